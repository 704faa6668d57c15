"""The registered queries against their SQL, and the pipeline's stages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_DIR, same_rows
from tests.llm.test_operators import brute_mix
from tickerloom.llm import mixing, queries
from tickerloom.llm.common import table


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(name, spark, duck, tmp_path):
    same_rows(spark, duck, queries.QUERIES[name](spark, SF_DIR), queries.ORACLE_SQL[name], f"{tmp_path}/out")


ODD = [(None, None, "en", "a"), (None, "", None, None), (5, " \n", "en", "a"), (6, None, "en", "b")]


def stage_rows(spark) -> list[tuple]:
    """Clean texts, exact and near copies of the first, one with a benchmark passage, with null and repeated doc_ids; and junk."""
    docs = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    good, sets = [], []
    for d in sorted(docs):
        w = (docs[d] or "").lower().split()
        mine = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        if labels.get(d) == 1 and len(w) > 60 and len(good) < 12 and not any(len(mine & x) > 0.3 * len(mine) for x in sets):
            good.append(docs[d])
            sets.append(mine)
    bad = [docs[d] for d in sorted(docs) if labels.get(d) == 0 and docs[d]][:6]
    passage = max((r.text for r in table(spark, SF_DIR, "benchmark").collect() if r.text), key=len)
    first = good[0].split()
    rows = [(10 + i, x, "en", "ab"[i % 2]) for i, x in enumerate(good)]
    rows += [(40, "  ".join(first), "en", "a"), (10, good[0], "en", "a"), (None, good[0], "en", "a"), (41, " ".join([*first[:-1], "changed"]), "en", "b"), (None, " ".join(["changed", *first[1:]]), "en", None)]
    rows += [(42, f"{good[1]} {passage} {good[2]}", "en", "a"), (None, f"{good[3]} {passage}", "en", "a"), (11, f"{passage} {' '.join(good[4].split()[:10])}", "en", "a"), (43, " ".join(good * 20), "en", None)]
    return rows + [(60 + i, x, "en", "a") for i, x in enumerate(bad)] + ODD


def test_stages_on_odd_rows(spark):
    """Each stage on nulls, empty and long texts, ties, repeated rows and clashing column names; and on an empty table."""
    rows = stage_rows(spark)
    names = "doc_id long, text string, lang string, source string, _id string, _hash string, _sha string, draw string, node string, hash string, size string, digest string"
    docs = spark.createDataFrame([(*r, *"abcdefgh") for r in rows], names).repartition(3)
    ids = lambda df: sorted((str(r.doc_id), r.text) for r in df.collect() if r.text and r.text.strip())
    given, passage = ids(docs), max((r.text for r in table(spark, SF_DIR, "benchmark").collect() if r.text), key=len)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        kept, blank = ids(out), out.where("trim(text) = '' or trim(text) = '\n' or text is null").count()
        if name == "quality classifier":
            assert blank == 0 and sum(x[0].isdigit() and 10 <= int(x[0]) < 22 for x in kept) >= 11 and sum(x[0].isdigit() and int(x[0]) >= 60 for x in kept) <= 1
        if name == "exact dedup":
            words = [" ".join(x[1].split()) for x in kept]
            assert blank == 2 and len(set(words)) == len(words) and set(words) == {" ".join(x[1].split()) for x in given}
            assert ("10", rows[0][1]) in kept
        if name == "n-gram jaccard join":
            assert blank == len(ODD) and not any(x[0] in ("40", "41") or "changed" in x[1] for x in kept) and kept.count(("10", rows[0][1])) == 2
            assert all((str(d), x) in kept for d, x, _, _ in rows[1:12])
        if name == "benchmark decontamination":
            assert blank == len(ODD) and kept == [x for x in given if passage not in x[1]]
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name
    mix = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    size = {s: sum(len((x or "").split()) for _, x, _, t in rows if t == s) for s in ("a", "b", None)}
    for s, n in size.items():
        words = mix.where(F.col("source").eqNullSafe(F.lit(s))).agg(F.sum(F.size(F.split("text", " ")))).first()[0]
        assert 0 < words <= 2 * n
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF_DIR).count() == 0


def test_pipeline(spark):
    """Stage by stage as run() does; the mix against brute force over what the stage before it left."""
    docs = table(spark, SF_DIR, "documents")
    labels = {r.doc_id: r for r in table(spark, SF_DIR, "labels").collect()}
    left = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        kept = stage(spark, left, SF_DIR).cache()
        assert kept.columns == docs.columns and 0 < kept.count() <= left.count()
        if not i:
            ids = {r.doc_id for r in kept.select("doc_id").collect()}
            good = [d for d, r in labels.items() if r.quality == 1]
            assert sum(d in ids for d in good) >= 0.97 * len(good)
        left = kept
    mix = corpus_pipeline.STAGES[-1][1](spark, left, SF_DIR)
    rows = [(r.doc_id, r.text, r.source) for r in left.collect()]
    _, text = brute_mix(rows, mixing.Mix(left), mixing.BLOCK)
    got = sorted((r.shard, r.slot, r.text) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert got == sorted(text) and mix.columns == ["shard", "slot", "source", "doc_ids", "text"]
