"""Each operator on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, against brute force."""

from __future__ import annotations

import base64
import collections
import gzip
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickerloom.llm import components, decontaminate, dedup_exact, jaccard, langid, license, lmscore, mixing, pii, quality, warc
from tickerloom.llm.common import shingle_sets, sliced

KIND = "doc_id long, text string, lang string, source string, n_chars long, size long, node string, fp string, kept string, words string"
BLANK = re.compile("[\x20\x09-\x0d]+")
VOWELS, HEADS = "aeiou", "bdfgklmnprst"


def prose(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(HEADS) + rng.choice(VOWELS) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def corpus(seed: int = 1) -> list[tuple]:
    """Texts of many kinds: (doc_id, text, source)."""
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", " \t\n", "one", "One", "a b c d", "A  b\tc d", "é" * 50, "x" * 5000, "\x0b\x0c \r"]
    for _ in range(12):
        base = prose(rng, rng.randint(20, 300))
        texts.append(" ".join(base))
        texts.append("\n ".join(base))  # equal after normalisation, or not: a blank run is one space
        near = list(base)
        near[rng.randrange(len(near))] = "changed"
        texts.append(" ".join(near).upper())
        far = [w if rng.random() > 0.2 else "other" for w in base]
        texts.append(" ".join(far))
    texts.append(" ".join(prose(rng, 20_000)))
    texts += [texts[12]] * 40
    rows = [(i * 7 % 1009, x, [None, "a", "b", "ü", "hot"][min(4, i % 9)]) for i, x in enumerate(texts)]
    return [*rows, rows[15], rows[15], (None, "a b c d", "a")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(d, x, "en", s, 1, 2, "n", "f", "k", "w") for d, x, s in rows]
    return spark.createDataFrame(full, KIND).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KIND)


def words(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [w for w in BLANK.split(low) if w]


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


# 3
def test_exact_groups(docs, rows, none):
    norm = [BLANK.sub(" ", x or "") for _, x, _ in rows]
    ids, count = collections.defaultdict(list), collections.Counter(norm)
    for (d, _, _), x in zip(rows, norm):
        ids[x].append(d)
    least = {x: min((d for d in v if d is not None), default=None) for x, v in ids.items()}
    want = [(d, least[x] if count[x] > 1 else d, count[x], count[x] == 1 or d == least[x], hashlib.sha256(x.encode()).hexdigest()) for (d, _, _), x in zip(rows, norm)]
    assert sorted_rows(dedup_exact.exact_groups(docs)) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert dedup_exact.exact_groups(none).count() == 0


def test_keep_first(docs, rows):
    kept = dedup_exact.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id is null").count() == 0  # its text has a row with a doc_id
    norm = {BLANK.sub(" ", x or "") for _, x, _ in rows}
    assert kept.count() == len(norm) and kept.select(dedup_exact.norm_text(F.col("text"))).distinct().count() == len(norm)


def test_keep_first_with_clashing_names_and_shared_ids(spark):
    rows = [(1, "a b", "x"), (1, "c d", "y"), (2, "a  b", "z"), (3, "c d", "w"), (1, "a b", "x"), (4, "alone", "v"), (1, "own", "u")]
    kept = dedup_exact.keep_first(spark.createDataFrame(rows, "doc_id long, text string, _sha string").withColumn("_id", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "_sha", "_id"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a b"), (1, "c d"), (1, "own"), (4, "alone")]


@pytest.mark.parametrize("bits", [20, 54])
def test_counting_quotient_filter(bits):
    rng = np.random.default_rng(bits)
    parts = [rng.integers(0, 1 << bits, 500).astype(np.uint64) >> np.uint64(rng.integers(0, 12)) for _ in range(6)]
    parts += [parts[0][:100], np.full(200_000, 77, np.uint64), np.arange(50, dtype=np.uint64), np.zeros(0, np.uint64)]
    one, many = dedup_exact.CountingQuotientFilter(bits), []
    for p in parts:
        one.insert(p)
        many.append(dedup_exact.CountingQuotientFilter(bits))
        many[-1].insert(p)
    want = collections.Counter(np.concatenate(parts).tolist())
    for cqf in (one, dedup_exact.merge(many), dedup_exact.CountingQuotientFilter.from_bytes(one.to_bytes())):
        prints, counts = cqf.items()
        assert dict(zip(prints.tolist(), counts.tolist())) == want and prints.tolist() == sorted(want)
        assert all(cqf.count(x) == want[x] for x in [*list(want)[:200], 77, 0, 49]) and cqf.count(next(x for x in range(1 << 20) if x not in want)) == 0
        assert cqf.occupied.sum() == cqf.run_end.sum() == len({x >> (bits - cqf.q_bits) for x in want})
        assert (~cqf.counter[cqf.occupied.nonzero()[0][:1]]).all() and cqf.counter.sum() >= sum(n > 1 for n in want.values())
    assert dedup_exact.CountingQuotientFilter(bits).items()[0].size == 0


# 4
def brute_mix(rows, mix, block):
    """(doc_id, size, taken) and the blocks, by loops over each source's stream in the order of the mix's places."""
    starts = collections.defaultdict(list)
    for r in mix.rows.collect():
        starts[(r.doc_id, r.source_no, r["size"], r.digest)].append(r.start)
    streams, spans = collections.defaultdict(dict), []
    number = {s: i for i, s, _, _ in mix.known}
    digests = {r.text: r.d for r in mix.rows.sparkSession.createDataFrame([(x,) for _, x, _ in rows], "text string").select("text", F.xxhash64("text").alias("d")).collect()}
    for d, x, s in rows:
        w = words_as_they_are(x)
        at = starts[(d, number[s], len(w), digests[x])].pop()
        spans.append((d, len(w), number[s], at))
        for i, y in enumerate(w):
            assert at + i not in streams[number[s]]
            streams[number[s]][at + i] = y
    assert not any(starts.values()) and all(sorted(x) == list(range(len(x))) for x in streams.values())
    slots = [(r.shard, r.slot, r.source_no, r.block) for r in mix.slots.collect()]
    times = collections.Counter((s, b) for _, _, s, b in slots)
    taken = [(d, n, sum(times[(s, i // block)] for i in range(at, at + n))) for d, n, s, at in spans]
    text = [(a, b, " ".join(streams[s][i] for i in range(k * block, (k + 1) * block) if i in streams[s])) for a, b, s, k in slots]
    return taken, text


def words_as_they_are(x):
    return [w for w in BLANK.split(x or "") if w]


def test_mix(spark, docs, rows, none):
    for table, given in ((docs, rows), (spark.createDataFrame(REPEATS, "doc_id long, text string, source string"), REPEATS)):
        mix = mixing.Mix(table, block=4)
        got = mix.taken().collect()
        taken, text = brute_mix(given, mix, 4)
        key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
        assert sorted(((r.doc_id, r["size"], r.taken) for r in got), key=key) == sorted(taken, key=key)
        assert sorted((r.shard, r.slot, r.text) for r in mix.blocks(table).collect()) == sorted(text)
        assert all(0 <= r.taken <= 2 * r["size"] for r in got)
        by = collections.Counter()
        for r in got:
            by[(r.source_size, r.target)] += r.taken
        assert all(abs(taken - target) <= 8 for (_, target), taken in by.items())
        again = mixing.Mix(table.repartition(7), block=4).taken()
        assert sorted_rows(again) == sorted(map(tuple, got), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert mixing.Mix(none).taken().count() == 0 and mixing.Mix(none).blocks(none).count() == 0


REPEATS = [(None, "a b c", "s")] * 30 + [(5, "one text", "s"), (5, "two words", "s"), (5, None, None), (None, "x y z u v", None)] + [(i, f"w{i} again", "t") for i in range(20)]


def test_targets():
    t = mixing.targets([("b", 100), (None, 100), ("a", 10), ("c", 1000)])
    assert t["a"] == 20 and sum(t.values()) == pytest.approx(1815) and t["b"] == 200 and t["c"] == pytest.approx(1815 - 20 - 200 - t[None])
    assert mixing.targets([("a", 0)]) == {"a": 0}


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation(n):
    assert sorted(mixing.permuted(np.arange(n), n, 5).tolist()) == list(range(n))


def test_draws_add_up():
    n = mixing.drawn(70_000, 10, [1, 2])
    assert n.sum() == 70_000 and (abs(n - 7000) < 500).all() and (n == mixing.drawn(70_000, 10, [1, 2])).all() and mixing.drawn(0, 3, [1, 2]).tolist() == [0, 0, 0]


def test_copies_of_a_row_are_split(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 7)
    rows = [(1, "a b c", "s")] * 40 + [(2, "d e", "s")]
    got = mixing.Mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=2)
    assert sorted(r.start for r in got.rows.where("doc_id = 1").collect()) in ([3 * i for i in range(40)], [2 + 3 * i for i in range(40)])


# 5
def test_archives(spark):
    pages = [(i, f"http://www.ex{i % 3}.com/p{i % 4}?q#f", f"<p>{i % 5}</p>\r\n\r\nWARC/1.1" if i % 7 else None) for i in range(60)]
    pages += [(99, None, ""), (100, "HTTP://M.Ex1.com", "ü" * 3000), (59, "http://x/", "own"), (98, "http://x/\r\ny", "own"), (1, "http://y/", "<p>2</p>\r\n\r\nWARC/1.1"), (None, "http://z/", "alone"), (None, "http://z/", "own"), (None, "http://z/", "two"), (None, None, "two")]
    pages += [pages[4], pages[4], pages[59]]
    kind = "page_id long, url string, html string, file string, place string, refers_to string, sha string, n string"
    df = spark.createDataFrame([(*p, "f", "p", "r", "s", "n") for p in pages], kind).repartition(4)
    first: dict = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, u, h in pages:
        raw, least = (h or "").encode(), first.get(h or "")
        sha1, same = base64.b32encode(hashlib.sha1(raw).digest()).decode(), least is None or i == least
        want.append((i, len(raw), sha1, "response" if same else "revisit", None if same else least, warc.url_key(u), warc.capture_time(i)))
    got = warc.archived(df).collect()
    text = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:7] for r in got), key=text) == sorted(want, key=text)
    assert [r.place for r in sorted(got, key=lambda r: r.place)] == list(range(len(pages)))
    assert [(r.url_key, r.ts) for r in sorted(got, key=lambda r: r.place)] == sorted((r.url_key, r.ts) for r in got)
    assert warc.archived(df.limit(0)).count() == 0


def test_archives_keep_every_payload(spark, tmp_path):
    """What a revisit repeats is in the archive: each distinct payload is in some response."""
    pages = [(i % 20 if i % 3 else None, "http://h/", f"payload {i % 30}") for i in range(200)]
    lines = warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), f"file://{tmp_path}/w").collect()
    found = set()
    for r in lines:
        raw = (tmp_path / "w" / r.file).read_bytes()[r.offset : r.offset + r.length]
        fields, block = warc.parse(gzip.decompress(raw))
        if fields["WARC-Type"] == "response":
            found.add(block.partition(b"\r\n\r\n")[2].decode())
    assert len(lines) == 200 and found == {h for _, _, h in pages}


def test_capture_times_do_not_wrap():
    ids = [-(10**18), -5, 0, 1, 5_000_000, 10**12, 10**16, 10**18]
    times = [warc.capture_time(i) for i in ids]
    assert times == sorted(times) and len(set(times)) == len(ids) and warc.capture_time(None) == warc.capture_time(0)


def test_index_is_in_order(spark, tmp_path, monkeypatch):
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), (F.col("id") % 7).cast("string"), F.lit(".org/")).alias("url"), F.lit("x").alias("html")).repartition(5)
    lines = warc.write_archives(pages, f"file://{tmp_path}/w").cache()
    monkeypatch.setattr(warc, "RANGE_ROWS", 60)
    rows = warc.merged_index(lines).orderBy("place").collect()
    keys = [(r.url_key, r.ts, r.page_id) for r in rows]
    assert len(keys) == 500 and keys == sorted(keys) and [r.place for r in rows] == list(range(500))


def test_loser_tree():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(itertools.chain(*runs))


# 6
def brute_components(rows):
    sets = []
    for _, x, _ in rows:
        w = words(x)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least: dict = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _, _), s) in enumerate(zip(rows, sets))]


def test_near_groups(docs, rows, none):
    want = brute_components(rows)
    assert sorted_rows(jaccard.near_groups(docs)) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert jaccard.near_groups(none).count() == 0
    assert jaccard.keep_one(docs).columns == docs.columns


@pytest.mark.parametrize("seed", [1, 2])
def test_near_groups_with_chains(spark, seed):
    """A family of copies with more and more changes, and a passage that all share."""
    rng = random.Random(seed)
    base, passage, rows = prose(rng, 120), prose(rng, 60), []
    for i in range(70):
        w = list(base)
        for _ in range(i % 9):
            w[rng.randrange(len(w))] = f"z{rng.randrange(40)}"
        rows.append((i, " ".join(w), None))
    for i in range(70, 110):
        rows.append((i, " ".join(prose(rng, rng.randint(5, 80)) + passage), None))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(map(tuple, jaccard.near_groups(df).collect())) == sorted(brute_components(rows))


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (60, 50), (70, 60), (70, 70), (50, 60)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 50: 50, 60: 50, 70: 50}


# 7
def test_masks_meet_every_window():
    for wrong in itertools.combinations(range(decontaminate.WINDOW), decontaminate.SLACK):
        assert any(all(m[i] == "0" or at + i not in wrong for i in range(len(m))) for m in decontaminate.MASKS for at in range(decontaminate.WINDOW - len(m) + 1))


def test_leaks(spark, docs, none):
    rng = random.Random(9)
    items = [(0, " ".join(prose(rng, 40))), (1, " ".join(prose(rng, 9))), (2, " ".join(prose(rng, 4))), (3, None), (4, " ".join(prose(rng, 15)))]
    long, short, tiny, edge = (items[i][1].split() for i in (0, 1, 2, 4))
    text, want = [], {}
    for i in range(80):
        w = prose(rng, rng.randint(0, 60))
        case = i % 8
        if case < 6:
            part = [list(long), list(short), list(tiny), list(edge), list(long[10:25]), list(long[:14])][case]
            n = rng.randint(0, 4)
            for j in rng.sample(range(len(part)), min(n, len(part))):
                part[j] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = part
        text.append((i, "\n".join(w).upper() if i % 3 else "  ".join(w)))

    def hit(doc, item):
        size = min(15, len(item))
        slack = 2 if len(item) >= 15 else 0
        return len(item) >= 8 and any(sum(a != b for a, b in zip(doc[i : i + size], item[j : j + size])) <= slack for i in range(len(doc) - size + 1) for j in range(len(item) - size + 1))

    want = {(i, k) for i, x in text for k, item in items if hit(words(x), words(item))}
    df = spark.createDataFrame([*text, (100, None), (101, ""), text[0]], "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(5))
    got = decontaminate.leaks(df, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and got.count() == len(want)
    old, decontaminate.BROADCAST_SEEDS = decontaminate.BROADCAST_SEEDS, 0
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()} == want
    decontaminate.BROADCAST_SEEDS = old
    assert decontaminate.leaks(none, bench).count() == 0 and decontaminate.leaks(df, bench.limit(0)).count() == 0
    assert {r.doc_id for r in decontaminate.clean(df, bench).collect()} == ({i for i, _ in text} | {100, 101}) - {d for d, _ in want}


def test_clean_goes_by_row(spark, monkeypatch):
    rng = random.Random(2)
    item, other = " ".join(prose(rng, 30)), [" ".join(prose(rng, 40)) for _ in range(3)]
    leaky = f"{other[0]} {item} {other[1]}"
    rows = [(None, leaky), (None, other[0]), (1, leaky), (1, other[1]), (1, other[1]), (2, None), (3, ""), (None, None), (4, f"{item} end")]
    docs = spark.createDataFrame([(*r, "i", "h") for r in rows], "doc_id long, text string, _id string, _hash string")
    bench = spark.createDataFrame([(None, item), (None, item), (7, None), (8, "short item")], "item_id long, text string")
    text = lambda r: tuple(map(str, r))
    want = sorted((r for r in rows if not (r[1] and item in r[1])), key=text)
    for most in (decontaminate.BROADCAST_SEEDS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", most)
        kept = decontaminate.clean(docs, bench)
        assert kept.columns == docs.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=text) == want
        assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == {(None, None), (1, None), (4, None)}
    assert decontaminate.clean(docs.limit(0), bench).count() == 0 and decontaminate.clean(docs, bench.limit(0)).count() == len(rows)


# 8
def test_quality(spark, docs, none):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        w = prose(rng, rng.randint(12, 120))
        text = ". ".join(" ".join(w[a : a + 9]).capitalize() for a in range(0, len(w), 9)) + "."
        if i % 5 == 1:
            text = " ".join(x + rng.choice(["###", "%%%", "&&&", "$$$"]) for x in w)
        if i % 5 == 2:
            text = " ".join(x.upper() + "!!" for x in w)
        if i % 10 == 8:
            text = " ".join(x for x in w[:6] for _ in range(15))
        rows.append((i, text))
    got = {r.doc_id: r for r in quality.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    clean = [i for i, _ in rows if i % 5 not in (1, 2) and i % 10 != 8]
    junk = [i for i, _ in rows if i not in set(clean)]
    assert sum(got[i].kept for i in clean) >= 0.98 * len(clean) and sum(not got[i].kept for i in junk) >= 0.9 * len(junk)
    odd = {r.doc_id: r for r in quality.scores(docs).collect()}
    assert not odd[0].kept and odd[0].score == 0 and len(odd) > 50
    assert quality.scores(none).count() == 0 and quality.keep_good(docs).columns == docs.columns


def test_labellers_accuracies_are_found():
    """Votes drawn with known accuracies, in kinds of known shares."""
    rng, n = np.random.default_rng(4), len(quality.LABELLERS)
    kind = rng.choice(n + 1, 40_000, p=[*[0.04] * n, 1 - 0.04 * n])
    wrong = np.full((n + 1, n), 0.1)
    wrong[np.arange(n), np.arange(n)] = np.linspace(0.7, 0.95, n)
    wrong[n] = 0.02
    votes = np.where(rng.random((len(kind), n)) < wrong[kind], 1, 2)
    patterns, counts = np.unique(votes @ 3 ** np.arange(n), return_counts=True)
    posterior, found = quality.fit_labellers(patterns, counts.astype(float))
    for j, (_, share, right_good, right_junk) in enumerate(found):
        assert abs(share - 0.04) < 0.02 and abs(right_good - 0.98) < 0.02 and abs(right_junk - wrong[j, j]) < 0.2
    good = np.array([posterior[p] > 0.5 for p in (votes @ 3 ** np.arange(n)).tolist()])
    assert (good == (kind == n)).mean() > 0.85


def test_quality_scores_are_those_of_plain_sums(spark):
    """The scorer's sums over whole batches against a text's features one by one; with and without bins."""
    texts = ["the red, sea AND the $$ old man\nred", "", None, "one", "x" * 999, "THE END!! " * 30]
    w = np.random.default_rng(1).standard_normal(quality.DIM + 1)
    for bins in (True, False):
        batch = pa.RecordBatch.from_pydict({"draw": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
        (features,) = quality._features(bins)([batch])
        _, got = quality._score(batch.column("text"), w, bins)
        for x, text, p in zip(features.to_pylist(), texts, got):
            z = sum(w[i] * v for i, v in zip(x["places"], x["value"])) + w[-1]
            assert p == pytest.approx(1 / (1 + math.exp(-z)) if words(text) else 0, abs=1e-6)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert {r.labeller for r in quality.accuracies(docs).collect()} == set(quality.MEASURES)


# 9
def test_lm_base_and_totals(docs, rows, none):
    end, counts = object(), collections.Counter()
    held = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 7 == 2
    for d, x, _ in rows:
        if not held(d):
            counts.update([*words(x), end])
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, x, _ in rows:
        w = [*words(x), end]
        want.append((d, held(d), len(w), sum(counts[a] > 0 for a in w), n, sum(math.log10((counts[a] + 1) / (n + v + 1)) for a in w)))
    got = lmscore.text_scores(docs).collect()
    key = lambda r: ((r[0] is None, r[0] or 0), r[2])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] < 0
    assert lmscore.text_scores(none).count() == 0


def lm_model(uses, first):
    model = lmscore.Model(uses, first)
    rng = np.random.default_rng(3)
    for k in ("ask", "offer", "carry", "own", "out"):
        model.p[k] += rng.standard_normal(model.p[k].shape).astype(np.float32) * 0.3
    return model


def test_lm_probabilities_sum_to_one_and_look_back_only():
    rng = np.random.default_rng(0)
    model = lm_model(np.r_[rng.integers(0, 50, 700).astype(float), 5], np.r_[rng.random(700) < 0.5, True])
    seq = rng.integers(0, 700, 40)
    for k in (0, 1, 7, 20):
        own, kind = zip(*(model.each(np.array([*seq[:k], x]), np.array([0, k + 1])) for x in range(701)))
        assert sum(10 ** (o[-1] + q[-1]) for o, q in zip(own, kind)) == pytest.approx(1, abs=1e-4)
        assert all(np.allclose(o[:k], own[0][:k]) for o in own)


def test_lm_learns():
    rng = np.random.default_rng(1)
    ids = np.array([[1, 2, 3, 4][i % 4] if rng.random() > 0.05 else 9 for i in range(6000)])
    uses = np.bincount(ids, minlength=601).astype(float)
    model = lmscore.Model(uses, np.arange(601) % 2 == 0)
    starts = np.arange(0, 6001, 60)
    before = sum(x.sum() for x in model.each(ids, starts))
    x, target = model.windows(ids, starts)
    model.learn(x, model.classes(ids, target))
    assert sum(x.sum() for x in model.each(ids, starts)) > 0.6 * before
    some, _ = model.windows(ids, starts, 4, rng)
    assert len(x) / 4 <= len(some) <= len(x) / 4 + 1


def test_lm_scores_are_those_of_plain_loops():
    """All of a chunk against dictionaries and loops: words, spellings, segments, and each text's own counts left out."""
    rng = random.Random(7)
    stock, passage = prose(rng, 40), prose(rng, 90)
    texts = [None, "", "one", " ".join(passage), " ".join(passage)] + [" ".join(rng.choice(stock) if rng.random() < 0.9 else "".join(prose(rng, 2)) for _ in range(rng.randint(1, 120))) for _ in range(25)] + [" ".join(prose(rng, 30) + passage[20:])]
    held = [i % 5 == 2 for i in range(len(texts))]
    with open(lmscore.TOKENIZER, "rb") as f:
        ranks = f.read()
    end = len(lmscore._blank(ranks))
    shared = type("Shared", (), {})
    given = shared()
    given.value = ranks
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string()), "held_out": held})
    (chunk,) = lmscore._chunks(given, end)([batch])
    row = chunk.to_pylist()[0]
    uses = np.zeros(end + 1)
    uses[row["used"]], uses[end] = row["uses"], held.count(False)
    model = lm_model(uses, np.r_[lmscore._blank(ranks), True])

    tokens = [[*words(x), None] for x in texts]
    ids = [[lmscore.encoder(ranks).encode_ordinary(" " + w) for w in t[:-1]] for t in tokens]
    cuts, anchors = [], []
    for t in tokens:
        w = t[:-1]
        h = lmscore.Words(pa.array([" ".join(w)])).hashes()
        marks = [0]
        for i in range(len(w) - lmscore.ANCHOR + 1):
            z = np.zeros(1, np.uint64)
            for k in range(lmscore.ANCHOR):
                z = lmscore._mix(z + h[i + k : i + k + 1] + np.uint64(k))
            if int(z[0]) % lmscore.SEGMENT == 0:
                marks.append(i + lmscore.ANCHOR)
        cuts.append([(a, b) for a, b in zip(marks, [*marks[1:], len(t)])])
        anchors.append([tuple(w[a - lmscore.ANCHOR : a]) if a else () for a in marks])
    count, segs, starts, mass, types = (collections.Counter() for _ in range(5))
    for t, c, a, i, out in zip(tokens, cuts, anchors, ids, held):
        if not out:
            count.update(t[:-1])
            starts.update(a)
            segs.update((x, tuple(t[p:q])) for x, (p, q) in zip(a, c))
            mass.update(x[0] for x in i)
    first_of = {w: x[0] for t, i in zip(tokens, ids) for w, x in zip(t, i)}
    types.update(first_of[w] for w in count)
    want = []
    for t, c, a, i, out in zip(tokens, cuts, anchors, ids, held):
        own, kind = model.each(np.array([*itertools.chain(*i), end]), np.array([0, sum(map(len, i)) + 1]))
        less = collections.Counter(t) if not out else collections.Counter()
        at, logs = 0, []
        for w, x in zip(t[:-1], i):
            spelling = sum(own[at + 1 : at + len(x)]) + sum(kind[at + 1 : at + len(x) + 1])
            f = x[0]
            rest = 10.0**spelling
            logs.append(own[at] + math.log10(max(0, count[w] - less[w] - lmscore.DISCOUNT) / mass[f] + lmscore.DISCOUNT * types[f] / mass[f] * rest if mass[f] else rest))
            at += len(x)
        logs.append(own[at])
        mine = [(x, tuple(t[p:q])) for x, (p, q) in zip(a, c)]
        total = 0.0
        for (p, q), key in zip(c, mine):
            n_anchor = starts[key[0]] - (0 if out else a.count(key[0]))
            n_seg = segs[key] - (0 if out else mine.count(key))
            plain = sum(logs[p:q])
            if n_anchor:
                plain += math.log10(1 - lmscore.MEMORY)
                memory = math.log10(lmscore.MEMORY * n_seg / n_anchor) if n_seg else -math.inf
                plain = max(plain, memory) + math.log10(1 + 10 ** -abs(max(plain, memory) - min(plain, memory)))
            total += plain
        want.append(total)
    asked = list(lmscore._asked([pa.RecordBatch.from_pylist([{"chunk": 0, **{k: row[k] for k in ("keys", "kinds", "counts")}}])]))[0]
    asked = pa.table({"place": asked.column("place"), "total": asked.column("n")})
    given.value = (model, *(np.array([c.get(i, 0) for i in range(end + 1)]) for c in (mass, types)))
    kept = pa.Table.from_pylist([{"chunk": 0} | {k: v for k, v in row.items() if k not in ("keys", "kinds", "counts", "used", "uses")}])
    got = lmscore._scored(given, len(count) + 1, 100, held.count(False), end)(asked, kept)
    assert got.column("score").to_pylist() == pytest.approx(want, rel=1e-4, abs=1e-3)
    assert want[3] / len(tokens[3]) > want[-1] / len(tokens[-1])  # a text that occurs twice is remembered


def test_lm_subwords_are_those_of_each_word():
    with open(lmscore.TOKENIZER, "rb") as f:
        ranks = f.read()
    rng = random.Random(2)
    bits = ["a", "the", "ing", "1", "42", "'s", "!", "é", "ção", "\u00a0", "\u2003", "日本", "\u0085", "-", "x" * 3000]
    for odd in (bits, [b for b in bits if not b.isspace()]):
        for _ in range(300):
            some = ["".join(rng.choice(odd) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 6))]
            flat, lens = lmscore.subwords(some, ranks)
            assert [x.tolist() for x in np.split(flat, np.cumsum(lens)[:-1])] == [lmscore.encoder(ranks).encode_ordinary(" " + w) for w in some] or not some


def test_lm_beats_its_base_on_held_out_texts(spark):
    found = lmscore.text_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    score, base = found.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


def test_lm_two_equal_long_rows(spark):
    """Rows longer than a chunk are chunks of their own, and equal ones don't mix."""
    stock = "government international information development university president community different important management".split()
    text = " ".join(stock * 62_000)
    assert len(text) > lmscore.CHUNK_BYTES
    docs = spark.createDataFrame([(3, text), (3, text), (4, "red sea")], "doc_id long, text string")
    got = lmscore.text_scores(docs).orderBy("doc_id", "n_tokens").collect()
    count, long = collections.Counter(words(text) * 2 + ["red", "sea"]), len(words(text))
    assert all(zlib.crc32(str(d).encode()) % 7 != 2 for d in (3, 4))
    n, v = 2 * long + 2 + 3, len(count) + 1
    want = sum(k * math.log10((count[w] + 1) / (n + v + 1)) for w, k in collections.Counter(words(text)).items()) + math.log10(4 / (n + v + 1))
    assert [r.n_tokens for r in got] == [long + 1, long + 1, 3] and got[0].base_score == pytest.approx(want, rel=1e-9) and got[1].base_score == pytest.approx(want, rel=1e-9) and got[0].score == pytest.approx(got[1].score) and got[0].score < 0


# 10
def test_languages(spark, none):
    rng = random.Random(3)
    sounds = {"aa": ("ka", "tu", "mi"), "bb": ("sch", "ung", "keit"), "cc": ("ção", "nho", "lha")}
    rows = [(i, " ".join("".join(rng.choice(sounds[k]) for _ in range(3)) for _ in range(rng.randint(3, 60))), k) for i in range(300) for k in [sorted(sounds)[i % 3]]]
    rows += [(1000, None, "aa"), (1001, "12 34 !!", "aa"), (1002, "", "bb"), (1003, "katumi tumika kami", None)]
    got = {r.doc_id: r for r in langid.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    held = [(i, k) for i, _, k in rows if zlib.crc32(str(i).encode()) % 5 == 0 and i < 1000]
    assert all(got[i].held_out for i, _ in held) and sum(got[i].lang_pred == k for i, k in held) >= 0.97 * len(held)
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0)] * 3 and got[1003].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.languages(none).count() == 0
    assert {r.lang_pred for r in langid.languages(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).collect()} == {"und"}


def test_languages_with_repeats_clashing_names_and_long_texts(spark):
    rng = random.Random(6)
    sounds = {"aa": ("ka", "tu", "mi"), "bb": ("sch", "ung", "keit")}
    text = lambda k, n: " ".join("".join(rng.choice(sounds[k]) for _ in range(3)) for _ in range(n))
    hot = text("aa", 30)
    rows = [(i, text(k, 20), k) for i in range(200) for k in [sorted(sounds)[i % 2]]] + [(7, hot, "aa")] * 150 + [(None, text("bb", 10), "bb"), (500, text("bb", 60_000), None), (501, " ".join([text("aa", 5), text("bb", 5)]), None)]
    docs = spark.createDataFrame([(*r, "d", "r", "h", "s") for r in rows], "doc_id long, text string, lang string, draw string, rank string, held_out string, score string")
    got = langid.languages(docs).collect()
    assert len(got) == len(rows) and {(r.lang_pred, r.score) for r in got if r.doc_id == 7 and r.lang_pred == "aa"} and len({r.score for r in got if r.doc_id == 7}) <= 2
    assert [r.lang_pred for r in got if r.doc_id in (None, 500)] == ["bb", "bb"] and all(0 <= r.score <= 1 for r in got)
    assert sorted((r.doc_id or -1, r.lang_pred, r.score) for r in langid.languages(docs.repartition(5)).collect()) == sorted((r.doc_id or -1, r.lang_pred, r.score) for r in got)


# 1
def test_rare_languages_are_learned_at_every_size(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 40)  # a small table as large against the sample as millions of documents
    rng = random.Random(4)
    sounds = {"aa": ("ka", "tu", "mi"), "bb": ("sch", "ung", "keit"), "rare": ("ção", "nho", "lha")}
    kinds = ["rare" if i % 200 == 51 else ("aa", "bb")[i % 2] for i in range(4000)]
    rows = [(i, " ".join("".join(rng.choice(sounds[k]) for _ in range(3)) for _ in range(12)), k) for i, k in enumerate(kinds)]
    got = {r.doc_id: r.lang_pred for r in langid.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    rare = [i for i, k in enumerate(kinds) if k == "rare"]
    assert sum(got[i] == "rare" for i in rare) >= 0.9 * len(rare)


def brute_spans(text):
    out = []
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    for k, p in enumerate(patterns):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")) or k == 2 and not (16 <= len(digits) <= 19 and pii.luhn(digits)) or k == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    bits = ["a", "@", ".", "-", "1", "2", "4111 1111 1111 1111", "+", "(", " ", "b.c", "25", "255", "_", "%", "é", "192.168.0.1", "\n", "+1 (555) 123-4567", "12"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_personal_data(spark, docs, none):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        entity = [f"+1 (5{i % 90 + 10}) 123-4{i % 900 + 100}", "4111 1111 1111 1111", f"10.{i % 250}.3.4", f"user{i}@mail{i % 7}.example.com"][i % 4]
        rows.append((i, " ".join(prose(rng, 30)) + " call " + entity + " or " + " ".join(prose(rng, 30))))
    rows += [(500, "first +1 (555) 123-4567 then again (555) 123-4567 only"), (501, "mail bob.smith@example.com, or bob.smith [at] example.com"), (502, "order 12345678 of 20240115"), (503, "9" * 100_000), (504, "a." * 50_000 + "@")]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows[:302]:
        base = brute_spans(text)
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(base))
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and set(joined.split(",")) <= set(got[i].spans.split(","))
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == j for b in base) for j in range(4)]
    assert got[500].n_added == 1 and f"phone:{rows[300][1].index('(555) 123-4567', 20)}:{rows[300][1].index(' only')}" in got[500].spans.split(",")
    assert got[501].n_added == 1 and got[502].spans == "" and got[503].spans == "" and got[504].spans == ""
    assert pii.personal_data(docs).where("doc_id = 0").first().spans == "" and pii.personal_data(none).count() == 0


def test_field_finds_masked_repeats_and_leaves_others(spark):
    """On texts that the field didn't learn from: repeats as no pattern knows them are added, numbers of the same shape are not."""
    rng = random.Random(16)
    rows, want = [], {}
    for i in range(600):
        p = f"+1 {rng.randint(200, 999)} {rng.randint(200, 999)} {rng.randint(1000, 9999)}"
        e = f"{''.join(prose(rng, 1))}.{rng.randint(1, 99)}@{''.join(prose(rng, 1))}.example.com"
        text = f"{' '.join(prose(rng, 20))} {p if i % 2 else e} {' '.join(prose(rng, 20))}"
        if i % 3 == 0:
            y = "-".join(re.sub("[^0-9]", "", p)[-10:][a:b] for a, b in ((0, 3), (3, 6), (6, 10))) if i % 2 else e.replace("@", " [at] ")
            want[i] = (len(text) + 1, len(text) + 1 + len(y))
            text += f" {y} {' '.join(prose(rng, 5))}"
        elif i % 3 == 1:
            text += f" {rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)} {' '.join(prose(rng, 5))}"
        rows.append((i, text))
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = sum(f":{a}:{b}" in got[i].spans for i, (a, b) in want.items())
    assert hit >= 0.9 * len(want)
    assert sum(got[i].n_added > 0 for i, _ in rows if i % 3 == 1) <= 0.05 * len(rows) / 3
    assert sum(got[i].n_added > 0 for i, _ in rows if i % 3 == 2) <= 0.02 * len(rows) / 3


def test_field_weights_favour_equal_labels():
    rng = random.Random(5)
    texts = [f"{' '.join(prose(rng, 9))} +1 {rng.randint(200, 999)} {rng.randint(200, 999)} {rng.randint(1000, 9999)} and {' '.join(prose(rng, 9))}" for _ in range(200)]
    w, near, far, skip, *_ = pii.fit([tuple(pii.example(t, i).values()) for i, t in enumerate(texts)])
    phone = pii.LABELS.index("phone")
    assert skip[phone, phone] > skip[phone, 0] and (skip != 0).any() and np.allclose(skip, skip.T)
    one = pii.example("1234567 x " * 5000, 1)
    assert len(one["label"]) == pii.SAMPLE_NODES


# 2
def repeated(rng: random.Random, kind: str, k: int, gap: int, first: bool, other: bool) -> tuple[str, set, set]:
    """A text with an entity, k repeats of it as no pattern knows them, and perhaps k others of that shape; spans of both."""
    if kind == "phone":
        x = f"+1 {rng.randint(200, 999)} {rng.randint(200, 999)} {rng.randint(1000, 9999)}"
        digits = re.sub("[^0-9]", "", x)[-10:]
        y, z = f"{digits[:3]}-{digits[3:6]}-{digits[6:]}", f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    else:
        local, host = f"{''.join(prose(rng, 2))}.{rng.randint(1, 99)}", "".join(prose(rng, 2))
        x, y, z = f"{local}@{host}.org", f"{local} [at] {host}.org", f"{''.join(prose(rng, 3))}.{rng.randint(1, 99)} [at] {''.join(prose(rng, 3))}.org"
    parts = [(y, 1)] * k
    parts = ([(x, 2), *parts] if first else [*parts, (x, 2)]) + [(z, 0)] * (k if other else 0)
    text, spans = "", {0: set(), 1: set(), 2: set()}
    for part, label in parts:
        text += " ".join(prose(rng, gap)) + " "
        spans[label].add((len(text), len(text) + len(part)))
        text += part + " "
    return text, spans[1], spans[0]


def test_all_repeats_of_an_entity_are_found(spark):
    """2 to 50 repeats, near and far, before and after the entity, after words that the field never saw; learned from few texts."""
    rng = random.Random(21)
    teach = [(i, " ".join(prose(rng, 20)) + (f" +1 {rng.randint(200, 999)} {rng.randint(200, 999)} {rng.randint(1000, 9999)} " if i % 2 else f" {''.join(prose(rng, 2))}.{i}@mail.example.com ") + " ".join(prose(rng, 9))) for i in range(40)]
    cases = [(1000 + i, *repeated(rng, *case)) for i, case in enumerate(itertools.product(("phone", "email"), (2, 5, 12, 50), (2, 40), (True, False), (True, False)))]
    table = spark.createDataFrame([*teach, *((i, text) for i, text, _, _ in cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(table).collect()}
    for kind, mine in (("phone", cases[: len(cases) // 2]), ("email", cases[len(cases) // 2 :])):
        hit = sum(f"{kind}:{a}:{b}" in got[i].spans.split(",") for i, _, want, _ in mine for a, b in want)
        wrong = sum(f":{a}:{b}" in got[i].spans for i, _, _, others in mine for a, b in others)
        assert hit >= 0.9 * sum(len(want) for _, _, want, _ in mine) and wrong <= 0.05 * sum(len(others) for _, _, _, others in mine)


def test_repeats_are_linked_to_their_entity():
    text = "a +1 415 555 0100 b 415-555-0100 c 415-555-0100 d bob.smith@x.org e bob.smith [at] x.org f bob.smlth [at] x.org g 22415-555-0100"
    nodes = pii.Nodes(text, pii.base_spans(text))
    skips = {(i, j, pii.EDGES[kind]) for i, j, kind in nodes.edges if kind > 1}
    assert skips == {(0, 1, "tail"), (0, 2, "tail"), (1, 2, "again"), (3, 4, "same"), (3, 5, "typo"), (4, 5, "alike"), (0, 6, "longer"), (2, 6, "alike")}


@pytest.mark.parametrize("seed", range(12))
def test_beliefs_are_those_of_all_labellings(seed):
    """Exact on trees, near on loops: against the sum over all labellings of graphs of up to 8 nodes."""
    rng = np.random.default_rng(seed)
    n, k, loops = int(rng.integers(2, 9)), 3, seed % 2
    node, tables = rng.normal(0, 1, (n, k)), rng.normal(0, 0.4, (2, k, k)) + 0.6 * np.eye(k)
    tables = (tables + tables.transpose(0, 2, 1)) / 2
    edges = [(int(rng.integers(0, j)), j, int(rng.integers(0, 2))) for j in range(1, n)]
    edges += [(i, j, 1) for i, j in itertools.combinations(range(n), 2) if loops and rng.random() < 0.15]
    labellings = np.array(list(itertools.product(range(k), repeat=n)))
    score = node[np.arange(n), labellings].sum(1) + sum(tables[e][labellings[:, i], labellings[:, j]] for i, j, e in edges)
    weight = np.exp(score - score.max())
    want = np.array([[weight[labellings[:, i] == c].sum() for c in range(k)] for i in range(n)]) / weight.sum()
    assert np.abs(pii.marginals(node, edges, tables) - want).max() < (0.1 if loops else 2e-3)


def test_messages_settle_in_contradictory_loops():
    edges = [(0, 1, 0), (1, 2, 0), (0, 2, 0)]
    p = pii.marginals(np.zeros((3, 2)) + [0.1, 0], edges, np.array([[[-9.0, 9], [9, -9]]]))
    assert np.isfinite(p).all() and np.allclose(p.sum(1), 1)


def test_licences(spark, docs, none):
    rng = random.Random(8)
    filler = lambda: " ".join(prose(rng, 25))
    cases = [("Released under the MIT License.", "mit"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("All rights reserved.", "reserved"), ("This work is licensed under the GNU General Public License, version 3.", "gpl"), ("Licensed under the Apache License, Version 2.0.", "apache")]
    rows = [(i, "\n".join([filler(), cases[i % 7][0] if i % 7 < 5 else filler(), filler()])) for i in range(140)]
    rows += [(900, "the license of the version is reserved for the public"), (901, None), (902, "GPL " * 3000), (903, "Licensed under the MIT License\n\n" + filler() + "\n\nAll rights reserved.")]
    got = {r.doc_id: r for r in license.licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].families == (cases[i % 7][1] if i % 7 < 5 else "") for i, _ in rows[:140])
    assert got[0].notices == "mit:1" and [got[i].n_notices for i in (900, 901, 902)] == [0, 0, 0] and got[903].notices == "mit:0,reserved:4"
    assert license.licences(none).count() == 0 and license.licences(docs).agg(F.sum("n_notices")).first()[0] == 0


def wrapped(text, width, prefix):
    lines, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            lines.append(line)
            line = ""
        line += (" " if line else "") + w
    return "\n".join(prefix + x for x in [*lines, line])


def test_wrapped_varied_and_named_notices_are_found(spark):
    """Recall on notices wrapped as in source files, with words left out, and on names and identifiers; prose of their words isn't taken."""
    rng = random.Random(12)
    cases = [(f, x) for f, x in license.templates() if f != license.FAMILIES.index("reserved")]
    rows, want = [], {}
    for i in range(500):
        f, x = cases[i % len(cases)] if i >= 60 else (long := [c for c in cases if len(c[1]) > 100])[i % len(long)]
        if len(x.split()) > 12 and i % 2:
            x = " ".join(w for w in x.split() if rng.random() > 0.05)
        prefix = ["", "# ", " * ", "// "][i % 4]
        rows.append((i, f"{' '.join(prose(rng, 12))}\n\n{prefix}Copyright 2021 Someone\n{wrapped(x, 72, prefix)}\n\n{' '.join(prose(rng, 12))}"))
        want[i] = license.FAMILIES[f]
    bag = [w for _, x in cases for w in x.split()]
    rows += [(1000 + i, " ".join(rng.choice(bag) for _ in range(60))) for i in range(200)]
    rows += [(2000, "/* SPDX-License-Identifier: GPL-2.0-only */"), (2001, "BSD-2-Clause is its SPDX-License-Identifier: BSD-2-Clause"), (2002, "SPDX-License-Identifier: LGPL-2.1-or-later"), (2003, " ".join(prose(rng, 300)) + " " + license.NOTICES["mit"][0] + " " + " ".join(prose(rng, 300)))]
    got = {r.doc_id: r for r in license.licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = [i for i in want if want[i] in got[i].families.split(",")]
    assert len(hit) >= 0.9 * len(want), [(want[i], got[i].families, rows[i][1]) for i in want if i not in hit][:5]
    assert sum(got[1000 + i].n_notices > 0 for i in range(200)) <= 10
    assert [got[i].families for i in range(2000, 2004)] == ["gpl", "bsd", "lgpl", "mit"]


def test_template_shares_are_those_of_sets():
    rng, v = random.Random(3), license.Vocabulary()
    tokens = lambda x: re.findall("[a-z0-9]+", x.lower())
    bigrams = lambda w: set(zip(w, w[1:]))
    for _ in range(40):
        f, x = rng.choice(license.templates())
        w = [y for y in tokens(x) if rng.random() > 0.1]
        _, _, of, at = v.stretches(pa.array([" ".join(w)]))
        if len(of) and of.max() == 0:
            want = max(len(bigrams(tokens(y)) & bigrams(w)) / len(bigrams(tokens(y))) for k, y in license.templates() if k == f and len(tokens(y)) > 1)
            assert v.share(f, np.unique(at)) == pytest.approx(want)


# shared
def test_slices_and_shingles():
    batch = pa.RecordBatch.from_pydict({"text": ["ab " * 400, None, "x", "y" * 5000, ""]})
    parts = list(sliced([batch], most=1000))
    assert sum(p.num_rows for p in parts) == 5 and len(parts) > 1
    a, b, c = shingle_sets(pa.array(["A b c d e f", "a  b\tc\nd e f", None]))
    assert len(a) == 2 and a.tolist() == b.tolist() and len(c) == 0


def test_queries_have_what_the_contract_names(spark):
    from tickerloom.llm import queries

    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 11))


def test_lm_scores_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, other = ({r.doc_id: r.score for r in lmscore.text_scores(docs.repartition(n)).collect()} for n in (1, 5))
    assert one.keys() == other.keys() and all(abs(one[d] - other[d]) <= 1e-6 * abs(one[d]) for d in one)


def test_lm_learns_from_all_windows():
    """The units of the pass give every window of every training text, with its context."""
    with open(lmscore.TOKENIZER, "rb") as f:
        ranks = f.read()
    end, given = len(lmscore._blank(ranks)), lambda: None
    given.value = ranks
    texts = [" ".join(f"w{i * j % 997}" for j in range(n)) for i, n in enumerate((0, 1, 5000, 40, 9000))]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4, 5], "text": texts, "held_out": [False, False, False, True, False]})
    (chunk,) = lmscore._chunks(given, end)([batch])
    given.value = model = lmscore.Model(np.ones(end + 1), np.r_[lmscore._blank(ranks), True])
    want = [w for b in lmscore._taught(given, end, 1)([chunk]) for w in b.column("window").to_pylist()]
    got = []
    for b in lmscore._units(end, 3)([chunk]):
        for lead, ids in zip(b.column("lead").to_pylist(), b.column("ids").to_pylist()):
            ids = lmscore._unzip(ids, "<u4").astype(np.int64)
            x, target = model.windows(ids, np.array([0, len(ids)]), leads=np.array([lead]))
            assert len(x) <= lmscore.UNIT
            got += [r.tobytes() for r in np.hstack([x, model.classes(ids, target)]).astype("<i2")]
    assert len(want) > 3 * lmscore.UNIT and sorted(got) == sorted(want)


def test_lm_counts_by_parts_are_those_of_dictionaries():
    """Keys of several chunks, packed by ranges of hashes, against counting them one by one; packed they take few bytes."""
    with open(lmscore.TOKENIZER, "rb") as f:
        ranks = f.read()
    given, rng = lambda: None, random.Random(4)
    given.value, stock, rows = ranks, prose(rng, 3000), []
    for c in range(3):
        texts = [" ".join(rng.choice(stock) for _ in range(rng.randint(0, 400))) for _ in range(60)] + [" ".join(prose(rng, 5))] * 3
        batch = pa.RecordBatch.from_pydict({"doc_id": list(range(63)), "text": texts, "held_out": [i % 3 == c for i in range(63)]})
        rows += [{"chunk": c} | r for r in next(lmscore._chunks(given, len(lmscore._blank(ranks)))([batch])).to_pylist()]
    chunks = pa.RecordBatch.from_pylist(rows)
    asked = [r for b in lmscore._asked([chunks]) for r in b.to_pylist()]
    assert [r["n_keys"] for r in rows] == [sum(r["chunk"] == c for r in asked) for c in range(3)]
    count, mass, types = collections.Counter(), collections.Counter(), collections.Counter()
    for r in asked:
        count[r["kind"], r["key"]] += r["n"]
    for (kind, _), n in count.items():
        if kind >= 0 and n:
            mass[kind], types[kind] = mass[kind] + n, types[kind] + 1
    dealt = pa.Table.from_batches(lmscore._dealt(4)([chunks]))
    assert len(dealt) == 12 and sum(len(r[c]) for r in dealt.to_pylist() for c in ("keys", "places", "kinds", "counts")) < 14 * len(asked)
    got, found = {}, []
    for part in range(4):
        for r in lmscore._counted(dealt.filter(pa.compute.equal(dealt.column("part"), part))).to_pylist():
            if r["chunk"] is None:
                found += zip(r["kinds"], r["types"], r["masses"])
            else:
                got |= {(r["chunk"], p): t for p, t in zip(lmscore._unzip(r["places"], "<i4").tolist(), lmscore._unzip(r["totals"], "<i8").tolist())}
    assert got == {(r["chunk"], r["place"]): count[r["kind"], r["key"]] for r in asked if count[r["kind"], r["key"]] != r["n"]}
    for want, at in ((types, 1), (mass, 2)):
        total = collections.Counter()
        for f in found:
            total[f[0]] += f[at]
        assert total == want


def test_lm_gradient_is_that_of_the_halves_and_their_classes(monkeypatch):
    """Against differences of the cross-entropy in plain sums, also where powers leave the range of floats; a place costs the classes of its half only."""
    rng = np.random.default_rng(5)
    model = lm_model(np.r_[rng.integers(0, 50, 700).astype(float), 5], np.r_[rng.random(700) < 0.5, True])
    model.p["gate"] += rng.standard_normal(len(model.p["gate"])).astype(np.float32) * 0.3
    ids = rng.integers(0, 701, 200)
    x, target = model.windows(ids, np.array([0, 45, 46, 200]))
    y = model.classes(ids, target)
    size, powers = [], lmscore._powers
    monkeypatch.setattr(lmscore, "_powers", lambda f: [got := powers(f), size.append(got[0].size)][0])

    def loss():
        h = model.forward(x)[0].astype(float)
        at = np.flatnonzero(y.ravel() >= 0)
        k, begins = y.ravel()[at], y.ravel()[at] < lmscore.HALVES[1].start
        logits = h[at] @ model.p["out"].astype(float)
        logits[(np.arange(lmscore.CLASSES) < lmscore.HALVES[1].start) != begins[:, None]] = -np.inf
        top = logits.max(1)
        g = h[at] @ model.p["gate"].astype(float)
        return np.mean(np.logaddexp(0, np.where(begins, -g, g)) + top + np.log(np.exp(logits - top[:, None]).sum(1)) - logits[np.arange(len(at)), k])

    for far in (0.0, 200.0):  # added to all classes alike, which changes no probability
        model.p["out"][-1] += np.float32(far)
        size.clear()
        grad = model.gradient(x, y)
        assert sum(size) <= x.shape[0] * lmscore.STRIDE * (x.shape[1] + max(h.stop - h.start for h in lmscore.HALVES))
        for name, a in model.p.items():
            for at in np.argsort(-np.abs(grad[name]).ravel())[:4]:
                was, found = a.flat[at], []
                for step in (0.02, -0.02):
                    a.flat[at] = was + np.float32(step)
                    found.append(loss())
                a.flat[at] = was
                assert grad[name].flat[at] == pytest.approx((found[0] - found[1]) / 0.04, rel=0.03, abs=3e-4), name


def test_lm_words_are_joined_alike_in_short_and_long_texts(monkeypatch):
    """By their bytes' places, and one by one where a text is long; a blank before each, and the same ids as word by word."""
    with open(lmscore.TOKENIZER, "rb") as f:
        ranks = f.read()
    w = lmscore.Words(pa.array(["One é日本 two", None, "x" * 300 + "\u00a0y\tZ"]))
    at, want = np.array([4, 0, 3, 1, 2]), ["z", "one", "x" * 300 + "\u00a0y", "é日本", "two"]
    for most in (lmscore.CHUNK_BYTES, 1):
        monkeypatch.setattr(lmscore, "CHUNK_BYTES", most)
        assert lmscore.joined(w, at) == "".join(" " + x for x in want) and lmscore.joined(w, at[:0]) == ""
        ids, lens = lmscore.subwords(lmscore.joined(w, at), ranks, len(at))
        assert [x.tolist() for x in np.split(ids, np.cumsum(lens)[:-1])] == [lmscore.encoder(ranks).encode_ordinary(" " + x) for x in want]


def test_lm_steps_are_those_of_plain_adam_and_take_no_new_memory():
    """Against Adam as it is written down, over more steps than the sums of gradients are scaled by; a step's large arrays are there before it."""
    import tracemalloc

    rng = np.random.default_rng(6)
    model = lm_model(np.r_[rng.integers(0, 50, 1500).astype(float), 5], np.r_[rng.random(1500) < 0.5, True])
    ids = rng.integers(0, 1501, 128 * lmscore.STRIDE)
    x, target = model.windows(ids, np.array([0, len(ids)]))
    y = model.classes(ids, target)
    tables, was = lmscore.Tables(model.p), {k: a.copy() for k, a in model.p.items()}
    m, v = ({k: np.zeros(a.shape) for k, a in was.items()} for _ in range(2))
    for n in range(1, 151):
        some = rng.permutation(len(x))[: 128 if n == 1 else 5]  # of few windows, so most rows are not seen
        for k, g in model.gradient(x[some], y[some]).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g.astype(float) ** 2
            model.p[k] = (model.p[k] - 0.002 * m[k] / (1 - 0.9**n) / (np.sqrt(v[k] / (1 - 0.99**n)) + 1e-8)).astype(np.float32)
        tables.step(x[some], y[some], 0.002)
    for k, a in model.p.items():
        assert np.abs(a - was[k]).max() > 0.01 and np.abs(tables.p[k] - a).max() < 0.02 * np.abs(a - was[k]).max(), k
    tracemalloc.start()
    tables.step(x, y, 0.002)
    assert tracemalloc.get_traced_memory()[1] < 1_200_000
    tracemalloc.stop()


def test_lm_windows_are_those_of_plain_loops():
    rng = np.random.default_rng(8)
    model = lm_model(np.r_[rng.integers(0, 50, 700).astype(float), 5], np.r_[rng.random(700) < 0.5, True])
    ids, starts, leads = rng.integers(0, 701, 120), np.array([0, 1, 3, 40, 41, 65, 120]), np.array([0, 0, 5, 0, 5, 0])
    x, target = model.windows(ids, starts, leads=leads)
    want = []
    for a, b, lead in zip(starts, starts[1:], leads):
        for begin in range(a + lead, b, lmscore.STRIDE):
            places = range(begin - lmscore.CONTEXT - 1, begin + lmscore.STRIDE - 1)
            want.append(([model.input_of[ids[p]] if a <= p < b else model.input_of[-1] for p in places], [p if p < b else -1 for p in range(begin, begin + lmscore.STRIDE)]))
    assert [(r.tolist(), t.tolist()) for r, t in zip(x, target)] == [([int(c) for c in r], [int(p) for p in t]) for r, t in want]
    assert model.classes(ids, target).tolist() == [[int(model.class_of[ids[p]]) if p >= 0 else -1 for p in t] for _, t in want]
