"""The Merkle manifest against hashlib."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from tickerloom.llm import merkle
from tickerloom.llm.merkle import FIELDS


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row: dict) -> str:
    return sha(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS])


def levels(nodes: list[str], arity: int) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def brute(rows: list[dict], arity: int) -> list[tuple]:
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r)))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: levels([brute_leaf(r) for r in groups[g]], arity) for g in names}
    top = levels([trees[g][-1][0] for g in names], arity)
    out = []
    for i, g in enumerate(names):
        for j, r in enumerate(groups[g]):
            touched = r["doc_id"] is not None and r["n_chars"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            now, siblings = brute_leaf(r | {"n_chars": r["n_chars"] + 1} if touched else r), []
            for tree, at in ((trees[g], j), (top, i)):
                for nodes in tree[:-1]:
                    first = at - at % arity
                    run = list(nodes[first : first + arity])
                    siblings += run[: at - first] + run[at - first + 1 :]
                    run[at - first] = now
                    now, at = sha(*run), at // arity
            root = top[-1][0]
            out.append((r["doc_id"], brute_leaf(r), trees[g][-1][0], root, sha(*siblings), now, now == root))
    return out


def test_states_resume_where_they_were_left():
    texts = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(50)]
    digests = np.array([[int(t[8 * w : 8 * w + 8], 16) for t in texts] for w in range(8)], np.uint32)
    state = merkle.absorbed(merkle.fresh(50), digests)
    assert bytes(merkle.raw(merkle.finished(state, np.full(50, 1)))[7]).hex() == sha(texts[7])
    state = merkle.absorbed(state, digests[:, ::-1])
    assert [bytes(x).hex() for x in merkle.raw(merkle.finished(state, np.full(50, 2)))] == [sha(a, b) for a, b in zip(texts, texts[::-1])]


LANGS = [None, "", "en", "é", "zz", "=x"]


@pytest.mark.parametrize("arity,depth,n", [(2, 2, 230), (3, 2, 240), (2, 10, 90), (2, 1, 40)])
def test_folds_against_brute_force(spark, arity, depth, n):
    """Several passes of chunks, hot and lone groups, nulls, repeated ids and rows, long and empty texts, clashing names."""
    rng = np.random.default_rng(n)
    rows = [{"doc_id": int(i), "source": None if i % 9 == 0 else f"s{i % 4}", "lang": LANGS[2] if i % 3 else LANGS[int(rng.integers(6))], "n_chars": None if i % 11 == 0 else int(i * 7), "text": [None, "", "x" * 70_000, f"tëxt {i}"][min(3, i % 17)]} for i in range(n)]
    rows += [rows[5], rows[5], rows[8] | {"text": "other"}, rows[1] | {"doc_id": None}, rows[2] | {"doc_id": None}, rows[3] | {"lang": "lone"}]
    names = "doc_id long, source string, lang string, n_chars long, text string, key string, digest string, chunk string, idx string, n string"
    docs = spark.createDataFrame([(*r.values(), *"abcde") for r in rows], names).repartition(5)
    got = [tuple(r) for r in merkle.tamper_check(docs, arity, depth).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, arity), key=str)
    assert {x[-1] for x in got} == {True, False}


def test_empty_and_single(spark):
    names = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.tamper_check(spark.createDataFrame([], names)).count() == 0
    row = dict(zip(FIELDS, (7, None, None, 3, None)))
    docs = spark.createDataFrame([(7, None, None, 3, None)], "doc_id long, source string, lang string, n_chars long, text string")
    assert [tuple(r) for r in merkle.tamper_check(docs).collect()] == brute([row], 2)
