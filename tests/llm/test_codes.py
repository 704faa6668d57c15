"""Product codes against plain loops over Python's integers; GNAT searches against all distances."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tickerloom.llm import codes as C


@pytest.mark.parametrize("n,d,span", [(1, 3, 5), (30, 2, 3), (256, 16, 900), (256, 4, 6), (300, 1, 40), (200, 8, 1 << 30)])
def test_gnat_finds_the_lowest_of_the_nearest(n, d, span):
    """Few distinct places give many ties; a wide span takes whole numbers of any size."""
    rng = np.random.default_rng(n + d)
    kind = object if span > C._SAFE else np.int64
    points, queries = (rng.integers(-span, span + 1, (k, d)).astype(kind) for k in (n, 60 if kind is object else 700))
    queries[: min(n, 20)] = points[: min(n, 20)]
    square, index, _ = C.Gnat(points, splits=5, leaf=6).nearest(queries)
    far = [[sum((int(a) - int(b)) ** 2 for a, b in zip(q, p)) for p in points] for q in queries]
    assert index.tolist() == [min(range(n), key=lambda i: (f[i], i)) for f in far]
    assert [int(s) for s in square] == [min(f) for f in far]


def test_gnat_leaves_subtrees_out():
    rng = np.random.default_rng(5)
    points = (rng.integers(0, 40, (16, 8)) * 1000)[rng.integers(0, 16, 256)] + rng.integers(0, 30, (256, 8))
    queries = points[rng.integers(0, 256, 500)] + rng.integers(0, 9, (500, 8))
    assert C.Gnat(points).nearest(queries)[2] < 0.5 * 500 * 256


def test_roots_are_bounds():
    x = np.array([0, 1, 2, 3, 4, 24, 25, 26, (1 << 50) - 1, 1 << 50, (1 << 26) ** 2 - 1, (1 << 31) ** 2, (1 << 31) ** 2 - 1])
    assert C.root_down(x).tolist() == [math.isqrt(int(v)) for v in x]


def brute(rows: list[tuple], entries: int = 256, rounds: int = 4, parts: int = 4) -> list[tuple]:
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    kept = [(i, [math.floor(1024 * c) for c in v], lab) for i, v, lab in kept if len(v) == width]
    cuts = [sum(width // parts + (i < width % parts) for i in range(p)) for p in range(parts + 1)]
    book = [[v[a:b] for _, v, _ in kept[:entries]] for a, b in zip(cuts, cuts[1:])]
    near = lambda p, v: min((sum((x - y) ** 2 for x, y in zip(e, v)), i) for i, e in enumerate(book[p]))
    for _ in range(rounds):
        for p in range(parts):
            groups: dict = {}
            for _, v, _ in kept:
                x = v[cuts[p] : cuts[p + 1]]
                groups.setdefault(near(p, x)[1], []).append(x)
            book[p] = [[sum(c) // len(c) for c in zip(*groups[e])] if e in groups else old for e, old in enumerate(book[p])]
    sha = hashlib.sha256(",".join(str(c) for p in book for e in p for c in e).encode()).hexdigest()
    found = [(i, [near(p, v[cuts[p] : cuts[p + 1]]) for p in range(parts)], lab) for i, v, lab in kept]
    total: dict = {}
    for _, f, lab in found:
        total[lab] = total.get(lab, 0) + sum(d for d, _ in f)
    return [(i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), total[lab], sha) for i, f, lab in found]


SCHEMA = "vec_id long, embedding array<float>, label int, vector string, key string, error string"


def rows_of(n: int, width: int, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    out = [(int(i), [float(np.float32(c)) for c in rng.normal(0, 0.2, width).round(2)], None if i % 5 == 0 else int(i % 3)) for i in rng.permutation(n)]
    nan, inf = float("nan"), float("inf")
    return out + [(5, out[3][1], 1), (7, None, 1), (8, [None] * width, 2), (9, [nan] * width, 2), (10, [-inf] + [0.0] * (width - 1), 2), out[0], (None, out[1][1], None)]


@pytest.mark.parametrize("n,width,entries", [(90, 8, 20), (60, 10, 256), (40, 3, 7)])
def test_codes_against_plain_loops(spark, n, width, entries):
    """Null, NaN and infinite vectors, ties, repeated and null ids, null labels, odd widths, few vectors, clashing names."""
    rows = [*rows_of(n, width), (1000, [0.5] * (width + 1), 1)]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(3)
    assert sorted(map(tuple, C.product_codes(df, entries=entries).collect()), key=str) == sorted(brute(rows, entries), key=str)


def test_huge_components_and_empty_tables(spark):
    rows = [(i, [1e4 * i, -3e12 * i, 2.0, 1e9 + i], i % 2) for i in range(12)]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA.replace("float", "double"))
    want = [(i, c, e if e < 1 << 63 else None) for i, c, e, _, _ in brute(rows, 5)]
    assert sorted((r.vec_id, r.code, r.error) for r in C.product_codes(df, entries=5).collect()) == sorted(want, key=lambda r: r[0])
    assert C.product_codes(df.limit(0)).count() == 0
    assert [r.code for r in C.product_codes(spark.createDataFrame([(1, [], 1, "a", "b", "c"), (2, [], None, "a", "b", "c")], SCHEMA)).collect()] == ["00000000"] * 2
