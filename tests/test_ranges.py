"""Order within ranges, against plain Python."""

from __future__ import annotations

import math
import random
import statistics

import pytest

from tickerloom.operators import ranges as R
from tickerloom.operators import table as O


@pytest.mark.parametrize("few, accuracy", [(10_000, 10_000), (3, 20), (1, 50)])
def test_medians_are_exact(spark, monkeypatch, few, accuracy):
    """Even and odd numbers of values, ties, a value that most rows share, extremes, nulls; also where nothing is few."""
    monkeypatch.setattr(R, "FEW", few)
    monkeypatch.setattr(R, "ACCURACY", accuracy)
    rng = random.Random(few)
    odd = [rng.gauss(0, 1e6) for _ in range(2001)]
    even = [*(rng.randint(0, 50) for _ in range(2000)), None]
    hot = [7.0] * 1000 + [rng.random() for _ in range(1001)]  # the middle lies at the edge of a run
    two = [1.0] * 1000 + [2.0] * 1000 + [None]
    ends = [float("-inf")] * 990 + [rng.random() for _ in range(21)] + [float("inf")] * 990
    for column in (odd, even, hot, two, ends):
        rng.shuffle(column)
    rows = list(zip(odd, map(lambda x: None if x is None else float(x), even), hot, two, ends, [None] * 2001))
    names = ["odd", "even", "hot", "two", "ends", "none"]
    got = R.exact_medians(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5), names)
    want = {n: statistics.median([x for x in c if x is not None]) for n, c in zip(names, zip(*rows)) if n != "none"}
    assert got == want | {"none": None}


def test_medians_of_odd_tables(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 5.0), (None, float("nan"))], "a int, b double")
    got = R.exact_medians(df, ["a", "b"])
    assert got["a"] == 1.5 and math.isnan(got["b"])
    assert R.exact_medians(df.limit(0), ["a"]) == {"a": None}
    filled = O.impute_median(df.select("a"), ["a"]).collect()
    assert sorted(r.a for r in filled) == [1, 1, 2]


def test_values_are_carried_over_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, None, None, f"x{i}"]), rng.choice([None, i])) for i in range(600)]
    rows += [("late", 10_000, None, None), ("c", None, "first", 1), ("c", 5, None, None)]
    got = {(r.k, r.i): (r.u, r.v) for r in O.impute_ffill(spark.createDataFrame(rows, "k string, i int, u string, v int").repartition(7), ["u", "v"], ["k"], ["i"]).collect()}
    last, want = {}, {}
    for k, i, u, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        held = last.get(k, (None, None))
        last[k] = want[k, i] = (held[0] if u is None else u, held[1] if v is None else v)
    assert got == want


def test_ascending_over_ranges(spark):
    up = [("up", i, i // 3) for i in range(300)]
    seam = [("seam", i, i if i < 150 else i - 150) for i in range(300)]  # falls once only, wherever ranges are cut
    df = spark.createDataFrame([*up, *seam, ("one", 1, 1)], "k string, i int, v int").repartition(6)
    assert {r.k: r.ordered for r in R.ascending(df, "v", ["k"], ["i"]).collect()} == {"up": True, "seam": False, "one": True}
