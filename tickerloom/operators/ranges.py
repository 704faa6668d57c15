"""Order within ranges: exact medians by selection, and values carried forward, without a task that gets all rows of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FEW = 10_000  # values of a column among which a median is picked directly
ACCURACY = 10_000  # of the sketches that bound a median


def range_of(df: DataFrame, column: str) -> Column:
    """A number from 0 by which df's rows are cut into ranges of a number or date column, at sampled quantiles; nulls are in range 0."""
    kind = dict(df.dtypes)[column]
    value = F.unix_date(F.col(column)).cast("double") if kind == "date" else F.col(column).cast("double")
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = df.select(value.alias("x")).stat.approxQuantile("x", [i / n for i in range(1, n)], 0.001) if n > 1 else []
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(float(b)) for b in sorted(set(bounds))]), lambda b: F.coalesce(value, F.lit(float("-inf"))) > b))


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """The exact median of each number column, nulls left out; None without values. NaN is above all numbers.

    A median is selected: a sketch bounds it, one pass counts what lies below and within the bounds, and what lies within
    goes on until FEW values or one value are left. So no state is larger than a sketch or FEW values, whatever the number
    of distinct values. Each round reads the columns twice and leaves about 4 / ACCURACY of the rows: two or three rounds at
    any size. A value that very many rows share ends a column's search, or leaves its range.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    sizes = values.agg(*[F.count(c).alias(c) for c in columns]).first()
    middle = {c: ((sizes[c] - 1) // 2, sizes[c] // 2) for c in columns if sizes[c]}
    # Of each rank that is open: the bounds of its value, the values below the lower one, the values within.
    spans = {(c, rank): (None, None, 0, sizes[c]) for c, ranks in middle.items() for rank in ranks}
    found: dict[tuple[str, int], float] = {}

    def within(key: tuple[str, int]) -> Column:
        (c, _), (lo, hi, *_) = key, spans[key]
        return F.when((F.lit(True) if lo is None else F.col(c) >= F.lit(lo)) & (F.lit(True) if hi is None else F.col(c) <= F.lit(hi)), F.col(c))

    def share(key: tuple[str, int], slack: float) -> float:
        return min(1.0, max(0.0, (key[1] - spans[key][2]) / spans[key][3] + slack))

    while spans:
        few, many = [k for k, s in spans.items() if s[3] <= FEW], [k for k, s in spans.items() if s[3] > FEW]
        if few:
            for k, got in zip(few, values.agg(*[F.sort_array(F.collect_list(within(k))) for k in few]).first()):
                found[k] = got[k[1] - spans.pop(k)[2]]
        if not many:
            break
        sketch = values.agg(*[F.percentile_approx(within(k), [share(k, -2 / ACCURACY), share(k, 2 / ACCURACY)], ACCURACY) for k in many]).first()
        counts = []
        for k, bounds in zip(many, sketch):
            (a, b), v = (F.lit(float(x)) for x in bounds), within(k)
            counts.append(
                F.struct(
                    F.count_if(v < a).alias("under_a"), F.count_if(v <= a).alias("upto_a"), F.count_if(v < b).alias("under_b"), F.count_if(v <= b).alias("upto_b"),
                    F.min(F.when(v > a, v)).alias("above_a"), F.max(F.when(v < a, v)).alias("below_a"), F.min(F.when(v > b, v)).alias("above_b"), F.max(F.when(v < b, v)).alias("below_b"),
                )
            )
        for k, (a, b), n in zip(many, sketch, values.agg(*counts).first()):
            lo, hi, below, m = spans[k]
            at = k[1] - below
            if n.under_a <= at < n.upto_a or n.under_b <= at < n.upto_b:
                found[k] = a if at < n.upto_a else b
                del spans[k]
            elif at < n.under_a:  # a sketch may miss by a little
                spans[k] = (lo, n.below_a, below, n.under_a)
            elif at < n.under_b:
                spans[k] = (n.above_a, n.below_b, below + n.upto_a, n.under_b - n.upto_a)
            else:
                spans[k] = (n.above_b, hi, below + n.upto_b, m - n.upto_b)
    return {c: (found[c, middle[c][0]] + found[c, middle[c][1]]) / 2 if c in middle else None for c in columns}


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def carried_forward(df: DataFrame, columns: list[str], by: list[str], order: list[str]) -> DataFrame:
    """The last value that isn't null in place of nulls, in `order` within `by`.

    Rows are cut into ranges of the order's first column, a number or a date. Each key's range carries its own values; what
    it starts with comes from one row for each of the key's ranges. So a key with very many rows is spread over all tasks.
    Rows that tie in `order` must not differ in what they carry.
    """
    ranged = df.withColumn("_range", range_of(df, order[0]))
    at = F.struct(*order)
    ends = ranged.groupBy(*by, "_range").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])
    before = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # a row for each range
    starts = ends.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_range").alias("_r"), *[F.last(c, ignorenulls=True).over(before).alias(f"_start{i}") for i, c in enumerate(columns)])
    inside = W.partitionBy(*by, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    out = ranged.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(by):
        same = same & _same(c, f"_by{i}")
    out = out.join(starts, same)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_start{i}")) for i, c in enumerate(columns)}).select(*df.columns)


def ascending(df: DataFrame, value: str, by: list[str], order: list[str]) -> DataFrame:
    """by, ordered: whether no row's value is below that of the row before, in `order` within `by`; by ranges as above."""
    ranged = df.select(*by, *{*order, value}, range_of(df, order[0]).alias("_range"))
    prior = F.lag(value).over(W.partitionBy(*by, "_range").orderBy(*order))
    at = F.struct(*order)
    parts = ranged.withColumn("_prior", prior).groupBy(*by, "_range").agg(
        F.count_if(F.col(value) < F.col("_prior")).alias("_falls"), F.min(F.struct(at.alias("o"), F.col(value).alias("v")))["v"].alias("_first"), F.max(F.struct(at.alias("o"), F.col(value).alias("v")))["v"].alias("_last")
    )
    seam = F.col("_first") < F.lag("_last").over(W.partitionBy(*by).orderBy("_range"))  # a row for each range
    return parts.withColumn("_seam", seam).groupBy(*by).agg(((F.sum("_falls") + F.count_if("_seam")) == 0).alias("ordered"))
