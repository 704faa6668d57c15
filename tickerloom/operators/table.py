"""Cleaning, splits, folds, trailing windows and fitted column operations on feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.operators.ranges import carried_forward, exact_medians, range_of

NUMERIC = ("double", "float", "bigint", "int", "smallint", "tinyint")


def clean_date(df: DataFrame, column: str = "date") -> DataFrame:
    """Trimmed and parsed dates; header words, blanks and what can't be parsed go."""
    text = F.trim(F.col(column))
    kept = df.where(~F.lower(text).isin("date", "", "nan"))
    return kept.withColumn(column, F.to_date(F.try_to_timestamp(F.trim(F.col(column)), F.lit("yyyy-MM-dd")))).where(F.col(column).isNotNull())


def null_shares(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Share of nulls of each column, in one pass."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]).first()
    return {c: row[c] or 0.0 for c in columns}


def drop_sparse(df: DataFrame, columns: list[str], most: float = 0.30) -> DataFrame:
    return df.drop(*[c for c, share in null_shares(df, columns).items() if share > most])


def impute_median(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Exact medians of fit_on (df by default) in place of nulls."""
    medians = exact_medians(df if fit_on is None else fit_on, columns)
    return df.fillna({c: m for c, m in medians.items() if m is not None})


def impute_ffill(df: DataFrame, columns: list[str], by: list[str], order: list[str]) -> DataFrame:
    """The last value before, in order within `by`; the order begins with a number or a date, by whose ranges rows are spread."""
    return carried_forward(df, columns, by, order)


def impute_group_mean(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    means = df.groupBy(*by).agg(*[F.avg(c).alias(f"_{c}") for c in columns])
    out = df.join(means, by, "left")
    return out.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


def drop_any_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without null in the columns; NaN counts as null."""
    kinds = dict(df.dtypes)
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull()
        if kinds[c] in ("double", "float"):
            ok = ok & ~F.isnan(c)
    return df.where(ok)


def infinite_to_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(F.abs(F.col(c)) == float("inf"), 0.0).otherwise(F.col(c)) for c in columns})


def numeric_target(df: DataFrame, column: str) -> DataFrame:
    """Rows whose target is a number, as one."""
    return df.withColumn(column, F.col(column).try_cast("double")).where(F.col(column).isNotNull())


def label_column(df: DataFrame) -> DataFrame:
    """label: the column direction where there is one, else return_1d > 0; without either, an error."""
    if "direction" in df.columns:
        return df.withColumnRenamed("direction", "label")
    if "return_1d" in df.columns:
        return df.withColumn("label", (F.col("return_1d") > 0).cast("int"))
    raise ValueError("no column to label by")


def label_first(df: DataFrame, label: str) -> DataFrame:
    return df.select(label, *[c for c in df.columns if c != label])


def select_features(df: DataFrame, exclude: tuple[str, ...]) -> DataFrame:
    return df.drop(*exclude)


def glob_match(path: Column, patterns: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for p in patterns:
        found = found | path.rlike("^" + "".join(".*" if c == "*" else "." if c == "?" else "\\" + c if c in ".^$+{}[]()|\\" else c for c in p) + "$")
    return found


#: The least or, for the spread, the bound below which each measure of a traded symbol must be.
UNIVERSE = {
    "avg_stock_vol": 1e6, "avg_option_vol": 1e3, "iv_rank_pct": 0.5, "open_interest": 1e3, "bid_ask_spread": 0.005, "atr_close_ratio": 0.01,
    "adx": 25.0, "market_cap": 2e9, "free_float": 1e7, "close": 5.0, "num_expirations": 2, "strikes_per_expiry": 5,
}


def universe(df: DataFrame, bounds: dict[str, float] | None = None, below: tuple[str, ...] = ("bid_ask_spread",)) -> DataFrame:
    """Rows that meet all bounds (UNIVERSE, with those given in place of its own); columns in `below` must be less than theirs."""
    ok = F.lit(True)
    for name, bound in (UNIVERSE | (bounds or {})).items():
        ok = ok & (F.col(name) < bound if name in below else F.col(name) >= bound)
    return df.where(ok)


def hash_mod(key: Column, k: int) -> Column:
    """A number from 0 to k - 1 by MD5 of the key as text: the same in any engine."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % k


def global_index(df: DataFrame, order: list[str]) -> DataFrame:
    """df with idx, from 0, in the order of columns that tell all rows apart.

    Rows are counted by ranges of the order's first column, cut at sampled quantiles; each range is numbered by itself
    from where the ranges before it end. So no task gets all rows, and a plan that runs twice numbers alike.
    """
    ranged = df.withColumn("_range", range_of(df, order[0]))
    sizes = ranged.groupBy("_range").count()
    before = sizes.select(F.abs("_range").alias("_r"), F.coalesce(F.sum("count").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # one row for each range
    inside = F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn("_inside", inside).join(F.broadcast(before), F.abs("_range") == F.col("_r")).withColumn("idx", F.col("_before") + F.col("_inside")).drop("_range", "_r", "_before", "_inside")


def time_split(df: DataFrame, order: list[str], train: float = 0.7, val: float = 0.15) -> DataFrame:
    """split: train, val or test by place in the order; the first two get int(n * share) rows."""
    n = df.count()
    a, b = int(n * train), int(n * train) + int(n * val)
    return global_index(df, order).withColumn("split", F.when(F.col("idx") < a, "train").when(F.col("idx") < b, "val").otherwise("test"))


def cv_folds(df: DataFrame, order: list[str], k: int = 5, leak_free: bool = False) -> DataFrame:
    """fold, part: expanding folds. Fold i trains on the first (i + 1) * (n div k) rows and validates on the next half fold.

    The last trains on all rows and validates on the last half of a fold, which it has seen; leak_free trains it on the rest.
    """
    n = df.count()
    size, idx, parts = n // k, F.col("idx"), []
    for i in range(k):
        last = i == k - 1
        end = n if last else (i + 1) * size
        lo, hi = (n - (size - size // 2), n) if last else (end, min(n, end + size // 2))
        for part, inside in (("train", idx < (lo if last and leak_free else end)), ("val", (idx >= lo) & (idx < hi))):
            parts.append(F.when(inside, F.struct(F.lit(i).alias("fold"), F.lit(part).alias("part"))))
    found = global_index(df, order).withColumn("_fold", F.explode(F.array_compact(F.array(*parts))))  # each row once, then its folds
    return found.withColumns({"fold": F.col("_fold.fold"), "part": F.col("_fold.part")}).drop("_fold")


def scale_standard(df: DataFrame, columns: list[str], fit_on: DataFrame) -> DataFrame:
    """z-scores with fit_on's means and population deviations; a constant column is only centred."""
    stats = fit_on.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).first()
    return df.withColumns({c: (F.col(c) - stats[c].m) / (stats[c].s or 1.0) for c in columns if stats[c].m is not None})


def select_variance(df: DataFrame, columns: list[str], least: float = 0.001) -> list[str]:
    """Columns of population variance above `least`; all where none is."""
    row = df.agg(*[F.var_pop(c).alias(c) for c in columns]).first()
    return [c for c in columns if (row[c] or 0) > least] or list(columns)


def numbered_by_hash(df: DataFrame, key: str, by: list[str]) -> DataFrame:
    """df with _at, from 0, by MD5 order of the key within each value of `by`, and _n, that value's rows.

    Rows are numbered within 256 hash ranges that follow one another, not in one task. Nulls in `by` are values, too.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    ranged = df.withColumn("_h", digest).withColumn("_range", F.substring(digest, 1, 2))
    each = W.partitionBy(*by)  # a row for each range
    sizes = ranged.groupBy(*by, "_range").agg(F.count("*").alias("_c"))
    sizes = sizes.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_range").alias("_r"), (F.sum("_c").over(each.orderBy("_range")) - F.col("_c")).alias("_before"), F.sum("_c").over(each).alias("_n"))
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    inside = F.row_number().over(W.partitionBy(*by, "_range").orderBy("_h", key)) - 1
    out = ranged.withColumn("_inside", inside).join(sizes, same)
    return out.withColumn("_at", F.col("_before") + F.col("_inside")).drop("_h", "_range", "_r", "_before", "_inside", *[f"_by{i}" for i in range(len(by))])


def stratified_folds(df: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """fold by MD5 order of the key within each class, so that classes are spread evenly."""
    return numbered_by_hash(df, key, [label]).withColumn("fold", (F.col("_at") % k).cast("int")).drop("_at", "_n")


def sequences(df: DataFrame, features: list[str], by: list[str], order: list[str], length: int = 10) -> DataFrame:
    """The `length` rows before each as an array of arrays; rows with fewer before them go."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(-length, -1)
    out = df.withColumn("sequence", F.collect_list(F.array(*[F.col(c).cast("double") for c in features])).over(w))
    return out.where(F.size("sequence") == length)
