"""Measures of predictions, columns and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.operators.ranges import exact_medians
from tickerloom.operators.staging import staged


def guarded_corr(a: str, b: str) -> Column:
    """Pearson's correlation; null where a column is constant."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    return F.try_divide(F.covar_pop(x, y), F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0)))


def auc(preds: DataFrame, by: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve, ties counting half; null without both classes.

    Rows meet by score first, and those sums are staged: preds is evaluated once. Distinct scores are summed up within ranges
    of scores, cut at sampled quantiles, from where the ranges before end: so no task gets all scores of a key.
    """
    n = max(1, int(preds.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ties = staged(preds.groupBy(*by, score).agg(F.sum(F.col(label).cast("double")).alias("p"), F.sum(1.0 - F.col(label)).alias("n")), "auc-ties")
    bounds = sorted(set(ties.stat.approxQuantile(score, [i / n for i in range(1, n)], 0.01))) if n > 1 else []
    cut = F.size(F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: F.col(score) > b)) if bounds else F.lit(0)
    ties = ties.withColumn("_range", cut)
    before = lambda keys, at: W.partitionBy(*keys).orderBy(at).rowsBetween(W.unboundedPreceding, -1)
    sums = ties.groupBy(*by, "_range").agg(F.sum("n").alias("_n"))
    sums = sums.select(*by, "_range", F.coalesce(F.sum("_n").over(before(by, "_range")), F.lit(0.0)).alias("_base"))
    inside = F.coalesce(F.sum("n").over(before([*by, "_range"], score)), F.lit(0.0))
    ties = ties.withColumn("_inside", inside).join(sums, [*by, "_range"]).withColumn("below", F.col("_base") + F.col("_inside"))
    return ties.groupBy(*by).agg(F.try_divide(F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)), F.nullif(F.sum("p") * F.sum("n"), F.lit(0.0))).alias("auc"))


def accuracy(preds: DataFrame, by: list[str], score: str = "score", label: str = "label") -> DataFrame:
    return preds.groupBy(*by).agg(F.avg(((F.col(score) > 0.5).cast("int") == F.col(label)).cast("double")).alias("accuracy"))


def long_form(df: DataFrame, columns: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """feature, value: a row for each of the columns, as doubles."""
    return df.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])).alias("x")).select(*keys, "x.feature", "x.value")


def median_of(medians: dict[str, float | None]) -> Column:
    """The median of the row's feature."""
    found = F.lit(None).cast("double")
    for name, m in medians.items():
        found = F.when(F.col("feature") == name, F.lit(m).cast("double")).otherwise(found)
    return found


def baseline_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """feature, rows, null_share, mean, std, min, max, median (exact, selected by ranges)."""
    v, mid = F.col("value"), median_of(exact_medians(df, columns))
    return long_form(df, columns).groupBy("feature").agg(F.count("*").alias("rows"), F.avg(v.isNull().cast("double")).alias("null_share"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")).withColumn("median", mid)


def drift(baseline: DataFrame, current: DataFrame, limit: float = 0.1) -> DataFrame:
    """feature, drift, drifted: how far the mean moved in deviations of the baseline profile."""
    b = baseline.select("feature", F.col("mean").alias("base_mean"), F.col("std").alias("base_std"))
    d = F.try_divide(F.abs(F.col("mean") - F.col("base_mean")), F.nullif(F.col("base_std"), F.lit(0.0)))
    return current.join(b, "feature").select("feature", F.coalesce(d, F.lit(0.0)).alias("drift")).withColumn("drifted", F.col("drift") > limit)
