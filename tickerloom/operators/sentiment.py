"""Sentiment of posts by time buckets, days and trailing windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.functions.text import clip, engagement

SHARES = ("sentiment_positive", "sentiment_negative", "sentiment_neutral", "sentiment_confidence")
KEYS = ("symbol", "date")


def with_date(posts: DataFrame) -> DataFrame:
    return posts.withColumn("date", F.to_date("created_at"))


def bucket_means(posts: DataFrame, minutes: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Of each key, the mean over its buckets of (positive - negative) * confidence of the buckets' means, clipped.

    Buckets with a null mean, or a mean confidence of 0 or less, don't count. Only sums and counts move in the shuffle.
    """
    width = F.window("created_at", f"{minutes} minutes")
    means = with_date(posts).groupBy(*keys, width.alias("bucket")).agg(*[F.avg(c).alias(c) for c in SHARES])
    good = means.dropna(subset=list(SHARES)).where("sentiment_confidence > 0")
    value = (F.col("sentiment_positive") - F.col("sentiment_negative")) * F.col("sentiment_confidence")
    return good.groupBy(*keys).agg(clip(F.avg(value), -1.0, 1.0).alias(f"sent_{minutes}m"))


def weighted(posts: DataFrame, weight: Column, name: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Of each key, the weighted mean of positive - negative, clipped; 0 without weight."""
    kept = with_date(posts).withColumn("w", weight)
    mean = F.try_divide(F.sum((F.col("sentiment_positive") - F.col("sentiment_negative")) * F.col("w")), F.nullif(F.sum("w"), F.lit(0.0)))
    return kept.groupBy(*keys).agg(F.coalesce(clip(mean, -1.0, 1.0), F.lit(0.0)).alias(name))


def post_weight(posts: DataFrame) -> Column:
    """engagement_score, else retweets + likes + 1, else confidence: by the columns that there are."""
    if "engagement_score" in posts.columns:
        return F.col("engagement_score")
    if {"retweet_count", "like_count"} <= set(posts.columns):
        return (F.col("retweet_count") + F.col("like_count") + 1).cast("double")
    return F.col("sentiment_confidence")


def daily(posts: DataFrame) -> DataFrame:
    return weighted(posts, post_weight(posts), "sent_daily")


def volatility(posts: DataFrame) -> DataFrame:
    """Half the population deviation of the posts' confident sentiment, 1 at most; 0 for fewer than two."""
    value = (F.col("sentiment_positive") - F.col("sentiment_negative")) * F.col("sentiment_confidence")
    spread = F.when(F.count(value) < 2, 0.0).otherwise(F.least(F.stddev_pop(value) / 2, F.lit(1.0)))
    return with_date(posts).groupBy(*KEYS).agg(spread.alias("volatility"))


def momentum(posts: DataFrame, hours: int = 4) -> DataFrame:
    """Last minus second last trailing mean of the day: each over (t - hours, t], weighted by confidence; 0 for one post."""
    rows = with_date(posts).where("sentiment_confidence is not null").withColumn("at", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', created_at)"))
    back = F.row_number().over(W.partitionBy(*KEYS).orderBy(F.desc("at"), F.desc("tweet_id")))
    last = rows.select(*KEYS, "at", "tweet_id").withColumn("back", back).where("back <= 2")  # each task hands on two rows of a key
    ends = last.groupBy(*KEYS).agg(*[F.max(F.when(F.col("back") == k, F.col("at"))).alias(f"end{k}") for k in (1, 2)])
    c = F.col("sentiment_confidence")
    within = lambda k: (F.col("at") > F.col(f"end{k}") - hours * 3_600_000_000) & (F.col("at") <= F.col(f"end{k}"))
    sums = [F.sum(F.when(within(k), x)).alias(f"{n}{k}") for k in (1, 2) for n, x in (("x", (F.col("sentiment_positive") - F.col("sentiment_negative")) * c), ("c", c))]
    ends = ends.withColumnsRenamed({k: f"_{k}" for k in KEYS})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    near = F.coalesce(F.col("at") > F.coalesce("end2", "end1") - hours * 3_600_000_000, F.lit(True))
    both = rows.join(ends, same).where(near).groupBy(*KEYS).agg(F.max("end2").alias("end2"), *sums)
    mean = lambda k: F.coalesce(F.try_divide(f"x{k}", F.nullif(f"c{k}", F.lit(0.0))), F.lit(0.0))
    step = F.when(F.col("end2").isNotNull(), clip(mean(1) - mean(2), -1.0, 1.0))
    return both.select(*KEYS, F.coalesce(step, F.lit(0.0)).alias("momentum"))


def rolled(posts: DataFrame) -> DataFrame:
    """sent_5m, sent_10m, sent_60m (as by bucket_means) and sent_daily (as by daily) of each symbol and day, in one pass.

    Posts are summed and counted by five minutes once; the longer buckets and the day add those sums.
    """
    epoch = "TIMESTAMP_NTZ '1970-01-01 00:00:00'" if dict(posts.dtypes)["created_at"] == "timestamp_ntz" else "TIMESTAMP_LTZ '1970-01-01 00:00:00 UTC'"
    w = post_weight(posts)
    sums = {f"s{i}": F.sum(c) for i, c in enumerate(SHARES)} | {f"n{i}": F.count(c) for i, c in enumerate(SHARES)} | {"wx": F.sum((F.col("sentiment_positive") - F.col("sentiment_negative")) * w), "w": F.sum(w)}
    five = with_date(posts).groupBy(*KEYS, F.floor(F.expr(f"timestampdiff(MINUTE, {epoch}, created_at)") / 5).alias("at")).agg(*[x.alias(c) for c, x in sums.items()])
    levels = five.withColumn("m", F.explode(F.array(F.lit(1), F.lit(2), F.lit(12)))).groupBy(*KEYS, "m", F.floor(F.col("at") / F.col("m")).alias("at")).agg(*[F.sum(c).alias(c) for c in sums])
    p, n, u, c = (F.try_divide(f"s{i}", F.nullif(F.col(f"n{i}"), F.lit(0))) for i in range(4))
    value = F.when(p.isNotNull() & n.isNotNull() & u.isNotNull() & (c > 0), (p - n) * c)
    means = [clip(F.avg(F.when(F.col("m") == k, value)), -1.0, 1.0).alias(f"sent_{5 * k}m") for k in (1, 2, 12)]
    once = lambda x: F.sum(F.when(F.col("m") == 1, F.col(x)))
    day = F.coalesce(clip(F.try_divide(once("wx"), F.nullif(once("w"), F.lit(0.0))), -1.0, 1.0), F.lit(0.0))
    return levels.groupBy(*KEYS).agg(*means, day.alias("sent_daily"))


def summary(posts: DataFrame) -> DataFrame:
    """All of the above for each symbol and day, with the number of posts and their mean confidence; nothing found is 0."""
    value = (F.col("sentiment_positive") - F.col("sentiment_negative")) * F.col("sentiment_confidence")
    spread = F.when(F.count(value) < 2, 0.0).otherwise(F.least(F.stddev_pop(value) / 2, F.lit(1.0)))
    out = with_date(posts).groupBy(*KEYS).agg(F.count("*").alias("tweet_count"), F.coalesce(F.avg("sentiment_confidence"), F.lit(0.0)).alias("avg_confidence"), spread.alias("volatility"))
    return out.join(rolled(posts), list(KEYS), "left").join(momentum(posts), list(KEYS), "left").fillna(0.0)


def features_with_sentiment(features: DataFrame, posts: DataFrame) -> DataFrame:
    """Features by symbol and date with four sent_ columns, 0 where there are no posts."""
    return features.join(rolled(posts), list(KEYS), "left").fillna(0.0, ["sent_5m", "sent_10m", "sent_60m", "sent_daily"])


def sentiment_features(posts: DataFrame, dates: DataFrame) -> DataFrame:
    """The four sent_ columns of every symbol on every one of some days (few rows), 0 where there are no posts."""
    return features_with_sentiment(posts.select("symbol").distinct().crossJoin(F.broadcast(dates)), posts)


def with_engagement(posts: DataFrame) -> DataFrame:
    return posts.withColumn("engagement_score", engagement(F.col("retweet_count"), F.col("quote_count"), F.col("reply_count"), F.col("like_count")))
