"""Small cases worked out by hand, and properties."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tickerloom.functions import text as T
from tickerloom.operators import metrics as M
from tickerloom.operators import models as L
from tickerloom.operators import sentiment as S
from tickerloom.operators import table as O
from tickerloom.plans.fixtures import Tables
from tickerloom.streaming import jobs as J

POST = "tweet_id long, symbol string, created_at timestamp_ntz, sentiment_positive double, sentiment_negative double, sentiment_neutral double, sentiment_confidence double, retweet_count long, like_count long"


def posts(spark, *rows):
    at = lambda h, m=0: dt.datetime(2024, 1, 2, h, m)
    return spark.createDataFrame([(i, "S", at(h, m), p, n, 1 - p - n, c, 0, 0) for i, (h, m, p, n, c) in enumerate(rows)], POST)


def one(df, column):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][column]


def test_bucket_means(spark):
    two = posts(spark, (9, 0, 0.8, 0.2, 1.0), (9, 1, 0.6, 0.2, 0.5), (10, 0, 0.1, 0.9, 1.0), (11, 0, 0.9, 0.0, 0.0), (12, 0, 0.9, 0.0, None))
    assert one(S.bucket_means(two, 5), "sent_5m") == pytest.approx(((0.7 - 0.2) * 0.75 - 0.8) / 2)
    assert S.bucket_means(two.limit(0), 5).count() == 0


def test_momentum(spark):
    rows = posts(spark, (1, 0, 0.9, 0.1, 1.0), (5, 0, 0.5, 0.5, 1.0), (6, 0, 0.3, 0.5, 1.0))
    assert one(S.momentum(rows), "momentum") == pytest.approx((0.0 - 0.2) / 2 - 0.0)  # the first post is 4 h before the second: outside
    assert one(S.momentum(rows.limit(1)), "momentum") == 0


def test_volatility_and_daily(spark):
    rows = posts(spark, (1, 0, 0.9, 0.1, 1.0), (2, 0, 0.1, 0.9, 1.0))
    assert one(S.volatility(rows), "volatility") == pytest.approx(0.4)
    assert one(S.volatility(rows.limit(1)), "volatility") == 0
    assert one(S.daily(rows), "sent_daily") == pytest.approx(0)


def test_text_functions(spark):
    df = spark.createDataFrame([("Buy $TSLAXYZ now!  see https://x.co/a @me #Tag",)], "t string")
    r = df.select(T.clean_text(F.col("t"), True, True, True).alias("c"), T.cashtags(F.col("t")).alias("s"), T.hashtags(F.col("t")).alias("h"), T.hits(F.col("t"), T.BULLISH).alias("n")).first()
    assert (r.c, r.s, r.h, r.n) == ("Buy $TSLAXYZ now! see", ["TSLAX"], ["#tag"], 1)


@pytest.mark.parametrize(("n", "good"), [(19, False), (20, True), (280, True), (281, False)])
def test_quality_length(spark, n, good):
    text = " ".join(f"w{i}" for i in range(200))[:n]
    assert spark.createDataFrame([(text + "x" * (n - len(text)),)], "t string").select(T.is_quality(F.col("t"), F.lit(2)).alias("q")).first().q is good


def test_auc(spark):
    preds = spark.createDataFrame([("m", 0.1, 0), ("m", 0.4, 0), ("m", 0.4, 1), ("m", 0.8, 1), ("x", 0.5, 1)], "model string, score double, label int")
    got = {r.model: r.auc for r in M.auc(preds, ["model"]).collect()}
    flipped = {r.model: r.auc for r in M.auc(preds.withColumn("score", -F.col("score")), ["model"]).collect()}
    assert got == {"m": 0.875, "x": None} and got["m"] + flipped["m"] == 1


def test_guarded_corr_is_null_on_constants(spark):
    assert spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double").agg(M.guarded_corr("a", "b").alias("r")).first().r is None


def test_splits_and_folds(spark):
    t = Tables(spark, SF_DIR)
    bars = t.bars.select("symbol", "date")
    n = bars.count()
    index = O.global_index(bars, ["date", "symbol"])
    assert [r.idx for r in index.orderBy("date", "symbol").select("idx").collect()] == list(range(n))
    sizes = {r.split: r["count"] for r in O.time_split(bars, ["date", "symbol"]).groupBy("split").count().collect()}
    assert sizes == {"train": int(n * 0.7), "val": int(n * 0.15), "test": n - int(n * 0.7) - int(n * 0.15)}
    folds = O.cv_folds(bars, ["date", "symbol"], leak_free=True).groupBy("fold").agg(F.max(F.when(F.col("part") == "train", F.col("idx"))).alias("a"), F.min(F.when(F.col("part") == "val", F.col("idx"))).alias("b"))
    assert all(r.a < r.b for r in folds.collect())


def test_cleaning(spark):
    df = spark.createDataFrame([(1, " 2024-01-05 ", 1.0), (2, "date", 2.0), (3, "nan", None), (4, "x", float("nan")), (5, "2024-02-30", float("inf"))], "id int, date string, v double")
    assert [r.id for r in O.clean_date(df).collect()] == [1]
    assert {r.id for r in O.drop_any_null(df, ["v"]).collect()} == {1, 2, 5}
    assert O.infinite_to_zero(df, ["v"]).where("id = 5").first().v == 0
    assert O.drop_sparse(spark.createDataFrame([(1, None), (2, 3)], "a int, b int"), ["a", "b"]).columns == ["a"]
    with pytest.raises(ValueError, match="label"):
        O.label_column(df)


def test_scale_constant_column(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 3.0)], "c double, x double")
    assert [(r.c, r.x) for r in O.scale_standard(df, ["c", "x"], df).orderBy("x").collect()] == [(0, -1), (0, 1)]


def test_each_row_is_scored_out_of_fold_once(spark):
    df = spark.createDataFrame([(i, i % 2, float(i % 7), float(i % 2) + i / 100) for i in range(90)], "id long, label int, a double, b double")
    oof = L.out_of_fold(df, ["a", "b"], "id").groupBy("id", "model").count()
    assert oof.count() == 270 and oof.where("count <> 1").count() == 0
    assert L.fold_measures(L.out_of_fold(df, ["a", "b"], "id")).where("oof_auc > 0.9").count() >= 2


def test_stream_windows_equal_batch(spark, tmp_path):
    t = Tables(spark, SF_DIR)
    t.events.coalesce(1).sortWithinPartitions("ts").write.option("maxRecordsPerFile", 400).parquet(f"{tmp_path}/in")
    stream = J.sentiment_windows(J.posts(J.read_events(spark, f"{tmp_path}/in", t.events.schema)), 60)
    J.drain(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    got = {(r.symbol, r.start): round(r.value, 9) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = J.posts(t.events).groupBy("symbol", F.window("created_at", "60 minutes").start.alias("start")).agg(*[F.avg(f"sentiment_{k}").alias(k) for k in ("positive", "negative", "confidence")]).where("confidence > 0")
    want = {(r.symbol, r.start): round((r.positive - r.negative) * r.confidence, 9) for r in batch.collect()}
    missing = set(want) - set(got)
    assert got == {k: want[k] for k in got} and len(missing) <= 0.05 * len(want)
    assert not missing or min(s for _, s in missing) >= max(s for _, s in got) - dt.timedelta(hours=2)


def test_momentum_by_a_plain_loop(spark):
    """Equal times, one post, no weight, a null key; no trailing window over a key's sorted posts is in the plan."""
    at = lambda h, m=0: dt.datetime(2024, 1, 5, h, m)
    times = {"a": [at(0), at(3), at(6), at(7), at(11)], "b": [at(1), at(9), at(9)], "c": [at(2)], "z": [at(4), at(5)], None: [at(1), at(5), at(8, 59)]}
    rows = [(i * 10 + j, s, t, (j % 4) / 4, (j % 3) / 6, 0.0 if s == "z" else (j + 1) / 8) for i, (s, ts) in enumerate(times.items()) for j, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "tweet_id long, symbol string, created_at timestamp_ntz, sentiment_positive double, sentiment_negative double, sentiment_confidence double")
    got = S.momentum(df)
    assert "rangeframe" not in got._jdf.queryExecution().executedPlan().toString().lower()
    want = {}
    for s, ts in times.items():
        def mean(end):
            near = [r for r in rows if r[1] == s and end - dt.timedelta(hours=4) < r[2] <= end]
            return sum((r[3] - r[4]) * r[5] for r in near) / c if (c := sum(r[5] for r in near)) else 0.0
        ends = sorted(ts)[-2:]
        want[s] = max(-1, min(1, mean(ends[-1]) - mean(ends[0]))) if len(ends) > 1 else 0.0
    assert {r.symbol: round(r.momentum, 12) for r in got.collect()} == {s: round(x, 12) for s, x in want.items()} and abs(want["a"]) > 0.01
