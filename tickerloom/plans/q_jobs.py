"""Queries: models, scoring, sources and sinks, streams."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.functions.text import BEARISH, BULLISH
from tickerloom.operators import models as L
from tickerloom.operators import posts as P
from tickerloom.operators import scoring as C
from tickerloom.operators import table as O
from tickerloom.operators.staging import folder
from tickerloom.plans.q_text import _has
from tickerloom.plans.registry import query
from tickerloom.sources import files as S
from tickerloom.streaming import jobs as J
from tickerloom.streaming import log as G

_MD5 = "CAST(concat('0x', substr(md5(CAST(row_id AS STRING)), 1, 8)) AS BIGINT)"
FEATURES = ["open", "high", "low", "close", "volume"]


def training(t):
    """Bars with the next close's direction as label."""
    bars = t.bars.withColumn("next", F.lead("close").over(W.partitionBy("symbol").orderBy("date"))).dropna(subset=["next"])
    return bars.select(F.concat("symbol", F.lit("-"), F.col("date").cast("string")).alias("row_id"), "symbol", "date", (F.col("next") > F.col("close")).cast("int").alias("label"), *[F.col(c).cast("double").alias(c) for c in FEATURES])


# Models
query("ml_scale_standard", "WITH s AS (SELECT avg(close) AS m, stddev_pop(close) AS s FROM bars WHERE date < DATE '1997-01-01') SELECT symbol, date, round((close - m) / s, 5) AS close FROM bars CROSS JOIN s", "bars")(
    lambda t: O.scale_standard(t.bars.select("symbol", "date", "close"), ["close"], t.bars.where("date < '1997-01-01'")).withColumn("close", F.round("close", 5))
)
query("ml_select_variance", "SELECT row_id, f_median FROM features", "features")(lambda t: t.features.select("row_id", *O.select_variance(t.features, ["f_median", "f_const"])))
query("ml_sample_split", f"SELECT row_id, {_MD5} % 5 < 4 AS train, row_number() OVER (PARTITION BY symbol ORDER BY md5(CAST(row_id AS STRING)), row_id) <= floor(count(*) OVER (PARTITION BY symbol) * 0.8e0 + 0.5e0) AS stratified FROM features", "features")(
    lambda t: L.stratified_split(t.features.select("row_id", "symbol"), "row_id", "symbol").select("row_id", (O.hash_mod(F.col("row_id"), 5) < 4).alias("train"), F.col("train").alias("stratified"))
)
query("ml_stratified_folds", "SELECT row_id, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(row_id AS STRING)), row_id) - 1) % 5 AS INT) AS fold FROM preds", "preds")(lambda t: O.stratified_folds(t.preds.select("row_id", "label"), "row_id", "label", 5).select("row_id", "fold"))
query("ml_blend_mean", """WITH s AS (SELECT row_id, label, score AS a, (row_id % 101) / 101e0 AS b FROM preds), l AS (SELECT 'a' AS model, label, a AS score FROM s UNION ALL SELECT 'b', label, b FROM s UNION ALL SELECT 'blend', label, (0e0 + a + b) / 2 FROM s),
r AS (SELECT *, rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2e0 AS k FROM l), u AS (SELECT model, (sum(k) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2e0) / (sum(label) * (count(*) - sum(label))) AS auc FROM r GROUP BY model)
SELECT round(max(auc) FILTER (WHERE model = 'blend'), 6) AS blend_auc, round(max(auc) FILTER (WHERE model <> 'blend'), 6) AS best_auc FROM u""", "preds")(
    lambda t: L.blend_measures(t.preds.select("label", F.col("score").alias("a"), ((F.col("row_id") % 101) / 101.0).alias("b")), ["a", "b"]).select(F.round("blend_auc", 6).alias("blend_auc"), F.round("best_auc", 6).alias("best_auc"))
)
query("ml_select_l1")(lambda t: L.select_l1(training(t), FEATURES, "row_id"))
query("ml_train_pooled")(lambda t: L.train_pooled(training(t), FEATURES, "row_id", ["date", "symbol"]))
query("ml_train_per_symbol")(lambda t: L.train_per_group(training(t), FEATURES, "row_id"))
query("ml_train_per_sector")(lambda t: L.train_per_group(training(t).withColumn("sector", (F.substring("symbol", 2, 1).cast("int") % 3).cast("string")), FEATURES, "row_id", "sector").withColumnRenamed("symbol", "sector"))
query("ml_oof")(lambda t: L.fold_measures(L.out_of_fold(training(t), FEATURES, "row_id")))
query("ml_calibrate")(lambda t: L.calibrate(t.preds.select("row_id", "label", "score"), "row_id"))
query("ml_calibration_bins")(lambda t: L.reliability(L.calibrate(t.preds.select("row_id", "label", "score"), "row_id")))
query("ml_stack")(lambda t: L.stack(L.out_of_fold(training(t), FEATURES, "row_id"), "row_id"))
query("ml_param_sweep")(lambda t: L.sweep(training(t), FEATURES, "row_id"))
query("ml_importance")(lambda t: L.importance(training(t), FEATURES, "row_id"))


@query("ml_batch_predict")
def ml_batch_predict(t):
    data = L.assembled(training(t), FEATURES)
    return L.predict(L.estimators()["logistic"].fit(data), data, "row_id")


_NOISE = ", ".join(f"CAST(concat('0x', substr(md5(concat(symbol, '-', CAST(date AS STRING), '-{i}')), 1, 8)) AS BIGINT) % 2000 / 1000e0 - 1 AS feature_{i}" for i in range(69))


@query("gen_synthetic_features", f"WITH days AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM bars), (SELECT max(date) FROM bars), INTERVAL 1 DAY)) AS DATE) AS date) SELECT symbol, date, {_NOISE} FROM (SELECT DISTINCT symbol FROM bars) CROSS JOIN (SELECT date FROM days WHERE isodow(date) < 6)", "bars")
def gen_synthetic_features(t):
    """A seeded feature row for each symbol and weekday that the bars span."""
    days = t.bars.agg(F.min("date").alias("a"), F.max("date").alias("z")).select(F.explode(F.sequence("a", "z")).alias("date")).where(F.weekday("date") < 5)
    noise = lambda i: O.hash_mod(F.concat("symbol", F.lit("-"), F.col("date").cast("string"), F.lit(f"-{i}")), 2000) / 1000.0 - 1
    return t.bars.select("symbol").distinct().crossJoin(days).select("symbol", "date", *[noise(i).alias(f"feature_{i}") for i in range(69)])


# Scoring
_U, _B = _has(BULLISH), _has(BEARISH)
query("udf_score_batch", f"SELECT tweet_id, round(u * 1e0 / (u + d + 2), 6) AS positive, round(d * 1e0 / (u + d + 2), 6) AS negative, CASE WHEN u >= d AND u >= 2 THEN 'positive' WHEN d >= 2 THEN 'negative' ELSE 'neutral' END AS label FROM (SELECT tweet_id, {_U} AS u, {_B} AS d FROM tweet_text)", "tweet_text")(
    lambda t: C.scored(t.tweet_text).select("tweet_id", F.round("positive", 6).alias("positive"), F.round("negative", 6).alias("negative"), "label")
)


def _length_model():
    """A stand-in for a loaded model: shares by length, none for texts of odd length."""
    return lambda texts: [None if len(x) % 2 else (min(1.0, len(x) / 600), 0.1, 0.5) for x in texts]


query("udf_fallback_score")(lambda t: C.scored(t.tweet_text, C.batch_scorer(_length_model)).select("tweet_id", "label", "confidence", "scored_by"))


# Sources and sinks, each as a round trip over rows of the given tables
def _feature_rows(t):
    return t.features.select("row_id", "symbol", "f_median", "f_const")


_KIND = "row_id bigint, f_median double, f_const double, symbol string"


@query("src_csv_header", "SELECT row_id, symbol, f_median FROM features", "features")
def src_csv_header(t):
    path = folder(t.spark)
    _feature_rows(t).write.option("header", True).csv(path)
    return S.read_csv(t.spark, path, "row_id bigint, symbol string, f_median double, f_const double").where("_corrupt is null").select("row_id", "symbol", "f_median")


@query("snk_csv_header", "SELECT row_id, symbol, f_median FROM features", "features")
def snk_csv_header(t):
    path = folder(t.spark)
    S.write_csv_by_symbol(_feature_rows(t).select("row_id", "f_median", "f_const", "symbol"), path)
    return t.spark.read.schema(_KIND).option("header", True).csv(path).select("row_id", "symbol", "f_median")


def _label_first(t):
    path = folder(t.spark)
    S.write_label_first(t.features.withColumn("label", (F.col("row_id") % 2).cast("double")), path, "label", ["f_median", "f_const"])
    return S.read_label_first(t.spark, path, 2)


for _n in ("src_csv_label_first", "snk_csv_label_first"):
    query(_n, "SELECT CAST(row_id % 2 AS DOUBLE) AS label, f_median AS f0, f_const AS f1 FROM features", "features")(_label_first)


@query("src_csv_dir_prefer", "SELECT row_id, symbol FROM features WHERE symbol >= 'S5'", "features")
def src_csv_dir_prefer(t):
    path = folder(t.spark)
    rows = _feature_rows(t).select("row_id", "symbol")
    rows.where("symbol < 'S5'").write.option("header", True).csv(f"{path}/all.csv")
    rows.where("symbol >= 'S5'").write.option("header", True).csv(f"{path}/train.csv")
    return S.read_preferred(t.spark, path, "row_id bigint, symbol string")


query("src_csv_multi_location", "SELECT row_id, symbol FROM features WHERE symbol < 'S5' OR row_id % 2 = 0", "features")(
    lambda t: S.first_location([t.features.where("symbol < 'S5'").select("row_id", "symbol"), t.features.where("row_id % 2 = 0").select("row_id", "symbol")], "symbol")
)
_POST = "tweet_id bigint, symbol string, sentiment_positive double, retweet_count bigint"


def _jsonl(t, compression):
    path = folder(t.spark)
    t.tweets.select("tweet_id", "symbol", "sentiment_positive", "retweet_count").write.option("compression", compression).json(path)
    return S.read_jsonl(t.spark, path, _POST).where("_corrupt is null").drop("_corrupt")


for _n, _c in (("src_jsonl", "none"), ("src_jsonl_gz", "gzip")):
    query(_n, "SELECT tweet_id, symbol, sentiment_positive, retweet_count FROM tweets", "tweets")(lambda t, c=_c: _jsonl(t, c))


def _by_hour(t, write):
    path = folder(t.spark)
    write(t.tweets.select("tweet_id", "symbol", "created_at"), path)
    return t.spark.read.schema("tweet_id bigint, symbol string").json(path).select("tweet_id", "symbol")


query("snk_jsonl_symbol_hour", "SELECT tweet_id, symbol FROM tweets", "tweets")(lambda t: _by_hour(t, S.write_jsonl_by_hour))
query("snk_jsonl_gz_day", "SELECT tweet_id, symbol FROM tweets", "tweets")(lambda t: _by_hour(t, S.write_jsonl_by_day))


@query("snk_scored", "SELECT tweet_id, symbol, sentiment_positive FROM tweets", "tweets")
def snk_scored(t):
    path = folder(t.spark)
    S.write_scored(t.tweets, path)
    return t.spark.read.parquet(path).select("tweet_id", "symbol", "sentiment_positive")


@query("src_scored_by_date", "SELECT tweet_id, symbol FROM tweets WHERE symbol = 'S2' AND CAST(created_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'", "tweets")
def src_scored_by_date(t):
    path = folder(t.spark)
    S.write_scored(t.tweets, path)
    return S.read_scored(t.spark, path, "S2", "2024-01-05", "2024-01-12").select("tweet_id", "symbol")


@query("src_symbol_list", "SELECT DISTINCT symbol FROM tweets", "tweets")
def src_symbol_list(t):
    path = folder(t.spark)
    t.tweets.select(F.concat(F.lit("  "), "symbol", F.lit(" ")).alias("v")).distinct().unionByName(t.tweets.limit(1).select(F.lit(" ").alias("v"))).write.text(path)
    return S.read_symbols(t.spark, path)


@query("src_metrics_json", "SELECT split_part(file, '_', 1) AS model, replace(split_part(file, '_', 2), '.json', '') AS symbol, count(*) AS runs, max(best_value) AS best_value FROM results GROUP BY ALL", "results")
def src_metrics_json(t):
    """Result files named model_symbol.json, each an object over several lines; model and symbol come from the name alone."""
    path = folder(t.spark)
    S.write_named_json(t.results.groupBy("file").agg(F.count("*").alias("runs"), F.max("best_value").alias("best_value")), path, "file")
    return S.read_results(t.spark, path, "runs bigint, best_value double")


@query("src_file_listing")
def src_file_listing(t):
    path = folder(t.spark)
    S.write_scored(t.tweets, path)
    return S.listing(t.spark, path).select(F.regexp_extract("path", "symbol=(S[0-9])", 1).alias("symbol"), "length")


@query("snk_feature_metadata", "SELECT 'row_id,symbol,f_median,sent_5m,sent_daily' AS features, 'f_const' AS target, 5 AS n, count(f_median) AS filled FROM features", "features")
def snk_feature_metadata(t):
    """Written, read, written again with the sentiment names that it lacked, and read."""
    first, second = folder(t.spark), folder(t.spark)
    S.write_metadata(S.feature_metadata(_feature_rows(t), "f_const"), first)
    S.write_metadata(S.with_names(S.read_metadata(t.spark, first), ["f_median", "sent_5m", "sent_daily"]), second)
    return S.read_metadata(t.spark, second).select(F.array_join("features", ",").alias("features"), "target", "n", F.col("filled")["f_median"].alias("filled"))


@query("snk_result_tables", "SELECT job_name, status, count(*) AS n FROM trials GROUP BY ALL", "trials")
def snk_result_tables(t):
    path = folder(t.spark)
    t.trials.groupBy("job_name", "status").agg(F.count("*").alias("n")).write.option("header", True).csv(path)
    return t.spark.read.schema("job_name string, status string, n bigint").option("header", True).csv(path)


@query("snk_oof", "SELECT row_id, score FROM preds WHERE row_id % 3 = 0", "preds")
def snk_oof(t):
    path = folder(t.spark)
    S.write_runs(t.preds.select("row_id", "score"), path, "2024-01-01")
    S.write_runs(t.preds.where("row_id % 3 = 0").select("row_id", "score"), path, "2024-02-01")
    return S.latest_run(t.spark, path).select("row_id", "score")


# Streams, each run until its input is used up
def _files(t, rows, order=()):
    """The rows as a stream of files, as many as the rows have partitions (four at least), in four batches; by order, if given, as posts come."""
    path, n = folder(t.spark), rows.rdd.getNumPartitions()
    dealt = rows.repartitionByRange(max(4, n), *order) if order else rows if n >= 4 else rows.repartition(4)
    dealt.write.parquet(path)
    return J.read_events(t.spark, path, rows.schema, -(-max(4, n) // 4))


def _stream(t):
    return J.posts(_files(t, t.events, ("ts", "event_id")))


def _drained(t, stream, parts=()):
    path = folder(t.spark)
    J.drain(stream, path + "/out", path + "/state", parts)
    return t.spark.read.schema(stream.schema).parquet(path + "/out")


_ST = "SELECT tweet_id, symbol, sentiment_positive FROM tweets"
_keep = ("tweet_id", "symbol", "sentiment_positive")
_RULES = "CASE tweet_id % 6 WHEN 0 THEN 'cashtag_TSLA' WHEN 1 THEN 'financial_keywords,company_MSFT,cashtag_V' ELSE '' END"


@query("st_ingest", f"SELECT tweet_id, coalesce(CASE tweet_id % 6 WHEN 0 THEN 'TSLA' WHEN 1 THEN 'MSFT' END, CASE WHEN contains(upper(text), '$AAPL') THEN 'AAPL' WHEN contains(upper(text), '$TSLA') THEN 'TSLA' END) AS symbol, {_RULES} AS rules, coalesce(retweet_count, 0) AS retweet_count, coalesce(like_count, 0) AS like_count, 0 AS quote_count FROM tweet_text", "tweet_text")
def st_ingest(t):
    """The posts as records of a log, read by two runs of one job with a restart between them."""
    path = folder(t.spark)
    stream = P.projected(G.records(t.spark, path=path + "/log", suffix=".txt", bytes_per_read=str(1 << 18)), ("AAPL", "TSLA"))
    for half in range(2):
        _log(t.tweet_text.where(F.col("tweet_id") % 2 == half), path + "/log")
        J.drain(stream, path + "/out", path + "/state")
    got = t.spark.read.schema(stream.schema).parquet(path + "/out")
    return got.select("tweet_id", "symbol", F.array_join("rules", ",").alias("rules"), "retweet_count", "like_count", "quote_count")


def _log(posts, path):
    """Appends posts to the log as JSON records with metrics and rules."""
    rules = F.transform(F.filter(F.split(F.expr(_RULES), ","), lambda x: x != ""), lambda x: F.struct(F.lit("1").alias("id"), x.alias("tag")))
    metrics = F.struct("retweet_count", "like_count")
    record = F.struct(F.col("tweet_id").alias("id"), "text", F.lit("2024-01-05T10:00:00.000Z").alias("created_at"), "lang", metrics.alias("public_metrics"), rules.alias("matching_rules"))
    posts.select(F.to_json(record)).write.mode("append").text(path)


@query("st_drain", _ST, "tweets")
def st_drain(t):
    """Drained twice from one checkpoint: the second time there is nothing left."""
    path, stream = folder(t.spark), _stream(t)
    for _ in range(2):
        J.drain(stream, path + "/out", path + "/state")
    return t.spark.read.schema(stream.schema).parquet(path + "/out").select(*_keep)


@query("st_microbatch_flush", _ST, "tweets")
def st_microbatch_flush(t):
    """The running job, whose buffers (one for each symbol) let 100 rows go at a time and by the clock what is left."""
    path, stream = folder(t.spark), J.flushed(_stream(t), "symbol", rows=100, seconds=2.0)
    job = stream.writeStream.format("parquet").option("path", path + "/out").option("checkpointLocation", path + "/state").trigger(processingTime="0 seconds").start()
    try:
        J.settle(job)
    finally:
        job.stop()
    return t.spark.read.schema(stream.schema).parquet(path + "/out").select(*_keep)


@query("st_partitioned_sink", "SELECT tweet_id, symbol, CAST(hour(created_at) AS INT) AS hour FROM tweets", "tweets")
def st_partitioned_sink(t):
    path, stream = folder(t.spark), J.with_parts(_stream(t))
    J.drain(stream, path + "/out", path + "/state", ("symbol", "date", "hour"))
    return t.spark.read.parquet(path + "/out").select("tweet_id", "symbol", "hour")


def _text_stream(t):
    return _files(t, t.tweet_text)


_FAN = "(VALUES ('AAPL'), ('TSLA'), ('V'), ('VZ')) k(symbol)"
query("st_symbol_fanout", f"SELECT tweet_id, symbol FROM tweet_text JOIN {_FAN} ON contains(upper(text), concat('$', symbol))", "tweet_text")(
    lambda t: _drained(t, J.fan_out(_text_stream(t), t.spark.createDataFrame([("AAPL",), ("TSLA",), ("V",), ("VZ",)], "symbol string")).select("tweet_id", "symbol"))
)
query("st_incremental_score", f"SELECT tweet_id, round(u * 1e0 / (u + d + 2), 6) AS positive FROM (SELECT tweet_id, {_U} AS u, {_B} AS d FROM tweet_text)", "tweet_text")(lambda t: _drained(t, J.scores(_text_stream(t)).select("tweet_id", F.round("positive", 6).alias("positive"))))
_WIDE = """SELECT {m} AS width, symbol, w AS start, round(greatest(-1e0, least(1e0, (p - n) * c)), 9) AS value FROM (SELECT symbol, time_bucket(INTERVAL '{m} minutes', created_at) AS w, avg(sentiment_positive) AS p, avg(sentiment_negative) AS n, avg(sentiment_confidence) AS c FROM tweets GROUP BY ALL)
WHERE c > 0 AND w + INTERVAL '{m} minutes' <= (SELECT max(created_at) FROM tweets) - INTERVAL '10 minutes'"""


@query("st_sent_windows", " UNION ALL ".join(_WIDE.format(m=m) for m in J.WIDTHS), "tweets")
def st_sent_windows(t):
    """Windows of all widths that the watermark has passed, of posts that come in the order of time in five files, a batch each."""
    path, n = folder(t.spark), 5
    bounds = t.events.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("x")).stat.approxQuantile("x", [i / n for i in range(1, n)], 0.01)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = t.events.where((F.lit(True) if low is None else at >= low) & (F.lit(True) if high is None else at < high))
        part.coalesce(1).write.mode("append").parquet(path)
    out = _drained(t, J.all_sentiment_windows(J.posts(J.read_events(t.spark, path, t.events.schema))))
    return out.select("width", "symbol", F.col("start").cast("timestamp_ntz").alias("start"), F.round("value", 9).alias("value"))
