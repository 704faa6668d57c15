"""Queries: aggregates, joins, windows, order and sets."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.functions import text as T
from tickerloom.operators import metrics as M
from tickerloom.operators import posts as P
from tickerloom.operators import sentiment as S
from tickerloom.operators import table as O
from tickerloom.operators.ranges import ascending, exact_medians
from tickerloom.plans.q_text import artifact_kind
from tickerloom.plans.registry import query

_D = "date_trunc('day', created_at)"
_DAY = "CAST(created_at AS DATE)"


def _bucket_sql(m: int) -> str:
    return f"""b{m} AS (SELECT symbol, {_DAY} AS date, time_bucket(INTERVAL '{m} minutes', created_at) AS w, avg(sentiment_positive) AS p, avg(sentiment_negative) AS n, avg(sentiment_neutral) AS u, avg(sentiment_confidence) AS c FROM tweets GROUP BY ALL),
s{m} AS (SELECT symbol, date, greatest(-1e0, least(1e0, avg((p - n) * c))) AS sent_{m}m FROM b{m} WHERE p IS NOT NULL AND n IS NOT NULL AND u IS NOT NULL AND c > 0 GROUP BY ALL)"""


_DAILY = f"sd AS (SELECT symbol, {_DAY} AS date, greatest(-1e0, least(1e0, sum((sentiment_positive - sentiment_negative) * (retweet_count + like_count + 1)) / sum(retweet_count + like_count + 1))) AS sent_daily FROM tweets GROUP BY ALL)"
_VOL = f"sv AS (SELECT symbol, {_DAY} AS date, CASE WHEN count(sentiment_confidence) < 2 THEN 0 ELSE least(stddev_pop((sentiment_positive - sentiment_negative) * sentiment_confidence) / 2, 1e0) END AS volatility FROM tweets GROUP BY ALL)"
_MOM = f"""mt AS (SELECT *, {_DAY} AS date FROM tweets WHERE sentiment_confidence IS NOT NULL),
mm AS (SELECT symbol, date, created_at, tweet_id, coalesce(sum((sentiment_positive - sentiment_negative) * sentiment_confidence) OVER f / nullif(sum(sentiment_confidence) OVER f, 0), 0) AS mean FROM mt
WINDOW f AS (PARTITION BY symbol, date ORDER BY created_at RANGE BETWEEN INTERVAL '3 hours 59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW)),
ml AS (SELECT symbol, date, mean - lag(mean) OVER (PARTITION BY symbol, date ORDER BY created_at, tweet_id) AS step, row_number() OVER (PARTITION BY symbol, date ORDER BY created_at DESC, tweet_id DESC) AS back FROM mm),
mo AS (SELECT symbol, date, greatest(-1e0, least(1e0, coalesce(step, 0))) AS momentum FROM ml WHERE back = 1)"""


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


for _m in (5, 10, 60):
    query(f"agg_sent_{_m}m", f"WITH {_bucket_sql(_m)} SELECT symbol, date, round(sent_{_m}m, 6) AS sent_{_m}m FROM s{_m}", "tweets")(lambda t, m=_m: _rounded(S.bucket_means(t.tweets, m), f"sent_{m}m"))
query("agg_sent_daily", f"WITH {_DAILY} SELECT symbol, date, round(sent_daily, 6) AS sent_daily FROM sd", "tweets")(lambda t: _rounded(S.daily(t.tweets), "sent_daily"))
query("agg_sent_weighted", f"SELECT symbol, {_DAY} AS date, round(coalesce(greatest(-1e0, least(1e0, sum((sentiment_positive - sentiment_negative) * sentiment_confidence) / nullif(sum(sentiment_confidence), 0))), 0), 6) AS sent FROM tweets GROUP BY ALL", "tweets")(
    lambda t: _rounded(S.weighted(t.tweets, F.col("sentiment_confidence"), "sent"), "sent")
)
query("agg_sent_volatility", f"WITH {_VOL} SELECT symbol, date, round(volatility, 6) AS volatility FROM sv", "tweets")(lambda t: _rounded(S.volatility(t.tweets), "volatility"))
query("win_sent_momentum", f"WITH {_MOM} SELECT symbol, date, round(momentum, 5) AS momentum FROM mo", "tweets")(lambda t: _rounded(S.momentum(t.tweets), "momentum", digits=5))
_ALL = ", ".join([_bucket_sql(5), _bucket_sql(10), _bucket_sql(60), _DAILY, _VOL, _MOM])
query("agg_sent_summary", f"""WITH {_ALL}, base AS (SELECT symbol, {_DAY} AS date, count(*) AS tweet_count, coalesce(avg(sentiment_confidence), 0) AS avg_confidence FROM tweets GROUP BY ALL)
SELECT symbol, date, tweet_count, round(avg_confidence, 3) AS avg_confidence, round(coalesce(sent_5m, 0), 5) AS sent_5m, round(coalesce(sent_10m, 0), 5) AS sent_10m, round(coalesce(sent_60m, 0), 5) AS sent_60m, round(coalesce(sent_daily, 0), 5) AS sent_daily,
round(coalesce(momentum, 0), 5) AS momentum, round(coalesce(volatility, 0), 5) AS volatility
FROM base LEFT JOIN s5 USING (symbol, date) LEFT JOIN s10 USING (symbol, date) LEFT JOIN s60 USING (symbol, date) LEFT JOIN sd USING (symbol, date) LEFT JOIN mo USING (symbol, date) LEFT JOIN sv USING (symbol, date)""", "tweets")(
    lambda t: _rounded(S.summary(t.tweets), "sent_5m", "sent_10m", "sent_60m", "sent_daily", "momentum", "volatility", digits=5).withColumn("avg_confidence", F.round("avg_confidence", 3))
)
_CAL = "cal AS (SELECT s.symbol, d.date FROM (SELECT DISTINCT symbol FROM tweets) s CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT min(created_at) FROM tweets)::DATE - 2, (SELECT max(created_at) FROM tweets)::DATE + 2, INTERVAL 1 DAY)) AS DATE) AS date) d)"
_JOIN = f"WITH {_bucket_sql(5)}, {_bucket_sql(10)}, {_bucket_sql(60)}, {_DAILY}, {_CAL} SELECT symbol, date, " + ", ".join(f"round(coalesce({c}, 0), 6) AS {c}" for c in ("sent_5m", "sent_10m", "sent_60m", "sent_daily")) + " FROM cal LEFT JOIN s5 USING (symbol, date) LEFT JOIN s10 USING (symbol, date) LEFT JOIN s60 USING (symbol, date) LEFT JOIN sd USING (symbol, date)"


def calendar(posts):
    """All symbols on all days from two before the first post to two after the last."""
    span = posts.agg(F.to_date(F.min("created_at")).alias("a"), F.to_date(F.max("created_at")).alias("z")).select(F.explode(F.sequence(F.date_sub("a", 2), F.date_add("z", 2))).alias("date"))
    return posts.select("symbol").distinct().crossJoin(F.broadcast(span))


_FOUR = ("sent_5m", "sent_10m", "sent_60m", "sent_daily")
query("join_features_sentiment", _JOIN, "tweets")(lambda t: _rounded(S.features_with_sentiment(calendar(t.tweets), t.tweets), *_FOUR))
query("agg_sentiment_features", f"WITH {_bucket_sql(5)}, {_bucket_sql(10)}, {_bucket_sql(60)}, {_DAILY}, {_CAL} SELECT symbol, date, " + ", ".join(f"round(coalesce({c}, 0), 6) AS {c}" for c in _FOUR) + " FROM (SELECT * FROM cal WHERE isodow(date) < 6) LEFT JOIN s5 USING (symbol, date) LEFT JOIN s10 USING (symbol, date) LEFT JOIN s60 USING (symbol, date) LEFT JOIN sd USING (symbol, date)", "tweets")(
    lambda t: _rounded(S.sentiment_features(t.tweets, calendar(t.tweets).select("date").distinct().where(F.weekday("date") < 5)), *_FOUR)
)
query("agg_sent_window_stats", "SELECT symbol, time_bucket(INTERVAL '5 minutes', created_at) AS start, count(*) AS n, round(avg(sentiment_positive), 6) AS sent_mean_5m, round(sum(sentiment_positive), 6) AS sent_sum, round(avg(CAST(sentiment_positive > sentiment_negative AS INT)), 6) AS sent_pos_ratio FROM tweets GROUP BY ALL", "tweets")(
    lambda t: t.tweets.groupBy("symbol", F.window("created_at", "5 minutes").start.alias("start")).agg(F.count("*").alias("n"), F.round(F.avg("sentiment_positive"), 6).alias("sent_mean_5m"), F.round(F.sum("sentiment_positive"), 6).alias("sent_sum"), F.round(F.avg((F.col("sentiment_positive") > F.col("sentiment_negative")).cast("int")), 6).alias("sent_pos_ratio"))
)
query("agg_tweet_volume_day", f"SELECT symbol, {_DAY} AS date, count(*) AS n FROM tweets GROUP BY ALL", "tweets")(lambda t: t.tweets.groupBy("symbol", F.to_date("created_at").alias("date")).agg(F.count("*").alias("n")))
query("agg_mean_sentiment", "SELECT symbol, time_bucket(INTERVAL '60 minutes', created_at) AS start, round(avg(sentiment_positive - sentiment_negative), 6) AS mean FROM tweets GROUP BY ALL", "tweets")(
    lambda t: t.tweets.groupBy("symbol", F.window("created_at", "60 minutes").start.alias("start")).agg(F.round(F.avg(F.col("sentiment_positive") - F.col("sentiment_negative")), 6).alias("mean"))
)
query("agg_batch_assign", "SELECT tweet_id, CAST(floor((row_number() OVER (PARTITION BY symbol, date_trunc('hour', created_at) ORDER BY created_at, tweet_id) - 1) / 4) AS BIGINT) AS batch FROM tweets", "tweets")(
    lambda t: t.tweets.select("tweet_id", F.floor((F.row_number().over(W.partitionBy("symbol", F.window("created_at", "1 hour").start).orderBy("created_at", "tweet_id")) - 1) / 4).alias("batch"))
)
query("agg_group_partition", f"SELECT symbol, {_DAY} AS date, CAST(hour(created_at) AS INT) AS h, count(*) AS n FROM tweets GROUP BY ALL", "tweets")(lambda t: t.tweets.groupBy("symbol", F.to_date("created_at").alias("date"), F.hour("created_at").alias("h")).agg(F.count("*").alias("n")))

# Data quality
_LAB = "(SELECT symbol, CAST(target_next_day LIKE '-%' AS INT) AS y, f_median FROM features)"


def _labelled(t):
    return t.features.select("symbol", F.col("target_next_day").like("-%").cast("int").alias("y"), "f_median")


query("agg_target_profile", f"SELECT symbol, count(DISTINCT y) AS kinds, round(avg(y), 6) AS ratio, avg(y) NOT BETWEEN 0.3 AND 0.7 AS warn FROM {_LAB} GROUP BY symbol", "features")(
    lambda t: _labelled(t).groupBy("symbol").agg(F.countDistinct("y").alias("kinds"), F.round(F.avg("y"), 6).alias("ratio"), (~F.avg("y").between(0.3, 0.7)).alias("warn"))
)
query("agg_validation_rollup", f"SELECT count(*) AS files, round(avg(ratio), 6) AS mean_ratio, round(stddev_pop(ratio), 6) AS std_ratio, round(avg(CAST(ratio BETWEEN 0.45 AND 0.55 AS INT)), 6) AS pass_rate, array_to_string(list_sort(list(symbol) FILTER (WHERE ratio NOT BETWEEN 0.45 AND 0.55)), ',') AS failed FROM (SELECT symbol, avg(y) AS ratio FROM {_LAB} GROUP BY symbol)", "features")(
    lambda t: _labelled(t).groupBy("symbol").agg(F.avg("y").alias("ratio")).agg(F.count("*").alias("files"), F.round(F.avg("ratio"), 6).alias("mean_ratio"), F.round(F.stddev_pop("ratio"), 6).alias("std_ratio"), F.round(F.avg(F.col("ratio").between(0.45, 0.55).cast("int")), 6).alias("pass_rate"), F.nullif(F.array_join(F.sort_array(F.collect_list(F.when(~F.col("ratio").between(0.45, 0.55), F.col("symbol")))), ","), F.lit("")).alias("failed"))
)
_COLS = ("f_median", "f_sparse", "f_const", "f_inf")
_LONG = "(" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM features" for c in _COLS) + ")"
query("agg_null_profile", f"SELECT feature, count(value) = 0 AS all_null, round(avg(CAST(value IS NULL AS INT)) * 100, 4) AS null_pct, avg(CAST(value IS NULL AS INT)) > 0.5 AS mostly_null FROM {_LONG} GROUP BY feature", "features")(
    lambda t: M.long_form(t.features, list(_COLS)).groupBy("feature").agg((F.count("value") == 0).alias("all_null"), F.round(F.avg(F.col("value").isNull().cast("int")) * 100, 4).alias("null_pct"), (F.avg(F.col("value").isNull().cast("int")) > 0.5).alias("mostly_null"))
)
query("agg_distinct_targets", "SELECT 'target_next_day' AS feature, count(DISTINCT target_next_day) AS n FROM features", "features")(lambda t: t.features.agg(*[F.countDistinct(c).alias("n") for c in t.features.columns if "target" in c or "direction" in c]).select(F.lit("target_next_day").alias("feature"), "n"))
query("agg_value_counts", "SELECT label, count(*) AS n FROM preds GROUP BY label", "preds")(lambda t: t.preds.groupBy("label").agg(F.count("*").alias("n")))
query("agg_column_stats", "SELECT round(avg(f_median), 2) AS mean, round(stddev_samp(f_median), 2) AS std, min(f_median) AS lo, max(f_median) AS hi FROM features", "features")(lambda t: t.features.agg(F.round(F.avg("f_median"), 2).alias("mean"), F.round(F.stddev_samp("f_median"), 2).alias("std"), F.min("f_median").alias("lo"), F.max("f_median").alias("hi")))
query("agg_column_summary_all", f"SELECT feature, round(median(value), 4) AS mid, min(value) AS lo, max(value) AS hi FROM {_LONG} GROUP BY feature", "features")(lambda t: M.long_form(t.features, list(_COLS)).groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).withColumn("mid", F.round(M.median_of(exact_medians(t.features, list(_COLS))), 4)))
query("agg_date_span", "SELECT symbol, min(date) AS first, max(date) AS last FROM bars GROUP BY symbol", "bars")(lambda t: t.bars.groupBy("symbol").agg(F.min("date").alias("first"), F.max("date").alias("last")))
_NEXT = "nx AS (SELECT symbol, date, close, volume, lead(close) OVER (PARTITION BY symbol ORDER BY date) / close - 1 AS r FROM bars)"


def _next_return(bars):
    return bars.withColumn("r", F.lead("close").over(W.partitionBy("symbol").orderBy("date")) / F.col("close") - 1)


query("win_next_return", f"WITH {_NEXT} SELECT symbol, date, round(r, 5) AS r, coalesce(CAST(r > 0 AS INT), 0) AS direction FROM nx", "bars")(lambda t: _next_return(t.bars).select("symbol", "date", F.round("r", 5).alias("r"), F.coalesce((F.col("r") > 0).cast("int"), F.lit(0)).alias("direction")))
query("agg_leakage_corr", f"WITH {_NEXT} SELECT symbol, round(corr(close, r), 5) AS corr_close, round(corr(volume, r), 5) AS corr_volume, abs(corr(close, r)) > 0.99 AS severe FROM nx GROUP BY symbol", "bars")(
    lambda t: _next_return(t.bars).groupBy("symbol").agg(F.round(M.guarded_corr("close", "r"), 5).alias("corr_close"), F.round(M.guarded_corr("volume", "r"), 5).alias("corr_volume"), (F.abs(M.guarded_corr("close", "r")) > 0.99).alias("severe"))
)
query("agg_expected_count", "SELECT count(DISTINCT symbol) AS actual, 46 AS expected, count(DISTINCT symbol) = 46 AS complete FROM features", "features")(lambda t: t.features.agg(F.countDistinct("symbol").alias("actual")).select("actual", F.lit(46).alias("expected"), (F.col("actual") == 46).alias("complete")))
query("agg_process_summary", "SELECT status, count(*) AS n, count(DISTINCT job_name) AS jobs, array_to_string(list_sort(list(DISTINCT job_name)), ',') AS names FROM trials GROUP BY status", "trials")(lambda t: t.trials.groupBy("status").agg(F.count("*").alias("n"), F.countDistinct("job_name").alias("jobs"), F.array_join(F.sort_array(F.collect_set("job_name")), ",").alias("names")))

# Trials
def _o():
    return F.col("objective_value")


_AT = (0.55, 0.80, 0.95, 0.999)
query("agg_trial_stats", "SELECT job_name, count(objective_value) AS n, round(avg(objective_value), 6) AS mean, min(objective_value) AS lo, max(objective_value) AS hi, " + ", ".join(f"count(*) FILTER (WHERE objective_value >= {x}) AS ge_{str(x)[2:]}" for x in _AT) + " FROM trials GROUP BY job_name", "trials")(
    lambda t: t.trials.groupBy("job_name").agg(F.count(_o()).alias("n"), F.round(F.avg(_o()), 6).alias("mean"), F.min(_o()).alias("lo"), F.max(_o()).alias("hi"), *[F.count_if(_o() >= x).alias(f"ge_{str(x)[2:]}") for x in _AT])
)
query("agg_trials_by_source", "SELECT data_source, array_to_string(list_sort(list(DISTINCT job_name)), ',') AS jobs FROM trials GROUP BY data_source", "trials")(lambda t: t.trials.groupBy("data_source").agg(F.array_join(F.sort_array(F.collect_set("job_name")), ",").alias("jobs")))
query("agg_trial_summary", "SELECT count(*) AS total, count(objective_value) AS completed, round(100e0 * count(objective_value) / count(*), 4) AS success_pct, max(objective_value) AS best, min(objective_value) AS worst, round(avg(objective_value), 6) AS mean, round(median(objective_value), 6) AS mid, round(stddev_samp(objective_value), 6) AS std FROM trials", "trials")(
    lambda t: t.trials.agg(F.count("*").alias("total"), F.count(_o()).alias("completed"), F.round(100.0 * F.count(_o()) / F.count("*"), 4).alias("success_pct"), F.max(_o()).alias("best"), F.min(_o()).alias("worst"), F.round(F.avg(_o()), 6).alias("mean"), F.round(F.lit(exact_medians(t.trials, ["objective_value"])["objective_value"]), 6).alias("mid"), F.round(F.stddev_samp(_o()), 6).alias("std"))
)
@query("agg_trial_upper_median", "SELECT job_name, list_sort(list(objective_value) FILTER (WHERE objective_value IS NOT NULL))[count(objective_value) // 2 + 1] AS mid FROM trials GROUP BY job_name", "trials")
def agg_trial_upper_median(t):
    """The value at which more than half of a job's are counted, from counts of distinct values; null where there are none."""
    counts = t.trials.groupBy("job_name", "objective_value").agg(F.count(_o()).alias("n"))
    up_to = counts.withColumn("up_to", F.sum("n").over(W.partitionBy("job_name").orderBy("objective_value"))).withColumn("all", F.sum("n").over(W.partitionBy("job_name")))
    return up_to.groupBy("job_name").agg(F.min(F.when(F.col("up_to") * 2 > F.col("all"), _o())).alias("mid"))


query("agg_threshold_table", " UNION ALL ".join(f"SELECT {x}e0 AS threshold, count(*) FILTER (WHERE objective_value >= {x}) AS n, count(objective_value) AS total, round(100e0 * count(*) FILTER (WHERE objective_value >= {x}) / count(objective_value), 4) AS pct FROM trials" for x in _AT), "trials")(
    lambda t: t.trials.agg(F.count(_o()).alias("total"), *[F.count_if(_o() >= x).alias(f"n{i}") for i, x in enumerate(_AT)]).select("total", F.explode(F.array(*[F.struct(F.lit(x).alias("threshold"), F.col(f"n{i}").alias("n")) for i, x in enumerate(_AT)])).alias("r")).select("r.threshold", "r.n", "total", F.round(100.0 * F.col("r.n") / F.col("total"), 4).alias("pct"))
)
_STATES = ("Completed", "Failed", "InProgress")
query("agg_status_counters", "SELECT job_name, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s.lower()}" for s in _STATES) + ", count(*) AS total FROM trials GROUP BY job_name", "trials")(
    lambda t: t.trials.groupBy("job_name").pivot("status", list(_STATES)).count().fillna(0).select("job_name", *[F.col(s).alias(s.lower()) for s in _STATES], sum((F.col(s) for s in _STATES), F.lit(0)).alias("total"))
)
_MODELS = ("lightgbm", "xgboost", "lstm")


def _by_model(df):
    name = F.lit(None)
    for m in reversed(_MODELS):
        name = F.when(F.contains(F.lower("file"), F.lit(m)), m).otherwise(name)
    return df.withColumn("model", name)


_BY = "(SELECT *, CASE " + " ".join(f"WHEN contains(lower(file), '{m}') THEN '{m}'" for m in _MODELS) + " END AS model FROM results)"
query("agg_completion_by_model", f"SELECT model, count(*) AS n, round(100e0 * count(*) / 242, 4) AS pct FROM {_BY} WHERE model IS NOT NULL GROUP BY model", "results")(lambda t: _by_model(t.results).where("model is not null").groupBy("model").agg(F.count("*").alias("n"), F.round(100.0 * F.count("*") / 242, 4).alias("pct")))
query("agg_progress_by_model", f"SELECT model, count(*) AS completed, sum(trials) AS trials, max(best_value) AS best FROM {_BY} GROUP BY model", "results")(lambda t: _by_model(t.results).groupBy("model").agg(F.count("*").alias("completed"), F.sum("trials").alias("trials"), F.max("best_value").alias("best")))
query("agg_progress_delta", f"SELECT model, count(*) FILTER (WHERE row_id % 10 < 7) AS before, count(*) AS now, count(*) - count(*) FILTER (WHERE row_id % 10 < 7) AS fresh FROM {_BY} GROUP BY model", "results")(
    lambda t: _by_model(t.results).where("row_id % 10 < 7").groupBy("model").agg(F.count("*").alias("before")).join(_by_model(t.results).groupBy(F.col("model").alias("m")).agg(F.count("*").alias("now")), F.col("model").eqNullSafe(F.col("m")), "right").select(F.col("m").alias("model"), F.coalesce("before", F.lit(0)).alias("before"), "now").withColumn("fresh", F.col("now") - F.col("before"))
)
_AK = "(SELECT *, CASE WHEN ends_with(path, '.pkl') THEN 'Pickle' WHEN ends_with(path, '.tar.gz') THEN 'Compressed' ELSE 'Other' END AS kind FROM artifacts)"
query("agg_artifact_inventory", f"SELECT kind, count(*) AS n, CAST(sum(size) AS BIGINT) AS total, max(size) AS largest, min(size) AS smallest, CAST(floor(sum(size) / count(*)) AS BIGINT) AS mean FROM {_AK} GROUP BY kind", "artifacts")(
    lambda t: t.artifacts.groupBy(artifact_kind(F.col("path")).alias("kind")).agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.max("size").alias("largest"), F.min("size").alias("smallest"), F.floor(F.sum("size") / F.count("*")).alias("mean"))
)
_AUC = "r AS (SELECT *, rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2e0 AS k FROM preds), a AS (SELECT model, (sum(k) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2e0) / (sum(label) * (count(*) - sum(label))) AS auc FROM r GROUP BY model)"
query("agg_auc", f"WITH {_AUC} SELECT model, round(auc, 6) AS auc FROM a", "preds")(lambda t: _rounded(M.auc(t.preds, ["model"]), "auc"))
query("agg_accuracy", "SELECT model, round(avg(CAST(CAST(score > 0.5 AS INT) = label AS INT)), 6) AS accuracy FROM preds GROUP BY model", "preds")(lambda t: _rounded(M.accuracy(t.preds, ["model"]), "accuracy"))
query("agg_fold_scores", "SELECT model, round(avg(m), 6) AS mean, round(stddev_pop(m), 6) AS std FROM (SELECT model, row_id % 5 AS fold, avg(score) AS m FROM preds GROUP BY ALL) GROUP BY model", "preds")(lambda t: t.preds.groupBy("model", (F.col("row_id") % 5).alias("fold")).agg(F.avg("score").alias("m")).groupBy("model").agg(F.round(F.avg("m"), 6).alias("mean"), F.round(F.stddev_pop("m"), 6).alias("std")))
_NUM = ("open", "close", "volume")
_LB = "(" + " UNION ALL ".join(f"SELECT '{c}' AS feature, date, CAST({c} AS DOUBLE) AS value FROM bars" for c in _NUM) + ")"
query("agg_baseline_profile", f"SELECT feature, count(*) AS rows, avg(CAST(value IS NULL AS INT)) AS null_share, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min, round(max(value), 4) AS max, round(median(value), 4) AS median FROM {_LB} GROUP BY feature", "bars")(lambda t: _rounded(M.baseline_profile(t.bars, list(_NUM)), "mean", "std", "min", "max", "median", digits=4))
query("agg_drift", f"WITH p AS (SELECT feature, date < DATE '1995-06-01' AS old, avg(value) AS mean, stddev_samp(value) AS std FROM {_LB} GROUP BY ALL) SELECT a.feature, round(abs(b.mean - a.mean) / a.std, 5) AS drift, abs(b.mean - a.mean) / a.std > 0.1 AS drifted FROM p a JOIN p b ON a.feature = b.feature AND a.old AND NOT b.old", "bars")(
    lambda t: _rounded(M.drift(M.baseline_profile(t.bars.where("date < '1995-06-01'"), list(_NUM)), M.baseline_profile(t.bars.where("date >= '1995-06-01'"), list(_NUM))), "drift", digits=5)
)

# Joins
_KNOWN = ("AAPL", "TSLA", "V", "VZ")
query("anti_unprocessed", "SELECT path FROM artifacts WHERE modified % 3 <> 0", "artifacts")(lambda t: t.artifacts.withColumn("target", F.replace("path", F.lit("models/"), F.lit("scored/"))).join(t.artifacts.where("modified % 3 = 0").select(F.replace("path", F.lit("models/"), F.lit("scored/")).alias("target")), "target", "left_anti").select("path"))
query("except_files", "SELECT path FROM artifacts EXCEPT SELECT path FROM artifacts WHERE modified % 3 = 0", "artifacts")(lambda t: t.artifacts.select("path").exceptAll(t.artifacts.where("modified % 3 = 0").select("path")))
query("semi_symbols", "SELECT row_id FROM features WHERE symbol IN ('S1', 'S4', 'S7')", "features")(lambda t: t.features.join(F.broadcast(t.spark.createDataFrame([("S1",), ("S4",), ("S7",), ("S77",)], "symbol string")), "symbol", "left_semi").select("row_id"))


def _symbols(t):
    return F.broadcast(t.spark.createDataFrame([(s, i) for i, s in enumerate(_KNOWN)], "symbol string, pos int"))


_ABOUT = (*_KNOWN, *[s for s in T.KEYWORDS if s not in _KNOWN])
_ABOUT_VALUES = "(VALUES " + ", ".join(f"('{s}', {i})" for i, s in enumerate(_ABOUT)) + ") k(symbol, pos)"
_VALUES = "(VALUES " + ", ".join(f"('{s}', {i})" for i, s in enumerate(_KNOWN)) + ") k(symbol, pos)"
query("join_cashtag_multi", f"SELECT tweet_id, symbol FROM tweet_text JOIN {_VALUES} ON contains(upper(text), concat('$', symbol))", "tweet_text")(lambda t: t.tweet_text.join(_symbols(t), F.contains(F.upper("text"), F.concat(F.lit("$"), "symbol"))).select("tweet_id", "symbol"))
_KW = [(s, k) for s in _ABOUT for k in T.KEYWORDS.get(s, ())]
#: Tags of the rules that a post matched, as the stream gives them.
_TAGS = "CASE tweet_id % 6 WHEN 0 THEN 'cashtag_TSLA' WHEN 1 THEN 'financial_keywords,company_MSFT' WHEN 2 THEN 'company_V,cashtag_AAPL,cashtag_NOPE' ELSE '' END"


@query("join_symbol_scored", f"""WITH said AS (SELECT tweet_id, unnest(regexp_extract_all(upper(text), '\\$([A-Z]{{1,5}})', 1)) AS symbol FROM tweet_text),
tags AS (SELECT tweet_id, unnest(string_split({_TAGS}, ',')) AS tag FROM tweet_text),
e AS (SELECT tweet_id, symbol, 10 AS w FROM said UNION ALL SELECT tweet_id, tag[9:], 9 FROM tags WHERE starts_with(tag, 'cashtag_') UNION ALL SELECT tweet_id, tag[9:], 7 FROM tags WHERE starts_with(tag, 'company_') UNION ALL
SELECT tweet_id, symbol, 5 FROM tweet_text JOIN (VALUES {", ".join(f"('{s}', '{k}')" for s, k in _KW)}) q(symbol, word) ON contains(lower(text), word)),
s AS (SELECT tweet_id, symbol, sum(w) AS score FROM e GROUP BY ALL),
r AS (SELECT tweet_id, symbol, score, row_number() OVER (PARTITION BY tweet_id ORDER BY score DESC, pos) AS k FROM s JOIN {_ABOUT_VALUES} USING (symbol))
SELECT tweet_id, symbol, least(10, score) / 10e0 AS confidence FROM r WHERE k = 1""", "tweet_text")
def join_symbol_scored(t):
    found = t.tweet_text.select("tweet_id", P.best_symbol(F.col("text"), F.split(F.expr(_TAGS), ","), _ABOUT).alias("b"))
    return found.where("b is not null").select("tweet_id", "b.symbol", "b.confidence")


query("join_symbol_first", f"SELECT tweet_id, coalesce(replace(replace(list_filter(string_split({_TAGS}, ','), lambda x: starts_with(x, 'cashtag_') OR starts_with(x, 'company_'))[1], 'cashtag_', ''), 'company_', ''), CASE " + " ".join(f"WHEN contains(upper(text), '${s}') THEN '{s}'" for s in _KNOWN) + " END) AS symbol FROM tweet_text", "tweet_text")(
    lambda t: t.tweet_text.select("tweet_id", P.first_symbol(F.col("text"), F.split(F.expr(_TAGS), ","), _KNOWN).alias("symbol"))
)
query("join_oof_target", "SELECT p.row_id, p.score, e.value AS target FROM preds p JOIN events e ON p.row_id = e.event_id", "preds")(lambda t: t.preds.join(t.events.select(F.col("event_id").alias("row_id"), F.col("value").alias("target")), "row_id").select("row_id", "score", "target"))
_MD5 = "CAST(concat('0x', substr(md5(CAST(row_id AS STRING)), 1, 8)) AS BIGINT)"
query("join_complement", f"SELECT row_id FROM features WHERE {_MD5} % 5 >= 4", "features")(lambda t: t.features.join(t.features.where(O.hash_mod(F.col("row_id"), 5) < 4).select("row_id"), "row_id", "left_anti").select("row_id"))
query("join_completeness", "WITH have AS (SELECT DISTINCT symbol, CASE tweet_id % 3 WHEN 0 THEN '5min' WHEN 1 THEN '10min' ELSE '60min' END AS frame FROM tweets WHERE sentiment_confidence > 0.99) SELECT s.symbol, f.frame FROM (SELECT DISTINCT symbol FROM tweets) s CROSS JOIN (VALUES ('5min'), ('10min'), ('60min')) f(frame) ANTI JOIN have h ON s.symbol = h.symbol AND f.frame = h.frame", "tweets")(
    lambda t: t.tweets.select("symbol").distinct().crossJoin(F.broadcast(t.spark.createDataFrame([("5min",), ("10min",), ("60min",)], "frame string"))).join(t.tweets.where("sentiment_confidence > 0.99").select("symbol", F.when(F.col("tweet_id") % 3 == 0, "5min").when(F.col("tweet_id") % 3 == 1, "10min").otherwise("60min").alias("frame")).distinct(), ["symbol", "frame"], "left_anti")
)
query("join_compare_versions", "SELECT a.job_name, a.v AS v1, b.v AS v2, round(b.v - a.v, 6) AS change FROM (SELECT job_name, max(objective_value) AS v FROM trials WHERE trial_id % 2 = 0 GROUP BY 1) a JOIN (SELECT job_name, max(objective_value) AS v FROM trials WHERE trial_id % 2 = 1 GROUP BY 1) b USING (job_name)", "trials")(
    lambda t: t.trials.where("trial_id % 2 = 0").groupBy("job_name").agg(F.max(_o()).alias("v1")).join(t.trials.where("trial_id % 2 = 1").groupBy("job_name").agg(F.max(_o()).alias("v2")), "job_name").withColumn("change", F.round(F.col("v2") - F.col("v1"), 6))
)

# Windows
def _by_symbol():
    return W.partitionBy("symbol").orderBy("date")


def _full(n):
    w = _by_symbol().rowsBetween(-(n - 1), 0)
    return F.coalesce(F.when(F.count("close").over(w) == n, F.avg("close").over(w)), F.lit(0.0))


def _full_sql(n):
    w = f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"coalesce(CASE WHEN count(close) OVER {w} = {n} THEN avg(close) OVER {w} END, 0)"


query("win_rolling_mean_full", f"SELECT symbol, date, round({_full_sql(9)}, 4) AS mean9 FROM bars", "bars")(lambda t: t.bars.select("symbol", "date", F.round(_full(9), 4).alias("mean9")))
query("win_macd_hist", f"SELECT symbol, date, round(close - {_full_sql(9)}, 4) AS hist FROM bars", "bars")(lambda t: t.bars.select("symbol", "date", F.round(F.col("close") - _full(9), 4).alias("hist")))
_W20 = "(PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
_MID, _DEV = f"CASE WHEN count(close) OVER {_W20} = 20 THEN avg(close) OVER {_W20} ELSE close END", f"CASE WHEN count(close) OVER {_W20} = 20 THEN stddev_samp(close) OVER {_W20} ELSE 0.02e0 * close END"


@query("win_bollinger", f"SELECT symbol, date, round({_MID}, 4) AS mid, round({_MID} + 2 * ({_DEV}), 4) AS upper, round({_MID} - 2 * ({_DEV}), 4) AS lower FROM bars", "bars")
def win_bollinger(t):
    w, close = _by_symbol().rowsBetween(-19, 0), F.col("close")
    ready = F.count("close").over(w) == 20
    mid, dev = F.when(ready, F.avg("close").over(w)).otherwise(close), F.when(ready, F.stddev_samp("close").over(w)).otherwise(0.02 * close)
    return t.bars.select("symbol", "date", F.round(mid, 4).alias("mid"), F.round(mid + 2 * dev, 4).alias("upper"), F.round(mid - 2 * dev, 4).alias("lower"))


query("win_news_lookback", "SELECT symbol, date, round(CASE WHEN count(volume) OVER w = 3 THEN avg(volume) OVER w ELSE 0 END, 4) AS news FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", "bars")(
    lambda t: t.bars.select("symbol", "date", F.round(F.when(F.count("volume").over(_by_symbol().rowsBetween(-2, 0)) == 3, F.avg("volume").over(_by_symbol().rowsBetween(-2, 0))).otherwise(0.0), 4).alias("news"))
)
query("win_cum_return", f"WITH {_NEXT} SELECT symbol, date, round(ln(100) + sum(ln(1 + coalesce(r, 0))) OVER (PARTITION BY symbol ORDER BY date), 5) AS log_price FROM nx", "bars")(
    lambda t: _next_return(t.bars).select("symbol", "date", F.round(F.log(F.lit(100.0)) + F.sum(F.log1p(F.coalesce("r", F.lit(0.0)))).over(_by_symbol()), 5).alias("log_price"))
)
_CENTS = ("high", "low", "volume")
query("win_sequences", "SELECT symbol, date, CAST(len(s) AS INT) AS steps, array_to_string(s, ';') AS sequence FROM (SELECT symbol, date, list(concat_ws(',', " + ", ".join(f"CAST(CAST(round({c} * 100) AS BIGINT) AS STRING)" for c in _CENTS) + ")) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS s FROM bars) WHERE len(s) = 10", "bars")(
    lambda t: O.sequences(t.bars, list(_CENTS), ["symbol"], ["date"]).select("symbol", "date", F.size("sequence").alias("steps"), F.array_join(F.transform("sequence", lambda r: F.array_join(F.transform(r, lambda x: F.round(x * 100).cast("long").cast("string")), ",")), ";").alias("sequence"))
)
query("win_ordered", "SELECT symbol, count(*) FILTER (WHERE d < p) = 0 AS ordered FROM (SELECT symbol, date AS d, lag(date) OVER (PARTITION BY symbol ORDER BY volume, date) AS p FROM bars) GROUP BY symbol", "bars")(
    lambda t: ascending(t.bars.select("symbol", "date", "volume"), "date", ["symbol"], ["volume", "date"])
)
query("win_latest_two", "SELECT symbol, round(max(close) FILTER (WHERE k = 1) - max(close) FILTER (WHERE k = 2), 4) AS change FROM (SELECT symbol, close, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM bars) GROUP BY symbol", "bars")(
    lambda t: t.bars.withColumn("k", F.row_number().over(W.partitionBy("symbol").orderBy(F.desc("date")))).where("k <= 2").groupBy("symbol").agg(F.round(F.max(F.when(F.col("k") == 1, F.col("close"))) - F.max(F.when(F.col("k") == 2, F.col("close"))), 4).alias("change"))
)
_IDX = "ix AS (SELECT symbol, date, row_number() OVER (ORDER BY date, symbol) - 1 AS idx, count(*) OVER () AS n FROM bars)"
query("win_time_split", f"WITH {_IDX} SELECT symbol, date, CASE WHEN idx < floor(n * 0.7e0) THEN 'train' WHEN idx < floor(n * 0.7e0) + floor(n * 0.15e0) THEN 'val' ELSE 'test' END AS split FROM ix", "bars")(lambda t: O.time_split(t.bars.select("symbol", "date"), ["date", "symbol"]).select("symbol", "date", "split"))
query("win_cv_folds", f"""WITH {_IDX}, f AS (SELECT unnest(range(5)) AS fold), j AS (SELECT *, n // 5 AS fs FROM ix CROSS JOIN f)
SELECT symbol, date, CAST(fold AS INT) AS fold, 'train' AS part FROM j WHERE fold = 4 OR idx < (fold + 1) * fs UNION ALL
SELECT symbol, date, CAST(fold AS INT), 'val' FROM j WHERE (fold < 4 AND idx >= (fold + 1) * fs AND idx < (fold + 1) * fs + fs // 2) OR (fold = 4 AND idx >= n - (fs - fs // 2))""", "bars")(lambda t: O.cv_folds(t.bars.select("symbol", "date"), ["date", "symbol"]).select("symbol", "date", "fold", "part"))


@query("win_walk_forward", """WITH s AS (SELECT min(date) AS a, max(date) AS z FROM bars), f AS (SELECT CAST(fold AS INT) AS fold, z, a + to_months(CAST(6 * fold AS INT)) AS t0, a + to_months(CAST(6 * fold + 6 AS INT)) AS t1, a + to_months(CAST(6 * fold + 12 AS INT)) AS t2
FROM (SELECT a, z, unnest(range(date_diff('month', a, z) // 6 + 2)) AS fold FROM s))
SELECT fold, symbol, date, CASE WHEN date < t1 THEN 'train' ELSE 'val' END AS part FROM f JOIN bars ON date >= t0 AND date < t2 WHERE fold = 0 OR t1 <= z""", "bars")
def win_walk_forward(t):
    """Folds of six months' training and six months' validation, each six months on, for as long as there are days to validate."""
    span = t.bars.agg(F.min("date").alias("a"), F.max("date").alias("z"))
    folds = span.withColumn("fold", F.explode(F.sequence(F.lit(0), F.floor(F.months_between("z", "a") / 6).cast("int") + 1)))
    folds = folds.select("fold", "z", *[F.add_months("a", F.col("fold") * 6 + 6 * k).alias(f"t{k}") for k in range(3)]).where("fold = 0 or t1 <= z")
    return t.bars.join(F.broadcast(folds), (F.col("date") >= F.col("t0")) & (F.col("date") < F.col("t2"))).select("fold", "symbol", "date", F.when(F.col("date") < F.col("t1"), "train").otherwise("val").alias("part"))


@query("win_lagged_returns", "WITH r AS (SELECT symbol, date, " + ", ".join(f"lag(close, 1) OVER w / lag(close, {k + 1}) OVER w - 1 AS r{k}" for k in (1, 3, 5)) + " FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)) SELECT a.symbol, a.date, round(a.r1, 5) AS ret_1d_lag1, round(a.r3, 5) AS ret_3d_lag1, round(a.r5, 5) AS ret_5d_lag1, round(a.r1 - b.r1, 5) AS relative FROM r a LEFT JOIN r b ON b.symbol = 'S0' AND a.date = b.date", "bars")
def win_lagged_returns(t):
    r = t.bars.select("symbol", "date", *[(F.lag("close", 1).over(_by_symbol()) / F.lag("close", k + 1).over(_by_symbol()) - 1).alias(f"r{k}") for k in (1, 3, 5)])
    index = r.where("symbol = 'S0'").select("date", F.col("r1").alias("base"))
    return r.join(index, "date", "left").select("symbol", "date", *[F.round(f"r{k}", 5).alias(f"ret_{k}d_lag1") for k in (1, 3, 5)], F.round(F.col("r1") - F.col("base"), 5).alias("relative"))


# Order, limits, sets
query("sort_by_date", "SELECT symbol, date FROM bars ORDER BY date, symbol", "bars")(lambda t: t.bars.select("symbol", "date").orderBy("date", "symbol"))
query("topk_trials", "SELECT trial_id, objective_value, row_number() OVER (ORDER BY objective_value DESC, trial_id) AS rank FROM trials WHERE objective_value IS NOT NULL ORDER BY objective_value DESC, trial_id LIMIT 10", "trials")(
    lambda t: t.trials.where(_o().isNotNull()).orderBy(F.desc("objective_value"), "trial_id").limit(10).select("trial_id", "objective_value", F.row_number().over(W.orderBy(F.desc("objective_value"), "trial_id")).alias("rank"))
)
query("topk_universe", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")(lambda t: t.part.orderBy(F.desc("p_retailprice"), "p_partkey").limit(10).select("p_partkey", "p_retailprice"))
query("topk_features", f"SELECT feature, round(avg(abs(value)), 4) AS importance FROM {_LB} GROUP BY feature HAVING avg(abs(value)) >= 0.01 ORDER BY 2 DESC, 1 LIMIT 10", "bars")(lambda t: M.long_form(t.bars, list(_NUM)).groupBy("feature").agg(F.round(F.avg(F.abs("value")), 4).alias("importance")).where("importance >= 0.01").orderBy(F.desc("importance"), "feature").limit(10))
query("sort_newest_jobs", "SELECT job_name, max(creation_time) AS newest FROM trials GROUP BY job_name ORDER BY 2 DESC, 1", "trials")(lambda t: t.trials.groupBy("job_name").agg(F.max("creation_time").alias("newest")).orderBy(F.desc("newest"), "job_name"))
query("sort_largest_artifacts", "SELECT path, size FROM artifacts ORDER BY size DESC, path", "artifacts")(lambda t: t.artifacts.select("path", "size").orderBy(F.desc("size"), "path"))
query("topk_recent", "SELECT path, modified FROM artifacts ORDER BY modified DESC LIMIT 5", "artifacts")(lambda t: t.artifacts.select("path", "modified").orderBy(F.desc("modified")).limit(5))
query("latest_row", "SELECT max(modified) AS modified, max_by(path, modified) AS path FROM artifacts", "artifacts")(lambda t: t.artifacts.agg(F.max("modified").alias("modified"), F.max_by("path", "modified").alias("path")))
query("best_model", "SELECT job_name, max(objective_value) AS best, arg_max(trial_id, (objective_value, -trial_id)) AS trial_id FROM trials WHERE objective_value IS NOT NULL GROUP BY job_name", "trials")(lambda t: t.trials.where(_o().isNotNull()).groupBy("job_name").agg(F.max(_o()).alias("best"), F.max_by("trial_id", F.struct("objective_value", -F.col("trial_id"))).alias("trial_id")))
query("latest_qualifying_run", "SELECT job_name, newest FROM (SELECT job_name, max(creation_time) AS newest, count(objective_value) AS done FROM trials WHERE starts_with(data_source, 's3://') GROUP BY job_name) WHERE done >= 100 ORDER BY newest DESC, job_name LIMIT 1", "trials")(
    lambda t: t.trials.where(F.startswith("data_source", F.lit("s3://"))).groupBy("job_name").agg(F.max("creation_time").alias("newest"), F.count(_o()).alias("done")).where("done >= 100").orderBy(F.desc("newest"), "job_name").limit(1).select("job_name", "newest")
)
query("limit_files", "SELECT path FROM artifacts ORDER BY path LIMIT 20", "artifacts")(lambda t: t.artifacts.select("path").orderBy("path").limit(20))
query("src_sample_head", "SELECT row_id, f_median FROM features ORDER BY row_id LIMIT 1000", "features")(lambda t: t.features.select("row_id", "f_median").orderBy("row_id").limit(1000))
query("union_symbols", "SELECT symbol, CAST(date AS DATE) AS date, volume AS value FROM bars UNION ALL SELECT symbol, CAST(created_at AS DATE), sentiment_positive FROM tweets", ("bars", "tweets"))(lambda t: t.bars.select("symbol", "date", F.col("volume").cast("double").alias("value")).unionByName(t.tweets.select("symbol", F.to_date("created_at").alias("date"), F.col("sentiment_positive").alias("value"))))
query("distinct_dates", "SELECT DISTINCT symbol, date FROM bars", "bars")(lambda t: t.bars.select("symbol", "date").distinct())
query("subset_check", "SELECT model, count(*) FILTER (WHERE label NOT IN (0, 1)) = 0 AS valid FROM preds GROUP BY model", "preds")(lambda t: t.preds.groupBy("model").agg((F.size(F.array_except(F.collect_set("label"), F.array(F.lit(0), F.lit(1)))) == 0).alias("valid")))


@query("schema_diff", "SELECT row_id, symbol, CAST(NULL AS DOUBLE) AS sent_5m, CAST(NULL AS DOUBLE) AS sent_daily FROM features", "features")
def schema_diff(t):
    """Required columns that the table lacks, added as nulls without doubling any."""
    need = ["row_id", "symbol", "sent_5m", "sent_daily"]
    have = t.features.select("row_id", "symbol")
    return have.select("*", *[F.lit(None).cast("double").alias(c) for c in need if c not in have.columns])
