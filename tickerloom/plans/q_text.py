"""Queries: cleaning, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.functions import text as T
from tickerloom.operators import table as O
from tickerloom.plans.registry import query

_T = "tweet_text"


def _has(phrases, col="lower(text)"):
    return " + ".join(f"CAST(contains({col}, '{p}') AS INT)" for p in phrases)


query("fn_clean_text", r"SELECT tweet_id, trim(regexp_replace(regexp_replace(text, 'https?://[^\s]+', '', 'g'), '\s+', ' ', 'g')) AS clean FROM tweet_text", _T)(
    lambda t: t.tweet_text.select("tweet_id", T.clean_text(F.col("text")).alias("clean"))
)
query("fn_cashtags", r"SELECT tweet_id, array_to_string(regexp_extract_all(upper(text), '\$([A-Z]{1,5})', 1), ',') AS tags FROM tweet_text", _T)(
    lambda t: t.tweet_text.select("tweet_id", F.array_join(T.cashtags(F.col("text")), ",").alias("tags"))
)
query("fn_hashtags", r"SELECT tweet_id, array_to_string(list_transform(regexp_extract_all(text, '#\w+'), lambda x: lower(x)), ',') AS tags FROM tweet_text", _T)(
    lambda t: t.tweet_text.select("tweet_id", F.array_join(T.hashtags(F.col("text")), ",").alias("tags"))
)


@query("fn_indicators", f"SELECT *, bullish - bearish AS net FROM (SELECT tweet_id, {_has(T.BULLISH)} AS bullish, {_has(T.BEARISH)} AS bearish FROM tweet_text)", _T)
def fn_indicators(t):
    return t.tweet_text.select("tweet_id", T.hits(F.col("text"), T.BULLISH).alias("bullish"), T.hits(F.col("text"), T.BEARISH).alias("bearish")).withColumn("net", F.col("bullish") - F.col("bearish"))


_W = "(3 * retweet_count + 2 * quote_count + 1.5e0 * reply_count + like_count)"


@query("fn_engagement", f"SELECT tweet_id, round(CASE WHEN {_W} = 0 THEN 0 ELSE least(1e0, log10({_W} + 1) / log10(1001)) END, 6) AS engagement FROM tweets", "tweets")
def fn_engagement(t):
    return t.tweets.select("tweet_id", F.round(T.engagement(*map(F.col, ("retweet_count", "quote_count", "reply_count", "like_count"))), 6).alias("engagement"))


@query("fn_virality", "SELECT tweet_id, round(CASE WHEN like_count = 0 THEN 0 ELSE least(1e0, retweet_count * 1e0 / like_count / 0.3e0) END, 6) AS virality FROM tweets", "tweets")
def fn_virality(t):
    return t.tweets.select("tweet_id", F.round(T.virality(F.col("retweet_count"), F.col("like_count")), 6).alias("virality"))


@query("fn_partition_key", "SELECT tweet_id, symbol, CAST(year(created_at) AS INT) AS y, CAST(month(created_at) AS INT) AS m, CAST(day(created_at) AS INT) AS d, CAST(hour(created_at) AS INT) AS h FROM tweets", "tweets")
def fn_partition_key(t):
    c = F.col("created_at")
    return t.tweets.select("tweet_id", "symbol", F.year(c).alias("y"), F.month(c).alias("m"), F.dayofmonth(c).alias("d"), F.hour(c).alias("h"))


@query("fn_parse_iso", "SELECT tweet_id, CAST(epoch(date_trunc('second', created_at)) AS BIGINT) AS seconds FROM tweets", "tweets")
def fn_parse_iso(t):
    iso = F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return t.tweets.select("tweet_id", F.unix_timestamp(F.try_to_timestamp(iso)).alias("seconds"))


@query("fn_softmax_label", """
WITH z AS (SELECT tweet_id, sentiment_positive * 3 AS a, sentiment_negative * 3 AS b, sentiment_neutral * 3 AS c FROM tweets),
e AS (SELECT tweet_id, exp(a - greatest(a, b, c)) AS a, exp(b - greatest(a, b, c)) AS b, exp(c - greatest(a, b, c)) AS c FROM z),
p AS (SELECT tweet_id, a / (a + b + c) AS a, b / (a + b + c) AS b, c / (a + b + c) AS c FROM e)
SELECT tweet_id, round(a, 6) AS p_positive, round(b, 6) AS p_negative, CASE WHEN a >= b AND a >= c THEN 'positive' WHEN b >= c THEN 'negative' ELSE 'neutral' END AS label, round(greatest(a, b, c), 6) AS confidence FROM p""", "tweets")
def fn_softmax_label(t):
    p = T.softmax(F.array(*[F.col(f"sentiment_{k}") * 3 for k in ("positive", "negative", "neutral")]))
    rows = t.tweets.select("tweet_id", p.alias("p"))
    label = F.element_at(F.array(F.lit("positive"), F.lit("negative"), F.lit("neutral")), F.array_position("p", F.array_max("p")).cast("int"))
    return rows.select("tweet_id", F.round(F.col("p")[0], 6).alias("p_positive"), F.round(F.col("p")[1], 6).alias("p_negative"), label.alias("label"), F.round(F.array_max("p"), 6).alias("confidence"))


_L = "(SELECT tweet_id, CASE WHEN tweet_id % 4 = 0 THEN 'positive' WHEN tweet_id % 4 = 1 THEN 'negative' WHEN tweet_id % 4 = 2 THEN 'neutral' END AS label, sentiment_positive AS score FROM tweets)"


@query("fn_label_to_scores", f"""
SELECT tweet_id, CASE WHEN label = 'positive' THEN score ELSE 0 END AS positive, CASE WHEN label = 'negative' THEN score WHEN label = 'neutral' THEN round(1 - score, 6) ELSE 0 END AS negative,
CASE WHEN label IS NULL THEN 1 WHEN label = 'neutral' THEN score ELSE round(1 - score, 6) END AS neutral FROM {_L}""", "tweets")
def fn_label_to_scores(t):
    label = F.when(F.col("tweet_id") % 4 == 0, "positive").when(F.col("tweet_id") % 4 == 1, "negative").when(F.col("tweet_id") % 4 == 2, "neutral")
    s = T.label_scores(label, F.col("sentiment_positive"))
    return t.tweets.select("tweet_id", *[F.round(s[k], 6).alias(k) for k in ("positive", "negative", "neutral")])


_UP, _DOWN = "contains(lower(text), 'positive')", "contains(lower(text), 'negative')"
_R = "(SELECT tweet_id, concat(text, CASE tweet_id % 3 WHEN 0 THEN ' Positive' WHEN 1 THEN ' NEGATIVE' ELSE '' END) AS text FROM tweet_text)"


@query("fn_parse_response", f"""
SELECT tweet_id, CASE WHEN {_UP} THEN 'positive' WHEN {_DOWN} THEN 'negative' ELSE 'neutral' END AS label, CASE WHEN {_UP} THEN 0.8e0 WHEN {_DOWN} THEN 0.05e0 ELSE 0.25e0 END AS positive,
CASE WHEN {_UP} OR {_DOWN} THEN 0.15e0 ELSE 0.5e0 END AS neutral, CASE WHEN {_UP} THEN 0.05e0 WHEN {_DOWN} THEN 0.8e0 ELSE 0.25e0 END AS negative, CASE WHEN {_UP} OR {_DOWN} THEN 0.8e0 ELSE 0.5e0 END AS confidence FROM {_R}""", _T)
def fn_parse_response(t):
    said = F.concat("text", F.when(F.col("tweet_id") % 3 == 0, " Positive").when(F.col("tweet_id") % 3 == 1, " NEGATIVE").otherwise(""))
    return t.tweet_text.select("tweet_id", *[c.alias(k) for k, c in T.parse_response(said).items()])


_PROMPT = "Analyze the sentiment of this financial tweet and classify it as positive, negative, or neutral.\n\nTweet: %s\n\nSentiment:"  # fixed value
query("fn_prompt", f"SELECT tweet_id, concat('{_PROMPT.split('%s')[0]}', text, '{_PROMPT.split('%s')[1]}') AS prompt FROM tweet_text", _T)(lambda t: t.tweet_text.select("tweet_id", F.concat(F.lit(_PROMPT.split("%s")[0]), "text", F.lit(_PROMPT.split("%s")[1])).alias("prompt")))
query("fn_truncate", "SELECT doc_id, substr(trim(text), 1, 512) AS head FROM documents")(lambda t: t.documents.select("doc_id", F.substring(F.trim("text"), 1, 512).alias("head")))
query("fn_path_rewrite", "SELECT path, concat(replace(path, 'models/', 'scored/'), '.scored') AS target FROM artifacts", "artifacts")(lambda t: t.artifacts.select("path", F.concat(F.replace("path", F.lit("models/"), F.lit("scored/")), F.lit(".scored")).alias("target")))
query("fn_file_keys", "SELECT row_id, split_part(file, '_', 1) AS model, replace(split_part(file, '_', 2), '.json', '') AS symbol FROM results", "results")(
    lambda t: t.results.select("row_id", F.split_part("file", F.lit("_"), F.lit(1)).alias("model"), F.replace(F.split_part("file", F.lit("_"), F.lit(2)), F.lit(".json"), F.lit("")).alias("symbol"))
)
query("fn_format_size", "SELECT path, CASE WHEN size < 1024 THEN concat(CAST(size AS STRING), ' B') WHEN size < 1048576 THEN concat(printf('%.1f', floor(size / 1024e0 * 10 + 0.5e0) / 10), ' KB') ELSE concat(printf('%.1f', floor(size / 1048576e0 * 10 + 0.5e0) / 10), ' MB') END AS shown FROM artifacts", "artifacts")(
    lambda t: t.artifacts.select("path", T.format_size(F.col("size")).alias("shown"))
)
query("fn_format_duration", "SELECT row_id, CASE WHEN row_id < 60 THEN printf('%.0fs', row_id * 1e0) WHEN row_id < 3600 THEN printf('%.1fm', floor(row_id / 60e0 * 10 + 0.5e0) / 10) ELSE printf('%.1fh', floor(row_id / 3600e0 * 10 + 0.5e0) / 10) END AS shown FROM results", "results")(
    lambda t: t.results.select("row_id", T.format_duration(F.col("row_id")).alias("shown"))
)
query("fn_clip", "SELECT tweet_id, CASE WHEN sentiment_confidence IS NULL THEN NULL ELSE greatest(0.2e0, least(0.8e0, sentiment_confidence)) END AS x FROM tweets", "tweets")(lambda t: t.tweets.select("tweet_id", T.clip(F.col("sentiment_confidence"), 0.2, 0.8).alias("x")))
query("fn_business_days", "WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z FROM orders), d AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM b) SELECT day FROM d WHERE isodow(day) < 6")(
    lambda t: t.orders.agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("z")).select(F.explode(F.sequence("a", "z")).alias("day")).where(F.weekday("day") < 5)
)
query("fn_json_metrics", "SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k, coalesce(CAST(json_extract(props, '$.likes') AS BIGINT), 0) AS likes FROM events")(
    lambda t: t.events.withColumn("j", F.from_json("props", "k BIGINT, likes BIGINT")).select("event_id", F.coalesce("j.k", F.lit(0)).alias("k"), F.coalesce("j.likes", F.lit(0)).alias("likes"))
)


@query("fn_array_tags", "SELECT tweet_id, concat('cashtag_', symbol, ',company_', symbol) AS tags FROM tweets", "tweets")
def fn_array_tags(t):
    rules = F.array(*[F.struct(F.lit(i).alias("id"), F.concat(F.lit(kind), "symbol").alias("tag")) for i, kind in enumerate(("cashtag_", "company_"))])
    return t.tweets.select("tweet_id", F.array_join(F.transform(rules, lambda r: r.tag), ",").alias("tags"))



# Cleaning and predicates
_DATE = "features_d AS (SELECT * REPLACE (TRY_CAST(trim(date) AS DATE) AS date) FROM features WHERE lower(trim(date)) NOT IN ('date', '', 'nan') AND TRY_CAST(trim(date) AS DATE) IS NOT NULL)"
_FD = f"WITH {_DATE} "


def _features(t):
    return O.clean_date(t.features)


query("clean_date", _FD + "SELECT row_id, date FROM features_d", "features")(lambda t: _features(t).select("row_id", "date"))
query("filter_date_range", _FD + "SELECT row_id, date FROM features_d WHERE date BETWEEN DATE '1994-01-01' AND DATE '1995-06-30'", "features")(lambda t: _features(t).where(F.col("date").between("1994-01-01", "1995-06-30")).select("row_id", "date"))
query("default_lookback_365", _FD + "SELECT row_id, date FROM features_d WHERE date BETWEEN DATE '1998-01-01' - 365 AND DATE '1998-01-01'", "features")(
    lambda t: _features(t).where(F.col("date").between(F.date_sub(F.lit("1998-01-01").cast("date"), 365), F.lit("1998-01-01").cast("date"))).select("row_id", "date")
)
query("filter_symbol", "SELECT row_id, symbol FROM features WHERE symbol = 'S3'", "features")(lambda t: t.features.where("symbol = 'S3'").select("row_id", "symbol"))
query("select_features", "SELECT row_id, f_median, f_sparse, f_const, f_inf FROM features", "features")(lambda t: O.select_features(t.features, ("date", "symbol", "f_text", "target_next_day")))
query("project_simple_n", "SELECT target_next_day AS label, f_median, f_sparse, f_const, f_inf, f_text FROM features", "features")(lambda t: t.features.select(F.col("target_next_day").alias("label"), *[c for c in t.features.columns if c.startswith("f_")][:5]))
query("label_first", "SELECT target_next_day, row_id, symbol FROM features", "features")(lambda t: O.label_first(t.features.select("row_id", "symbol", "target_next_day"), "target_next_day"))
query("drop_sparse_columns", "SELECT row_id, f_median, f_const FROM features", "features")(lambda t: O.drop_sparse(t.features.select("row_id", "f_median", "f_sparse", "f_const"), ["f_median", "f_sparse", "f_const"]))
query("impute_median", "SELECT row_id, round(coalesce(f_median, (SELECT quantile_cont(f_median, 0.5) FROM features)), 4) AS f_median FROM features", "features")(lambda t: O.impute_median(t.features.select("row_id", "f_median"), ["f_median"]).withColumn("f_median", F.round("f_median", 4)))
query("impute_ffill", "SELECT row_id, symbol, last_value(f_text IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f_text FROM features", "features")(
    lambda t: O.impute_ffill(t.features.select("row_id", "symbol", "f_text"), ["f_text"], ["symbol"], ["row_id"])
)
query("impute_group_mean", "SELECT row_id, symbol, round(coalesce(f_median, avg(f_median) OVER (PARTITION BY symbol)), 2) AS f_median FROM features", "features")(
    lambda t: O.impute_group_mean(t.features.select("row_id", "symbol", "f_median"), ["f_median"], ["symbol"]).select("row_id", "symbol", F.round("f_median", 2).alias("f_median"))
)
query("impute_zero", "SELECT row_id, coalesce(f_sparse, 0) AS f_sparse FROM features", "features")(lambda t: t.features.select("row_id", "f_sparse").fillna(0, ["f_sparse"]))
query("drop_any_null", "SELECT row_id FROM features WHERE f_median IS NOT NULL AND f_text IS NOT NULL", "features")(lambda t: O.drop_any_null(t.features, ["f_median", "f_text"]).select("row_id"))
query("inf_to_zero", "SELECT row_id, CASE WHEN isinf(f_inf) THEN 0 ELSE f_inf END AS f_inf FROM features WHERE f_median IS NOT NULL", "features")(lambda t: O.infinite_to_zero(O.drop_any_null(t.features, ["f_median"]), ["f_inf"]).select("row_id", "f_inf"))
query("numeric_coerce_target", "SELECT row_id, TRY_CAST(target_next_day AS DOUBLE) AS target_next_day FROM features WHERE TRY_CAST(target_next_day AS DOUBLE) IS NOT NULL", "features")(lambda t: O.numeric_target(t.features, "target_next_day").select("row_id", "target_next_day"))
query("label_positive_return", "SELECT row_id, CAST(TRY_CAST(target_next_day AS DOUBLE) > 0 AS INT) AS target_binary FROM features WHERE TRY_CAST(target_next_day AS DOUBLE) IS NOT NULL", "features")(
    lambda t: O.numeric_target(t.features, "target_next_day").select("row_id", (F.col("target_next_day") > 0).cast("int").alias("target_binary"))
)
query("label_fallback", "SELECT row_id, CAST(TRY_CAST(target_next_day AS DOUBLE) > 0 AS INT) AS label FROM features", "features")(lambda t: O.label_column(t.features.select("row_id", F.col("target_next_day").try_cast("double").alias("return_1d"))).select("row_id", "label"))
query("filter_news_threshold", "SELECT row_id FROM (SELECT row_id, abs(f_median) > 250000 AS far, count(*) FILTER (WHERE abs(f_median) > 250000) OVER () AS n FROM features) WHERE far OR n <= 100", "features")(
    lambda t: t.features.withColumn("far", F.abs("f_median") > 250000).crossJoin(F.broadcast(t.features.agg(F.count_if(F.abs("f_median") > 250000).alias("n")))).where("far or n <= 100").select("row_id")
)
_MEASURES = "p_partkey, p_size * 1e5 AS avg_stock_vol, p_size * 1e2 AS avg_option_vol, (p_partkey % 100) / 100e0 AS iv_rank_pct, p_retailprice * 2e0 AS open_interest, (p_partkey % 7) / 1000e0 AS bid_ask_spread, (p_partkey % 9) / 100e0 AS atr_close_ratio, p_partkey % 41 + 10e0 AS adx, p_retailprice * 4e6 AS market_cap, p_size * 1e6 AS free_float, p_retailprice / 100e0 AS close, p_partkey % 5 AS num_expirations, p_partkey % 12 AS strikes_per_expiry"
query("filter_universe", f"SELECT p_partkey FROM (SELECT {_MEASURES} FROM part) WHERE " + " AND ".join(f"{c} {'<' if c == 'bid_ask_spread' else '>='} {b}" for c, b in O.UNIVERSE.items()))(
    lambda t: O.universe(t.part.selectExpr(*[x.strip() for x in _MEASURES.split(", ")])).select("p_partkey")
)


@query("project_tweet", "SELECT tweet_id, symbol AS primary_symbol, coalesce(retweet_count, 0) AS retweet_count, coalesce(like_count, 0) AS like_count, 0 AS quote_count FROM tweets", "tweets")
def project_tweet(t):
    raw = t.tweets.select("tweet_id", F.col("symbol").alias("primary_symbol"), F.struct("retweet_count", "like_count", F.lit(None).cast("int").alias("quote_count")).alias("public_metrics"))
    return raw.select("tweet_id", "primary_symbol", *[F.coalesce(f"public_metrics.{c}", F.lit(0)).alias(c) for c in ("retweet_count", "like_count", "quote_count")])


@query("validate_tweet", "SELECT row_id, coalesce(f_text, '') <> '' AND TRY_CAST(trim(date) AS TIMESTAMP) IS NOT NULL AS valid, CASE WHEN coalesce(f_text, '') = '' THEN 'missing text' WHEN TRY_CAST(trim(date) AS TIMESTAMP) IS NULL THEN 'bad time' END AS reason FROM features", "features")
def validate_tweet(t):
    missing, bad = F.coalesce("f_text", F.lit("")) == "", F.try_to_timestamp(F.trim("date")).isNull()
    return t.features.select("row_id", (~missing & ~bad).alias("valid"), F.when(missing, "missing text").when(bad, "bad time").alias("reason"))


_WORDS = r"string_split(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), ' ')"
query("filter_quality_tweet", f"SELECT tweet_id FROM tweet_text WHERE length(text) BETWEEN 20 AND 280 AND retweet_count + like_count >= 2 AND {_has(T.SPAM)} = 0 AND len(list_distinct({_WORDS})) >= 0.5 * len({_WORDS})", _T)(
    lambda t: t.tweet_text.where(T.is_quality(F.col("text"), F.col("retweet_count") + F.col("like_count"))).select("tweet_id")
)
_SYMBOLS = ("AAPL", "TSLA", "V")


@query("filter_stream_rules", "SELECT tweet_id, concat_ws(',', " + ", ".join(f"CASE WHEN contains(upper(text), '${s}') THEN 'cashtag_{s}' END" for s in _SYMBOLS) + ", CASE WHEN (" + " OR ".join(f"contains(upper(text), '${s}')" for s in _SYMBOLS) + f") AND {_has(T.FINANCE)} > 0 THEN 'financial_keywords' END) AS tags FROM tweet_text WHERE lang = 'en'", _T)
def filter_stream_rules(t):
    up = F.upper("text")
    cash = [F.contains(up, F.lit(f"${s}")) for s in _SYMBOLS]
    some = cash[0] | cash[1] | cash[2]
    tags = F.array_compact(F.array(*[F.when(c, f"cashtag_{s}") for c, s in zip(cash, _SYMBOLS)], F.when(some & (T.hits(F.col("text"), T.FINANCE) > 0), "financial_keywords")))
    return t.tweet_text.where("lang = 'en'").select("tweet_id", F.array_join(tags, ",").alias("tags"))


query("filter_trials", "SELECT trial_id FROM trials WHERE contains(lower(job_name), 'job-1') AND status = 'Completed'", "trials")(lambda t: t.trials.where(F.contains(F.lower("job_name"), F.lit("job-1")) & (F.col("status") == "Completed")).select("trial_id"))
query("filter_glob", r"SELECT path FROM artifacts WHERE path GLOB 'models/m1*.pkl' OR path GLOB '*.csv'", "artifacts")(lambda t: t.artifacts.where(O.glob_match(F.col("path"), ("models/m1*.pkl", "*.csv"))).select("path"))
_KIND = (("Pickle", (".pkl",)), ("Joblib", (".joblib",)), ("Compressed", (".tar.gz",)), ("Deep Learning", (".h5", ".pt", ".pth")), ("ONNX", (".onnx",)))  # fixed values
_ARTIFACT = (".pkl", ".joblib", ".tar.gz", ".zip", ".h5", ".pt", ".pth", ".onnx")  # fixed values


def artifact_kind(path):
    kind = F.lit(None)
    for name, ends in reversed(_KIND):
        test = F.lit(False)
        for e in ends:
            test = test | F.endswith(path, F.lit(e))
        kind = F.when(test, name).otherwise(kind)
    return F.coalesce(kind, F.lit("Other"))


@query("classify_artifact", "SELECT path, CASE " + " ".join("WHEN " + " OR ".join(f"ends_with(path, '{e}')" for e in ends) + f" THEN '{n}'" for n, ends in _KIND) + " ELSE 'Other' END AS kind FROM artifacts WHERE " + " OR ".join(f"ends_with(path, '{e}')" for e in _ARTIFACT), "artifacts")
def classify_artifact(t):
    keep = F.lit(False)
    for e in _ARTIFACT:
        keep = keep | F.endswith("path", F.lit(e))
    return t.artifacts.where(keep).select("path", artifact_kind(F.col("path")).alias("kind"))


@query("classify_failure", "SELECT trial_id, CASE WHEN contains(r, 'ecr') OR contains(r, 'container') THEN 'container' WHEN contains(r, 'resource') OR contains(r, 'capacity') THEN 'resource' WHEN contains(r, 'data') OR contains(r, 's3') THEN 'data' END AS cause FROM (SELECT trial_id, lower(failure_reason) AS r FROM trials)", "trials")
def classify_failure(t):
    has = lambda *w: F.lower("failure_reason").rlike("|".join(w))
    return t.trials.select("trial_id", F.when(has("ecr", "container"), "container").when(has("resource", "capacity"), "resource").when(has("data", "s3"), "data").alias("cause"))


_BAND = "CASE WHEN best >= 0.999 THEN 'suspicious' WHEN best > 0.85 THEN 'high' WHEN best > 0.70 THEN 'good' ELSE 'baseline' END"
query("classify_auc_band", f"SELECT job_name, {_BAND} AS band, mean > 0.90 AS flagged FROM (SELECT job_name, max(objective_value) AS best, avg(objective_value) AS mean FROM trials GROUP BY job_name)", "trials")(
    lambda t: t.trials.groupBy("job_name").agg(F.max("objective_value").alias("best"), F.avg("objective_value").alias("mean")).select("job_name", F.when(F.col("best") >= 0.999, "suspicious").when(F.col("best") > 0.85, "high").when(F.col("best") > 0.70, "good").otherwise("baseline").alias("band"), (F.col("mean") > 0.90).alias("flagged"))
)
query("gate_threshold", "SELECT job_name, max(objective_value) >= 0.60 AND avg(objective_value) > 0.3 AS accepted FROM trials GROUP BY job_name", "trials")(lambda t: t.trials.groupBy("job_name").agg(((F.max("objective_value") >= 0.60) & (F.avg("objective_value") > 0.3)).alias("accepted")))
