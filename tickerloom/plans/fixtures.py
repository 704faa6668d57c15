"""Views over the given tables, one text each for Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "tweets": ("events", """
SELECT event_id AS tweet_id, ts AS created_at, concat('S', CAST(user_id % 10 AS STRING)) AS symbol,
       CAST(k AS DOUBLE) / 100 AS sentiment_positive,
       CAST(100 - k AS DOUBLE) * 0.6e0 / 100 AS sentiment_negative,
       CAST(100 - k AS DOUBLE) * 0.4e0 / 100 AS sentiment_neutral,
       CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 0e0
            ELSE least(value / 500, 1e0) END AS sentiment_confidence,
       event_id % 50 AS retweet_count, event_id % 101 AS like_count,
       event_id % 7 AS reply_count, event_id % 3 AS quote_count
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM {events}) e"""),
    "tweet_text": ("documents", """
SELECT doc_id AS tweet_id,
       concat('$', CASE doc_id % 4 WHEN 0 THEN 'AAPL' WHEN 1 THEN 'V' WHEN 2 THEN 'tsla' ELSE 'VZ' END,
              ' ', coalesce(text, ''), ' http://x.co/', CAST(doc_id AS STRING),
              ' @user', CAST(doc_id % 7 AS STRING), ' #tag', CAST(doc_id % 5 AS STRING),
              CASE WHEN doc_id % 3 = 0 THEN ' buy strong rally' WHEN doc_id % 3 = 1 THEN ' sell weak' ELSE '' END) AS text,
       lang, doc_id % 9 AS retweet_count, doc_id % 4 AS like_count
FROM {documents}"""),
    "bars": ("lineitem", """
SELECT concat('S', CAST(l_suppkey % 10 AS STRING)) AS symbol, CAST(l_shipdate AS DATE) AS date,
       avg(l_extendedprice / l_quantity) AS open, max(l_extendedprice / l_quantity) AS high,
       min(l_extendedprice / l_quantity) AS low, sum(l_extendedprice) / sum(l_quantity) AS close,
       sum(l_quantity) AS volume
FROM {lineitem} GROUP BY 1, 2"""),
    "features": ("orders", """
SELECT o_orderkey AS row_id, concat('S', CAST(o_custkey % 10 AS STRING)) AS symbol,
       CASE WHEN o_orderkey % 211 = 0 THEN 'date' WHEN o_orderkey % 223 = 0 THEN ' '
            WHEN o_orderkey % 227 = 0 THEN 'bad' ELSE concat(' ', CAST(CAST(o_orderdate AS DATE) AS STRING)) END AS date,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS f_median,
       CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE NULL END AS f_sparse,
       1e0 AS f_const,
       CASE WHEN o_orderkey % 301 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE CAST(o_custkey AS DOUBLE) END AS f_inf,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS f_text,
       CASE WHEN o_orderkey % 101 = 0 THEN 'n/a' ELSE CAST((o_orderkey * 7919 % 1000) - 480 AS STRING) END AS target_next_day
FROM {orders}"""),
    "trials": ("orders", """
SELECT concat('job-', CAST(o_custkey % 12 AS STRING)) AS job_name, o_orderkey AS trial_id,
       CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Failed' ELSE 'InProgress' END AS status,
       o_orderdate AS creation_time,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 500000 ELSE NULL END AS objective_value,
       concat('s3://bucket/', CAST(o_custkey % 5 AS STRING)) AS data_source,
       CASE o_orderkey % 4 WHEN 0 THEN 'ECR pull failed' WHEN 1 THEN 'no capacity' WHEN 2 THEN 'bad S3 data' ELSE '' END AS failure_reason
FROM {orders}"""),
    "preds": ("events", """
SELECT event_id AS row_id, event_type AS model, floor(value / 5) / 100 AS score,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 2 AS label
FROM {events}"""),
    "artifacts": ("pages", """
SELECT concat('models/m', CAST(page_id % 40 AS STRING), '/f', CAST(page_id AS STRING),
              CASE page_id % 6 WHEN 0 THEN '.csv' WHEN 1 THEN '.json' WHEN 2 THEN '.pkl' WHEN 3 THEN '.tar.gz' WHEN 4 THEN '.log' ELSE '.txt' END) AS path,
       length(html) AS size, page_id AS modified
FROM {pages}"""),
    "results": ("orders", """
SELECT concat(CASE o_orderkey % 4 WHEN 0 THEN 'lightgbm' WHEN 1 THEN 'xgboost' WHEN 2 THEN 'lstm' ELSE 'gru' END, '_S', CAST(o_custkey % 60 AS STRING), '.json') AS file,
       o_orderkey % 30 AS trials, o_totalprice / 500000 AS best_value, o_orderkey AS row_id
FROM {orders}"""),
}


class Tables:
    """The given tables and the views over them, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            base, text = VIEWS[name]
            return self.spark.sql(text, **{base: getattr(self, base)})
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def with_views(sql: str, views: tuple[str, ...]) -> str:
    """The SQL with the views that it uses before it."""
    heads = [f"{v} AS ({VIEWS[v][1].format(**{VIEWS[v][0]: VIEWS[v][0]})})" for v in views]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join([*heads, body[5:]])
    return ("WITH " + ",\n".join(heads) + "\n" if heads else "") + body
