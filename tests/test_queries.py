"""Every registered query runs; those with SQL give DuckDB's rows."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, same_rows
from tickerloom.plans import QUERIES, SQL
from tickerloom.plans.fixtures import Tables


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(name, spark, duck, tmp_path):
    same_rows(spark, duck, QUERIES[name](spark, SF_DIR), SQL[name], f"{tmp_path}/out")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_stream_windows_are_those_of_the_batch(spark):
    """Closed windows: those that end by the last post's time less the ten minutes that rows may be late."""
    posts = Tables(spark, SF_DIR).tweets.withColumn("created_at", F.col("created_at").cast("timestamp"))
    last = posts.agg(F.max("created_at")).first()[0]
    c = ("sentiment_positive", "sentiment_negative", "sentiment_confidence")
    means = posts.groupBy("symbol", F.window("created_at", "60 minutes").alias("w")).agg(*[F.avg(x).alias(x) for x in c]).where("sentiment_confidence > 0")
    want = {(r.symbol, r.w.start): max(-1, min(1, (r[c[0]] - r[c[1]]) * r[c[2]])) for r in means.collect() if r.w.end <= last - datetime.timedelta(minutes=10)}
    got = {(r.symbol, r.start): r.value for r in QUERIES["st_sent_windows"](spark, SF_DIR).where("width = 60").collect()}
    assert len(want) > 100 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
