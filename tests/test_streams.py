"""Stream jobs: buffers that leave by rows or by the clock, windows of three widths, a log read across restarts."""

from __future__ import annotations

import datetime as dt
import json
import time
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerloom.operators import posts as P
from tickerloom.operators.staging import folder
from tickerloom.streaming import jobs as J
from tickerloom.streaming import log as G


def test_flush_by_rows_or_by_the_clock(spark):
    """250 rows leave as 100, 100 and, once the clock says so, 50, with all their columns."""
    path = folder(spark)
    rows = spark.range(250).select("id", F.timestamp_micros(F.col("id") * 1_000_001).alias("at"), F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("x"), F.array(F.lit("a\"b"), F.col("id").cast("string")).alias("names"))
    rows.coalesce(1).write.parquet(path + "/in")
    stream = J.flushed(J.read_events(spark, path + "/in", rows.schema), rows=100, seconds=3)
    job = stream.writeStream.format("parquet").option("path", path + "/out").option("checkpointLocation", path + "/state").trigger(processingTime="0 seconds").start()
    try:
        J.settle(job)
    finally:
        job.stop()
    out = spark.read.parquet(path + "/out")
    assert sorted((r["reason"], r["count"]) for r in out.groupBy("flush", "reason").count().collect()) == [("rows", 100), ("rows", 100), ("time", 50)]
    assert out.drop("flush", "reason").exceptAll(rows).count() == 0 and out.count() == 250


def test_windows_of_all_widths_over_several_batches(spark):
    """Six files, a batch each; the last brings posts that are too late and don't count. Every width is the batch's."""
    path = folder(spark)
    start = dt.datetime(2024, 1, 1)
    kind = "created_at timestamp, symbol string, sentiment_positive double, sentiment_negative double, sentiment_confidence double"
    rows = [(start + dt.timedelta(minutes=2 * i), "ab"[i % 2], (i % 10) / 10, (i % 7) / 20, None if i % 11 == 0 else (i % 5) / 5) for i in range(600)]
    late = [(start + dt.timedelta(minutes=7 * i), "a", 1.0, 0.0, 1.0) for i in range(20)]
    for i in range(5):
        spark.createDataFrame(rows[120 * i : 120 * (i + 1)], kind).coalesce(1).write.mode("append").parquet(path + "/in")
    last = start + dt.timedelta(minutes=2 * 599)
    spark.createDataFrame([*late, (last, "z", 0.0, 0.0, 0.0)], kind).coalesce(1).write.mode("append").parquet(path + "/in")
    stream = J.all_sentiment_windows(J.read_events(spark, path + "/in", spark.createDataFrame([], kind).schema))
    job = stream.writeStream.outputMode("append").option("checkpointLocation", path + "/state").format("parquet").option("path", path + "/out").trigger(availableNow=True).start()
    assert job.awaitTermination(100)
    assert sum(p["numInputRows"] > 0 for p in job.recentProgress) >= 4
    got = {(r.width, r.symbol, r.start): r.value for r in spark.read.parquet(path + "/out").collect()}
    for width in J.WIDTHS:
        want: dict = {}
        for at, symbol, *x in rows:
            want.setdefault((symbol, start + (at - start) // dt.timedelta(minutes=width) * dt.timedelta(minutes=width)), []).append(x)
        mean = lambda xs, i: sum(y) / len(y) if (y := [x[i] for x in xs if x[i] is not None]) else None
        values = {k: (mean(v, 0) - mean(v, 1)) * mean(v, 2) for k, v in want.items() if k[1] + dt.timedelta(minutes=width) <= last - dt.timedelta(minutes=10) and mean(v, 2)}
        mine = {(s, w): v for (m, s, w), v in got.items() if m == width}
        assert mine.keys() == values.keys() and all(abs(mine[k] - values[k]) < 1e-9 for k in values), width


def test_log_is_read_on_after_a_restart(spark):
    """Whole lines only, cut into small reads; a second run reads what was added, a third nothing; equal to the batch's projection."""
    path = folder(spark)
    at = Path(path.removeprefix("file://")) / "log"
    at.mkdir(parents=True)
    record = lambda i: {"id": i, "text": ["é $TSLA up", "none", "$AAPL\nnew"][i % 3] * (1 + i % 50), "created_at": "2024-01-05T10:00:00.5Z", "lang": "en", "matching_rules": [{"id": "1", "tag": "x"}, {"id": "2", "tag": "company_V"}] if i % 4 == 0 else None, "public_metrics": {"like_count": i} if i % 2 else None}
    line = lambda i: json.dumps(record(i)) + "\n"
    (at / "a.jsonl").write_text("".join(line(i) for i in range(100)) + line(100)[:30])
    (at / "b.jsonl").write_text("not json\n\n" + "".join(line(i) for i in range(200, 260)))
    stream = P.projected(G.records(spark, path=path + "/log", bytes_per_read="700"), ("AAPL", "TSLA"))
    J.drain(stream, path + "/out", path + "/state")
    assert spark.read.parquet(path + "/out").count() == 160
    with (at / "a.jsonl").open("a") as f:
        f.write(line(100)[30:] + line(101))
    (at / "c.jsonl").write_text(line(300))
    for _ in range(2):
        J.drain(stream, path + "/out", path + "/state")
    got = spark.read.parquet(path + "/out")
    assert sorted(r.tweet_id for r in got.collect()) == [*range(102), *range(200, 260), 300]
    batch = spark.read.text(path + "/log", pathGlobFilter="*.jsonl").select(F.from_json("value", P.RECORD).alias("r")).where("r.id is not null").select("r.*")
    assert got.exceptAll(P.projected(batch, ("AAPL", "TSLA"))).count() == 0
    by = {r.tweet_id: r for r in got.collect()}
    assert (by[0].symbol, by[3].symbol, by[1].symbol, by[2].symbol) == ("V", "TSLA", None, "AAPL") and by[5].like_count == 5 and by[4].like_count == 0 and by[4].rules == ["x", "company_V"]


WORDS = ["meta", "metaverse", "verse", "aws", "j&j", "model 3", "mac", "macmac"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="metavrswj& l3ocdMA", max_size=12), min_size=1, max_size=8), st.lists(st.sampled_from(WORDS), max_size=8))
def test_contained_words(spark, noise, words):
    text = "".join(a + b for a, b in zip([*noise, *[""] * len(words)], [*words, *[""] * len(noise)]))
    got = spark.range(1).select(P.contained(F.lit(text), WORDS).alias("w")).first().w
    assert sorted(got) == sorted(w for w in WORDS if w in text.lower())


@pytest.mark.parametrize(
    ("text", "tags", "want"),
    [("$TSLA and $AAPL", [], ("AAPL", 1.0)), ("Tesla", ["cashtag_AAPL"], ("AAPL", 0.9)), ("visa payment", ["company_MA"], ("MA", 1.0)), ("apple", None, ("AAPL", 0.5)), ("$ZZZZ nothing", ["cashtag_ZZZZ", "other"], None), ("", ["company_V"], ("V", 0.7)), (None, ["company_V"], ("V", 0.7))],
)
def test_best_symbol(spark, text, tags, want):
    """Ties go to the first listed symbol."""
    row = spark.createDataFrame([(text, tags)], "text string, tags array<string>").select(P.best_symbol(F.col("text"), F.col("tags"), ("AAPL", "TSLA", "V", "MA")).alias("b")).first()
    assert (row.b and tuple(row.b)) == want


def test_settle_waits_for_a_job_that_works(spark):
    """Batches that each take longer than the time without progress that settle allows are waited for."""
    path = folder(spark)

    @F.udf("long")
    def slow(i):
        time.sleep(0.03)
        return i

    rows = spark.range(100).select("id")
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(path + "/in")
    stream = J.flushed(J.read_events(spark, path + "/in", rows.schema).select(slow("id").alias("id")), rows=100, seconds=1)
    job = stream.writeStream.format("parquet").option("path", path + "/out").option("checkpointLocation", path + "/state").trigger(processingTime="0 seconds").start()
    try:
        J.settle(job, most=2.5)
    finally:
        job.stop()
    assert spark.read.parquet(path + "/out").count() == 200


def test_a_batch_writes_one_file_in_each_folder(spark):
    """Also where it reads several files, a task each."""
    path = folder(spark)
    rows = spark.range(4000).select("id", (F.col("id") % 5).alias("k"))
    rows.repartition(8).write.parquet(path + "/in")
    J.drain(J.read_events(spark, path + "/in", rows.schema, 8), path + "/out", path + "/state", ("k",))
    out = spark.read.parquet(path + "/out")
    assert out.count() == 4000 and len(out.inputFiles()) == 5


def test_stream_files_are_as_many_as_the_input_has_partitions(spark):
    """Four batches of files that each are no larger than a partition of the input; four files at least."""
    from types import SimpleNamespace

    from tickerloom.plans import q_jobs

    t = SimpleNamespace(spark=spark)
    for n, files in ((1, 4), (10, 10)):
        path = folder(spark)
        J.drain(q_jobs._files(t, spark.range(0, 1000, 1, n)).withColumn("file", F.input_file_name()), path + "/out", path + "/state")
        out = spark.read.parquet(path + "/out")
        assert out.count() == 1000 and out.select("file").distinct().count() == files


def test_reads_of_a_long_batch():
    """No more reads than READS while each is below MOST_BYTES; they cover all bytes once."""
    reader = G.LogReader({"path": "/none", "bytes_per_read": "100"})
    for size, most in ((1000, 10), (10_000_000, G.READS), (2 * G.READS * G.MOST_BYTES, 2 * G.READS)):
        parts = reader.partitions({"a": 7}, {"a": size, "b": 50})
        assert len(parts) <= most + 2 and max(p.end - p.begin for p in parts) <= max(100, G.MOST_BYTES)
        assert sorted((p.begin, p.end) for p in parts if p.path == "a")[0][0] == 7 and sum(p.end - p.begin for p in parts) == size - 7 + 50


def test_best_symbol_looks_through_a_text_once(spark):
    """The pattern of keywords is in the plan's projection once and not again in its filter's other terms."""
    rows = spark.range(3).select(F.concat(F.lit("Tesla visa "), F.col("id")).alias("text"), F.array(F.lit("company_V")).alias("tags"))
    b = P.best_symbol(F.col("text"), F.col("tags"), ("TSLA", "V"))
    got = rows.select(b.alias("b"))
    assert got._jdf.queryExecution().analyzed().toString().count("regexp_extract_all(lower(") == 1 and [r.b.symbol for r in got.collect()] == ["V"] * 3
