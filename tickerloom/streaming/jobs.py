"""Structured Streaming jobs over posts: ingest, fan-out, scoring and windowed sentiment."""

from __future__ import annotations

import time

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tickerloom.functions.text import clip
from tickerloom.operators.scoring import scored


def read_events(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def posts(events: DataFrame) -> DataFrame:
    """The tweets view, with zoned times, which watermarks need."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    confidence = F.when(F.col("event_id") % 97 == 0, None).when(F.col("event_id") % 89 == 0, 0.0).otherwise(F.least(F.col("value") / 500, F.lit(1.0)))
    return events.select(
        F.col("event_id").alias("tweet_id"), F.col("ts").cast("timestamp").alias("created_at"), F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("symbol"),
        (k / 100.0).alias("sentiment_positive"), ((100 - k) * 0.6 / 100).alias("sentiment_negative"), ((100 - k) * 0.4 / 100).alias("sentiment_neutral"), confidence.alias("sentiment_confidence"),
    )


def drain(stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (), mode: str = "append") -> None:
    """Runs the stream until all that is there has been written, exactly once, and stops.

    With partition_by, a batch's rows are dealt by those columns first, so that it writes one file in each folder, not one for each task.
    """
    rows = stream.repartition(*partition_by) if partition_by else stream
    out = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).format("parquet").option("path", path).trigger(availableNow=True)
    (out.partitionBy(*partition_by) if partition_by else out).start().awaitTermination()


def with_parts(stream: DataFrame) -> DataFrame:
    """Posts with the date and hour that a sink is partitioned by."""
    return stream.withColumns({"date": F.to_date("created_at"), "hour": F.hour("created_at")})


def start(stream: DataFrame, path: str, checkpoint: str, every: str = "300 seconds"):
    """A running job that writes by symbol, day and hour in micro-batches; a failed batch is done again from the checkpoint."""
    parts = ("symbol", "date", "hour")
    out = with_parts(stream).repartition(*parts).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return out.partitionBy(*parts).trigger(processingTime=every).start()


def fan_out(stream: DataFrame, symbols: DataFrame) -> DataFrame:
    """A row for each symbol whose cashtag a post's text contains; symbols is a small static table."""
    return stream.join(F.broadcast(symbols), F.contains(F.upper("text"), F.concat(F.lit("$"), F.col("symbol"))))


def scores(stream: DataFrame, scorer=None) -> DataFrame:
    """New texts scored as they come; the checkpoint keeps what was read from being read again."""
    return scored(stream, scorer)


def sentiment_windows(stream: DataFrame, minutes: int, late: str = "10 minutes") -> DataFrame:
    """symbol, start, value: tumbling windows, closed once the watermark has passed them."""
    shares = ("sentiment_positive", "sentiment_negative", "sentiment_confidence")
    means = stream.withWatermark("created_at", late).groupBy("symbol", F.window("created_at", f"{minutes} minutes").alias("w")).agg(*[F.avg(c).alias(c) for c in shares])
    value = clip((F.col("sentiment_positive") - F.col("sentiment_negative")) * F.col("sentiment_confidence"), -1.0, 1.0)
    return means.where("sentiment_confidence > 0").select("symbol", F.col("w.start").alias("start"), value.alias("value"))


WIDTHS = (5, 10, 60)  # minutes; each a multiple of the one before


def all_sentiment_windows(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """width, symbol, start, value: tumbling windows of 5, 10 and 60 minutes, each given once the watermark has passed it.

    Posts are summed and counted by five minutes; the longer windows sum those up, in a chain, and all widths leave in one
    stream. Posts that come after the watermark has passed their five minutes don't count.
    """
    shares = ("sentiment_positive", "sentiment_negative", "sentiment_confidence")
    sums = {f"s{i}": F.sum(c) for i, c in enumerate(shares)} | {f"n{i}": F.count(c) for i, c in enumerate(shares)}
    level = stream.withWatermark("created_at", late).groupBy("symbol", F.window("created_at", f"{WIDTHS[0]} minutes").alias("w")).agg(*[x.alias(c) for c, x in sums.items()])
    levels = [level]
    for width in WIDTHS[1:]:
        level = level.withColumn("at", F.window_time("w")).groupBy("symbol", F.window("at", f"{width} minutes").alias("w")).agg(*[F.sum(c).alias(c) for c in sums])
        levels.append(level)
    p, n, c = (F.try_divide(f"s{i}", F.nullif(F.col(f"n{i}"), F.lit(0))) for i in range(3))
    parts = [x.where(c > 0).select(F.lit(m).alias("width"), "symbol", F.col("w.start").alias("start"), clip((p - n) * c, -1.0, 1.0).alias("value")) for m, x in zip(WIDTHS, levels)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_AT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def flushed(stream: DataFrame, key: str | None = None, rows: int = 100, seconds: float = 300.0) -> DataFrame:
    """The rows of the stream with flush and reason: a buffer of each key lets `rows` rows go at a time, or what it has once its first is `seconds` old.

    reason is rows or time; flush names the rows that left together. A buffer holds fewer than `rows` rows and is kept in
    the state store; keys spread over tasks. Without a key there is one buffer.
    """
    names = stream.columns
    packed = stream.select((F.col(key).cast("string") if key else F.lit("")).alias("_key"), F.to_json(F.struct(*names), _AT).alias("_row"))

    def flush(group, frames, state):
        now = state.getCurrentProcessingTimeMs()
        since, count, held = state.get if state.exists else (now, 0, [])
        held, out = list(held), []

        def leave(n: int, reason: str) -> None:
            nonlocal since, count, held
            out.append(pd.DataFrame({"_key": group[0], "flush": f"{since}-{count}", "reason": reason, "_row": held[:n]}))
            held, since, count = held[n:], now, count + 1

        if held and now >= since + seconds * 1000:
            leave(len(held), "time")
        for frame in frames:
            for row in frame["_row"]:
                since = since if held else now
                held.append(row)
                if len(held) == rows:
                    leave(rows, "rows")
        if held:
            state.update((since, count, held))
            state.setTimeoutDuration(max(1, int(since + seconds * 1000 - now)))
        elif state.exists:
            state.remove()
        yield from out

    out = packed.groupBy("_key").applyInPandasWithState(flush, "_key string, flush string, reason string, _row string", "since long, count long, held array<string>", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return out.select("flush", "reason", F.from_json("_row", stream.schema, _AT).alias("_r")).select("flush", "reason", "_r.*")


def settle(job, most: float = 60.0) -> None:
    """Waits until the running job has read all that there is and its buffers are empty, however long it works on that.

    An error if for `most` seconds no batch runs, or batches end that neither read a row nor change what the buffers hold. A
    batch that runs counts as work. A job with timers runs batches without rows, too, so it never counts as done by itself.
    """
    moved, seen, held = time.monotonic(), None, None
    while True:
        if job.exception():
            raise job.exception()
        last, status = job.lastProgress, job.status
        if last and last["batchId"] != seen:
            before, seen, held = held, last["batchId"], [s["numRowsTotal"] for s in last["stateOperators"]]
            if last["numInputRows"] or held != before:
                moved = time.monotonic()
            if last["numInputRows"] == 0 and not status["isDataAvailable"] and not any(held):
                return
            stuck = time.monotonic() - moved > most
        else:
            stuck = not status["isTriggerActive"] and time.monotonic() - moved > most
        if stuck:
            raise TimeoutError(f"the job still has rows to read or buffers to empty: {last}")
        time.sleep(0.2)
