"""File sources and sinks: CSV with and without header, JSON Lines, listings, metadata."""

from __future__ import annotations

import json
import re

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header; lines that don't fit go to _corrupt."""
    kind = schema if isinstance(schema, str) else ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return spark.read.schema(kind + ", _corrupt string").option("header", True).option("columnNameOfCorruptRecord", "_corrupt").csv(path)


def read_label_first(spark: SparkSession, path: str, features: int) -> DataFrame:
    """CSV without header, the label first."""
    return spark.read.schema(", ".join(["label double", *[f"f{i} double" for i in range(features)]])).csv(path)


def read_preferred(spark: SparkSession, folder: str, schema: str, name: str = "train.csv") -> DataFrame:
    """Of a folder's entries, each a CSV file or a folder of them, the one of that name, else the first by name."""
    rows = spark.read.schema(schema).option("header", True).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).csv(folder)
    base = re.escape(folder.rstrip("/").rpartition("/")[2])
    tagged = rows.withColumn("_entry", F.regexp_extract("_metadata.file_path", f"/{base}/([^/]+)", 1))
    pick = tagged.select("_entry").distinct().orderBy(F.col("_entry") != name, "_entry").limit(1)
    return tagged.join(F.broadcast(pick), "_entry", "left_semi").drop("_entry")


def first_location(frames: list[DataFrame], by: str) -> DataFrame:
    """Of several places in order, each key's rows from the first that has any."""
    rows = None
    for i, f in enumerate(frames):
        one = f.withColumn("_place", F.lit(i))
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    least = rows.groupBy(by).agg(F.min("_place").alias("_place"))
    return rows.join(least, [by, "_place"], "left_semi").drop("_place")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON Lines, also compressed by suffix; blank lines are skipped, bad ones go to _corrupt."""
    return spark.read.schema(schema + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("symbol")).where("symbol <> ''")


def write_named_json(rows: DataFrame, path: str, name: str) -> None:
    """A JSON file for each row, over several lines, named by the column `name`; tasks write files of their own, and a task that runs again writes the same."""
    rest = [c for c in rows.columns if c != name]

    def write(batches):
        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
                with fs.open_output_stream(f"{base}/{file}") as out:
                    out.write(json.dumps(json.loads(value), indent=2).encode())
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    rows.select(F.col(name).alias("file"), F.to_json(F.struct(*rest)).alias("value")).mapInArrow(write, "files long").agg(F.sum("files")).collect()


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Many small JSON files, each an object or an array of them over any number of lines, with model and symbol of names such as model_symbol.json.

    A model's name may have underscores; a file whose name has none gives a null symbol. What isn't JSON gives nulls.
    """
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    symbol = F.when(F.contains(stem, F.lit("_")), F.substring_index(stem, "_", -1))
    return rows.select(F.regexp_replace(stem, "_[^_]*$", "").alias("model"), symbol.alias("symbol"), "*")


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """path, length and time of all files below a folder; their content isn't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "modificationTime")


def write_csv_by_symbol(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).partitionBy("symbol").csv(path)


def write_label_first(df: DataFrame, path: str, label: str, features: list[str]) -> None:
    df.select(label, *features).write.mode("overwrite").csv(path)


def write_jsonl_by_hour(posts: DataFrame, path: str, compression: str = "none") -> None:
    """JSON Lines appended by symbol, year, month, day and hour."""
    at = F.col("created_at")
    parts = {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at), "hour": F.hour(at)}
    posts.withColumns(parts).write.mode("append").option("compression", compression).partitionBy("symbol", *parts).json(path)


def write_jsonl_by_day(posts: DataFrame, path: str) -> None:
    """Gzipped JSON Lines appended by symbol and day: a later batch never replaces an earlier one."""
    posts.withColumn("day", F.to_date("created_at")).write.mode("append").option("compression", "gzip").partitionBy("symbol", "day").json(path)


def write_scored(posts: DataFrame, path: str) -> None:
    posts.withColumn("date", F.to_date("created_at")).write.mode("append").partitionBy("symbol", "date").parquet(path)


def read_scored(spark: SparkSession, path: str, symbol: str, first: str, last: str) -> DataFrame:
    """A symbol's scored posts of some days, by partitions."""
    return spark.read.parquet(path).where((F.col("symbol") == symbol) & F.col("date").between(first, last))


_METADATA = "features array<string>, target string, n int, filled map<string,bigint>"


def feature_metadata(df: DataFrame, target: str) -> DataFrame:
    """One row: the feature names in order, the target, their number, and how many values of each aren't null."""
    names = [c for c in df.columns if c != target]
    filled = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.count(c) for c in names]))
    return df.agg(filled.alias("filled")).select(F.array(*map(F.lit, names)).alias("features"), F.lit(target).alias("target"), F.lit(len(names)).alias("n"), "filled")


def with_names(metadata: DataFrame, names: list[str]) -> DataFrame:
    """Metadata with the names that it lacks at the end."""
    features = F.array_union("features", F.array(*map(F.lit, names)))
    return metadata.withColumn("features", features).withColumn("n", F.size("features"))


def write_metadata(metadata: DataFrame, path: str) -> None:
    metadata.coalesce(1).write.mode("overwrite").json(path)  # one row


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_METADATA).json(path)


def write_runs(oof: DataFrame, path: str, run_id: str) -> None:
    oof.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def latest_run(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the greatest run_id."""
    rows = spark.read.parquet(path)
    return rows.join(F.broadcast(rows.agg(F.max("run_id").alias("run_id"))), "run_id", "left_semi")


def newest_by(df: DataFrame, key: str, at: str) -> DataFrame:
    return df.withColumn("_k", F.row_number().over(W.partitionBy(key).orderBy(F.desc(at)))).where("_k = 1").drop("_k")
