"""A stream source over a folder of logs: files that only grow, a record a line, read by byte offsets.

Offsets are {file: bytes}, so a run that starts again reads on from where its checkpoint ends, and a batch that failed is read
again byte by byte. A batch takes all whole lines that there are, cut into reads of bytes_per_read, a task each;
long batches into longer ones, so that tasks don't grow with the bytes.
Paths go through pyarrow's file systems, for the driver and the executors alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tickerloom.operators.posts import RECORD

CHUNK = 1 << 20
READS, MOST_BYTES = 256, 64 << 20  # a batch of more than READS reads gets longer ones, of MOST_BYTES at most


@dataclass
class Stretch(InputPartition):
    path: str
    begin: int
    end: int


def _line_end(f, at: int, size: int) -> int:
    """The place after the first line end from `at` on; size if there is none."""
    f.seek(at)
    while at < size:
        data = f.read(min(CHUNK, size - at))
        if (i := data.find(b"\n")) >= 0:
            return at + i + 1
        at += len(data)
    return size


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.suffix, self.each = options["path"], options.get("suffix", ".jsonl"), int(options.get("bytes_per_read", 8 << 20))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Up to the last line end of each file; a line that isn't ended waits."""
        fs, base = pafs.FileSystem.from_uri(self.folder)
        out = {}
        for info in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)):
            if info.is_file and info.base_name.endswith(self.suffix):
                end = info.size
                with fs.open_input_file(info.path) as f:
                    while end:
                        at = max(0, end - CHUNK)
                        f.seek(at)
                        if (i := f.read(end - at).rfind(b"\n")) >= 0:
                            end = at + i + 1
                            break
                        end = at
                out[info.base_name] = end
        return out

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        each = max(self.each, min(MOST_BYTES, -(-sum(to - start.get(name, 0) for name, to in end.items()) // READS)))
        return [Stretch(name, at, min(at + each, to)) for name, to in sorted(end.items()) for at in range(start.get(name, 0), to, each)]

    def read(self, partition: Stretch):
        """The lines that begin in the stretch."""
        fs, base = pafs.FileSystem.from_uri(self.folder)
        with fs.open_input_file(f"{base}/{partition.path}") as f:
            size = f.size()
            at = _line_end(f, partition.begin - 1, size) if partition.begin else 0
            end = _line_end(f, partition.end - 1, size)
            f.seek(at)
            rest, begin = b"", at
            while at < end:
                data = f.read(min(CHUNK, end - at))
                at += len(data)
                *lines, rest = (rest + data).split(b"\n")
                rows = []
                for line in lines:
                    if line:
                        rows.append((line.decode("utf-8", "replace"), begin))
                    begin += len(line) + 1
                if rows:
                    values, offsets = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array([partition.path] * len(rows), pa.string()), pa.array(offsets, pa.int64())], ["value", "file", "offset"])

    def commit(self, end: dict) -> None:
        pass


class LogSource(DataSource):
    """Format "post_log". Options: path, suffix, bytes_per_read."""

    @classmethod
    def name(cls) -> str:
        return "post_log"

    def schema(self) -> str:
        return "value string, file string, offset long"

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options)


def records(spark: SparkSession, source: str = "post_log", **options) -> DataFrame:
    """A stream of records (operators.posts.RECORD) from this format or any broker's whose rows have a column `value` with JSON.

    The broker is named by the source and its options. What isn't JSON gives no row.
    """
    if source == "post_log":
        spark.dataSource.register(LogSource)
    raw = spark.readStream.format(source).options(**options).load()
    return raw.select(F.from_json(F.col("value").cast("string"), RECORD).alias("r")).where("r.id is not null").select("r.*")
