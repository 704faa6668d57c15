"""Helpers shared by the text operators: shared-folder tables, and word arrays over Arrow text columns.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text with A-Z lower-cased.
Word and shingle identities are 64-bit hashes; nothing is decided across documents on a hash alone unless
the operator says so.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_KEEP = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 8)] + [2**64 - 1], np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; set to one under the warehouse only where the cluster names none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: the lineage ends there, and any executor can read it."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


_STAGED: list[str] = []  # folders of this driver's staged tables


def finished(make, name: str) -> DataFrame:
    """The DataFrame that make() gives, staged; then the tables that were staged on its way are removed."""
    mark = len(_STAGED)
    out = staged(make(), name)
    for path in _STAGED[mark:-1]:
        fs, base = pafs.FileSystem.from_uri(path)
        fs.delete_dir(base)
    del _STAGED[mark:-1]
    return out


def spread_join(rows: DataFrame, groups: DataFrame, keys: list[str], total: int, how: str, share: int = 1000) -> DataFrame:
    """rows joined with groups by keys that are unique in groups; `n` says how many rows a group meets, about, and is dropped.

    A group may meet a third of all rows: groups of over total / share rows, fewer than `share` of them, are broadcast, and
    only the rows of the others are shuffled. how: inner or left; rows must be cheap to read twice.
    """
    more = [c for c in groups.columns if c not in (*keys, "n")]
    hot = groups.where(F.col("n") * share > F.lit(total)).drop("n").withColumn("_hot", F.lit(True))
    cold = groups.where(F.col("n") * share <= F.lit(total)).drop("n")
    few = rows.join(F.broadcast(hot), keys, "left")
    done, rest = few.where("_hot").drop("_hot"), few.where("_hot is null").drop("_hot", *more)
    return done.unionByName(rest.join(cold, keys, how).select(*done.columns))


def drawn(rows: DataFrame, n: int, most: int) -> DataFrame:
    """About `most` of the n rows by a hash of their texts, each text once; draw: a number to order and cut them by.

    Rows that repeat a text are drawn together and count once, so a text of very many rows doesn't fill the sample. Rows
    without a text are left out.
    """
    rate = min(1_000_000_000, 1_000_000_000 * most // max(1, n))
    some = rows.withColumn("draw", F.xxhash64("text", F.lit(most))).where(F.col("text").isNotNull() & (F.pmod("draw", F.lit(1_000_000_000)) < F.lit(rate)))
    return some.dropDuplicates(["draw"])


def crc_mod(doc_id, k: int):
    """crc32 of doc_id as text, mod k; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow column, one after the other, and each text's begin and end offsets (n + 1). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


class Words:
    """Words of a batch of texts. begin, end: byte offsets in `low`; of: for each text, its first word's index (n + 1)."""

    def __init__(self, column, space: np.ndarray = SPACE):
        raw, off = utf8(column)
        n = len(raw)
        self.low = np.zeros(n + 8, np.uint8)  # eight spare bytes, so that a load at the last byte stays inside
        data = raw.tobytes()
        self.low[:n] = np.frombuffer(data.translate(LOWER.tobytes()), np.uint8)
        word = ~np.frombuffer(data.translate(space.tobytes()), bool)
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        begin = word.copy()
        begin[1:] &= ~word[:-1] | edge[1:n]
        end = word.copy()
        end[:-1] &= ~word[1:] | edge[1:n]
        self.begin, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.of = np.searchsorted(self.begin, off)
        self.bytes = off

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, eight bytes at a time."""
        loads = np.ndarray((len(self.low) - 7,), "<u8", self.low, strides=(1,))
        length = (self.end - self.begin).astype(np.int64)
        h = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at, left, sub = self.begin, length, None
        while len(at):
            x = loads[at] & _KEEP[np.minimum(left, 8)]
            if sub is None:
                h = _mix(h ^ x)
            else:
                h[sub] = _mix(h[sub] ^ x)
            more = left > 8
            sub = np.flatnonzero(more) if sub is None else sub[more]
            at, left = at[more] + 8, left[more] - 8
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def shingle_sets(column, k: int = 5) -> list[np.ndarray]:
    """For each text, its sorted distinct k-word shingles as uint64. Fewer words: the whole sequence as one. No words: none."""
    words = Words(column)
    h, of = words.hashes(), words.of
    n = max(0, len(h) - k + 1)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = _mix(total + h[i : i + n] * np.uint64(2 * i + 3) + np.uint64(i))
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(total[a : b - k + 1]))
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for x in h[a:b]:
                one = _mix(one * np.uint64(31) + x)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sliced(batches, column: str = "text", most: int = 2 << 20):
    """The rows of Arrow batches in slices of about `most` bytes of a text column, so that a task's memory stays bounded. A longer text goes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size) // most
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)
