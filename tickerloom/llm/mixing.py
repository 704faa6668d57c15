"""Mixing sources to target weights: fixed-length blocks, multinomial draws per shard, pseudorandom index permutations.

Each source's words form one stream, cut into blocks of BLOCK words. The mix is a sequence of slots in shards. Each source's
slots fall on the shards by a multinomial draw, so a shard's counts of sources are multinomial and the totals come out as
planned; the draws are made in tasks, each source's from its own seed. The t-th slot of a source takes block perm(t mod
blocks) in pass t div blocks, where perm is a keyed permutation of the source's block numbers, another one in each pass.
Slots and blocks join by (source, block).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import _mix, sliced, spread_join, staged, Words

BLOCK = 64  # words of a block
SHARD = 65536  # slots of a shard, about
TASK_SLOTS = 500_000  # slots that a task makes, about
WEIGHTS = (5, 2, 1)  # of sources in code point order, null last, repeating
SHARE = 1.5  # of all words, to be shared
MOST = 2.0  # times a source's words, at most
ROUNDS = 4  # of the Feistel network
BUCKET = 250  # documents of a bucket, about
SPAN = 1000  # buckets of a span
COPIES = 10_000  # of one row that a task makes at most


def targets(sizes: list[tuple[str | None, int]]) -> dict[str | None, float]:
    """Words that each source shall give. sizes: one (source, words) per source."""
    order = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode("utf-32-be")))
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, (s, _) in enumerate(order)}
    cap = {s: MOST * n for s, n in order}
    out: dict = {}
    left, free = SHARE * sum(n for _, n in order), [s for s, _ in order]
    while free:
        each = left / sum(weight[s] for s in free)
        over = [s for s in free if each * weight[s] > cap[s]]
        if not over:
            out |= {s: each * weight[s] for s in free}
            break
        out |= {s: cap[s] for s in over}
        left -= sum(cap[s] for s in over)
        free = [s for s in free if s not in out]
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1, keyed: a Feistel network over an even power of two, walked until inside."""
    half = np.uint64(max(1, ((max(size, 2) - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for i in range(ROUNDS):
            left, right = right, left ^ (_mix(right + np.uint64((key * 0x9E3779B97F4A7C15 + i * 0xD1B54A32D192ED03) % 2**64)) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def drawn(slots: int, shards: int, key: int) -> np.ndarray:
    """How many of a source's slots fall on each shard."""
    return np.random.default_rng(key).multinomial(slots, np.full(shards, 1 / shards))


def _plan(shards: int, seed: int):
    def plan(batches):
        """Of each source (source_no, slots, blocks), a row for each shard that has slots of it: first, the number of the first one."""
        for batch in batches:
            for r in batch.to_pylist():
                n = drawn(r["slots"], shards, [seed, r["source_no"]])
                first, some = np.cumsum(n) - n, np.flatnonzero(n)
                for at in np.array_split(some, -(-len(some) // 100_000)) if len(some) else []:
                    k = len(at)
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(k, r["source_no"], np.int32)), pa.array(first[at]), pa.array(n[at]), pa.array(np.full(k, r["blocks"]))], ["shard", "source_no", "first", "n", "blocks"])

    return plan


def _slots(batches):
    """Of each row (shard, source_no, first, n, blocks, at): its n slots with the blocks that they take."""
    for batch in batches:
        for r in batch.to_pylist():
            for a in range(0, r["n"], 1 << 20):
                t = r["first"] + np.arange(a, min(r["n"], a + (1 << 20)), dtype=np.int64)
                block = np.empty(len(t), np.int64)
                for lap in np.unique(t // r["blocks"]).tolist():
                    here = t // r["blocks"] == lap
                    block[here] = permuted(t[here] % r["blocks"], r["blocks"], r["source_no"] * 1_000_003 + lap)
                k = len(t)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, r["shard"])), pa.array(r["at"] + a + np.arange(k)), pa.array(np.full(k, r["source_no"], np.int32)), pa.array(block)], ["shard", "slot", "source_no", "block"])


def _sizes(batches):
    for batch in sliced(batches):
        of = Words(batch.column("text")).of
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), batch.column("digest"), pa.array(np.diff(of).astype(np.int64))], ["doc_id", "source", "digest", "size"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source")).withColumn("digest", F.xxhash64("text"))


class Mix:
    """A mix of docs(doc_id, text, source); other columns are ignored.

    rows: doc_id, digest (64 bits of the text), source_no, source_size, target, size and `start`, the place of the row's
    first word in its source's stream. Null and blank texts have no words. Rows that repeat have a place each, one after
    the other; a doc_id may be null or come with several texts. An empty table gives an empty mix.
    slots: shard, slot, source_no, block: the mix. Reruns give the same mix, however the rows are partitioned.
    The driver holds one row for each source.
    """

    def __init__(self, docs: DataFrame, seed: int = 20, block: int = BLOCK):
        spark, self.block = docs.sparkSession, block
        sized = _keyed(docs).mapInArrow(_sizes, "doc_id long, source string, digest long, size long")
        units = staged(sized.groupBy("doc_id", "source", "digest", "size").agg(F.count("*").alias("copies")), "mix-sizes")
        self.units = units
        found = units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("words"), F.count("*").alias("n")).collect()  # one row per source
        want = targets([(r.source, r.words) for r in found])
        order = sorted(found, key=lambda r: (r.source is None, (r.source or "").encode("utf-32-be")))
        self.known = [(i, r.source, r.words, float(want[r.source])) for i, r in enumerate(order)]
        none, name = F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")
        sources = spark.createDataFrame([(*k, r.n) for k, r in zip(self.known, order)], "source_no int, source string, source_size long, target double, n long")
        self.sources = sources.select("source_no", "source")

        # Places: prefix sums over the spans of a source, the buckets of a span, and within each bucket.
        total = sum(r.n for r in found)
        buckets = total // BUCKET + 1
        placed = spread_join(units.select("doc_id", "digest", "size", "copies", none, name), sources.select("source_no", "source_size", "target", "n", none, name), ["none", "name"], total, "inner")
        placed = placed.drop("none", "name").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest", "size"), F.lit(buckets)))
        before = lambda by, at: W.partitionBy(*by).orderBy(*at).rowsBetween(W.unboundedPreceding, -1)
        words = F.sum(F.col("size") * F.col("copies"))
        spans = placed.groupBy("source_no", "bucket").agg(words.alias("words")).withColumn("span", F.expr(f"bucket div {SPAN}"))
        firsts = spans.groupBy("source_no", "span").agg(F.sum("words").alias("words"))
        firsts = firsts.select("source_no", "span", F.coalesce(F.sum("words").over(before(["source_no"], ["span"])), F.lit(0)).alias("first"))
        bases = spans.withColumn("inside", F.coalesce(F.sum("words").over(before(["source_no", "span"], ["bucket"])), F.lit(0))).join(firsts, ["source_no", "span"])
        bases = bases.select("source_no", "bucket", (F.col("first") + F.col("inside")).alias("base"))
        placed = placed.withColumn("inside", F.coalesce(words.over(before(["source_no", "bucket"], ["doc_id", "size", "digest"])), F.lit(0))).join(bases, ["source_no", "bucket"])
        placed = staged(placed.select("doc_id", "digest", "source_no", "source_size", "target", "size", "copies", (F.col("base") + F.col("inside")).alias("start")), "mix-places")
        names = ["doc_id", "digest", "source_no", "source_size", "target", "size"]
        many = placed.where("copies > 1").withColumn("from", F.explode(F.expr(f"sequence(0l, copies - 1, {COPIES}l)")))
        many = many.repartition(max(32, spark.sparkContext.defaultParallelism), "doc_id", "digest", "source_no", "size", "from")  # a row may be repeated by the million
        many = many.withColumn("copy", F.explode(F.expr(f"sequence(from, least(copies, from + {COPIES}) - 1)")))
        self.rows = placed.where("copies = 1").select(*names, "start").unionByName(many.select(*names, (F.col("start") + F.col("copy") * F.col("size")).alias("start")))

        owed = [(i, _slot_count(words, target, block), -(-words // block)) for i, _, words, target in self.known]
        slots = sum(n for _, n, _ in owed)
        shards = max(1, -(-slots // SHARD))
        plan = spark.createDataFrame([r for r in owed if r[1]], "source_no int, slots long, blocks long").repartition(max(1, min(len(owed), shards)), "source_no").mapInArrow(_plan(shards, seed), "shard long, source_no int, first long, n long, blocks long")
        plan = plan.withColumn("at", F.coalesce(F.sum("n").over(before(["shard"], ["source_no"])), F.lit(0)))
        self.slots = plan.repartition(max(32, -(-slots // TASK_SLOTS)), "shard", "source_no").mapInArrow(_slots, "shard long, slot long, source_no int, block long")

    def pieces(self) -> DataFrame:
        """The columns of rows, and block, from_word, words: the part of each row in each block."""
        b = F.lit(self.block)
        cut = self.rows.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {self.block}, (start + size - 1) div {self.block})")))
        low, high = F.greatest(F.col("start"), F.col("block") * b), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b)
        return cut.select("*", (low - F.col("start")).alias("from_word"), (high - low).alias("words"))

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken of every row."""
        times = self.slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
        names = ["doc_id", "size", "source_size", "target"]
        # Merge join by hint: the slots come from a small plan, from which Spark would take their number to be small.
        used = self.pieces().select("source_no", "block", "start", *names, "words").join(times.hint("merge"), ["source_no", "block"], "left")
        used = used.groupBy("source_no", "start", *names).agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
        return used.select(*names, F.col("taken").cast("long").alias("taken")).unionByName(self.rows.where("size = 0").select(*names, F.lit(0).cast("long").alias("taken")))

    def blocks(self, docs: DataFrame) -> DataFrame:
        """shard, slot, source, doc_ids, text: each slot's words with one space between, and the documents that they come from.

        docs: the table that the mix was made of. The mix's order is that of shard, then slot. Texts and blocks stream past
        hashed places and slots, so neither is sorted; a piece that fills its block isn't gathered with others.
        """
        texts = _keyed(docs).where(F.length("text") > 0)
        if not self.units.where("copies > 1 and size > 0").isEmpty():
            texts = texts.dropDuplicates(["doc_id", "source", "digest"])  # these have one text
        none = lambda c, x: F.coalesce(c, F.lit(x)).alias(f"_{c}")
        keys = [none("doc_id", -(2**63)), F.col("doc_id").isNull().alias("_none"), F.col("digest")]
        places = self.rows.where("size > 0").select(*keys, "source_no", "start")
        names = self.sources.select("source_no", F.coalesce("source", F.lit("")).alias("_source"), F.col("source").isNull().alias("_other"))
        places = places.join(F.broadcast(names) if len(self.known) <= 100_000 else names, "source_no")
        met = texts.select(*keys, none("source", ""), F.col("source").isNull().alias("_other"), "doc_id", "source", "text")
        met = met.join(places.hint("shuffle_hash"), ["_doc_id", "_none", "digest", "_source", "_other"]).select("doc_id", "source", "source_no", "start", "text")
        cut = met.mapInArrow(_cut(self.block), "source_no int, source string, block long, start long, doc_id long, words long, part string")
        full = cut.where(F.col("words") == self.block).select("source_no", "source", "block", F.array("doc_id").alias("doc_ids"), F.col("part").alias("text"))
        rest = cut.where(F.col("words") < self.block).groupBy("source_no", "block").agg(F.first("source").alias("source"), F.sort_array(F.collect_list(F.struct("start", "doc_id", "part"))).alias("pieces"))  # at most one piece a word
        rest = rest.select("source_no", "source", "block", F.array_distinct("pieces.doc_id").alias("doc_ids"), F.array_join("pieces.part", " ").alias("text"))
        return full.unionByName(rest).join(self.slots.hint("shuffle_hash"), ["source_no", "block"]).select("shard", "slot", "source", "doc_ids", "text")


def _cut(size: int):
    def cut(batches):
        """Of each text that begins at a word's place of its source, the part in each block of `size` words."""
        for batch in sliced(batches):
            out: list[list] = [[] for _ in range(7)]
            for doc_id, source, number, start, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "source", "source_no", "start", "text"))):
                words = _WORD.findall(text)
                at = 0
                while at < len(words):
                    end = min(len(words), at + size - (start + at) % size)
                    for column, x in zip(out, (number, source, (start + at) // size, start, doc_id, end - at, " ".join(words[at:end]))):
                        column.append(x)
                    at = end
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], ["source_no", "source", "block", "start", "doc_id", "words", "part"])

    return cut


_WORD = re.compile("[^\x20\x09-\x0D]+")


def _slot_count(words: int, target: float, block: int) -> int:
    """Slots whose blocks hold nearly `target` words; whole passes count the last, shorter block as it is."""
    if not words:
        return 0
    blocks, laps = -(-words // block), min(int(target // words), int(MOST))
    rest = max(0.0, target - laps * words)
    return min(laps * blocks + round(rest / (words / blocks)), int(MOST) * blocks)
