"""Exact duplicates through counting quotient filters.

Each task fills counting quotient filters from its rows, one for each range of fingerprints. A fingerprint is 64 bits of the
normalised text's SHA-256: RANGE_BITS of them name the range, the next ones (the quotient) a slot, and the rest (the
remainder) is what the slot holds. The filters of all tasks for one range merge losslessly by their sorted remainders,
counts added. Fingerprints counted more than once route their rows to verification, which groups by the normalised bytes
themselves.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import _mix, sliced, spread_join, staged, utf8

RANGE_BITS = 10  # filters are cut into so many ranges of fingerprints (2 ** RANGE_BITS)
LOAD = 0.9  # of a filter's slots that are filled at most
BITS_EACH = 16  # of a range's bitmap for each repeated fingerprint
BITMAP_BYTES = 1 << 16  # of a range's bitmap at most: 64 MB for all ranges, at any size of the input
HOT_SHARE = 1000  # a group of more than 1/HOT_SHARE of all rows is hot; so at most HOT_SHARE groups are
_BLANKS = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def normalised(raw: bytes) -> bytes:
    """Each run of [\\x20\\x09-\\x0D] becomes one space."""
    raw = raw.translate(_BLANKS)
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    return raw


def norm_text(text):
    """The same as a column."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class CountingQuotientFilter:
    """Fingerprints of `bits` bits with counts, in slots.

    A fingerprint's quotient is its canonical slot. Fingerprints of one quotient form a run, in the order of their remainders;
    runs stand in the order of their quotients, each at its canonical slot or pushed behind the run before. `occupied` marks
    quotients that have a run, `run_end` the last slot of each run: the i-th occupied quotient's run ends at the i-th run
    end. A count above one takes further slots after its remainder, marked `counter`: the digits of count - 1, low first, to
    the base of a slot.
    """

    def __init__(self, bits: int, prints: np.ndarray | None = None, counts: np.ndarray | None = None):
        """prints: distinct fingerprints in order, with their counts."""
        self.bits = bits
        self._fill(np.zeros(0, np.uint64) if prints is None else prints, np.zeros(0, np.int64) if counts is None else counts)

    def _fill(self, prints: np.ndarray, counts: np.ndarray) -> None:
        base = 1 << 16
        digits = np.zeros(len(prints), np.int64)
        rest = counts - 1
        while rest.any():
            digits += rest > 0
            rest = rest // base
        need = int(len(prints) + digits.sum())
        self.q_bits = max(3, int(np.ceil(np.log2(max(1, need) / LOAD))))
        self.r_bits = max(16, self.bits - self.q_bits)
        quotient = (prints >> np.uint64(self.bits - self.q_bits)).astype(np.int64)
        head = np.arange(len(prints)) + np.cumsum(digits) - digits  # slots taken before each fingerprint
        place = head + np.maximum.accumulate(quotient - head) if len(prints) else head  # its own, or pushed behind the one before
        slots = max(1 << self.q_bits, int(place[-1] + 1 + digits[-1]) if len(place) else 0)
        self.remainder, self.counter, self.run_end = np.zeros(slots, np.uint64), np.zeros(slots, bool), np.zeros(slots, bool)
        self.occupied = np.zeros(1 << self.q_bits, bool)
        self.occupied[quotient] = True
        self.remainder[place] = prints & np.uint64((1 << (self.bits - self.q_bits)) - 1)
        rest, at = counts - 1, place + 1
        while rest.any():
            some = np.flatnonzero(rest)
            self.remainder[at[some]], self.counter[at[some]] = (rest[some] % base).astype(np.uint64), True
            at[some] += 1
            rest = rest // base
        last = np.flatnonzero(np.r_[quotient[1:] != quotient[:-1], True][: len(quotient)])
        self.run_end[place[last] + digits[last]] = True

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints in order, and their counts."""
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        begins = np.maximum(quotients, np.r_[0, ends[:-1] + 1][: len(ends)])  # of runs
        inside = np.zeros(len(self.remainder) + 1, np.int64)
        inside[begins] += 1
        np.add.at(inside, ends + 1, -1)
        used = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        head = used[~self.counter[used]]
        run = np.searchsorted(ends, head)
        prints = quotients[run].astype(np.uint64) << np.uint64(self.bits - self.q_bits) | self.remainder[head]
        counts = np.ones(len(head), np.int64)
        more = used[self.counter[used]]
        if len(more):
            owner = np.searchsorted(head, more) - 1
            counts += np.bincount(owner, self.remainder[more].astype(float) * 65536.0 ** (more - head[owner] - 1), minlength=len(head)).astype(np.int64)
        return prints, counts

    def count(self, fingerprint: int) -> int:
        """Of one fingerprint, by rank and select over the marks of its run alone."""
        q, want = fingerprint >> (self.bits - self.q_bits), fingerprint & ((1 << (self.bits - self.q_bits)) - 1)
        if not self.occupied[q]:
            return 0
        rank = int(self.occupied[:q].sum())
        ends = np.flatnonzero(self.run_end)[max(0, rank - 1) : rank + 1]
        at, end = max(q, int(ends[0]) + 1 if rank else 0), int(ends[-1])
        while at <= end:
            if not self.counter[at] and int(self.remainder[at]) == want:
                n, k = 1, 0
                while at + k + 1 <= end and self.counter[at + k + 1]:
                    n, k = n + (int(self.remainder[at + k + 1]) << (16 * k)), k + 1
                return n
            at += 1
        return 0

    def insert(self, fingerprints: np.ndarray) -> None:
        """Adds fingerprints; the filter grows by moving bits from the remainders to the quotients."""
        merged = merge([self, CountingQuotientFilter(self.bits, *np.unique(fingerprints, return_counts=True))])
        self.__dict__ = merged.__dict__

    def to_bytes(self) -> bytes:
        width = -(-self.r_bits // 8)
        head = np.array([self.bits, self.q_bits, len(self.remainder)], "<i8")
        marks = [np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.counter)]
        return b"".join([head.tobytes(), *marks, self.remainder.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountingQuotientFilter:
        out = cls.__new__(cls)
        out.bits, out.q_bits, slots = np.frombuffer(raw, "<i8", 3).tolist()
        out.r_bits = max(16, out.bits - out.q_bits)
        at = 24
        for name, n in (("occupied", 1 << out.q_bits), ("run_end", slots), ("counter", slots)):
            size = -(-n // 8)
            setattr(out, name, np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=n).astype(bool))
            at += size
        width = -(-out.r_bits // 8)
        wide = np.zeros((slots, 8), np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8, slots * width, at).reshape(slots, width)
        out.remainder = wide.view("<u8").ravel().astype(np.uint64)
        return out


def merge(filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
    """One filter of all fingerprints with their counts added. Filters may differ in slots: quotient and remainder are one order."""
    bits = filters[0].bits
    prints, counts = (np.concatenate(x) for x in zip(*(f.items() for f in filters)))
    order = np.argsort(prints, kind="stable")  # merges the sorted runs
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]][: len(prints)])
    return CountingQuotientFilter(bits, prints[first], np.add.reduceat(counts, first) if len(first) else counts)


def _digests(batches):
    """doc_id, fingerprint and SHA-256 of each normalised text."""
    for batch in sliced(batches):
        raw, off = utf8(batch.column("text"))
        raw, off = raw.tobytes(), off.tolist()
        sha = [hashlib.sha256(normalised(raw[a:b])).digest() for a, b in zip(off[:-1], off[1:])]
        prints = pa.array([int.from_bytes(x[:8], "big", signed=True) for x in sha], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints, pa.array(sha, pa.binary())], ["doc_id", "fp", "sha"])


def _filters(batches):
    """Of each task, its filters by range. Rows wait until they are as many as the filters hold, so that each moves few times."""
    held, waiting, n_held, n_waiting = {}, [], 0, 0
    low = np.uint64((1 << (64 - RANGE_BITS)) - 1)

    def inserted():
        fresh = np.sort(np.concatenate(waiting))
        part = (fresh >> np.uint64(64 - RANGE_BITS)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for a, b in zip(cuts, [*cuts[1:], len(part)]):
            held.setdefault(int(part[a]), CountingQuotientFilter(64 - RANGE_BITS)).insert(fresh[a:b] & low)

    for batch in batches:
        waiting.append(batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        n_waiting += len(waiting[-1])
        if n_waiting >= max(100_000, n_held):
            inserted()
            waiting, n_held, n_waiting = [], n_held + n_waiting, 0
    if n_waiting:
        inserted()
    for part, cqf in held.items():
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "cqf": pa.array([cqf.to_bytes()], pa.binary())})


def _repeated(key, filters):
    """Of one range, a bitmap of the fingerprints with a merged count above one: of bounded size, with false positives."""
    prints, counts = merge([CountingQuotientFilter.from_bytes(x) for x in filters.column("cqf").to_pylist()]).items()
    prints = prints[counts > 1]
    size = 8 * min(BITMAP_BYTES, 1 << max(0, int(np.ceil(np.log2(max(1, len(prints) * BITS_EACH / 8))))))
    bits = np.zeros(size, bool)
    for at in _probes(prints, size):
        bits[at] = True
    some = int(len(prints) > 0)
    return pa.table({"part": pa.array([key[0].as_py()] * some, pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()] * some, pa.binary())})


def _probes(prints: np.ndarray, size: int) -> list[np.ndarray]:
    return [(_mix(prints + np.uint64(k)) % np.uint64(size)).astype(np.int64) for k in (0, 1)]


def _routed(bitmaps):
    def route(batches):
        """The rows whose fingerprint may be counted above one, with their normalised bytes."""
        for batch in sliced(batches):
            raw, off = utf8(batch.column("text"))
            raw, off = raw.tobytes(), off.tolist()
            texts = [normalised(raw[a:b]) for a, b in zip(off[:-1], off[1:])]
            digests = [hashlib.sha256(x).digest() for x in texts]
            prints = np.array([int.from_bytes(x[:8], "big") for x in digests], np.uint64)
            part, low = (prints >> np.uint64(64 - RANGE_BITS)).tolist(), prints & np.uint64((1 << (64 - RANGE_BITS)) - 1)
            found = bitmaps.value
            going = []
            for i, p in enumerate(part):
                bits = found.get(p)
                if bits is not None and all(bits[at[0] >> 3] >> (7 - (at[0] & 7)) & 1 for at in _probes(low[i : i + 1], 8 * len(bits))):
                    going.append(i)
            ids = batch.column("doc_id").to_pylist()
            ids, sha, norm = [ids[i] for i in going], [digests[i] for i in going], [texts[i] for i in going]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sha, pa.binary()), pa.array(norm, pa.binary())], ["doc_id", "sha", "norm"])

    return route


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs(doc_id, text).

    Null text counts as empty. Of rows with equal doc_id in a group each says the same. A null doc_id never stays unless
    its whole group has none. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = staged(rows.mapInArrow(_digests, "doc_id long, fp long, sha binary"), "exact-prints")
    n = prints.count()
    ranges = prints.select("fp").mapInArrow(_filters, "part long, cqf binary")
    bitmaps = ranges.groupBy("part").applyInArrow(_repeated, "part long, bits binary").collect()  # 2 ** RANGE_BITS rows at most
    shared = spark.sparkContext.broadcast({r.part: r.bits for r in bitmaps})

    # Byte verification: rows group by the normalised bytes themselves, and equal ones meet in partial aggregates first.
    routed = rows.mapInArrow(_routed(shared), "doc_id long, sha binary, norm binary")
    groups = routed.groupBy("sha", "norm").agg(F.count("*").alias("group_size"), F.min("doc_id").alias("keep_id"))
    groups = staged(groups.where("group_size > 1").select("sha", "group_size", "keep_id"), "exact-groups")

    done = spread_join(prints.select("doc_id", "sha"), groups.withColumn("n", F.col("group_size")), ["sha"], n, "left")
    return done.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs whose text no row with a smaller doc_id has. Of repeated rows with one doc_id and text, one stays.

    Rows are told apart by doc_id and text, so a doc_id may come with several texts, or be null. Null text counts as empty.
    All columns stay, whatever their names. An empty table gives no rows.
    """
    groups = exact_groups(docs).where("group_size > 1")
    groups = staged(groups.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept")), "exact-decisions")
    name = "_sha"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    ids = groups.select(F.col("doc_id").alias("_id")).distinct()
    number = docs.doc_id.cast("long")
    met = number.eqNullSafe(ids._id)
    some = docs.join(ids, met, "left_semi").withColumn(name, F.sha2(norm_text(docs.text.cast("string")).cast("binary"), 256))
    kept = groups.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_kept"), F.col("kept").alias("_stays"))
    first, same = kept.where("_stays"), lambda k: number.eqNullSafe(k["_id"]) & (some[name] == k["_kept"])
    stays = some.join(first, same(first), "left_semi").dropDuplicates(["doc_id", name])
    alone = some.join(kept, same(kept), "left_anti")
    return docs.join(ids, met, "left_anti").unionByName(stays.drop(name)).unionByName(alone.drop(name))
