"""A Merkle manifest of a table whose parents keep SHA-256 states.

A leaf is the digest of a row's fields; the leaves of each group, in order, are folded to a subroot by runs of `arity`, and
the subroots, in the order of the groups, to the root. A node's digest is hashed as 64 hex digits, which is exactly one block
of SHA-256: so the state of a parent's hash before each child slot is eight words, which the manifest keeps beside the child.
When a leaf changes, each parent on its path resumes the state before the slot, takes the replacement and the siblings on its
right, and is padded; siblings on the left are never hashed again.

Trees are cut into chunks of arity ** depth nodes, so a group of any size is built and folded by many tasks. Hashes of one
level are computed for a batch of nodes at once, in numpy.
"""

from __future__ import annotations

from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import staged

BATCH = 1 << 14  # nodes hashed at once, about
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _primes(n: int) -> list[int]:
    found: list[int] = []
    p = 2
    while len(found) < n:
        if all(p % q for q in found):
            found.append(p)
        p += 1
    return found


def _cube_root(n: int) -> int:
    x = 1 << -(-n.bit_length() // 3)
    while (y := (2 * x + n // (x * x)) // 3) < x:
        x = y
    return x


#: The algorithm's constants: 32 bits of the fractional parts of primes' square and cube roots.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
_HEX = np.frombuffer(b"".join(b"%04x" % i for i in range(1 << 16)), ">u4").astype(np.uint32)


def _turn(x, k: int):
    return (x >> np.uint32(k)) | (x << np.uint32(32 - k))


def _schedule(block: list) -> list:
    w = list(block)
    for t in range(16, 64):
        a, b = w[t - 15], w[t - 2]
        w.append(w[t - 16] + (_turn(a, 7) ^ _turn(a, 18) ^ (a >> np.uint32(3))) + w[t - 7] + (_turn(b, 17) ^ _turn(b, 19) ^ (b >> np.uint32(10))))
    return [x + k for x, k in zip(w, ROUND)]


def compress(state: np.ndarray, keyed: list) -> np.ndarray:
    """SHA-256 states (8, n) after one more block each; keyed: the block's schedule with the round constants added."""
    a, b, c, d, e, f, g, h = state
    for k in keyed:
        x = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + k
        y = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = x + y, a, b, c, d + x, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def absorbed(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The states after the hex digits of digests (8, n): one block."""
    block = np.empty((16, digests.shape[1]), np.uint32)
    block[0::2] = _HEX[digests >> np.uint32(16)]
    block[1::2] = _HEX[digests & np.uint32(0xFFFF)]
    return compress(state, _schedule(list(block)))


@lru_cache(256)
def _padding(blocks: int) -> list:
    pad = np.zeros((16, 1), np.uint32)
    pad[0], pad[14], pad[15] = 1 << 31, (512 * blocks) >> 32, (512 * blocks) & 0xFFFFFFFF
    return _schedule(list(pad))


def finished(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of states that have taken so many blocks each."""
    out = np.empty_like(state)
    for k in np.unique(blocks).tolist():
        at = blocks == k
        out[:, at] = compress(state[:, at], _padding(k))
    return out


def fresh(n: int) -> np.ndarray:
    return np.repeat(START[:, None], n, 1)


def words(digests) -> np.ndarray:
    """(8, n) of an Arrow column of 32-byte values."""
    return np.ascontiguousarray(np.frombuffer(b"".join(digests.to_pylist()), ">u4").reshape(-1, 8).T.astype(np.uint32))


def raw(digests: np.ndarray) -> np.ndarray:
    """(n, 32) bytes of digests (8, n)."""
    return np.ascontiguousarray(digests.T).astype(">u4").view(np.uint8).reshape(-1, 32)


def _binaries(rows: np.ndarray) -> pa.Array:
    n, k = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def _hexes(digests: np.ndarray) -> pa.Array:
    block = np.empty((digests.shape[1], 16), ">u4")
    block[:, 0::2] = _HEX[digests.T >> np.uint32(16)]
    block[:, 1::2] = _HEX[digests.T & np.uint32(0xFFFF)]
    n = len(block)
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(np.arange(0, n * 64 + 1, 64, dtype=np.int32)), pa.py_buffer(block)])


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the runs of these sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def lifts(n: np.ndarray, arity: int, depth: int) -> np.ndarray:
    """Levels that a chunk climbs in a tree of n nodes: depth, or fewer up to the root where one chunk has all of them."""
    up, left = np.zeros(len(n), np.int64), n.copy()
    while (left > 1).any():
        up, left = up + (left > 1), np.where(left > 1, -(-left // arity), left)
    return np.minimum(up, depth)


def grown(digests: np.ndarray, sizes: np.ndarray, up: np.ndarray, arity: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Tops of chunks (8, chunks), and for each chunk its nodes below the top, level by level: digest and the parent's state before it."""
    tops = np.empty((8, len(sizes)), np.uint32)
    kept: list[list[np.ndarray]] = [[] for _ in sizes]
    chunk, level = np.arange(len(sizes)), 0
    while len(chunk):
        done = up[chunk] == level
        ends = np.cumsum(sizes)
        tops[:, chunk[done]] = digests[:, ends[done] - 1]
        mine = np.repeat(~done, sizes)
        chunk, sizes, digests = chunk[~done], sizes[~done], digests[:, mine]
        if not len(chunk):
            break
        place, parents = _within(sizes), -(-sizes // arity)
        parent = np.repeat(np.cumsum(parents) - parents, sizes) + place // arity
        slot, state = place % arity, fresh(int(parents.sum()))
        before = np.empty_like(digests)
        for j in range(arity):
            at = np.flatnonzero(slot == j)
            before[:, at] = state[:, parent[at]]
            state[:, parent[at]] = absorbed(state[:, parent[at]], digests[:, at])
        entries = np.concatenate([raw(digests), raw(before)], 1)
        for c, a, b in zip(chunk.tolist(), (np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist()):
            kept[c].append(entries[a:b])
        digests, sizes, level = finished(state, np.bincount(parent, minlength=state.shape[1])), parents, level + 1
    return tops, kept


def _whole(batches):
    """Tables of whole chunks of about BATCH rows, from rows sorted by key and chunk, and the chunks' begins."""
    held: list = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= BATCH:
            table = pa.Table.from_batches(held).combine_chunks()
            begins = _begins(table)
            if len(begins) > 1:
                yield table.slice(0, begins[-1]), begins[:-1]
                held = table.slice(begins[-1]).to_batches()
                rows = table.num_rows - begins[-1]
    if rows:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _begins(table)


def _begins(table: pa.Table) -> np.ndarray:
    key = table.column("key").combine_chunks().dictionary_encode()
    code = (key.chunk(0) if isinstance(key, pa.ChunkedArray) else key).indices.to_numpy(zero_copy_only=False)
    chunk = table.column("chunk").to_numpy()
    return np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (chunk[1:] != chunk[:-1])])


def _built(arity: int, depth: int):
    def build(batches):
        for table, begins in _whole(batches):
            sizes = np.diff(np.r_[begins, table.num_rows])
            n = table.column("n").to_numpy()[begins]
            tops, kept = grown(words(table.column("digest")), sizes, lifts(n, arity, depth), arity)
            yield pa.RecordBatch.from_arrays(
                [table.column("key").take(begins).combine_chunks(), pa.array(table.column("chunk").to_numpy()[begins]), pa.array(n), pa.array(sizes), _binaries(raw(tops)), pa.array([b"".join(x.tobytes() for x in k) for k in kept], pa.binary())],
                ["key", "chunk", "n", "size", "digest", "entries"],
            )

    return build


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with idx, from 0, in order within each key, and n, the rows of the key. Staged; no task gets all rows of a key.

    Rows are sorted by ranges of key and order and numbered within each range; then the ranges before are added.
    """

    def local(batches):
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key")
            sizes = np.diff(np.r_[np.flatnonzero(np.r_[True, _changes(key)]), batch.num_rows])
            at = _within(sizes)
            if key[0].as_py() == last:
                at[: sizes[0]] += count
            last, count = key[batch.num_rows - 1].as_py(), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int64)), pa.array(at)], [*batch.schema.names, "part", "at"])

    kinds = ", ".join(f"{c} {k}" for c, k in rows.dtypes)
    ranged = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order).mapInArrow(local, f"{kinds}, part long, at long")
    ranged = staged(ranged, "merkle-ranges")
    sizes = ranged.groupBy("key", "part").agg(F.count("*").alias("here"))
    each = W.partitionBy("key")  # a row for each range
    sizes = sizes.select("key", "part", (F.sum("here").over(each.orderBy("part")) - F.col("here")).alias("base"), F.sum("here").over(each).alias("n"))
    return ranged.join(sizes, ["key", "part"]).withColumn("idx", F.col("base") + F.col("at")).drop("part", "at", "base")


def _changes(column) -> np.ndarray:
    code = column.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return code[1:] != code[:-1]


class Tree:
    """Trees of one level of groups: chunk rows (key, chunk, n, size, digest, entries) of each pass, from the leaves up; tops: key, digest."""

    def __init__(self, nodes: DataFrame, arity: int, depth: int):
        """nodes: key string, idx long, n long, digest binary."""
        self.arity, self.depth, self.passes, span = arity, depth, [], arity**depth
        most = nodes.agg(F.max("n")).first()[0] or 0
        while True:
            chunked = nodes.select("key", F.floor(F.col("idx") / span).cast("long").alias("chunk"), "idx", "n", "digest").repartition("key", "chunk").sortWithinPartitions("key", "chunk", "idx")
            chunks = staged(chunked.mapInArrow(_built(arity, depth), "key string, chunk long, n long, size long, digest binary, entries binary"), "merkle-chunks")
            self.passes.append((nodes, chunks))
            if most <= span:
                break
            nodes, most = chunks.select("key", F.col("chunk").alias("idx"), F.ceil(F.col("n") / span).cast("long").alias("n"), "digest"), -(-most // span)
        self.tops = chunks.select("key", "digest")

    def paths(self, above: DataFrame) -> DataFrame:
        """above, carried down to the chunks of the leaves: key, chunk, path, subroot, root. above: key, path, subroot, root of each tree."""
        span = self.arity**self.depth
        paths = above.select("key", F.lit(0).cast("long").alias("chunk"), "path", "subroot", "root")
        for nodes, chunks in reversed(self.passes[1:]):
            down = _joined(nodes.select("key", F.floor(F.col("idx") / span).cast("long").alias("chunk"), "idx"), chunks, paths, {"idx": "long"})
            paths = staged(down.mapInArrow(_stepped(self.arity, self.depth), "key string, chunk long, path binary, subroot binary, root binary"), "merkle-paths")
        return paths


_MANIFEST = {"n": "long", "entries": "binary", "path": "binary", "subroot": "binary", "root": "binary"}


def _joined(rows: DataFrame, chunks: DataFrame, paths: DataFrame, more: dict[str, str]) -> DataFrame:
    """Rows with their chunk's path (kind 0) and manifest (kind 1) in front of them (kind 2), sorted: one shuffle."""
    names = {"key": "string", "chunk": "long", "kind": "int"} | more | _MANIFEST
    full = lambda df, kind: df.withColumn("kind", F.lit(kind)).select(*[(F.col(c) if c in (*df.columns, "kind") else F.lit(None)).cast(k).alias(c) for c, k in names.items()])
    both = full(paths, 0).unionByName(full(chunks.select("key", "chunk", "n", "entries"), 1)).unionByName(full(rows, 2))
    return both.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "kind")


class _Chunks:
    """A table of whole chunks, made ready: the rows, and of each row its steps from the leaf to the root."""

    def __init__(self, table: pa.Table, begins: np.ndarray, arity: int, depth: int):
        self.arity, self.span = arity, arity**depth
        kind = table.column("kind").to_numpy()
        heads, manifest, leaf = begins, np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
        of = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, table.num_rows]))
        self.rows, self.of = table.take(leaf), of[leaf]
        entries = table.column("entries").take(manifest).to_pylist()
        self.entry = np.frombuffer(b"".join(entries), ">u4").astype(np.uint32).reshape(-1, 16)
        self.base = np.cumsum([0] + [len(x) // 64 for x in entries])[:-1]
        self.head = table.take(heads)
        paths = self.head.column("path").to_pylist()
        width = 4 * (10 + 8 * arity)
        self.steps = np.frombuffer(b"".join(paths), ">u4").astype(np.uint32).reshape(-1, width // 4)
        self.above = np.array([len(x) // width for x in paths])
        self.first = np.cumsum(self.above) - self.above
        count = np.bincount(self.of, minlength=len(heads))
        self.up, left = np.zeros(len(heads), np.int64), np.array([len(x) // 64 for x in entries])
        self.sizes, m = [], count
        while (left > 0).any():
            self.sizes.append(np.where(left > 0, m, 0))
            self.up, left = self.up + (left > 0), left - np.where(left > 0, m, 0)
            m = -(-m // arity)

    def __iter__(self):
        """For each level: the rows that have it, their slots, numbers of children, states before the slot (8, n), children (arity, 8, n)."""
        place = self.rows.column("idx").to_numpy() % self.span
        base, level = self.base.copy(), 0
        while True:
            inside = np.flatnonzero(self.up[self.of] > level)
            outside = np.flatnonzero((self.up[self.of] <= level) & (self.up[self.of] + self.above[self.of] > level))
            if not len(inside) and not len(outside):
                return
            c = self.of[inside]
            m = self.sizes[level][c] if len(inside) else np.zeros(0, np.int64)
            slot = place[inside] % self.arity
            start = place[inside] - slot
            count = np.minimum(self.arity, m - start)
            at = base[c] + place[inside]
            state = self.entry[at, 8:]
            run = np.stack([self.entry[base[c] + start + np.minimum(j, count - 1), :8] for j in range(self.arity)])
            far = self.first[self.of[outside]] + level - self.up[self.of[outside]]
            step = self.steps[far]
            rows = np.r_[inside, outside]
            runs = np.concatenate([run, step[:, 10:].reshape(-1, self.arity, 8).transpose(1, 0, 2)], 1)
            yield rows, np.r_[slot, step[:, 0].astype(np.int64)], np.r_[count, step[:, 1].astype(np.int64)], np.ascontiguousarray(np.r_[state, step[:, 2:10]].T), np.ascontiguousarray(runs.transpose(0, 2, 1))
            if level < len(self.sizes):
                base = base + self.sizes[level]
            place = place // self.arity
            level += 1


def _stepped(arity: int, depth: int):
    def step(batches):
        """The path of each row's node: the steps of its chunk and of what is above."""
        for table, begins in _whole(batches):
            chunks = _Chunks(table, begins, arity, depth)
            n = chunks.rows.num_rows
            paths: list[list[bytes]] = [[] for _ in range(n)]
            for rows, slot, count, state, runs in chunks:
                steps = np.concatenate([np.stack([slot, count], 1).astype(np.uint32), state.T, runs.transpose(2, 0, 1).reshape(len(rows), -1)], 1).astype(">u4")
                for i, r in enumerate(rows.tolist()):
                    paths[r].append(steps[i].tobytes())
            head = chunks.head.take(pa.array(chunks.of))
            yield pa.RecordBatch.from_arrays([chunks.rows.column("key").combine_chunks(), chunks.rows.column("idx").combine_chunks(), pa.array([b"".join(p) for p in paths], pa.binary()), head.column("subroot").combine_chunks(), head.column("root").combine_chunks()], ["key", "chunk", "path", "subroot", "root"])

    return step


def _folded(arity: int, depth: int):
    def fold(batches):
        """Each leaf's proof and the root that its replacement gives."""
        for table, begins in _whole(batches):
            chunks = _Chunks(table, begins, arity, depth)
            leaf = words(chunks.rows.column("digest"))
            now = words(chunks.rows.column("now"))
            n = leaf.shape[1]
            proof, taken = fresh(n), np.zeros(n, np.int64)
            for rows, slot, count, state, runs in chunks:
                state = absorbed(state, now[:, rows])
                for j in range(arity):
                    right = np.flatnonzero((j > slot) & (j < count))
                    if len(right):
                        state[:, right] = absorbed(state[:, right], runs[j][:, right])
                    other = np.flatnonzero((j != slot) & (j < count))
                    if len(other):
                        proof[:, rows[other]] = absorbed(proof[:, rows[other]], runs[j][:, other])
                        taken[rows[other]] += 1
                now[:, rows] = finished(state, count)
            head = chunks.head.take(pa.array(chunks.of))
            root = words(head.column("root"))
            yield pa.RecordBatch.from_arrays(
                [chunks.rows.column("doc_id").combine_chunks(), _hexes(leaf), _hexes(words(head.column("subroot"))), _hexes(root), _hexes(finished(proof, taken)), _hexes(now), pa.array((root == now).all(0))],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    return fold


def leaf(docs: DataFrame, changed: dict[str, Column] | None = None) -> Column:
    """SHA-256 of the row's fields, 32 bytes: each is - if null, else its UTF-8 byte count, a colon and its text."""
    parts = []
    for c in FIELDS:
        value = (changed or {}).get(c, docs[c]).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


class Manifest:
    """The manifest of a table of documents: trees of the leaves of each lang, and the tree of their subroots, staged."""

    def __init__(self, docs: DataFrame, changed: dict[str, Column] | None = None, arity: int = 2, depth: int = 10):
        """changed: columns in place of those of docs in the rows that replace them."""
        self.arity = arity
        key = F.when(docs["lang"].isNull(), F.lit("")).otherwise(F.concat(F.lit("="), docs["lang"].cast("string")))
        rows = docs.select(key.alias("key"), docs["doc_id"].cast("long").alias("doc_id"), leaf(docs).alias("digest"), leaf(docs, changed).alias("now"), F.monotonically_increasing_id().alias("place"))
        self.rows = staged(numbered(staged(rows, "merkle-leaves"), ["doc_id", "digest", "place"]).drop("place"), "merkle-rows")
        self.leaves = Tree(self.rows.select("key", "idx", "n", "digest"), arity, depth)
        tops = self.leaves.tops.select(F.lit("").alias("key"), F.col("key").alias("lang"), "digest")
        self.groups = staged(numbered(tops, ["lang"]), "merkle-groups")
        self.top = Tree(self.groups.select("key", "idx", "n", "digest"), arity, depth)

    def folds(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row."""
        span = self.arity**self.top.depth
        none = F.lit(b"")
        chunk = F.floor(F.col("idx") / span).cast("long").alias("chunk")
        above = self.top.paths(self.top.tops.select("key", none.alias("path"), none.alias("subroot"), F.col("digest").alias("root")))
        heads = _joined(self.groups.select("key", chunk, "idx"), self.top.passes[0][1], above, {"idx": "long"}).mapInArrow(_stepped(self.arity, self.top.depth), "key string, chunk long, path binary, subroot binary, root binary")
        heads = heads.join(self.groups.select(F.col("idx").alias("chunk"), "lang", "digest"), "chunk").select(F.col("lang").alias("key"), "path", F.col("digest").alias("subroot"), "root")
        paths = self.leaves.paths(staged(heads, "merkle-heads"))
        rows = _joined(self.rows.select("key", chunk, "idx", "doc_id", "digest", "now"), self.leaves.passes[0][1], paths, {"idx": "long", "doc_id": "long", "digest": "binary", "now": "binary"})
        return rows.mapInArrow(_folded(self.arity, self.leaves.depth), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def tamper_check(docs: DataFrame, arity: int = 2, depth: int = 10) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: documents whose doc_id's CRC-32 is a multiple of 7 have 1 added to n_chars.

    A null field is a dash in the leaf, a null lang a group of its own, the first; a null doc_id comes first in its group and
    isn't tampered with. Rows that repeat a doc_id stand in the order of their leaves; rows that are alike in all fields are
    leaves each. A null n_chars stays null, so its row is verified. An empty table gives no rows. Other columns are ignored.
    """
    touched = docs["doc_id"].isNotNull() & (F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0)
    count = F.when(touched, docs["n_chars"] + 1).otherwise(docs["n_chars"])
    return Manifest(docs, {"n_chars": count}, arity, depth).folds()
