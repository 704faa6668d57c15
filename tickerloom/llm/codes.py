"""Product codes of vectors, trained by assignment rounds whose nearest entries are found in GNATs.

Vectors become integers, are cut into parts, and each part has a codebook. A GNAT over a codebook's entries holds split points;
the other entries go to the child of the nearest one, and each split point keeps, for each child, the range of its distances to
the child's entries. A query measures its distance to the split points; a child whose ranges lie further off than the nearest
entry so far, by the triangle inequality, is left out as a whole. Distances are bounded by whole numbers, rounded down and up,
and a child goes only if it is strictly further; entries that are left are told apart by exact squared distances, ties by index.

Rounds are passes over the table: tasks send sums and counts for each entry, and the driver holds the codebooks, whose size
doesn't depend on the table.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import spread_join, staged

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
SPLITS, LEAF = 12, 24  # split points of a node, and entries that are looked at one by one
ROWS = 4096  # vectors searched for at once
_SAFE = 1 << 24  # parts of smaller components are exact in floats and 64 bits; others in whole numbers of any size


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of floats, as 64-bit integers, or Python's where one is too large for exact 64-bit distances."""
    x = np.floor(vectors.astype(np.float64) * SCALE)
    if not x.size or np.abs(x).max() < _SAFE:
        return x.astype(np.int64)
    return np.array([[int(c) for c in row] for row in x.tolist()], object).reshape(x.shape)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances (len(a), len(b)), exact."""
    if a.dtype == object or b.dtype == object:
        return np.array([[sum((int(p) - int(q)) ** 2 for p, q in zip(x, y)) for y in b] for x in a], object).reshape(len(a), len(b))
    most = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if 4 * int(most) ** 2 * max(1, a.shape[1]) < 1 << 52:  # then each sum of the products is exact in floats
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)).astype(np.int64)
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(2)


def root_down(square: np.ndarray) -> np.ndarray:
    """The whole part of the root, of 64-bit squares up to 2 ** 62: no more than the distance; one more is no less than it."""
    if square.dtype == object:
        return np.array([math.isqrt(x) for x in square.ravel()], object).reshape(square.shape)
    root = np.sqrt(square.astype(np.float64)).astype(np.int64)
    root -= root * root > square
    root += (root + 1) * (root + 1) <= square
    return root


class Gnat:
    """A node over entries (indices into points)."""

    def __init__(self, points: np.ndarray, entries: np.ndarray | None = None, splits: int = SPLITS, leaf: int = LEAF):
        self.points = points
        entries = np.arange(len(points)) if entries is None else entries
        self.children: list = []
        if len(entries) <= max(leaf, splits):
            self.own = entries
            return
        self.own = self._chosen(entries, splits)
        rest = np.setdiff1d(entries, self.own)
        far = squares(points[self.own], points[rest])
        nearest = np.argmin(far, 0)
        down = root_down(far)
        for j in range(len(self.own)):
            mine = nearest == j
            if mine.any():
                low, high = down[:, mine].min(1), down[:, mine].max(1) + 1
                self.children.append((j, low, high, Gnat(points, rest[mine], splits, leaf)))

    def _chosen(self, entries: np.ndarray, k: int) -> np.ndarray:
        """The first entry, then again and again the one that is furthest from those chosen."""
        at, far = [0], squares(self.points[entries[:1]], self.points[entries])[0]
        while len(at) < k:
            at.append(int(np.argmax(far)))
            far = np.minimum(far, squares(self.points[entries[at[-1:]]], self.points[entries])[0])
        return np.unique(entries[at])

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Of each query the nearest entry's squared distance and index, the lowest of ties; and how many distances were measured."""
        wide = self.points.dtype == object or queries.dtype == object
        best = np.full(len(queries), 1 << 62, object if wide else np.int64)
        if wide:
            best[:] = 1 << 400
        index, self.measured = np.full(len(queries), len(self.points)), 0
        measured = self._search(queries, np.arange(len(queries)), best, index)
        return best, index, measured

    def _search(self, queries: np.ndarray, which: np.ndarray, best: np.ndarray, index: np.ndarray) -> int:
        far = squares(queries[which], self.points[self.own])
        at = np.argmin(far, 1)  # own entries stand in order of their indices, so ties give the lowest
        least, entry = far[np.arange(len(which)), at], self.own[at]
        better = ((least < best[which]) | ((least == best[which]) & (entry < index[which]))).astype(bool)
        best[which[better]], index[which[better]] = least[better], entry[better]
        measured = far.size
        if not self.children:
            return measured
        down = root_down(far)
        for near in (True, False):  # each query first goes to its nearest split point's child, which brings its bound down
            for j, low, high, child in self.children:
                todo = np.flatnonzero((at == j) == near)
                bound = root_down(best[which[todo]]) + 1
                off = ((down[todo] - high > bound[:, None]) | (low - (down[todo] + 1) > bound[:, None])).astype(bool).any(1)
                if len(left := which[todo[~off]]):
                    measured += child._search(queries, left, best, index)
        return measured


def _cuts(width: int, parts: int) -> list[int]:
    return np.cumsum([0] + [width // parts + (i < width % parts) for i in range(parts)]).tolist()


def _vectors(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


class Codebooks:
    """For each part its entries, integers of any size."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries = entries

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts, n) indices of the nearest entries, and the squared distances summed over the parts."""
        x, cuts = scaled(vectors), _cuts(vectors.shape[1], len(self.entries))
        found = [Gnat(e).nearest(x[:, a:b])[:2] for e, a, b in zip(self.entries, cuts, cuts[1:])]
        return np.stack([i for _, i in found]), sum(d for d, _ in found)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(c)) for e in self.entries for row in e for c in row).encode()).hexdigest()


def usable(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, label, vector: without vectors that are null or hold null, NaN or infinite components."""
    v = rows[column].cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(rows["vec_id"].cast("long").alias("vec_id"), rows["label"].cast("string").alias("label"), v.alias("vector")).where(v.isNotNull() & ~bad)


def _chunks(batches, width: int):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, _vectors(part.column("vector"), width)


def _sums(books: Codebooks, width: int):
    def add(batches):
        """Of the task's vectors, for each part, entry and place the sum, and the count at place -1. 38 digits."""
        cuts, total, count = _cuts(width, len(books.entries)), {}, {}
        for _, vectors in _chunks(batches, width):
            x = scaled(vectors)
            codes, _ = books.codes(vectors)
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                order = np.argsort(codes[p], kind="stable")
                used, begin = np.unique(codes[p][order], return_index=True)
                sums = np.add.reduceat(x[order, a:b], begin, axis=0) if b > a else np.zeros((len(used), 0), np.int64)
                for e, s, n in zip(used.tolist(), sums.tolist(), np.diff(np.r_[begin, len(order)]).tolist()):
                    total[p, e] = [i + j for i, j in zip(total[p, e], s)] if (p, e) in total else s
                    count[p, e] = count.get((p, e), 0) + n
        keys = [(p, e, k) for p, e in total for k in range(-1, len(total[p, e]))]
        if keys:
            values = [count[p, e] if k < 0 else total[p, e][k] for p, e, k in keys]
            names = [pa.array(c, pa.int64()) for c in zip(*keys)]
            yield pa.RecordBatch.from_arrays([*names, pc.cast(pa.array(map(str, values)), pa.decimal128(38, 0))], ["part", "entry", "place", "value"])

    return add


def trained(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Codebooks, int]:
    """The codebooks after so many rounds, and the vectors' width, from vectors of that width.

    The first entries are those of the vectors with the smallest vec_ids; a null vec_id comes last, equal ones go by their
    components. The driver holds the codebooks only.
    """
    order = [F.asc_nulls_last("vec_id"), "vector"]
    one = kept.orderBy(*order).select("vector").limit(1).collect()
    width = len(one[0].vector) if one else 0
    rows = kept.where(F.size("vector") == width)
    first = [r.vector for r in rows.orderBy(*order).select("vector").limit(entries).collect()]
    start = scaled(np.array(first, float).reshape(len(first), width))
    cuts = _cuts(width, parts)
    books = Codebooks([start[:, a:b] for a, b in zip(cuts, cuts[1:])])
    for _ in range(rounds if first else 0):
        sums = rows.select("vector").mapInArrow(_sums(books, width), "part long, entry long, place long, value decimal(38,0)").groupBy("part", "entry", "place").agg(F.sum("value").cast("string").alias("value")).collect()
        value = {(r.part, r.entry, r.place): int(r.value) for r in sums}
        moved = []
        for p, old in enumerate(books.entries):
            new = [[value[p, e, k] // value[p, e, -1] for k in range(old.shape[1])] if (p, e, -1) in value else [int(c) for c in old[e]] for e in range(len(old))]
            small = all(abs(c) < _SAFE for row in new for c in row)
            moved.append(np.array(new, np.int64 if small else object).reshape(old.shape))
        books = Codebooks(moved)
    return books, width


def product_codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each usable vector of rows(vec_id, embedding, label).

    Vectors that are null or hold null, NaN or infinite components are dropped; so are those of another length than the one
    with the smallest vec_id has, as they can't be compared. Where the length isn't a multiple of the number of parts, the
    first parts are one longer; empty vectors are equal to each other. Null labels are one group. Rows that repeat a vec_id
    each count and have a code; a null vec_id starts no entry unless there are too few others. Components are exact at any
    size that floats have; an error beyond 64 bits is null, and so is its label's. Fewer vectors than entries give fewer
    entries. An empty table gives no rows. Other columns are ignored.
    """
    kept = usable(rows)
    books, width = trained(kept, parts, entries, rounds)

    def coded(batches):
        for part, vectors in _chunks(batches, width):
            codes, error = books.codes(vectors)
            text = ["".join(f"{c:02x}" for c in row) for row in codes.T.tolist()]
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(text, pa.string()), pa.array([x if x < 1 << 63 else None for x in error.tolist()], pa.int64())], ["vec_id", "label", "code", "error"])

    found = kept.where(F.size("vector") == width).mapInArrow(coded, "vec_id long, label string, code string, error long")
    found = staged(found.withColumn("key", F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))).drop("label"), "vector-codes")
    whole = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)")))
    labels = found.groupBy("key").agg(F.when(F.abs(whole) < F.lit(str(1 << 63)).cast("decimal(38,0)"), whole).cast("long").alias("label_error"), F.count("*").alias("n"))
    labels = staged(labels, "vector-labels")
    return spread_join(found, labels, ["key"], found.count(), "inner").select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
