"""Near duplicates by an exact n-gram Jaccard join with multiple global orders.

A document's set holds its distinct five-word shingles; documents with the same set are one node. For a similarity of at
least t, two sets must share one of the first |x| - ceil(t |x|) + 1 members under any order of all shingles. Here three
orders are used, which all begin with the shingles that only one node has (those can't be shared: they fill prefixes, and
are neither kept nor sent on): after them one puts rare shingles first, the two others go by two hashes. Nodes meet through
the first order; a pair goes on only where the prefixes meet under the other orders, too, and is then compared whole.

Only links that change the components are looked for. Star rounds take, for each node, a centre among the nodes that it
meets; after them, only pairs of different components are candidates, so a large group of copies of a text does not make
all its pairs. Every pair, of stars or not, passes all orders before it is compared.

Shingles that are common by a sample of the texts go straight to their nodes and come last in the first order, and of a
text that very many rows have, one row sends its shingles; so no bucket grows with one shingle's or text's rows. The
sample decides the way that a shingle takes and its place in the order, and with that no result.
Shingles are told apart by 48 bits of a hash within their bucket, then by 64 bits; nodes by 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import _mix, shingle_sets, sliced, spread_join, staged
from tickerloom.llm.components import components

SHINGLE = 5
PERCENT = 80  # of the union that two sets share at least
ORDERS = 3
STARS = 4  # of a node's rarest shingles find it a centre of their own
STAR_ROUNDS = 2
CROWD = 100  # nodes that meet at one shingle, beyond which they must meet at one of the second order's, too
BUCKET_CHARS = 16_000_000  # characters of text whose shingles one bucket gets, about
SAMPLE_CHARS = 10_000_000  # characters of texts that tell which shingles are common, about
COMMON, COMMON_SHARE = 8, 500  # sampled texts with a common shingle: at least so many, and one in so many
COMMON_CODE = 255
HOT_SHARE = 1000
_SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)


def _binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


_SENT = "bucket long, kind string, part long, doc_id long, hash long, node long, n long, blob binary"
_COUNTED = "kind string, part long, doc_id long, hash long, node long, n long, blob binary"


def _rows(kind: str, schema: str, **columns) -> pa.RecordBatch:
    """Rows of one kind; columns that aren't given are null."""
    names = [(x.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]]) for x in schema.split(", ")]
    k = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array([kind] * k, t) if c == "kind" else columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(k, t) for c, t in names], [c for c, _ in names])


def _parted(node: np.ndarray, buckets: int, *members: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Members of nodes by part of the nodes: the parts, and a blob for each."""
    part = (node % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((node, part))
    node, part, members = node[order], part[order], [m[order] for m in members]
    cuts = _runs(part)
    blobs = []
    for a, b in zip(cuts, [*cuts[1:], len(part)]):
        run = _runs(node[a:b])
        blobs.append(_packed(node[a:b][run], np.diff(np.r_[run, b - a]), *(m[a:b] for m in members)))
    return part[cuts], blobs


def _sent(buckets: int, shared):
    def send(batches):
        """bucket >= 0: shingles of one bucket, by node. Others pass on as they are: documents; nodes' sizes and common shingles by part."""
        hot_texts, common = shared.value
        turn = 0
        for batch in sliced(batches):
            sets = shingle_sets(batch.column("text"), SHINGLE)
            sizes = np.array([len(s) for s in sets], np.int64)
            nodes = np.array([_node(s) for s in sets], np.uint64)
            k = len(sets)
            spread = lambda m: pa.array(-1 - (turn + np.arange(m)) % buckets)  # noqa: B023, E731
            yield _rows("document", _SENT, bucket=spread(k), doc_id=batch.column("doc_id"), hash=batch.column("hash"), node=nodes.view(np.int64), n=sizes)
            turn += k
            silent = np.array([h in hot_texts and hot_texts[h] != d for h, d in zip(batch.column("hash").to_pylist(), batch.column("doc_id").to_pylist())], bool)
            speak = np.flatnonzero((sizes > 0) & ~silent)
            speak = speak[np.unique(nodes[speak], return_index=True)[1]]
            if not len(speak):
                continue
            parts, blobs = _parted(nodes[speak], buckets, sizes[speak].astype("<u4"))
            yield _rows("sizes", _SENT, bucket=spread(len(parts)), part=parts, blob=_binary(blobs))
            tokens = np.concatenate([sets[i] for i in speak])
            owner = np.repeat(np.arange(len(speak)), sizes[speak])
            if len(common):
                is_common = common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens
                if is_common.any():
                    parts, blobs = _parted(nodes[speak][owner[is_common]], buckets, _wide(tokens[is_common]), np.full(int(is_common.sum()), COMMON_CODE, "u1"))
                    yield _rows("shared", _SENT, bucket=spread(len(parts)), part=parts, blob=_binary(blobs))
                    owner, tokens = owner[~is_common], tokens[~is_common]
            bucket = (_mix(tokens) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # within a bucket by node
            bucket, owner, tokens = bucket[order], owner[order], tokens[order]
            low, high = tokens.astype("<u4"), (tokens >> np.uint64(32)).astype("<u2")
            cuts = _runs(bucket)
            blobs = []
            for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
                who, counts = np.unique(owner[a:b], return_counts=True)
                blobs.append(_packed(nodes[speak[who]], counts, low[a:b], high[a:b]))
            yield _rows("bucket", _SENT, bucket=bucket[cuts], blob=_binary(blobs))

    return send


def _wide(tokens: np.ndarray) -> np.ndarray:
    """64-bit identities of shingles."""
    return _mix(tokens ^ np.uint64(_SEEDS[1])).astype("<u8")


def _commons(batches):
    """The distinct shingles of each text."""
    for batch in sliced(batches):
        for s in shingle_sets(batch.column("text"), SHINGLE):
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], ["token"])


def _packed(nodes: np.ndarray, counts: np.ndarray, *members: np.ndarray) -> bytes:
    """Nodes with so many members each, and the members' columns (their kinds are fixed by the reader)."""
    head = np.array([len(nodes), len(members[0])], "<i8")
    return b"".join(x.tobytes() for x in (head, nodes.astype("<u8"), counts.astype("<u4"), *members))


def _unpacked(blob: bytes, *kinds: str) -> tuple[np.ndarray, ...]:
    """The node of each member, and the members' columns."""
    k, m = np.frombuffer(blob, "<i8", 2)
    at, out = 16, []
    for kind, n in (("<u8", k), ("<u4", k), *((x, m) for x in kinds)):
        out.append(np.frombuffer(blob, kind, n, at))
        at += out[-1].nbytes
    return np.repeat(out[0], out[1]), *out[2:]


def _node(s: np.ndarray) -> int:
    """Identity of a set: 64 bits over its sorted members and its size."""
    with np.errstate(over="ignore"):
        return int(_mix(np.bitwise_xor.reduce(_mix(s + np.uint64(len(s)))) + np.add.reduce(_mix(s ^ np.uint64(_SEEDS[0]))) * np.uint64(31) + np.array([len(s)], np.uint64))[0])


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]][: len(x)])


def _counted(buckets: int):
    def count(key, table):
        """Of a bucket, the shingles that at least two nodes have, with a code of how many, as blobs by part of the nodes."""
        if key[0].as_py() < 0:
            return table.drop_columns("bucket")
        node, low, high = (np.concatenate(x) for x in zip(*(_unpacked(x, "<u4", "<u2") for x in table.column("blob").to_pylist())))
        token = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
        order = np.argsort(token, kind="stable")
        token = token[order]
        same = np.r_[False, token[1:] == token[:-1]]
        shared = same | np.r_[same[1:], False]
        node, token = node[order[shared]], token[shared]
        order = np.lexsort((node, token))
        node, token = node[order], token[order]
        fresh = np.r_[True, (token[1:] != token[:-1]) | (node[1:] != node[:-1])][: len(token)]
        node, token = node[fresh], token[fresh]
        first = _runs(token)
        df = np.diff(np.r_[first, len(token)])
        df = np.repeat(df, df)
        node, token, df = node[df > 1], token[df > 1], df[df > 1]
        code = np.frexp(df.astype(np.float64))[1].astype(np.uint8)
        parts, blobs = _parted(node, buckets, _wide(token + np.uint64(key[0].as_py()) * np.uint64(0x9E3779B97F4A7C15)), code)
        return pa.Table.from_batches([_rows("shared", _COUNTED, part=parts, blob=_binary(blobs))])

    return count


def _candidates(key, table):
    """Of one part of the nodes, those with a shared shingle in their prefix: the shared shingles, and each order's prefix."""
    kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
    known, size = (np.concatenate(x) for x in zip(*(_unpacked(b, "<u4") for k, b in zip(kinds, blobs) if k == "sizes")))
    known, once = np.unique(known, return_index=True)
    size = size[once]
    parts = [_unpacked(b, "<u8", "u1") for k, b in zip(kinds, blobs) if k == "shared"] or [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint8))]
    node, token, code = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((token, node))
    node, token, code = node[order], token[order], code[order]
    fresh = np.r_[True, (token[1:] != token[:-1]) | (node[1:] != node[:-1])][: len(token)]
    node, token, code = node[fresh], token[fresh], code[fresh]
    cuts = _runs(node)
    ends = np.r_[cuts[1:], len(node)].astype(np.int64)
    n = size[np.searchsorted(known, node[cuts])].astype(np.int64)
    prefix = n - (PERCENT * n + 99) // 100 + 1 - (n - (ends - cuts))  # without the shingles of one node
    keep = np.flatnonzero(prefix > 0)
    tokens, orders = [], [[] for _ in range(ORDERS)]
    for i in keep:
        a, b, p = cuts[i], ends[i], prefix[i]
        t, c = token[a:b], code[a:b]
        tokens.append(np.sort(t).view(np.int64))
        for k in range(ORDERS):
            by = _mix(t ^ np.uint64(_SEEDS[k]))
            orders[k].append(t[np.argsort(by) if k else np.lexsort((by, c))][:p].view(np.int64))

    def lists(x):
        flat = np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(y) for y in x])].astype(np.int32)), pa.array(flat))

    columns = {"node": pa.array(node[cuts[keep]].view(np.int64), pa.int64()), "n": pa.array(n[keep], pa.int64()), "tokens": lists(tokens)}
    return pa.table(columns | {f"prefix{k}": lists(orders[k]) for k in range(ORDERS)})


def _linked(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of pairs(a, b) that meet under the first order, those that meet under the others, too, and whose sets are similar enough."""
    others = range(1, ORDERS)
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"t_{x}"), *[F.col(f"prefix{k}").alias(f"p{k}_{x}") for k in others])
    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")  # sets are never broadcast
    for k in others:
        both = both.where(F.arrays_overlap(f"p{k}_a", f"p{k}_b"))
    inter = F.size(F.array_intersect("t_a", "t_b"))
    return both.select("a", "b", "n_a", "n_b", inter.alias("inter")).where(F.lit(100) * F.col("inter") >= F.lit(PERCENT) * (F.col("n_a") + F.col("n_b") - F.col("inter"))).select("a", "b")


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, hash (64 bits of the text), n, component_id of every row of docs."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    texts = rows.groupBy("hash").agg(F.count("*").alias("k"), F.min("doc_id").alias("least"), F.max(F.length("text")).alias("chars"))
    texts = staged(texts, "near-texts")
    total = texts.agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("chars")).alias("chars"), F.sum("chars").alias("distinct")).first()
    n, chars = total.n or 0, total.chars or 0
    buckets = max(16, chars // BUCKET_CHARS)
    hot = {r.hash: r.least for r in texts.where(F.col("k") * HOT_SHARE > F.lit(n)).collect() if r.least is not None}  # fewer than HOT_SHARE rows
    rate = F.lit(min(1_000_000, 1_000_000 * SAMPLE_CHARS // max(1, total.distinct or 0)))
    tell = texts.where(F.pmod(F.xxhash64("hash", F.lit(1)), F.lit(1_000_000)) < rate)
    few = max(COMMON, tell.count() // COMMON_SHARE)
    sample = rows.where(F.pmod(F.xxhash64("hash", F.lit(1)), F.lit(1_000_000)) < rate)
    common = sample.select("hash", "text").dropDuplicates(["hash"]).select("text").mapInArrow(_commons, "token long")
    common = sorted(r.token % 2**64 for r in common.groupBy("token").count().where(F.col("count") > few).select("token").collect())  # SAMPLE_CHARS / COMMON rows at most
    shared = spark.sparkContext.broadcast((hot, np.array(common, np.uint64)))
    counted = rows.mapInArrow(_sent(buckets, shared), _SENT).groupBy("bucket").applyInArrow(_counted(buckets), _COUNTED)
    counted = staged(counted, "near-counted")
    info = counted.where("kind = 'document'").select("doc_id", "hash", "node", "n")
    kind = "node long, n long, tokens array<long>, " + ", ".join(f"prefix{k} array<long>" for k in range(ORDERS))
    nodes = staged(counted.where("kind <> 'document'").select("kind", "part", "blob").groupBy("part").applyInArrow(_candidates, kind), "near-nodes")
    roots = _roots(nodes)

    classes = info.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = staged(classes.join(least, "root").select("node", "component_id", F.col("copies").alias("n")), "near-classes")
    own = F.when(F.col("n") > 0, F.col("node")).otherwise(F.monotonically_increasing_id())  # rows of the empty set spread; what they meet is not used
    done = spread_join(info.select("doc_id", "hash", F.col("n").alias("size"), own.alias("node")), classes, ["node"], n, "left")
    return done.select("doc_id", "hash", F.col("size").alias("n"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs(doc_id, text); other columns are ignored.

    Null and empty texts have the empty set and are linked with nothing: their component is their own doc_id. Rows with
    equal doc_id count by their own texts. A null doc_id names no component unless all of it have none. An empty table
    gives no rows.
    """
    return _grouped(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _roots(nodes: DataFrame) -> DataFrame:
    """node, root of all nodes that are linked with another."""
    # Star rounds: each node against a centre of another component, at most two of them: the best of all centres that share
    # one of its prefix shingles, and that of its rarest ones. The first round's best has the fewest shingles of its own,
    # the others' is drawn.
    roots, links = None, None
    posts = nodes.select("node", (F.col("n") - F.size("tokens")).alias("own"), F.posexplode("prefix0").alias("at", "token"))
    for r in range(STAR_ROUNDS):
        rank = F.col("own").cast("long") if r == 0 else F.xxhash64("node", F.lit(r))
        known = posts.withColumn("root", F.col("node")) if roots is None else posts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        centre = known.groupBy("token").agg(F.min(F.struct(rank.alias("rank"), F.col("node").alias("b"), F.col("root").alias("root_b"))).alias("c"))
        met = known.join(centre, "token").where("root <> c.root_b").groupBy("node").agg(F.min("c").alias("best"), F.min(F.when(F.col("at") < STARS, F.col("c"))).alias("rare"))
        stars = met.select(F.col("node").alias("a"), F.explode(F.array("best.b", "rare.b")).alias("b")).where("b is not null").distinct()
        found = staged(_linked(stars, nodes), "near-links")
        links = found if links is None else found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = staged(components(links), "near-roots")

    # Last: all pairs of different components that meet. `left`: members of the set from the shared one on. At the first
    # that two sets share no more than that can be shared, which bounds their similarity; a posting that the bound rules out
    # for the smallest set of its shingle can't be the first of any linked pair. Where a shingle is crowded, nodes meet by
    # pairs of shingles, one of either order: a linked pair has such a pair.
    posts = nodes.select("node", "n", F.posexplode("prefix0").alias("at", "token"), F.size("tokens").alias("shared"))
    posts = posts.select("token", "node", "n", (F.col("shared") - F.col("at")).alias("left")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    posts = staged(posts, "near-posts")
    least = posts.groupBy("token").agg(F.min("n").alias("least"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token", "least")
    posts = posts.join(least, "token").where(_may(F.col("left"), F.col("n") + F.greatest("least", "left"))).drop("least")
    posts = staged(posts, "near-posts")
    mixed = posts.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("many")).where("x <> y").select("token", "many")
    posts = posts.join(mixed, "token")
    crowded = posts.where(F.col("many") > CROWD).join(nodes.select("node", "prefix1").hint("merge"), "node").withColumn("other", F.explode("prefix1")).drop("prefix1", "many")
    posts = staged(posts.where(F.col("many") <= CROWD).drop("many").withColumn("other", F.lit(0).cast("long")).unionByName(crowded), "near-posts")
    side = lambda x: posts.select("token", "other", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "left", "root")])
    may = _may(F.least("left_a", "left_b"), F.col("n_a") + F.col("n_b"))
    pairs = side("a").join(side("b"), ["token", "other"]).where((F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & may).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    more = staged(_linked(pairs, nodes), "near-links")
    if more.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def _may(inter, sizes):
    """Whether sets of so many members together, sharing at most so many, can be similar enough."""
    return F.lit(100) * inter >= F.lit(PERCENT) * (sizes - inter)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs without those whose component has another, smaller doc_id; all columns stay.

    Rows are told by doc_id and text, so a doc_id may come with several texts; of repeated rows all or none stay. A row
    without a doc_id goes if its component has one. Null and empty texts stay. An empty table gives no rows.
    """
    lost = _grouped(docs).where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct()
    lost = staged(lost, "near-lost")
    return docs.join(lost, docs.doc_id.cast("long").eqNullSafe(lost._id) & (F.xxhash64(docs.text.cast("string")) == lost._hash), "left_anti")
