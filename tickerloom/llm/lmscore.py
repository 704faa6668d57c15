"""Language-model scores: an add-one word model over the whole corpus, and a causal self-attention model on subword ids.

Texts are cut into chunks of some megabytes. A chunk stores its distinct words once, with their subword ids, and its texts
as places in that list, frequent words first. It asks for the corpus counts of its keys: words, segments and their anchors.
Keys meet by ranges of their hashes in one shuffle, a chunk's keys of a range packed in one row, and the counts that a chunk
doesn't know go back to it in another, so no vocabulary is held whole anywhere. Packed arrays are compressed byte by byte of
their numbers.

The model of a text, over words and one end:
- Self-attention over the subword ids before it gives the class of each id; within its class an id has its share of the
  training texts. Windows of CONTEXT + STRIDE ids overlap by CONTEXT: each id is scored once, in a batch of windows under
  one causal mask. Ids that begin a word and ids that go on are classes apart, so the chance that a word ends is known.
- A word is its first id, times either its own discounted count among the words with that id, or its spelling by
  the attention model with the mass that discounting leaves (absolute discounting).
- A text falls into segments at places that follow from its words alone. A segment comes with the chance MEMORY from
  those that followed the same anchor (the three words before it) in the training texts, else word by word.
Counts that a training text is scored with leave out its own (all but the counts by id), so that texts which learning saw
and others are scored alike.

Attention begins on a bounded sample of windows of all training texts; from there groups pass over all windows of all
training texts, and the groups' steps are averaged, each input class's by how often a group saw it. Windows are drawn,
grouped and ordered by hashes of the texts and doc_ids, not by where the rows lie. The counts are those of all training texts.
Subword ids come from a public tokenizer's ranks, whose path is a parameter.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import Words, _mix, crc_mod, sliced, staged

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
FOLDS, HELD = 7, 2  # held out: crc32(doc_id) mod FOLDS = HELD
CHUNK_BYTES = 6 << 20
PART = 1 << 20  # keys of a part, about: a range of hashes whose keys are counted together
SAMPLE = 40_000  # windows that the attention model begins on, at most; then it passes over all windows of all training texts
GROUP = 100_000  # windows of a group of that pass, about
UNIT = 256  # windows of a text that go to a group together
PLAIN = 0.1  # of each id's chance that comes from the counts of ids alone
CONTEXT, STRIDE = 4, 12
INPUTS, WIDTH = 1024, 16  # input classes, width of a head
ALONE, BINS = (56, 56), (6, 10)  # output classes of one id and of several, of ids that begin a word and that go on
CLASSES = sum(ALONE) + sum(BINS)
HALVES = (slice(0, ALONE[0] + BINS[0]), slice(ALONE[0] + BINS[0], CLASSES))  # classes of ids that begin a word; of those that go on
SIDES, REST = ("ask", "own", "offer", "carry"), ("out", "gate", "near")  # tables with a row for each input class; the others
PLACES = np.maximum(0, np.arange(CONTEXT, CONTEXT + STRIDE)[:, None] - np.arange(CONTEXT + STRIDE))  # how far back each place of a window lies
MASK = np.where(np.arange(CONTEXT, CONTEXT + STRIDE)[:, None] >= np.arange(CONTEXT + STRIDE), 0.0, -1e9).astype(np.float32)
STEPS, BATCH, RATE = 1000, 128, 0.01
PASS_RATE = 0.002  # of the pass over all training texts
DISCOUNT = 0.75  # of a word's count
MEMORY = 0.1  # chance that a segment is one that followed its anchor elsewhere
ANCHOR, SEGMENT = 3, 48  # words of an anchor; words of a segment, about
PIECE_WORDS = 100_000  # words of a chunk's texts that are worked on at once, about
SCORED = 128  # windows that are scored at once
#: Fixed value: the tokenizer's pattern of pieces.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OPENING, _CLOSING = np.uint64(0x452821E638D01377), np.uint64(0xBE5466CF34E90C6C)
_ENCODERS: dict = {}
_ONES = np.ones(CLASSES, np.float32)


def encoder(ranks: bytes):
    """The tokenizer, once for each worker."""
    if ranks not in _ENCODERS:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODERS[ranks] = tiktoken.Encoding("subwords", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _ENCODERS[ranks]


def subwords(words: list[str] | str, ranks: bytes, n: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word with a blank before it, one after the other; and how many each has. A str is n words, a blank before each.

    Pieces of the pattern don't go over a blank before a word, so all words are cut at once: an id that begins with a blank
    begins a word. Where odd white space inside words makes that fail, they are cut one by one.
    """
    e = encoder(ranks)
    if words:
        text, n = (words, n) if isinstance(words, str) else (" " + " ".join(words), len(words))
        ids = np.array(e.encode_ordinary(text), np.uint32)
        begin = np.flatnonzero(_blank(ranks)[ids])
        if len(begin) == n:
            return ids, np.diff(np.r_[begin, len(ids)])
    each = [e.encode_ordinary(" " + w) for w in (words[1:].split(" ") if words and isinstance(words, str) else words)]
    return np.fromiter((i for x in each for i in x), np.uint32), np.fromiter(map(len, each), np.int64, len(each))


def joined(w: Words, at: np.ndarray) -> str:
    """Some of the words, a blank before each."""
    size = w.end[at] - w.begin[at] + 1
    end = np.cumsum(size)
    if size.sum() > 2 * CHUNK_BYTES:  # of a longer text, whose bytes' places would take much memory
        return "".join(" " + w.low[a:b].tobytes().decode() for a, b in zip(w.begin[at].tolist(), w.end[at].tolist()))
    raw = w.low[np.arange(size.sum()) + np.repeat(w.begin[at] - 1 - (end - size), size)]
    raw[end - size] = ord(" ")
    return raw.tobytes().decode()


def _blank(ranks: bytes) -> np.ndarray:
    """Of each id, whether it begins with a blank."""
    if (ranks, "blank") not in _ENCODERS:
        table = {int(b): base64.b64decode(a)[:1] == b" " for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODERS[ranks, "blank"] = np.array([table.get(i, False) for i in range(max(table) + 1)])
    return _ENCODERS[ranks, "blank"]


def segments(h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts' word hashes: where each segment begins among all tokens (a text's words, then its end); anchors; identities.

    A segment begins with a text, and after each ANCHOR words of a text whose hash is a multiple of SEGMENT.
    """
    n, texts = len(h), len(of) - 1
    anchor = np.zeros(max(0, n - ANCHOR + 1), np.uint64)
    for k in range(ANCHOR):
        anchor = _mix(anchor + h[k : k + len(anchor)] + np.uint64(k))
    text = np.repeat(np.arange(texts), np.diff(of))
    after = np.flatnonzero(anchor % np.uint64(SEGMENT) == 0)
    after = after[text[after] == text[after + ANCHOR - 1]]  # anchors inside one text
    begin = np.r_[of[:-1] + np.arange(texts), after + ANCHOR + text[after]]  # ends of earlier texts are tokens, too
    order = np.argsort(begin, kind="stable")
    begin, anchor = begin[order], np.r_[np.full(texts, _OPENING), anchor[after]][order]
    token = np.empty(n + texts, np.uint64)
    token[np.arange(n) + text] = h
    token[of[1:] + np.arange(texts)] = _CLOSING
    size = np.diff(np.r_[begin, len(token)])
    inside = (np.arange(len(token)) - np.repeat(begin, size)).astype(np.uint64)
    with np.errstate(over="ignore"):
        body = np.add.reduceat(_mix(token + inside * np.uint64(0x9E3779B97F4A7C15)), begin) if len(begin) else token
        anchor = _mix(anchor ^ np.uint64(0x3C6EF372FE94F82B))
        return begin, anchor, _mix(body + anchor + size.astype(np.uint64))


def _zip(x: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones and so on, compressed: the higher bytes are few or none."""
    raw, planes = x.view(np.uint8).reshape(-1, x.itemsize), np.empty((x.itemsize, len(x)), np.uint8)
    for j, plane in enumerate(planes):  # in a fraction of the time that the copy of a turned array takes
        plane[:] = raw[:, j]
    return np.array([x.nbytes], "<i8").tobytes() + pa.compress(pa.py_buffer(planes), "zstd", asbytes=True)


def _unzip(x: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(x[8:], int.from_bytes(x[:8], "little"), "zstd", asbytes=True), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    raw = np.empty(planes.shape[::-1], np.uint8)
    for j, plane in enumerate(planes):
        raw[:, j] = plane
    return raw.view(kind).ravel()


def _steps(x: np.ndarray) -> np.ndarray:
    """Each number less the one before it, over zero; their running sums give the numbers back."""
    return np.diff(x, prepend=x.dtype.type(0))


def _chunks(ranks, n_ids: int):
    def cut(batches):
        """A row for each chunk. places: each text's words as places in the chunk's words, the frequent ones first, then by their hashes."""
        for batch in sliced(batches, most=CHUNK_BYTES):
            w = Words(batch.column("text"))
            h = w.hashes()
            place, known = pd.factorize(h)
            first = np.empty(len(known), np.int64)
            first[place[::-1]] = np.arange(len(h))[::-1]
            order = np.lexsort((known, -np.bincount(place, minlength=len(known))))
            known, first, place = known[order], first[order], np.argsort(order)[place]
            sizes = np.diff(w.of)
            taught = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            counts = np.bincount(place[np.repeat(taught, sizes)], minlength=len(known))
            flat, lens = subwords(joined(w, first), ranks.value, len(first))
            used = np.bincount(flat, np.repeat(counts, lens), minlength=n_ids)
            some = np.flatnonzero(used)
            begin, anchor, seg = segments(h, w.of)
            text = np.searchsorted(w.of + np.arange(len(w.of)), begin, "right") - 1
            keys, kinds, many, spots = [known], [flat[np.cumsum(lens) - lens].astype("<i4")], [counts], []
            for kind, x in ((-1, anchor), (-2, seg)):
                each, spot = np.unique(x, return_inverse=True)
                keys.append(each)
                kinds.append(np.full(len(each), kind, "<i4"))
                many.append(np.bincount(spot[taught[text]], minlength=len(each)))
                spots.append(_zip(spot.astype("<i4")))
            columns = {
                "doc_ids": [batch.column("doc_id").to_pylist()], "held": [(~taught).tolist()], "sizes": [sizes.tolist()], "places": [_zip(place.astype("<i4"))], "ids": [_zip(flat.astype("<u4"))], "lens": [_zip(lens.astype("<u4"))],
                "begins": [_zip(begin.astype("<i8"))], "anchors": [spots[0]], "segs": [spots[1]], "keys": [_zip(_steps(np.concatenate(keys).astype("<u8")))], "n_keys": [sum(map(len, keys))], "kinds": [_zip(np.concatenate(kinds))], "counts": [_zip(np.concatenate(many).astype("<i8"))],
                "used": [some.tolist()], "uses": [used[some].astype(np.int64).tolist()],
            }
            yield pa.RecordBatch.from_pydict(columns, schema=_SCHEMA)

    return cut


_BLOBS = ("places", "ids", "lens", "begins", "anchors", "segs", "keys", "kinds", "counts")
_SCHEMA = pa.schema([("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64()))] + [(c, pa.binary()) for c in _BLOBS] + [("n_keys", pa.int64()), ("used", pa.list_(pa.int64())), ("uses", pa.list_(pa.int64()))])
_KIND = "doc_ids array<long>, held array<boolean>, sizes array<long>, " + ", ".join(f"{c} binary" for c in _BLOBS) + ", n_keys long, used array<long>, uses array<long>"


def _asked(batches):
    """A row for each key of a chunk: its place among them, kind (a word's first id, -1 anchor, -2 segment), count in the training texts."""
    for batch in batches:
        for chunk, keys, kinds, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "keys", "kinds", "counts"))):
            k = np.cumsum(_unzip(keys, "<u8")).view("<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), chunk)), pa.array(np.arange(len(k), dtype=np.int32)), pa.array(k), pa.array(_unzip(kinds, "<i4")), pa.array(_unzip(counts, "<i8"))], ["chunk", "place", "key", "kind", "n"])


def _dealt(parts: int):
    def deal(batches):
        """A row for each part (a range of hashes) that a chunk has keys of, with these keys in their order, packed."""
        for asked in _asked(batches):
            key, place, kind, n = (asked.column(c).to_numpy() for c in ("key", "place", "kind", "n"))
            key = key.view("<u8")
            order = np.argsort(key)
            key, place, kind, n = key[order], place[order], kind[order], n[order]
            part = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part)) + 1
            of = part[np.r_[0, cuts]] if len(part) else part
            packed = [[_zip(f(x)) for x in np.split(a, cuts)] if len(of) else [] for a, f in ((key, _steps), (place, np.asarray), (kind, np.asarray), (n, np.asarray))]
            yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(np.full(len(of), asked.column("chunk")[0].as_py() if len(of) else 0)), *(pa.array(x, pa.binary()) for x in packed)], ["part", "chunk", "keys", "places", "kinds", "counts"])

    return deal


_COUNTED = "chunk long, places binary, totals binary, kinds array<int>, types array<long>, masses array<long>"


def _counted(table: pa.Table) -> pa.Table:
    """Of a part's keys: for each chunk, the places of keys that other chunks count, too, and their totals; and one row without
    a chunk with the distinct words of each first id that training texts have, and how often they come."""
    rows = table.to_pylist()
    key, place, kind, n = (np.concatenate([np.cumsum(x) if c == "keys" else x for x in (_unzip(r[c], k) for r in rows)]) for c, k in (("keys", "<u8"), ("places", "<i4"), ("kinds", "<i4"), ("counts", "<i8")))
    sizes = [int.from_bytes(r["places"][:8], "little") // 4 for r in rows]
    order = np.lexsort((kind, key))
    key, sorted_kind = key[order], kind[order]
    begin = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (sorted_kind[1:] != sorted_kind[:-1])])
    sums = np.add.reduceat(n[order], begin)
    total = np.empty_like(n)
    total[order] = np.repeat(sums, np.diff(np.r_[begin, len(order)]))
    first, word = sorted_kind[begin], (sorted_kind[begin] >= 0) & (sums > 0)
    ids, at = np.unique(first[word], return_inverse=True)
    mass = np.zeros(len(ids), np.int64)
    np.add.at(mass, at, sums[word])
    more = np.split(total != n, np.cumsum(sizes)[:-1])
    packed = [[_zip(np.ascontiguousarray(x[m])) for x, m in zip(np.split(a, np.cumsum(sizes)[:-1]), more)] for a in (place, total)]
    k = len(rows)
    return pa.table({
        "chunk": pa.array([r["chunk"] for r in rows] + [None], pa.int64()), "places": pa.array(packed[0] + [None], pa.binary()), "totals": pa.array(packed[1] + [None], pa.binary()),
        "kinds": pa.array([None] * k + [ids.tolist()], pa.list_(pa.int32())), "types": pa.array([None] * k + [np.bincount(at, minlength=len(ids)).tolist()], pa.list_(pa.int64())), "masses": pa.array([None] * k + [mass.tolist()], pa.list_(pa.int64())),
    })


def _answered(score):
    def answered(packed: pa.Table, chunk: pa.Table) -> pa.Table:
        """A chunk's scores, with the totals that all parts have for it."""
        place, total = (np.concatenate([np.zeros(0, k), *(_unzip(x, k) for x in packed.column(c).to_pylist())]) for c, k in (("places", "<i4"), ("totals", "<i8")))
        return score(pa.table({"place": place, "total": total}), chunk)

    return answered


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, which stays with one place; a product with ones takes a fraction of the time of sum."""
    return (x.reshape(-1, x.shape[-1]) @ _ONES[: x.shape[-1]]).reshape(*x.shape[:-1], 1)


def _powers(f) -> tuple[np.ndarray, np.ndarray]:
    """Powers of e of the numbers that f gives, and their sums over the last axis. Where a sum would leave the range of floats, each row's are less its greatest."""
    with np.errstate(over="ignore"):
        x = f()
        np.exp(x, out=x)
        total = _sums(x)
    if total.size and not (total.min() > 1e-30 and total.max() < 1e30):
        x = f()
        x -= x.max(-1, keepdims=True)
        np.exp(x, out=x)
        total = _sums(x)
    return x, total


def _class_powers(h: np.ndarray, out: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows h and a half's classes: powers of e without their biases, a factor for each class that stands for its bias, and
    the sums of powers times factors. Where these would leave the range of floats, the biases and each row's greatest go into the powers."""
    x = room[: len(h) * out.shape[1]].reshape(len(h), out.shape[1])
    factor = np.exp(out[-1] - out[-1].max())
    with np.errstate(over="ignore", invalid="ignore"):
        np.matmul(h, out[:-1], out=x)
        np.exp(x, out=x)
        total = x @ factor
    if factor.min() > 1e-20 and (not total.size or total.min() > 1e-20 and total.max() < 1e20):
        return x, factor, total
    np.matmul(h, out[:-1], out=x)
    x += out[-1]
    x -= x.max(-1, keepdims=True)
    np.exp(x, out=x)
    return x, np.ones_like(factor), x.sum(-1)


def _sides(x: np.ndarray) -> list[np.ndarray]:
    return [x[:, :, i : i + WIDTH] for i in range(0, len(SIDES) * WIDTH, WIDTH)]


class Tables:
    """A model's tables side by side, and room for the arrays of a batch of windows, which all batches use: their memory is not
    taken and given back each time. Steps (Adam) change these tables and not those that they are copied from."""

    def __init__(self, p: dict, most: int = BATCH):
        n, window, wide = INPUTS * len(SIDES) * WIDTH, CONTEXT + STRIDE, len(SIDES) * WIDTH
        self.flat = np.concatenate([np.hstack([p[k] for k in SIDES]).ravel(), *(p[k].ravel() for k in REST)])
        self.rows, self.rest = self.flat[:n].reshape(INPUTS, wide), self.flat[n:]
        self.slope = np.zeros_like(self.rest)  # gradient of the rest
        self.p, self.slopes, at = {k: self.rows[:, i * WIDTH : (i + 1) * WIDTH] for i, k in enumerate(SIDES)}, {}, 0
        for k in REST:
            self.p[k], self.slopes[k] = (x[at : at + p[k].size].reshape(p[k].shape) for x in (self.rest, self.slope))
            at += p[k].size
        self.n = self.since = 0  # steps; those since the sums of gradients were scaled
        self.spare = np.empty((most, STRIDE, window), np.float32)
        self.taken, self.back = np.zeros((2, most, window, wide), np.float32)  # what windows take of the rows, and the gradient of it
        self.turned, self.share, self.shift = (np.empty((most, *s), np.float32) for s in ((WIDTH, window), (STRIDE, window), (STRIDE, window)))
        self.h, self.dh = np.empty((2, most, STRIDE, WIDTH), np.float32)
        self.mine, self.ways = (np.zeros((most * STRIDE + 1, WIDTH), np.float32) for _ in range(2))
        self.powers = np.empty(most * STRIDE * max(h.stop - h.start for h in HALVES), np.float32)
        self.sorted = np.empty((most * window, wide), np.float32)

    def forward(self, x: np.ndarray) -> np.ndarray:
        """What is carried to each of the last STRIDE places of windows x of input classes, a row each."""
        n = len(x)
        taken, turned, share, h = self.taken[:n], self.turned[:n], self.share[:n], self.h[:n]
        self.rows.take(x, 0, out=taken, mode="clip")
        ask, own, offer, carry = _sides(taken)
        np.multiply(offer.transpose(0, 2, 1), np.float32(WIDTH**-0.5), out=turned)
        near = self.p["near"][PLACES] + MASK

        def scores():
            np.matmul(ask[:, CONTEXT:], turned, out=share)
            return np.add(share, near, out=share)

        _, total = _powers(scores)
        np.divide(share, total, out=share)
        np.matmul(share, carry, out=h)
        h += own[:, CONTEXT:]
        return h.reshape(-1, WIDTH)

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the mean cross-entropy over the places that have a class: of its half, and of the class within that half. The input
        classes of the windows, and the gradient of their rows; slopes has that of the rest."""
        k, y, h = len(x), y.ravel(), self.forward(x)
        gate, out = self.p["gate"], self.p["out"]
        n = np.float32(max(1, (y >= 0).sum()))
        begins = h @ gate[:-1]
        begins += gate[-1]
        np.minimum(np.maximum(begins, -60, out=begins), 60, out=begins)
        begins = 1 / (1 + np.exp(-begins))
        begins -= y < HALVES[1].start
        begins *= y >= 0
        begins /= n
        np.matmul(begins, h, out=self.slopes["gate"][:-1])
        self.slopes["gate"][-1] = begins.sum()
        where, b = np.full(len(h), len(h)), 0  # a place's row in ways; the last is zero
        for half in HALVES:
            place = np.flatnonzero((y >= half.start) & (y < half.stop))
            mine, ways = self.mine[b : b + len(place)], self.ways[b : b + len(place)]
            where[place] = np.arange(b, b := b + len(place))
            h.take(place, 0, out=mine, mode="clip")
            d, factor, total = _class_powers(mine, out[:, half], self.powers)
            i, part = y.take(place) - half.start, 1 / (total * n)
            d.ravel()[np.arange(len(place)) * d.shape[1] + i] -= total / factor.take(i)
            np.matmul(d, (out[:-1, half] * factor).T, out=ways)
            ways *= part[:, None]
            mine *= part[:, None]
            self.slopes["out"][:-1, half] = (mine.T @ d) * factor
            self.slopes["out"][-1, half] = (part @ d) * factor
        self.ways[len(h)] = 0
        taken, back, share, dh, ds = self.taken[:k], self.back[:k], self.share[:k], self.dh[:k], self.shift[:k]
        self.ways.take(where, 0, out=dh.reshape(-1, WIDTH), mode="clip")
        dh += np.multiply(begins.reshape(k, STRIDE, 1), gate[:-1], out=self.h[:k])
        (ask, _, offer, carry), (to_ask, to_own, to_offer, to_carry) = _sides(taken), _sides(back)
        self.turned[:k] = carry.transpose(0, 2, 1)
        np.matmul(dh, self.turned[:k], out=ds)
        ds -= _sums(np.multiply(ds, share, out=self.spare[:k]))
        ds *= share
        self.slopes["near"][:] = np.bincount(PLACES.ravel(), np.ones(k, np.float32) @ ds.reshape(k, -1), minlength=CONTEXT + STRIDE)
        ds *= np.float32(WIDTH**-0.5)
        np.matmul(ds, offer, out=to_ask[:, CONTEXT:])  # places that are context only ask for nothing, there back stays zero
        to_own[:, CONTEXT:] = dh
        np.matmul(ds.transpose(0, 2, 1), ask[:, CONTEXT:], out=to_offer)
        np.matmul(share.transpose(0, 2, 1), dh, out=to_carry)
        i = x.ravel().astype(np.uint16)
        order = np.argsort(i, kind="stable")
        some = back.reshape(len(i), -1).take(order, 0, out=self.sorted[: len(i)], mode="clip")
        i, new = i.take(order), np.ones(len(i), bool)
        np.not_equal(i[1:], i[:-1], out=new[1:])
        starts = np.flatnonzero(new)
        return i.take(starts), np.add.reduceat(some.view(np.complex64), starts).view(np.float32)  # two numbers as a complex one are added at once

    def step(self, x: np.ndarray, y: np.ndarray, rate: float) -> None:
        """Down the gradient. The sums of gradients are kept over the powers of their decay, so that a step adds to those of the rows
        that it saw alone; their constant factors are left to the rate and the floor."""
        if not self.n:
            self.m, self.v, self.room = (np.zeros_like(self.flat) for _ in range(3))
        seen, grad = self.gradient(x, y)
        self.n += 1
        self.since += 1
        fast, slow = 0.9**self.since, 0.99**self.since
        for g, at, to in ((grad, seen, slice(None, self.rows.size)), (self.slope[:, None], slice(None), slice(self.rows.size, None))):
            m, v = (a[to].reshape(-1, g.shape[1]) for a in (self.m, self.v))
            v[at] += g * g * np.float32(1 / slow)
            g *= np.float32(1 / fast)
            m[at] += g
        scale = (0.01 / (1 - 0.99**self.n)) ** 0.5
        floor, rate = np.float32(1e-8 / scale / slow**0.5), np.float32(0.1 * rate / (1 - 0.9**self.n) / scale * fast / slow**0.5)
        np.sqrt(self.v, out=self.room)
        self.room += floor
        np.divide(self.m, self.room, out=self.room)
        self.room *= rate
        self.flat -= self.room
        if self.since == 64:
            self.m *= np.float32(fast)
            self.v *= np.float32(slow)
            self.since = 0


class Model:
    """The attention model's tables: what each input class asks, offers and carries, and how the carried predicts whether an id
    begins a word (gate) and, within that half, a class."""

    def __init__(self, uses: np.ndarray, first: np.ndarray, seed: int = 7):
        """uses: training count of each id; first: whether an id begins a word. The last id ends a text, and counts as a first."""
        n = len(uses) - 1
        order = np.argsort(-uses[:n], kind="stable")
        self.input_of = np.zeros(n + 2, np.int16)
        self.input_of[order] = np.minimum(np.arange(n), INPUTS - 34)  # frequent ids are classes of their own
        rest = order[INPUTS - 34 :]
        self.input_of[rest] = INPUTS - 34 + np.arange(len(rest)) * 16 // max(1, len(rest)) + 16 * first[rest]
        self.input_of[-2:] = INPUTS - 1  # before a text
        self.first = np.r_[first[:n], True]
        self.class_of, at = np.zeros(n + 1, np.int16), 0
        order = np.argsort(-np.r_[uses[:n], np.inf], kind="stable")
        for half, alone, bins in zip((True, False), ALONE, BINS):
            mine = order[self.first[order] == half]
            self.class_of[mine[:alone]] = at + np.arange(len(mine[:alone]))
            mass = np.cumsum(uses[mine[alone:]] + 0.1)
            if len(mass):
                self.class_of[mine[alone:]] = at + alone + np.minimum(bins - 1, (bins * mass / mass[-1]).astype(np.int64))
            at += alone + bins
        share = np.bincount(self.class_of, uses + 0.1, minlength=CLASSES)
        self.inside = np.log10((uses + 0.1) / share[self.class_of]).astype(np.float32)
        halves = np.bincount(self.first.astype(np.int64), uses + 0.1, minlength=2)
        self.plain = np.log10((uses + 0.1) / halves[self.first.astype(np.int64)])
        rng = np.random.default_rng(seed)
        window = CONTEXT + STRIDE
        self.p = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in {"ask": (INPUTS, WIDTH), "offer": (INPUTS, WIDTH), "carry": (INPUTS, WIDTH), "own": (INPUTS, WIDTH), "out": (WIDTH + 1, CLASSES)}.items()}
        self.p["gate"] = np.zeros(WIDTH + 1, np.float32)
        self.p["gate"][-1] = np.log(halves[1] / max(halves[0], 1e-9) + 1e-9)
        self.p["near"] = np.zeros(window, np.float32)
        self.p["out"][-1] = np.log(share / share.sum() + 1e-9)

    def forward(self, x: np.ndarray):
        """What is carried to each of the last STRIDE places of windows x of input classes, a row each, with a one after it."""
        h = Tables(self.p, len(x)).forward(x)
        return (np.hstack([h, np.ones((len(h), 1), np.float32)]),)

    def gradient(self, xb: np.ndarray, yb: np.ndarray) -> dict:
        """Of the mean cross-entropy over the places that have a class: of its half, and of the class within that half."""
        tables = Tables(self.p, len(xb))
        seen, sums = tables.gradient(xb, yb)
        grad = {k: np.zeros_like(self.p[k]) for k in SIDES} | tables.slopes
        for k, side in zip(SIDES, np.split(sums, len(SIDES), 1)):
            grad[k][seen] = side
        return grad

    def learn(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        """x: windows of input classes; y: the class after each of the last STRIDE places, -1 for none. Adam on cross-entropy."""
        rng, tables = np.random.default_rng(seed), Tables(self.p)
        for step in range(1, STEPS + 1 if len(x) else 0):
            at = rng.integers(0, len(x), BATCH)
            tables.step(x[at], y[at], RATE * min(1.0, step / 30) * (1 - 0.9 * step / STEPS))
        self.p = {k: a.copy() for k, a in tables.p.items()}

    def windows(self, ids: np.ndarray, starts: np.ndarray, every: int = 1, rng=None, pick: np.ndarray | None = None, leads: np.ndarray | int = 0):
        """Of texts' ids, one after the other, each text ended: inputs of each window and its targets' places (-1: none).

        starts: where each text begins in ids, and the end. Before a text stands its opening class. every: one in so many
        windows, drawn by rng: of each run of so many, one. pick: the windows to take. leads: so many ids of each text are context only.
        """
        sizes = np.diff(starts) - leads
        first = starts[:-1] + leads
        n = -(-sizes // STRIDE)
        base, total = np.cumsum(n) - n, int(n.sum())
        pick = np.arange(total) if pick is None else pick
        if every > 1:
            pick = np.arange(0, total, every)
            pick = np.minimum(pick + rng.integers(0, every, len(pick)), total - 1)
        text = np.searchsorted(base, pick, "right") - 1
        begin = first[text] + STRIDE * (pick - base[text])
        left, right, before = starts[text], starts[text + 1], self.input_of[-1:]
        target = begin[:, None] + np.arange(STRIDE)
        some = np.flatnonzero(begin + STRIDE > right)
        target[some] = np.where(target[some] < right[some, None], target[some], -1)
        inputs = np.concatenate([before.repeat(CONTEXT + 1), self.input_of[ids], before.repeat(STRIDE)])
        x = np.lib.stride_tricks.sliding_window_view(inputs, CONTEXT + STRIDE)[begin]
        some = np.flatnonzero((begin - CONTEXT - 1 < left) | (begin + STRIDE - 1 > right))  # windows that reach over an end of their text
        source = begin[some, None] + np.arange(-CONTEXT - 1, STRIDE - 1)
        x[some] = np.where((source >= left[some, None]) & (source < right[some, None]), x[some], before)
        return x, target

    def classes(self, ids: np.ndarray, target: np.ndarray) -> np.ndarray:
        return np.append(self.class_of[ids], np.int16(-1))[target]

    def each(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each id, given whether it begins a word; and that it does so or doesn't, as it is."""
        got, gate = np.zeros((2, len(ids)), np.float32)
        classes, first = self.class_of[ids], self.first[ids]
        x, target = self.windows(ids, starts)
        tables = Tables(self.p, SCORED)
        for a in range(0, len(x), SCORED):
            h = tables.forward(x[a : a + SCORED])
            t = target[a : a + SCORED].ravel()
            real = t >= 0
            begins = first.take(t) & real
            real &= ~begins
            for half, at in zip(HALVES, (np.flatnonzero(begins), np.flatnonzero(real))):
                i = t.take(at)
                mine = h.take(at, 0, out=tables.mine[: len(at)], mode="clip")
                gate[i] = mine @ tables.p["gate"][:-1]
                power, factor, total = _class_powers(mine, tables.p["out"][:, half], tables.powers)
                k = classes.take(i) - half.start
                got[i] = power.ravel().take(np.arange(len(i)) * power.shape[1] + k) * factor.take(k) / total
        gate += self.p["gate"][-1]
        own = np.log10((1 - PLAIN) * got * (10.0**self.inside)[ids] + (PLAIN * 10**self.plain)[ids])
        return own, _log_sum(np.zeros(1), np.where(first, -gate, gate).astype(float)) / -np.log(10)


def _log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of two numbers whose logarithms these are; in a fraction of the time of logaddexp."""
    with np.errstate(invalid="ignore"):
        less = np.exp(-np.abs(a - b))
    less += 1
    np.log(less, out=less)
    less += np.maximum(a, b)
    return less


def _sequences(row: dict, texts: np.ndarray, end: int):
    """Ids of some of a chunk's texts, each ended; where each text begins; of each word, its place, and where it begins in ids."""
    places, flat, lens, sizes = row["places"], row["ids"], row["lens"], row["sizes"]
    begin = np.cumsum(lens) - lens
    first = np.cumsum(sizes) - sizes
    word = np.concatenate([places[first[i] : first[i] + sizes[i]] for i in texts]) if len(texts) else places[:0]
    n = lens[word]
    at = np.repeat(begin[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    total = np.r_[0, np.cumsum(n)]
    last = np.cumsum(sizes[texts])
    ends = total[last]
    of = np.repeat(np.arange(len(texts)), sizes[texts])
    return np.insert(flat[at], ends, end), np.r_[0, ends + np.arange(1, len(ends) + 1)], word, total[:-1] + of


def _opened(row: dict) -> dict:
    """A chunk's row with its arrays."""
    kinds = {"places": "<i4", "ids": "<u4", "lens": "<u4", "begins": "<i8", "anchors": "<i4", "segs": "<i4", "counts": "<i8"}
    return {k: _unzip(x, kinds[k]).astype(np.int64) if k in kinds else np.array(x, bool if k == "held" else np.int64) if k in ("held", "sizes") else x for k, x in row.items()}


def _pieces(row: dict, texts: np.ndarray) -> list[np.ndarray]:
    """Some of a chunk's texts in parts of about PIECE_WORDS words, so that memory stays bounded."""
    part = np.cumsum(row["sizes"][texts]) // PIECE_WORDS
    return np.split(texts, np.flatnonzero(np.diff(part)) + 1) if len(texts) else []


def _draws(row: dict, texts: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for each window of these texts, which follows from the text, its doc_id and the window's place in it alone."""
    with np.errstate(over="ignore"):
        seed = np.add.reduceat(_mix(ids.astype(np.uint64) + (np.arange(len(ids)) - np.repeat(starts[:-1], np.diff(starts))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), starts[:-1])
        doc_id = np.array([row["doc_ids"][i] or 0 for i in texts], np.int64).astype(np.uint64)
        n = -(-np.diff(starts) // STRIDE)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return _mix(np.repeat(_mix(seed + doc_id * np.uint64(3)), n) + inside.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _taught(model, end: int, every: int):
    def teach(batches):
        """About one in `every` windows of the training texts, with a number to draw by."""
        for batch in batches:
            for row in map(_opened, batch.to_pylist()):
                for texts in _pieces(row, np.flatnonzero(~row["held"])):
                    ids, starts, _, _ = _sequences(row, texts, end)
                    draws = _draws(row, texts, ids, starts)
                    pick = np.flatnonzero(draws % np.uint64(every) == 0)
                    x, target = model.value.windows(ids, starts, pick=pick)
                    y = model.value.classes(ids, target)
                    rows = np.hstack([x, y]).astype("<i2")
                    yield pa.RecordBatch.from_arrays([pa.array((draws[pick] // np.uint64(every) >> np.uint64(1)).astype(np.int64)), pa.array([r.tobytes() for r in rows], pa.binary())], ["draw", "window"])

    return teach


def _units(end: int, groups: int):
    def cut(batches):
        """All training texts in units of UNIT windows: one of so many groups, a number to order by, the ids and how many of them are context only."""
        for batch in batches:
            for row in map(_opened, batch.to_pylist()):
                for texts in _pieces(row, np.flatnonzero(~row["held"])):
                    ids, starts, _, _ = _sequences(row, texts, end)
                    draws = _draws(row, texts, ids, starts)
                    n = -(-np.diff(starts) // STRIDE)
                    out, base = [], np.cumsum(n) - n
                    for t in range(len(texts)):
                        for k in range(0, n[t], UNIT):
                            begin, lead = starts[t] + k * STRIDE, CONTEXT + 1 if k else 0
                            out.append((int(draws[base[t] + k]), lead, _zip(ids[begin - lead : min(starts[t + 1], begin + UNIT * STRIDE)].astype("<u4"))))
                    draw, lead, units = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array([d % groups for d in draw], pa.int64()), pa.array([d // groups >> 1 for d in draw], pa.int64()), pa.array(lead, pa.int32()), pa.array(units, pa.binary())], ["part", "draw", "lead", "ids"])

    return cut


def _moved(model, salts: int):
    def move(table: pa.Table) -> pa.Table:
        """How far a pass over a group's windows, shuffled, moves the model, times the weights; and the weights."""
        start = model.value
        tables = Tables(start.p)
        table = table.sort_by([("draw", "ascending"), ("lead", "ascending"), ("ids", "ascending")])
        units = [_unzip(u, "<u4") for u in table.column("ids").to_pylist()]
        ids = np.concatenate(units).astype(np.int64)
        x, target = start.windows(ids, np.r_[0, np.cumsum([len(u) for u in units])], leads=table.column("lead").to_numpy().astype(np.int64))
        order = np.random.default_rng(13).permutation(len(x))
        x, y = x[order], start.classes(ids, target)[order]
        steps = -(-len(x) // BATCH)
        for xb, yb in zip(np.array_split(x, steps), np.array_split(y, steps)):
            tables.step(xb, yb, PASS_RATE * min(1.0, (tables.n + 1) / 10))
        seen = np.r_[np.bincount(x.ravel(), minlength=INPUTS), len(x)].astype(float)
        moves = np.concatenate([((tables.p[k] - start.p[k]) * _weight(k, seen)).astype("<f4").ravel() for k in sorted(start.p)])
        group = table.column("part")[0].as_py()
        return pa.table({"salt": pa.array([group % salts]), "task": pa.array([group]), "moves": pa.array([np.r_[seen.astype("<f4"), moves].tobytes()], pa.binary())})

    return move


def _weight(name: str, seen: np.ndarray):
    """Of a table's rows: how often its input class was seen; of the others, how many windows."""
    return seen[:-1, None] if name in ("ask", "offer", "carry", "own") else seen[-1]


def _summed(table: pa.Table) -> pa.Table:
    rows = sorted(table.select(["task", "moves"]).to_pylist(), key=lambda r: r["task"])
    total = sum(np.frombuffer(r["moves"], "<f4").astype("<f8") for r in rows)
    return pa.table({"salt": table.column("salt")[:1], "task": pa.array([rows[0]["task"]]), "moves": pa.array([total.tobytes()], pa.binary())})


def pass_over(model: Model, chunks: DataFrame, end: int, windows: int) -> None:
    """Moves the model by a pass over the training texts of all chunks: groups of units by hash move it each by itself, and their moves are averaged.

    Groups, and the order in them, follow from the texts and doc_ids, so the layout of the table doesn't matter. Their number
    grows with the windows, of which there are about so many.
    """
    spark = chunks.sparkSession
    groups = max(1, windows // GROUP)
    salts = max(1, int(groups**0.5))  # so that no task and not the driver has a row for each group
    shared = spark.sparkContext.broadcast(model)
    some = chunks.select("doc_ids", "held", "sizes", "places", "ids", "lens").mapInArrow(_units(end, groups), "part long, draw long, lead int, ids binary")
    kind = "salt long, task long, moves binary"
    moved = some.groupBy("part").applyInArrow(_moved(shared, salts), kind).groupBy("salt").applyInArrow(_summed, kind).collect()
    if moved:
        total = sum(np.frombuffer(r.moves, "<f8") for r in sorted(moved, key=lambda r: r.task))
        seen, at = total[: INPUTS + 1], INPUTS + 1
        for k in sorted(model.p):
            a = model.p[k]
            a += (total[at : at + a.size].reshape(a.shape) / np.maximum(1, _weight(k, seen))).astype(np.float32)
            at += a.size


def _others(place: np.ndarray, text: np.ndarray, held: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Counts of keys at their occurrences, without those of the occurrence's own text if that is a training text."""
    pair, own = np.unique(text * np.int64(max(1, len(total))) + place, return_inverse=True)
    return total[place] - np.bincount(own, minlength=len(pair))[own] * ~held[text]


def word_scores(own: np.ndarray, kind: np.ndarray, begin: np.ndarray, after: np.ndarray, count: np.ndarray, mass: np.ndarray, types: np.ndarray) -> np.ndarray:
    """log10 probability of words that begin at `begin` in ids and are followed by what begins at `after`.

    count: of the word; mass and types: words with its first id, all and distinct ones.
    """
    total = np.r_[0.0, np.cumsum(own + kind)]
    spelling = total[after] - total[begin + 1] + kind[after]
    known = mass > 0
    share = np.where(known, np.maximum(0, count - DISCOUNT) / np.maximum(1, mass), 0.0)
    left = np.where(known, DISCOUNT * types / np.maximum(1, mass), 1.0)
    return own[begin] + _log_sum(np.log(np.maximum(share, 1e-300)), np.log(np.maximum(left, 1e-300)) + spelling * np.log(10)) / np.log(10)


def remembered(scores: np.ndarray, seg: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """log10 probability of segments of such scores, which with their anchor, and whose anchors, come so often elsewhere."""
    with np.errstate(divide="ignore"):
        memory = np.log(MEMORY * seg / np.maximum(1, anchor))
    return np.where(anchor > 0, np.logaddexp(memory, np.log(1 - MEMORY) + scores * np.log(10)) / np.log(10), scores)


def _scored(model, v: int, n: int, n_train: int, end: int):
    def score(asked: pa.Table, chunk: pa.Table) -> pa.Table:
        m, mass, types = model.value
        row = _opened(chunk.to_pylist()[0])
        totals = row["counts"].copy() if "counts" in row else np.zeros(len(asked), np.int64)  # keys that no other chunk counts need no answer
        totals[asked.column("place").to_numpy()] = asked.column("total").to_numpy()
        totals_of = np.split(totals, np.cumsum([len(row["lens"]), row["anchors"].max(initial=-1) + 1]))  # words, anchors, segments
        words, held, sizes, places = totals_of[0], row["held"], row["sizes"], row["places"]
        k, starts = len(sizes), np.r_[0, np.cumsum(sizes)]
        text = np.repeat(np.arange(k), sizes)
        each, known = np.r_[0.0, np.cumsum(np.log10(words + 1.0)[places])], np.r_[0, np.cumsum((words > 0)[places])]
        base = each[starts[1:]] - each[starts[:-1]] + np.log10(n_train + 1.0) - (sizes + 1) * np.log10(float(n + v + 1))

        tokens = np.empty(len(places) + k)  # scores of words and ends, text by text
        count = _others(places, text, held, words)
        for texts in _pieces(row, np.arange(k)):
            ids, begins, word, at = _sequences(row, texts, end)
            own, kind = m.each(ids, begins)
            last = begins[1:] - 1
            which = np.insert(np.arange(len(word)), np.cumsum(sizes[texts]), -1)  # a text's words, and its end as -1
            where = np.insert(at, np.cumsum(sizes[texts]), last)
            follow = np.r_[where[1:], len(ids)][which >= 0]
            a, b = starts[texts[0]], starts[texts[-1] + 1]
            f = ids[at]
            out = np.empty(len(which))
            out[which >= 0] = word_scores(own, kind, at, follow, count[a:b], mass[f], types[f])
            out[which < 0] = own[last]
            tokens[a + texts[0] : b + texts[-1] + 1] = out
        begin = row["begins"]
        of = np.searchsorted(starts + np.arange(k + 1), begin, "right") - 1
        seg, anchor = _others(row["segs"], of, held, totals_of[2]), _others(row["anchors"], of, held, totals_of[1])
        scores = np.bincount(of, remembered(np.add.reduceat(tokens, begin), seg, anchor), minlength=k)
        columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(held), pa.array(sizes + 1), pa.array(known[starts[1:]] - known[starts[:-1]] + int(n_train > 0)), pa.array(np.full(k, n)), pa.array(base), pa.array(scores)]
        return pa.Table.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def text_scores(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs(doc_id, text).

    Null text counts as empty: its one token is the end. Held-out rows teach nothing. Repeated rows are texts of their own.
    With no training row, counts are zero and the attention model is untrained. An empty table gives no rows. A null
    doc_id counts as the empty text for held_out. The model's text is the words, lower-cased, with a blank before each, and
    the end.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        ranks = f.read()
    end = len(_blank(ranks))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (crc_mod(F.col("doc_id"), FOLDS) == HELD).alias("held_out"))
    chunks = rows.mapInArrow(_chunks(spark.sparkContext.broadcast(ranks), end), _KIND).withColumn("chunk", F.monotonically_increasing_id())
    chunks = staged(chunks, "lm-chunks")  # written once, so a chunk's number stays its own
    facts = chunks.select(F.explode(F.arrays_zip("held", "sizes")).alias("d")).agg(F.sum(F.when(~F.col("d.held"), F.col("d.sizes") + 1)).alias("n"), F.sum((~F.col("d.held")).cast("long")).alias("texts")).first()
    n, n_train, n_keys = int(facts.n or 0), int(facts.texts or 0), int(chunks.agg(F.sum("n_keys")).first()[0] or 0)

    asked = chunks.select("chunk", "keys", "kinds", "counts").mapInArrow(_dealt(max(8, n_keys // PART)), "part long, chunk long, keys binary, places binary, kinds binary, counts binary")
    answers = staged(asked.groupBy("part").applyInArrow(_counted, _COUNTED), "lm-answers")
    words = answers.where("chunk is null").select(F.explode(F.arrays_zip("kinds", "types", "masses")).alias("w"))
    found = words.groupBy(F.col("w.kinds").alias("kind")).agg(F.sum("w.types").alias("types"), F.sum("w.masses").alias("mass")).collect()  # one row for each id of the tokenizer, at most
    mass, types = np.zeros(end + 1, np.int64), np.zeros(end + 1, np.int64)
    for r in found:
        mass[r.kind], types[r.kind] = r.mass, r.types
    v = int(types.sum()) + int(n_train > 0)

    uses = np.zeros(end + 1)
    for r in chunks.select(F.explode(F.arrays_zip("used", "uses")).alias("u")).groupBy("u.used").agg(F.sum("u.uses").alias("k")).collect():  # one row for each id of the tokenizer, at most
        uses[r.used] = r.k
    windows = int(uses.sum() + n_train) // STRIDE + 1
    uses[end] = n_train
    model = Model(uses, np.r_[_blank(ranks), True])
    texts = chunks.select("doc_ids", "held", "sizes", "places", "ids", "lens")
    drawn = texts.mapInArrow(_taught(spark.sparkContext.broadcast(model), end, max(1, windows // SAMPLE)), "draw long, window binary")
    drawn = [r.window for r in drawn.orderBy("draw", "window").limit(SAMPLE).collect()]
    if drawn:
        xy = np.frombuffer(b"".join(drawn), "<i2").reshape(len(drawn), -1).astype(np.int64)
        model.learn(xy[:, : CONTEXT + STRIDE], xy[:, CONTEXT + STRIDE :])
    pass_over(model, chunks, end, windows)

    shared = spark.sparkContext.broadcast((model, mass, types))
    rows = chunks.drop("keys", "kinds", "n_keys", "used", "uses").groupBy("chunk")
    return answers.where("chunk is not null").select("chunk", "places", "totals").groupBy("chunk").cogroup(rows).applyInArrow(_answered(_scored(shared, v, n, n_train, end)), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
