"""Token ids in files of range-coded blocks.

Ids are cut into blocks of BLOCK; a block is coded from nothing but its segment's counts of ids, so any one can be read alone,
and has a checksum. Within a block, order 2 (the two ids before) and order 1 (the id before) each remember an id that followed
and how well it did; order 0 are the segment's counts. An id is one decision, whether it is the remembered one, with a
probability mixed from the three orders by weights that learn, and after a miss a draw from order 0. Both drive a range coder
with 48 bits of range and digits of 16 bits. All arithmetic is in integers, so files read the same anywhere.

All blocks of a segment are coded in step, one id of each at a time, as numpy arrays over the blocks.

File: segments, then the footer (documents' ids and lengths, segments' offsets; deflated), its length and MAGIC. Segment: four
numbers (ids, blocks, distinct ids, bytes of the blocks), the distinct ids and their shares, each block's length in digits and
CRC-32, the digits.
"""

from __future__ import annotations

import codecs
import os
import struct
import uuid
import zlib
from functools import lru_cache
from itertools import chain, filterfalse
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import new_folder, sliced, staged

BLOCK = 2048  # ids of a block
SEGMENT = 4096  # blocks of a segment at most
END = 2
MAGIC = b"TKRC0001"
SLICE = 12 << 20  # bytes of text tokenized at once, about
MEMO = 1 << 20  # words whose ids a task keeps at most; beyond that it forgets them all

_ZERO, _HALF, _WHOLE = np.uint64(0), np.uint64(32), np.uint64((1 << 48) - 1)
_LOW = np.uint64((1 << 32) - 1)
_SIX = np.uint64(16)
_TABLE = 2048  # slots of each order's memory in a block
_STRETCH = np.round(np.clip(np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096))) * 256, -2047, 2047)).astype(np.int32)
_SQUASH = np.clip(np.round(65536 / (1 + np.exp(-(np.arange(4096) - 2048) / 256))), 32, 65504).astype(np.int32)


def _crc_of_tables() -> int:
    return zlib.crc32(_STRETCH.astype("<i4").tobytes() + _SQUASH.astype("<i4").tobytes())


class Encoder:
    """Range coders of several blocks in step. Digits go to flat, a stretch of `most` for each block; at: the next digit's place."""

    def __init__(self, blocks: int, most: int):
        self.low, self.range = np.zeros(blocks, np.uint64), np.full(blocks, (1 << 48) - 1, np.uint64)
        self.most = 2 * most + 4
        self.flat, self.at = np.zeros(blocks * self.most, np.uint16), np.arange(blocks) * self.most

    def _carry(self, low: np.ndarray, over: np.ndarray, blocks: np.ndarray) -> None:
        """Takes the bit too many from low[over] and adds it to the blocks' digits before, and on while those overflow."""
        low[over] &= _WHOLE
        place = self.at.take(blocks) - 1
        while len(place):
            self.flat[place] += 1
            place = place[self.flat.take(place) == 0] - 1

    def _shift(self, low: np.ndarray, size: np.ndarray, small: np.ndarray, blocks: np.ndarray) -> None:
        """Moves a digit of low[small] out."""
        x, at = low.take(small), self.at.take(blocks)
        self.flat[at] = x >> _HALF
        self.at[blocks] = at + 1
        low[small] = (x & _LOW) << _SIX
        size[small] = size.take(small) << _SIX

    def bit(self, k: int, p: np.ndarray, hit: np.ndarray | None) -> np.ndarray:
        """Codes hit for the first k blocks; p: its probability of 65536."""
        low, size = self.low[:k], self.range[:k]
        bound = (size >> _SIX) * p
        low += np.where(hit, _ZERO, bound)
        size[:] = np.where(hit, bound, size - bound)
        if len(over := np.flatnonzero(low > _WHOLE)):
            self._carry(low, over, over)
        if len(small := np.flatnonzero(size <= _LOW)):
            self._shift(low, size, small, small)
        return hit

    def draw(self, which: np.ndarray, order0: Order0, ids: np.ndarray | None) -> np.ndarray:
        """Codes ids of the blocks `which` by order 0."""
        step = self.range.take(which) >> _SIX
        low = self.low.take(which) + step * order0.base.take(ids)
        size = step * order0.share.take(ids)
        if len(over := np.flatnonzero(low > _WHOLE)):
            self._carry(low, over, which.take(over))
        if len(small := np.flatnonzero(size <= _LOW)):
            self._shift(low, size, small, which.take(small))
        self.low[which], self.range[which] = low, size
        return ids

    def ended(self) -> list[np.ndarray]:
        """The digits of each block; those left out at the end are zeros."""
        self.low += _LOW
        if len(over := np.flatnonzero(self.low > _WHOLE)):
            self._carry(self.low, over, over)
        self.flat[self.at] = self.low >> _HALF
        return [np.trim_zeros(self.flat[i * self.most : end + 1], "b") for i, end in enumerate(self.at.tolist())]


class Decoder:
    """The same from the digits; hit and ids are what it gives."""

    def __init__(self, digits: list[np.ndarray], most: int):
        n, width = len(digits), 4 + max(map(len, digits))
        full = np.zeros((n, width), np.uint16)
        for i, d in enumerate(digits):
            full[i, : len(d)] = d
        first = full[:, :3].astype(np.uint64)
        self.code, self.range = (first[:, 0] << _HALF) | (first[:, 1] << _SIX) | first[:, 2], np.full(n, (1 << 48) - 1, np.uint64)
        self.flat, self.at, self.last = full.ravel(), np.arange(n) * width + 3, np.arange(n) * width + width - 1

    def _shift(self, code: np.ndarray, size: np.ndarray, small: np.ndarray, blocks: np.ndarray) -> None:
        at = self.at.take(blocks)
        code[small] = (code.take(small) << _SIX) | self.flat.take(np.minimum(at, self.last.take(blocks)))
        self.at[blocks] = at + 1
        size[small] = size.take(small) << _SIX

    def bit(self, k: int, p: np.ndarray, hit: np.ndarray | None) -> np.ndarray:
        code, size = self.code[:k], self.range[:k]
        bound = (size >> _SIX) * p
        hit = code < bound
        code -= np.where(hit, _ZERO, bound)
        size[:] = np.where(hit, bound, size - bound)
        if len(small := np.flatnonzero(size <= _LOW)):
            self._shift(code, size, small, small)
        return hit

    def draw(self, which: np.ndarray, order0: Order0, ids: np.ndarray | None) -> np.ndarray:
        step, code = self.range.take(which) >> _SIX, self.code.take(which)
        ids = order0.at.take((code // step).astype(np.int64), mode="clip")
        code -= step * order0.base.take(ids)
        size = step * order0.share.take(ids)
        if len(small := np.flatnonzero(size <= _LOW)):
            self._shift(code, size, small, which.take(small))
        self.code[which], self.range[which] = code, size
        return ids


class Order0:
    """Shares of 65536 of the distinct ids of a segment, each 1 at least."""

    def __init__(self, ids: np.ndarray, shares: np.ndarray):
        self.ids, self.shares = ids.astype(np.int64), shares.astype(np.int64)
        self.share, self.base = np.ones(65536, np.uint64), np.zeros(65536, np.uint64)
        self.share[self.ids] = self.shares
        self.base[self.ids] = np.cumsum(self.shares) - self.shares
        self.at = np.repeat(self.ids, self.shares).astype(np.int32)
        known = np.zeros(65536, np.int64)
        known[self.ids] = self.shares
        self.stretch = _STRETCH[np.minimum(known >> 4, 4095)]

    @classmethod
    def counted(cls, ids: np.ndarray) -> Order0:
        counts = np.bincount(ids, minlength=65536)
        known = np.flatnonzero(counts)
        n = counts[known]
        shares = 1 + n * (65536 - len(known)) // n.sum()
        shares[np.argmax(n)] += 65536 - shares.sum()
        return cls(known, shares)


def _coded(coder, lengths: np.ndarray, order0: Order0, ids: np.ndarray | None) -> np.ndarray:
    """Runs the coder over blocks of these lengths, none longer than those before it. ids (blocks, longest): to encode, or None."""
    n, most = len(lengths), int(lengths[0])
    out = np.zeros((most, n), np.int32) if ids is None else np.ascontiguousarray(ids.T.astype(np.int32))
    lane = np.arange(n)
    memory = np.zeros(2 * n * _TABLE, np.int32)  # of order 2, then of order 1: an id and, above 16 bits, how well it did
    odds = np.full(n * 48, 1 << 15, np.int32)  # by how well it did: of order 2, of order 1 beside another guess, of order 1 as the guess
    odds.reshape(n, 3, 16)[:, :, 0] = 1 << 10
    weights = np.repeat(np.array([[30_000], [20_000], [6_000]], np.int32), n, 1)
    before, last = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    tables, sixteens = np.stack([lane * _TABLE, (n + lane) * _TABLE]), np.stack([lane * 48, lane * 48 + 16])
    running = np.searchsorted(-lengths, -np.arange(most), side="left")  # blocks longer than t
    hashed, stretch = np.empty((2, n), np.uint32), np.empty((3, n), np.int32)
    low, five = np.uint32(_TABLE - 1), np.uint32(5)
    for t in range(most):
        k = int(running[t])
        if k < len(last):
            before, last = before[:k], last[:k]
            tables, sixteens, weights, hashed, stretch = (np.ascontiguousarray(x[:, :k]) for x in (tables, sixteens, weights, hashed, stretch))
        np.multiply(last, np.uint32(40503), out=hashed[1])
        np.add(hashed[1], before * np.uint32(2654435769), out=hashed[0])
        hashed >>= five
        hashed &= low
        slots = tables + hashed
        held = memory.take(slots, mode="clip")
        well, known = held >> 16, held & 0xFFFF
        guess = np.where(well[0] > 0, known[0], known[1])
        places = sixteens + well
        places[1] += (known[1] == guess) << 4
        odd = odds.take(places, mode="clip")
        _STRETCH.take(odd >> 4, out=stretch[:2], mode="clip")
        order0.stretch.take(guess, out=stretch[2], mode="clip")
        mixed = np.einsum("ij,ij->j", weights, stretch) >> 16
        p = _SQUASH.take(mixed + 2048, mode="clip")
        x = None if ids is None else out[t, :k]
        hit = coder.bit(k, p.astype(np.uint64), None if x is None else x == guess)
        miss = np.flatnonzero(~hit)
        if x is None:
            x = guess
            if len(miss):
                x = guess.copy()
                x[miss] = coder.draw(miss, order0, None)
            out[t, :k] = x
        elif len(miss):
            coder.draw(miss, order0, x.take(miss))
        goal = hit * np.int32(65535)
        error = (goal - p) >> 5
        stretch *= error
        stretch >>= 10
        weights += stretch
        np.minimum(np.maximum(weights, -200_000, out=weights), 200_000, out=weights)
        odds[places] = odd + ((goal - odd) >> 4)
        better = (held < 0xF0000) * np.int32(65536)
        better += held
        memory[slots] = np.where(known == x, better, np.where(held < 0x20000, x | 65536, held - 65536))
        before, last = last, x.astype(np.uint32)
    return out


def encoded(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment."""
    if len(ids) and (ids.min() < 0 or ids.max() > 65535):
        raise ValueError("ids must have 16 bits")
    n = len(ids)
    if not n:
        return struct.pack("<4Q", 0, 0, 0, 0)
    blocks = -(-n // block)
    lengths = np.full(blocks, block)
    lengths[-1] = n - (blocks - 1) * block
    full = np.zeros((blocks, min(block, n)), np.uint16)
    full.ravel()[:n] = ids
    order0 = Order0.counted(ids)
    coder = Encoder(blocks, int(lengths[0]))
    _coded(coder, lengths, order0, full)
    digits = coder.ended()
    payload = [d.astype("<u2").tobytes() for d in digits]
    sums = [zlib.crc32(p, zlib.crc32(full[i, : lengths[i]].astype("<u2").tobytes())) for i, p in enumerate(payload)]
    head = struct.pack("<4Q", n, blocks, len(order0.ids), sum(map(len, payload)))
    return b"".join([head, order0.ids.astype("<u2").tobytes(), (order0.shares - 1).astype("<u2").tobytes(), np.array([len(d) for d in digits], "<u4").tobytes(), np.array(sums, "<u4").tobytes(), *payload])


def decoded(data: bytes, block: int = BLOCK, only: int | None = None) -> np.ndarray:
    """The ids of a segment, or of one of its blocks. A block that fails its checksum is an error."""
    n, blocks, known, _ = struct.unpack_from("<4Q", data)
    if not n:
        return np.zeros(0, np.uint16)
    at = 32
    parts = []
    for kind, count in (("<u2", known), ("<u2", known), ("<u4", blocks), ("<u4", blocks)):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    ends = at + 2 * np.cumsum(parts[2].astype(np.int64))
    order0 = Order0(parts[0], parts[1].astype(np.int64) + 1)
    lengths = np.full(blocks, block)
    lengths[-1] = n - (blocks - 1) * block
    which = range(blocks) if only is None else [only]
    digits = [np.frombuffer(data, "<u2", parts[2][i], ends[i] - 2 * parts[2][i]) for i in which]
    mine = lengths[list(which)]
    rows = _coded(Decoder(digits, int(mine[0])), mine, order0, None).T.astype("<u2")
    out = []
    for j, i in enumerate(which):
        ids = rows[j, : lengths[i]]
        if zlib.crc32(digits[j].tobytes(), zlib.crc32(ids.tobytes())) != parts[3][i]:
            raise ValueError(f"block {i} is damaged")
        out.append(ids)
    return np.concatenate(out)


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _gathered(begin: np.ndarray, size: np.ndarray, flat: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of units one after the other, and each unit's number of ids."""
    sizes = size.take(units, mode="clip")
    ends = np.cumsum(sizes)
    at = np.repeat(begin.take(units, mode="clip") - ends + sizes, sizes)
    at += np.arange(len(at))
    return flat.take(at, mode="clip"), sizes


#: Bytes of letters beyond ASCII as the letters that the vocabulary has for them: a byte that doesn't print has one from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_LETTERS = "".join(chr(256 + _HIDDEN.index(b)) if b in _HIDDEN and b != 10 else chr(b) for b in range(256))  # but for the line feed, which stands between words
_ID = attrgetter("id")


def _strings(column) -> list[str]:
    """Arrow strings without nulls as a list; to_pylist makes a scalar of each first, which takes several times as long."""
    return column.to_numpy(zero_copy_only=False).tolist()


class Tokens:
    """Ids of texts by their distinct words: the tokenizer drops white space and never looks across it.

    A word that ends in a letter or digit and closing marks is cut before the marks, where the tokenizer cuts it, too; ASCII
    words are lower-cased, as it does. Words of Latin letters, which its normalizer only lower-cases and its pattern doesn't
    cut, go straight to its model; others to the whole tokenizer many at a time with MARK, which stands alone between spaces,
    between them; those with MARK or a special token's beginning in them by themselves.
    """

    MARK, CLOSING, LATIN, LOT = "\ue000", ".,;:!?*$#=)", "^[A-Za-zÀ-ÖØ-öø-ÿ]+$", 1024

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.mark = np.array(self._encoded([self.MARK])[0])
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.begin, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint16) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ascii(self, words: list[str]) -> tuple[list, list]:
        model, flats, sizes = self.tokenizer.model.tokenize, [], []
        for i in range(0, len(words), self.LOT):  # in lots, so that few tokens live at once
            each = list(map(model, words[i : i + self.LOT]))
            sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
            flats.append(np.fromiter(map(_ID, chain.from_iterable(each)), np.uint16, int(sizes[-1].sum())))
        return flats, sizes

    def _accented(self, words: list[str]) -> tuple[list, list]:
        return self._ascii(codecs.charmap_decode("\n".join(words).lower().encode(), "strict", _LETTERS)[0].split("\n"))

    def _marked(self, words: list[str]) -> tuple[list, list]:
        flats, sizes = [], []
        between = f" {self.MARK} "
        for ids in self._encoded([between.join(words[i : i + self.LOT]) for i in range(0, len(words), self.LOT)]):
            n = max(0, len(ids) - len(self.mark) + 1)
            at = np.flatnonzero(np.logical_and.reduce([ids[k : k + n] == m for k, m in enumerate(self.mark)]))
            keep = np.ones(len(ids), bool)
            keep[(at[:, None] + np.arange(len(self.mark))).ravel()] = False
            flats.append(ids[keep])
            sizes.append(np.diff(np.r_[0, at - np.arange(len(at)) * len(self.mark), keep.sum()]))
        return flats, sizes

    def _alone(self, words: list[str]) -> tuple[list, list]:
        flats = self._encoded(words)
        return flats, [np.array([len(f)]) for f in flats]

    def _learn(self, new: list[str]) -> None:
        words = pa.array(new, pa.large_string())
        latin, ascii = pc.match_substring_regex(words, self.LATIN), pc.string_is_ascii(words)
        rest = _strings(words.filter(pc.invert(latin)))
        ways = {self._ascii: _strings(words.filter(pc.and_(latin, ascii))), self._accented: _strings(words.filter(pc.and_not(latin, ascii))), self._marked: [w for w in rest if not (self.MARK in w or "<|" in w)], self._alone: [w for w in rest if self.MARK in w or "<|" in w]}
        for way, words in ways.items():
            if words:
                flats, sizes = way(words)
                size = np.concatenate(sizes)
                if len(size) != len(words):
                    raise ValueError("the tokenizer doesn't cut these words where this class expects it")
                self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
                self.begin, self.size, self.flat = np.r_[self.begin, len(self.flat) + np.cumsum(size) - size], np.r_[self.size, size], np.concatenate([self.flat, *flats])

    def ids(self, texts, end: int = END) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of an Arrow column, each text's followed by `end`; and how many each has."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        of = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        word = coded.dictionary
        core = pc.utf8_rtrim(word, self.CLOSING)
        cut = pc.and_not(pc.match_substring_regex(core, r"[\pL\pN]$"), pc.match_substring(word, "<|"))
        word = pc.if_else(pc.and_not(pc.string_is_ascii(word), pc.match_substring(word, "<|")), pc.ascii_lower(word), word)
        core = pc.if_else(pc.string_is_ascii(word), pc.ascii_lower(core), core)
        parts = pa.chunked_array([pc.if_else(cut, core, word), _tails(word, core, cut)]).combine_chunks().dictionary_encode()
        units = _strings(parts.dictionary)
        new = list(filterfalse(self.place.__contains__, units))
        if len(self.place) + len(new) > MEMO:
            self._forget()
            new = units
        self._learn(new)
        at = np.fromiter(map(self.place.__getitem__, units), np.int64, len(units)).take(parts.indices.to_numpy(), mode="clip")
        n = len(word)
        flat, sizes = _gathered(self.begin, self.size, self.flat, at.reshape(2, n).T.ravel())
        flat, size = np.r_[flat, np.uint16(end)], np.r_[sizes.reshape(n, 2).sum(1), 1]
        code = np.insert(coded.indices.to_numpy().astype(np.int64), of[1:] - of[0], n)  # the end after each text's words
        ids, sizes = _gathered(np.cumsum(size) - size, size, flat, code)
        after = np.r_[0, np.cumsum(sizes)][of[1:] - of[0] + np.arange(1, len(of))]
        return ids, np.diff(after, prepend=0)


def _tails(word, core, cut) -> pa.Array:
    """What was cut from each word: its bytes after the core."""
    skip = np.where(cut.to_numpy(zero_copy_only=False), pc.binary_length(core).to_numpy(), pc.binary_length(word).to_numpy())
    begin, end = (np.frombuffer(word.buffers()[1], np.int64)[word.offset + i : word.offset + i + len(word)] for i in (0, 1))
    begin = begin + skip
    raw = np.frombuffer(word.buffers()[2], np.uint8) if word.buffers()[2] else np.zeros(0, np.uint8)
    size = end - begin
    at = np.cumsum(size) - size
    data = raw[np.repeat(begin - at, size) + np.arange(size.sum())]
    return pa.Array.from_buffers(pa.large_string(), len(word), [None, pa.py_buffer(np.r_[0, np.cumsum(size)].astype(np.int64)), pa.py_buffer(data)])


def _written(folder: str, path: str, block: int, segment: int):
    def write(batches):
        """One file of the task's documents, in their order; a row for it. An attempt that is lost leaves a file that no row names."""
        tokens, fs, base = Tokens(path), *pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids"
        docs: list[tuple] = []
        held, waiting, total, at, segments = [], 0, 0, 0, []
        out = None
        for batch in batches:
            for part in sliced([batch], most=SLICE):
                if out is None:
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                ids, sizes = tokens.ids(part.column("text"))
                docs.append((part.column("doc_id"), sizes))
                held.append(ids)
                waiting, total = waiting + len(ids), total + len(ids)
                while waiting >= block * segment:
                    ids = np.concatenate(held)
                    segments.append(at)
                    at += out.write(encoded(ids[: block * segment], block))
                    held, waiting = [ids[block * segment :]], waiting - block * segment
        if out is None:
            return
        segments.append(at)
        at += out.write(encoded(np.concatenate(held), block))
        doc_id = pa.concat_arrays([d for d, _ in docs])
        known = doc_id.is_valid().to_numpy(zero_copy_only=False)
        parts = [doc_id.fill_null(0).to_numpy().astype("<i8"), known.astype("u1"), np.concatenate([s for _, s in docs]).astype("<u8"), np.array(segments, "<u8")]
        footer = zlib.compress(struct.pack("<3Q", len(doc_id), len(segments), block) + b"".join(p.tobytes() for p in parts))
        out.write(footer + struct.pack("<2Q", len(footer), _crc_of_tables()) + MAGIC)
        out.close()
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "name": [name], "n_ids": [total], "n_docs": [len(doc_id)]})

    return write


def write_files(docs: DataFrame, folder: str, path: str | None = None, block: int = BLOCK, segment: int = SEGMENT) -> DataFrame:
    """Writes the ids of docs(doc_id, text) to files in folder, documents in ascending doc_id order over all files; part, name, n_ids, n_docs of each.

    Null doc_ids come first and null text is empty; rows that repeat a doc_id stand in the order in which they are read, which
    cuts a doc_id of very many rows over several files. Staged, as a second run would write second files.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).withColumn("place", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "text")
    return staged(ordered.mapInArrow(_written(folder, path or _vocabulary(), block, segment), "part long, name string, n_ids long, n_docs long"), "token-files")


def read_file(fs, path: str):
    """Segment by segment: doc_id, n_tokens and CRC-32 of the documents that end in it. Only a segment's ids are held at once."""
    with fs.open_input_file(path) as f:
        size = f.size()
        f.seek(size - 24)
        tail = f.read(24)
        length, tables = struct.unpack_from("<2Q", tail)
        if tail[16:] != MAGIC or tables != _crc_of_tables():
            raise ValueError(f"{path} isn't a file of this format")
        f.seek(size - 24 - length)
        footer = zlib.decompress(f.read(length))
        n, k, block = struct.unpack_from("<3Q", footer)
        doc_id, known, sizes, starts = (np.frombuffer(footer, kind, count, at) for kind, count, at in (("<i8", n, 24), ("u1", n, 24 + 8 * n), ("<u8", n, 24 + 9 * n), ("<u8", k, 24 + 17 * n)))
        ends = np.cumsum(sizes.astype(np.int64))
        bounds = [*starts.tolist(), size - 24 - length]
        done, first, crc = 0, 0, 0
        for a, b in zip(bounds, bounds[1:]):
            f.seek(a)
            ids = decoded(f.read(b - a), block).astype("<u4")
            last = int(np.searchsorted(ends, done + len(ids), side="right"))
            sums, at = np.zeros(last - first, np.int64), 0
            for i in range(first, last):
                end = int(ends[i]) - done
                sums[i - first], at, crc = zlib.crc32(ids[at:end], crc), end, 0
            crc = zlib.crc32(ids[at:], crc)
            yield pa.array(doc_id[first:last].astype(np.int64), mask=known[first:last] == 0), ends[first:last] - sizes[first:last].astype(np.int64), sizes[first:last].astype(np.int64), sums
            done, first = done + len(ids), last


def read_files(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files."""
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row for each file
    based = staged(files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "token-index")

    def read(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist()):
                for doc_id, starts, sizes, sums in read_file(fs, f"{base}/{name}"):
                    yield pa.RecordBatch.from_arrays([doc_id, pa.array(starts + start), pa.array(sizes), pa.array(sums)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, based.count())
    return based.select("name", "base").repartitionByRange(n, "name").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str | None = None, block: int = BLOCK, segment: int = SEGMENT) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, written and read back.

    Null and empty texts have the end id only. A null doc_id comes first; repeated rows are documents each. An empty table
    gives no rows. Other columns are ignored, whatever their names.
    """
    folder = new_folder(docs.sparkSession, "tokens")
    return read_files(write_files(docs, folder, path, block, segment), folder)
