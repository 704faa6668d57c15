"""Token files: whole-text tokenizing, exact round trips, single blocks, damage."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_DIR
from tickerloom.llm import tokenfile as T
from tickerloom.llm.common import new_folder, table

ODD = [
    None, "", " \n\t ", "a", "it's ISN'T we'll. x's. 12,345... ((a)) é. É! é. H̱ ẖ. İstanbul ΟΔΟΣ", "<|endoftext|>. <|STARTOFTEXT|> a<|startoftext|>b <|", " a. ",
    " nbsp em　", "東京タワー。日本語", "🎉🎉!! 👩‍👩‍👧 ok?", "x" * 5000, "word. " * 9000, "***===###", "\x00\x01 a\x0bb\x0cc\x85d e", "a.b.c...;:)", "1. 2) 3*", "ß. ẞ Ǆ ﬁ. ①. ²= Ⅷ.",
]


def whole(texts: list) -> list[list[int]]:
    tokenizer = T._tokenizer(T._vocabulary())
    return [tokenizer.encode(x or "", add_special_tokens=False).ids + [T.END] for x in texts]


def split(texts: list) -> list[list[int]]:
    ids, sizes = T.Tokens(T._vocabulary()).ids(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_words_give_the_ids_of_whole_texts():
    assert split(ODD) == whole(ODD)
    assert split(ODD[:3]) == [[2], [2], [2]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=6))
def test_any_text_gives_the_ids_of_whole_texts(texts):
    assert split(texts) == whole(texts)


def test_latin_words_of_several_lots_go_to_the_model_in_one_pass_each():
    """ASCII and accented words, more than a lot of each; accents are lower-cased and lettered many words at a time."""
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    accented = [f"{a}x{b}e" for a in letters for b in letters]
    plain = [f"{a}{b}{c}ing" for a in "abcdeghijkrst" for b in "aeiou" for c in "bcdfghjklmnpqrstvwxyz"]
    tokens = T.Tokens(T._vocabulary())
    assert min(len(accented), len(plain)) > tokens.LOT
    for way, words in ((tokens._accented, accented), (tokens._ascii, plain)):
        flats, sizes = way(words)
        assert len(flats) == len(sizes) > 1
        got = np.split(np.concatenate(flats), np.cumsum(np.concatenate(sizes))[:-1])
        assert [x.tolist() for x in got] == [x[:-1] for x in whole(words)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 65535), max_size=200), st.integers(1, 70), st.integers(1, 40))
def test_any_ids_come_back(ids, block, times):
    ids = np.array(ids * times, np.uint16)
    assert (T.decoded(T.encoded(ids, block), block) == ids).all()


def test_blocks_are_read_alone_and_are_small_where_ids_are_predictable():
    rng = np.random.default_rng(1)
    step = {i: int(rng.integers(500)) for i in range(500)}
    ids = [3]
    while len(ids) < 30_000:
        ids.append(step[ids[-1]] if rng.random() < 0.9 else int(rng.integers(500)))
    ids = np.array(ids, np.uint16)
    data = T.encoded(ids, 1000)
    assert (T.decoded(data, 1000, only=17) == ids[17_000:18_000]).all() and (T.decoded(data, 1000, only=29) == ids[29_000:]).all()
    assert len(data) < 0.45 * 2 * len(ids) and len(T.encoded(np.zeros(100_000, np.uint16))) < 1500
    assert (T.decoded(T.encoded(np.arange(65536).astype(np.uint16))) == np.arange(65536)).all()


def test_damage_is_found():
    data = bytearray(T.encoded(np.arange(5000) % 300, 512))
    for at in (len(data) - 3, len(data) - 900):
        data[at] ^= 4
        with pytest.raises(ValueError, match="damaged"):
            T.decoded(bytes(data), 512)
        data[at] ^= 4
    assert (T.decoded(bytes(data), 512) == np.arange(5000) % 300).all()


def brute(rows: list[tuple], same: bool = True) -> list[tuple]:
    out, start = [], 0
    for (d, _), ids in zip(rows, whole([x for _, x in rows])):
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block,segment", [(2048, 4096), (64, 3), (7, 1)])
def test_round_trip_against_whole_texts(spark, block, segment):
    """Nulls, long texts over many blocks and segments, equal rows, clashing names."""
    rows = [(i, x) for i, x in enumerate(ODD)] + [(100, "same text"), (100, "same text"), (10**15, "last")]
    docs = spark.createDataFrame([(d, x, "a", 1) for d, x in rows], "doc_id long, text string, hash string, part long").repartition(4)
    assert sorted(map(tuple, T.round_trip(docs, block=block, segment=segment).collect())) == sorted(brute(rows))


def test_ties_nulls_and_empty_tables(spark):
    rows = [(None, "b"), (None, "c d"), (3, "x y"), (3, "z"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, T.round_trip(docs).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 3, 3, 3] and [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in brute(rows))
    assert T.round_trip(docs.limit(0)).count() == 0


def test_given_documents_and_other_layouts(spark):
    docs = table(spark, SF_DIR, "documents")
    want = brute(sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()))
    assert sorted(map(tuple, T.round_trip(docs).collect())) == want
    assert sorted(map(tuple, T.round_trip(docs.repartition(7)).collect())) == want
    folder = new_folder(spark, "tokens")
    files = T.write_files(docs, folder)
    assert files.agg({"n_ids": "sum"}).first()[0] == want[-1][1] + want[-1][2]
