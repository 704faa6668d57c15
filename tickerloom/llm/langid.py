"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Characters are lower-cased, what is no letter counts as a blank. Bigrams and trigrams hash to DIM features; a feature's
weight in a text is its share of the text's n-grams times its inverse document frequency over all training documents.
Follow-the-regularised-leader with L1 and L2 penalties learns the weights from a bounded sample of training documents that
has some of every language: languages are counted over all training documents, and a rare one's rate is raised to LEAST,
and a temperature fitted on a part of it that was left out calibrates the probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import crc_mod, sliced, utf8

DIM = 1 << 15
ORDERS = (2, 3)
FOLDS, HELD = 5, 0  # held out: crc32(doc_id) mod FOLDS = HELD
SAMPLE = 4000  # training documents that the regression learns from, about
LEAST = 200  # of each language's training documents that it learns from, about, or all if it has fewer
EPOCHS, ALPHA, BETA, L1, L2, SCALE = 3, 0.5, 1.0, 0.02, 0.01, 20.0
_TABLES: dict = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of each code point, 0 for what is no letter; and whether it is a letter."""
    if not _TABLES:
        low = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            if not 0xD800 <= i < 0xE000 and (c := chr(i)).isalpha():
                x = c.lower()
                low[i] = ord(x) if len(x) == 1 else i
        _TABLES["low"] = low
    return _TABLES["low"], _TABLES["low"] > 0


def grams(column) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each order, the hashed n-gram that begins at each character, -1 for none; texts' character offsets; letters of each text."""
    raw, off = utf8(column)
    low, letter = _tables()
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    at = heads[off]
    c = low[points].astype(np.uint64)
    letters = np.r_[0, np.cumsum(c > 0)]
    edge = np.zeros(len(c) + 4, bool)
    edge[at] = True
    out = []
    for n in ORDERS:
        m = max(0, len(c) - n + 1)
        h, some, inside = np.full(m, n, np.uint64), np.zeros(m, bool), np.ones(m, bool)
        for k in range(n):
            h = h * np.uint64(0x9E3779B1) + c[k : k + m]
            some |= c[k : k + m] > 0
            if k:
                inside &= ~edge[k : k + m]
        h = (h * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - DIM.bit_length() + 1)
        full = np.full(len(c), -1, np.int64)
        full[:m] = np.where(some & inside, h.astype(np.int64), -1)
        out.append(full)
    return out, at, letters[at[1:]] - letters[at[:-1]]


def _frequencies(batches):
    """Of each task, in how many texts a feature is, and in the row -1 the number of texts."""
    df, n = np.zeros(DIM, np.int64), 0
    flags = np.zeros(DIM + 1, bool)
    for batch in sliced(batches):
        if not batch.num_rows:
            continue
        orders, at, _ = grams(batch.column("text"))
        n += batch.num_rows
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            for full in orders:
                flags[full[a:b]] = True  # -1 marks the spare last place
            df += flags[:-1]
            flags[:] = False
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some]), pa.array(np.r_[n, df[some]])], ["feature", "n"])


def _sampled(batches):
    for batch in sliced(batches):
        if not batch.num_rows:
            continue
        orders, at, _ = grams(batch.column("text"))
        index, value = [], []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            which, n = np.unique(np.concatenate([x[a:b] for x in orders]), return_counts=True)
            n = n[which >= 0]
            index.append(which[which >= 0].astype(np.int32))
            value.append((n / max(1, n.sum())).astype(np.float32))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), batch.column("draw"), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))], ["doc_id", "lang", "draw", "places", "value"])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list, labels: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights (DIM x labels), intercepts and temperature. Every fifth row only calibrates."""
    k, of = len(labels), {x: i for i, x in enumerate(labels)}
    z, n = np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k))

    def weights(i):
        penal = np.where(i == DIM, 0.0, L1)[:, None]
        return np.where(np.abs(z[i]) <= penal, 0.0, -(z[i] - np.sign(z[i]) * penal) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    def inputs(r):
        i = np.array(r.places, np.int64)
        return np.r_[i, DIM], np.r_[SCALE * np.array(r.value) * idf[i], 1.0]

    rows = sorted(rows, key=lambda r: (r.draw, r.lang))
    for _ in range(EPOCHS):
        for j, r in enumerate(rows):
            if j % 5 == 4:
                continue
            i, x = inputs(r)
            w = weights(i)
            p = _softmax(x @ w)
            p[of[r.lang]] -= 1
            g = x[:, None] * p
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    w = weights(np.arange(DIM + 1))
    left = [(r, inputs(r)) for j, r in enumerate(rows) if j % 5 == 4]
    logits, truth = np.array([x @ w[i] for _, (i, x) in left]).reshape(len(left), k), np.array([of[r.lang] for r, _ in left], int)
    loss = lambda t: -np.log(np.maximum(1e-12, _softmax(logits / t)[np.arange(len(truth)), truth])).sum()
    temperature = min(np.exp(np.linspace(np.log(0.05), np.log(20), 121)), key=loss) if len(left) else 1.0
    return w[:-1], w[-1], float(temperature)


def _predicted(model):
    def predict(batches):
        labels, table, intercept, temperature = model.value
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            orders, at, letters = grams(batch.column("text"))
            logits, total = np.zeros((batch.num_rows, max(1, len(labels)))), np.zeros(batch.num_rows)
            for full in orders:
                for a in range(0, len(full), 1 << 20):  # a slice at a time, so that memory stays bounded
                    b = min(len(full), a + (1 << 20))
                    lo, hi = np.searchsorted(at, a, "right") - 1, np.searchsorted(at, b, "left")
                    cuts = np.clip(at[lo : hi + 1], a, b) - a
                    part = full[a:b]
                    sums = np.zeros((b - a + 1, table.shape[1]))
                    np.cumsum(table[part], axis=0, out=sums[1:])
                    logits[lo:hi] += sums[cuts[1:]] - sums[cuts[:-1]]
                    some = np.r_[0, np.cumsum(part >= 0)]
                    total[lo:hi] += some[cuts[1:]] - some[cuts[:-1]]
            p = _softmax((logits / np.maximum(1, total)[:, None] * SCALE + intercept) / temperature)
            known = (letters > 0) & (len(labels) > 0)
            best = p.argmax(1)
            pred = [labels[i] if ok else "und" for i, ok in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred), pa.array(np.where(known, p.max(1), 0.0))], ["doc_id", "held_out", "lang_pred", "score"])

    return predict


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs(doc_id, text, lang); other columns are ignored.

    Learns from rows that are not held out and have text and lang; with none of those, all is `und`. lang_pred is `und`
    with score 0 where the text is null or has no letter. A null doc_id counts as the empty text for held_out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), (crc_mod(F.col("doc_id"), FOLDS) == HELD).alias("held_out"))
    learn = rows.where("not held_out and text is not null and lang is not null")
    counted = learn.select("text").mapInArrow(_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()  # DIM + 1 rows at most
    df = {r.feature: r.n for r in counted}
    n = df.pop(-1, 0)
    idf = np.full(DIM, np.log(1 + n) + 1)
    for i, k in df.items():
        idf[i] = np.log((1 + n) / (1 + k)) + 1
    sizes = {r.lang: r["count"] for r in learn.groupBy("lang").count().collect()}  # one row for each language
    rates = {x: 1_000_000_000 if k <= LEAST else min(1_000_000_000, 1_000_000_000 * max(SAMPLE * k, LEAST * n) // (n * k)) for x, k in sizes.items()}
    raised = {x: r for x, r in rates.items() if r > 1_000_000_000 * SAMPLE // n}  # the others have one rate
    rate = F.lit(min(1_000_000_000, 1_000_000_000 * SAMPLE // max(1, n)))
    if raised:
        rate = F.coalesce(F.create_map(*[F.lit(y) for x, r in sorted(raised.items()) for y in (x, r)])[F.col("lang")].cast("long"), rate)
    # A text of very many rows is drawn once, and no language sends more than twice the bound.
    some = learn.withColumn("draw", F.xxhash64("text", F.lit(3))).where(F.pmod("draw", F.lit(1_000_000_000)) < rate).dropDuplicates(["draw", "lang"])
    found = some.select("doc_id", "lang", "draw", "text").mapInArrow(_sampled, "doc_id long, lang string, draw long, places array<int>, value array<float>")
    found = found.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("draw"))).where(F.col("rank") <= F.lit(2 * max(SAMPLE, LEAST))).collect()
    labels = sorted(sizes)
    if labels:
        w, intercept, temperature = train(found, labels, idf)
        table = np.vstack([w * idf[:, None], np.zeros((1, len(labels)))])  # the last row, also -1, is for no n-gram
    else:
        table, intercept, temperature = np.zeros((DIM + 1, 1)), np.zeros(1), 1.0
    model = spark.sparkContext.broadcast((labels, table, intercept, temperature))
    return rows.select("doc_id", "held_out", "text").mapInArrow(_predicted(model), "doc_id long, held_out boolean, lang_pred string, score double")
