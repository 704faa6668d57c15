"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each text. Expectation-maximisation over the counts of vote patterns of
all documents estimates each labeller's accuracy for either class and the share of good texts; each pattern then has a
posterior. A hashed linear scorer learns the posteriors from a bounded sample and scores every text: its features are
hashed words and hashed trigrams of byte classes, as shares of the text, and hashed bins of a few whole-text measures.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import drawn, sliced, utf8, Words

GRAMS, BINS, WORDS = 1792, 256, 2048  # places of trigrams, of bins, of words
DIM = GRAMS + BINS + WORDS
SAMPLE = 4000  # documents that the scorer learns from, at most
BIN = 0.4  # value of a bin's feature
PRIOR = 0.05  # of the texts, as which the first belief in a labeller counts
PSEUDO = 60  # bytes added to a text's length in the shares, so that a few words say little
THRESHOLD = 0.5  # posterior of being good from which a text is kept
# Labellers: a measure, the bound beyond which it votes bad, the bound within which it votes good, words needed. Fixed values.
LABELLERS = (
    ("symbols", ">", 0.04, 0.01, 1),
    ("capitals", ">", 0.30, 0.15, 5),
    ("exclamations", ">", 0.03, 0.01, 1),
    ("repeats", ">", 0.15, 0.03, 10),
    ("distinct", "<", 0.30, 0.45, 20),
    ("same_lines", ">", 0.45, 0.40, 1),
    ("letters", "<", 0.60, 0.72, 1),
    ("bare_words", ">", 0.15, 0.06, 5),
    ("mean_length", "outside", (2.5, 14.0), (3.0, 12.0), 5),
)
MEASURES = [x[0] for x in LABELLERS]
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[32, 9, 11, 12, 13]] = 4
_CLASS[10] = 5
_CLASS[128:] = 1  # parts of letters outside ASCII
_CLASS[33:48] = np.arange(6, 21)
_CLASS[58:65] = np.arange(21, 28)
_CLASS[91:97] = np.arange(28, 34)
_CLASS[123:127] = np.arange(34, 38)
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#$%&*+<=>@\\^_`{|}~", np.uint8))
_OTHER = {"upper": (np.arange(256) >= 65) & (np.arange(256) <= 90), "lower": (np.arange(256) >= 97) & (np.arange(256) <= 122), "high": np.arange(256) >= 192, "digit": (np.arange(256) >= 48) & (np.arange(256) <= 57)}


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return total[off[1:]] - total[off[:-1]]


def measures(column) -> dict[str, np.ndarray]:
    """Whole-text measures of each text; `words`, its number of words; `at` and `of`: each word's place among the features, and each text's first."""
    raw, off = utf8(column)
    words = Words(column)
    h, of = words.hashes(), words.of
    n_words = np.diff(of)
    chars = np.maximum(1, _sums((raw & 0xC0) != 0x80, off))
    upper, lower, high = (_sums(_OTHER[k][raw], off) for k in ("upper", "lower", "high"))
    solid = np.maximum(1, chars - _sums(_CLASS[raw] == 4, off) - _sums(raw == 10, off))
    alnum = (_OTHER["upper"] | _OTHER["lower"] | _OTHER["digit"] | (np.arange(256) >= 128))[raw]
    seen = np.r_[0, np.cumsum(alnum, dtype=np.int64)]
    bare = seen[words.end] == seen[words.begin]
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[of[:-1][n_words > 0]] = False
    text = raw.tobytes()
    distinct, same_lines = np.ones(len(n_words)), np.zeros(len(n_words))
    for i, (a, b, c, d) in enumerate(zip(of[:-1].tolist(), of[1:].tolist(), off[:-1].tolist(), off[1:].tolist())):
        if b > a:
            distinct[i] = len(np.unique(h[a:b])) / (b - a)
            lines = [x for x in text[c:d].split(b"\n") if x]
            same_lines[i] = 1 - len(set(lines)) / max(4, len(lines)) if len(lines) >= 4 else 0
    some = np.maximum(1, n_words)
    word_bytes = _sums_words(words, (raw & 0xC0) != 0x80, of)
    return {
        "symbols": _sums(_SYMBOL[raw], off) / solid, "capitals": upper / np.maximum(1, upper + lower + high), "exclamations": _sums(raw == 33, off) / solid,
        "repeats": _by_text(again, of) / some, "distinct": distinct, "same_lines": same_lines, "letters": (upper + lower + high) / solid,
        "bare_words": _by_text(bare, of) / some, "mean_length": word_bytes / some, "words": n_words,
        "at": (GRAMS + BINS + (h >> np.uint64(20)) % np.uint64(WORDS)).astype(np.int64), "of": of,
    }


def _by_text(flags: np.ndarray, of: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return total[of[1:]] - total[of[:-1]]


def _sums_words(words: Words, heads: np.ndarray, of: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(heads, dtype=np.int64)]
    return _by_text(total[words.end] - total[words.begin], of)


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """texts x labellers: 1 bad, 2 good, 0 no vote."""
    out = np.zeros((len(m["words"]), len(LABELLERS)), np.int64)
    for j, (name, how, bad, good, least) in enumerate(LABELLERS):
        x = m[name]
        if how == "outside":
            is_bad, is_good = (x < bad[0]) | (x > bad[1]), (x >= good[0]) & (x <= good[1])
        else:
            is_bad, is_good = (x > bad, x <= good) if how == ">" else (x < bad, x >= good)
        out[:, j] = np.where(m["words"] < max(1, least), 0, np.where(is_bad, 1, np.where(is_good, 2, 0)))
    return out


def _patterns(batches):
    power = 3 ** np.arange(len(LABELLERS))
    for batch in sliced(batches):
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(votes(measures(batch.column("text"))) @ power)], ["doc_id", "pattern"])


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[dict[int, float], list[tuple]]:
    """Posterior of being good of each pattern; and (labeller, share, right_good, right_junk): EM over good texts and one kind of junk for each labeller.

    Labellers err independently within a kind, and no vote says nothing. Each is believed at first to call few good texts
    bad, most junk of its own kind, and some of the other kinds; that belief weighs PRIOR of the texts, beside the votes.
    share: of the texts that are junk of the labeller's kind; right_good, right_junk: how often its vote is right on good
    texts and on that junk.
    """
    n = len(LABELLERS)
    v = patterns[:, None] // 3 ** np.arange(n) % 3
    bad, good = (v == 1).astype(float), (v == 2).astype(float)
    belief = np.full((n + 1, n), 0.2)
    belief[np.arange(n), np.arange(n)] = 0.9
    belief[n] = 0.01
    kinds = np.c_[0.02 + bad, 0.9 * (1 - bad.max(1, initial=0)) + 0.1]
    kinds /= kinds.sum(1, keepdims=True)
    extra = PRIOR * counts.sum() / (n + 1) + 1e-9
    for _ in range(rounds):
        weight = counts[:, None] * kinds
        wrong = (weight.T @ bad + extra * belief) / (weight.T @ (bad + good) + extra)
        share = (weight.sum(0) + extra) / (weight.sum() + extra * (n + 1))
        logs = np.log(share) + bad @ np.log(wrong).T + good @ np.log(1 - wrong).T
        now = np.exp(logs - logs.max(1, keepdims=True))
        now /= now.sum(1, keepdims=True)
        done, kinds = np.abs(now - kinds).max(initial=0) < 1e-6, now
        if done:
            break
    found = [(name, float(share[j]), float(1 - wrong[n, j]), float(wrong[j, j])) for j, name in enumerate(MEASURES)]
    return dict(zip(patterns.tolist(), kinds[:, n].tolist())), found


def _grams(raw: np.ndarray) -> np.ndarray:
    c = _CLASS[raw].astype(np.uint32)
    out = np.zeros(len(c), np.uint32)
    out[:-2] = (c[:-2] * np.uint32(38) + c[1:-1]) * np.uint32(38) + c[2:]
    return (out * np.uint32(2654435761) >> np.uint32(7)) % np.uint32(GRAMS)


def _bins(m: dict[str, np.ndarray]) -> np.ndarray:
    """texts x measures: hashed bins of the measures in the BINS places after the trigrams'."""
    out = np.empty((len(m["words"]), len(MEASURES)), np.int64)
    for j, (name, _, _, _, least) in enumerate(LABELLERS):
        x = np.minimum(15, m[name] if name == "mean_length" else m[name] * 20).astype(np.int64)
        x = np.where(m["words"] < least, 16, x)  # too few words to say
        out[:, j] = GRAMS + (x * 9 + j) % BINS
    return out


def _features(bins: bool):
    def features(batches):
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            m = measures(batch.column("text"))
            raw, off = utf8(batch.column("text"))
            grams, places, of, index, value = _grams(raw), _bins(m), m["of"], [], []
            for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                which, n = np.unique(grams[a : max(a, b - 2)], return_counts=True)
                word, k = np.unique(m["at"][of[i] : of[i + 1]], return_counts=True)
                index.append(np.r_[which, word, places[i] if bins else places[i, :0]])
                value.append(np.r_[n / (b - a + PSEUDO), k / (of[i + 1] - of[i] + PSEUDO / 6), np.full(len(index[-1]) - len(which) - len(word), BIN)])
            pattern = votes(m) @ 3 ** np.arange(len(LABELLERS))
            yield pa.RecordBatch.from_arrays([batch.column("draw"), pa.array(pattern), pa.array(index, pa.list_(pa.int64())), pa.array(value, pa.list_(pa.float64()))], ["draw", "pattern", "places", "value"])

    return features


def fit_scorer(rows: list[tuple], posterior: dict[int, float], rounds: int = 300) -> np.ndarray:
    """Weights and, last, the intercept: logistic regression on soft labels, by accelerated gradient steps. rows: (pattern, places, value)."""
    x, y = np.zeros((len(rows), DIM), np.float32), np.array([posterior.get(pattern, 0.5) for pattern, _, _ in rows], np.float32)
    for i, (_, places, value) in enumerate(rows):
        np.add.at(x[i], np.array(places, np.int64), value)
    if not len(rows):
        return np.zeros(DIM + 1)
    w, b, momentum, step = np.zeros(DIM), 0.0, np.zeros(DIM + 1), 0.5
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32) + b, -40, 40))) - y) / len(y)
        momentum = 0.9 * momentum - step * np.r_[x.T @ error.astype(np.float32) + 1e-4 * w, error.sum()]
        w, b = w + momentum[:-1], b + momentum[-1]
    return np.r_[w, b]


def _score(column, w: np.ndarray, bins: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Votes, and the scorer's probability of being good, of each text."""
    m = measures(column)
    raw, off = utf8(column)
    total = np.r_[0.0, np.cumsum(w[:-1][_grams(raw)])]
    last = np.maximum(off[:-1], off[1:] - 2)
    words, of = np.r_[0.0, np.cumsum(w[m["at"]])], m["of"]
    z = (total[last] - total[off[:-1]]) / (np.diff(off) + PSEUDO) + (words[of[1:]] - words[of[:-1]]) / (np.diff(of) + PSEUDO / 6) + w[-1]
    if bins:
        z = z + BIN * w[_bins(m)].sum(1)
    return votes(m), np.where(m["words"] > 0, 1 / (1 + np.exp(-np.clip(z, -40, 40))), 0.0)


def _scored(weights, bins: bool = True):
    def score(batches):
        for batch in sliced(batches):
            v, p = _score(batch.column("text"), weights.value, bins)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(v @ 3 ** np.arange(len(LABELLERS))), pa.array((v == 1).sum(1)), pa.array((v == 2).sum(1)), pa.array(p)], ["doc_id", "pattern", "votes_bad", "votes_good", "score"])

    return score


def _kept(weights):
    def keep(batches):
        for batch in sliced(batches):
            yield batch.filter(pa.array(_score(batch.column("text"), weights.value)[1] >= THRESHOLD))

    return keep


def _labelled(docs: DataFrame) -> tuple[DataFrame, dict[int, float], list[tuple], int]:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_patterns, "doc_id long, pattern long").groupBy("pattern").count().collect()  # 3 ** labellers rows at most
    return rows, *fit_labellers(np.array([r["pattern"] for r in counted], np.int64), np.array([r["count"] for r in counted], float)), sum(r["count"] for r in counted)


def accuracies(docs: DataFrame) -> DataFrame:
    """labeller, share, right_good, right_junk: what EM finds about each labeller from the votes on all rows of docs; see fit_labellers."""
    return docs.sparkSession.createDataFrame(_labelled(docs)[2], "labeller string, share double, right_good double, right_junk double")


def learned(docs: DataFrame, bins: bool = True):
    """The scorer's weights, broadcast, and the posterior of each pattern of votes. bins: whether it sees the bins of the measures."""
    rows, posterior, _, n = _labelled(docs)
    found = drawn(rows, n, SAMPLE).select("draw", "text").mapInArrow(_features(bins), "draw long, pattern long, places array<long>, value array<double>").orderBy("draw").limit(SAMPLE).collect()
    return docs.sparkSession.sparkContext.broadcast(fit_scorer([tuple(r)[1:] for r in found], posterior)), posterior


def scores(docs: DataFrame, bins: bool = True) -> DataFrame:
    """doc_id, votes_bad, votes_good, weak_good, score, kept of every row of docs(doc_id, text); other columns are ignored.

    weak_good: the posterior of the votes; score: the scorer's probability of being good; kept: whether that is at least
    THRESHOLD. Null, empty and blank texts score 0 and are not kept. Repeated rows score alike. An empty table gives no rows.
    """
    weights, posterior = learned(docs, bins)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weak = F.broadcast(docs.sparkSession.createDataFrame(list(posterior.items()), "pattern long, weak_good double"))
    out = rows.mapInArrow(_scored(weights, bins), "doc_id long, pattern long, votes_bad long, votes_good long, score double")
    return out.join(weak, "pattern", "left").select("doc_id", "votes_bad", "votes_good", "weak_good", "score", (F.col("score") >= THRESHOLD).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that the classifier keeps, with all their columns; each row by its own text.

    Null, empty and blank texts go. Repeated rows stay or go together. An empty table stays empty.
    """
    return docs.mapInArrow(_kept(learned(docs)[0]), docs.schema)
