"""Personal data: base patterns, and a skip-chain conditional random field that adds what they miss.

Base spans come from fixed patterns and checks. Around them, the field's nodes are a document's candidates: stretches
that look like a number of some length, or like an address. Chain edges join neighbours, near and far ones with weights of
their own; skip edges join candidates with the same or a similar normal form, however far apart: each with the one before,
and each free one with the nearest base span, so evidence doesn't fade along many repeats. Similar are numbers with the same
last ten digits and addresses one character apart; each kind of edge has weights of its own. Base spans are evidence. Loopy
sum-product passes messages over all edges until they settle, and a free candidate becomes a span where a label's belief is
high.

Weights are learned by pseudo-likelihood from a bounded sample of documents labelled by the base patterns. To each are
added repeats of its entities in forms that no pattern knows, others of the same shapes that are none, as often repeated, and
longer numbers that end like an entity and are none: so a skip edge's weights come from pairs that agree and pairs that don't.
A skip edge has one weight for agreement that all labels share, and smaller ones by label. The marks by which a pattern
decides are hidden from half of the nodes; words before a candidate have weights held near zero, so an unseen word says little.
"""

from __future__ import annotations

import bisect
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import drawn, sliced, utf8

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
SAMPLE, SAMPLE_NODES = 2000, 50  # examples that teach the field, and candidates of each, at most
VARIED, VARIANTS = 5000, 25  # documents of smaller tables teach by several examples, so that there are about so many; of each, at most
LOOKED = 60_000  # documents that are looked through for them, about
BELIEF = 0.75  # of a label, from which a free candidate becomes a span
SETTLED, ROUNDS = 1e-3, 1000  # the change of a message by which all have settled, and rounds of message passing at most
SHARED = 1.0  # of the step of a label's own pair weight: that of the weight for agreement
NEAR = 200  # characters between neighbours, beyond which the chain edge is a far one
DIM, WORDS = 256, 512  # hashed features of shapes, and of the words before
EDGES = ("near", "far", "same", "tail", "longer", "typo", "again", "alike")  # the first two are the chain's; the last two join free ones
_NEAR, _FAR, _SAME, _TAIL, _LONGER, _TYPO, _AGAIN, _ALIKE = range(len(EDGES))

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9])++")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?:@|\x20?[\[(]\x20?at\x20?[\])]\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63})+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if i % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def _emails(text: str):
    last, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and _LOCAL.match(text[begin - 1]):
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            last = m.end()
            yield begin, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind as in KINDS, then start; code points, end exclusive.

    Each pattern's matches are leftmost and don't overlap; one that fails its check is dropped and not tried otherwise.
    """
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-3:] or 0) <= 255 for x in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


class Nodes:
    """Candidates of a text in order: start, end, label (0 where no base span meets it, -1 as free), features, edges."""

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        spans = {(a, b): kind + 1 for kind, a, b in base}
        taken = sorted((a, b) for a, b in spans)
        found = [(m.start(), m.end()) for m in _NUMBER.finditer(text) if sum(c.isdigit() for c in m[0]) >= 7]
        if "@" in text or " at " in text or "at]" in text or "at)" in text or "at ]" in text or "at )" in text:
            found += [(m.start(), m.end()) for m in _ADDRESS.finditer(text)]
        free, i = [], 0
        for a, b in sorted(found):
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if (i == len(taken) or taken[i][0] >= b) and not (free and free[-1][1] > a):
                free.append((a, b))
        self.spans = sorted([*taken, *free])
        self.label = np.array([spans.get(s, 0) for s in self.spans], np.int64)
        self.fixed = self.label > 0
        self.features, self.marks = zip(*[_describe(text, a, b) for a, b in self.spans]) if self.spans else ((), ())
        chain = [(i, i + 1, _FAR if self.spans[i + 1][0] - self.spans[i][1] > NEAR else _NEAR) for i in range(len(self.spans) - 1)]
        self.edges = [*chain, *sorted(self._skips(text))]

    def _skips(self, text: str) -> set[tuple[int, int, int]]:
        """Edges (i, j, kind) between nodes that share a form: from each to the one before, from each free one to the nearest base span."""
        plain = [_plain(text[a:b]) for a, b in self.spans]
        addresses = any(not f and not p.isdigit() for f, p in zip(self.fixed, plain))
        groups, found = collections.defaultdict(list), set()
        for i, (p, (a, b)) in enumerate(zip(plain, self.spans)):
            for form in _forms(text[a:b], p, addresses):
                groups[form].append(i)
        for nodes in groups.values():
            held = [i for i in nodes if self.fixed[i]]
            for i, j in zip(nodes, nodes[1:]):
                if not (self.fixed[i] and self.fixed[j]):
                    found.add((i, j))
            for i in nodes if held else ():
                if not self.fixed[i]:
                    at = bisect.bisect(held, i)
                    j = min(held[max(0, at - 1) : at + 1], key=lambda j: abs(self.spans[j][0] - self.spans[i][0]))
                    found.add((min(i, j), max(i, j)))
        return {(i, j, self._kind(plain, i, j)) for i, j in found}

    def _kind(self, plain: list[str], i: int, j: int) -> int:
        if not (self.fixed[i] or self.fixed[j]):
            return _AGAIN if plain[i] == plain[j] else _ALIKE
        entity, other = (plain[i], plain[j]) if self.fixed[i] else (plain[j], plain[i])
        if entity == other:
            return _SAME
        return _TYPO if not entity.isdigit() else _TAIL if len(other) < len(entity) else _LONGER


def _plain(x: str) -> str:
    """Letters and digits; `at` and `dot` that stand for signs go."""
    return re.sub(r"[^a-z0-9]", "", re.sub(r"\x20?[\[(]?\x20?\b(?:at|dot)\b\x20?[\])]?\x20?", "", x.lower()))


def _forms(x: str, plain: str, addresses: bool) -> list[str]:
    """Normal forms by which candidates are the same or similar: all letters and digits; a number's last ten digits; an address
    less a character, so that addresses one character apart share a form."""
    if re.search("[A-Za-z]", x):
        return [plain, *({f"~{plain[:i]}{plain[i + 1 :]}" for i in range(len(plain))} | {f"~{plain}"} if addresses else ())]
    digits = re.sub(r"[^0-9]", "", x)
    return [plain] + ([f"#{digits[-10:]}"] if len(digits) >= 10 else [])


def _describe(text: str, a: int, b: int) -> tuple[list[int], list[int]]:
    """Hashed features; and the marks, which decide in the base patterns and are hidden at times."""
    x = text[a:b]
    digits = [c for c in x if c.isdigit() and c.isascii()]
    groups = [len(g) for g in re.findall(r"[0-9]+", x)]
    words = re.findall(r"[A-Za-z]{2,20}(?=[^A-Za-z]*$)", text[max(0, a - 30) : a])
    letters = bool(re.search("[A-Za-z]", x))
    plain = ["bias", f"letters{letters}", f"n{min(24, len(digits))}", "groups" + "-".join(map(str, groups[:6])), f"dots{min(4, x.count('.'))}", f"hyphens{min(4, x.count('-'))}", f"blanks{min(4, x.count(' '))}", f"brackets{'(' in x}", f"slash{'/' in x}"]
    marks = [f"plus{x[:1] == '+'}", f"at{'@' in x}", f"luhn{not letters and len(digits) >= 16 and luhn(''.join(digits))}", f"bytes{len(groups) == 4 and all(g <= 3 for g in groups)}"]
    place = lambda names: [zlib.crc32(s.encode()) % DIM for s in names]
    return [*place(plain), DIM + zlib.crc32((words[-1].lower() if words else "").encode()) % WORDS], place(marks)


def repeats(text: str, base: list[tuple[int, int, int]], rng: random.Random) -> tuple[str, dict]:
    """The text with up to four of its entities again, as no pattern knows them, and with others that are none; labels of those by span."""
    words, made, truth, out = re.findall(r"[A-Za-z]{2,20}", text[:20_000]) or ["and"], [], {}, text
    for kind, a, b in rng.sample(base, min(4, len(base))):
        x, digits = text[a:b], re.sub("[^0-9]", "", text[a:b])
        other = "".join(rng.choice("0123456789") for _ in digits)
        times = rng.choice((1, 1, 1, 2, 4))
        for label, d in (*[(kind + 1, digits), (0, other)] * times, (0, f"{rng.randint(10, 99)}{digits}")):
            if label == 0 and d is not other and rng.random() < 0.85:
                continue
            if kind == 0:
                local, _, domain = x.partition("@")
                local, domain = (local, domain) if label else ("".join("abcdefghij"[int(c)] for c in d.ljust(6, "7")[:12]) if d else "none", domain)
                if label and len(local) > 2 and rng.random() < 0.25:
                    at = rng.randrange(len(local))
                    local = local[:at] + rng.choice("abcdefghij") + local[at + 1 :]  # mistyped
                y = local + rng.choice([" [at] ", " (at) ", "[at]", " at "]) + domain.replace(".", rng.choice([".", " [dot] ", " dot "]))
            elif kind == 1:
                parts = x.split(".") if label else [d[i : i + 2] for i in range(0, len(d), 2)]
                y = rng.choice(["/", "-"]).join(parts)
            else:
                d = d[-10:] if kind == 3 and d is digits and len(d) >= 10 and rng.random() < 0.7 else d
                sep = rng.choice(["", "-", "."]) if kind == 3 else rng.choice([".", "/"])
                cut = [len(d) - 7, len(d) - 4] if kind == 3 else range(4, len(d), 4)
                y = sep.join(d[i:j] for i, j in zip([0, *cut], [*cut, len(d)]) if i < j)
                y = f"({d[:3]}) {d[3:6]}-{d[6:]}" if kind == 3 and len(d) == 10 and rng.random() < 0.3 else y
            made.append((y, label))
    rng.shuffle(made)  # so that neighbours say nothing of how these came about
    for y, label in made:
        out += " " + " ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) + " "
        truth[(len(out), len(out) + len(y))] = label
        out += y
    return out + " " + rng.choice(words), truth


def fit(rows: list[tuple], rounds: int = 1000) -> tuple[np.ndarray, ...]:
    """Weights of features and of the edges of each kind in EDGES. rows: a document's (features, marks, labels, edges) each.

    Pseudo-likelihood: each node given its features and its neighbours' labels, with an L2 penalty. A label of -1 is open (a
    candidate that repeats an entity and may be one): such a node teaches nothing, nor do its edges. Every second document goes
    without the edges between free candidates, so that evidence is enough without them.
    """
    k = len(LABELS)
    x, y, sums, word = [], [], [], []
    for at, (features, marks, label, edges) in enumerate(rows):
        for i, (f, m) in enumerate(zip(features, marks)):
            row = np.zeros(DIM, np.float32)
            row[f[:-1]] = 1
            if (len(y) + i) % 2:
                row[m] = 1
            x.append(row)
            word.append(f[-1] - DIM)
        y.extend(label)
        mine = np.zeros((len(EDGES), len(label), k), np.float32)
        for i, j, kind in edges:
            if label[i] >= 0 and label[j] >= 0 and (kind < _AGAIN or at % 2):
                mine[kind, i, label[j]] += 1
                mine[kind, j, label[i]] += 1
        sums.append(mine)
    w, tables = np.zeros((DIM + WORDS, k)), np.zeros((len(EDGES), k, k))
    sure = np.array(y, np.int64) >= 0
    if not sure.any():
        w[zlib.crc32(b"bias") % DIM, 0] = 9.0  # nothing is known, so no candidate is taken
        return w, *tables
    x, y, word, sums = np.array(x)[sure], np.array(y)[sure], np.array(word)[sure], np.concatenate(sums, 1)[:, sure]
    want, n, agree = np.eye(k)[y], len(y), np.zeros(len(EDGES))
    moved_w, moved_t, moved_a = np.zeros_like(w), np.zeros_like(tables), np.zeros_like(agree)
    for _ in range(rounds):
        full = tables + agree[:, None, None] * np.eye(k)
        z = (x @ w[:DIM].astype(np.float32)).astype(np.float64) + w[DIM + word] + sum(s @ e for s, e in zip(sums, full))
        p = np.exp(z - z.max(1, keepdims=True))
        error = (p / p.sum(1, keepdims=True) - want) / n
        by_word = np.stack([np.bincount(word, error[:, c], WORDS) for c in range(k)], 1)
        g_w = np.r_[x.T @ error.astype(np.float32) + 1e-4 * w[:DIM], by_word + 3e-3 * w[DIM:]]
        by_edge = np.stack([s.T @ error for s in sums])
        by_edge = (by_edge + by_edge.transpose(0, 2, 1)) / 2  # an edge has no direction
        g_a = np.trace(by_edge, axis1=1, axis2=2) * SHARED
        g_a[:_SAME] = 0  # neighbours of the chain need not agree
        moved_w, moved_t, moved_a = 0.9 * moved_w - g_w, 0.9 * moved_t - (by_edge + 3e-4 * tables), 0.9 * moved_a - (g_a + 3e-5 * agree * SHARED)
        w, tables, agree = w + moved_w, tables + moved_t, agree + moved_a
    return w, *(tables + agree[:, None, None] * np.eye(k))


def beliefs(nodes: Nodes, model) -> np.ndarray:
    """nodes x labels once messages have settled; fixed nodes stand for their label alone."""
    w, *tables = model
    node = np.array([w[f].sum(0) + w[m].sum(0) for f, m in zip(nodes.features, nodes.marks)])
    node[nodes.fixed] = -1e9
    node[nodes.fixed, nodes.label[nodes.fixed]] = 0
    return marginals(node, nodes.edges, np.array(tables))


def marginals(node: np.ndarray, edges: list[tuple[int, int, int]], tables: np.ndarray) -> np.ndarray:
    """Label probabilities of each node by loopy sum-product: node scores, edges (i, j, kind) and the kinds' pair scores.

    Messages move by half of their change; after 100 rounds by ever less, so that contradictory loops settle, too.
    """
    if not edges:
        e = np.exp(node - node.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)
    ends = np.array(edges, np.int64)
    src, dst, pot = np.r_[ends[:, 0], ends[:, 1]], np.r_[ends[:, 1], ends[:, 0]], tables[ends[:, 2]]
    pot, half = np.concatenate([pot, pot.transpose(0, 2, 1)]), len(ends)
    back = np.r_[np.arange(half, 2 * half), np.arange(half)]
    message = np.zeros((2 * half, node.shape[1]))

    def gathered():
        total = node.copy()
        np.add.at(total, dst, message)
        return total

    for r in range(ROUNDS):
        out = (gathered()[src] - message[back])[:, :, None] + pot
        top = out.max(1, keepdims=True)
        new = np.log(np.exp(out - top).sum(1)) + top[:, 0]
        change = new - new.max(1, keepdims=True) - message
        message += min(0.5, 50 / (r + 1)) * change
        if np.abs(change).max() < SETTLED:
            break
    total = gathered()
    e = np.exp(total - total.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def added_spans(text: str, base: list[tuple[int, int, int]], model) -> list[tuple[int, int, int]]:
    nodes = Nodes(text, base)
    if nodes.fixed.all():
        return []
    p = beliefs(nodes, model)
    return [(int(k) - 1, a, b) for (a, b), k, q, fixed in zip(nodes.spans, p.argmax(1), p.max(1), nodes.fixed) if not fixed and k and q >= BELIEF]


def _telling(column) -> list[bool]:
    """Of each text, whether it has a digit or an address sign or word; without, it has neither spans nor candidates."""
    raw, off = utf8(column)
    flags = ((raw >= 48) & (raw <= 57)) | (raw == 64)
    total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return (total[off[1:]] > total[off[:-1]]).tolist()


def example(text: str, seed: int | str) -> dict:
    """What a document teaches: a stretch of its nodes, by the base patterns and with repeats that it was given."""
    text, truth = repeats(text, base_spans(text), random.Random(seed))
    nodes = Nodes(text, base_spans(text))
    entity = [bool(f) or truth.get(s, 0) > 0 for f, s in zip(nodes.fixed, nodes.spans)]
    skips = [(i, j) for i, j, kind in nodes.edges if kind >= _SAME]
    open_ends = {j for edge in skips for i, j in (edge, edge[::-1]) if entity[i] and not entity[j]}
    label = [truth[s] if s in truth else -1 if i in open_ends else int(k) for i, (s, k) in enumerate(zip(nodes.spans, nodes.label))]
    kept = set(range(max(0, len(nodes.spans) - SAMPLE_NODES), len(nodes.spans)))  # what was added stands last
    kept |= {i for edge in skips for i, j in (edge, edge[::-1]) if j in kept and nodes.fixed[i]}  # and the base spans that it repeats
    place = {i: at for at, i in enumerate(sorted(kept))}
    edges = [[place[i], place[j], kind] for i, j, kind in nodes.edges if i in place and j in place]
    pick = lambda values: [values[i] for i in place]
    return {"features": pick(nodes.features), "marks": pick(nodes.marks), "label": pick(label), "edges": edges}


def _examples(variants: int):
    def teach(batches):
        for batch in sliced(batches):
            rows, draws, places = [], [], []
            for text, draw, telling in zip(batch.column("text").to_pylist(), batch.column("draw").to_pylist(), _telling(batch.column("text"))):
                for i in range(variants if telling else 0):
                    if (got := example(text, f"{draw}:{i}"))["label"]:
                        rows.append(got)
                        draws.append(draw)
                        places.append(i)
            lists = pa.list_(pa.list_(pa.int64()))
            kinds = {"features": lists, "marks": lists, "label": pa.list_(pa.int64()), "edges": lists}
            yield pa.RecordBatch.from_arrays([pa.array(draws, pa.int64()), pa.array(places, pa.int64()), *(pa.array([r[c] for r in rows], k) for c, k in kinds.items())], ["draw", "variant", *kinds])

    return teach


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _found(model):
    def find(batches):
        for batch in sliced(batches):
            counts, sha, spans, more = [], [], [], []
            for text, telling in zip(batch.column("text").to_pylist(), _telling(batch.column("text"))):
                base = base_spans(text) if telling else []
                added = added_spans(text, base, model.value) if telling or (text and _ADDRESS.search(text)) else []
                counts.append([sum(k == i for k, _, _ in base) for i in range(len(KINDS))])
                sha.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined([*base, *added]))
                more.append(len(added))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(sha), pa.array(spans), pa.array(more, pa.int64())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return find


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added of every row of docs(doc_id, text).

    Null text counts as empty and has no spans. Repeated rows say the same. Other columns are ignored. An empty table gives
    no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "array<array<long>>"
    n = rows.count()
    examples = _examples(max(1, min(VARIANTS, VARIED // max(1, n))))
    found = drawn(rows, n, LOOKED).select("draw", "text").mapInArrow(examples, f"draw long, variant long, features {kind}, marks {kind}, label array<long>, edges {kind}")
    found = found.orderBy("variant", "draw").limit(SAMPLE).collect()
    model = spark.sparkContext.broadcast(fit([tuple(r)[2:] for r in found]))
    return rows.mapInArrow(_found(model), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
