"""Personal data by fixed patterns and a skip-chain conditional random field.

The base spans are those of four patterns (e-mail, IP, card with Luhn check,
phone). Over the carriers of a document - its tokens with a digit or an at
sign - stands a conditional random field: consecutive carriers share a chain
potential, carriers with the same digits or the same local part, however far
apart, share a skip potential, and loopy belief propagation settles the labels
of a document together. Carriers inside base spans are observed; others become
further spans where the field is confident, so a number that is unmistakable
once is recognised where it is written in another way.

The field is learnt by pseudo-likelihood on a bounded sample of documents whose
carriers carry the base labels: the form of a carrier and the labels of its
neighbours have to explain its own. A carrier outside the base spans that is
similar to one inside has no known label and is left out. Skip potentials start from a prior by which
similar carriers agree, and move from it as far as the sample speaks.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, spread, table, texts_of

KINDS = ("email", "ip", "card", "phone")
#: Label 0 is "no personal data", label k + 1 is KINDS[k].
LABELS = 1 + len(KINDS)
#: Documents with a carrier that the field is learnt from, about.
SAMPLE = 4000
#: Marginal from which a carrier outside the base spans becomes a span.
CONFIDENT = 0.9
#: Carriers further apart than this share no chain potential.
NEAR = 40
#: Rounds of message passing at most; it ends earlier when no message changes by TOLERANCE.
PASSES, TOLERANCE = 25, 1e-3
#: Prior log-odds of no personal data, and of agreement between similar carriers.
PRIOR_NONE, PRIOR_AGREE = 3.0, 6.0
#: Shapes are hashed to so many features.
SHAPES = 4096

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_CARRIER = _LOCAL | frozenset("@()")
_START = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){15,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TAIL = re.compile(r"[A-Za-z0-9._%+@()-]*")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else (v * 2 if v < 5 else v * 2 - 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """The leftmost matches of local@domain, found from the at signs: the same spans as the pattern's, in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = [(0, *x) for x in emails(text)] if "@" in text else []
    if _START.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) < 256 for x in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def carriers(text: str) -> list[tuple[int, int]]:
    """Maximal runs of the characters personal data is written in that hold a digit or an at sign, less punctuation at their ends."""
    out, done = [], 0
    while m := _START.search(text, done):
        start, end = m.start(), _TAIL.match(text, m.start()).end()
        while start > done and text[start - 1] in _CARRIER:
            start -= 1
        done = end
        while text[end - 1] in ".-(":
            end -= 1
        while text[start] in ".-)":
            start += 1
        out.append((start, end))
    return out


def _length(n: int) -> str:
    return str(n) if n < 5 else "5" if n < 8 else "8" if n < 12 else "12" if n < 16 else "16" if n < 20 else "20"


def shape(token: str) -> int:
    """The hashed form of a token: runs of letters and digits, lengths roughly, and whether its digits pass the checks."""
    runs = re.sub(r"[0-9]+", lambda m: "9" + _length(len(m.group())), re.sub(r"[A-Za-z]+", "a", token))
    digits = _NOT_DIGIT.sub("", token)
    checks = f"{int(16 <= len(digits) <= 19 and luhn(digits))}{int(len(digits) > 15)}" if len(digits) == len(token) else "-"
    return zlib.crc32(f"{runs[:64]}|{checks}".encode()) % SHAPES


def likeness(token: str) -> str:
    """Equal for tokens that share a skip potential: the digits of long numbers, the last seven of shorter ones (with or without prefix), else the local part."""
    digits = _NOT_DIGIT.sub("", token)
    if len(digits) >= 7 and not any(c.isalpha() for c in token):
        return digits if len(digits) >= 12 else digits[-7:]
    return token.partition("@")[0].lower().strip(".-()%+_")


@dataclass
class Graph:
    """The carriers of some texts with what the field looks at."""

    text: list[int]
    spans: list[tuple[int, int]]
    shapes: np.ndarray
    base: np.ndarray  # label of the base span that a carrier touches, 0 for none
    chain: np.ndarray  # pairs of carriers
    skip: np.ndarray


def graph(texts: list[str], bases: list[list[tuple[int, int, int]]]) -> Graph:
    text, spans, shapes, base, chain, skip = [], [], [], [], [], []
    for number, (whole, known) in enumerate(zip(texts, bases, strict=True)):
        seen: dict[str, int] = {}
        by_start = sorted((a, b, k) for k, a, b in known)
        at, reach = 0, []
        for start, end in carriers(whole):
            node = len(spans)
            while at < len(by_start) and by_start[at][0] < end:
                reach.append(by_start[at])
                at += 1
            reach = [x for x in reach if x[1] > start]
            label = min((k + 1 for a, b, k in reach if a < end and b > start), default=0)
            if node and text[-1] == number and start - spans[-1][1] <= NEAR:
                chain.append((node - 1, node))
            token = whole[start:end]
            if (like := likeness(token)) in seen:
                skip.append((seen[like], node))
            if like:
                seen[like] = node
            text.append(number)
            spans.append((start, end))
            shapes.append(shape(token))
            base.append(label)
    pairs = lambda x: np.array(x, dtype=np.int64).reshape(-1, 2)
    return Graph(text, spans, np.array(shapes, dtype=np.int64), np.array(base, dtype=np.int64), pairs(chain), pairs(skip))


@dataclass
class Field:
    """Weights: by shape and label, by label pairs of chain and of skip neighbours."""

    shape: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, g: Graph) -> np.ndarray:
        """Label probabilities of every carrier by loopy belief propagation; carriers in base spans are observed."""
        unary = self.shape[g.shapes].copy()
        seen = np.flatnonzero(g.base)
        unary[seen] = -40.0
        unary[seen, g.base[seen]] = 0.0
        source = np.concatenate([g.chain[:, 0], g.chain[:, 1], g.skip[:, 0], g.skip[:, 1]])
        target = np.concatenate([g.chain[:, 1], g.chain[:, 0], g.skip[:, 1], g.skip[:, 0]])
        c, s = len(g.chain), len(g.skip)
        back = np.concatenate([np.arange(c) + c, np.arange(c), np.arange(s) + 2 * c + s, np.arange(s) + 2 * c])
        weight = np.concatenate([np.broadcast_to(w, (n, LABELS, LABELS)) for w, n in ((self.chain, c), (self.chain.T, c), (self.skip, s), (self.skip.T, s))])
        message = np.zeros((len(source), LABELS))
        for _ in range(PASSES):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = np.logaddexp.reduce((belief[source] - message[back])[:, :, None] + weight, axis=1)
            out -= out.max(axis=1, keepdims=True)
            change = np.abs(out - message).max(initial=0.0)
            message = out
            if change < TOLERANCE:
                break
        belief = unary
        np.add.at(belief, target, message)
        belief -= belief.max(axis=1, keepdims=True)
        belief = np.exp(belief)
        return belief / belief.sum(axis=1, keepdims=True)


def blank_field() -> Field:
    """The prior: carriers are no personal data, unless similar ones are."""
    unary, skip = np.zeros((SHAPES, LABELS)), np.zeros((LABELS, LABELS))
    unary[:, 0] = PRIOR_NONE
    np.fill_diagonal(skip[1:, 1:], PRIOR_AGREE)
    return Field(unary, np.zeros((LABELS, LABELS)), skip)


def fit(cases: list[tuple[tuple[int, ...], int]], steps: int = 400, ridge: float = 0.5) -> Field:
    """Pseudo-likelihood: cases are ((shape, left, right, skip before, skip after, label), count); -1 for no neighbour."""
    field = blank_field()
    if not cases:
        return field
    rows = np.array([x for x, _ in cases], dtype=np.int64)
    count = np.array([n for _, n in cases], dtype=np.float64)
    used, shapes = np.unique(rows[:, 0], return_inverse=True)
    label, total = rows[:, 5], count.sum()
    parts = [np.zeros((len(used), LABELS)), field.chain, field.skip]
    parts[0][:, 0] = PRIOR_NONE
    prior = [x.copy() for x in parts]
    speed = [np.zeros_like(x) for x in parts]
    has = [rows[:, k] >= 0 for k in range(1, 5)]
    for step in range(steps):
        shaped, chain, skip = parts
        logit = shaped[shapes].copy()
        for k, w in enumerate((chain, chain.T, skip, skip.T)):
            # to the left stands the first index, to the right the second
            logit[has[k]] += w[rows[has[k], k + 1]]
        logit -= logit.max(axis=1, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(rows)), label] -= 1.0
        p *= count[:, None]
        grads = [ridge * (a - b) for a, b in zip(parts, prior, strict=True)]
        np.add.at(grads[0], shapes, p)
        for k, g in enumerate((grads[1], grads[1].T, grads[2], grads[2].T)):
            np.add.at(g, rows[has[k], k + 1], p[has[k]])
        for k, g in enumerate(grads):
            speed[k] += g**2
            parts[k] -= 0.5 * g / np.sqrt(speed[k] + 1e-9) * (1.0 if step < steps // 2 else 0.3)
    field.shape[used] = parts[0]
    field.chain, field.skip = parts[1], parts[2]
    return field


def unknown(g: Graph) -> np.ndarray:
    """Which carriers lie outside the base spans but are joined by skip potentials, over any number, to one inside."""
    near = g.base > 0
    for a, b in g.skip.tolist():  # by the second, so one way and back is enough
        near[b] |= near[a]
    for a, b in g.skip[::-1].tolist():
        near[a] |= near[b]
    return near & (g.base == 0)


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    """The field learnt from about ``sample`` documents with a digit or an at sign, chosen by a hash of key and text.

    The driver receives counts of the distinct neighbourhoods in the sample.
    """
    some = docs.where(F.col(text).rlike("[0-9@]"))
    n = some.count()
    chosen = some.where((F.xxhash64(key, text).bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31)) < (min(1.0, sample / n) if n else 1.0)).select(F.col(text).alias("text"))

    def cases(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch)
        g = graph(texts, [base_spans(x) for x in texts])
        around = np.full((len(g.spans), 4), -1, dtype=np.int64)
        open_ = unknown(g)
        label = np.where(open_, -1, g.base)
        around[g.chain[:, 1], 0] = label[g.chain[:, 0]]
        around[g.chain[:, 0], 1] = label[g.chain[:, 1]]
        around[g.skip[:, 1], 2] = label[g.skip[:, 0]]
        around[g.skip[:, 0], 3] = label[g.skip[:, 1]]
        table_ = np.column_stack([g.shapes, around, g.base])[~open_]
        found, count = np.unique(table_, axis=0, return_counts=True) if len(table_) else (table_, np.zeros(0, dtype=np.int64))
        return pa.RecordBatch.from_arrays([*(pa.array(found[:, k]) for k in range(6)), pa.array(count.astype(np.int64))], ["a", "b", "c", "d", "e", "f", "n"])

    counted = arrow_map(chosen, cases, "a long, b long, c long, d long, e long, f long, n long").groupBy("a", "b", "c", "d", "e", "f").agg(F.sum("n").alias("n"))
    return fit(sorted(((r[0], r[1], r[2], r[3], r[4], r[5]), r[6]) for r in counted.collect()))


def all_spans(texts: list[str], field: Field) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, all spans) of each text, by kind and start."""
    bases = [base_spans(x) for x in texts]
    more: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    busy = [k for k, x in enumerate(texts) if _START.search(x)]
    if busy:
        g = graph([texts[k] for k in busy], [bases[k] for k in busy])
        if (g.base == 0).any():
            p = field.marginals(g)
            best = p.argmax(axis=1)
            sure = (g.base == 0) & (best > 0) & (p.max(axis=1) >= CONFIDENT)
            for node in np.flatnonzero(sure).tolist():
                number, kind, (start, end) = busy[g.text[node]], int(best[node]) - 1, g.spans[node]
                own = more[number]
                if own and own[-1][0] == kind and not texts[number][own[-1][2] : start].strip(" ()-"):
                    own[-1] = (kind, own[-1][1], end)
                else:
                    own.append((kind, start, end))
    return [(base, sorted(base + more[k]) if k in more else base) for k, base in enumerate(bases)]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, counts of the base spans, their SHA-256, and all spans as text.

    Offsets are code points, ends exclusive. Defined results: a null text is
    read as empty; a text without spans has the hash of the empty string and
    spans ''; repeated rows have equal results; null keys are kept; an empty
    table gives no rows; texts are read whole, and further columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(field)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = all_spans(texts_of(batch), held.value)
        counts = [Counter(k for k, _, _ in base) for base, _ in found]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))),
                pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                pa.array([_joined(spans) for _, spans in found], pa.string()),
            ],
            ["doc_id", *(f"n_{x}" for x in KINDS), "base_sha256", "spans"],
        )

    return arrow_map(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, " + ", ".join(f"n_{x} long" for x in KINDS) + ", base_sha256 string, spans string")


def redact(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in brackets, as [EMAIL].

    Defined results: spans that overlap become one, of the kind that starts
    first; null texts stay null and empty ones empty; repeated rows get equal
    texts; an empty table gives no rows; texts are read whole; further columns,
    of any name, go through unchanged.
    """
    held = docs.sparkSession.sparkContext.broadcast(field)

    def clean(whole: str, spans: list[tuple[int, int, int]]) -> str:
        out, done = [], 0
        for start, end, kind in sorted((a, b, k) for k, a, b in spans):
            if start >= done:
                out += [whole[done:start], f"[{KINDS[kind].upper()}]"]
            done = max(done, end)
        return "".join([*out, whole[done:]])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(text).to_pylist()
        whole = [x or "" for x in raw]
        new = [x if x is None else clean(x, spans) for x, (_, spans) in zip(raw, all_spans(whole, held.value), strict=True)]
        at = batch.schema.get_field_index(text)
        return batch.set_column(at, text, pa.array(new, pa.string()))

    return arrow_map(docs, run, docs.schema)


def op5_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document; the n_ columns count base spans, ``spans`` lists all."""
    docs = spread(table(spark, sf_dir, "documents"))
    return find(docs, learn(docs))
