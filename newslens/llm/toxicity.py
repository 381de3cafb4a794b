"""Toxicity by a convolutional classifier, trained in numpy.

A word's vector is the sum of the embeddings of its hash and of the hashes of its
first letters, so that inflected and compound words are like their stem. Filters
of several widths slide over these vectors; each one's outputs are max-pooled over
segments of the text, and a text is described by every filter's greatest maximum
and its mean maximum: whether there is a telling passage, and how densely. On this
rest two outputs: the odds of toxicity, and the language, which a text is read in
rather than told. The threshold on the odds is calibrated for each language on
documents that the fit doesn't see, and scores are shifted so that it lies at
THRESHOLD in every language.

It learns from all labelled documents: words are counted by an aggregation, tasks
train on shards from common parameters, each of which then moves by the mean of the
shards that moved it, and thresholds are read from counts of log-odds.

Only words and beginnings that several documents have get embeddings; they
are found by their full hash, so an unknown word is never taken for a known one.
Embeddings start from the shift of the log-odds that their presence makes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ..runtime import LONG_ROWS, small_batches
from .common import arrow_map, free_name, quoted, spread, stash, table, texts_of, utf8_crc32
from .textvec import PIECE, U64, code_points, lower_and_kind, mix, powers

#: Documents of a shard, and characters of it, about: a task trains on a shard at a time.
SHARD, SHARD_CHARS = 2000, 1 << 24
#: Times that the parameters of all shards are averaged.
ROUNDS = 4
#: Words and beginnings with embeddings at most; of more, those that fewer documents have go.
KEYS = 1 << 17
#: Labels up to which they are sent to the documents; more meet them by a shuffle.
SENT = 4_000_000
#: Parameters that are added together, and parts of the log-odds that thresholds tell apart.
CHUNK, FINE = 1 << 16, 1000
#: Components of an embedding, filters of each width, and the widths in words, ascending.
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
#: First letters of a word that have an embedding too, in words longer than that.
STEMS = (5, 7)
#: Words of a segment.
SEGMENT = 64
#: Labelled documents that a word has to be in.
SEEN = 3
#: Documents that stand for a word's being as toxic as any, against those that it is seen in.
PRIOR = 10.0
#: Share of the words that a text is read without, others in every epoch.
DROP = 0.2
#: Deviation that embeddings start with.
NOISE = 0.1
#: The score from which a text counts as toxic.
THRESHOLD = 0.7
#: Toxic documents that a language needs for a threshold of its own.
OWN = 15
#: Times that a shard is gone through at least, and steps that are taken at least.
EPOCHS, STEPS = 12, 150
BATCH, RATE, RIDGE = 48, 0.08, 1e-4
#: Slots of the table that finds a hash.
SLOTS = 1 << 21
#: Words that go through the filters at a time.
_WORDS = 1 << 13
_PAD = max(WIDTHS) - 1


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every word and of its beginnings (0 where the word is no longer), a row for each, and the bounds of each text."""
    parts, counts = [], np.zeros(len(texts) + 1, dtype=np.int64)
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= PIECE):
            size += len(texts[end]) + 1
            end += 1
        begins = np.cumsum([0, *(len(x) + 1 for x in texts[at:end])])
        points, word = lower_and_kind(code_points("\n".join(texts[at:end])))
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        rows = np.zeros((len(starts), 1 + len(STEMS)), dtype=U64)
        # hashes of pieces of the text, so that the powers needed don't grow with it
        for low in range(0, max(1, len(starts)), PIECE // 8):
            some = slice(low, low + PIECE // 8)
            if not len(starts[some]):
                break
            origin, upto = int(starts[some][0]), int(ends[some][-1])
            up, down = powers(upto - origin + 1)
            prefix = np.zeros(upto - origin + 1, dtype=U64)
            np.cumsum((points[origin:upto].astype(U64) + U64(0x51ED270B)) * up[:-1], out=prefix[1:])
            s, e = starts[some] - origin, ends[some] - origin
            rows[some, 0] = mix((prefix[e] - prefix[s]) * down[s] + U64(1))
            for k, letters in enumerate(STEMS):
                long = e - s > letters
                rows[some, 1 + k] = np.where(long, mix((prefix[np.minimum(e, s + letters)] - prefix[s]) * down[s] + U64(2 + k)), 0)
        parts.append(rows)
        counts[at + 1 : end + 1] = np.diff(np.searchsorted(starts, begins))
        at = end
    return np.concatenate(parts) if parts else np.zeros((0, 1 + len(STEMS)), dtype=U64), np.cumsum(counts)


@dataclass
class Model:
    """Parameters; row 0 of the embeddings is nothing's and stays 0."""

    keys: np.ndarray
    slots: np.ndarray
    embedding: np.ndarray
    filters: list[np.ndarray]  # for each width: words x components x filters
    bias: np.ndarray
    toxic: np.ndarray
    toxic_bias: float
    lang: np.ndarray
    lang_bias: np.ndarray
    langs: list[str]
    thresholds: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """The embeddings' rows of hashes, 0 for those without."""
        row = self.slots[(hashes & U64(SLOTS - 1)).astype(np.int64)]
        return np.where(self.keys[row] == hashes, row, 0)


def _laid_out(rows: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of words with empty words after each text, where these are, where segments begin, and where texts begin in the segments."""
    sizes = np.diff(bounds)
    padded = np.maximum(sizes, 1) + _PAD
    begins = np.concatenate(([0], np.cumsum(padded)))
    out = np.zeros((begins[-1], rows.shape[1]), dtype=np.int32)
    out[np.repeat(begins[:-1] - bounds[:-1], sizes) + np.arange(len(rows))] = rows
    segments = -(-np.maximum(sizes, 1) // SEGMENT)
    first = np.concatenate(([0], np.cumsum(segments)))
    number = np.arange(first[-1]) - np.repeat(first[:-1], segments)
    empty = (begins[1:, None] - np.arange(_PAD, 0, -1)).ravel()
    return out, empty, np.repeat(begins[:-1], segments) + number * SEGMENT, first


def _vectors(model: Model, rows: np.ndarray) -> np.ndarray:
    """The sum of the embeddings of each word."""
    out = model.embedding.take(rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        some = np.flatnonzero(rows[:, k])
        out[some] += model.embedding.take(rows[some, k], axis=0)
    return out


def _convolved(model: Model, vectors: np.ndarray) -> np.ndarray:
    """Outputs of all filters at every word but the last _PAD."""
    n = len(vectors) - _PAD
    # all words by all words of all filters at once, then each shifted to where its filter begins
    out = vectors[:n] @ np.concatenate([x[0] for x in model.filters], axis=1)
    for j in range(1, _PAD + 1):
        wide = [k for k, w in enumerate(WIDTHS) if w > j]
        out[:, wide[0] * FILTERS :] += vectors[j : n + j] @ np.concatenate([model.filters[k][j] for k in wide], axis=1)
    out += model.bias
    return np.maximum(out, 0, out=out)


def _pooled(model: Model, rows: np.ndarray, empty: np.ndarray, begins: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Greatest and mean maxima of every filter for each text."""
    most = np.empty((len(begins), FILTERS * len(WIDTHS)), dtype=np.float32)
    at = 0
    while at < len(begins):
        stop = max(at + 1, int(np.searchsorted(begins, begins[at] + _WORDS)))
        low, high = int(begins[at]), int(begins[stop]) if stop < len(begins) else len(rows) - _PAD
        vectors = _vectors(model, rows[low : high + _PAD])
        out = _convolved(model, vectors)
        out[empty[np.searchsorted(empty, low) : np.searchsorted(empty, high)] - low] = 0  # no filter begins there
        most[at:stop] = np.maximum.reduceat(out, begins[at:stop] - low)
        at = stop
    whole = np.maximum.reduceat(most, first[:-1])
    mean = np.add.reduceat(most, first[:-1]) / np.diff(first)[:, None]
    return np.concatenate([whole, mean], axis=1)


def _outputs(model: Model, rows: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The log-odds of toxicity and the number of the likeliest language of each text, given as rows of embeddings."""
    if len(bounds) == 1:
        return np.zeros(0), np.zeros(0, dtype=np.int64)
    pooled = _pooled(model, *_laid_out(rows, bounds))
    odds = (pooled @ model.toxic + model.toxic_bias).astype(np.float64)
    return odds, (pooled @ model.lang + model.lang_bias).argmax(axis=1)


def _seen(hashes: np.ndarray, bounds: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All hashes, in how many texts each is, and in how many toxic ones."""
    owner = np.repeat(np.arange(len(toxic)), np.diff(bounds) * hashes.shape[1])
    flat = hashes.ravel()
    order = np.lexsort((owner, flat))
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1]))) & (flat != 0) if len(flat) else np.zeros(0, dtype=bool)
    keys, at, times = np.unique(flat[new], return_inverse=True, return_counts=True)
    return keys, times, np.bincount(at, weights=toxic[owner[new]], minlength=len(keys)).astype(np.int64)


def _shift(times: np.ndarray, with_toxic: np.ndarray, base: float) -> np.ndarray:
    """The shift of the log-odds that each hash makes, where ``base`` of all texts are toxic."""
    base = min(max(base, 0.01), 0.99)
    p = (with_toxic + PRIOR * base) / (times + PRIOR)
    return np.log(p / (1 - p)) - np.log(base / (1 - base))


def _new_model(keys: np.ndarray, shift: np.ndarray, langs: list[str], rng: np.random.Generator) -> Model:
    keys = np.concatenate((np.zeros(1, dtype=U64), keys))
    slots = np.zeros(SLOTS, dtype=np.int32)
    order = np.argsort(np.concatenate(([0.0], np.abs(shift))), kind="stable")
    slots[(keys[order] & U64(SLOTS - 1)).astype(np.int64)] = order  # of hashes in one slot the most telling is found
    slots[0] = slots[0] if keys[slots[0]] & U64(SLOTS - 1) == 0 else 0
    embedding = rng.normal(0, NOISE, (len(keys), DIM)).astype(np.float32)
    embedding[1:, 0] = np.clip(shift / 4, -1, 1)
    embedding[0] = 0
    filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for k, x in enumerate(filters):
        x[:, 0, : FILTERS // 2] = 1.0 / WIDTHS[k]  # half of them look for what tells
    pooled = 2 * FILTERS * len(WIDTHS)
    return Model(keys, slots, embedding, filters, np.zeros(FILTERS * len(WIDTHS), dtype=np.float32), rng.normal(0, 0.1, pooled).astype(np.float32), 0.0, rng.normal(0, 0.1, (pooled, max(1, len(langs)))).astype(np.float32), np.zeros(max(1, len(langs)), dtype=np.float32), langs)


class _Adagrad:
    def __init__(self, parameters: list[np.ndarray], seen: list[np.ndarray]) -> None:
        self.parameters, self.seen = parameters, seen

    def step(self, gradients: list[np.ndarray]) -> None:
        for x, seen, g in zip(self.parameters, self.seen, gradients, strict=True):
            seen += g * g
            x -= RATE * g / np.sqrt(seen)

    def step_rows(self, number: int, rows: np.ndarray, g: np.ndarray) -> None:
        x, seen = self.parameters[number], self.seen[number]
        seen[rows] += g * g
        x[rows] -= RATE * g / np.sqrt(seen[rows])


def _parameters(model: Model) -> list[np.ndarray]:
    return [model.embedding, *model.filters, model.bias, model.toxic, np.array([model.toxic_bias], dtype=np.float32), model.lang, model.lang_bias]


def _flat(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([x.ravel() for x in parts])


def _split(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    ends = np.cumsum([x.size for x in like])
    return [flat[e - x.size : e].reshape(x.shape).copy() for e, x in zip(ends, like, strict=True)]


def _with(model: Model, parameters: list[np.ndarray]) -> Model:
    """The model with other parameters."""
    embedding, *filters, bias, toxic, toxic_bias, lang, lang_bias = parameters
    return replace(model, embedding=embedding, filters=filters, bias=bias, toxic=toxic, toxic_bias=float(toxic_bias[0]), lang=lang, lang_bias=lang_bias)


def _train(model: Model, seen: list[np.ndarray], rows: np.ndarray, bounds: np.ndarray, toxic: np.ndarray, lang: np.ndarray, weight: np.ndarray, rng: np.random.Generator, epochs: int) -> list[np.ndarray]:
    """The parameters after gradient descent on the loss of both outputs, over whole texts; the model's own and ``seen``, the squares so far, change in place."""
    parameters = _parameters(model)
    bias = parameters[-3]
    ada = _Adagrad(parameters, seen)
    n_filters = FILTERS * len(WIDTHS)
    for _ in range(epochs):
        order = rng.permutation(len(toxic))
        for low in range(0, len(order), BATCH):
            docs = order[low : low + BATCH]
            own = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs]) if len(docs) else np.zeros(0, dtype=np.int64)
            sizes = np.diff(bounds)[docs]
            some = rows[own] * (rng.random(len(own)) >= DROP)[:, None]
            held, empty, begins, first = _laid_out(some, np.concatenate(([0], np.cumsum(sizes))))
            vectors = _vectors(model, held)
            out = _convolved(model, vectors)
            out[empty[empty < len(out)]] = 0
            most = np.maximum.reduceat(out, begins)
            # the first place of each maximum
            length = np.diff(np.append(begins, len(out)))
            is_most = out == np.repeat(most, length, axis=0)
            place = np.where(is_most, np.arange(len(out))[:, None], len(out))
            place = np.minimum.reduceat(place, begins)
            whole = np.maximum.reduceat(most, first[:-1])
            segments = np.diff(first)
            mean = np.add.reduceat(most, first[:-1]) / segments[:, None]
            pooled = np.concatenate([whole, mean], axis=1)
            z = pooled @ model.toxic + bias[0]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            d_z = ((p - toxic[docs]) * weight[docs] / len(docs)).astype(np.float32)
            y = pooled @ model.lang + model.lang_bias
            y = np.exp(y - y.max(axis=1, keepdims=True))
            y /= y.sum(axis=1, keepdims=True)
            known = lang[docs] >= 0
            y[np.flatnonzero(known), lang[docs][known]] -= 1
            y[~known] = 0
            y *= 0.3 / len(docs)
            d_pooled = d_z[:, None] * model.toxic + y @ model.lang.T
            share = np.repeat(d_pooled[:, n_filters:] / segments[:, None], segments, axis=0)
            top = most == np.repeat(whole, segments, axis=0)
            share += top * np.repeat(d_pooled[:, :n_filters] / np.maximum(np.add.reduceat(top, first[:-1]), 1), segments, axis=0)
            share *= most > 0
            seg, f = np.nonzero(share)
            g, at = share[seg, f].astype(np.float32), place[seg, f]
            d_bias = np.bincount(f, weights=g, minlength=n_filters).astype(np.float32)
            d_filters, where, d_vectors = [], [], []
            for k, filters in enumerate(model.filters):
                mine = (f >= k * FILTERS) & (f < (k + 1) * FILTERS)
                column, g_k, at_k = f[mine] - k * FILTERS, g[mine], at[mine]
                d = np.zeros_like(filters)
                for j in range(len(filters)):
                    hot = np.zeros((FILTERS, len(g_k)), dtype=np.float32)
                    hot[column, np.arange(len(g_k))] = g_k
                    d[j] = (hot @ vectors[at_k + j]).T
                    where.append(held[at_k + j])
                    d_vectors.append(g_k[:, None] * filters[j].T[column])
                d_filters.append(d + RIDGE * filters)
            at, change = np.concatenate(where), np.concatenate(d_vectors)
            used, back = np.unique(at, return_inverse=True)
            back = back.reshape(at.shape)
            d_rows = np.stack([np.bincount(back.ravel(), weights=np.repeat(change[:, c], at.shape[1]), minlength=len(used)) for c in range(DIM)], axis=1).astype(np.float32)
            d_rows[used == 0] = 0
            ada.step_rows(0, used, d_rows + RIDGE * model.embedding[used])
            model.embedding[0] = 0
            rest = ada.parameters[1:]
            gradients = [*d_filters, d_bias, pooled.T @ d_z + RIDGE * model.toxic, d_z.sum(keepdims=True), pooled.T @ y + RIDGE * model.lang, y.sum(axis=0)]
            for k, (x, grad) in enumerate(zip(rest, gradients, strict=True), 1):
                ada.seen[k] += grad * grad
                x -= (RATE / 2 * grad / np.sqrt(ada.seen[k])).astype(np.float32)
    return parameters


def best_threshold(odds: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the widest gap of log-odds at which the weighted errors are fewest."""
    order = np.argsort(odds, kind="stable")
    odds, toxic, weight = odds[order], toxic[order], weight[order]
    below = np.concatenate(([0.0], np.cumsum(weight * toxic)))  # toxic ones missed with so many below
    above = np.concatenate(([0.0], np.cumsum(weight * (1 - toxic))))
    errors = below + (above[-1] - above)
    edge = np.concatenate(([odds[0] - 2], odds, [odds[-1] + 2]))
    errors[np.diff(edge) <= 0] = np.inf  # equal odds aren't parted
    gap = np.where(errors <= errors.min() + 1e-9, np.diff(edge), -1.0)
    k = int(gap.argmax())
    return float((edge[k] + edge[k + 1]) / 2)


def _thresholds(counts: list[tuple[bool, int, int, int, int]], names: list[str]) -> dict[str, float]:
    """The common threshold and those of languages, from (check, language read, log-odds in parts of FINE, documents, toxic ones); of documents not in the check if that has no toxic one."""
    checked = [x for x in counts if x[0]]
    held = checked if any(x[4] for x in checked) else counts

    def best(rows: list[tuple[bool, int, int, int, int]]) -> float:
        odds = np.array([x[2] for x in rows] * 2) / FINE
        toxic, n = np.array([x[4] for x in rows], dtype=float), np.array([x[3] for x in rows], dtype=float)
        return best_threshold(odds, np.repeat([1.0, 0.0], len(rows)), np.concatenate((toxic, n - toxic)))

    out = {"": best(held)} if held else {}
    for k, name in enumerate(names):
        of = [x for x in held if x[1] == k]
        toxic = sum(x[4] for x in of)
        if OWN <= toxic < sum(x[3] for x in of):
            out[name] = best(of)
    return out


def _word_table(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes that SEEN of the documents have (at most KEYS, those in most documents), ascending, in how many each is, and in how many toxic ones."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, times, with_toxic = _seen(*word_features(texts_of(batch)), batch.column("toxic").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times.astype(np.int64)), pa.array(with_toxic)], ["hash", "times", "toxic"])

    counted = arrow_map(labelled.select("text", "toxic"), count, "hash long, times long, toxic long").groupBy("hash").agg(F.sum("times").alias("times"), F.sum("toxic").alias("toxic"))
    counted = stash(counted.where(F.col("times") >= SEEN), "words")
    least, total = SEEN, 0
    for times, n in sorted(counted.groupBy(F.least("times", F.lit(1 << 20))).count().collect(), reverse=True):
        total += n
        if total > KEYS:
            least = times + 1
            break
    rows = counted.where(F.col("times") >= least).toArrow()
    keys = rows.column("hash").to_numpy().view(U64)
    order = np.argsort(keys)
    return keys[order], rows.column("times").to_numpy()[order], rows.column("toxic").to_numpy()[order]


_ENCODED = "shard long, rows binary, sizes binary, toxic binary, lang binary, check binary"


def _encoded(labelled: DataFrame, model: Model) -> DataFrame:
    """A row for each shard: the rows of the embeddings of all its words, how many words each text has, and what the labels say."""
    number = {x: k for k, x in enumerate(model.langs)}
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by([(x, "ascending") for x in ("key", "text", "lang")])
        hashes, bounds = word_features([x or "" for x in group.column("text").to_pylist()])
        lang = np.array([number.get(x, -1) for x in group.column("lang").to_pylist()], dtype=np.int64)
        parts = [shared.value.rows(hashes).astype(np.int32), np.diff(bounds).astype(np.int64), group.column("toxic").to_numpy().astype(np.int64), lang, group.column("check").to_numpy().astype(np.int64)]
        return pa.table([pa.array([key[0].as_py()], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["shard", "rows", "sizes", "toxic", "lang", "check"])

    return stash(labelled.groupBy("shard").applyInArrow(run, _ENCODED), "encoded", LONG_ROWS)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(shard, rows, bounds, toxic, lang, check) of every row of ``_encoded``."""
    for batch in batches:
        for x in zip(*batch.columns, strict=True):
            shard, rows, sizes, toxic, lang, check = (y.as_py() for y in x)
            sizes, toxic, lang, check = (np.frombuffer(y, np.int64) for y in (sizes, toxic, lang, check))
            yield shard, np.frombuffer(rows, np.int32).reshape(-1, 1 + len(STEMS)), np.concatenate(([0], np.cumsum(sizes))), toxic, lang, check > 0


def _round(encoded: DataFrame, model: Model, flat: np.ndarray, balance: tuple[float, float], epochs: int, number: int) -> np.ndarray:
    """All parameters, and the squares of their gradients, after every shard has been trained on; each moves by the mean of the shards that moved it."""
    bare = replace(model, keys=model.keys[:0], slots=model.slots[:0])
    shared = encoded.sparkSession.sparkContext.broadcast((bare, flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bare, flat = shared.value
        like = _parameters(bare)
        half = len(flat) // 2
        total, moved = np.zeros(len(flat)), np.zeros(half, dtype=np.int32)
        for shard, rows, bounds, toxic, lang, check in _shards(batches):
            fit = np.flatnonzero(~check)
            own = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in fit]) if len(fit) else np.zeros(0, dtype=np.int64)
            both = _split(flat, like + like)
            start, seen = _with(bare, both[: len(like)]), both[len(like) :]
            y = toxic[fit].astype(np.float64)
            new = _train(start, seen, rows[own], np.concatenate(([0], np.cumsum(np.diff(bounds)[fit]))), y, lang[fit], np.where(y > 0, *balance), np.random.default_rng([13, number, shard]), epochs)
            change = _flat(new + seen) - flat
            total += change
            moved += change[half:] != 0  # squares grow wherever there is a gradient
        for at in range(0, half, CHUNK):
            if moved[at : at + CHUNK].any():
                parts = (total[:half].astype(np.float32), total[half:].astype(np.float32), moved)
                yield pa.RecordBatch.from_arrays([pa.array([at]), *(pa.array([x[at : at + CHUNK].tobytes()], pa.binary()) for x in parts)], ["at", "total", "squares", "moved"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares, moved = 0.0, 0.0, 0
        for batch in batches:
            for a, b, c in zip(batch.column("total"), batch.column("squares"), batch.column("moved"), strict=True):
                total, squares, moved = total + np.frombuffer(a.as_py(), np.float32).astype(np.float64), squares + np.frombuffer(b.as_py(), np.float32).astype(np.float64), moved + np.frombuffer(c.as_py(), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), *(pa.array([(x / np.maximum(moved, 1)).astype(np.float32).tobytes()], pa.binary()) for x in (total, squares))], ["at", "change", "squares"])

    # each task sends all parameters, so there are not more of them than cores
    few = encoded.coalesce(encoded.sparkSession.sparkContext.defaultParallelism)
    out = flat.copy()
    with small_batches(encoded.sparkSession):
        for at, *both in few.mapInArrow(run, "at long, total binary, squares binary, moved binary").groupBy("at").applyInArrow(add, "at long, change binary, squares binary").collect():
            for low, change in zip((at, at + len(flat) // 2), (np.frombuffer(bytes(x), np.float32) for x in both), strict=True):
                out[low : low + len(change)] += change
    shared.destroy()
    return out


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", lang: str = "lang") -> Model | None:
    """A model from all labelled documents, a quarter of them kept for the thresholds; None if nothing is labelled.

    Shards of about SHARD documents are trained on by tasks, and averaged ROUNDS
    times. The driver receives the words that have embeddings, the averaged
    parameters, and the documents counted by language and log-odds; all three are
    bounded whatever the number of documents.
    """
    rated = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max((F.col(label) > 0).cast("int")).alias("toxic"))
    n = rated.count()
    if not n:
        return None
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = texts.join(F.broadcast(rated) if n <= SENT else rated, "key").distinct()
    labelled = stash(rows.withColumn("check", (F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(4)) == 0).cast("int")), "labelled")
    fit = F.col("check") == 0
    n, chars, fitted, toxic = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count_if(fit), F.count_if(fit & (F.col("toxic") == 1))).first()
    if not n:
        return None
    shards = max(1, round(n / SHARD), -(-chars // SHARD_CHARS))
    labelled = labelled.withColumn("shard", F.pmod(F.xxhash64(F.lit(2), "key"), F.lit(shards)))
    names = sorted(x for (x,) in labelled.select("lang").distinct().collect() if x is not None)
    keys, times, with_toxic = _word_table(labelled.where(fit))
    model = _new_model(keys, _shift(times, with_toxic, toxic / fitted if fitted else 0.5), names, np.random.default_rng(13))
    encoded = _encoded(labelled, model)
    # both classes weigh the same
    balance = fitted / 2 / max(1, toxic), fitted / 2 / max(1, fitted - toxic)
    epochs = -(-max(EPOCHS, -(-STEPS * BATCH * shards // max(1, fitted))) // ROUNDS)
    like = _parameters(model)
    flat = _flat([*like, *(np.full_like(x, 1e-3) for x in like)])
    for number in range(ROUNDS):
        flat = _round(encoded, model, flat, balance, epochs, number)
    model = _with(model, _split(flat[: len(flat) // 2], like))
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, keys=model.keys[:0], slots=model.slots[:0]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, bounds, toxic, _, check in _shards(batches):
            odds, langs = _outputs(shared.value, rows, bounds)
            fine = np.round(np.clip(odds, -30, 30) * FINE).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (check, langs.astype(np.int64), fine, toxic)], ["check", "read", "odds", "toxic"])

    counted = encoded.mapInArrow(read, "check boolean, read long, odds long, toxic long").groupBy("check", "read", "odds").agg(F.count(F.lit(1)), F.sum("toxic"))
    with small_batches(docs.sparkSession):
        model.thresholds = _thresholds(sorted(map(tuple, counted.collect())), names)
    return model


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with lang_read, score (0 to 1) and predicted (1 from THRESHOLD on).

    Defined results: null, empty and wordless texts have the score of the bare
    biases; without a model (nothing was labelled) all scores are 0 and
    lang_read is null; repeated rows get equal results; null keys are kept; an
    empty table gives no rows; texts are read whole; further columns are ignored.
    """
    inner = free_name(docs, "_text")
    schema = StructType([*(docs.schema[x] for x in keep), StructField("lang_read", StringType()), StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [*keep, "lang_read", "score", "predicted"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = shared.value
        if held is None:
            n = batch.num_rows
            return pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), pa.nulls(n, pa.string()), pa.array(np.zeros(n)), pa.array(np.zeros(n, dtype=np.int32))], names)
        hashes, bounds = word_features(texts_of(batch, inner))
        odds, read = _outputs(held, held.rows(hashes), bounds)
        langs = [held.langs[k] if held.langs else None for k in read]
        common = held.thresholds.get("", 0.0)
        shift = np.array([held.thresholds.get(x, common) for x in langs])
        at = np.log(THRESHOLD / (1 - THRESHOLD))
        p = np.round(1 / (1 + np.exp(-np.clip(odds - shift + at, -30, 30))), 6)
        return pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), pa.array(langs, pa.string()), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], names)

    return arrow_map(docs.select(*map(quoted, keep), F.col(quoted(text)).alias(inner)), run, schema)


def held_out() -> Column:
    """The third of documents whose labels the model never sees."""
    return F.coalesce(F.pmod(utf8_crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every whole document, learnt from the labels that aren't held out."""
    docs = spread(table(spark, sf_dir, "documents"))
    model = learn(docs.where(~held_out()), table(spark, sf_dir, "labels").where(~held_out()))
    return score(docs.withColumn("held_out", held_out()), model, keep=("doc_id", "held_out")).select("doc_id", "held_out", "score", "predicted", "lang_read")
