"""Quality classification by ordinal cumulative-link regression.

Ratings have an order, so one linear score with shared weights over hashed text
features is cut by ordered thresholds: P(grade <= k) = sigmoid(threshold_k - score).
The expected grade and the probability of the upper grades select documents.

Features are the distinct words of the whole text and their stems (first
letters), hashed, and the shares of capitals, of each punctuation mark and of
repeated stems, hashed too. A feature is scaled by how much its presence shifts
the odds of the upper grades, so a rare word that tells counts for more than
frequent ones that don't, however long the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, slices, spread, table, texts_of, utf8_crc32
from .textvec import PIECE, code_points, lower_and_kind, mix, owners, words

#: Hashed features (a power of two).
FEATURES = 1 << 18
#: Rated documents that the regression is fitted to, about.
SAMPLE = 8000
#: Grades of the standard labels: 0 toxic, 1 poor, 2 good.
GRADES = 3
#: Documents are kept if P(highest grade) is at least this.
KEEP = 0.5
STEPS, RATE, MOMENTUM, RIDGE = 300, 60.0, 0.9, 1e-5
#: A feature counts if so many documents of the sample have it.
SEEN = 3
#: Least scale of a feature, in log-odds.
LEAST_SCALE = 0.5
#: First letters of a word that are a feature too.
STEM = 5
#: Weight of a share of characters against a word.
_MARK = 1.0


def _marks(text: str, out: dict[int, int]) -> int:
    """Counts of capitals (key 0), digits (1) and marks (their code point) of a text; returns its length without white space."""
    total = 0
    for at in range(0, len(text), PIECE):
        points = code_points(text[at : at + PIECE])
        lower, word = lower_and_kind(points)
        other = points[~word]
        seen = other[other > 32]
        total += int(word.sum()) + len(seen)
        for key, n in ((0, int((lower != points).sum())), (1, int(((points >= 48) & (points <= 57)).sum()))):
            if n:
                out[key] = out.get(key, 0) + n
        found, counts = np.unique(seen, return_counts=True)
        for key, n in zip(found.tolist(), counts.tolist(), strict=True):
            out[key] = out.get(key, 0) + n
    return total


def features(texts: list[str], size: int = FEATURES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (row, feature, value): distinct words and stems over the root of their number, and roots of shares."""
    rows_, features_, values = [], [], []
    for prefix_of in (0, STEM):
        hashes, bounds = words(texts, prefix_of)
        key = np.unique(owners(bounds) * size + (mix(hashes + np.uint64(prefix_of)) % np.uint64(size)).astype(np.int64))
        row = key // size
        n = np.bincount(row, minlength=len(texts))
        rows_.append(row)
        features_.append(key % size)
        values.append((1.0 / np.sqrt(np.maximum(n, 1)))[row])
    spread = n / np.maximum(np.diff(bounds), 1)  # few different words: repetition
    rows, marks, shares = [], [], []
    for k, text in enumerate(texts):
        found: dict[int, int] = {}
        total = _marks(text, found)
        for mark, count in found.items():
            rows.append(k)
            marks.append(mark)
            shares.append(count / total)
        if total:
            rows.append(k)
            marks.append(2)
            shares.append(1 - min(1.0, float(spread[k])))
    hashed = (mix(np.array(marks, dtype=np.uint64) + np.uint64(0xABCDEF << 24)) % np.uint64(size)).astype(np.int64)
    value = _MARK * np.sqrt(np.array(shares, dtype=np.float64))
    return np.concatenate([*rows_, np.array(rows, dtype=np.int64)]), np.concatenate([*features_, hashed]), np.concatenate([*values, value])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def tails(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1 .. number of thresholds, a column each."""
    return _sigmoid(score[:, None] - thresholds[None, :])


def scales(at: np.ndarray, row: np.ndarray, grade: np.ndarray, grades: int, size: int) -> np.ndarray:
    """For each feature the largest shift, over the cuts between grades, of the log-odds of being above by its presence; at least LEAST_SCALE."""
    count = np.zeros((grades, size))
    np.add.at(count, (grade[row], at), 1.0)
    total = np.bincount(grade, minlength=grades)
    out = np.full(size, LEAST_SCALE)
    for k in range(1, grades):
        above, below = ((count[x].sum(axis=0) + 0.5) / (total[x].sum() + 1.0) for x in (slice(k, None), slice(k)))
        out = np.maximum(out, np.abs(np.log(above / below)))
    return out


def likelihood(score: np.ndarray, free: np.ndarray, grade: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The mean negative log-likelihood, its slope by each row's score (times the rows) and by ``free``: the first threshold and the logarithms of the gaps."""
    n, grades = len(grade), len(free) + 1
    thresholds = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
    edge = np.concatenate([[-np.inf], thresholds, [np.inf]])
    high, low = _sigmoid(edge[grade + 1] - score), _sigmoid(edge[grade] - score)
    high[grade == grades - 1], low[grade == 0] = 1.0, 0.0
    p = np.maximum(high - low, 1e-12)
    d_high, d_low = high * (1 - high), low * (1 - low)
    by_threshold = np.array([(-(d_high / p)[grade == k].sum() + (d_low / p)[grade == k + 1].sum()) / n for k in range(grades - 1)])
    by_free = np.array([by_threshold.sum(), *(by_threshold[k:].sum() * np.exp(free[k]) for k in range(1, grades - 1))])
    return float(-np.log(p).mean()), (d_high - d_low) / p, by_free


def fit(row: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int = GRADES, size: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of maximum likelihood, by gradient descent with momentum over all rows at once, with shorter steps where the loss grows."""
    _, at, times = np.unique(feature, return_inverse=True, return_counts=True)
    often = (times >= SEEN)[at]
    row, value = row[often], value[often]
    used, at = np.unique(feature[often], return_inverse=True)
    n = len(grade)
    scale = scales(at, row, grade, grades, len(used))
    value = value * scale[at]
    weight = np.zeros(len(used))
    at_least = np.array([(grade >= k).mean() if n else 0.5 for k in range(1, grades)])
    start = -np.log(np.clip(at_least, 0.01, 0.99) / (1 - np.clip(at_least, 0.01, 0.99)))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])  # gaps stay positive
    speed, free_speed = np.zeros(len(used)), np.zeros(grades - 1)
    rate, best, kept = RATE, np.inf, (weight, free)
    for _ in range(STEPS if n else 0):
        score = np.bincount(row, weights=value * weight[at], minlength=n)
        loss, slope, by_free = likelihood(score, free, grade)
        loss += RIDGE / 2 * (weight**2).sum()
        if loss > 1.02 * best + 1e-3:  # a step too far: back, and shorter ones from there
            rate /= 2
            weight, free = kept[0].copy(), kept[1].copy()
            speed[:], free_speed[:], best = 0, 0, np.inf
            continue
        if loss < best:
            best, kept = loss, (weight.copy(), free.copy())
        gradient = np.bincount(at, weights=value * slope[row], minlength=len(used)) / n + RIDGE * weight
        speed = MOMENTUM * speed - rate * gradient
        free_speed = MOMENTUM * free_speed - min(0.5, rate) * by_free
        weight += speed
        free += free_speed
    weight, free = kept
    out = np.zeros(size, dtype=np.float32)
    out[used] = weight * scale
    return out, free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def learn(rated: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "grade", grades: int = GRADES, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds from about ``sample`` rated documents, chosen by a hash of key and text; equal rows count once.

    One task fits the model to the sample; the driver receives the weights,
    which have a fixed size.
    """
    rows = rated.where(F.col(grade).isNotNull())
    n = rows.count()
    share = min(1.0, sample / n) if n else 1.0
    chosen = rows.where((F.xxhash64(key, text).bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31)) < share).select(F.col(text).alias("text"), F.col(grade).cast("long").alias("grade"), F.col(key).alias("key")).distinct()

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, seen = [], 0
        for batch in slices(batches):
            row, feature, value = features(texts_of(batch))
            parts.append((row + seen, feature, value, batch.column("grade").to_numpy(zero_copy_only=False)))
            seen += batch.num_rows
        if not parts:
            return
        weight, thresholds = fit(*(np.concatenate(x) for x in zip(*parts, strict=True)), grades=grades)
        yield pa.RecordBatch.from_arrays([pa.array([weight.tobytes()], pa.binary()), pa.array([thresholds.tolist()], pa.list_(pa.float64()))], ["weights", "thresholds"])

    fitted = chosen.repartition(1).sortWithinPartitions("key", "text", "grade").mapInArrow(train, "weights binary, thresholds array<double>").collect()
    if not fitted:
        return np.zeros(FEATURES, dtype=np.float32), np.arange(grades - 1, dtype=np.float64)
    return np.frombuffer(bytes(fitted[0][0]), dtype=np.float32), np.array(fitted[0][1])


def some_rated(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", grade: str = "grade", sample: int = SAMPLE) -> DataFrame:
    """(key, text, grade) of about ``sample`` rated documents, chosen by a hash of the key.

    The keys are chosen among the ratings, before any text is read, so the
    documents meet a table of bounded size, which is sent to every executor.
    """
    rows = ratings.where(F.col(grade).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(grade).alias(grade))
    n = rows.count()
    share = min(1.0, sample / n) if n else 1.0
    chosen = rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) / float(1 << 30) < share)
    return docs.select(key, "text").join(F.broadcast(chosen), key)


def score(docs: DataFrame, weights: np.ndarray, thresholds: np.ndarray, key: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """Per document: doc_id, expected_grade, p_poor (lowest grade), p_good (highest grade), keep.

    Defined results: null and empty texts have no features, so they get the
    model's bare thresholds; if nothing was rated all scores are equal;
    repeated rows get equal results; null keys are kept; an empty table gives no
    rows; texts are read whole, and further columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast((weights, thresholds))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        weight, edges = held.value
        row, feature, value = features(texts_of(batch), len(weight))
        p = tails(np.bincount(row, weights=value * weight[feature], minlength=batch.num_rows), edges)
        good = np.round(p[:, -1], 6)
        columns = [pa.array(np.round(p.sum(axis=1), 6)), pa.array(np.round(1 - p[:, 0], 6)), pa.array(good), pa.array(good >= keep)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "expected_grade", "p_poor", "p_good", "keep"])

    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, expected_grade double, p_poor double, p_good double, keep boolean")


def grade_of(quality: Column, toxic: Column) -> Column:
    """The graded rating of the standard labels: 0 toxic, 1 poor, 2 good; null where a label is missing."""
    return F.when(toxic == 1, 0).when((toxic == 0) & (quality == 0), 1).when((toxic == 0) & (quality == 1), 2)


def held_out() -> Column:
    """A quarter of the documents that the fit doesn't see."""
    return F.coalesce(F.pmod(utf8_crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def op8_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every whole document, fitted to the ratings in ``labels``."""
    docs = spread(table(spark, sf_dir, "documents"))
    ratings = table(spark, sf_dir, "labels").select("doc_id", grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    weights, thresholds = learn(some_rated(docs.where(~held_out()), ratings.where(~held_out())), sample=2 * SAMPLE)
    return score(docs, weights, thresholds)
