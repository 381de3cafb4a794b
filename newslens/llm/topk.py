"""Exact top-k inner-product search by Fagin's threshold algorithm.

Vectors become integers, floor(1024 * x), so scores are exact. The candidates
of a task are held in blocks with one sorted list for each axis; the axes are
the principal ones of a bounded sample, so that a few lists carry most of a
score, and a block holds vectors that lie near each other. For a query the lists are read from the end that its sign favours; every
vector met is scored in full, and reading stops as soon as the best that an
unread vector could reach is below the k-th result so far. That bound takes the
next value of every list and the longest vector of the block. How deep each list
is read is planned: the depths with the fewest entries that bring the bound
below the k-th result; where no depths do so for fewer entries than the block
has, one list is read to its end. The k-th result starts from that of the
sample, results carry over from block to block, and the block whose vectors could
reach most comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import ship
from .common import arrow_map, spread, stash, table

SCALE = 1024.0
TOP = 10
#: Queries sent to the executors at a time; the candidates are read once for each such block.
QUERY_BLOCK = 16384
#: Vectors that share sorted lists at most, and components that a task holds at a time, or are sent with a block of queries.
LISTS, CELLS = 2048, 1 << 22
#: Least depth to which a list is read; the planned depths are this and its doubles.
DEPTH = 16
#: Vectors, about, that axes and first bounds come from.
SAMPLE = 4096
#: Multipliers of the length bound that are tried, and prices of an entry read.
_LENGTHS = np.array([1.0, 1.05, 1.15, 1.3, 1.7, 2.5, 5.0, 1e9])
_PRICES = 2.0 ** np.arange(4, -13, -1)


def to_ints(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Integer matrix, short vectors filled up with 0, and which rows are complete and finite."""
    lists = vectors.cast(pa.large_list(pa.float64()))
    offsets, flat = lists.offsets.to_numpy(), lists.values
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    if flat.null_count:
        values = np.where(flat.is_null().to_numpy(zero_copy_only=False), np.nan, values)
    n, length = len(lists), np.diff(offsets)
    length = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, length)
    out = np.zeros((n, int(length.max(initial=0))))
    for k in range(out.shape[1]):
        has = length > k
        out[has, k] = values[offsets[:-1][has] + k]
    good = np.isfinite(out).all(axis=1) & ~lists.is_null().to_numpy(zero_copy_only=False)
    scaled = np.floor(SCALE * np.where(good[:, None], out, 0.0))
    return np.clip(scaled, -(2.0**62), 2.0**62).astype(np.int64), good


def _dot(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer products, by floating point where that is exact; sums beyond 64 bits are held at its ends."""
    size = float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, len(query))
    if size < 2.0**53:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if size < 2.0**62:
        return rows @ query
    exact = rows.astype(object) @ query.astype(object)
    return np.array([max(-(2**63), min(2**63 - 1, int(x))) for x in exact], dtype=np.int64)


def axes_of(rows: np.ndarray) -> np.ndarray:
    """The principal axes of integer vectors, as columns."""
    if not len(rows):
        return np.eye(rows.shape[1])
    values = rows.astype(np.float64)
    centred = (values - values.mean(axis=0)) / max(1.0, np.abs(values).max())
    return np.linalg.eigh(centred.T @ centred)[1]


def widened(axes: np.ndarray, width: int) -> np.ndarray:
    """The axes for vectors that are longer than those of the sample."""
    more = max(0, width - len(axes))
    return np.block([[axes, np.zeros((len(axes), more))], [np.zeros((more, len(axes))), np.eye(more)]])


def _most(w: np.ndarray, edge: np.ndarray, length: np.ndarray | float) -> np.ndarray:
    """The largest w * u - u * u / (2 * length) over u up to the edge."""
    return np.where(edge >= length * w, length * w * w / 2, w * edge - edge * edge / (2 * length))


class Block:
    """Candidate vectors with their sorted lists, ascending, one for each axis."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, axes: np.ndarray | None = None) -> None:
        n, width = rows.shape
        self.ids, self.rows = ids, rows
        self.axes = np.eye(width) if axes is None else axes
        values = rows.astype(np.float64)
        #: Rows as floating point, if all products with integers up to ``exact`` are exact.
        self.values, self.exact = values, 2.0**53 / max(1.0, np.abs(values).max(initial=0.0)) / max(1, width)
        self.mean = values.mean(axis=0)
        turned = (values - self.mean) @ self.axes
        self.order = np.argsort(turned, axis=0, kind="stable")
        self.length = float(np.sqrt((turned**2).sum(axis=1).max(initial=0.0)))
        self.depths = np.array([0, *(DEPTH << k for k in range(63) if DEPTH << k < n)], dtype=np.int64)
        # the next value of each list, from either end, when so many have been read
        ahead = np.take_along_axis(turned, self.order, axis=0)
        self.high, self.low = ahead[n - 1 - self.depths].T, ahead[self.depths].T
        self.read = self.offered = 0

    def scores(self, which: np.ndarray, query: np.ndarray) -> np.ndarray:
        if float(np.abs(query).max(initial=0)) > self.exact:
            return _dot(self.rows[which], query)
        if 2 * len(which) > len(self.rows):
            return (self.values @ query.astype(np.float64)).astype(np.int64)[which]
        return (self.values[which] @ query.astype(np.float64)).astype(np.int64)

    def search(self, query_id: int, query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k best of (ids, scores) and of this block: scores descending, ties to smaller ids. query: as wide as the rows.

        ``least`` is a score that k candidates are known to have or exceed.
        """
        n, width = self.rows.shape
        turned = query.astype(np.float64) @ self.axes
        base, w, up = float(query.astype(np.float64) @ self.mean), np.abs(turned), turned > 0
        edges = np.where(up[:, None], self.high, -self.low)
        norm = float(np.sqrt((w**2).sum()))
        margin = 1.0 + 1e-7 * norm * (self.length + float(np.abs(self.mean).max(initial=0.0)))
        lengths = _LENGTHS * (self.length / norm if norm else 0.0)
        at, seen, every = np.zeros(width, dtype=np.int64), np.zeros(n, dtype=bool), False
        self.offered += n
        while not every:
            kth = max((int(scores[-1]) if len(scores) == k else None, least), key=lambda x: -(1 << 63) if x is None else x)
            if kth is None:
                depths = np.maximum(at, 1 if len(self.depths) > 1 and not at.any() else len(self.depths))
            else:
                depths = self._plan(w, edges, lengths, at, float(kth) - base - margin)
                if depths is not None and (depths == at).all():
                    return ids, scores  # equal scores may still have smaller ids, so the bound is below
            every = depths is None or int(depths.max(initial=0)) >= len(self.depths)
            if every:
                fresh = np.flatnonzero(~seen)
            else:
                mark = np.zeros(n, dtype=bool)
                for d in np.flatnonzero(depths > at):
                    begin, end = self.depths[at[d]], self.depths[depths[d]]
                    mark[self.order[n - end : n - begin, d] if up[d] else self.order[begin:end, d]] = True
                fresh = np.flatnonzero(mark & ~seen)
                at = depths
            seen[fresh] = True
            self.read += len(fresh)
            ids, scores = _best(query_id, np.concatenate([ids, self.ids[fresh]]), np.concatenate([scores, self.scores(fresh, query)]), k)
        return ids, scores

    def _plan(self, w: np.ndarray, edges: np.ndarray, lengths: np.ndarray, at: np.ndarray, under: float) -> np.ndarray | None:
        """Numbers of the depths, at least ``at``, that bring the bound below ``under`` with the fewest entries; None if one whole list has fewer.

        For every length > 0 the sum of _most and reach ** 2 / (2 * length) bounds the score of any
        unread vector whose values are up to the edges, whatever else is known of it.
        """
        if lengths[0] <= 0:  # all vectors of the block, or the query, are where the axes meet
            return None if under <= 0 else at
        # the deepest reading there is short of whole lists, for all lengths at once
        slack = under - self.length**2 / (2 * lengths)
        able = _most(w[:, None], edges[:, -1:], lengths[None, :]).sum(axis=0) < slack
        if not able.any():
            return None
        best, fewest = None, len(self.rows)
        held = np.arange(len(self.depths))[None, :] < at[:, None]
        done = int(self.depths[at].sum())
        rows = np.arange(len(w))
        for length, room in zip(lengths[able], slack[able], strict=True):
            most = np.where(held, np.inf, _most(w[:, None], edges, length))
            if most[rows, at].sum() < room:
                return at
            scale = max(1.0, float(np.abs(most[np.isfinite(most)]).max(initial=1.0))) / len(self.rows)
            taken = (most[None] + (_PRICES * scale)[:, None, None] * self.depths).argmin(axis=2)
            entries = self.depths[taken].sum(axis=1) - done
            good = (most[rows, taken].sum(axis=1) < room) & (entries < fewest)
            if good.any():
                pick = int(np.where(good, entries, np.iinfo(np.int64).max).argmin())
                best, fewest = taken[pick], int(entries[pick])
        return best


def blocks_of(ids: np.ndarray, rows: np.ndarray, axes: np.ndarray) -> list[Block]:
    """The vectors halved, by the axis along which they are spread most, until LISTS or fewer are together."""
    turned = rows.astype(np.float64) @ axes
    out, todo = [], [np.arange(len(rows))]
    while todo:
        which = todo.pop()
        if len(which) <= LISTS:
            out.append(Block(ids[which], rows[which], axes))
            continue
        order = np.argpartition(turned[which, turned[which].var(axis=0).argmax()], len(which) // 2)
        todo += [which[order[: len(which) // 2]], which[order[len(which) // 2 :]]]
    return out


def search_blocks(blocks: list[Block], query_id: int, query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The k best of (ids, scores) and of all blocks, as in Block.search."""
    value = query.astype(np.float64)
    norm = float(np.sqrt((value**2).sum()))
    reach = [float(x.mean @ value) + norm * x.length for x in blocks]
    for n in sorted(range(len(blocks)), key=lambda x: -reach[x]):
        ids, scores = blocks[n].search(query_id, query, ids, scores, k, least)
    return ids, scores


def _best(query_id: int, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    other = ids != query_id
    ids, scores = ids[other], scores[other]
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= edge
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -1 - scores))[:k]  # -1 - x turns the order round without overflow
    return ids[order], scores[order]


def search(vectors: DataFrame, asks: Column, k: int = TOP, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``asks`` holds, the k rows of highest inner product.

    A row's own id is no candidate for it; ties go to the smaller id.

    Defined results: vectors that are null or hold null or non-finite
    components take no part, nor do rows without id; if rows share an id, each is a
    candidate and the smallest vector asks; vectors of different length are
    filled up with zeros; with fewer than k candidates all are returned; an empty
    table gives no rows; further columns are ignored. Components beyond 2 ** 62 and
    scores beyond 64 bits are out of range: they count as the ends of the range.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), asks.alias("asks")).where("vec_id is not null and v is not null")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    known = rows.where(whole)
    sizes = known.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    if not sizes[1]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # axes and first bounds from rows chosen by a hash, the same on every run; equal rows count once, so that many copies of one don't come
    some = known.where(F.xxhash64("vec_id", "v").bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31) < min(1.0, SAMPLE / sizes[0])).select("vec_id", "v").distinct().toArrow()
    sample = to_ints(some.column("v").combine_chunks())[0]
    blocks = -(-sizes[1] // max(1, min(QUERY_BLOCK, CELLS // max(1, sample.shape[1]))))
    start = spark.sparkContext.broadcast((some.column("vec_id").to_numpy(), sample, axes_of(sample)))

    def first(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The k-th score of each query in the sample, null where it has fewer."""
        ids, sample, *_ = start.value
        ask, _ = to_ints(batch.column("v"))
        width = max(ask.shape[1], sample.shape[1])
        rows = _wide(sample, width)
        found = [_best(q, ids, _dot(rows, np.pad(v, (0, width - len(v)))), k)[1] for q, v in zip(batch.column("vec_id").to_pylist(), ask, strict=True)]
        least = pa.array([int(x[-1]) if len(x) == k else None for x in found], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), least], ["vec_id", "v", "least"])

    queries = arrow_map(known.where("asks").groupBy("vec_id").agg(F.min("v").alias("v")), first, "vec_id long, v array<double>, least long")
    if blocks > 1:
        queries = stash(queries, "queries")
    out = None
    for number in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).toArrow()
        if not block.num_rows:
            continue
        held = spark.sparkContext.broadcast((block.column("vec_id").to_numpy(), to_ints(block.column("v").combine_chunks())[0], block.column("least").to_pylist()))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            ids, ask, least = held.value
            _, _, axes = start.value
            best = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in ids]
            for found, part in _parts(batches):
                width = max(part.shape[1], ask.shape[1], len(axes))
                blocks = blocks_of(found, _wide(part, width), widened(axes, width))
                for q in range(len(ids)):
                    best[q] = search_blocks(blocks, int(ids[q]), np.pad(ask[q], (0, width - len(ask[q]))), *best[q], k, least[q])
            n = [len(x[0]) for x in best]
            if sum(n):
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(np.concatenate([x[0] for x in best])), pa.array(np.concatenate([x[1] for x in best]))], ["query_id", "vec_id", "score"])

        part = rows.select("vec_id", "v").mapInArrow(run, "query_id long, vec_id long, score long")
        if blocks > 1:  # one block of queries at a time is on driver and executors
            part = stash(_ranked(part, k), "found")
            held.destroy()
        out = part if out is None else out.unionByName(part)
    return _ranked(out, k) if blocks == 1 else out


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _wide(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The usable vectors, about CELLS components at a time, so that their length doesn't matter."""
    ids, rows, n = [], [], 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        width = max(x.shape[1] for x in rows)
        return np.concatenate(ids), np.concatenate([_wide(x, width) for x in rows])

    for batch in batches:
        part, good = to_ints(batch.column("v"))
        if good.any():
            ids.append(batch.column("vec_id").to_numpy()[good])
            rows.append(part[good])
            n += int(good.sum())
        if n and n * max(x.shape[1] for x in rows) >= CELLS:
            yield joined()
            ids, rows, n = [], [], 0
    if n:
        yield joined()


def op10_fagin_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every vector whose id is divisible by 100 the 10 others of highest score."""
    return search(spread(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


ORACLE_SQL = {
    "op10_fagin_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank_ AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank_ FROM s) WHERE rank_ <= 10"""
}
