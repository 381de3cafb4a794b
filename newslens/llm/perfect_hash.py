"""Minimal perfect hashes over tables of integer pairs, built by Spark tasks and looked up by numpy.

Keys are dealt to buckets of bounded size by a hash. The keys of a bucket are
thrown into a row of bits, half as many again as there are keys; those alone on
their bit keep it, the others go on to a further, smaller row. The slot of a key
is the number of bits set before its own, so n keys have the slots 0 to n - 1.
Every slot stores its key, so what is no key is told from what is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import ship, stash
from .textvec import U64, mix

#: Keys of a bucket, about, and of the buckets that are held in memory together.
BUCKET, BLOCK = 1 << 16, 1 << 21
#: Bits of a row for each key left.
ROOM = 1.5
TABLE = "bucket int, n long, rows array<long>, bits binary, first binary, second binary"


def hashed(first: np.ndarray, second: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each pair, another one for every salt."""
    return mix(mix(first.astype(U64) + U64((salt + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) + second.astype(U64))


def bucket_of(first: np.ndarray, second: np.ndarray, buckets: int) -> np.ndarray:
    return (hashed(first, second, 0) % U64(buckets)).astype(np.int64)


def build(first: np.ndarray, second: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Lengths of the rows of bits, the bits, and the order of the keys by slot; the keys have to differ."""
    rows, bits, order = [], [], []
    left = np.arange(len(first))
    while len(left):
        size = int(ROOM * len(left)) + 1
        at = (hashed(first[left], second[left], len(rows) + 1) % U64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        settled = alone[at]
        order.append(left[settled][np.argsort(at[settled])])
        left = left[~settled]
        rows.append(size)
        bits.append(alone)
    empty = np.zeros(0, dtype=np.int64)
    return rows, np.concatenate(bits) if bits else empty.astype(bool), np.concatenate(order) if order else empty


@dataclass
class Block:
    """Consecutive buckets in memory; their keys have the numbers ``low`` to ``high`` - 1."""

    buckets: int
    begin: int
    low: int
    base: np.ndarray
    rows: np.ndarray
    bits: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    second: np.ndarray

    @property
    def high(self) -> int:
        return self.low + len(self.first)

    def numbers(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The number of each pair that is a key of this block, -1 for the others."""
        out = np.full(len(first), -1, dtype=np.int64)
        bucket = bucket_of(first, second, self.buckets) - self.begin
        left = np.flatnonzero((bucket >= 0) & (bucket < len(self.rows)))
        for level in range(self.rows.shape[1]):
            held = bucket[left]
            size = self.rows[held, level]
            left, held, size = left[size > 0], held[size > 0], size[size > 0]
            if not len(left):
                break
            at = self.base[held, level] + (hashed(first[left], second[left], level + 1) % size.astype(U64)).astype(np.int64)
            here = self.bits[at]
            slot = self.rank[at[here]]
            own = left[here]
            same = (self.first[slot] == first[own]) & (self.second[slot] == second[own])
            out[own[same]] = slot[same] + self.low
            left = left[~here]
        return out


class PerfectHash:
    """The minimal perfect hash of a table of pairs, in the shared folder."""

    def __init__(self, table: DataFrame, buckets: int) -> None:
        self.table, self.buckets = table, buckets
        # a number for each bucket of BUCKET keys
        sizes = dict(table.select("bucket", "n").collect())
        self.starts = np.concatenate(([0], np.cumsum([sizes.get(k, 0) for k in range(buckets)]))).astype(np.int64)

    def __len__(self) -> int:
        return int(self.starts[-1])

    def spans(self, block: int) -> list[tuple[int, int]]:
        """Ranges of buckets of about ``block`` keys each."""
        out, begin = [], 0
        while begin < self.buckets:
            end = max(begin + 1, int(np.searchsorted(self.starts, self.starts[begin] + block, side="right")) - 1)
            out.append((begin, end))
            begin = end
        return out

    def blocks(self, block: int = BLOCK) -> Iterator[Block]:
        """The blocks, read one after the other."""
        for begin, end in self.spans(block):
            rows = self.table.where(F.col("bucket").between(begin, end - 1)).orderBy("bucket").toArrow().to_pylist()
            depth = max((len(x["rows"]) for x in rows), default=0)
            sizes = np.zeros((end - begin, depth), dtype=np.int64)
            for x in rows:
                sizes[x["bucket"] - begin, : len(x["rows"])] = x["rows"]
            ends = np.cumsum(sizes.ravel()).reshape(sizes.shape) if depth else sizes
            bits = _joined([np.unpackbits(np.frombuffer(x["bits"], np.uint8))[: sum(x["rows"])] for x in rows], np.uint8).astype(bool)
            rank = np.cumsum(bits, dtype=np.int32) - 1
            keys = (_joined([np.frombuffer(x[side], np.int64) for x in rows], np.int64) for side in ("first", "second"))
            # the slots of a bucket count on from those before it: its bits stand after theirs
            yield Block(self.buckets, begin, int(self.starts[begin]), ends - sizes, sizes, bits, rank, *keys)

    def keys(self) -> DataFrame:
        """(id, first, second): the keys and their numbers."""
        starts = self.starts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for x in batch.to_pylist():
                    first, second = (np.frombuffer(x[side], np.int64) for side in ("first", "second"))
                    ids = starts[x["bucket"]] + np.arange(len(first))
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(first), pa.array(second)], ["id", "first", "second"])

        return self.table.select("bucket", "first", "second").mapInArrow(run, "id long, first long, second long")


def _joined(parts: Sequence[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if len(parts) else np.zeros(0, dtype=kind)


def perfect_hash(pairs: DataFrame, total: int, bucket: int = BUCKET) -> PerfectHash:
    """The perfect hash of ``pairs``: two long columns, not null, without repetition, ``total`` rows. A task builds a bucket."""
    ship(pairs.sparkSession)
    buckets = max(1, -(-total // bucket))
    one, two = pairs.columns

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (batch.column(x).to_numpy() for x in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(first, second, buckets), pa.int32()), *batch.columns], ["bucket", "first", "second"])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        first, second = (rows.column(x).to_numpy() for x in ("first", "second"))
        sizes, bits, order = build(first, second)
        columns = {"n": [len(first)], "rows": [sizes], "bits": [np.packbits(bits).tobytes()], "first": [first[order].tobytes()], "second": [second[order].tobytes()]}
        kinds = {"n": pa.int64(), "rows": pa.list_(pa.int64()), "bits": pa.binary(), "first": pa.binary(), "second": pa.binary()}
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), **{k: pa.array(v, kinds[k]) for k, v in columns.items()}})

    dealt = pairs.select(F.col(one).alias("first"), F.col(two).alias("second")).mapInArrow(deal, "bucket int, first long, second long")
    return PerfectHash(stash(dealt.groupBy("bucket").applyInArrow(run, TABLE), "perfect_hash"), buckets)
