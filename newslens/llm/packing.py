"""Variable-capacity best-fit packing of documents into training sequences.

Texts are measured in tokens (by default bytes of UTF-8 plus an end token, the
lengths of a byte-level tokenizer), cut into pieces of at most the largest
permitted sequence length, and packed by best-fit decreasing. Several sequence
lengths are permitted at once. A sequence costs its tokens, a share for
attention that grows with the square of its length, and a fixed overhead, so
short ones are cheap and long ones have room for long pieces. A piece that fits
no open bin opens one of the least expected cost: that of the size less the
price of the tokens that the smaller pieces still to come, and not yet promised
to open bins, can fill its gap with. Several prices are tried on each share of
the pieces, from nothing (the tightest size) upwards, and the cheapest outcome
kept; at the end each bin is downsized to the smallest permitted length that
holds its contents.

Pieces are dealt to shares of a bounded number of rows by a hash of document,
piece and number of the copy, so one source, one very long document or one row
repeated many times doesn't make a large share; each share is packed alone, and
loses at most a few partly filled bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import ship
from .common import stash, table

#: Permitted sequence lengths in tokens.
CAPACITIES = (2048, 4096, 8192, 16384)
#: Cost of a bin besides its tokens: a sequence's fixed overhead.
BIN_COST = 64
#: Tokens at which a sequence's attention costs as much as the rest of it.
ATTENTION = 32_768
#: Prices of a filled token that are tried, in terms of the cheapest size's cost per token.
PRICES = (0.0, 0.8, 0.9, 0.95, 1.0, 1.1, 1.5)
#: Pieces that one task packs together.
SHARE = 20_000
#: Copies of one row that are expanded by one task.
RUN = 65_536


def byte_tokens(text: Column) -> Column:
    """Token count of a byte-level tokenizer: UTF-8 bytes and one end token; null counts as empty."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def bin_cost(capacity: int) -> int:
    """Cost of a sequence: its tokens, attention, and overhead."""
    return capacity + capacity * capacity // ATTENTION + BIN_COST


class _Open:
    """Open bins by free space: the tightest that fits in O(log n)."""

    def __init__(self) -> None:
        self.free: list[int] = []  # the distinct free spaces, ascending
        self.bins: dict[int, list[int]] = {}

    def take(self, need: int) -> tuple[int, int] | None:
        at = bisect_left(self.free, need)
        if at == len(self.free):
            return None
        space = self.free[at]
        held = self.bins[space]
        number = held.pop()
        if not held:
            del self.bins[space], self.free[at]
        return number, space

    def put(self, number: int, space: int) -> None:
        if space <= 0:
            return
        if space not in self.bins:
            self.bins[space] = []
            insort(self.free, space)
        self.bins[space].append(number)


def downsize(used: int, capacities: Sequence[int]) -> int:
    return capacities[bisect_left(capacities, used)]


def best_fit(lengths: Sequence[int], capacities: Sequence[int], price: float) -> tuple[list[int], list[int], int]:
    """Bin of each piece (lengths descending), the downsized capacities, and the total cost.

    A piece that fits no open bin opens one of the size whose cost, less
    ``price`` for each token that smaller pieces can fill of its gap, is least;
    ties go to the smaller size.
    """
    open_bins, where, used = _Open(), [], []
    left = [*accumulate(reversed(lengths), initial=0)][::-1]  # tokens from a piece on
    negative = [-x for x in lengths]
    costs = [bin_cost(x) for x in capacities]
    promised = 0  # free space of open bins
    for at, need in enumerate(lengths):
        found = open_bins.take(need)
        if found is None:

            def expected(k: int, at=at, need=need) -> float:
                gap = capacities[k] - need
                fitting = left[max(at + 1, bisect_left(negative, -gap))]
                return costs[k] - price * min(gap, max(0, fitting - promised))

            space = capacities[min(range(bisect_left(capacities, need), len(capacities)), key=expected)]
            used.append(0)
            found = (len(used) - 1, space)
            promised += space
        number, space = found
        promised -= need
        used[number] += need
        where.append(number)
        open_bins.put(number, space - need)
    sizes = [downsize(x, capacities) for x in used]
    return where, sizes, sum(map(bin_cost, sizes))


def pack_share(lengths: Sequence[int], capacities: Sequence[int]) -> tuple[list[int], list[int]]:
    """The cheapest packing over all prices; ties go to the lower price."""
    cheapest = min((bin_cost(x) / x for x in capacities))
    where, sizes, _ = min((best_fit(lengths, capacities, x * cheapest) for x in PRICES), key=lambda x: x[2])
    return where, sizes


def pieces(docs: DataFrame, key: str, tokens: Column, longest: int) -> DataFrame:
    """(doc_id, piece, start, n_tokens): each document cut into pieces of at most ``longest`` tokens."""
    sized = docs.select(F.col(key).alias("doc_id"), tokens.alias("_tokens"))
    cut = sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_tokens") - 1) / longest).cast("long"))))
    start = F.col("piece") * longest
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.col("_tokens") - start, F.lit(longest)).cast("long").alias("n_tokens"))


def _each(cut: DataFrame) -> DataFrame:
    """Pieces with _copy, which numbers equal rows; they are counted before the shuffle, and many copies are expanded by several tasks."""
    names = cut.columns
    counted = stash(cut.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")), "pieces")
    single = counted.where("_n = 1").select(*names, F.lit(0).cast("long").alias("_copy"))
    runs = counted.where("_n > 1").withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / RUN).cast("long"))))
    spread = runs.repartition(*names, "_run").withColumn("_copy", F.explode(F.sequence(F.col("_run") * RUN, F.least((F.col("_run") + 1) * RUN, F.col("_n")) - 1)))
    return single.unionByName(spread.select(*names, "_copy"))


def pack(docs: DataFrame, key: str = "doc_id", tokens: Column | None = None, capacities: Sequence[int] = CAPACITIES, share: int = SHARE) -> DataFrame:
    """One row per piece: its bin, the bin's capacity and fill, and the place in the bin.

    Columns: doc_id, piece, start, n_tokens, bin_id, capacity, bin_tokens, bin_offset.
    ``tokens`` is the token count of a row, at least 1 (default: bytes of text plus one).

    Defined results: null or empty text is one piece of one token; a text longer
    than the largest capacity is cut, nothing is dropped; repeated rows are packed
    each for itself; null keys are packed like others; an empty table gives no
    rows; further columns are ignored. Order and bins are the same on every run
    over the same rows, however they are partitioned.
    """
    sizes = sorted(set(capacities))
    if not sizes or sizes[0] < 1:
        raise ValueError("capacities must be positive")
    cut = _each(pieces(docs, key, byte_tokens(F.col("text")) if tokens is None else tokens, sizes[-1]))
    shares = max(1, -(-cut.count() // share))
    dealt = cut.withColumn("_share", F.pmod(F.xxhash64("doc_id", "piece", "n_tokens", "_copy"), F.lit(shares)).cast("int"))

    def run(rows: pa.Table) -> pa.Table:
        # keys stay in Arrow: pandas would make doubles of integers beside a null
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("_copy", "ascending")])).combine_chunks()
        lengths = rows.column("n_tokens").to_numpy()
        where, capacity = pack_share(lengths.tolist(), sizes)
        numbers = np.asarray(where, dtype=np.int64)
        order = np.argsort(numbers, kind="stable")
        first = np.concatenate(([0], np.cumsum(np.bincount(numbers))))
        upto = np.concatenate(([0], np.cumsum(lengths[order])))
        offsets = np.empty(len(numbers), dtype=np.int64)
        offsets[order] = upto[:-1] - upto[first[numbers[order]]]
        columns = {
            "bin_id": numbers + (rows.column("_share").to_numpy().astype(np.int64) << 32),
            "capacity": np.asarray(capacity, dtype=np.int32)[numbers],
            "bin_tokens": np.diff(upto[first])[numbers],
            "bin_offset": offsets,
        }
        return pa.table({**{x: rows.column(x) for x in ("doc_id", "piece", "start", "n_tokens")}, **columns})

    ship(docs.sparkSession)
    kind = cut.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("_share").applyInArrow(run, f"doc_id {kind}, piece long, start long, n_tokens long, bin_id long, capacity int, bin_tokens long, bin_offset long")


def sequences(packed: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The packed sequences as bytes: (bin_id, capacity, bin_tokens, tokens), pieces in order, each document ended by a 0 byte.

    For the default byte-level token count and unique keys.
    """
    whole = docs.select(F.col(key).alias("_key"), F.concat(F.coalesce(F.col("text"), F.lit("")).cast("binary"), F.lit(b"\x00")).alias("_bytes"))
    cut = packed.join(whole, F.col("doc_id").eqNullSafe(F.col("_key"))).select(
        "bin_id", "capacity", "bin_tokens", F.struct("bin_offset", F.expr("substring(_bytes, cast(start + 1 as int), cast(n_tokens as int))").alias("part")).alias("_part")
    )
    parts = cut.groupBy("bin_id", "capacity", "bin_tokens").agg(F.array_sort(F.collect_list("_part")).alias("_parts"))
    joined = F.aggregate("_parts", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["part"]))
    return parts.select("bin_id", "capacity", "bin_tokens", joined.alias("tokens"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into byte-level sequences of the permitted lengths."""
    return pack(table(spark, sf_dir, "documents"))
