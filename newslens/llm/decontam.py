"""Benchmark decontamination by spaced-seed hashing.

A spaced seed looks at some positions of a window of tokens and ignores the
rest, so a substituted token in an ignored position doesn't hide a copy. The
hashes of every seed at every position of the benchmark are joined with those
of the corpus; around each hit the two texts are aligned and compared token by
token, and an overlap counts if enough of its tokens agree. Hits of one text and
item at one shift are compared together, over bounded pieces, so a passage that
many items share costs an array operation for each alignment and no step of a loop.

The seeds together find every overlap of OVERLAP tokens (or of a whole item of
at least LEAST tokens) in which no more than a fifth was substituted: a test
goes through all such patterns. Shorter items can be looked for as well, word
for word and whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import arrow_map, free_name, spread, stash, table, texts_of
from .textvec import mix, owners, words

#: Positions that each seed looks at.
SEEDS = ((0, 1, 2, 4, 5), (0, 1, 2, 3, 4), (0, 1, 3, 5, 6), (0, 1, 2, 3, 6))
#: Tokens of an aligned stretch that is compared.
OVERLAP = 12
#: Share of its tokens that must agree.
AGREE = 0.8
#: Items of fewer tokens have no overlap that may differ; they are found whole or not at all.
LEAST = 8
#: Tokens of the benchmark that are sent to the executors at a time, and hits or tokens that are compared at a time.
BLOCK_TOKENS, PIECE_HITS = 1_000_000, 1 << 20


def seed_hashes(hashes: np.ndarray, bounds: np.ndarray, seed: Sequence[int], number: int) -> tuple[np.ndarray, np.ndarray]:
    """The seed's hash at every position where it fits into its text, and those positions."""
    n = len(hashes) - seed[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    acc = np.full(n, np.uint64(number + 1))
    factor = 1
    for k in seed:
        factor = factor * 0xD1342543DE82EF95 + 1 & (1 << 64) - 1
        acc += hashes[k : k + n] * np.uint64(factor)
    last = np.repeat(bounds[1:], np.diff(bounds))
    at = np.flatnonzero(np.arange(n) + seed[-1] < last[:n])
    return mix(acc[at]), at


#: Tokens on either side of a hit within which all overlaps around it lie.
REACH = OVERLAP + max(x[-1] for x in SEEDS)


def surroundings(hashes: np.ndarray, bounds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of the text's number and of the REACH tokens on either side of each place, or the end of the text there."""
    owner = np.searchsorted(bounds, places, side="right") - 1
    first, last = bounds[owner], bounds[owner + 1]
    acc = mix(owner.astype(np.uint64) + np.uint64(1))
    for k in range(-REACH, REACH + 1):
        at = places + k
        token = np.where((at >= first) & (at < last), hashes[np.clip(at, 0, len(hashes) - 1)], np.uint64(k & 0xFF))
        acc = acc * np.uint64(0xD1342543DE82EF95) + token
    return mix(acc)


class Index:
    """The seed hashes of a block of benchmark items."""

    def __init__(self, ids: Sequence[int], texts: list[str], short: bool = False) -> None:
        self.ids = np.asarray(ids, dtype=np.int64)
        self.hashes, self.bounds = words(texts)
        owner = owners(self.bounds)
        long_enough = np.diff(self.bounds) >= LEAST
        keys, places = [], []
        for number, seed in enumerate(SEEDS):
            found, at = seed_hashes(self.hashes, self.bounds, seed, number)
            good = long_enough[owner[at]] if len(at) else np.zeros(0, dtype=bool)
            keys.append(found[good])
            places.append(at[good])
        keys, places = np.concatenate(keys), np.concatenate(places)
        # of places of an item with equal surroundings the last is enough: it has the least shift
        held = np.unique(places)[::-1]
        held = held[np.unique(surroundings(self.hashes, self.bounds, held), return_index=True)[1]] if len(held) else held
        last = np.isin(places, held)
        keys, places = keys[last], places[last]
        order = np.argsort(keys, kind="stable")
        self.keys, self.places = keys[order], places[order]
        self.owner = owner
        self.bloom = np.zeros(1 << 22, dtype=bool)  # most positions of a corpus end here
        self.bloom[self.keys >> np.uint64(42)] = True
        #: By length: hashes of the short items, in order, and their numbers.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = np.diff(self.bounds)
        for size in range(1, LEAST) if short else ():
            which = np.flatnonzero(sizes == size)
            if len(which):
                found, at = seed_hashes(self.hashes, self.bounds, range(size), len(SEEDS) + size)
                found = found[np.searchsorted(at, self.bounds[which])]
                order = np.argsort(found, kind="stable")
                self.short[size] = found[order], which[order]

    def copies(self, hashes: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int, int]]:
        """The first whole copy of each short item in each text, as in overlaps."""
        out = {}
        for size, (keys, items) in self.short.items():
            found, at = seed_hashes(hashes, bounds, range(size), len(SEEDS) + size)
            low, high = np.searchsorted(keys, found), np.searchsorted(keys, found, side="right")
            n = high - low
            if total := int(n.sum()):
                item = items[np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(total)]
                place = np.repeat(at, n)
                same = np.all([hashes[place + k] == self.hashes[self.bounds[item] + k] for k in range(size)], axis=0)
                place, item = place[same], item[same]
                text = np.searchsorted(bounds, place, side="right") - 1
                pairs, first = np.unique(np.stack([text, item], axis=1), axis=0, return_index=True)
                out |= {(t, i): (p, 0, size, size) for (t, i), p in zip(pairs.tolist(), (place - bounds[text])[first].tolist(), strict=True)}
        return out

    def hits(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """(position in the texts, position in the items) of equal seed hashes, a row each, in pieces of about PIECE_HITS by position in the texts.

        Of a text's positions with equal surroundings only the first is taken:
        around the others lie the same overlaps, later in the text. So a line
        that is repeated doesn't meet each of its repetitions.
        """
        keys, places = [], []
        for number, seed in enumerate(SEEDS):
            found, at = seed_hashes(hashes, bounds, seed, number)
            near = self.bloom[found >> np.uint64(42)]
            keys.append(found[near])
            places.append(at[near])
        keys, places = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(places, kind="stable")
        keys, places = keys[order], places[order]
        low = np.searchsorted(self.keys, keys)
        many = np.searchsorted(self.keys, keys, side="right") - low
        held = np.unique(places[many > 0])
        if len(held):
            held = held[np.unique(surroundings(hashes, bounds, held), return_index=True)[1]]
            first = (many > 0) & np.isin(places, held)
            keys, places, low, many = keys[first], places[first], low[first], many[first]
        upto, begin = np.cumsum(many), 0
        while begin < len(keys):
            # as many as fit, one at least, which has no more hits than the block has tokens
            stop = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PIECE_HITS, side="right")))
            n = many[begin:stop]
            if total := int(n.sum()):
                which = np.repeat(low[begin:stop] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(total)
                yield np.stack([np.repeat(places[begin:stop], n), self.places[which]], axis=1)
            begin = stop

    def overlaps(self, hashes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, place in the text, place in the item, tokens, agreeing tokens): the best overlap of each text and item."""
        best: dict[tuple[int, int], tuple] = self.copies(hashes, bounds)
        for hits in self.hits(hashes, bounds):
            texts = np.searchsorted(bounds, hits[:, 0], side="right") - 1
            items = self.owner[hits[:, 1]]
            shifts = hits[:, 0] - hits[:, 1]
            order = np.lexsort((hits[:, 1], shifts, items, texts))
            texts, items, shifts, places = texts[order], items[order], shifts[order], hits[order, 1]
            # an overlap lies around a hit: alignments are split where hits lie too far apart to share one
            new = np.concatenate(([True], (np.diff(texts) != 0) | (np.diff(items) != 0) | (np.diff(shifts) != 0) | (np.diff(places) > 2 * REACH)))
            first = np.flatnonzero(new)
            last = np.concatenate((first[1:], [len(new)])) - 1
            text, item, shift = texts[first], items[first], shifts[first]
            low = np.maximum.reduce([self.bounds[item], bounds[text] - shift, places[first] - REACH])
            high = np.minimum.reduce([self.bounds[item + 1], bounds[text + 1] - shift, places[last] + REACH + 1])
            size = np.minimum(OVERLAP, self.bounds[item + 1] - self.bounds[item])
            for k, at, agree in self._along(hashes, low, high, shift, size):
                key, found = (int(text[k]), int(item[k])), (int(low[k] + at + shift[k] - bounds[text[k]]), int(low[k] + at - self.bounds[item[k]]), int(size[k]), agree)
                if key not in best or (found[3], -found[0], found[1]) > (best[key][3], -best[key][0], best[key][1]):
                    best[key] = found
        return [(t, i, *x) for (t, i), x in sorted(best.items())]

    def _along(self, hashes: np.ndarray, low: np.ndarray, high: np.ndarray, shift: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(alignment, offset, agreeing tokens) of the first window with most agreement of each alignment, if that is enough."""
        keep = np.flatnonzero(high - low >= size)
        lengths = (high - low)[keep]
        ends = np.cumsum(lengths)
        begin = 0
        while begin < len(keep):
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PIECE_HITS, side="right")))
            own, n = keep[begin:stop], lengths[begin:stop]
            starts = np.concatenate(([0], np.cumsum(n)))
            number = np.repeat(np.arange(len(own)), n)
            offset = np.arange(starts[-1]) - starts[number]
            place = low[own][number] + offset
            same = np.concatenate(([0], np.cumsum(self.hashes[place] == hashes[place + shift[own][number]])))
            inside = offset + size[own][number] <= n[number]
            window = np.flatnonzero(inside)
            agree = same[window + size[own][number[window]]] - same[window]
            # the first of the most agreeing windows of each alignment
            order = np.lexsort((offset[window], -agree, number[window]))
            first = order[np.concatenate(([True], np.diff(number[window][order]) != 0))]
            enough = agree[first] >= np.ceil(size[own][number[window[first]]] * AGREE)
            for k, at, a in zip(own[number[window[first]]][enough].tolist(), offset[window[first]][enough].tolist(), agree[first][enough].tolist(), strict=True):
                yield k, at, a
            begin = stop


def blocks(benchmark: DataFrame, key: str, text: str, short: bool = False) -> tuple[int, Iterator[Index]]:
    """How many blocks the benchmark has, each of about BLOCK_TOKENS tokens, and their indexes, made one after the other.

    The items are dealt to blocks by a hash. Each block is bounded, and the
    corpus is read once for each.
    """
    items = benchmark.select(F.col(key).cast("long").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("item is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // (6 * BLOCK_TOKENS)))

    def each() -> Iterator[Index]:
        for k in range(n):
            rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).orderBy("item", "text").collect()
            yield Index([r[0] for r in rows], [r[1] for r in rows], short)

    return n, each()


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", short: bool = False) -> DataFrame:
    """One row for each document and benchmark item that it holds a passage of.

    Columns: doc_id, item_id, doc_place and item_place (token numbers of the best
    overlap), n_tokens of it, and n_agree. Passages are compared as words, in
    lower case and without punctuation.

    Defined results: null and empty texts hold nothing; items of fewer than
    LEAST tokens are looked for if ``short``, and then found where all their
    words follow each other; items without words or without an id are not looked
    for; repeated documents have their rows each; of equally good overlaps the first counts; an empty
    corpus or benchmark gives no rows; further columns are ignored.
    """
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([StructField("doc_id", docs.schema[key].dataType), StructField("item_id", LongType()), *(StructField(x, IntegerType()) for x in ("doc_place", "item_place", "n_tokens", "n_agree"))])
    out = None
    n, indexes = blocks(benchmark, item_key, item_text, short)
    for index in indexes:
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch, held=held) -> pa.RecordBatch | None:
            found = held.value.overlaps(*words(texts_of(batch)))
            if not found:
                return None
            at = np.array(found, dtype=np.int64)
            small = [pa.array(at[:, k], pa.int32()) for k in range(2, 6)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at[:, 0])), pa.array(held.value.ids[at[:, 1]]), *small], [x.name for x in schema])

        part = arrow_map(source, run, schema)
        if n > 1:  # one block at a time is on driver and executors
            part = stash(part, "leaks")
            held.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", short: bool = False) -> DataFrame:
    """The rows of docs that hold no benchmark passage (nor a whole item of fewer than LEAST tokens, if ``short``), columns unchanged.

    Defined results: rows are judged one by one by their text, so keys need not
    be unique or set, and repeated rows stay or go together; null and empty texts
    stay; an empty benchmark keeps everything; an empty table gives no rows;
    texts are read whole; further columns, of any name, go through unchanged.
    """
    n, indexes = blocks(benchmark, item_key, item_text, short)
    if n == 1:
        only = docs.sparkSession.sparkContext.broadcast(next(indexes))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            clean = np.ones(batch.num_rows, dtype=bool)
            for found in only.value.overlaps(*words(texts_of(batch, text))):
                clean[found[0]] = False
            return batch.filter(pa.array(clean))

        return arrow_map(docs, run, docs.schema)
    # several blocks: the keys of the texts that each finds, then one join; the corpus is written once only
    one, two = free_name(docs, "_text_key"), free_name(docs, "_text_check")
    keyed = docs.withColumns({one: F.xxhash64(F.col(text)), two: F.xxhash64(F.lit(1), F.col(text))})
    source = keyed.select(F.col(text).alias("text"), F.col(one).alias("one"), F.col(two).alias("two"))
    gone = None
    for index in indexes:
        held = docs.sparkSession.sparkContext.broadcast(index)

        def leaks(batch: pa.RecordBatch, held=held) -> pa.RecordBatch | None:
            found = sorted({x[0] for x in held.value.overlaps(*words(texts_of(batch)))})
            return batch.select(["one", "two"]).take(pa.array(found, pa.int64())) if found else None

        part = stash(arrow_map(source, leaks, "one long, two long").distinct(), "leaks")
        held.destroy()
        gone = part if gone is None else gone.unionByName(part)
    return keyed.join(gone.distinct().withColumnsRenamed({"one": one, "two": two}), [one, two], "left_anti").drop(one, two)


def op1_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passages of ``benchmark`` in ``documents``."""
    return find_leaks(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), short=True)


#: Alignments that share three tokens in a row, as every overlap of 8 tokens or more does; shorter items by any token. Every window of each is counted.
ORACLE_SQL = {
    "op1_benchmark_leaks": r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), d AS (
  SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM docs
), i AS (
  SELECT item_id, unnest(w) AS t, generate_subscripts(w, 1) AS p, len(w) AS n, least(12, len(w)) AS size FROM items
), three AS (
  SELECT doc_id, p, concat_ws(' ', t, lead(t) OVER o, lead(t, 2) OVER o) AS g FROM d WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), item_three AS (
  SELECT item_id, p, n, concat_ws(' ', t, lead(t) OVER o, lead(t, 2) OVER o) AS g FROM i WINDOW o AS (PARTITION BY item_id ORDER BY p)
), lines AS (
  SELECT doc_id, item_id, three.p - item_three.p AS shift FROM three JOIN item_three USING (g) WHERE n >= 8
  UNION SELECT doc_id, item_id, d.p - i.p FROM d JOIN i USING (t) WHERE n < 8
), same AS (
  SELECT doc_id, item_id, shift, i.p, n, size, CAST(d.t = i.t AS INT) AS eq FROM lines JOIN i USING (item_id) JOIN d USING (doc_id) WHERE d.p = i.p + shift
), wins AS (
  SELECT *, sum(eq) OVER f AS agree, count(*) OVER f AS held FROM same WINDOW f AS (PARTITION BY doc_id, item_id, shift ORDER BY p ROWS BETWEEN CURRENT ROW AND size - 1 FOLLOWING)
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY agree DESC, p + shift, shift) AS rk FROM wins WHERE held = size AND agree >= CASE WHEN n < 8 THEN n ELSE ceil(0.8 * size) END
)
SELECT doc_id, item_id, CAST(p + shift - 1 AS INT) AS doc_place, CAST(p - 1 AS INT) AS item_place, CAST(size AS INT) AS n_tokens, CAST(agree AS INT) AS n_agree FROM best WHERE rk = 1"""
}
