"""Phrase collocations: phrases that are far more frequent than what their two parts make likely.

Phrases grow word by word, as in Apriori: a phrase of k words is a candidate only
if both phrases of k - 1 words in it are frequent, so it is a pair of their
numbers. Such pairs are added up before and after one shuffle of integers, and
those that can reach the least count go into a minimal perfect hash that stores
them. With it every place of the corpus gets the number of the phrase that
begins there; mappers count these numbers by bincount into arrays, which are
added as a tree, so the count of a phrase, and of both parts of each of its cuts,
is read by its slot.

The corpus is read twice as text (words, then their numbers). All further passes
read numbers, and stretches without frequent phrases are gone from them. Perfect
hashes and arrays are held in blocks of bounded size, one at a time: with more
numbers than fit, the numbers of the corpus are read once for each block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import LONG_ROWS
from .common import quoted, slices, spread, stash, table
from .perfect_hash import BLOCK, PerfectHash, perfect_hash

#: Fewest occurrences of a candidate, and most words in it.
LEAST, LONGEST = 30, 4
#: A candidate goes if a longer one has so many hundredths of its occurrences.
ABSORBED = 80
SCALE = 2_000_000
#: Phrases reported for each language.
TOP = 2000
UNKNOWN = "und"
#: Counts that are added together: a row of the tree.
CHUNK = 1 << 16
#: Arrays that are added in one task on each level of the tree, about.
FAN = 16
#: Bytes of text that become words, as objects, at a time.
TEXT_BYTES = 2 << 20
#: Numbers of a row of the corpus, about.
ROW = 1 << 16
_BREAK = b"\xff"  # in no UTF-8 text
_TABLE = bytes(0xFF if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c for c in range(256))


def tokens(raws: Sequence[bytes | None]) -> tuple[np.ndarray, list[bytes]]:
    """The words of all texts as numbers of the list returned, with 0 wherever a piece ends."""
    held = _BREAK.join(x or b"" for x in raws).lower().translate(_TABLE)  # of bytes, A to Z only
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    numbers[_BREAK]
    split = held.replace(_BREAK, b" \xff ").split()
    return np.fromiter(map(numbers.__getitem__, split), dtype=np.int64, count=len(split)), list(numbers)


def word_keys(words: Sequence[bytes], group: str, salt: int) -> np.ndarray:
    """A 64-bit key of each word of a group."""
    seed = xxhash.xxh3_64_intdigest(group.encode(), seed=salt)
    return np.array([xxhash.xxh3_64_intdigest(x, seed=seed) for x in words], dtype=np.uint64).view(np.int64)


def _by_group(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes | None]]]:
    texts, groups = batch.column("text").cast(pa.binary()).to_pylist(), defaultdict(list)
    for k, group in enumerate(batch.column("group").to_pylist()):
        groups[group].append(texts[k])
    yield from groups.items()


def _map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXT_BYTES):
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def _counted_words(source: DataFrame, salt: int) -> DataFrame:
    """(group, word, key, f): the occurrences of every word."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for group, raws in _by_group(batch):
            at, words = tokens(raws)
            f = np.bincount(at, minlength=len(words))[1:]
            columns = [pa.array([group] * len(f), pa.string()), pa.array(words[1:], pa.binary()).cast(pa.string()), pa.array(word_keys(words[1:], group, salt)), pa.array(f)]
            yield pa.RecordBatch.from_arrays(columns, ["group", "word", "key", "f"])

    return _map(source, count, "group string, word string, key long, f long").groupBy("group", "word", "key").agg(F.sum("f").alias("f"))


def _squeezed(numbers: np.ndarray) -> np.ndarray:
    """-1 once only where several follow each other."""
    return numbers[(numbers >= 0) | np.append(True, numbers[:-1] >= 0)[: len(numbers)]]


def _kind(total: int) -> type:
    """Integers that hold so many numbers."""
    return np.int32 if total < 1 << 31 else np.int64


def _arrays(batch: pa.RecordBatch, kind: type) -> Iterator[np.ndarray]:
    return (np.frombuffer(x, kind).astype(np.int64) for x in batch.column("ids").to_pylist())


def _parts(numbers: np.ndarray, end: int) -> Iterator[np.ndarray]:
    """The numbers in arrays of about ROW, cut behind ``end`` only, over which no phrase goes."""
    ends, low = np.flatnonzero(numbers == end) + 1, 0
    while len(numbers) - low > ROW:
        k = int(np.searchsorted(ends, low + ROW))
        high = int(ends[k]) if k < len(ends) else len(numbers)
        yield numbers[low:high]
        low = high
    if low < len(numbers):
        yield numbers[low:]


@dataclass(frozen=True)
class Pairs:
    """How rows become pairs: arrays of a batch, cut at ``end``, and the pair at every place of such an array."""

    arrays: Callable[[pa.RecordBatch], Iterator[np.ndarray]]
    pair: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
    end: int
    kind: type


def _numbered(source: DataFrame, pairs: Pairs, hashes: PerfectHash, block: int, tag: str) -> DataFrame:
    """(ids): arrays of the numbers of the pairs that each batch has, in order; -1, once only in a row, for those that are no keys.

    With several blocks of the hash there is a pass for each; the arrays go from
    one to the next beside their numbers so far, in rows and row groups of bounded size.
    """
    spans, kind = hashes.spans(block), _kind(len(hashes))
    rows = source
    for k, held in enumerate(hashes.blocks(block)):
        begun, last, shared = k == 0, k == len(spans) - 1, source.sparkSession.sparkContext.broadcast(held)

        def read(batch: pa.RecordBatch, begun=begun) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
            if begun:
                for x in pairs.arrays(batch):
                    for part in _parts(x, pairs.end):
                        yield part, None
            else:
                for x, ids in zip(batch.column("held"), batch.column("ids"), strict=True):
                    yield np.frombuffer(x.as_py(), pairs.kind), np.frombuffer(ids.as_py(), kind)

        def number(batch: pa.RecordBatch, shared=shared, last=last, read=read) -> Iterator[pa.RecordBatch]:
            for x, before in read(batch):
                ids = shared.value.numbers(*pairs.pair(x.astype(np.int64)))
                if before is not None:
                    ids = np.maximum(ids, before)
                if last:
                    yield pa.RecordBatch.from_arrays([pa.array([_squeezed(ids).astype(kind).tobytes()], pa.binary())], ["ids"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array([x.astype(pairs.kind).tobytes()], pa.binary()), pa.array([ids.astype(kind).tobytes()], pa.binary())], ["held", "ids"])

        rows = stash(_map(rows, number, "ids binary" if last else "held binary, ids binary"), tag, LONG_ROWS)
        shared.destroy()
    return rows


def _pairs_of_words(salt: int) -> Pairs:
    """The keys of all words in order, with nothing; 0 where a piece ends, which no frequent word has."""

    def arrays(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for group, raws in _by_group(batch):
            at, words = tokens(raws)
            own = word_keys(words, group, salt)
            own[0] = 0
            yield own[at]

    return Pairs(arrays, lambda x: (x, np.zeros(len(x), dtype=np.int64)), 0, np.int64)


def _pairs_of(kind: type) -> Pairs:
    """The numbers at every place and at the next one."""
    return Pairs(lambda batch: _arrays(batch, kind), lambda x: (x[:-1], x[1:]), -1, kind)


def _candidates(ids: DataFrame, kind: type, least: int) -> DataFrame:
    """(first, second): pairs of numbers that follow each other so often."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for x in _arrays(batch, kind):
            good = np.flatnonzero((x[:-1] >= 0) & (x[1:] >= 0))
            first, second = x[good], x[good + 1]
            order = np.lexsort((second, first))
            first, second = first[order], second[order]
            new = np.flatnonzero(np.concatenate(([True], (np.diff(first) != 0) | (np.diff(second) != 0)))) if len(first) else good
            yield pa.RecordBatch.from_arrays([pa.array(first[new]), pa.array(second[new]), pa.array(np.diff(np.append(new, len(first))))], ["first", "second", "n"])

    return _map(ids, count, "first long, second long, n long").groupBy("first", "second").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("first", "second")


def _summed(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    def add(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = reduce(np.add, (np.frombuffer(x, np.int64) for batch in rows for x in batch.column("counts").to_pylist()))
        yield pa.RecordBatch.from_arrays([*(pa.array([x.as_py()], pa.int64()) for x in key), pa.array([total.tobytes()], pa.binary())], [*by, "counts"])

    return parts.groupBy(*by).applyInArrow(add, ", ".join(f"{x} long" for x in by) + ", counts binary")


def _counts(ids: DataFrame, total: int, block: int) -> DataFrame:
    """(id, a): how often each number stands in the arrays, by arrays of mappers that are added as a tree."""
    out, kind = None, _kind(total)
    cores = ids.sparkSession.sparkContext.defaultParallelism
    # each mapper sends one array for each block, so there are not more of them than keep the cores busy
    few = ids.coalesce(2 * cores) if ids.rdd.getNumPartitions() > 2 * cores else ids
    few = few.withColumn("mapper", F.spark_partition_id().cast("long"))
    for low in range(0, max(1, total), block):
        size = min(block, total - low)

        def count(batches: Iterator[pa.RecordBatch], low=low, size=size) -> Iterator[pa.RecordBatch]:
            acc, mapper = np.zeros(size, dtype=np.int64), 0
            for batch in slices(batches, TEXT_BYTES):
                mapper = batch.column("mapper")[0].as_py()
                x = np.concatenate(list(_arrays(batch, kind)))
                acc += np.bincount(x[(x >= low) & (x < low + size)] - low, minlength=size)
            for at in range(0, size, CHUNK):
                if (part := acc[at : at + CHUNK]).any():
                    yield pa.RecordBatch.from_arrays([pa.array([low + at]), pa.array([mapper // FAN]), pa.array([part.tobytes()], pa.binary())], ["chunk", "branch", "counts"])

        parts = few.mapInArrow(count, "chunk long, branch long, counts binary")
        part = _summed(_summed(parts, ("chunk", "branch")), ("chunk",))
        out = part if out is None else out.unionByName(part)

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for x in batch.to_pylist():
            a = np.frombuffer(x["counts"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x["chunk"] + np.arange(len(a))), pa.array(a)], ["id", "a"])

    return _map(out, read, "id long, a long")


def _words(source: DataFrame, least: int) -> tuple[DataFrame, int]:
    """The occurrences of every word, with keys that tell the frequent ones from all others, and the salt of these keys."""
    for salt in range(8):
        words = stash(_counted_words(source, salt), "words")
        clash = words.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("f").alias("f")).where((F.col("n") > 1) & (F.col("f") >= least) | (F.col("key") == 0))
        if clash.isEmpty():
            return words, salt
    raise RuntimeError("no salt gives the words keys of their own")


def frequent_phrases(docs: DataFrame, text: str = "text", group: str = "lang", least: int = LEAST, longest: int = LONGEST, block: int = BLOCK) -> tuple[list[DataFrame], DataFrame]:
    """For each length from 1 the phrases that occur ``least`` times, and the number of words of each group.

    The tables hold id, group, phrase, last (its last word), a (its count), first
    and second (the ids of the phrase without its last and its first word, null
    for a word), heads and tails (the counts of its first and its last 1, 2, ...
    words, its own last). Ids count within a length.
    """
    source = docs.select(F.col(quoted(text)).alias("text"), F.coalesce(F.col(quoted(group)).cast("string"), F.lit(UNKNOWN)).alias("group"))
    words, salt = _words(source, least)
    totals = words.groupBy("group").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least)
    n = frequent.count()
    hashes = perfect_hash(frequent.select("key", F.lit(0).cast("long").alias("second")), n)
    ids = _numbered(source, _pairs_of_words(salt), hashes, block, "words")
    held = hashes.keys().join(_counts(ids, n, block), "id").join(frequent, F.col("first") == F.col("key"))
    null = F.lit(None).cast("long")
    out = [stash(held.select("id", "group", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", null.alias("first"), null.alias("second"), F.array("a").alias("heads"), F.array("a").alias("tails")), "phrases")]
    for size in range(2, longest + 1):
        pairs = stash(_candidates(ids, _kind(n), least), "candidates")
        kind, n = _kind(n), pairs.count()
        if not n:
            break
        hashes = perfect_hash(pairs, n)
        ids = _numbered(ids, _pairs_of(kind), hashes, block, f"phrases{size}")
        held = hashes.keys().join(_counts(ids, n, block), "id")
        first = out[-1].select(F.col("id").alias("first"), "group", F.col("phrase").alias("head"), "heads")
        second = out[-1].select(F.col("id").alias("second"), "last", "tails")
        phrase = F.concat_ws(" ", "head", "last").alias("phrase")
        grown = held.join(first, "first").join(second, "second")
        out.append(stash(grown.select("id", "group", phrase, "last", "a", "first", "second", F.array_append("heads", F.col("a")).alias("heads"), F.array_append("tails", F.col("a")).alias("tails")), "phrases"))
    return out, totals


def _lowest_cut(size: int) -> Column:
    """(score, k, l, r) of the cut of least score, of equal ones the first; exact beyond 64 bits."""

    def cut(k: int) -> Column:
        l, r = F.col("heads")[k - 1], F.col("tails")[size - k - 1]  # noqa: E741
        wide = f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(heads[{k - 1}] as decimal(19,0)) + cast(tails[{size - k - 1}] as decimal(19,0)))"
        return F.struct(F.expr(wide).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))

    return F.array_min(F.array(*map(cut, range(1, size))))


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", least: int = LEAST, longest: int = LONGEST, absorbed: int = ABSORBED, block: int = BLOCK) -> DataFrame:
    """The phrases of 2 to ``longest`` words that occur ``least`` times and aren't absorbed by a longer one.

    Columns: group, phrase, a (its count), l and r (the counts of both parts of
    its lowest cut), n (words of the group), score = floor(SCALE * a / (l + r)).
    Words are lower-cased (A to Z), parted by spaces and tabs; phrases lie within
    pieces, which end at any of . , ; : ! ? and line ends. A phrase is absorbed
    if a longer candidate that holds it occurs at least ``absorbed`` hundredths as often.

    Defined results: null and empty texts have no words; a null group is ``und``;
    repeated rows count each; an empty table, and one without frequent phrases,
    gives no rows; texts are read whole; further columns, of any name, are ignored.
    """
    tables, totals = frequent_phrases(docs, text, group, least, longest, block)
    out = None
    for size in range(2, len(tables) + 1):
        own = tables[size - 1]
        if size < len(tables):
            # one word more is enough to look at: what lies in a longer phrase lies in one of those within it, which are as frequent
            longer = tables[size]
            most = longer.select(F.col("first").alias("id"), "a").unionByName(longer.select(F.col("second").alias("id"), "a")).groupBy("id").agg(F.max("a").alias("most"))
            within = F.lit(100).cast("decimal(3,0)") * F.col("most").cast("decimal(19,0)") >= F.lit(absorbed).cast("decimal(3,0)") * F.col("a").cast("decimal(19,0)")
            own = own.join(most, "id", "left").where(~F.coalesce(within, F.lit(False)))
        part = own.select("group", "phrase", "a", _lowest_cut(size).alias("cut"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = tables[0].limit(0).select("group", "phrase", "a", F.expr("named_struct('score', a, 'k', 1, 'l', a, 'r', a)").alias("cut"))
    return out.select("group", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")).join(totals, "group")


def top_of_each(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` rows of each group with their rank: by score and count descending, then by phrase in byte order.

    The best of every slice of a group are taken first, so no task sorts a group.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("group", "_slice").orderBy(*order))).where(F.col("rank") <= top).drop("_slice")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("group").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first TOP collocations of every language, from all whole documents."""
    found = top_of_each(collocations(spread(table(spark, sf_dir, "documents"))))
    return found.select(F.col("group").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")


#: All phrases counted as strings, every cut, and every phrase within each longer one.
ORACLE_SQL = {
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (
  SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), words AS (
  SELECT r, lang, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM split
), rows AS (
  SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4 FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
), grams AS (
  SELECT lang, w1 AS g, 1 AS size FROM rows
  UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM rows WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM rows WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM rows WHERE w4 IS NOT NULL
), f AS (
  SELECT lang, g, size, count(*) AS a, string_split(g, ' ') AS ws FROM grams GROUP BY lang, g, size HAVING count(*) >= 30
), totals AS (
  SELECT lang, count(*) AS n FROM rows GROUP BY lang
), cuts AS (
  SELECT lang, g, a, ws, size, unnest(range(1, size)) AS k FROM f WHERE size > 1
), scored AS (
  SELECT c.lang, c.g, c.a, c.k, x.a AS l, y.a AS r, CAST(2000000 AS HUGEINT) * c.a // (x.a + y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = array_to_string(c.ws[1:c.k], ' ') JOIN f y ON y.lang = c.lang AND y.g = array_to_string(c.ws[c.k + 1:], ' ')
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM scored
), inner_phrases AS (
  SELECT lang, array_to_string(ws[s:s + m - 1], ' ') AS g, a FROM (SELECT *, unnest(range(1, size - m + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS m FROM f WHERE size > 2))
), longer AS (
  SELECT lang, g, max(a) AS most FROM inner_phrases GROUP BY lang, g
), ranked AS (
  SELECT lang, g AS phrase, a, l, r, n, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
  FROM lowest LEFT JOIN longer USING (lang, g) JOIN totals USING (lang) WHERE o = 1 AND NOT coalesce(100 * CAST(most AS HUGEINT) >= 80 * CAST(a AS HUGEINT), FALSE)
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""
}
