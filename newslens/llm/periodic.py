"""Periodic runs: stretches of words that repeat themselves three times or more.

A run of smallest period q holds an aligned block of words, of a power of two B
with B <= q < 2B (of 8 words where q is smaller), that occurs again q words on.
So for each scale the aligned blocks of a text are the keys of an Aho-Corasick
automaton over integers, the automaton is run across the text, and every
occurrence at a distance of that scale is extended to both sides, word by word
and exactly, as far as words that far apart are equal.

Two things keep this from growing with the square of the text. A block is a key
only if its first eight words come again within twice its size (their hashes
say so), and no occurrence is extended that lies with it in one known run of a
period no longer than the block (its distance is a multiple of that period), nor
one in a known stretch of its own distance.
"""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import arrow_map, free_name, quoted, spread, table, utf8_crc32
from .textvec import mix

#: Words of the smallest blocks; a run has to hold an aligned one twice, so LEAST_WORDS can't be under 3 * FIRST - 1.
FIRST = 8
#: Fewest words of a run, and how many periods it has at least.
LEAST_WORDS, LEAST_PERIODS = 24, 3

RUN = StructType([StructField(x, LongType()) for x in ("start", "length", "period")])


def _again(ids: np.ndarray) -> np.ndarray:
    """For each place the distance to the next one with the same FIRST words, by hash; the number of words where there is none."""
    n = len(ids) - FIRST + 1
    word = mix(ids.astype(np.uint64) + np.uint64(1))
    acc, factor = np.zeros(n, dtype=np.uint64), 1
    for k in range(FIRST):
        factor = factor * 0xD1342543DE82EF95 + 1 & (1 << 64) - 1
        acc += word[k : k + n] * np.uint64(factor)
    order = np.argsort(acc, kind="stable")
    same = acc[order[1:]] == acc[order[:-1]]
    out = np.full(n, len(ids), dtype=np.int64)
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _equal_ahead(ids: np.ndarray, at: int, distance: int) -> int:
    """The first place from ``at`` on whose word isn't that ``distance`` words on."""
    step, last = 64, len(ids) - distance
    while at < last:
        end = min(last, at + step)
        differ = ids[at:end] != ids[at + distance : end + distance]
        if (k := int(differ.argmax())) or differ[0]:
            return at + k
        at, step = end, 2 * step
    return max(at, last)


def _equal_behind(ids: np.ndarray, at: int, distance: int) -> int:
    """The first place of the stretch before ``at`` whose words are those ``distance`` words on."""
    step = 64
    while at > 0:
        begin = max(0, at - step)
        differ = (ids[begin:at] != ids[begin + distance : at + distance])[::-1]
        if (k := int(differ.argmax())) or differ[0]:
            return at - k
        at, step = begin, 2 * step
    return 0


def _occurrences(names: np.ndarray, part: int, starts: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """(distance, start) of every occurrence of the blocks at ``starts`` that is ``nearest`` to twice a block less one word on, in that order.

    A block is FIRST parts of ``part`` words, and a key the names of its parts,
    so the automaton is no deeper for long blocks. The text is handed over once,
    as the names from every offset within a part, one after the other.
    """
    if not len(starts):
        return starts, starts
    size = FIRST * part
    rows = -(-len(names) // part)
    places = np.full((part, rows + 1), -1, dtype=np.int64)  # each line ends in what is no name
    places[:, :rows] = np.arange(rows * part).reshape(rows, part).T
    places[places >= len(names)] = -1
    places = places.ravel()
    text = tuple(np.where(places < 0, int(names.max()) + 1, names[places]).tolist())
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    own: list[list[int]] = []
    for start, block in zip(starts.tolist(), names[starts[:, None] + part * np.arange(FIRST)].tolist(), strict=True):
        number = automaton.get(block := tuple(block), None)
        if number is None:
            number = len(own)
            automaton.add_word(block, number)
            own.append([])
        own[number].append(start)
    automaton.make_automaton()
    found: defaultdict[int, list[int]] = defaultdict(list)
    for end, number in automaton.iter(text):
        found[number].append(end - FIRST + 1)
    distances, begins = [], []
    for number, at in found.items():
        at, begin = np.sort(places[at]), np.array(own[number])
        low, high = np.searchsorted(at, begin + nearest), np.searchsorted(at, begin + 2 * size)
        n = high - low
        if total := int(n.sum()):
            which = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(total)
            begins.append(np.repeat(begin, n))
            distances.append(at[which] - begins[-1])
    if not begins:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    distances, begins = np.concatenate(distances), np.concatenate(begins)
    order = np.lexsort((begins, distances))
    return distances[order], begins[order]


def _doubled(names: np.ndarray, part: int) -> np.ndarray:
    """Names of the stretches of 2 * part words from those of part words: equal for equal stretches, and only for these."""
    return np.unique(names[:-part] * (int(names.max()) + 1) + names[part:], return_inverse=True)[1]


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of word numbers, by start and period."""
    n = len(ids)
    if n < LEAST_WORDS:
        return []
    again = _again(ids)
    if int(again.min()) >= n:
        return []
    runs: dict[tuple[int, int], int] = {}
    names, part, size = ids, 1, FIRST
    while size == FIRST or LEAST_PERIODS * size <= n:
        starts = np.arange(0, n - size + 1, size)
        starts = starts[again[starts] < 2 * size]
        held = [(start, start + length) for (start, length), period in runs.items() if period <= size and length >= 2 * size]
        for begin, end in held:
            starts = starts[(starts < begin) | (starts + 3 * size > end)]
        distances, places = _occurrences(names, part, starts, 1 if part == 1 else size)
        for begin, end in held:
            inside = (places >= begin) & (places + distances + size <= end)
            distances, places = distances[~inside], places[~inside]
        known, upto = 0, 0
        for distance, place in zip(distances.tolist(), places.tolist(), strict=True):
            if distance == known and place < upto:
                continue
            known, upto = distance, _equal_ahead(ids, place + size, distance)
            begin = _equal_behind(ids, place, distance)
            length = upto - begin + distance
            # periods ascend, so one that has the same stretch already divides this one
            if length >= max(LEAST_WORDS, LEAST_PERIODS * distance) and (begin, length) not in runs:
                runs[begin, length] = distance
        names, part, size = _doubled(names, part), 2 * part, 2 * size
    return sorted((start, length, period) for (start, length), period in runs.items())


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stand in no run after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def periodic_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), found: tuple[str, str, str] = ("n_words", "runs", "collapsed")) -> DataFrame:
    """The columns ``keep`` with the number of words, all runs, and the text with each run cut to its first period.

    Words are what white space (space, tab to carriage return) parts. A run is
    (start, length, period), in words and by start, then period: its period is
    its smallest, it has LEAST_WORDS words and LEAST_PERIODS periods at least,
    and no word beside it continues it. The collapsed text is the words left,
    joined by one space.

    Defined results: null, empty and white texts have no words, no run and an
    empty collapsed text; repeated rows get equal results; runs that overlap are
    all given; null keys are kept; an empty table gives no rows; texts are read
    whole; further columns are ignored, and ``found`` may rename the results
    where they clash with ``keep``.
    """
    if taken := {x.lower() for x in keep} & {x.lower() for x in found}:
        raise ValueError(f"columns of that name are kept already: {sorted(taken)}")
    inner = free_name(docs, "_text")
    schema = StructType([*(docs.schema[x] for x in keep), StructField(found[0], LongType()), StructField(found[1], ArrayType(RUN)), StructField(found[2], StringType())])
    kind = pa.list_(pa.struct([(x, pa.int64()) for x in RUN.names]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, all_runs, texts = [], [], []
        for raw in batch.column(inner).cast(pa.binary()).to_pylist():
            words = raw.split() if raw else []  # bytes are split at just these six characters
            numbers: defaultdict[bytes, int] = defaultdict()
            numbers.default_factory = numbers.__len__
            runs = runs_of(np.array([numbers[x] for x in words], dtype=np.int64)) if len(words) >= LEAST_WORDS else []
            counts.append(len(words))
            all_runs.append([dict(zip(RUN.names, x, strict=True)) for x in runs])
            if runs:
                words = [words[k] for k in np.flatnonzero(_kept(len(words), runs)).tolist()]
            texts.append(b" ".join(words))
        columns = [pa.array(counts, pa.int64()), pa.array(all_runs, kind), pa.array(texts, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), *columns], [*keep, *found])

    return arrow_map(docs.select(*map(quoted, keep), F.col(text).alias(inner)), run, schema)


def _looped(doc_id: Column, text: Column) -> Column:
    """The text, but of every tenth document from some word on a repetition of what follows there, as this query's contract has it."""
    h = utf8_crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def loop(words: Column) -> Column:
        n = F.size(words).cast("long")
        first = g % n
        period = 1 + F.floor((n - first) / (3 + g % 8))

        def word(values: Column) -> Column:
            i = values.cast("long")
            return F.element_at(words, (F.when(i < first, i).otherwise(first + (i - first) % period) + 1).cast("int"))

        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), word), " "))

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    # over an array of one, so the words are taken apart once and not for each of them
    return F.when(F.coalesce(h % 10 == 0, F.lit(False)), F.element_at(F.transform(F.array(words), loop), 1)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every whole document, the one of greatest exponent, and digests of all runs and of the collapsed text."""
    docs = spread(table(spark, sf_dir, "documents"))
    found = periodic_runs(docs.select("doc_id", _looped(F.col("doc_id"), F.col("text")).alias("text")))

    def better(best: Column, run: Column) -> Column:
        """The run of greater length / period, exactly; runs come by start and period, so the first of equals stays."""
        ours, theirs = (x["length"].cast("decimal(19,0)") * y["period"].cast("decimal(19,0)") for x, y in ((run, best), (best, run)))
        return F.when(best["period"].isNull() | (ours > theirs), run).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast(RUN), better)
    lines = F.array_join(F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])), "\n")
    digest = F.sha2(F.concat(lines, F.when(F.size("runs") > 0, "\n").otherwise("")), 256)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), digest.alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id",
        "n_runs",
        *(F.col(f"best.{x}").alias(x) for x in RUN.names),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


#: Stretches of equal words at every distance up to a third of the text; of one stretch the smallest period counts. The CRC comes from the table of its polynomial.
ORACLE_SQL = {
    "op11_periodic_runs": r"""
WITH crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t FROM range(256) x(b)
), raw AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), CAST([] AS VARCHAR[])) AS w,
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT)) AS b FROM documents
), hashed AS (
  SELECT k, doc_id, w, CAST(len(w) AS BIGINT) AS n, xor(list_reduce(b, lambda c, x: xor(t[CAST(xor(c, x) & 255 AS INT) + 1], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM raw, crc_table
), planned AS (
  SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM hashed
), docs AS (
  SELECT k, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM planned
), words AS (
  SELECT k, n, unnest(w) AS word, unnest(range(n)) AS i FROM docs
), equal AS (
  SELECT x.k, x.i, y.i - x.i AS d FROM words x JOIN words y ON x.k = y.k AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), islands AS (
  SELECT k, d, i, i - row_number() OVER (PARTITION BY k, d ORDER BY i) AS island FROM equal
), stretches AS (
  SELECT k, min(i) AS s, count(*) + d AS len, d FROM islands GROUP BY k, d, island HAVING count(*) + d >= greatest(24, 3 * d)
), runs AS (
  SELECT k, s, len, min(d) AS q FROM stretches GROUP BY k, s, len
), gone AS (
  SELECT DISTINCT k, unnest(range(s + q, s + len)) AS i FROM runs
), kept AS (
  SELECT k, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (k, i) GROUP BY k
), per AS (
  SELECT k, count(*) AS n_runs, arg_min({'s': s, 'l': len, 'q': q}, o) AS r, string_agg(concat(s, ',', len, ',', q, chr(10)), '' ORDER BY s, q) AS lines
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY CAST(len AS DECIMAL(38, 18)) / q DESC, s, q) AS o FROM runs) GROUP BY k
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, r.s AS start, r.l AS length, r.q AS period, 1000 * r.l // r.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM docs LEFT JOIN per USING (k) LEFT JOIN kept USING (k)"""
}
