"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. The vector of an n-gram binds
(multiplies) the vectors of its letters, each permuted by its place; the vector
of a text bundles (adds) those of its n-grams; the profile of a language
bundles its texts. A text goes to the language whose profile has the largest
cosine with it.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import arrow_map, free_name, quoted, spread, table, texts_of, utf8_crc32
from .textvec import PIECE, code_points, lower_and_kind, mix

#: Components of the vectors.
DIM = 1024
#: Letters in an n-gram.
GRAM = 3
#: Texts per language, on average, that the profiles are learnt from at most.
SAMPLE = 2000
UNKNOWN = "und"
#: Cosine under which a text is in no language that was learnt: four standard deviations of the cosine with a vector that has nothing to do with it.
LEAST_COSINE = 4 / DIM**0.5
#: Letters from which a cosine says so; clean texts of fewer have any.
SHORT = 20
#: Cells of the table that finds the distinct n-grams of a block of texts.
CELLS = 1 << 22
_BLOCK = 1 << 19


@cache
def letter_vector(letter: int, place: int, dim: int) -> np.ndarray:
    """The letter's vector of +1 and -1, rotated by its place in the n-gram."""
    bits = mix(np.arange(dim // 64 + 1, dtype=np.uint64) + np.uint64(letter << 20 | 0x5A17))
    signs = np.unpackbits(bits.view(np.uint8))[:dim].astype(np.int8) * 2 - 1
    return np.roll(signs, place)


def gram_vectors(grams: np.ndarray, dim: int) -> np.ndarray:
    """One row for each n-gram (a row of letters): the bound letter vectors."""
    out = np.ones((len(grams), dim), dtype=np.float32)
    for place in range(grams.shape[1]):
        letters, inverse = np.unique(grams[:, place], return_inverse=True)
        out *= np.stack([letter_vector(int(x), place, dim) for x in letters])[inverse].astype(np.float32)
    return out


def _letters(text: str) -> tuple[np.ndarray, bool]:
    """Code points with 0 for all that isn't a letter, and whether there is a letter."""
    points, word = lower_and_kind(code_points(text))
    keep = word & ~((points >= 48) & (points <= 57)) & (points != 95)
    if keep.any() and int(points.max(initial=0)) > 127:
        odd = np.unique(points[keep & (points > 127)])
        digits = odd[[not chr(int(x)).isalpha() for x in odd]]
        if len(digits):
            keep &= ~np.isin(points, digits)
    return np.where(keep, points, 0).astype(np.uint32), bool(keep.any())


def bundle(texts: list[str], gram: int = GRAM, dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """The vector of every text (all its n-grams, spaces at the ends included), and which texts have a letter.

    Letters are taken in bounded pieces that overlap by gram - 1, so the length of a text doesn't matter.
    """
    out, lettered = np.zeros((len(texts), dim), dtype=np.float32), np.zeros(len(texts), dtype=bool)
    pieces: list[tuple[int, str]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if pieces:
            _bundle(pieces, gram, dim, out, lettered)
            pieces.clear()
            size = 0

    for k, text in enumerate(texts):
        whole = " " + text + " "
        for at in range(0, max(1, len(whole) - gram + 1), PIECE):
            part = whole[at : at + PIECE + gram - 1]
            pieces.append((k, part))
            size += len(part)
            if size >= _BLOCK:
                flush()
    flush()
    return out, lettered


def _bundle(pieces: list[tuple[int, str]], gram: int, dim: int, out: np.ndarray, lettered: np.ndarray) -> None:
    parts = []
    for k, text in pieces:
        letters, some = _letters(text)
        lettered[k] |= some
        parts.append(letters)
    alphabet, codes = np.unique(np.concatenate(parts), return_inverse=True)
    codes, size = codes.astype(np.int64), len(alphabet)
    blank = int(alphabet[0] != 0)  # code -1 if no blank occurs
    begins = np.cumsum([0, *map(len, parts)])
    n = len(codes)
    if n < gram:
        return
    key = np.zeros(n - gram + 1, dtype=np.int64)
    good = np.ones(n - gram + 1, dtype=bool)
    for j in range(gram):
        key = key * size + codes[j : n - gram + 1 + j]
        if not blank and j:  # two blanks in a row say nothing
            good &= (codes[j : n - gram + 1 + j] != 0) | (codes[j - 1 : n - gram + j] != 0)
    for edge in begins[1:-1]:  # n-grams don't run from one piece into the next
        good[max(0, edge - gram + 1) : edge] = False
    owner = np.repeat(np.arange(len(parts)), np.diff(begins))[: n - gram + 1][good]
    key = key[good]
    if not len(key):
        return
    if size**gram <= CELLS:
        seen = np.flatnonzero(np.bincount(key, minlength=size**gram))
        place = np.zeros(size**gram, dtype=np.int64)
        place[seen] = np.arange(len(seen))
        where = place[key]
    else:
        seen, where = np.unique(key, return_inverse=True)
    texts = np.array([k for k, _ in pieces])
    for low in range(0, len(seen), 8192):
        grams = seen[low : low + 8192]
        rows = np.stack([alphabet[grams // size ** (gram - 1 - j) % size] for j in range(gram)], axis=1)
        inside = (where >= low) & (where < low + 8192)
        counts = np.bincount(owner[inside] * len(grams) + where[inside] - low, minlength=len(parts) * len(grams)).reshape(len(parts), len(grams))
        np.add.at(out, texts, counts.astype(np.float32) @ gram_vectors(rows, dim))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE, gram: int = GRAM, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Language names and unit profiles, learnt from about ``sample`` texts of each language.

    The texts are chosen by a hash of key and text, the same on every run. What
    comes to the driver is one vector for each language and partition.
    """
    rows = labelled.where(F.col(lang).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return [], np.zeros((0, dim), dtype=np.float32)
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample / n))])[F.col(lang)]
    chosen = rows.where((F.xxhash64(key, text).bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31)) < share).select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, some = bundle(texts_of(batch), gram, dim)
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        norm = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
        vectors = np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)
        names = sorted(set(langs[some]))
        return pa.RecordBatch.from_pydict({"lang": pa.array(names, pa.string()), "profile": pa.array([vectors[(langs == x) & some].sum(axis=0, dtype=np.float64) for x in names], pa.list_(pa.float64()))})

    parts = arrow_map(chosen, part, "lang string, profile array<double>")
    summed = parts.select("lang", F.posexplode("profile").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    held: dict[str, np.ndarray] = {}
    for r in summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("p")).collect():
        held[r[0]] = np.array([x["value"] for x in r[1]])
    names = sorted(held)
    if not names:
        return [], np.zeros((0, dim), dtype=np.float32)
    profiles = np.round(np.stack([held[x] for x in names]), 6)
    return names, (profiles / np.maximum(np.sqrt((profiles**2).sum(axis=1, keepdims=True)), 1e-12)).astype(np.float32)


def identify(
    docs: DataFrame, names: list[str], profiles: np.ndarray, text: str = "text", keep: tuple[str, ...] = ("doc_id",), gram: int = GRAM, found: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns ``keep`` with lang_pred and score (the cosine, 0 to 1), under the names ``found``, which keep mustn't have.

    Defined results: null, empty and letterless texts are ``und`` with score 0,
    as is everything if no language was learnt; ties go to the name that sorts
    first; repeated rows get equal results; null keys are kept; an empty table
    gives no rows; texts are read whole; further columns are ignored.
    """
    if taken := {x.lower() for x in keep} & {x.lower() for x in found}:
        raise ValueError(f"columns of that name are kept already: {sorted(taken)}")
    dim = profiles.shape[1]
    schema = StructType([*(docs.schema[x] for x in keep), StructField(found[0], StringType()), StructField(found[1], DoubleType())])
    inner = free_name(docs, "_text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, some = bundle(texts_of(batch, inner), gram, dim)
        best, score = np.zeros(len(some), dtype=np.int64), np.zeros(len(some))
        if names:
            norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
            cosine = (vectors @ profiles.T).astype(np.float64) / np.maximum(norm, 1e-12)[:, None]
            best = cosine.argmax(axis=1)
            score = np.clip(cosine.max(axis=1), 0, 1)
        some = some & bool(names)
        label = np.where(some, np.array(names or [UNKNOWN], dtype=object)[best], UNKNOWN)
        return pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), pa.array(label, pa.string()), pa.array(np.where(some, score, 0.0))], [*keep, *found])

    return arrow_map(docs.select(*map(quoted, keep), F.col(text).alias(inner)), run, schema)


def taught(text: Column, lang_pred: Column, score: Column) -> Column:
    """Whether a text may be in a language that was learnt: it has letters, and few of them or a cosine above chance."""
    few = F.length(F.regexp_replace(text, r"\P{L}+", "")) < SHORT
    return F.coalesce((lang_pred != UNKNOWN) & ((score >= LEAST_COSINE) | few), F.lit(False))


def held_out() -> Column:
    """The quarter of documents that is kept from training."""
    return F.coalesce(F.pmod(utf8_crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document; profiles from the documents that aren't held out."""
    docs = spread(table(spark, sf_dir, "documents"))
    names, profiles = learn(docs.where(~held_out()))
    out = identify(docs.withColumn("held_out", held_out()), names, profiles, keep=("doc_id", "held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score")
