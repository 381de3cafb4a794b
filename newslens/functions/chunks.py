"""Cutting long texts for models."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship

CHUNK_CHARS = 4000
CHUNK_TOKENS, OVERLAP_TOKENS = 900, 80
#: Characters of texts that are cut at a time; a longer text is alone.
PIECE = 1 << 20


def text_chunks_of(text: str, most: int = CHUNK_CHARS) -> list[str]:
    """Chunks of at most ``most`` characters: whole paragraphs together, long ones by sentence, too long sentences in pieces of that size; nothing is lost."""
    if len(text) <= most:
        return [text] if text.strip() else []
    units: list[tuple[str, str]] = []
    for paragraph in text.split("\n\n"):
        if len(paragraph) <= most:
            units.append((paragraph, "\n\n"))
        else:
            for k, sentence in enumerate(paragraph.split(". ")):
                pieces = [sentence[at : at + most] for at in range(0, max(1, len(sentence)), most)]
                units += [(x, "" if n else ". " if k else "\n\n") for n, x in enumerate(pieces)]
    out, held = [], ""
    for unit, glue in units:
        if held and len(held) + len(glue) + len(unit) > most:
            out.append(held)
            held = unit
        else:
            held = held + glue + unit if held else unit
    out.append(held)
    return [x.strip() for x in out if x.strip()]


def token_chunks_of(text: str, most: int = CHUNK_TOKENS, overlap: int = OVERLAP_TOKENS, encode: Callable[[str], list] = str.split) -> list[str]:
    """Whole sentences packed to ``most`` tokens, each chunk starting with sentences of up to ``overlap`` tokens from the one before.

    An overlap that leaves no room for the next sentence is dropped, so packing
    always goes on; a sentence that is too long itself is cut into windows that
    overlap in tokens.
    """
    out: list[str] = []
    held: list[tuple[str, int]] = []
    fresh = False

    def size() -> int:
        return sum(n for _, n in held)

    for sentence in (x for x in re.split(r"(?<=[.!?])\s+", text.strip()) if x):
        tokens = encode(sentence)
        if len(tokens) > most:
            if fresh:
                out.append(" ".join(x for x, _ in held))
            step = max(1, most - overlap)
            out += [" ".join(map(str, tokens[k : k + most])) for k in range(0, max(1, len(tokens) - overlap), step)]
            held, fresh = [], False
            continue
        if size() + len(tokens) > most:
            if fresh:
                out.append(" ".join(x for x, _ in held))
            kept: list[tuple[str, int]] = []
            for part in reversed(held):
                if sum(n for _, n in kept) + part[1] > overlap:
                    break
                kept.insert(0, part)
            held = kept if sum(n for _, n in kept) + len(tokens) <= most else []
        held.append((sentence, len(tokens)))
        fresh = True
    if fresh:
        out.append(" ".join(x for x, _ in held))
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def text_chunks(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: text_chunks_of(x or ""))


@F.pandas_udf(T.ArrayType(T.StringType()))
def token_chunks(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: token_chunks_of(x or ""))


def each_chunk(docs: DataFrame, cut: Callable[[str], list[str]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, place, chunk): the chunks of every text, one row each, in pieces of bounded size."""
    ship(docs.sparkSession)
    schema = T.StructType([docs.schema[key], T.StructField("place", T.IntegerType()), T.StructField("chunk", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, str]] = []
            size = 0
            for at, x in enumerate(batch.column(1)):
                found = cut(x.as_py() or "")
                rows += [(at, place, chunk) for place, chunk in enumerate(found)]
                size += sum(map(len, found))
                if rows and (size >= PIECE or at + 1 == batch.num_rows):
                    own, places, held = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), pa.array(places, pa.int32()), pa.array(held, pa.string())], schema.names)
                    rows, size = [], 0

    return docs.select(key, text).mapInArrow(run, schema)
