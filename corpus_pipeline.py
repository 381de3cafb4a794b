"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
that the stage before kept. All but the last return the columns of documents;
further columns of their input go. An empty table goes through as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import decontam, langid, neardup, packing, pii
from newslens.llm.common import spread, stash, table
from newslens.runtime import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that the corpus teaches: those with letters whose best cosine is above chance, or too short to tell.

    Null, empty and letterless texts go, and everything if no language is
    given; equal rows stay or go together; null ids and languages are kept.
    """
    ship(spark)
    names, profiles = langid.learn(docs.where(~langid.held_out()))
    found = langid.identify(docs, names, profiles, keep=tuple(COLUMNS))
    return found.where(langid.taught(F.col("text"), F.col("lang_pred"), F.col("score"))).select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the smallest doc_id.

    Of equal rows one stays; rows without an id are compared with each other;
    a null text is like no other.
    """
    ship(spark)
    return neardup.keep_one(docs).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark, or a whole item of it that is shorter than a passage.

    Null and empty texts stay, and everything if the benchmark is empty; equal
    rows stay or go together.
    """
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), short=True).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; n_chars follows the text.

    All rows stay; a null text stays null, and its n_chars becomes null.
    """
    ship(spark)
    clean = pii.redact(docs.select(*COLUMNS), pii.learn(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into byte-level sequences: a row for each piece, with its bin and place.

    A null or empty text is a piece of one token; equal rows are packed each for itself.
    """
    ship(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminate),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: SQL can't express the profiles, signatures and best fit; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    docs = spread(table(spark, sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
