"""Sharding by jump consistent hash.

``shard`` maps stable integer keys to shards with the jump consistent hash of
Lamping and Veach: no ring table, and a further shard takes rows only into
itself. Rows are then numbered gaplessly within their shard.

Defined results: a null key counts as key 0; a null text has size 1 and no
CRC; repeated rows share a shard and take neighbouring slots; an empty table
gives no rows; further columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stash, table, utf8_crc32

SHARDS = 8
#: Copies of one row that a single array may hold while they are numbered.
RUN = 65536


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of unsigned 64-bit keys."""
    key, b, j = keys.astype(np.uint64, copy=True), np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
    live = np.arange(len(keys))
    while len(live):
        b[live] = j[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        j[live] = np.minimum((b[live] + 1) * step, 1 << 62).astype(np.int64)
        live = live[j[live] < shards]
    return b


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a long key, from 0 to shards - 1; null counts as 0."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")

    @F.pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64).view(np.uint64), shards).astype(np.int32))

    return of(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def number_rows(rows: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... within each value of ``group`` by ``order`` (nulls first), without a task for a whole group.

    The rows are cut into as many ranges as Spark shuffles to, by all ordering columns together, so
    many different rows of one key are several ranges; rows are numbered within
    a range and shifted by the counts of the ranges before. Repeated rows are
    counted before the shuffle and expanded afterwards, so that many copies don't
    meet in one task. ``order`` has to tell apart all rows of a group that differ.
    """
    names = rows.columns
    by = [F.col(c).asc_nulls_first() for c in order]
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    # written, so that the numbers of the ranges are the same whenever they are read
    ranged = stash(counted.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()), "slots")
    totals = ranged.groupBy(group, "_range").agg(F.sum("_n").alias("_total"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each value of group and range
    offsets = totals.select(F.col(group).alias("_g"), F.col("_range").alias("_r"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy(group, "_range").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ranged.withColumn("_start", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
        .join(F.broadcast(offsets), F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
        .withColumn("_start", F.col("_start") + F.col("_offset"))
    )
    single = placed.where("_n = 1").select(*names, F.col("_start").alias(out))
    many = placed.where("_n > 1").withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / RUN).cast("long"))))
    many = many.withColumn("_k", F.explode(F.sequence(F.col("_run") * RUN, F.least((F.col("_run") + 1) * RUN, F.col("_n")) - 1)))
    return single.unionByName(many.select(*names, (F.col("_start") + F.col("_k")).alias(out)))


def shard(rows: DataFrame, key: str, shards: int, grown: int | None = None) -> DataFrame:
    """Add ``shard`` of ``shards``, and ``grown_shard`` of ``grown`` if given."""
    out = rows.withColumn("shard", jump_shard(F.col(key), shards))
    return out if grown is None else out.withColumn("grown_shard", jump_shard(F.col(key), grown))


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 8 shards by its doc_id, numbered within the shard by (doc_id, size, CRC).

    Defined results: a null doc_id is sharded as key 0 and stays null; a null
    text has size 1 and a null CRC, an empty one size 1 and CRC 0; equal rows
    share a shard and take neighbouring slots, nulls come first; an empty table
    gives no rows; texts are measured whole; further columns are ignored.
    """
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        utf8_crc32(F.col("text")).alias("text_crc32"),
    )
    placed = shard(docs, "doc_id", SHARDS, SHARDS + 1)
    numbered = number_rows(placed, "shard", ["doc_id", "size", "text_crc32"], "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


#: Jump hash with 128-bit integers, and the CRC from the UTF-8 bytes by the table of its polynomial.
ORACLE_SQL = {
    "op3_jump_shards": """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t FROM range(256) x(b)
), points AS (
  SELECT doc_id, text, list_transform(string_split(text, ''), lambda c: CAST(unicode(c) AS BIGINT)) AS p FROM documents
), utf8 AS (
  SELECT doc_id, text, flatten(list_transform(p, lambda u: CASE WHEN u < 128 THEN [u] WHEN u < 2048 THEN [192 + (u >> 6), 128 + (u & 63)] WHEN u < 65536 THEN [224 + (u >> 12), 128 + ((u >> 6) & 63), 128 + (u & 63)]
    ELSE [240 + (u >> 18), 128 + ((u >> 12) & 63), 128 + ((u >> 6) & 63), 128 + (u & 63)] END)) AS b FROM points
), sized AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size,
    CASE WHEN text = '' THEN 0 WHEN text IS NOT NULL THEN xor(list_reduce(b, lambda c, x: xor(t[CAST(xor(c, x) & 255 AS INT) + 1], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295) END AS text_crc32 FROM utf8, crc_table
), jump(k, n, key, b, j) AS (
  SELECT DISTINCT coalesce(doc_id, 0), n, CASE WHEN coalesce(doc_id, 0) < 0 THEN CAST(doc_id AS HUGEINT) + 18446744073709551616 ELSE CAST(coalesce(doc_id, 0) AS HUGEINT) END, CAST(-1 AS BIGINT), CAST(0 AS BIGINT) FROM documents, (VALUES (8), (9)) x(n)
  UNION ALL
  SELECT k, n, key, b, CAST(floor((b + 1) * (2147483648.0::DOUBLE / (CAST(key // 8589934592 AS DOUBLE) + 1))) AS BIGINT)
  FROM (SELECT k, n, (key * 2862933555777941757 + 1) % 18446744073709551616 AS key, j AS b FROM jump WHERE j < n)
), shards AS (
  SELECT k, CAST(max(b) FILTER (n = 8) AS INT) AS shard, CAST(max(b) FILTER (n = 9) AS INT) AS grown_shard FROM jump GROUP BY k
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32 NULLS FIRST) - 1 AS slot, grown_shard
FROM sized JOIN shards ON k = coalesce(doc_id, 0)"""
}
