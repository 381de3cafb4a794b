"""Day partitions: names, resolution, writing, and row-level changes as whole-partition rewrites.

A table of one day is a partition of one dataset, column ``dt``, or, for
suffixes that are no dates, ``suffix``; Spark prunes to the partition, so no
table name is built except where one is asked for.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import NEWS_CLUSTER


def partition_name(base: str, day: Column) -> Column:
    """base_YYYYMMDD."""
    return F.concat(F.lit(base + "_"), F.date_format(day, "yyyyMMdd"))


def partition_date(name: Column) -> Column:
    """The day that a partition name ends with; null for names without one or impossible days."""
    digits = F.regexp_extract(name, r"_(\d{8})$", 1)
    return F.to_date(F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMdd")))


def partition_list(names: DataFrame, base: str, name: str = "name") -> DataFrame:
    """Days of the partitions of ``base``, newest first; names with 'duplicate' in them are no partitions."""
    rows = names.where(F.startswith(F.col(name), F.lit(base + "_")) & ~F.contains(F.col(name), F.lit("duplicate")))
    return rows.select(F.col(name).alias("name"), partition_date(F.col(name)).alias("dt")).where("dt is not null").orderBy(F.desc("dt"), "name")


def latest(days: DataFrame, column: str = "dt") -> DataFrame:
    """One row with the newest day, null if there is none."""
    return days.agg(F.max(column).alias(column))


@dataclass(frozen=True)
class Tables:
    """What a run reads and writes: its day, its entries and flashpoints, and where clusters go."""

    day: str
    entries: DataFrame
    flashpoints: DataFrame
    clusters_path: str


def resolve(spark: SparkSession, root: str, day: str | None = None) -> Tables:
    """The tables of a day (the newest by default) under root; inputs must exist, the output may not.

    A day that isn't written as a date selects by the column ``suffix``.
    """
    entries, flashpoints = (spark.read.parquet(f"{root}/{x}") for x in ("feed_entries", "flash_point"))
    if day is None:
        found = latest(entries.select("dt")).first()[0]
        if found is None:
            raise ValueError("no partition of feed_entries")
        day = str(found)
    is_date = spark.range(1).select(F.try_to_timestamp(F.lit(day), F.lit("yyyy-MM-dd"))).first()[0] is not None
    column = "dt" if is_date else "suffix"
    held = [x.where(F.col(column).cast("string") == day) for x in (entries, flashpoints)]
    if any(not x.take(1) for x in held):
        raise ValueError(f"no input for {day}")
    return Tables(day, *held, f"{root}/news_clusters")


def table_exists(spark: SparkSession, place: str) -> bool:
    """Whether a table of that name is in the catalog, or data at that path."""
    if "/" not in place:
        return spark.catalog.tableExists(place)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def ensure_output(spark: SparkSession, root: str, day: date | None = None) -> str:
    """Make the clusters' table under root if there is none, empty and with its columns; the name of the day's partition, today's by default."""
    path = f"{root}/news_clusters"
    if not table_exists(spark, path):
        spark.createDataFrame([], T.StructType([*NEWS_CLUSTER, T.StructField("dt", T.DateType())])).write.mode("ignore").parquet(path)
    return f"news_clusters_{day or date.today():%Y%m%d}"


def append_topics(topics: DataFrame, path: str) -> None:
    """Add rows (feed_entry_id, iptc_top_level, iptc_path, confidence); what is there stays, repeated rows too."""
    topics.select("feed_entry_id", "iptc_top_level", "iptc_path", "confidence").write.mode("append").parquet(path)


def write_partitions(rows: DataFrame, path: str, by: list[str]) -> None:
    """Replace exactly the partitions that rows hold; the others stay, so a run can be repeated."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def upsert(held: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """held with the rows of new, by key the one that comes last by ``order`` in new; keys of new win."""
    last = new.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_rn = 1").select(*held.columns)
    return held.join(last.select(key), key, "left_anti").select(*held.columns).unionByName(last)


def insert_absent(held: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows of new whose keys held doesn't have, the first by ``order`` for each key."""
    first = new.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_rn = 1").drop("_rn")
    return first.join(held.select(*keys), keys, "left_anti").select(*new.columns)


def merge_sparse(held: DataFrame, changes: DataFrame, key: str, fields: list[str], now: Column) -> DataFrame:
    """held with the non-null fields of changes; updated_at becomes now where a field was given."""
    renamed = changes.select(F.col(key), *[F.col(x).alias(f"_{x}") for x in fields])
    joined = held.join(renamed, key, "left")
    given = F.coalesce(*[F.when(F.col(f"_{x}").isNotNull(), True) for x in fields], F.lit(False))
    rest = [x for x in held.columns if x not in (*fields, "updated_at")]
    return joined.select(*rest, *[F.coalesce(f"_{x}", x).alias(x) for x in fields], F.when(given, now).otherwise(F.col("updated_at")).alias("updated_at"))


#: What a run adds to an entry.
ENRICHED = ("content", "title_en", "hostname", "summary", "entities", "geo_entities", "images")


def reset_enrichment(entries: DataFrame, fields: list[str]) -> DataFrame:
    """entries with the fields set to null, for a run from scratch."""
    kinds = {f.name: f.dataType for f in entries.schema}
    return entries.withColumns({x: F.lit(None).cast(kinds[x]) for x in fields})


def reset(entries: DataFrame, jobs: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the three tables are before the first run: entries without what runs add, no jobs, no runs."""
    return reset_enrichment(entries, [x for x in ENRICHED if x in entries.columns]), jobs.limit(0), runs.limit(0)


def reseed(entries: DataFrame, most: int) -> DataFrame:
    """A small set to try runs on: the first entries of each flashpoint, reset."""
    place = F.row_number().over(Window.partitionBy("flashpoint_id").orderBy("seq", "id"))
    few = entries.where("flashpoint_id is not null").withColumn("_n", place).where(F.col("_n") <= most).drop("_n")
    return reset_enrichment(few, [x for x in ENRICHED if x in few.columns])
