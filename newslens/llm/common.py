"""Helpers shared by the operators: table access, shared storage, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..runtime import ARROW_ROWS, ship, spread, stash

__all__ = ["arrow_map", "free_name", "quoted", "slices", "spread", "stash", "table", "texts_of", "utf8_crc32"]

#: Bytes, about, that a function is handed at a time; Spark's own batches are bounded by rows and bytes too.
ARROW_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches cut to about ARROW_ROWS rows and ``size`` bytes (ARROW_BYTES by default); empty ones left out."""
    size = ARROW_BYTES if size is None else size
    for batch in batches:
        step = max(1, min(ARROW_ROWS, batch.num_rows * size // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """mapInArrow over slices of bounded size, columns of any name; fn may return None for "no rows"."""
    ship(df.sparkSession)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if (out := fn(batch.rename_columns(names))) is not None:
                yield out

    # mapInArrow itself can't take all names
    return df.toDF(*(f"c{k}" for k in range(len(names)))).mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that df doesn't have."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column name as F.col and SQL read it whatever its characters."""
    return "`" + name.replace("`", "``") + "`"


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column as Python strings, null as the empty string."""
    return [x or "" for x in batch.column(name).to_pylist()]


def utf8_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null for null."""
    return F.crc32(text.cast("binary"))
