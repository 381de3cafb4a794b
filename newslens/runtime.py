"""Session plumbing: this package on the executors, tables in the folder that a cluster shares, parallel scans."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

#: Rows of a batch handed to Python while a table is written; texts and sets are long, so far fewer than Spark's default.
ARROW_ROWS = 2000
#: Bytes of such a batch; a row that is longer is a batch of its own.
ARROW_BYTES = 16 << 20
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ARROW_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES}
#: Of long rows: a reader holds a row group, and a writer looks at its size after so many rows, so both are bounded.
LONG_ROWS = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
_SHIPPED: set[str] = set()
_FALLBACK: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so Python functions can import it there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="newslens-ship-")) / "newslens_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and there is one machine only (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="newslens-")
    return _FALLBACK[app]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of ARROW_ROWS rows and ARROW_BYTES bytes at most for what runs inside; the session's own settings come back."""
    held = {key: spark.conf.get(key, None) for key in _BATCH}
    for key, most in _BATCH.items():
        if not (held[key] or "").isdigit() or not 0 < int(held[key]) <= most:
            spark.conf.set(key, str(most))
    try:
        yield
    finally:
        for key, value in held.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stash(df: DataFrame, tag: str, options: dict[str, str | int] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors.

    The files go when the application ends. ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/newslens/{tag}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.options(**(options or {})).parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan with a partition for each core at least, for work that costs far more than moving its rows; large tables have them already and stay as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def with_computed(df: DataFrame, column: str, fn: Callable[[list], Sequence[list]], added: StructType) -> DataFrame:
    """df with the columns ``added``: lists of values that fn makes of the values of ``column``, a batch at a time.

    The other columns go through as Arrow has them, so integers beside a null stay exact; columns may have any name.
    """
    ship(df.sparkSession)
    at, inner = df.columns.index(column), [f"c{k}" for k in range(len(df.columns))]
    fields = [StructField(x, f.dataType) for x, f in zip(inner, df.schema, strict=True)]
    schema = StructType([*fields, *(StructField(f"a{k}", f.dataType) for k, f in enumerate(added))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in added]
        for batch in batches:
            made = [pa.array(x, kind) for x, kind in zip(fn(batch.column(at).to_pylist()), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema.names)

    return df.toDF(*inner).mapInArrow(run, schema).toDF(*df.columns, *added.names)
