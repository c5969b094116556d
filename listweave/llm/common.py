"""Shared helpers: the folder that all machines see, written tables, Arrow maps over texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listweave.shipping import ship

#: Bytes of text that a Python worker holds in numpy arrays at a time; a longer text is held alone.
SLICE_BYTES = 4_000_000
#: Bytes of an Arrow batch between the JVM and a Python worker; a longer row travels alone.
BATCH_BYTES = 4 << 20


def arrow_limits(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, not only by rows, and send the package to the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ship(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset on a local master, a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        where = tempfile.mkdtemp(prefix="listweave-")
        spark.conf.set("spark.checkpoint.dir", where)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme and authority that Spark reads it by."""
    jvm = spark.sparkContext._jvm
    here = jvm.org.apache.hadoop.fs.Path(path)
    return here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(here).toString()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh name in the application's part of the shared folder."""
    return f"{shared_dir(spark)}/listweave/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def storage(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a qualified path, for tasks that read and write files themselves."""
    for given, known in (("s3a://", "s3://"), ("s3n://", "s3://"), ("file:///", "file:///"), ("file:/", "file:///")):
        if uri.startswith(given):
            uri = known + uri[len(given) :]
            break
    return fs.FileSystem.from_uri(uri)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: the lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``written`` from which nothing that is still to be computed derives."""
    for table in tables:
        path = getattr(table, "_scratch", None)
        if path:
            spark = table.sparkSession
            here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(here, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; Spark's cleaner removes it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True where crc32 of the id's text is 0 modulo 5; those rows are never learnt from."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose sizes sum to ``limit`` at most (one row at least)."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def map_rows(df: DataFrame, schema: str, f: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """Apply ``f`` to slices of Arrow batches; it returns a column for each field of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            per_row = max(1, batch.nbytes // batch.num_rows)
            step = max(1, SLICE_BYTES // per_row)
            for start in range(0, batch.num_rows, step):
                columns = f(batch.slice(start, step))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[x.name], type=x.type) for x in arrow], schema=arrow
                )

    arrow_limits(df.sparkSession)
    return df.mapInArrow(run, schema)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]
