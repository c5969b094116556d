"""Audits: table fingerprints, verification of replicas, duplicates, samples, web data, column sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listweave.functions.text import location_cities
from listweave.operators.tables import equal_tables


def fingerprint(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows, smallest and largest key, and nulls by column, in one pass."""
    nulls = F.to_json(F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in sorted(df.columns)]))
    return df.agg(F.count("*").alias("rows"), F.min(key).cast("string").alias("min_key"), F.max(key).cast("string").alias("max_key"), nulls.alias("nulls")).select(F.lit(table).alias("table"), "*")


def fingerprints(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    parts = [fingerprint(df, name, key) for name, (df, key) in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def content_checksum(df: DataFrame) -> DataFrame:
    """Rows and a checksum of their contents that does not depend on their order."""
    h = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).alias("checksum"))


def verify_copy(original: DataFrame, copy: DataFrame) -> DataFrame:
    """Rows that one side lacks, with the side; empty if the copy is exact."""
    return equal_tables(original, copy)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def steady_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """The same ``n`` rows every time: those of the smallest md5 of the key."""
    return df.orderBy(F.md5(F.col(key).cast("string").cast("binary")), key).limit(n)


def steady_sample_per(df: DataFrame, per: str, key: str, n: int) -> DataFrame:
    order = Window.partitionBy(per).orderBy(F.md5(F.col(key).cast("string").cast("binary")), key)
    return df.withColumn("sample_rank", F.row_number().over(order)).where(F.col("sample_rank") <= n)


def not_ascii(df: DataFrame, key: str) -> DataFrame:
    """Keys of rows with a character beyond ASCII in any column."""
    return df.where(F.to_json(F.struct("*")).rlike(r"[^\x00-\x7F]")).select(key)


def orphans(child: DataFrame, parent: DataFrame, foreign: str, key: str) -> DataFrame:
    named = parent.select(F.col(key).alias(foreign)).distinct()
    return child.where(F.col(foreign).isNotNull()).join(named, foreign, "left_anti")


def column_bytes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Total and average bytes of text columns."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.octet_length(F.col(c)).cast("long").alias("n")) for c in columns])
    return df.select(F.explode(each).alias("x")).groupBy("x.column").agg(F.coalesce(F.sum("x.n"), F.lit(0)).alias("total_bytes"), F.round(F.avg("x.n"), 2).alias("average_bytes"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def most_common(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column).limit(n)


def recompute_cities(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results with location_cities derived anew, one row with how many changed)."""
    fresh = results.withColumn("_cities", location_cities("locations_raw"))
    changed = fresh.agg(F.count("*").alias("rows"), F.count_if(~F.col("_cities").eqNullSafe(F.col("location_cities"))).alias("changed"))
    return fresh.withColumn("location_cities", F.col("_cities")).drop("_cities"), changed


def catalogue_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Columns of all tables and views of the session's catalogue."""
    rows = []
    for t in spark.catalog.listTables(database):
        rows += [(t.name, t.tableType, c.name, c.dataType, c.nullable) for c in spark.catalog.listColumns(t.name, database if not t.isTemporary else None)]
    return spark.createDataFrame(rows, "table string, kind string, column string, type string, nullable boolean")


def old_logs(files: DataFrame, at, days: int) -> DataFrame:
    """Runs all of whose files are older than ``days``: files(run_id, path, length, modificationTime)."""
    return files.groupBy("run_id").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest")).where(
        F.col("newest") < at - F.make_dt_interval(days=F.lit(days))
    )
