"""Raw objects: files with their bytes, listings without, and content-addressed pages as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listweave.functions.hashes import object_key


def read_objects(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, content_length, modified_at, content) of the files under a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("content_length"), F.col("modificationTime").alias("modified_at"), "content")


def list_objects(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The same without the bytes, which are not read."""
    return read_objects(spark, folder, pattern).drop("content")


def pages_as_objects(pages: DataFrame, source: Column) -> DataFrame:
    """Pages as raw objects: one object for each key, with length and hash."""
    data = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").alias("job_id"), source.alias("source"), "url", data.alias("content"))
    return rows.withColumns({
        "object_key": object_key("source", "url"), "content_length_bytes": F.octet_length("content").cast("long"), "content_sha256": F.sha2("content", 256),
    }).dropDuplicates(["object_key"])


def write_discovery_pages(pages: DataFrame, folder: str) -> None:
    """Discovery pages, partitioned by source and day so that later scans prune."""
    pages.write.mode("append").partitionBy("source", "crawl_date").parquet(folder)


def write_checked(df: DataFrame, folder: str, key: str) -> int:
    """Write once per key, read back, and compare the count; returns the rows written."""
    unique = df.dropDuplicates([key])
    unique.write.parquet(folder)
    written = df.sparkSession.read.parquet(folder)
    n, keys = written.agg(F.count("*"), F.count_distinct(key)).first()
    if n != keys:
        raise OSError(f"{folder}: {n} rows for {keys} keys")
    return n
