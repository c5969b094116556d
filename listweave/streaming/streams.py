"""Streams: duplicate removal, event-time windows and sessions, rolling quotas, scans by micro-batch.

Late rows beyond the watermark are dropped; all state is bounded by it.  Results come out through
``foreachBatch`` or a sink of the caller's choice; ``run_available`` drains what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from listweave.operators.cdc import apply_scans
from listweave.shipping import ship
from listweave.sources.store import TableStore


def read_table_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def unique_urls(stream: DataFrame, at: str = "seen_at", delay: str = "1 hour", keys: tuple[str, ...] = ("run_id", "url")) -> DataFrame:
    """Each URL of a run once, within the watermark."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def tumbling_counts(stream: DataFrame, at: str, length: str, keys: list[str], delay: str = "1 hour") -> DataFrame:
    return stream.withWatermark(at, delay).groupBy(F.window(at, length).alias("w"), *keys).agg(F.count("*").alias("rows")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "rows")


def sliding_usage(stream: DataFrame, at: str = "started_at", length: str = "24 hours", step: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Requests and tokens of each provider in overlapping windows."""
    spent = F.coalesce("actual_tokens", "reserved_tokens")
    return stream.withWatermark(at, delay).groupBy(F.window(at, length, step).alias("w"), "provider").agg(F.count("*").alias("requests"), F.sum(spent).alias("tokens")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "provider", "requests", "tokens"
    )


def sessions(stream: DataFrame, at: str, gap: str, keys: list[str], delay: str = "1 hour") -> DataFrame:
    return stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("w"), *keys).agg(F.count("*").alias("rows")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "rows")


def stale_attempts(stream: DataFrame, hours: int = 6) -> DataFrame:
    """Attempts (job_id, status, started_at) that begin to parse and do not end within ``hours`` of event time.

    State per job is the time its parse began; a timer at that time plus ``hours`` reports it.
    """
    ship(stream.sparkSession)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (began,) = state.get
            state.remove()
            yield pd.DataFrame({"job_id": [key[0]], "started_at": [pd.Timestamp(began, unit="ms")], "status": ["stale"]})
            return
        began = state.get[0] if state.exists else None
        for frame in frames:
            for row in frame.sort_values("started_at").itertuples(index=False):
                began = int(row.started_at.value // 1_000_000) if row.status == "parsing" else None
        if began is None:
            if state.exists:
                state.remove()
        else:
            state.update((began,))
            state.setTimeoutTimestamp(max(began + hours * 3_600_000, state.getCurrentWatermarkMs() + 1))

    timed = stream.select("job_id", "status", F.col("started_at").cast("timestamp").alias("started_at")).withWatermark("started_at", "0 seconds")
    return timed.groupBy("job_id").applyInPandasWithState(step, "job_id long, started_at timestamp, status string", "began long", "append", GroupStateTimeout.EventTimeTimeout)


def scan_writer(store: TableStore, at: Column, owner: str = "scan-stream") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: each micro-batch holds finished scans (runs with their targets).

    The batch's runs are judged against the stored state and all four tables move on together, through
    the store's journal: a writer that dies has changed nothing or is carried to its end by the next.
    A batch that comes twice finds its runs no longer pending and changes nothing.  ``owner`` names
    the stream, which finds its own lock again after a crash.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        runs = batch.select("run.*").dropDuplicates(["id"])
        targets = batch.select(F.explode("targets").alias("t")).select("t.*").dropDuplicates(["run_id", "target_name"])
        with store.locked("scans", owner):
            store.finish("scans")
            known = store.read("runs", schema=runs.schema)
            fresh = runs.join(known.select("id"), "id", "left_anti")
            out = apply_scans(store.read("jobs"), known.unionByName(fresh), targets, store.read("scopes"), at)
            events = store.read("events", schema=out["events"].schema)
            new = out["events"].join(events.select("job_id", "run_id", "event_type"), ["job_id", "run_id", "event_type"], "left_anti")
            store.write_together("scans", out | {"events": events.unionByName(new)})

    return write


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None, table: str | None = None, mode: str = "append") -> None:
    """Process what is there in micro-batches, then stop."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True)
    query = (writer.foreachBatch(each) if each else writer.format("memory").queryName(table)).start()
    query.awaitTermination()
