"""Streaming jobs: bronze and silver, each its own consumer of the log with its own checkpoint."""

from __future__ import annotations

import json
import os
import signal
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions import wire
from ..operators import medallion
from ..plans.scratch import held
from ..sources.store import Table

BRONZE, SILVER = "bronze", "silver"
TRIGGER = "30 seconds"


def tables(spark: SparkSession, root: str) -> dict[str, Table]:
    """The three tables, made if they aren't there."""
    return {
        "bronze": Table.create(spark, f"{root}/bronze", wire.BRONZE, "ingest_date", wire.ARRIVAL),
        "edits": Table.create(spark, f"{root}/edits", wire.EDITS, "event_date", ("event_time",)),
        "quarantine": Table.create(spark, f"{root}/quarantine", wire.QUARANTINE, "ingest_date", wire.QUARANTINE_KEY),
    }


def _start(rows: DataFrame, name: str, checkpoints: str, each, once: bool) -> StreamingQuery:
    w = rows.writeStream.queryName(name).outputMode("append").option("checkpointLocation", f"{checkpoints}/{name}").foreachBatch(each)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=TRIGGER)
    return w.start()


def start_batches(rows: DataFrame, name: str, checkpoints: str, each, once: bool = False) -> StreamingQuery:
    """A query that gives its batches to each(batch, batch_id), on the processing-time trigger or once over all that is there."""
    return _start(rows, name, checkpoints, each, once)


def update_counts(grouped: DataFrame, out: str, checkpoints: str, once: bool = False) -> StreamingQuery:
    """A streaming aggregate in update mode: what each trigger changed is written with its batch_id, a replayed batch over itself."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    w = grouped.writeStream.queryName("update_counts").outputMode("update").option("checkpointLocation", f"{checkpoints}/update_counts").foreachBatch(each)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=TRIGGER)).start()


def latest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Of what update_counts() wrote, the last row of each group."""
    rest = [c for c in updates.columns if c not in (*keys, "batch_id")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_last")).select(*keys, "_last.*")


def start_bronze(log: DataFrame, root: str, checkpoints: str, once: bool = False) -> StreamingQuery:
    """Appends every record once: the batch's id is committed with its rows, so a replayed batch adds nothing."""
    spark = log.sparkSession
    table = tables(spark, root)["bronze"]

    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.append(batch, (BRONZE, batch_id))

    return _start(medallion.bronze_rows(log), BRONZE, checkpoints, each, once)


def merge_batch(frames: DataFrame, batch_id: int, root: str) -> dict[str, int]:
    """Judges a batch and merges both halves; rows that are stored already are left as they are, so replays add nothing."""
    spark = frames.sparkSession
    t = tables(spark, root)
    with held(medallion.candidates(frames), root) as judged:
        counts = {r["rejected"]: r["n"] for r in medallion.split_counts(judged).collect()}
        new = {
            "edits": t["edits"].insert_absent(medallion.valid_rows(judged), wire.EDITS_KEY),
            "quarantine": t["quarantine"].insert_absent(medallion.quarantine_rows(judged), wire.QUARANTINE_KEY),
        }
    return {"batch_id": batch_id, "valid": counts.get(False, 0), "rejected": counts.get(True, 0), "new_edits": new["edits"], "new_quarantine": new["quarantine"]}


def start_silver(log: DataFrame, root: str, checkpoints: str, once: bool = False) -> StreamingQuery:
    return _start(medallion.frames_from_log(log), SILVER, checkpoints, lambda b, i: merge_batch(b, i, root) and None, once)


def rebuild(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> dict[str, int]:
    """Silver from bronze, by the same code; ingest dates from first to last, inclusive."""
    if first and last and first > last:
        raise ValueError("first is after last")
    bronze = tables(spark, root)["bronze"].scan(first, last)  # opens only files of these dates
    return merge_batch(medallion.frames_from_bronze(bronze), -1, root)


def progress(query: StreamingQuery) -> dict:
    """Of the last trigger: batch id, rows written, end offsets, and how far the furthest source is behind, where sources tell."""
    p = query.lastProgress
    if not p:
        return {}
    behind = [int(s["metrics"]["maxOffsetsBehindLatest"]) for s in p["sources"] if "maxOffsetsBehindLatest" in (s.get("metrics") or {})]
    return {
        "batch_id": p["batchId"], "rows": p["sink"].get("numOutputRows", -1), "input_rows": p["numInputRows"],
        "end_offsets": [s["endOffset"] for s in p["sources"]], "offsets_behind": max(behind, default=None),
    }


class Heartbeat(StreamingQueryListener):
    """Writes the time and batch of each trigger to a file, by a rename."""

    def __init__(self, path: str) -> None:
        self.path = path

    def beat(self, batch_id: int) -> None:
        new = f"{self.path}.{os.getpid()}.{threading.get_ident()}"  # writers don't share a name
        with open(new, "w") as f:
            json.dump({"at": time.time(), "batch_id": batch_id}, f)
        os.replace(new, self.path)

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        self.beat(event.progress.batchId)

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...


def age_seconds(path: str, now: float | None = None) -> float | None:
    """Seconds since the last heartbeat; None if there is none that can be read."""
    try:
        with open(path) as f:
            return (time.time() if now is None else now) - json.load(f)["at"]
    except (OSError, ValueError, KeyError, TypeError):
        return None


def healthy(path: str, most: float = 120.0, now: float | None = None) -> bool:
    """The health check: is there a heartbeat of the last `most` seconds?"""
    age = age_seconds(path, now)
    return age is not None and age <= most


def stop_on_signal(query: StreamingQuery) -> None:
    """SIGTERM and SIGINT end the query once its batch is done."""
    for s in (signal.SIGTERM, signal.SIGINT):
        signal.signal(s, lambda *_: query.stop())


def drop_late(events: DataFrame, how: str, delay: str = "10 minutes") -> DataFrame:
    """The rejected alternatives to exact deduplication, for comparison: state is bounded, and late rows are lost.

    how: within_watermark, watermark (dropDuplicates on key and time), watermark_only (no effect), none.
    """
    if how == "none":
        return events
    w = events.withWatermark("event_time", delay)
    if how == "watermark_only":
        return w
    if how == "within_watermark":
        return w.dropDuplicatesWithinWatermark(["event_id"])
    if how == "watermark":
        return w.dropDuplicates(["event_id", "event_time"])
    raise ValueError(how)
