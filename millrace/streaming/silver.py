"""Silver over bucketed tables: each trigger moves its own rows only, and counts them while they are written.

Two writes a batch, one for edits and one for rejects. What the batch had and what was new is observed in these (no job of its own),
so a batch that is run again after a crash finds its rows stored and appends what is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions import wire
from ..operators import medallion
from ..plans.scratch import held
from ..sources import layout
from . import jobs


def tables(spark: SparkSession, root: str, buckets: int) -> dict[str, str]:
    """Names of the edits table and the quarantine table, bucketed by their keys."""
    return {
        "edits": layout.bucketed(spark, f"{root}/edits", wire.EDITS, wire.EDITS_KEY, buckets),
        "quarantine": layout.bucketed(spark, f"{root}/quarantine", wire.QUARANTINE, wire.QUARANTINE_KEY, buckets),
    }


def merge_batch(frames: DataFrame, batch_id: int, root: str, buckets: int = 64) -> dict[str, int]:
    """Judges a batch and merges both halves; rows that are stored already are left as they are."""
    spark = frames.sparkSession
    names = tables(spark, root, buckets)
    with held(medallion.candidates(frames), root) as judged:
        bad = F.col("failure_reason").isNotNull()
        seen = Observation()
        counted = judged.observe(seen, F.count_if(~bad).alias("valid"), F.count_if(bad).alias("rejected"))
        edits = layout.insert_absent(names["edits"], medallion.valid_rows(counted), wire.EDITS_KEY)
        quarantine = layout.insert_absent(names["quarantine"], medallion.quarantine_rows(judged), wire.QUARANTINE_KEY)
        return {"batch_id": batch_id, **seen.get, "new_edits": edits["new"], "new_quarantine": quarantine["new"]}


def start(log: DataFrame, root: str, checkpoints: str, once: bool = False, buckets: int = 64) -> StreamingQuery:
    """The query of the log's records; with once it ends when all that is there is done.

    The records are observed as they are read: the query's progress has `frames` and their bytes, see Observed."""
    rows = medallion.frames_from_log(log)
    sizes = F.coalesce(F.sum(F.octet_length("raw_payload")), F.lit(0)).alias("bytes")
    seen = rows.observe(jobs.SILVER, F.count("*").alias("frames"), sizes, F.max("ingested_at").alias("last_ingested_at"))
    return jobs._start(seen, jobs.SILVER, checkpoints, lambda b, i: merge_batch(b, i, root, buckets) and None, once)


class Observed(StreamingQueryListener):
    """Keeps what queries observed, a dict for each trigger that had rows: name of the query, batch, and its metrics."""

    def __init__(self, most: int = 10_000) -> None:
        self.most, self.rows = most, []

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in p.observedMetrics.items():
            self.rows.append({"query": p.name, "batch_id": p.batchId, "observed": name, **row.asDict()})
        del self.rows[: -self.most]

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...
