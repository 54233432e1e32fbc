"""Frames to bronze, and frames to validated edits and quarantine. Pure functions, batch and streaming alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules, wire


def bronze_rows(log: DataFrame) -> DataFrame:
    """Log records (value, topic, partition, offset, timestamp) as bronze rows: the payload verbatim, three fields lifted."""
    raw = log.select(
        F.col("value").cast("string").alias("raw_payload"), "topic", "partition", "offset", "timestamp", F.current_timestamp().alias("now")
    )
    parsed = raw.withColumn("p", F.from_json("raw_payload", wire.PARSED, wire.PARSE_OPTIONS))
    return parsed.select(
        F.col("p.meta.id").alias("event_id"), rules.event_time(F.col("p.meta.dt")).alias("event_time"),
        F.col("p.`$schema`").alias("schema_uri"), "raw_payload", F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"), F.col("now").alias("ingested_at"), F.to_date("now").alias("ingest_date"),
    )


def frames_from_log(log: DataFrame) -> DataFrame:
    """Log records as frames; the whole batch has one ingest time."""
    return log.select(
        F.col("value").cast("string").alias("raw_payload"), F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"), F.current_timestamp().alias("ingested_at"),
    )


def frames_from_bronze(bronze: DataFrame) -> DataFrame:
    """Bronze rows as frames, with the ingest time they were stored with: a replay gives the same rows."""
    return bronze.select(*wire.FRAME_COLUMNS)


def candidates(frames: DataFrame) -> DataFrame:
    """Frames parsed once, flattened, with derived fields and failure_reason; no row is dropped."""
    absent = [c for c in wire.FRAME_COLUMNS if c not in frames.columns]
    if absent:
        raise ValueError(f"frames lack {', '.join(absent)}")
    p = frames.withColumn("p", F.from_json("raw_payload", wire.PARSED, wire.PARSE_OPTIONS))
    flat = p.select(
        *wire.FRAME_COLUMNS,
        (F.col("p").isNull() | F.col(f"p.{wire.CORRUPT}").isNotNull()).alias("_parse_failed"),
        F.col("p.meta.id").alias("event_id"), F.col("p.meta.dt").alias("raw_event_time"),
        rules.event_time(F.col("p.meta.dt")).alias("event_time"),
        F.col("p.wiki").alias("wiki"), F.col("p.meta.domain").alias("domain"), F.col("p.type").alias("change_type"),
        F.col("p.namespace").alias("namespace_id"), (F.col("p.namespace") == 0).alias("is_article"),
        F.col("p.title").alias("page_title"), F.col("p.title_url").alias("page_url"), F.col("p.user").alias("editor"),
        F.col("p.bot").alias("is_bot"), F.col("p.minor").alias("is_minor"),
        rules.is_anonymous(F.col("p.user")).alias("is_anonymous"),
        F.col("p.length.old").alias("bytes_old"), F.col("p.length.new").alias("bytes_new"),
        rules.bytes_delta(F.col("p.length.old"), F.col("p.length.new")).alias("bytes_delta"),
        F.col("p.revision.old").alias("rev_old"), F.col("p.revision.new").alias("rev_new"), F.col("p.comment").alias("comment"),
    )
    timed = flat.withColumns(
        {
            "late_by_seconds": F.unix_timestamp("ingested_at") - F.unix_timestamp("event_time"),
            "event_date": F.to_date("event_time"),
            "ingest_date": F.to_date("ingested_at"),
        }
    )
    return timed.withColumn("failure_reason", rules.failure_reason())


def first_arrival(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...] = wire.ARRIVAL) -> DataFrame:
    """Of rows with equal keys the first in order. A rank of 1 is a group limit, cut before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def valid_rows(judged: DataFrame) -> DataFrame:
    good = first_arrival(judged.where(F.col("failure_reason").isNull()), wire.EDITS_KEY)
    return good.select(*wire.names(wire.EDITS))


def quarantine_rows(judged: DataFrame) -> DataFrame:
    bad = first_arrival(judged.where(F.col("failure_reason").isNotNull()), wire.QUARANTINE_KEY)
    return bad.withColumn("failed_at", F.col("ingested_at")).select(*wire.names(wire.QUARANTINE))


def split_counts(judged: DataFrame) -> DataFrame:
    """rejected boolean, n: both sides of the split counted in one pass."""
    return judged.groupBy(F.col("failure_reason").isNotNull().alias("rejected")).agg(F.count("*").alias("n"))


def insert_absent(target: DataFrame, source: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of source whose keys target lacks: an anti-join on all of target's keys, with no bound on dates, so that
    keys stay unique over the whole history. source must have unique keys."""
    have = target.select(*(F.col(k).alias(f"_t_{k}") for k in keys))
    same = None
    for k in keys:
        c = source[k] == F.col(f"_t_{k}")
        same = c if same is None else same & c
    return source.join(have, same, "left_anti")


def upsert(target: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """target with the rows of new in place of those with equal keys. Keys must not be null."""
    return target.join(new.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(new)


def replace_buckets(target: DataFrame, new: DataFrame, bucket: str) -> DataFrame:
    """target without the buckets that new has, and new: for results, such as the top rows, that can shrink."""
    return target.join(new.select(bucket).distinct(), bucket, "left_anti").select(*target.columns).unionByName(new)
