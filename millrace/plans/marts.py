"""Staging views and the five marts, as functions of DataFrames. Each takes its cutoff as an argument: rows
ingested at or after it aren't seen, so that all marts of a run see the same rows and a rerun gives the same result."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import ratio

EPOCH = datetime(1970, 1, 1)


def stg_edits(edits: DataFrame) -> DataFrame:
    """The columns that marts may use, time buckets, and the canary flag (null domain: null, which filters drop)."""
    return edits.select(
        "event_id", "event_time",
        F.date_trunc("minute", "event_time").alias("event_minute"), F.date_trunc("hour", "event_time").alias("event_hour"),
        "event_date", (F.col("domain") == "canary").alias("is_canary"), "wiki", "domain", "change_type", "namespace_id",
        "is_article", "page_title", "page_url", "editor", "is_bot", "is_minor", "is_anonymous", "bytes_old", "bytes_new",
        "bytes_delta", "late_by_seconds", "ingested_at",
    )


def stg_quarantine(quarantine: DataFrame) -> DataFrame:
    return quarantine.select(
        "event_id", "failure_reason", "kafka_partition", "kafka_offset", "failed_at",
        F.date_trunc("hour", "failed_at").alias("failed_hour"), "ingest_date",
    )


def _edits(stg: DataFrame, cutoff: datetime, bucket: str | None = None, since: datetime | None = None) -> DataFrame:
    """Edits proper before the cutoff, from a bucket on: with the partition column bounded as well, for pruning."""
    seen = stg.where(~F.col("is_canary") & (F.col("ingested_at") < F.lit(cutoff)))
    if since is not None:
        seen = seen.where((F.col("event_date") >= F.lit(since.date())) & (F.col(bucket) >= F.lit(since)))
    return seen


def _signed(x: Column) -> tuple[Column, Column]:
    zero = F.lit(0)
    return F.sum(F.coalesce(F.greatest(x, zero), zero)), F.sum(F.coalesce(F.least(x, zero), zero))


def _counts(**conditions: Column) -> list[Column]:
    return [F.count_if(c).alias(n) for n, c in conditions.items()]


def dim_wikis(stg: DataFrame, cutoff: datetime) -> DataFrame:
    """One row a wiki. Counted by (wiki, domain) first, so that the most frequent domain (of ties the last by
    name) needs no second scan; all else is additive."""
    more, less = _signed(F.col("bytes_delta"))
    sums = ["bot_events", "article_events", "anonymous_events", "events_with_bytes", "bytes_added", "bytes_removed"]
    inner = _edits(stg, cutoff).groupBy("wiki", "domain").agg(
        F.count("*").alias("events"), F.min("event_time").alias("first_seen_at"), F.max("event_time").alias("last_seen_at"),
        *_counts(
            bot_events=F.col("is_bot"), article_events=F.col("is_article"), anonymous_events=F.col("is_anonymous"),
            events_with_bytes=F.col("bytes_delta").isNotNull(),
        ),
        more.alias("bytes_added"), less.alias("bytes_removed"),
    )
    outer = inner.groupBy("wiki").agg(
        F.max_by("domain", F.struct("events", "domain")).alias("primary_domain"), F.count("*").alias("domain_count"),
        F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"),
        F.sum("events").alias("total_events"), *(F.sum(c).alias(c) for c in sums),
    )
    total = F.col("total_events")
    return outer.select(
        "wiki", F.lit(cutoff).alias("built_through"), "primary_domain", "domain_count", "first_seen_at", "last_seen_at",
        "total_events", "bot_events", (total - F.col("bot_events")).alias("human_events"), "article_events", "anonymous_events",
        "events_with_bytes", "bytes_added", "bytes_removed", (F.col("bytes_added") + F.col("bytes_removed")).alias("bytes_net"),
        ratio(F.col("bot_events"), total).alias("bot_share"), ratio(F.col("article_events"), total).alias("article_share"),
    )


def edits_per_minute(stg: DataFrame, cutoff: datetime, since: datetime | None = None) -> DataFrame:
    more, less = _signed(F.col("bytes_delta"))
    return _edits(stg, cutoff, "event_minute", since).groupBy("event_minute", "wiki", "change_type").agg(
        F.count("*").alias("events"), F.countDistinct("editor").alias("distinct_editors"),
        F.countDistinct("page_title").alias("distinct_pages"),
        *_counts(
            bot_events=F.col("is_bot"), article_events=F.col("is_article"), events_with_bytes=F.col("bytes_delta").isNotNull()
        ),
        more.alias("bytes_added"), less.alias("bytes_removed"),
    )


def bot_vs_human_hourly(stg: DataFrame, cutoff: datetime, since: datetime | None = None) -> DataFrame:
    bot, human, sized = F.col("is_bot"), ~F.col("is_bot"), F.col("bytes_delta").isNotNull()
    delta = F.coalesce("bytes_delta", F.lit(0))
    split = _edits(stg, cutoff, "event_hour", since).groupBy("event_hour", "wiki").agg(
        F.count("*").alias("events"), *_counts(bot_events=bot, human_events=human),
        F.countDistinct(F.when(bot, F.col("editor"))).alias("bot_editors"),
        F.countDistinct(F.when(human, F.col("editor"))).alias("human_editors"),
        *_counts(bot_events_with_bytes=bot & sized, human_events_with_bytes=human & sized),
        F.sum(F.when(bot, delta).otherwise(0)).alias("bot_bytes_net"),
        F.sum(F.when(human, delta).otherwise(0)).alias("human_bytes_net"),
    )
    return split.withColumn("bot_share", ratio(F.col("bot_events"), F.col("events")))


def top_pages_hourly(stg: DataFrame, cutoff: datetime, since: datetime | None = None, top: int = 10) -> DataFrame:
    """The most edited pages of each wiki and hour; ties by title. The rank filter limits groups before the shuffle's sort."""
    pages = _edits(stg, cutoff, "event_hour", since).where(F.col("page_title").isNotNull())
    counted = pages.groupBy("event_hour", "wiki", "page_title").agg(
        F.max("page_url").alias("page_url"), F.count("*").alias("events"), F.countDistinct("editor").alias("distinct_editors"),
        *_counts(bot_events=F.col("is_bot")), F.bool_or("is_article").alias("is_article"),
        F.sum(F.coalesce("bytes_delta", F.lit(0))).alias("bytes_net"),
    )
    place = Window.partitionBy("event_hour", "wiki").orderBy(F.desc("events"), "page_title")
    ranked = counted.withColumn("rank_in_wiki", F.row_number().over(place)).where(F.col("rank_in_wiki") <= top)
    return ranked.select(
        "event_hour", "wiki", F.col("rank_in_wiki").cast("long").alias("rank_in_wiki"), "page_title", "page_url", "events",
        "distinct_editors", "bot_events", "is_article", "bytes_net",
    )


def percentile(x: str, p: float, exact: bool) -> Column:
    """Approximate (a mergeable sketch of fixed size) in production; exact where results are compared."""
    if exact:
        return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {x})").cast("long")
    return F.percentile_approx(x, p)


def pipeline_health(edits: DataFrame, quarantine: DataFrame, cutoff: datetime, exact: bool = False) -> DataFrame:
    """One row an hour: edits by event time and rejects by ingest time, either may be missing."""
    at = F.lit(cutoff)
    left = edits.where(F.col("ingested_at") < at).groupBy("event_hour").agg(
        F.count("*").alias("events"),
        *_counts(canary_events=F.col("is_canary"), bot_events=~F.col("is_canary") & F.col("is_bot")),
        F.countDistinct("wiki").alias("distinct_wikis"), F.countDistinct("domain").alias("distinct_domains"),
        *_counts(events_without_bytes=F.col("bytes_delta").isNull()),
        F.min("event_time").alias("first_event_at"), F.max("event_time").alias("last_event_at"),
        F.max("ingested_at").alias("last_ingested_at"),
        *(percentile("late_by_seconds", p, exact).alias(f"late_p{q}_seconds") for p, q in ((0.5, 50), (0.95, 95), (0.99, 99))),
        F.max("late_by_seconds").alias("late_max_seconds"),
    )
    right = quarantine.where(F.col("failed_at") < at).groupBy("failed_hour").agg(
        F.count("*").alias("quarantined_events"), F.countDistinct("failure_reason").alias("distinct_failure_reasons")
    )
    both = left.join(right, left["event_hour"] == right["failed_hour"], "full")
    zero = [
        "events", "canary_events", "bot_events", "quarantined_events", "distinct_failure_reasons", "distinct_wikis",
        "distinct_domains", "events_without_bytes",
    ]
    n, bad = F.coalesce("events", F.lit(0)), F.coalesce("quarantined_events", F.lit(0))
    return both.select(
        F.coalesce("event_hour", "failed_hour").alias("bucket_hour"), *(F.coalesce(c, F.lit(0)).alias(c) for c in zero),
        "first_event_at", "last_event_at", "last_ingested_at",
        *(f"late_p{q}_seconds" for q in (50, 95, 99)), "late_max_seconds", ratio(bad, n + bad, 6).alias("quarantine_rate"),
    )


def boundary(target: DataFrame, bucket: str) -> datetime:
    """The newest bucket of a mart, or the epoch: one number for the driver, so that it becomes a literal filter."""
    return target.agg(F.max(bucket)).first()[0] or EPOCH


def touched(stg: DataFrame, bucket: str, since: datetime, cutoff: datetime) -> DataFrame:
    """Buckets that rows ingested in [since, cutoff) fall into, however old: what a late-safe run has to rebuild."""
    new = stg.where((F.col("ingested_at") >= F.lit(since)) & (F.col("ingested_at") < F.lit(cutoff)) & ~F.col("is_canary"))
    return new.select(bucket).distinct()
