"""Observations, gates and data tests: one-row aggregates, and frames of offending rows that should be empty."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import REASONS, ratio

FRESH_SECONDS, MOST_QUARANTINED, LOOKBACK_HOURS = 900, 0.005, 24


@dataclass(frozen=True)
class CheckResult:
    name: str
    passed: bool
    severity: str
    facts: dict


def bronze_observation(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count("*").alias("rows"), F.max("ingested_at").alias("last_ingested_at"),
        F.min("kafka_offset").alias("min_offset"), F.max("kafka_offset").alias("max_offset"),
    )


def edits_observation(edits: DataFrame, exact: bool = False) -> DataFrame:
    from ..plans.marts import percentile

    return edits.agg(
        F.count("*").alias("rows"), F.countDistinct("event_id").alias("distinct_event_ids"),
        F.max("event_time").alias("last_event_at"), F.max("ingested_at").alias("last_ingested_at"),
        F.count_if(F.col("domain") == "canary").alias("canary_events"),
        percentile("late_by_seconds", 0.95, exact).alias("late_p95_seconds"),
    )


def quarantine_observation(quarantine: DataFrame) -> DataFrame:
    return quarantine.agg(
        F.count("*").alias("rows"), F.countDistinct("failure_reason").alias("distinct_failure_reasons"),
        F.max("failed_at").alias("last_failed_at"),
    )


def offset_contiguity(bronze: DataFrame) -> DataFrame:
    """Of each partition the rows, the range of offsets and how many offsets are missing (below 0: rows applied twice)."""
    got = bronze.groupBy("kafka_partition").agg(
        F.count("*").alias("rows"), F.min("kafka_offset").alias("min_offset"), F.max("kafka_offset").alias("max_offset")
    )
    return got.withColumn("missing", F.col("max_offset") - F.col("min_offset") + 1 - F.col("rows")).orderBy("kafka_partition")


def watermarks(log: DataFrame) -> DataFrame:
    """Of each partition of a log the low and the high (next) offset."""
    return log.groupBy("partition").agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, n times."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def freshness(edits: DataFrame, now: datetime) -> DataFrame:
    last = F.max("event_time")
    return edits.agg(((F.unix_micros(F.lit(now)) - F.unix_micros(last)) / 1_000_000).alias("lag_seconds"), last.alias("last_event_at"))


def freshness_level(df: DataFrame, now: datetime, column: str = "ingested_at", warn: int = FRESH_SECONDS, error: int = 4 * FRESH_SECONDS) -> DataFrame:
    """lag_seconds and level (pass, warn, error) of a source; one without rows is an error."""
    lag = (F.unix_micros(F.lit(now)) - F.unix_micros(F.max(column))) / 1_000_000
    level = F.when(F.col("lag_seconds").isNull() | (F.col("lag_seconds") > error), "error").when(F.col("lag_seconds") > warn, "warn").otherwise("pass")
    return df.agg(lag.alias("lag_seconds")).withColumn("level", level)


def context(bronze: DataFrame, edits: DataFrame, quarantine: DataFrame) -> DataFrame:
    """fact, n: what the gate's result is read beside. Bronze may hold an event more than once, as records may come twice."""

    def facts(name: str, df: DataFrame, key) -> DataFrame:
        got = df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("keys"))
        pairs = ((f"{name}_rows", F.col("rows")), (f"{name}_repeated", F.col("rows") - F.col("keys")))
        return got.select(F.inline(F.array(*(F.struct(F.lit(k).alias("fact"), v.alias("n")) for k, v in pairs))))

    place = F.concat_ws(":", "kafka_partition", "kafka_offset")
    return facts("bronze", bronze, place).unionByName(facts("edits", edits, F.col("event_id"))).unionByName(facts("quarantine", quarantine, place))


def canaries_last_hour(edits: DataFrame, now: datetime) -> DataFrame:
    """Heartbeats and rows of the hour before now's: by the wall clock, so that a stopped stream isn't judged by its last hour."""
    end = now.replace(minute=0, second=0, microsecond=0)
    hour = edits.where((F.col("event_time") >= F.lit(end - timedelta(hours=1))) & (F.col("event_time") < F.lit(end)))
    return hour.agg(F.count_if(F.col("domain") == "canary").alias("canary_events"), F.count("*").alias("rows"))


def quarantine_rate(edits: DataFrame, quarantine: DataFrame, now: datetime, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Edits and rejects ingested in the hours before now, and the share of rejects: one row, each table aggregated first."""
    since = F.lit(now - timedelta(hours=hours))
    a = edits.where(F.col("ingested_at") >= since).agg(F.count("*").alias("edits"))
    b = quarantine.where(F.col("failed_at") >= since).agg(F.count("*").alias("quarantined"))
    both = a.join(b)  # two rows of one line each
    return both.withColumn("rate", ratio(F.col("quarantined"), F.col("edits") + F.col("quarantined"), 6))


def reasons(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("failure_reason").agg(F.count("*").alias("n"))


def unknown_reasons(quarantine: DataFrame, known: tuple[str, ...] = REASONS) -> DataFrame:
    """Reasons that no rule gives; a null counts as unknown, which a plain NOT IN would miss."""
    return reasons(quarantine.where(F.col("failure_reason").isNull() | ~F.col("failure_reason").isin(*known)))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child whose key, not null, parent lacks."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti").select(*child.columns)


def nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many nulls each column has."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))


def not_accepted(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def split_not_exhaustive(mart: DataFrame) -> DataFrame:
    rest = F.col("events") - F.col("bot_events") - F.col("human_events")
    return mart.select("event_hour", "wiki", "events", "bot_events", "human_events", rest.alias("unaccounted_events")).where(
        "unaccounted_events != 0"
    )


def change_type_missing(stg: DataFrame) -> DataFrame:
    return stg.where(F.col("change_type").isNull() & ~F.col("is_canary")).select("event_id", "event_time", "domain", "change_type")


def domain_not_observed(dim: DataFrame, stg: DataFrame, cutoff: datetime) -> DataFrame:
    """Wikis whose primary domain was never seen, or whose count of domains is wrong, recounted from staging."""
    seen = stg.where(~F.col("is_canary") & (F.col("ingested_at") < F.lit(cutoff)))
    pairs = seen.select("wiki", F.col("domain").alias("seen_domain")).distinct()
    counts = seen.groupBy("wiki").agg(F.countDistinct("domain").alias("observed_domain_count"))
    d = dim.select("wiki", "primary_domain", "domain_count")
    joined = d.join(
        pairs.withColumnRenamed("wiki", "w"), (F.col("wiki") == F.col("w")) & (F.col("primary_domain") == F.col("seen_domain")), "left"
    ).join(counts, "wiki", "left")
    bad = F.col("seen_domain").isNull() | (F.col("domain_count") != F.col("observed_domain_count"))
    return joined.where(bad).select("wiki", "primary_domain", "domain_count", "observed_domain_count")


def overcounted(mart: DataFrame, stg: DataFrame) -> DataFrame:
    """Minutes for which the mart claims more events than staging has."""
    have = stg.where(~F.col("is_canary")).groupBy("event_minute", "wiki", "change_type").agg(F.count("*").alias("silver_events"))
    both = mart.select("event_minute", "wiki", "change_type", F.col("events").alias("mart_events")).join(
        have, ["event_minute", "wiki", "change_type"], "left"
    )
    return both.where(F.col("mart_events") > F.coalesce("silver_events", F.lit(0)))


def rank_gaps(mart: DataFrame) -> DataFrame:
    """Hours and wikis whose ranks aren't 1 to n, each once."""
    got = mart.groupBy("event_hour", "wiki").agg(
        F.count("*").alias("n"), F.min("rank_in_wiki").alias("low"), F.max("rank_in_wiki").alias("high"),
        F.countDistinct("rank_in_wiki").alias("distinct_ranks"),
    )
    return got.where("low != 1 OR high != n OR distinct_ranks != n")


def no_duplicates_gate(edits: DataFrame, quarantine: DataFrame, allow_empty: bool = False) -> list[CheckResult]:
    """The gate on silver: unique and non-null keys, times present, not empty."""
    row = nulls(edits, ["event_id", "event_time"]).first()
    facts = {
        "duplicate_event_ids": duplicate_keys(edits.where("event_id IS NOT NULL"), ["event_id"]).count(),
        "null_event_ids": row["event_id"],
        "null_event_times": row["event_time"],
        "duplicate_quarantine_keys": duplicate_keys(quarantine, ["kafka_partition", "kafka_offset"]).count(),
    }
    out = [CheckResult(k, v == 0, "error", {"n": v}) for k, v in facts.items()]
    return [*out, CheckResult("not_empty", allow_empty or not edits.isEmpty(), "error", {})]


def as_rows(spark, results: list[CheckResult]) -> DataFrame:
    """name, passed, severity of check results."""
    return spark.createDataFrame([(r.name, bool(r.passed), r.severity) for r in results], "name string, passed boolean, severity string")


def run_checks(bronze: DataFrame, edits: DataFrame, quarantine: DataFrame, marts: dict[str, DataFrame], now: datetime) -> list[CheckResult]:
    """The standing checks, each with its severity."""
    out = []
    gaps = [r.asDict() for r in offset_contiguity(bronze).where("missing != 0").limit(100).collect()]
    out.append(CheckResult("bronze_offsets_are_contiguous", not gaps, "error", {"gaps": gaps}))
    lag = freshness(edits, now).first()["lag_seconds"]
    out.append(CheckResult("silver_edits_are_fresh", lag is not None and lag <= FRESH_SECONDS, "warn", {"lag_seconds": lag}))
    c = canaries_last_hour(edits, now).first()
    out.append(CheckResult("canary_heartbeat_was_received", c["rows"] == 0 or c["canary_events"] > 0, "error", c.asDict()))
    q = quarantine_rate(edits, quarantine, now).first()
    out.append(CheckResult("quarantine_rate_is_low", (q["rate"] or 0) <= MOST_QUARANTINED, "warn", q.asDict()))
    odd = [r.asDict() for r in unknown_reasons(quarantine).limit(100).collect()]
    out.append(CheckResult("quarantine_reasons_are_known", not odd, "error", {"unknown": odd}))
    out += [CheckResult(f"{n}_is_not_empty", not m.isEmpty(), "warn", {}) for n, m in marts.items()]
    return out
