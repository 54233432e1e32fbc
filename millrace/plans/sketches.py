"""Marts whose distinct counts and percentiles are kept as mergeable sketches.

A state has a row for each minute and group, with additive measures beside sketches of fixed size; it is written once for
each run, of the rows that the run saw, and later runs append theirs. Hours and days are unions of what is stored: raw rows are not read
again, and late rows need no bucket rebuilt. Union is idempotent for distinct counts; sums and percentiles need each row in one run only.

Errors: HLL sketches of 2^12 registers have a standard error of 1.04 / sqrt(2^12) = 1.6 %; theta sketches of 4,096 entries are exact
up to that many values and have 1 / sqrt(4096) beyond; KLL sketches of k = 200 are within 1.65 % of the rank, in 99 of 100 cases.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import ratio

#: Size of HLL and theta sketches (a power of two), and of KLL sketches.
LOG_K, KLL_K = 12, 200
#: Bounds that estimates are held to: three standard errors of a count, and the error of a rank.
COUNT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (LOG_K / 2), 0.0165


def within_count(estimate: Column, exact: Column) -> Column:
    """Is the estimate of a distinct count within three standard errors (and half a value)?"""
    return F.abs(estimate - exact) <= exact * F.lit(COUNT_ERROR) + 0.5


def distinct_state(rows: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """keys, and an HLL sketch for each named value (nulls don't count)."""
    return rows.groupBy(*keys).agg(*(F.hll_sketch_agg(v.cast("string"), LOG_K).alias(n) for n, v in values.items()))


def distinct_counts(state: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys, and the estimates of the union of all states of equal keys."""
    return state.groupBy(*keys).agg(*(F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in values))


def edits_state(stg: DataFrame, since: datetime | None, cutoff: datetime) -> DataFrame:
    """The state of the edits ingested in [since, cutoff), a row for each minute, wiki and bot flag."""
    seen = stg.where(~F.col("is_canary") & (F.col("ingested_at") < F.lit(cutoff)))
    if since is not None:
        seen = seen.where(F.col("ingested_at") >= F.lit(since))
    return seen.groupBy("event_minute", "wiki", "is_bot").agg(
        F.count("*").alias("events"), F.count("bytes_delta").alias("events_with_bytes"),
        F.sum(F.coalesce("bytes_delta", F.lit(0))).alias("bytes_net"),
        F.theta_sketch_agg("editor", LOG_K).alias("editors"), F.hll_sketch_agg("page_title", LOG_K).alias("pages"),
        F.kll_sketch_agg_bigint("late_by_seconds", KLL_K).alias("lags"),
    )


def bot_vs_human(state: DataFrame, unit: str = "hour") -> DataFrame:
    """The bot and human mart by hours (or days), from states of any number of runs.

    Editors of either side are unions of theta sketches, so those on both sides are their intersection."""
    bot, human = F.col("is_bot"), ~F.col("is_bot")

    def total(name: str, of: Column) -> Column:
        return F.sum(F.when(of, F.col(name)).otherwise(0))

    def union(of: Column) -> Column:
        return F.theta_union_agg(F.when(of, F.col("editors")), F.lit(LOG_K))

    merged = state.groupBy(F.date_trunc(unit, "event_minute").alias(f"event_{unit}"), "wiki").agg(
        F.sum("events").alias("events"), total("events", bot).alias("bot_events"), total("events", human).alias("human_events"),
        union(bot).alias("b"), union(human).alias("h"), F.hll_sketch_estimate(F.hll_union_agg("pages")).alias("pages"),
        total("events_with_bytes", bot).alias("bot_events_with_bytes"), total("events_with_bytes", human).alias("human_events_with_bytes"),
        total("bytes_net", bot).alias("bot_bytes_net"), total("bytes_net", human).alias("human_bytes_net"),
    )
    return merged.select(
        f"event_{unit}", "wiki", "events", "bot_events", "human_events", F.theta_sketch_estimate("b").alias("bot_editors"),
        F.theta_sketch_estimate("h").alias("human_editors"), F.theta_sketch_estimate(F.theta_intersection("b", "h")).alias("editors_on_both_sides"),
        "pages", "bot_events_with_bytes", "human_events_with_bytes", "bot_bytes_net", "human_bytes_net", ratio(F.col("bot_events"), F.col("events")).alias("bot_share"),
    )


def late_percentiles(state: DataFrame, unit: str = "hour", shares: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """event_<unit>, n, p, value: percentiles of the lag from merged sketches; no bucket's values are gathered."""
    merged = state.groupBy(F.date_trunc(unit, "event_minute").alias(f"event_{unit}")).agg(F.kll_merge_agg_bigint("lags", KLL_K).alias("s"))
    known = merged.where(F.kll_sketch_get_n_bigint("s") > 0)
    each = F.array(*(F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_bigint("s", F.lit(float(p))).alias("value")) for p in shares))
    return known.select(f"event_{unit}", F.kll_sketch_get_n_bigint("s").alias("n"), F.inline(each))


def rank_check(found: DataFrame, rows: DataFrame, keys: list[str], x: str) -> DataFrame:
    """found (keys, p, value) with the exact share of x below and up to value, and within: is p inside these, give or take RANK_ERROR?

    For tests and reports: it reads the rows, counted by value first."""
    counts = rows.where(F.col(x).isNotNull()).groupBy(*keys, F.col(x).alias("_x")).agg(F.count("*").alias("_c"))
    shares = found.join(counts, keys).groupBy(*keys, "p", "value").agg(
        (F.sum(F.when(F.col("_x") < F.col("value"), F.col("_c")).otherwise(0)) / F.sum("_c")).alias("below"),
        (F.sum(F.when(F.col("_x") <= F.col("value"), F.col("_c")).otherwise(0)) / F.sum("_c")).alias("upto"),
    )
    return shares.withColumn("within", (F.col("p") >= F.col("below") - RANK_ERROR) & (F.col("p") <= F.col("upto") + RANK_ERROR))
