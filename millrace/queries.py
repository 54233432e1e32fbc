"""Named queries over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import rules, wire
from .operators import analysis, checks, medallion, profile, smoke, statements
from .plans import adapter, build, delta, marts, scratch, sketches
from .sources import layout
from .sources import log as record_log
from .sources.store import StoreError, Table, maintain_all
from .streaming import jobs, keyed, silver

CUTOFF = datetime(2024, 1, 28)
NOW = datetime(2024, 1, 20, 12, 30)
EARLIER = datetime(2024, 1, 15)
_CUT, _NOW = f"TIMESTAMP '{CUTOFF}'", f"TIMESTAMP '{NOW}'"

# Edits straight from the table.
_EDITS = """
described AS (
  SELECT *, event_id % 97 = 0 AS canary, event_type IN ('view', 'signup') AS unsized,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events
), edits AS (
  SELECT event_id AS n, 'e' || event_id AS event_id, ts AS event_time,
    CASE WHEN NOT canary THEN 'wiki' || user_id % 7 END AS wiki,
    CASE WHEN canary THEN 'canary' ELSE 'w' || user_id % 7 || '.' || event_id % 2 || '.example' END AS domain,
    CASE WHEN NOT canary THEN CASE event_type WHEN 'view' THEN 'categorize' WHEN 'purchase' THEN 'new' WHEN 'signup' THEN 'log'
      ELSE 'edit' END END AS change_type,
    CASE WHEN NOT canary THEN k % 15 END AS namespace_id, CASE WHEN NOT canary THEN k % 15 = 0 END AS is_article,
    CASE WHEN NOT canary THEN 'P' || k END AS page_title, CAST(NULL AS VARCHAR) AS page_url,
    CASE WHEN NOT canary THEN 'u' || user_id END AS editor, CASE WHEN NOT canary THEN user_id % 5 = 0 END AS is_bot,
    false AS is_anonymous,
    CASE WHEN NOT canary AND NOT unsized AND event_type <> 'purchase' THEN (event_id * 37) % 5000 END AS bytes_old,
    CASE WHEN NOT canary AND NOT unsized THEN CAST(round(value * 100) AS BIGINT) END AS bytes_new,
    (event_id * 7919) % 3600 AS late_by_seconds, ts + to_seconds((event_id * 7919) % 3600) AS ingested_at,
    CAST(ts AS DATE) AS event_date, user_id % 3 AS kafka_partition, event_id * 2 AS kafka_offset
  FROM described
), sized AS (
  SELECT *, CASE WHEN bytes_new IS NULL THEN NULL WHEN bytes_old IS NULL THEN bytes_new ELSE bytes_new - bytes_old END AS bytes_delta
  FROM edits
), stg AS (
  SELECT *, date_trunc('minute', event_time) AS event_minute, date_trunc('hour', event_time) AS event_hour,
    domain = 'canary' AS is_canary FROM sized
)"""
_SEEN = f"NOT is_canary AND ingested_at < {_CUT}"
# Frames with faults; judged has the reason each ought to get.
_JUDGED = (
    _EDITS
    + """, framed AS (
  SELECT *, false AS again FROM sized
  UNION ALL BY NAME
  SELECT * REPLACE (bytes_new + 1 AS bytes_new, bytes_delta + 1 AS bytes_delta, kafka_offset + 1 AS kafka_offset), true AS again
  FROM sized WHERE n % 13 = 0
), judged AS (
  SELECT *, CASE """
    + " ".join(f"WHEN n % {m} = 0 THEN '{name}'" for name, m in adapter.FAULTS.items())
    + """ END AS failure_reason FROM framed
), quarantine AS (
  SELECT CASE WHEN n % 101 = 0 OR n % 103 = 0 THEN NULL ELSE event_id END AS event_id, failure_reason, kafka_partition,
    kafka_offset, ingested_at AS failed_at, date_trunc('hour', ingested_at) AS failed_hour, CAST(ingested_at AS DATE) AS ingest_date
  FROM judged WHERE failure_reason IS NOT NULL
)"""
)


def _edits(spark: SparkSession, d: str) -> DataFrame:
    return adapter.edits(adapter.events(spark, d))


def _stg(spark: SparkSession, d: str) -> DataFrame:
    return marts.stg_edits(_edits(spark, d))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return medallion.candidates(adapter.frames(adapter.events(spark, d)))


def _quarantine(spark: SparkSession, d: str) -> DataFrame:
    return medallion.quarantine_rows(_judged(spark, d))


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        name = f.__name__
        QUERIES[name] = lambda spark, d: adapter.plain(f(spark, d))
        if sql is not None:
            SQL[name] = sql
        return f

    return add


_STG_COLUMNS = (
    "event_id, event_time, event_minute, event_hour, event_date, is_canary, wiki, domain, change_type, namespace_id, is_article, "
    "page_title, page_url, editor, is_bot, is_anonymous, bytes_old, bytes_new, bytes_delta, late_by_seconds, ingested_at"
)


@query(f"WITH {_EDITS} SELECT {_STG_COLUMNS} FROM stg")
def stg_edits(spark, d):
    return _stg(spark, d).drop("is_minor")


@query(f"WITH {_JUDGED} SELECT * FROM quarantine")
def stg_quarantine(spark, d):
    return marts.stg_quarantine(_quarantine(spark, d))


_MEASURES = """count(*) AS events, count(DISTINCT editor) AS distinct_editors, count(DISTINCT page_title) AS distinct_pages,
  CAST(count_if(is_bot) AS BIGINT) AS bot_events, CAST(count_if(is_article) AS BIGINT) AS article_events,
  count(bytes_delta) AS events_with_bytes, CAST(sum(coalesce(greatest(bytes_delta, 0), 0)) AS BIGINT) AS bytes_added,
  CAST(sum(coalesce(least(bytes_delta, 0), 0)) AS BIGINT) AS bytes_removed"""
_MINUTE = f"SELECT event_minute, wiki, change_type, {_MEASURES} FROM stg WHERE {_SEEN} GROUP BY ALL"


@query(f"WITH {_EDITS} {_MINUTE}")
def mart_edits_per_minute(spark, d):
    return marts.edits_per_minute(_stg(spark, d), CUTOFF)


_BOTS = f"""SELECT *, round(CAST(bot_events AS DOUBLE) / nullif(events, 0), 4) AS bot_share FROM (
  SELECT event_hour, wiki, count(*) AS events, CAST(count_if(is_bot) AS BIGINT) AS bot_events,
    CAST(count_if(NOT is_bot) AS BIGINT) AS human_events, count(DISTINCT CASE WHEN is_bot THEN editor END) AS bot_editors,
    count(DISTINCT CASE WHEN NOT is_bot THEN editor END) AS human_editors,
    CAST(count_if(is_bot AND bytes_delta IS NOT NULL) AS BIGINT) AS bot_events_with_bytes,
    CAST(count_if(NOT is_bot AND bytes_delta IS NOT NULL) AS BIGINT) AS human_events_with_bytes,
    CAST(sum(CASE WHEN is_bot THEN coalesce(bytes_delta, 0) ELSE 0 END) AS BIGINT) AS bot_bytes_net,
    CAST(sum(CASE WHEN NOT is_bot THEN coalesce(bytes_delta, 0) ELSE 0 END) AS BIGINT) AS human_bytes_net
  FROM stg WHERE {_SEEN} GROUP BY ALL)"""


@query(f"WITH {_EDITS} {_BOTS}")
def mart_bot_vs_human_hourly(spark, d):
    return marts.bot_vs_human_hourly(_stg(spark, d), CUTOFF)


_TOP = f"""SELECT * FROM (
  SELECT event_hour, wiki, row_number() OVER (PARTITION BY event_hour, wiki ORDER BY events DESC, page_title) AS rank_in_wiki,
    page_title, page_url, events, distinct_editors, bot_events, is_article, bytes_net
  FROM (SELECT event_hour, wiki, page_title, max(page_url) AS page_url, count(*) AS events,
    count(DISTINCT editor) AS distinct_editors, CAST(count_if(is_bot) AS BIGINT) AS bot_events, bool_or(is_article) AS is_article,
    CAST(sum(coalesce(bytes_delta, 0)) AS BIGINT) AS bytes_net FROM stg WHERE {_SEEN} AND page_title IS NOT NULL GROUP BY ALL))
WHERE rank_in_wiki <= 10"""


@query(f"WITH {_EDITS} {_TOP}")
def mart_top_pages_hourly(spark, d):
    return marts.top_pages_hourly(_stg(spark, d), CUTOFF)


_DIM = f"""SELECT wiki, {_CUT} AS built_through, arg_max(domain, (events, domain)) AS primary_domain, count(*) AS domain_count,
  min(a) AS first_seen_at, max(z) AS last_seen_at, CAST(sum(events) AS BIGINT) AS total_events, CAST(sum(b) AS BIGINT) AS bot_events,
  CAST(sum(events) - sum(b) AS BIGINT) AS human_events, CAST(sum(art) AS BIGINT) AS article_events,
  CAST(sum(anon) AS BIGINT) AS anonymous_events, CAST(sum(w) AS BIGINT) AS events_with_bytes, CAST(sum(p) AS BIGINT) AS bytes_added,
  CAST(sum(m) AS BIGINT) AS bytes_removed, CAST(sum(p) + sum(m) AS BIGINT) AS bytes_net,
  round(CAST(sum(b) AS DOUBLE) / nullif(sum(events), 0), 4) AS bot_share,
  round(CAST(sum(art) AS DOUBLE) / nullif(sum(events), 0), 4) AS article_share
FROM (SELECT wiki, domain, count(*) AS events, min(event_time) AS a, max(event_time) AS z, count_if(is_bot) AS b,
  count_if(is_article) AS art, count_if(is_anonymous) AS anon, count(bytes_delta) AS w,
  sum(coalesce(greatest(bytes_delta, 0), 0)) AS p, sum(coalesce(least(bytes_delta, 0), 0)) AS m
  FROM stg WHERE {_SEEN} GROUP BY ALL) GROUP BY wiki"""


@query(f"WITH {_EDITS} {_DIM}")
def dim_wikis(spark, d):
    return marts.dim_wikis(_stg(spark, d), CUTOFF)


@query(
    f"""WITH {_JUDGED}, l AS (
  SELECT event_hour, count(*) AS events, count_if(is_canary) AS canary_events, count_if(NOT is_canary AND is_bot) AS bot_events,
    count(DISTINCT wiki) AS distinct_wikis, count(DISTINCT domain) AS distinct_domains,
    count_if(bytes_delta IS NULL) AS events_without_bytes, min(event_time) AS first_event_at, max(event_time) AS last_event_at,
    max(ingested_at) AS last_ingested_at, quantile_disc(late_by_seconds, 0.5) AS late_p50_seconds,
    quantile_disc(late_by_seconds, 0.95) AS late_p95_seconds, quantile_disc(late_by_seconds, 0.99) AS late_p99_seconds,
    max(late_by_seconds) AS late_max_seconds FROM stg WHERE ingested_at < {_CUT} GROUP BY event_hour
), r AS (
  SELECT failed_hour, count(*) AS q, count(DISTINCT failure_reason) AS reasons FROM quarantine WHERE failed_at < {_CUT} GROUP BY 1
)
SELECT coalesce(event_hour, failed_hour) AS bucket_hour, coalesce(events, 0) AS events,
  CAST(coalesce(canary_events, 0) AS BIGINT) AS canary_events, CAST(coalesce(bot_events, 0) AS BIGINT) AS bot_events,
  coalesce(q, 0) AS quarantined_events, coalesce(reasons, 0) AS distinct_failure_reasons, coalesce(distinct_wikis, 0) AS distinct_wikis,
  coalesce(distinct_domains, 0) AS distinct_domains, CAST(coalesce(events_without_bytes, 0) AS BIGINT) AS events_without_bytes,
  first_event_at, last_event_at, last_ingested_at, late_p50_seconds, late_p95_seconds, late_p99_seconds, late_max_seconds,
  round(CAST(coalesce(q, 0) AS DOUBLE) / nullif(coalesce(events, 0) + coalesce(q, 0), 0), 6) AS quarantine_rate
FROM l FULL JOIN r ON event_hour = failed_hour"""
)
def mart_pipeline_health(spark, d):
    return marts.pipeline_health(_stg(spark, d), marts.stg_quarantine(_quarantine(spark, d)), CUTOFF, exact=True)


# Frames, silver and quarantine


@query(f"WITH {_JUDGED} SELECT kafka_partition, kafka_offset, failure_reason FROM judged")
def validate_reason(spark, d):
    return _judged(spark, d).select("kafka_partition", "kafka_offset", "failure_reason")


_SILVER = """event_id, event_time, wiki, domain, change_type, namespace_id, is_article, page_title, editor, is_bot, is_anonymous,
  bytes_old, bytes_new, bytes_delta, late_by_seconds, ingested_at, event_date"""


@query(f"WITH {_JUDGED} SELECT {_SILVER} FROM judged WHERE failure_reason IS NULL AND NOT again")
def silver_edits(spark, d):
    return medallion.valid_rows(_judged(spark, d)).drop("page_url", "is_minor", "rev_old", "rev_new", "comment")


@query(f"WITH {_JUDGED} SELECT event_id, failure_reason, kafka_partition, kafka_offset, failed_at, ingest_date FROM quarantine")
def silver_quarantine(spark, d):
    return _quarantine(spark, d).drop("raw_payload")


@query(f"WITH {_JUDGED} SELECT failure_reason IS NOT NULL AS rejected, count(*) AS n FROM judged GROUP BY 1")
def split_counts(spark, d):
    return medallion.split_counts(_judged(spark, d))


@query(
    f"""WITH {_JUDGED} SELECT kafka_partition, kafka_offset,
  CASE WHEN n % 101 = 0 OR n % 103 = 0 THEN NULL ELSE event_id END AS event_id,
  CASE WHEN n % 101 = 0 OR n % 107 = 0 OR n % 109 = 0 THEN NULL WHEN n % 127 = 0 THEN TIMESTAMP '1999-01-01'
    WHEN n % 131 = 0 THEN TIMESTAMP '2099-01-01' ELSE event_time END AS event_time,
  CASE WHEN n % 101 <> 0 THEN '/schema/1.0.0' END AS schema_uri FROM judged"""
)
def bronze_rows(spark, d):
    f = adapter.frames(adapter.events(spark, d))
    log = f.select(
        F.col("raw_payload").cast("binary").alias("value"), F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), F.col("kafka_timestamp").alias("timestamp"),
    )
    return medallion.bronze_rows(log).select("kafka_partition", "kafka_offset", "event_id", "event_time", "schema_uri")


@query(
    f"""WITH {_JUDGED} SELECT event_id, bytes_new, kafka_offset FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY
  kafka_partition, kafka_offset) AS r FROM judged WHERE failure_reason IS NULL) WHERE r = 1"""
)
def dedup_first_arrival(spark, d):
    good = _judged(spark, d).where(F.col("failure_reason").isNull())
    return medallion.first_arrival(good, wire.EDITS_KEY).select("event_id", "bytes_new", "kafka_offset")


@query(
    f"""WITH {_EDITS}, t AS (SELECT event_id, bytes_new FROM sized WHERE n % 3 = 0)
SELECT event_id, bytes_new FROM t UNION ALL SELECT event_id, bytes_new + 7 FROM sized s WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE t.event_id = s.event_id)"""
)
def merge_insert_if_absent(spark, d):
    e = _edits(spark, d).select("event_id", "bytes_new")
    old = e.where(F.substring("event_id", 2, 20).cast("long") % 3 == 0)
    new = e.withColumn("bytes_new", F.col("bytes_new") + 7)
    return old.unionByName(medallion.insert_absent(old, new, wire.EDITS_KEY))


@query(
    f"""WITH {_JUDGED} SELECT kafka_partition, kafka_offset, failure_reason, kafka_offset % 5 = 0 AS old FROM quarantine"""
)
def merge_composite_key(spark, d):
    q = _quarantine(spark, d).select("kafka_partition", "kafka_offset", "failure_reason")
    old = q.where(F.col("kafka_offset") % 5 == 0).withColumn("old", F.lit(True))
    new = q.withColumn("old", F.lit(False))
    return old.unionByName(medallion.insert_absent(old, new, wire.QUARANTINE_KEY))


@query(f"WITH {_EDITS} {_MINUTE}")
def incremental_upsert_minute(spark, d):
    """Built up to an earlier cutoff, then the buckets that later rows touch are rebuilt and merged."""
    stg = _stg(spark, d)
    before = marts.edits_per_minute(stg, EARLIER)
    again = marts.touched(stg, "event_minute", EARLIER, CUTOFF)
    new = marts.edits_per_minute(stg.join(again, "event_minute", "left_semi"), CUTOFF)
    return medallion.upsert(before, new, ("event_minute", "wiki", "change_type"))


_BOUNDARY = f"""b AS (SELECT max(event_hour) AS h FROM stg WHERE NOT is_canary AND page_title IS NOT NULL AND ingested_at < TIMESTAMP '{EARLIER}')"""


@query(
    f"""WITH {_EDITS}, {_BOUNDARY}, new AS ({_TOP}), old AS ({_TOP.replace(_CUT, f"TIMESTAMP '{EARLIER}'")})
SELECT * FROM new WHERE event_hour >= (SELECT h FROM b) UNION ALL SELECT * FROM old WHERE event_hour < (SELECT h FROM b)"""
)
def incremental_replace_hour(spark, d):
    """The boundary strategy: hours from the newest one on are replaced as a whole."""
    stg = _stg(spark, d)
    old = marts.top_pages_hourly(stg, EARLIER)
    new = marts.top_pages_hourly(stg, CUTOFF, since=marts.boundary(old, "event_hour"))
    return medallion.replace_buckets(old, new, "event_hour")


# Checks and observations


@query(f"WITH {_JUDGED} SELECT event_id, count(*) AS n FROM judged WHERE failure_reason IS NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return checks.duplicate_keys(_judged(spark, d).where(F.col("failure_reason").isNull()), ["event_id"])


@query(
    f"""WITH {_JUDGED} SELECT kafka_partition, count(*) AS rows, min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset,
  max(kafka_offset) - min(kafka_offset) + 1 - count(*) AS missing FROM judged GROUP BY 1"""
)
def offset_contiguity(spark, d):
    """Over offsets as the adapter gives them, which have gaps."""
    return checks.offset_contiguity(adapter.frames(adapter.events(spark, d)))


@query(f"WITH {_JUDGED} SELECT kafka_partition AS partition, min(kafka_offset) AS low, max(kafka_offset) + 1 AS high FROM judged GROUP BY 1")
def topic_watermarks(spark, d):
    f = adapter.frames(adapter.events(spark, d))
    return checks.watermarks(f.select(F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset")))


@query(
    f"""WITH {_JUDGED}, a AS (SELECT count(*) AS edits FROM sized WHERE ingested_at >= {_NOW} - INTERVAL 24 HOUR),
b AS (SELECT count(*) AS quarantined FROM quarantine WHERE failed_at >= {_NOW} - INTERVAL 24 HOUR)
SELECT edits, quarantined, round(CAST(quarantined AS DOUBLE) / nullif(edits + quarantined, 0), 6) AS rate FROM a, b"""
)
def quarantine_rate(spark, d):
    return checks.quarantine_rate(_edits(spark, d), _quarantine(spark, d), NOW)


@query(f"WITH {_JUDGED} SELECT failure_reason, count(*) AS n FROM quarantine GROUP BY 1")
def quarantine_by_reason(spark, d):
    return checks.reasons(_quarantine(spark, d))


@query(
    f"""WITH {_JUDGED} SELECT failure_reason, count(*) AS n FROM quarantine
WHERE failure_reason IS NULL OR failure_reason NOT IN ('payload_not_json', 'domain_missing') GROUP BY 1"""
)
def unknown_reasons(spark, d):
    return checks.unknown_reasons(_quarantine(spark, d), ("payload_not_json", "domain_missing"))


@query(
    f"""WITH {_EDITS} SELECT CAST(count_if(domain = 'canary') AS BIGINT) AS canary_events, count(*) AS rows FROM stg
WHERE event_time >= TIMESTAMP '2024-01-20 11:00:00' AND event_time < TIMESTAMP '2024-01-20 12:00:00'"""
)
def canary_last_complete_hour(spark, d):
    return checks.canaries_last_hour(_edits(spark, d), NOW)


@query(
    f"""WITH {_EDITS} SELECT (epoch_us({_CUT}) - epoch_us(max(event_time))) / 1000000 AS lag_seconds, max(event_time) AS last_event_at FROM stg"""
)
def freshness_lag(spark, d):
    return checks.freshness(_edits(spark, d), CUTOFF)


@query(
    f"""WITH {_EDITS} SELECT count(*) AS rows, count(DISTINCT event_id) AS distinct_event_ids, max(event_time) AS last_event_at,
  max(ingested_at) AS last_ingested_at, CAST(count_if(domain = 'canary') AS BIGINT) AS canary_events,
  quantile_disc(late_by_seconds, 0.95) AS late_p95_seconds FROM sized"""
)
def edits_observation(spark, d):
    return checks.edits_observation(_edits(spark, d), exact=True)


@query(f"WITH {_JUDGED} SELECT count(*) AS rows, count(DISTINCT failure_reason) AS distinct_failure_reasons, max(failed_at) AS last_failed_at FROM quarantine")
def quarantine_observation(spark, d):
    return checks.quarantine_observation(_quarantine(spark, d))


@query(
    f"""WITH {_JUDGED} SELECT count(*) AS rows, max(ingested_at) AS last_ingested_at, min(kafka_offset) AS min_offset,
  max(kafka_offset) AS max_offset FROM judged"""
)
def bronze_observation(spark, d):
    return checks.bronze_observation(adapter.frames(adapter.events(spark, d)))


@query(
    f"""WITH {_EDITS}, m AS ({_MINUTE}), dim AS (SELECT DISTINCT wiki FROM stg WHERE wiki <> 'wiki3')
SELECT * FROM m WHERE wiki IS NOT NULL AND wiki NOT IN (SELECT wiki FROM dim WHERE wiki IS NOT NULL)"""
)
def relationship_orphans(spark, d):
    stg = _stg(spark, d)
    return checks.orphans(marts.edits_per_minute(stg, CUTOFF), stg.where("wiki != 'wiki3'"), "wiki")


@query(
    f"""WITH {_EDITS}, m AS ({_TOP}) SELECT event_hour, wiki, count(*) AS n, min(rank_in_wiki) AS low, max(rank_in_wiki) AS high,
  count(DISTINCT rank_in_wiki) AS distinct_ranks FROM m WHERE rank_in_wiki <> 2 GROUP BY 1, 2
HAVING min(rank_in_wiki) <> 1 OR max(rank_in_wiki) <> count(*) OR count(DISTINCT rank_in_wiki) <> count(*)"""
)
def rank_contiguity(spark, d):
    return checks.rank_gaps(marts.top_pages_hourly(_stg(spark, d), CUTOFF).where("rank_in_wiki != 2"))


@query(
    f"""WITH {_EDITS}, m AS ({_MINUTE}), s AS (SELECT event_minute, wiki, change_type, count(*) AS silver_events FROM stg
  WHERE NOT is_canary AND n % 10 <> 0 GROUP BY ALL)
SELECT event_minute, wiki, change_type, events AS mart_events, silver_events FROM m LEFT JOIN s USING (event_minute, wiki, change_type)
WHERE events > coalesce(silver_events, 0)"""
)
def never_overcounts(spark, d):
    """Held against staging with a tenth of its rows missing, so that there is something to find."""
    stg = _stg(spark, d)
    part = stg.where(F.substring("event_id", 2, 20).cast("long") % 10 != 0)
    return checks.overcounted(marts.edits_per_minute(stg, CUTOFF), part)


@query(
    f"""WITH {_EDITS}, dim AS ({_DIM}), seen AS (SELECT * FROM stg WHERE {_SEEN} AND domain <> 'w1.0.example'),
p AS (SELECT DISTINCT wiki, domain FROM seen), c AS (SELECT wiki, count(DISTINCT domain) AS observed_domain_count FROM seen GROUP BY 1)
SELECT dim.wiki, primary_domain, domain_count, observed_domain_count FROM dim LEFT JOIN p ON dim.wiki = p.wiki AND primary_domain = p.domain
LEFT JOIN c ON dim.wiki = c.wiki WHERE p.domain IS NULL OR domain_count <> observed_domain_count"""
)
def primary_domain_observed(spark, d):
    stg = _stg(spark, d)
    return checks.domain_not_observed(marts.dim_wikis(stg, CUTOFF), stg.where("domain != 'w1.0.example'"), CUTOFF)


@query(
    f"""WITH {_EDITS}, m AS ({_BOTS}), f AS (SELECT * REPLACE (CASE WHEN wiki = 'wiki3' THEN bot_events + 2 ELSE bot_events END AS bot_events) FROM m)
SELECT event_hour, wiki, events, bot_events, human_events, events - bot_events - human_events AS unaccounted_events FROM f
WHERE bot_events + human_events <> events"""
)
def bot_human_split(spark, d):
    """Held against a mart with one wiki's bots counted wrong, so that there is something to find."""
    mart = marts.bot_vs_human_hourly(_stg(spark, d), CUTOFF)
    wrong = F.when(F.col("wiki") == "wiki3", F.col("bot_events") + 2).otherwise(F.col("bot_events"))
    return checks.split_not_exhaustive(mart.withColumn("bot_events", wrong))


@query(
    f"""WITH {_EDITS}, f AS (SELECT * REPLACE (CASE WHEN n % 50 <> 0 THEN change_type END AS change_type) FROM stg)
SELECT event_id, event_time, domain, change_type FROM f WHERE change_type IS NULL AND NOT is_canary"""
)
def change_type_missing(spark, d):
    """Over staging without the change type of every 50th event."""
    kept = F.when(_number() % 50 != 0, F.col("change_type"))
    return checks.change_type_missing(_stg(spark, d).withColumn("change_type", kept))


# Analyses


_BUCKETS = " ".join(f"WHEN late_by_seconds <= {b} THEN '<= {b}'" for b in analysis.LAG_BOUNDS)


@query(
    f"""WITH {_EDITS} SELECT bucket, n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS share FROM (
  SELECT CASE {_BUCKETS} ELSE '> {analysis.LAG_BOUNDS[-1]}' END AS bucket, count(*) AS n FROM sized GROUP BY 1)"""
)
def lag_histogram(spark, d):
    return analysis.lag_histogram(_edits(spark, d))


@query(
    f"""WITH {_EDITS}, r AS (SELECT late_by_seconds AS v, row_number() OVER (ORDER BY late_by_seconds) - 1 AS i, count(*) OVER () AS n FROM sized),
p AS (SELECT unnest([0.5::DOUBLE, 0.9::DOUBLE, 0.99::DOUBLE]) AS p)
SELECT p, v AS value FROM r, p WHERE i = least(n - 1, CAST(round(p * n) AS BIGINT))"""
)
def nearest_rank_percentiles(spark, d):
    return analysis.nearest_rank(_edits(spark, d), "late_by_seconds", (0.5, 0.9, 0.99))


# The comparison engine has no crc32: bits are shifted out one by one, eight for each byte.
_CRC_STEPS = "[" + ", ".join("0" * 8) + "]"
_CRC = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), {_CRC_STEPS}), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


@query(
    f"""WITH {_EDITS}, keys AS (SELECT domain AS k, count(*) AS c FROM sized GROUP BY 1), coded AS (SELECT c, {_CRC} AS h FROM keys),
parts AS (SELECT n, h % n AS part, sum(c) AS rows, max(c) AS top FROM coded, (SELECT unnest([1, 3, 6, 12, 24]) AS n) GROUP BY 1, 2)
SELECT n, round(max(rows)::DOUBLE / sum(rows), 4) AS busiest_share, CAST(n - count(*) AS BIGINT) AS idle,
  round(max(top)::DOUBLE / sum(rows), 4) AS floor FROM parts GROUP BY n"""
)
def partition_skew(spark, d):
    return analysis.partition_skew(_edits(spark, d), "domain")


_PROFILED = ("wiki", "change_type", "bytes_delta", "is_bot", "page_title")


@query(
    f"WITH {_EDITS} "
    + " UNION ALL ".join(f"SELECT '{c}' AS field, round(avg(CAST({c} IS NULL AS INT)), 6) AS null_rate FROM sized" for c in _PROFILED)
)
def null_profile(spark, d):
    return analysis.null_profile(_edits(spark, d), list(_PROFILED))


@query(
    f"""WITH {_JUDGED}, k AS (SELECT unnest(['$schema', 'meta', 'length'] || CASE WHEN canary THEN [] ELSE
  ['type', 'namespace', 'title', 'user', 'bot', 'wiki'] END) AS key
  FROM (SELECT n, n % 97 = 0 AS canary FROM judged WHERE n % 101 <> 0)) SELECT key, count(*) AS n FROM k GROUP BY 1"""
)
def key_presence(spark, d):
    return analysis.key_presence(adapter.frames(adapter.events(spark, d)), "raw_payload")


@query(f"WITH {_EDITS} SELECT wiki, count(*) AS n FROM stg WHERE domain <> 'canary' GROUP BY 1 ORDER BY n DESC, wiki LIMIT 5")
def top_wikis(spark, d):
    """The five of seven wikis with most edits."""
    return analysis.most_common(_edits(spark, d).where("domain <> 'canary'"), "wiki", 5)


@query(f"WITH {_EDITS} SELECT domain, count(*) AS n FROM stg WHERE domain <> 'canary' GROUP BY 1 ORDER BY n DESC, domain LIMIT 10")
def top_domains(spark, d):
    return analysis.most_common(_edits(spark, d).where("domain <> 'canary'"), "domain", 10)


@query(f"WITH {_EDITS} SELECT DISTINCT wiki, domain FROM stg WHERE NOT is_canary")
def distinct_domains(spark, d):
    return _stg(spark, d).where(~F.col("is_canary")).select("wiki", "domain").distinct()


@query(
    f"""WITH {_JUDGED}, a AS (SELECT CAST(event_time AS DATE) AS day, count(*) AS n FROM sized GROUP BY 1),
b AS (SELECT ingest_date AS day, count(*) AS n FROM quarantine GROUP BY 1)
SELECT day, coalesce(a.n, 0) AS left_n, coalesce(b.n, 0) AS right_n FROM a FULL JOIN b USING (day)"""
)
def backfill_full_outer(spark, d):
    a = _edits(spark, d).groupBy(F.col("event_date").alias("day")).agg(F.count("*").alias("n"))
    b = _quarantine(spark, d).groupBy(F.col("ingest_date").alias("day")).agg(F.count("*").alias("n"))
    return analysis.outer_by_day(a, b)


@query(f"WITH {_EDITS} SELECT event_id, late_by_seconds, ingested_at FROM sized WHERE CAST(ingested_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'")
def ingest_date_range(spark, d):
    """The replay window: inclusive on ingest dates."""
    e = _edits(spark, d).where(F.to_date("ingested_at").between("2024-01-05", "2024-01-09"))
    return e.select("event_id", "late_by_seconds", "ingested_at")


@query(
    """SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'ExampleEditor' WHEN 1 THEN '192.0.2.146' WHEN 2 THEN '2001:db8::1'
  WHEN 3 THEN '~2026-19' WHEN 4 THEN '999.999.999.999' WHEN 5 THEN '1.2.3' WHEN 6 THEN NULL WHEN 7 THEN '' ELSE '12345678' END AS editor,
  event_id % 9 IN (1, 2, 3) AS is_anonymous FROM events"""
)
def is_anonymous(spark, d):
    shapes = ["ExampleEditor", "192.0.2.146", "2001:db8::1", "~2026-19", "999.999.999.999", "1.2.3", None, "", "12345678"]
    e = F.element_at(F.array(*(F.lit(s) for s in shapes)), (F.col("event_id") % 9 + 1).cast("int"))
    return adapter.events(spark, d).select("event_id", e.alias("editor")).withColumn("is_anonymous", rules.is_anonymous(F.col("editor")))


@query(
    """SELECT event_id, CASE WHEN new IS NULL THEN NULL WHEN old IS NULL THEN new ELSE new - old END AS bytes_delta FROM (
  SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_id * 37 % 5000 END AS old, CASE WHEN event_id % 5 <> 0 THEN event_id % 900 END AS new FROM events)"""
)
def bytes_delta(spark, d):
    e = adapter.events(spark, d).select(
        "event_id", F.when(F.expr("event_id % 3 <> 0"), F.expr("event_id * 37 % 5000")).alias("old"),
        F.when(F.expr("event_id % 5 <> 0"), F.expr("event_id % 900")).alias("new"),
    )
    return e.select("event_id", rules.bytes_delta(F.col("old"), F.col("new")).alias("bytes_delta"))


@query("SELECT event_id, CASE WHEN user_id % 4 <> 0 THEN 'did' || user_id || ':' || event_id END AS event_key FROM events")
def synthetic_event_key(spark, d):
    did = F.when(F.col("user_id") % 4 != 0, F.concat(F.lit("did"), "user_id"))
    return adapter.events(spark, d).select("event_id", rules.event_key(did, F.col("event_id")).alias("event_key"))


@query(
    f"""WITH {_JUDGED} SELECT kafka_partition, kafka_offset, CASE WHEN n % 101 = 0 OR n % 103 = 0 THEN NULL ELSE event_id END AS event_id,
  CASE WHEN n % 101 = 0 OR n % 113 = 0 THEN NULL ELSE domain END AS partition_key FROM judged"""
)
def frame_keys(spark, d):
    raw = F.col("raw_payload")
    return adapter.frames(adapter.events(spark, d)).select(
        "kafka_partition", "kafka_offset", rules.text_field(raw, "$.meta.id").alias("event_id"), rules.text_field(raw, "$.meta.domain").alias("partition_key")
    )


@query(
    f"""WITH {_EDITS} SELECT event_id, concat_ws(',', CASE WHEN wiki IS NULL THEN 'wiki' END, CASE WHEN bytes_new IS NULL THEN 'bytes_new' END) AS missing FROM sized"""
)
def required_fields(spark, d):
    e = _edits(spark, d)
    return e.select("event_id", F.array_join(rules.missing({"wiki": F.col("wiki"), "bytes_new": F.col("bytes_new")}), ",").alias("missing"))


@query("SELECT regionkey, customers FROM (SELECT n_regionkey AS regionkey, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)")
def ad_hoc_sql(spark, d):
    for t in ("customer", "nation"):
        spark.read.parquet(f"{d}/{t}.parquet").createOrReplaceTempView(f"millrace_{t}")
    return analysis.one_statement(
        spark,
        "SELECT n_regionkey AS regionkey, count(*) AS customers FROM millrace_customer JOIN millrace_nation ON c_nationkey = n_nationkey GROUP BY 1;",
    )


# Snapshot tables and streaming

_TWO = "event_id string, bytes_new long"


def _number():
    return F.substring("event_id", 2, 20).cast("long")


def _two(spark: SparkSession, d: str) -> tuple[Table, DataFrame]:
    """A table with the rows of even ids, and all rows."""
    e = _edits(spark, d).select("event_id", "bytes_new")
    t = Table.create(spark, scratch.folder(spark), _TWO, sort=("event_id",))
    t.append(e.where(_number() % 2 == 0))
    return t, e


@query(
    f"""WITH {_EDITS} SELECT 'before' AS at, count(*) AS n FROM sized WHERE n % 2 = 0
UNION ALL SELECT 'after' AS at, count(*) AS n FROM sized"""
)
def store_time_travel_union(spark, d):
    t, e = _two(spark, d)
    t.append(e.where(_number() % 2 == 1))
    last = t.manifest()["version"]
    at = [t.read(version=v).agg(F.count("*").alias("n")).select(F.lit(n).alias("at"), "n") for v, n in ((last - 1, "before"), (last, "after"))]
    return at[0].unionByName(at[1])


@query(f"WITH {_EDITS} SELECT event_id, bytes_new AS size, CASE WHEN n % 2 = 1 THEN 'late' END AS note FROM sized")
def store_evolution(spark, d):
    """A column added, one renamed, one added and dropped again; old files stay as they are."""
    t, e = _two(spark, d)
    t.add_column("note", "string")
    t.add_column("gone", "int")
    t.rename_column("bytes_new", "size")
    odd = e.where(_number() % 2 == 1).withColumnRenamed("bytes_new", "size")
    t.append(odd.withColumns({"note": F.lit("late"), "gone": F.lit(1)}))
    t.drop_column("gone")
    return t.read()


@query(f"WITH {_EDITS} SELECT event_id, CASE WHEN n % 3 = 0 THEN -1 ELSE bytes_new END AS bytes_new FROM sized WHERE n % 3 = 0 OR n % 2 = 0")
def store_upsert(spark, d):
    t, e = _two(spark, d)
    t.upsert(e.where(_number() % 3 == 0).withColumn("bytes_new", F.lit(-1).cast("long")), wire.EDITS_KEY)
    return t.read()


@query(f"WITH {_EDITS} SELECT event_id, bytes_new FROM sized WHERE NOT coalesce(bytes_new > 5000, false)")
def store_delete(spark, d):
    t, e = _two(spark, d)
    t.append(e.where(_number() % 2 == 1))
    t.delete_where(F.col("bytes_new") > 5000)
    return t.read()


@query(f"WITH {_EDITS} SELECT event_id, bytes_new FROM sized")
def store_maintenance(spark, d):
    """Replayed inserts, then compaction, expiry and orphan removal: the rows stay."""
    t, e = _two(spark, d)
    t.insert_absent(e, wire.EDITS_KEY)
    t.insert_absent(e, wire.EDITS_KEY)
    t.maintain(datetime(2100, 1, 1), retain_last=1, orphan_hours=0)
    return t.read()


@query(
    f"""WITH {_JUDGED} SELECT event_id, bytes_new, failure_reason FROM judged WHERE failure_reason IS NULL AND NOT again
UNION ALL SELECT event_id, NULL AS bytes_new, failure_reason FROM quarantine"""
)
def stream_silver(spark, d):
    """The log drained by the silver job, twice: the second run finds nothing to add."""
    root = scratch.folder(spark)
    adapter.log(adapter.events(spark, d)).withColumn("key", F.lit(None).cast("binary")).write.parquet(f"{root}/log/changes")
    for _ in range(2):
        jobs.start_silver(record_log.read_stream(spark, f"{root}/log", "changes"), root, f"{root}/checkpoints", once=True).awaitTermination()
    t = jobs.tables(spark, root)
    good = t["edits"].read().select("event_id", "bytes_new", F.lit(None).cast("string").alias("failure_reason"))
    return good.unionByName(t["quarantine"].read().select("event_id", F.lit(None).cast("long").alias("bytes_new"), "failure_reason"))


@query(f"WITH {_JUDGED} SELECT kafka_partition, count(*) AS n FROM judged GROUP BY 1")
def stream_bronze(spark, d):
    """The log drained by the bronze job, and its first batch offered again."""
    root = scratch.folder(spark)
    adapter.log(adapter.events(spark, d)).withColumn("key", F.lit(None).cast("binary")).write.parquet(f"{root}/log/changes")
    jobs.start_bronze(record_log.read_stream(spark, f"{root}/log", "changes"), root, f"{root}/checkpoints", once=True).awaitTermination()
    table = jobs.tables(spark, root)["bronze"]
    table.append(table.read(), (jobs.BRONZE, 0))
    return table.read().groupBy("kafka_partition").agg(F.count("*").alias("n"))


@query(f"WITH {_JUDGED} SELECT failure_reason, count(*) AS n FROM judged WHERE failure_reason IS NOT NULL GROUP BY 1")
def rebuild_from_bronze(spark, d):
    """Silver rebuilt from stored bronze rows."""
    root = scratch.folder(spark)
    log = adapter.log(adapter.events(spark, d))
    jobs.tables(spark, root)["bronze"].append(medallion.bronze_rows(log))
    jobs.rebuild(spark, root)
    return checks.reasons(jobs.tables(spark, root)["quarantine"].read())


# More of the table's and the engine's operators


@query(f"WITH {_JUDGED} SELECT count(*) AS rows, count(DISTINCT kafka_partition || ':' || kafka_offset) AS coordinates, count(DISTINCT event_id) AS ids FROM judged")
def composite_distinct(spark, d):
    f = _judged(spark, d).withColumn("event_id", F.coalesce("event_id", F.lit("?")))
    clean = adapter.edits(adapter.events(spark, d)).select("event_id").distinct()
    ids = clean.agg(F.count("*").alias("ids"))
    both = f.agg(F.count("*").alias("rows"), F.countDistinct(F.concat_ws(":", "kafka_partition", "kafka_offset")).alias("coordinates"))
    return both.join(ids)  # two frames of one row


@query(f"WITH {_EDITS} SELECT event_id, date_diff('second', event_time, ingested_at) AS seconds FROM sized")
def arrival_seconds(spark, d):
    return _edits(spark, d).select("event_id", F.expr("timestampdiff(SECOND, event_time, ingested_at)").alias("seconds"))


@query("SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS other FROM events")
def map_element(spark, d):
    props = adapter.events(spark, d).select("event_id", F.from_json("props", "map<string, string>").alias("m"))
    return props.select("event_id", F.try_element_at("m", F.lit("k")).cast("long").alias("k"), F.try_element_at("m", F.lit("other")).alias("other"))


@query("SELECT r_regionkey, r_name, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS n FROM region")
def correlated_count(spark, d):
    region = spark.read.parquet(f"{d}/region.parquet").select("r_regionkey", "r_name")
    nation = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_regionkey").alias("r_regionkey"))
    return statements.with_counts(region, nation, "r_regionkey")


@query(f"WITH {_EDITS} SELECT event_hour, true AS within FROM stg GROUP BY 1")
def approximate_percentiles(spark, d):
    """The approximate percentiles of each hour lie within 2 in 10,000 of their rank (or one row) of the exact ones."""
    stg = _stg(spark, d)
    shares = (0.5, 0.95, 0.99)
    found = stg.groupBy("event_hour").agg(F.count("late_by_seconds").alias("rows"), *(marts.percentile("late_by_seconds", p, False).alias(f"p{k}") for k, p in enumerate(shares)))
    near = stg.join(found, "event_hour").groupBy("event_hour", "rows").agg(
        *(F.count_if(F.col("late_by_seconds") < F.col(f"p{k}")).alias(f"below{k}") for k in range(3)),
        *(F.count_if(F.col("late_by_seconds") <= F.col(f"p{k}")).alias(f"upto{k}") for k in range(3)),
    )
    error = F.greatest(F.lit(1.0), F.col("rows") * 2 / 10_000)
    within = F.lit(True)
    for k, p in enumerate(shares):
        rank = F.col("rows") * p
        within = within & (F.col(f"below{k}") <= rank + error) & (F.col(f"upto{k}") >= rank - error)
    return near.select("event_hour", within.alias("within"))


@query("SELECT 0::BIGINT AS rows, CAST(NULL AS TIMESTAMP) AS last_ingested_at, CAST(NULL AS BIGINT) AS min_offset, CAST(NULL AS BIGINT) AS max_offset")
def empty_observation(spark, d):
    """A global aggregate over no rows is one row."""
    return checks.bronze_observation(adapter.frames(adapter.events(spark, d)).where("kafka_offset < 0"))


_RATES = """round(rows / nullif(seconds, 0), 3) AS rows_per_second, round(bytes_in / nullif(rows, 0), 3) AS bytes_per_row, round(bytes_in / nullif(bytes_stored, 0), 3) AS compression"""


@query(
    f"""WITH {_EDITS}, t AS (SELECT CAST(count(*) AS DOUBLE) AS rows, CAST(sum(late_by_seconds) AS DOUBLE) AS seconds,
  CAST(sum(coalesce(bytes_new, 0)) AS DOUBLE) AS bytes_in, CAST(sum(coalesce(bytes_old, 0)) AS DOUBLE) AS bytes_stored FROM sized) SELECT {_RATES} FROM t"""
)
def throughput_report(spark, d):
    """Days stand for triggers."""
    days = _edits(spark, d).groupBy("event_date").agg(
        F.count("*").alias("rows"), F.sum("late_by_seconds").alias("seconds"),
        F.sum(F.coalesce("bytes_new", F.lit(0))).alias("bytes_in"), F.sum(F.coalesce("bytes_old", F.lit(0))).alias("bytes_stored"),
    )
    return analysis.throughput(days)


@query(f"WITH {_EDITS} SELECT count(*) AS rows, round(CAST(count_if(late_by_seconds < 1800) AS DOUBLE) / count(*), 6) AS early_share FROM sized")
def early_share(spark, d):
    """Lags less half an hour, so that some are below 0."""
    return analysis.early_share(_edits(spark, d).withColumn("late_by_seconds", F.col("late_by_seconds") - 1800))


@query(
    f"""WITH {_JUDGED}, f AS (SELECT * FROM judged WHERE n % 101 <> 0), k AS (
  SELECT 'meta.id' AS path, CASE WHEN n % 103 = 0 THEN 'absent' ELSE 'string' END AS kind FROM f
  UNION ALL SELECT 'length.new' AS path, CASE WHEN bytes_new IS NULL THEN 'absent' ELSE 'number' END AS kind FROM f
  UNION ALL SELECT 'bot' AS path, CASE WHEN is_bot IS NULL THEN 'absent' ELSE 'boolean' END AS kind FROM f
  UNION ALL SELECT 'meta' AS path, 'object' AS kind FROM f) SELECT path, kind, count(*) AS n FROM k GROUP BY 1, 2"""
)
def path_types(spark, d):
    return analysis.path_types(adapter.frames(adapter.events(spark, d)), "raw_payload", ["meta.id", "length.new", "bot", "meta"])


@query(
    f"""WITH {_JUDGED}, i AS (SELECT CASE WHEN n % 101 <> 0 AND n % 103 <> 0 THEN event_id END AS id FROM judged)
SELECT count(*) AS rows, count(id) AS present, count(DISTINCT id) AS distinct_ids, count(id) - count(DISTINCT id) AS repeated FROM i"""
)
def id_distinctness(spark, d):
    return analysis.id_distinctness(_judged(spark, d), "event_id")


@query(
    """SELECT unnest(['bot', 'namespace', 'title', 'type', 'user', 'wiki', 'comment', 'minor']) AS field,
  unnest(['observed', 'observed', 'observed', 'observed', 'observed', 'observed', 'declared', 'declared']) AS side"""
)
def field_drift(spark, d):
    """Field names that are declared, against those that frames have."""
    declared = spark.createDataFrame([(f,) for f in ("$schema", "meta", "length", "comment", "minor")], "field string")
    seen = analysis.key_presence(adapter.frames(adapter.events(spark, d)), "raw_payload")
    return analysis.drift_of(declared, seen.select(F.col("key").alias("field")))


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 0 OR event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL ELSE 'e' || event_id END AS id FROM events"""
)
def string_ids(spark, d):
    """An id that is a number, empty or no JSON at all is none."""
    n = F.col("event_id").cast("string")
    body = F.when(F.expr("event_id % 7 = 0"), F.lit("{no")).when(F.expr("event_id % 3 = 0"), F.concat(F.lit('{"id": '), n, F.lit("}")))
    body = body.when(F.expr("event_id % 5 = 0"), F.lit('{"id": ""}')).otherwise(F.concat(F.lit('{"id": "e'), n, F.lit('"}')))
    return adapter.events(spark, d).select("event_id", rules.text_field(body, "$.id").alias("id"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{\"a\":' || event_id || '}' ELSE '[' || event_id || ',\"x\"]' END AS log_params FROM events")
def raw_json_field(spark, d):
    """A field that is an object in some frames and a list in others is kept as its text."""
    n = F.col("event_id").cast("string")
    value = F.when(F.expr("event_id % 2 = 0"), F.concat(F.lit('{"a":'), n, F.lit("}"))).otherwise(F.concat(F.lit("["), n, F.lit(',"x"]')))
    body = F.concat(F.lit('{"type":"log","log_params":'), value, F.lit("}"))
    parsed = adapter.events(spark, d).select("event_id", F.from_json(body, wire.PARSED, wire.PARSE_OPTIONS).alias("p"))
    return parsed.select("event_id", F.col("p.log_params").alias("log_params"))


@query("SELECT 1::BIGINT AS clocks, count(*) AS rows FROM events")
def one_clock(spark, d):
    """The clock of a batch stands still."""
    return adapter.events(spark, d).select(F.current_timestamp().alias("now")).agg(F.countDistinct("now").alias("clocks"), F.count("*").alias("rows"))


@query(
    f"""WITH {_EDITS} SELECT CASE WHEN l > 3600 THEN 'error' WHEN l > 900 THEN 'warn' ELSE 'pass' END AS level, l AS lag_seconds
FROM (SELECT (epoch_us({_CUT}) - epoch_us(max(ingested_at))) / 1000000 AS l FROM sized WHERE ingested_at < {_CUT})"""
)
def source_freshness(spark, d):
    e = _edits(spark, d)
    return checks.freshness_level(e.where(F.col("ingested_at") < F.lit(CUTOFF)), CUTOFF)


@query(
    f"""WITH {_JUDGED}, s AS (SELECT * FROM judged WHERE failure_reason IS NULL AND NOT again)
SELECT 'bronze_rows' AS fact, count(*) AS n FROM judged UNION ALL SELECT 'bronze_repeated' AS fact, count(*) - count(DISTINCT (kafka_partition, kafka_offset)) AS n FROM judged
UNION ALL SELECT 'edits_rows' AS fact, count(*) AS n FROM s UNION ALL SELECT 'edits_repeated' AS fact, count(*) - count(DISTINCT event_id) AS n FROM s
UNION ALL SELECT 'quarantine_rows' AS fact, count(*) AS n FROM quarantine
UNION ALL SELECT 'quarantine_repeated' AS fact, count(*) - count(DISTINCT (kafka_partition, kafka_offset)) AS n FROM quarantine"""
)
def context_report(spark, d):
    judged = _judged(spark, d)
    return checks.context(judged, medallion.valid_rows(judged), medallion.quarantine_rows(judged))


@query(
    f"""WITH {_JUDGED}, e AS (SELECT event_id, event_time FROM judged WHERE failure_reason IS NULL), q AS (SELECT * FROM judged WHERE failure_reason IS NOT NULL)
SELECT 'duplicate_event_ids' AS name, count(*) = count(DISTINCT event_id) AS passed, 'error' AS severity FROM e
UNION ALL SELECT 'null_event_ids', count_if(event_id IS NULL) = 0, 'error' FROM e UNION ALL SELECT 'null_event_times', count_if(event_time IS NULL) = 0, 'error' FROM e
UNION ALL SELECT 'duplicate_quarantine_keys', count(*) = count(DISTINCT (kafka_partition, kafka_offset)), 'error' FROM q UNION ALL SELECT 'not_empty', count(*) > 0, 'error' FROM e"""
)
def no_duplicates_gate(spark, d):
    """Over edits that weren't deduplicated: the gate finds the repeated ids."""
    judged = _judged(spark, d)
    return checks.as_rows(spark, checks.no_duplicates_gate(judged.where("failure_reason IS NULL"), judged.where("failure_reason IS NOT NULL")))


@query(
    f"""WITH {_EDITS} SELECT CAST(count_if(wiki IS NULL) AS BIGINT) AS wiki, CAST(count_if(bytes_delta IS NULL) AS BIGINT) AS bytes_delta,
  CAST(count_if(event_id IS NULL) AS BIGINT) AS event_id FROM sized"""
)
def column_nulls(spark, d):
    return checks.nulls(_edits(spark, d), ["wiki", "bytes_delta", "event_id"])


@query(f"WITH {_EDITS} SELECT event_id, change_type FROM sized WHERE change_type IS NOT NULL AND change_type NOT IN ('edit', 'new')")
def not_accepted_values(spark, d):
    return checks.not_accepted(_edits(spark, d).select("event_id", "change_type"), "change_type", ["edit", "new"])


@query(f"WITH {_EDITS} SELECT editor, event_minute, count(*) AS n FROM stg GROUP BY 1, 2 HAVING count(*) > 1")
def not_unique_combinations(spark, d):
    return checks.duplicate_keys(_stg(spark, d), ["editor", "event_minute"])


@query(f"WITH {_EDITS} SELECT event_id, bytes_new, true AS refused FROM sized")
def store_widen(spark, d):
    """int to bigint is a change of the manifest alone; the way back is refused."""
    e = _edits(spark, d).select("event_id", "bytes_new")
    t = Table.create(spark, scratch.folder(spark), "event_id string, bytes_new int")
    t.append(e.where(_number() % 2 == 0))
    t.widen_column("bytes_new", "bigint")
    t.append(e.where(_number() % 2 == 1))
    try:
        t.widen_column("bytes_new", "int")
        refused = False
    except StoreError as error:
        refused = "NOT_SUPPORTED_CHANGE_COLUMN" in str(error)
    return t.read().withColumn("refused", F.lit(refused))


def _by_day(spark: SparkSession, d: str) -> Table:
    """A table by days in two appends, one for each part of the month."""
    e = _edits(spark, d).select("event_id", "event_date")
    t = Table.create(spark, scratch.folder(spark), "event_id string, event_date date", "event_date", ("event_id",))
    t.append(e.where("event_date < DATE '2024-01-12'"))
    t.append(e.where("event_date >= DATE '2024-01-12'"))
    return t


@query(f"WITH {_EDITS} SELECT CAST(event_date AS VARCHAR) AS partition, count(*) AS rows FROM sized GROUP BY 1")
def store_partitions(spark, d):
    return _by_day(spark, d).partitions().select("partition", "rows")


@query(f"WITH {_EDITS} SELECT event_id, true AS pruned FROM sized WHERE event_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-05'")
def store_pruned_scan(spark, d):
    """A range of days; files outside it aren't opened."""
    t = _by_day(spark, d)
    rows = t.scan("2024-01-03", "2024-01-05")
    pruned = 0 < len(t.met("2024-01-03", "2024-01-05")) < len(t.manifest()["files"]) and len(rows.inputFiles()) == len(t.met("2024-01-03", "2024-01-05"))
    return rows.select("event_id", F.lit(pruned).alias("pruned"))


@query(f"WITH {_EDITS} SELECT event_id, bytes_new, true AS untouched FROM sized WHERE n % 2 = 0 UNION ALL SELECT 'new' AS event_id, 1 AS bytes_new, true AS untouched")
def store_touched_files(spark, d):
    """An upsert writes only those files anew that hold its keys."""
    t, e = _two(spark, d)
    before = set(r["file_path"] for r in t.files().collect())
    t.upsert(spark.createDataFrame([("new", 1)], _TWO), wire.EDITS_KEY)
    return t.read().withColumn("untouched", F.lit(before < {r["file_path"] for r in t.files().collect()}))


@query(
    """WITH e AS (SELECT count(*) AS n, CAST(count_if(event_id % 2 = 0) AS BIGINT) AS half FROM events)
SELECT 4 AS version, 'append' AS operation, n + half AS total_records FROM e UNION ALL SELECT 3 AS version, 'add column' AS operation, half AS total_records FROM e"""
)
def latest_snapshots(spark, d):
    t, e = _two(spark, d)
    t.add_column("note", "string")
    t.append(e)
    return t.snapshots().orderBy(F.desc("committed_at"), F.desc("version")).limit(2).select("version", "operation", "total_records")


@query("SELECT count(*) AS records, 1::BIGINT AS listed_once FROM events")
def distinct_files(spark, d):
    """Files of all versions, each once: a file that many versions share isn't counted twice."""
    t, e = _two(spark, d)
    t.append(e.where(_number() % 2 == 1))
    t.add_column("note", "string")
    once = t.files(every_version=True)
    return once.groupBy("file_path").agg(F.first("record_count").alias("r"), F.count("*").alias("c")).agg(F.sum("r").alias("records"), F.max("c").alias("listed_once"))


@query("SELECT 'bad' AS table_name, false AS ok, CAST(NULL AS BIGINT) AS rows UNION ALL SELECT 'good' AS table_name, true AS ok, count(*) AS rows FROM events")
def store_maintain_all(spark, d):
    """One table without its data files: the other is maintained all the same."""
    good, e = _two(spark, d)
    good.append(e.where(_number() % 2 == 1))
    bad, _ = _two(spark, d)
    bad.append(e.where(_number() % 2 == 1))
    for r in bad.files().collect():
        bad.fs.delete(r["file_path"])
    done = maintain_all(spark, {"bad": bad, "good": good}, datetime(2100, 1, 1), retain_last=1, orphan_hours=0)
    return done.select("table_name", "ok", "rows")


@query(f"WITH {_EDITS} SELECT event_id, bytes_new FROM sized")
def jsonl_round_trip(spark, d):
    path = scratch.folder(spark)
    record_log.write_jsonl(_edits(spark, d).select("event_id", "bytes_new"), path)
    lines = record_log.read_jsonl(spark, path)
    return lines.select(F.from_json("value", "event_id string, bytes_new long").alias("x")).select("x.*")


_FIRST_FILE, _SECOND_FILE = "event_date <= DATE '2024-01-10'", "event_date > DATE '2024-01-10'"
_LATE, _COPIED = "n % 50 = 0 AND event_date < DATE '2024-01-10'", "n % 40 = 0 AND event_date > DATE '2024-01-10'"


@query(
    f"""WITH {_EDITS}, c AS (SELECT count(*) AS n, count_if({_LATE}) AS late, count_if({_COPIED}) AS copies FROM sized)
SELECT how, CAST(CASE WHEN how IN ('none', 'watermark_only') THEN n + late + copies ELSE n END AS BIGINT) AS kept
FROM c, (SELECT unnest(['none', 'watermark_only', 'within_watermark', 'watermark']) AS how)"""
)
def watermark_drops(spark, d):
    """All edits in two files, read one a trigger: the first ten days, then the others with late rows of the first nine, and copies. State with a watermark of
    10 minutes loses the late rows (which here have been seen) and the copies; without state nothing goes."""
    root = scratch.folder(spark)
    e = _edits(spark, d).withColumn("n", _number())
    second = e.where(_SECOND_FILE).unionByName(e.where(_LATE)).unionByName(e.where(_COPIED))
    for k, rows in enumerate((e.where(_FIRST_FILE), second)):
        rows.select("event_id", "event_time").coalesce(1).write.json(f"{root}/in/{k}")
    found = None
    for how in ("none", "watermark_only", "within_watermark", "watermark"):
        stream = spark.readStream.schema("event_id string, event_time timestamp").option("maxFilesPerTrigger", 1).json(f"{root}/in/*")
        q = jobs.drop_late(stream, how).writeStream.option("checkpointLocation", f"{root}/c/{how}").trigger(availableNow=True).format("parquet").start(f"{root}/out/{how}")
        q.awaitTermination()
        kept = spark.read.schema("event_id string").parquet(f"{root}/out/{how}").agg(F.lit(how).alias("how"), F.count("*").alias("kept"))
        found = kept if found is None else found.unionByName(kept)
    return found


# Sketches: states of two runs, the second with late rows, merged without reading rows again


def _states(spark: SparkSession, d: str) -> DataFrame:
    stg, path = _stg(spark, d), f"{scratch.folder(spark)}/state"
    sketches.edits_state(stg, None, EARLIER).write.parquet(path)
    sketches.edits_state(stg, EARLIER, CUTOFF).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _sketched(found: DataFrame, exact: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """exact, and for each value whether the estimate is within its bound."""
    both = exact.join(found.select(*keys, *(F.col(v).alias(f"_{v}") for v in values)), keys, "left")
    checks_ = [F.coalesce(sketches.within_count(F.col(f"_{v}"), F.col(v)), F.lit(False)).alias(f"{v}_within") for v in values]
    return both.select(*(c for c in both.columns if c not in {f"_{v}" for v in values}), *checks_)


_SIDES = """count(DISTINCT CASE WHEN is_bot THEN editor END) AS bot_editors, count(DISTINCT CASE WHEN NOT is_bot THEN editor END) AS human_editors,
  count(DISTINCT page_title) AS pages"""


@query(
    f"""WITH {_EDITS}, h AS ({_BOTS}), p AS (SELECT event_hour, wiki, count(DISTINCT page_title) AS pages FROM stg WHERE {_SEEN} GROUP BY ALL)
SELECT h.*, pages, true AS bot_editors_within, true AS human_editors_within, true AS pages_within FROM h JOIN p USING (event_hour, wiki)"""
)
def sketch_bot_vs_human_hourly(spark, d):
    """The additive measures are those of the sketch mart itself; exact distinct counts stand beside the estimates' verdicts."""
    found, keys = sketches.bot_vs_human(_states(spark, d)), ["event_hour", "wiki"]
    seen = _stg(spark, d).where(~F.col("is_canary") & (F.col("ingested_at") < F.lit(CUTOFF)))
    exact = seen.groupBy(*keys).agg(
        F.countDistinct(F.when(F.col("is_bot"), F.col("editor"))).alias("bot_editors"),
        F.countDistinct(F.when(~F.col("is_bot"), F.col("editor"))).alias("human_editors"), F.countDistinct("page_title").alias("pages"),
    )
    values = ["bot_editors", "human_editors", "pages"]
    return found.drop(*values, "editors_on_both_sides").join(_sketched(found, exact, keys, values), keys)


@query(
    f"""WITH {_EDITS}, days AS (SELECT date_trunc('day', event_time) AS event_day, * FROM stg WHERE {_SEEN})
SELECT event_day, wiki, {_SIDES}, true AS bot_editors_within, true AS human_editors_within, true AS pages_within FROM days GROUP BY event_day, wiki"""
)
def sketch_editors_daily(spark, d):
    """The same stored minutes, merged to days."""
    found, keys = sketches.bot_vs_human(_states(spark, d), "day"), ["event_day", "wiki"]
    seen = _stg(spark, d).where(~F.col("is_canary") & (F.col("ingested_at") < F.lit(CUTOFF))).withColumn("event_day", F.date_trunc("day", "event_time"))
    exact = seen.groupBy(*keys).agg(
        F.countDistinct(F.when(F.col("is_bot"), F.col("editor"))).alias("bot_editors"),
        F.countDistinct(F.when(~F.col("is_bot"), F.col("editor"))).alias("human_editors"), F.countDistinct("page_title").alias("pages"),
    )
    return _sketched(found, exact, keys, ["bot_editors", "human_editors", "pages"])


@query(
    """WITH l AS (SELECT *, date_trunc('year', l_shipdate) AS year FROM lineitem)
SELECT l_returnflag, year, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, true AS orders_within, true AS parts_within FROM l GROUP BY 1, 2"""
)
def sketch_distinct_by_year(spark, d):
    """Thousands of values a group: sketches of a month, merged to years."""
    rows = spark.read.parquet(f"{d}/lineitem.parquet").withColumn("month", F.date_trunc("month", "l_shipdate"))
    state = sketches.distinct_state(rows, ["l_returnflag", "month"], {"orders": F.col("l_orderkey"), "parts": F.col("l_partkey")})
    keys = ["l_returnflag", "year"]
    found = sketches.distinct_counts(state.withColumn("year", F.date_trunc("year", "month")), keys, ["orders", "parts"])
    exact = rows.groupBy("l_returnflag", F.date_trunc("year", "l_shipdate").alias("year")).agg(F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"))
    return _sketched(found, exact, keys, ["orders", "parts"])


@query(
    f"""WITH {_EDITS}, h AS (SELECT event_hour, count(*) AS n FROM stg WHERE {_SEEN} GROUP BY 1)
SELECT event_hour, n, p, true AS within FROM h, (SELECT unnest([0.5::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS p)"""
)
def sketch_late_percentiles(spark, d):
    """Percentiles of the lag by hour from merged sketches, held to the exact rank of the value they give."""
    seen = _stg(spark, d).where(~F.col("is_canary") & (F.col("ingested_at") < F.lit(CUTOFF)))
    found = sketches.late_percentiles(_states(spark, d))
    judged = sketches.rank_check(found.select("event_hour", "p", "value"), seen, ["event_hour"], "late_by_seconds")
    return found.join(judged.select("event_hour", "p", "within"), ["event_hour", "p"]).select("event_hour", "n", "p", "within")


# Marts kept from changes: rows up to an earlier cutoff, then late rows come and some of the first are taken back

_TAKEN = f"n % 11 = 0 AND ingested_at < TIMESTAMP '{EARLIER}'"


def _change(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows before, rows that came, rows that went, and rows after, each written."""
    path = scratch.folder(spark)
    rows = _stg(spark, d).where(~F.col("is_canary") & (F.col("ingested_at") < F.lit(CUTOFF)))
    early, taken = F.col("ingested_at") < F.lit(EARLIER), F.substring("event_id", 2, 20).cast("long") % 11 == 0
    rows.withColumn("_at", F.when(early & taken, "went").when(early, "stays").otherwise("came")).write.partitionBy("_at").parquet(path)
    kept = spark.read.parquet(path)
    part = {k: kept.where(F.col("_at") == k).drop("_at") for k in ("went", "stays", "came")}
    return part["stays"].unionByName(part["went"]), part["came"], part["went"], part["stays"].unionByName(part["came"])


MINUTES = delta.View(
    ("event_minute", "wiki", "change_type"),
    {
        "bot_events": "CAST(is_bot AS LONG)", "article_events": "CAST(is_article AS LONG)", "events_with_bytes": "CAST(bytes_delta IS NOT NULL AS LONG)",
        "bytes_added": "greatest(bytes_delta, 0)", "bytes_removed": "least(bytes_delta, 0)",
    },
    {"distinct_editors": "editor", "distinct_pages": "page_title"}, {"first_event_at": "event_time"}, {"last_event_at": "event_time"},
)
HOURS = delta.View(
    ("event_hour", "wiki"), {"bot_events": "CAST(is_bot AS LONG)"}, {"editors": "editor"}, {"first_event_at": "event_time", "least_late": "late_by_seconds"},
    {"last_event_at": "event_time", "most_late": "late_by_seconds"},
)
PAGES = delta.View(("event_hour", "wiki", "page_title"), {"bytes_net": "bytes_delta", "bot_events": "CAST(is_bot AS LONG)"}, {"distinct_editors": "editor"})


def _kept(spark: SparkSession, d: str, view: delta.View) -> tuple[delta.State, delta.Change]:
    before, came, went, after = _change(spark, d)
    state = delta.full(before, view)
    return state, delta.apply(state, view, came, went, after)


@query(
    f"""WITH {_EDITS} SELECT event_minute, wiki, change_type, {_MEASURES}, min(event_time) AS first_event_at, max(event_time) AS last_event_at
FROM stg WHERE {_SEEN} AND NOT ({_TAKEN}) GROUP BY event_minute, wiki, change_type"""
)
def delta_edits_per_minute(spark, d):
    state, change = _kept(spark, d, MINUTES)
    return delta.merged(state, change, MINUTES).groups.withColumnRenamed("rows", "events")


@query(
    f"""WITH {_EDITS} SELECT event_hour, wiki, count(*) AS events, CAST(count_if(is_bot) AS BIGINT) AS bot_events, count(DISTINCT editor) AS editors,
  min(event_time) AS first_event_at, min(late_by_seconds) AS least_late, max(event_time) AS last_event_at, max(late_by_seconds) AS most_late
FROM stg WHERE {_SEEN} AND NOT ({_TAKEN}) GROUP BY event_hour, wiki"""
)
def delta_hours(spark, d):
    """Minima and maxima over many rows a group: most groups keep their witness, the others are read again."""
    state, change = _kept(spark, d, HOURS)
    return delta.merged(state, change, HOURS).groups.withColumnRenamed("rows", "events")


@query(
    f"""WITH {_EDITS}, g AS (SELECT event_hour, wiki, page_title, count(*) AS events, count(DISTINCT editor) AS distinct_editors,
    CAST(count_if(is_bot) AS BIGINT) AS bot_events, CAST(sum(coalesce(bytes_delta, 0)) AS BIGINT) AS bytes_net
  FROM stg WHERE {_SEEN} AND NOT ({_TAKEN}) AND page_title IS NOT NULL GROUP BY ALL)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY event_hour, wiki ORDER BY events DESC, page_title) AS INTEGER) AS rank FROM g) WHERE rank <= 3"""
)
def delta_top_pages(spark, d):
    """Top three of each hour and wiki: the buckets that changed are ranked again, the others keep their rows."""
    before, came, went, after = (x.where(F.col("page_title").isNotNull()) for x in _change(spark, d))
    state = delta.full(before, PAGES)
    change = delta.apply(state, PAGES, came, went, after)
    order, bucket = [F.desc("rows"), F.asc("page_title")], ("event_hour", "wiki")
    place = F.row_number().over(Window.partitionBy(*bucket).orderBy(*order))
    old = state.groups.withColumn("rank", place).where("rank <= 3")
    new = delta.top_changed(delta.merged(state, change, PAGES).groups, change, bucket, order, 3)
    touched = change.changed.groups.select(*bucket).unionByName(change.gone.select(*bucket)).distinct()
    return old.join(touched, list(bucket), "left_anti").select(*new.columns).unionByName(new).withColumnRenamed("rows", "events")


# Spark's own layouts: bucketed history, metrics observed in passing, parts overwritten


@query(
    f"""WITH {_EDITS}, t AS (SELECT event_id, bytes_new FROM sized WHERE n % 3 = 0)
SELECT event_id, bytes_new FROM t UNION ALL SELECT event_id, bytes_new + 7 FROM sized s WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE t.event_id = s.event_id)"""
)
def bucketed_insert_if_absent(spark, d):
    """The merge into a bucketed table, run twice: the second run adds nothing."""
    e = _edits(spark, d).select("event_id", "bytes_new")
    name = layout.bucketed(spark, scratch.folder(spark), e.schema, wire.EDITS_KEY, 8)
    layout.insert_absent(name, e.where(F.substring("event_id", 2, 20).cast("long") % 3 == 0), wire.EDITS_KEY)
    new = e.withColumn("bytes_new", F.col("bytes_new") + 7)
    for _ in range(2):
        layout.insert_absent(name, new, wire.EDITS_KEY)
    return layout.read(spark, name)


@query(
    f"""WITH {_JUDGED}, once AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition, kafka_offset) AS r FROM judged
  WHERE failure_reason IS NULL), bad AS (SELECT count(*) AS b FROM judged WHERE failure_reason IS NOT NULL)
SELECT CAST(run AS INTEGER) AS run, (SELECT count(*) FROM once) AS valid, b AS rejected, CASE WHEN run = 1 THEN (SELECT count(*) FROM once WHERE r = 1) ELSE 0 END AS new_edits,
  CASE WHEN run = 1 THEN b ELSE 0 END AS new_quarantine FROM bad, (SELECT unnest([1, 2]) AS run)"""
)
def observed_merge_counts(spark, d):
    """What a batch observed while it was merged into bucketed tables, and what it observed when it was run again."""
    root = scratch.folder(spark)
    f = adapter.frames(adapter.events(spark, d))
    runs = [(k, silver.merge_batch(f, k, root, 8)) for k in (1, 2)]
    names = ("valid", "rejected", "new_edits", "new_quarantine")
    return spark.createDataFrame([(k, *(got[n] for n in names)) for k, got in runs], "run int, valid long, rejected long, new_edits long, new_quarantine long")


@query(f"WITH {_EDITS} SELECT *, CAST(event_hour AS DATE) AS day FROM ({_TOP})")
def overwrite_touched_days(spark, d):
    """Built up to an earlier cutoff; then the days that later rows fall into are computed again and their folders replaced, no others."""
    root = scratch.folder(spark)
    layout.write_parts(_stg(spark, d).where(F.col("ingested_at") < F.lit(CUTOFF)), f"{root}/edits", "event_date")
    edits = spark.read.parquet(f"{root}/edits")

    def build(rows: DataFrame, cutoff: datetime) -> None:
        layout.write_parts(marts.top_pages_hourly(rows, cutoff).withColumn("day", F.to_date("event_hour")), f"{root}/mart", "day")

    build(edits, EARLIER)
    build(layout.touched_parts(edits, "event_date", EARLIER, CUTOFF), CUTOFF)
    return spark.read.parquet(f"{root}/mart")


@query(
    f"""WITH {_JUDGED} SELECT event_id, bytes_new, failure_reason FROM judged WHERE failure_reason IS NULL AND NOT again
UNION ALL SELECT event_id, NULL AS bytes_new, failure_reason FROM quarantine"""
)
def stream_bucketed_silver(spark, d):
    """The log drained by the silver job over bucketed tables, twice."""
    root = scratch.folder(spark)
    adapter.log(adapter.events(spark, d)).withColumn("key", F.lit(None).cast("binary")).write.parquet(f"{root}/log/changes")
    for _ in range(2):
        silver.start(record_log.read_stream(spark, f"{root}/log", "changes"), root, f"{root}/checkpoints", once=True, buckets=8).awaitTermination()
    names = silver.tables(spark, root, 8)
    good = layout.read(spark, names["edits"]).select("event_id", "bytes_new", F.lit(None).cast("string").alias("failure_reason"))
    return good.unionByName(layout.read(spark, names["quarantine"]).select("event_id", F.lit(None).cast("long").alias("bytes_new"), "failure_reason"))


# Statements with parameters, profiles, the smoke report and the build


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('purchase', 'view', 'it''s') GROUP BY 1")
def parameter_markers(spark, d):
    return statements.among(adapter.events(spark, d), "event_type", ["purchase", "view", "it's"]).groupBy("event_type").agg(F.count("*").alias("n"))


def _saved(spark: SparkSession, df: DataFrame) -> str:
    path = scratch.folder(spark)
    name = f"saved_{path.rsplit('-', 1)[1]}"
    df.write.option("path", path).saveAsTable(name)
    return name


@query("SELECT event_id, event_type, value FROM events UNION ALL VALUES (-1, 'it''s \\ \"quoted\"', 0.5), (-2, NULL, 2.5)")
def literal_insert(spark, d):
    name = _saved(spark, adapter.events(spark, d).select("event_id", "event_type", "value"))
    statements.insert(spark, name, [{"event_id": -1, "event_type": "it's \\ \"quoted\"", "value": 0.5}, {"event_id": -2, "value": 2.5}])
    return spark.table(name)


@query(f"WITH {_EDITS} SELECT page_title AS key, count(*) AS n, max(event_time) AS newest FROM sized WHERE page_title IS NOT NULL GROUP BY 1 ORDER BY n DESC, key LIMIT 10")
def grouped_report(spark, d):
    return statements.grouped_report(spark, _saved(spark, _edits(spark, d).select("page_title", "event_time")), "page_title", "event_time")


_PATHS = {
    "$schema": ("string", "true"), "meta": ("object", "true"), "meta.id": ("string", "n % 103 <> 0"), "meta.dt": ("string", "n % 107 <> 0"), "meta.domain": ("string", "n % 113 <> 0"),
    "type": ("string", "NOT canary"), "namespace": ("number", "NOT canary"), "title": ("string", "NOT canary"), "user": ("string", "NOT canary"), "bot": ("boolean", "NOT canary"),
    "wiki": ("string", "NOT canary"), "length": ("object", "true"), "length.old": ("number", "bytes_old IS NOT NULL"), "length.new": ("number", "bytes_new IS NOT NULL"),
}


@query(
    f"WITH {_JUDGED}, j AS (SELECT *, n % 97 = 0 AS canary FROM judged WHERE n % 101 <> 0) "
    + " UNION ALL ".join(f"SELECT '{p}' AS path, '{kind}' AS kind, count(*) AS n FROM j WHERE {of}" for p, (kind, of) in _PATHS.items())
)
def json_paths(spark, d):
    """All nested paths of the frames, none of them given."""
    return profile.paths(adapter.frames(adapter.events(spark, d)), "raw_payload")


@query("SELECT CAST(user_id AS VARCHAR) AS value, count(*) AS n, true AS within FROM events GROUP BY 1")
def frequent_keys(spark, d):
    """Every key's exact count beside the verdict on its summary's bounds; a key that the summary has not must be rare."""
    ev = adapter.events(spark, d)
    exact = ev.groupBy(F.col("user_id").cast("string").alias("value")).agg(F.count("*").alias("n"))
    found = profile.frequent(ev, "user_id", 50)
    both = exact.join(found.drop("rows"), "value", "left").crossJoin(F.broadcast(ev.agg(F.count("*").alias("rows"))))
    rare = F.col("at_least").isNull() & (F.col("n") * 51 <= F.col("rows"))
    within = rare | F.coalesce((F.col("at_least") <= F.col("n")) & (F.col("n") <= F.col("at_most")) & ((F.col("at_most") - F.col("at_least")) * 51 <= F.col("rows")), F.lit(False))
    return both.select("value", "n", within.alias("within"))


@query(
    f"""WITH {_EDITS}, keys AS (SELECT domain AS k, count(*) AS c FROM sized GROUP BY 1), coded AS (SELECT c, {_CRC} AS h FROM keys),
parts AS (SELECT n, h % n AS part, sum(c) AS rows, max(c) AS top FROM coded, (SELECT unnest([1, 3, 6, 12, 24]) AS n) GROUP BY 1, 2)
SELECT n, round(max(rows)::DOUBLE / sum(rows), 4) AS crc32_share, round(max(top)::DOUBLE / sum(rows), 4) AS floor, true AS not_worse FROM parts GROUP BY n"""
)
def weighted_partitions(spark, d):
    """Is the busiest partition, with keys dealt by weight, no busier than with crc32, and no less than the heaviest key?"""
    got = profile.dealt(_edits(spark, d), "domain")
    fine = (F.col("weighted_share") <= F.col("crc32_share")) & (F.col("weighted_share") >= F.greatest("floor", F.round(1 / F.col("n"), 4)) - 0.0001)
    return got.select("n", "crc32_share", "floor", fine.alias("not_worse"))


@query(
    f"""WITH {_JUDGED}, f AS (SELECT * FROM judged WHERE n % 101 <> 0), m AS (
  SELECT count_if(n % 113 = 0) AS k, count_if(n % 103 = 0) + count_if(n % 107 = 0) + count_if(n % 113 = 0) AS c FROM f), u AS (SELECT count_if(n % 101 = 0) AS u FROM judged)
SELECT 'decodable' AS check, CASE WHEN u > 0 THEN 'warn' ELSE 'ok' END AS level, CAST(u AS BIGINT) AS found FROM u
UNION ALL SELECT 'keyable', CASE WHEN k > 0 THEN 'bad' ELSE 'ok' END, CAST(k AS BIGINT) FROM m UNION ALL SELECT 'complete', CASE WHEN c > 0 THEN 'bad' ELSE 'ok' END, CAST(c AS BIGINT) FROM m
UNION ALL SELECT 'contract', 'bad', CAST(count(*) + 1 AS BIGINT) FROM f WHERE n % 97 <> 0"""
)
def smoke_report(spark, d):
    """bot is not declared, so every frame that has it (all but canaries) is found; comment is declared and no frame has it."""
    names = ["$schema", "meta", "type", "namespace", "title", "user", "wiki", "length", "comment"]
    required = {"id": "$.meta.id", "dt": "$.meta.dt", "domain": "$.meta.domain"}
    return smoke.report(adapter.frames(adapter.events(spark, d)), "$.meta.domain", required, names)


@query(
    f"""WITH {_JUDGED}, q AS (SELECT count(*) AS n FROM quarantine), w AS (SELECT count(*) AS n FROM sized WHERE bytes_delta < 0)
SELECT * FROM (VALUES ('edits', NULL, 'built', NULL), ('quarantine', NULL, 'built', NULL), ('minutes', NULL, 'built', NULL), ('wikis', NULL, 'built', NULL), ('sides', NULL, 'built', NULL),
  ('health', NULL, 'skipped', NULL), ('edits', 'ids_unique', 'passed', 0), ('sides', 'wikis_known', 'passed', 0), ('health', 'hours_unique', 'skipped', NULL)) t(model, gate, status, found)
UNION ALL SELECT 'quarantine', 'nothing_rejected', 'failed', n FROM q UNION ALL SELECT 'edits', 'no_shrinking', 'warned', n FROM w"""
)
def build_with_gates(spark, d):
    """Six models and five gates as one build. A gate on the rejects fails and stops what hangs on them; a warning stops nothing."""
    m = build.Model
    models = [
        m("edits", lambda t: _stg(spark, d)), m("quarantine", lambda t: marts.stg_quarantine(_quarantine(spark, d))),
        m("minutes", lambda t: marts.edits_per_minute(t["edits"], CUTOFF), ("edits",)), m("wikis", lambda t: marts.dim_wikis(t["edits"], CUTOFF), ("edits",)),
        m("sides", lambda t: marts.bot_vs_human_hourly(t["edits"], CUTOFF), ("edits",)),
        m("health", lambda t: marts.pipeline_health(t["edits"], t["quarantine"], CUTOFF), ("edits", "quarantine")),
    ]
    gates = [
        build.Gate("ids_unique", "edits", lambda t: checks.duplicate_keys(t["edits"], ["event_id"])),
        build.Gate("no_shrinking", "edits", lambda t: t["edits"].where("bytes_delta < 0"), warns=True),
        build.Gate("nothing_rejected", "quarantine", lambda t: t["quarantine"]),
        build.Gate("wikis_known", "sides", lambda t: t["sides"].join(t["wikis"], "wiki", "left_anti"), ("wikis",)),
        build.Gate("hours_unique", "health", lambda t: checks.duplicate_keys(t["health"], ["bucket_hour"])),
    ]
    return build.run(spark, scratch.folder(spark), models, gates).drop("reason")


# More of streaming, and of what the catalog and the layouts hold


@query(f"WITH {_EDITS} SELECT event_hour, wiki, count(*) AS events, max(bytes_delta) AS largest FROM stg WHERE wiki IS NOT NULL GROUP BY 1, 2")
def stream_update_counts(spark, d):
    """Update mode: each trigger gives the groups it changed, and the last of each group's rows is its value."""
    root = scratch.folder(spark)
    rows = _stg(spark, d).where(F.col("wiki").isNotNull()).select("event_hour", "wiki", "bytes_delta")
    rows.repartition(4).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    jobs.update_counts(stream.groupBy("event_hour", "wiki").agg(F.count("*").alias("events"), F.max("bytes_delta").alias("largest")), f"{root}/out", f"{root}/c", once=True).awaitTermination()
    return jobs.latest(spark.read.parquet(f"{root}/out"), ["event_hour", "wiki"])


@query(
    f"""WITH {_JUDGED} SELECT event_id, bytes_new, failure_reason FROM judged WHERE failure_reason IS NULL AND NOT again
UNION ALL SELECT event_id, NULL AS bytes_new, failure_reason FROM quarantine"""
)
def stream_crash_recovery(spark, d):
    """A batch that dies between its two writes: the next start runs it again from the checkpoint, and its rows are there once."""
    root = scratch.folder(spark)
    adapter.log(adapter.events(spark, d)).withColumn("key", F.lit(None).cast("binary")).write.parquet(f"{root}/log/changes")

    def dies(batch: DataFrame, batch_id: int) -> None:
        judged = medallion.candidates(batch)
        layout.insert_absent(silver.tables(spark, root, 8)["edits"], medallion.valid_rows(judged), wire.EDITS_KEY)
        raise InterruptedError("between two writes")

    stream = record_log.read_stream(spark, f"{root}/log", "changes")
    q = jobs.start_batches(medallion.frames_from_log(stream), jobs.SILVER, f"{root}/checkpoints", dies, True)
    try:
        q.awaitTermination()
    except StreamingQueryException as e:
        if "between two writes" not in str(e):
            raise
    else:
        raise AssertionError("the first run was to die")
    silver.start(record_log.read_stream(spark, f"{root}/log", "changes"), root, f"{root}/checkpoints", once=True, buckets=8).awaitTermination()
    names = silver.tables(spark, root, 8)
    good = layout.read(spark, names["edits"]).select("event_id", "bytes_new", F.lit(None).cast("string").alias("failure_reason"))
    return good.unionByName(layout.read(spark, names["quarantine"]).select("event_id", F.lit(None).cast("long").alias("bytes_new"), "failure_reason"))


@query(f"WITH {_JUDGED} SELECT CAST(count(*) AS BIGINT) AS input_rows, true AS has_end, 'silver' AS observed, CAST(count(*) AS BIGINT) AS frames FROM judged")
def stream_progress(spark, d):
    """A query on a processing-time trigger that is stopped once it has read everything: its progress, added up over its triggers."""
    root = scratch.folder(spark)
    adapter.log(adapter.events(spark, d)).withColumn("key", F.lit(None).cast("binary")).write.parquet(f"{root}/log/changes")
    q = silver.start(record_log.read_stream(spark, f"{root}/log", "changes"), root, f"{root}/checkpoints", buckets=8)
    q.processAllAvailable()
    q.stop()
    seen = [p for p in q.recentProgress if p["numInputRows"]]
    frames = sum(p["observedMetrics"]["silver"]["frames"] for p in seen)
    row = (sum(p["numInputRows"] for p in seen), bool(jobs.progress(q)["end_offsets"]), "silver", frames)
    return spark.createDataFrame([row], "input_rows long, has_end boolean, observed string, frames long")


@query(
    f"""WITH {_EDITS} SELECT 'minutes_is_not_empty' AS name, count(*) > 0 AS passed, 'warn' AS severity FROM stg WHERE {_SEEN}
UNION ALL SELECT 'unsized_purchases_is_not_empty', count(*) > 0, 'warn' FROM sized WHERE change_type = 'new' AND bytes_new IS NULL"""
)
def marts_not_empty(spark, d):
    """A mart with rows, and one that has none (purchases always have a size)."""
    e = _edits(spark, d)
    empty = e.where("change_type = 'new' AND bytes_new IS NULL")
    marts_ = {"minutes": marts.edits_per_minute(_stg(spark, d), CUTOFF), "unsized_purchases": empty}
    got = checks.as_rows(spark, checks.run_checks(_judged(spark, d), e, _quarantine(spark, d), marts_, NOW))
    return got.where(F.col("name").endswith("_is_not_empty"))


@query("SELECT table_name, count(*) AS columns FROM information_schema.columns WHERE table_name IN ('events', 'nation', 'lineitem') GROUP BY 1")
def catalog_listing(spark, d):
    """Tables of a database of its own, with their numbers of columns."""
    root = scratch.folder(spark)
    database = f"listed_{root.rsplit('-', 1)[1]}"
    spark.sql("CREATE DATABASE IDENTIFIER(:d)", args={"d": database})
    for t in ("events", "nation", "lineitem"):
        spark.read.parquet(f"{d}/{t}.parquet").write.option("path", f"{root}/{t}").saveAsTable(f"{database}.{t}")
    return analysis.table_listing(spark, database)


@query(f"WITH {_EDITS} SELECT count(*) AS rows, 0 AS inversions FROM sized")
def write_order(spark, d):
    """Are the rows of every file of a bucketed table sorted by its key, as they lie there?"""
    e = _edits(spark, d).select("event_id", "bytes_new")
    name = layout.bucketed(spark, scratch.folder(spark), e.schema, wire.EDITS_KEY, 8)
    layout.insert_absent(name, e, wire.EDITS_KEY)
    at = spark.table(name).select("event_id", "_metadata.file_path", "_metadata.row_index")
    before = F.lag("event_id").over(Window.partitionBy("file_path").orderBy("row_index"))
    return at.withColumn("before", before).agg(F.count("*").alias("rows"), F.count_if(F.col("before") > F.col("event_id")).cast("int").alias("inversions"))


@query(
    f"""WITH {_EDITS}, ranked AS (SELECT 'user' || user_id AS key, events.event_id AS n, row_number() OVER (PARTITION BY user_id, half ORDER BY events.event_id) AS r, half
  FROM events, LATERAL (SELECT events.event_id % 2 AS half)), first AS (SELECT key, min(half) AS half FROM ranked GROUP BY key)
SELECT ranked.key, n FROM ranked JOIN first ON ranked.key = first.key AND ranked.half = first.half WHERE r = 1"""
)
def stream_keyed_state(spark, d):
    """The first event of each user, ever: even events come in a first run, odd ones in a second that starts from the first one's checkpoint."""
    root = scratch.folder(spark)
    rows = adapter.events(spark, d).select(F.concat(F.lit("user"), "user_id").alias("key"), F.col("event_id").alias("n"))
    keyed.use_rocksdb(spark)
    for half in (0, 1):
        rows.where(F.col("n") % 2 == half).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        found = keyed.first_arrivals(stream, "key", ("n",))
        found.writeStream.outputMode("append").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).format("parquet").start(f"{root}/out").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


@query(
    f"""WITH {_EDITS} SELECT event_minute, wiki, change_type, {_MEASURES}, min(event_time) AS first_event_at, max(event_time) AS last_event_at
FROM stg WHERE {_SEEN} AND NOT ({_TAKEN}) GROUP BY event_minute, wiki, change_type"""
)
def delta_stored_minutes(spark, d):
    """The minutes as files by day: first what came, then what went, each a change that reads and replaces the days it falls into."""
    before, came, went, after = _change(spark, d)
    root, day = scratch.folder(spark), "CAST(event_minute AS DATE)"
    delta.store(delta.full(before, MINUTES), MINUTES, root, day)
    delta.update(spark, MINUTES, root, day, came, None, after)
    delta.update(spark, MINUTES, root, day, came.where("false"), went, after)
    return delta.stored(spark, MINUTES, root).groups.drop(delta.PART).withColumnRenamed("rows", "events")
