"""The `events` table as edits, frames and log records, by fixed rules, so that results can be said in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, wire


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, with ts as an instant. All times here are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def plain(df: DataFrame) -> DataFrame:
    """df with its times as timestamps without zone, for comparison."""
    return df.select(*(F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes))


def _late() -> Column:
    return (F.col("event_id") * 7919) % 3600


def _described(ev: DataFrame) -> DataFrame:
    """event_id as number (n) and the wire's fields."""
    canary = F.col("event_id") % 97 == 0
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")

    def edit(c: Column) -> Column:
        return F.when(~canary, c)

    sized = ~canary & ~kind.isin("view", "signup")
    change = F.when(kind == "view", "categorize").when(kind == "purchase", "new").when(kind == "signup", "log").otherwise("edit")
    return ev.select(
        F.col("event_id").alias("n"), F.col("ts"), F.concat(F.lit("e"), "event_id").alias("event_id"),
        edit(F.concat(F.lit("wiki"), F.col("user_id") % 7)).alias("wiki"),
        F.when(canary, "canary").otherwise(
            F.concat(F.lit("w"), F.col("user_id") % 7, F.lit("."), F.col("event_id") % 2, F.lit(".example"))
        ).alias("domain"),
        edit(change).alias("change_type"), edit(k % 15).alias("namespace_id"), edit(F.concat(F.lit("P"), k)).alias("page_title"),
        edit(F.concat(F.lit("u"), "user_id")).alias("editor"), edit(F.col("user_id") % 5 == 0).alias("is_bot"),
        F.when(sized, F.round(F.col("value") * 100).cast("long")).alias("bytes_new"),
        F.when(sized & (kind != "purchase"), (F.col("event_id") * 37) % 5000).alias("bytes_old"),
        (F.col("ts") + F.make_dt_interval(secs=_late())).alias("ingested_at"),
        (F.col("user_id") % 3).cast("int").alias("kafka_partition"), (F.col("event_id") * 2).alias("kafka_offset"),
    )


def edits(ev: DataFrame) -> DataFrame:
    """Validated edits as silver has them, made straight from the table (no faults)."""
    d = _described(ev)
    none = F.lit(None)
    return d.select(
        "event_id", F.col("ts").alias("event_time"), "wiki", "domain", "change_type", "namespace_id",
        (F.col("namespace_id") == 0).alias("is_article"), "page_title", none.cast("string").alias("page_url"), "editor", "is_bot",
        none.cast("boolean").alias("is_minor"), rules.is_anonymous(F.col("editor")).alias("is_anonymous"), "bytes_old", "bytes_new",
        rules.bytes_delta(F.col("bytes_old"), F.col("bytes_new")).alias("bytes_delta"), none.cast("long").alias("rev_old"),
        none.cast("long").alias("rev_new"), none.cast("string").alias("comment"),
        (F.unix_timestamp("ingested_at") - F.unix_timestamp("ts")).alias("late_by_seconds"), "ingested_at",
        F.to_date("ts").alias("event_date"),
    )


# Residue classes of event_id that are made faulty, in the order of the rules they break.
FAULTS = {
    "payload_not_json": 101, "event_id_missing": 103, "event_time_missing": 107, "event_time_unparseable": 109,
    "domain_missing": 113, "event_time_before_wikipedia": 127, "event_time_in_future": 131,
}


def frames(ev: DataFrame) -> DataFrame:
    """Raw JSON frames with injected faults, and for every 13th a second frame with the same id, at the next offset."""
    d = _described(ev)

    def fault(name: str) -> Column:
        return F.col("n") % FAULTS[name] == 0

    again = d.where("n % 13 = 0").withColumns({"bytes_new": F.col("bytes_new") + 1, "kafka_offset": F.col("kafka_offset") + 1})
    all_ = d.unionByName(again)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    dt = (
        F.when(fault("event_time_missing"), F.lit(None).cast("string"))
        .when(fault("event_time_unparseable"), F.lit("17/09/2026 04:00"))
        .when(fault("event_time_before_wikipedia"), F.lit("1999-01-01T00:00:00Z"))
        .when(fault("event_time_in_future"), F.lit("2099-01-01T00:00:00Z"))
        .otherwise(stamp)
    )
    body = F.to_json(
        F.struct(
            F.lit("/schema/1.0.0").alias("$schema"),
            F.struct(
                F.when(~fault("event_id_missing"), F.col("event_id")).alias("id"), dt.alias("dt"),
                F.when(~fault("domain_missing"), F.col("domain")).alias("domain"),
            ).alias("meta"),
            F.col("change_type").alias("type"), F.col("namespace_id").alias("namespace"), F.col("page_title").alias("title"),
            F.col("editor").alias("user"), F.col("is_bot").alias("bot"), "wiki",
            F.struct(F.col("bytes_old").alias("old"), F.col("bytes_new").alias("new")).alias("length"),
        )
    )
    raw = F.when(fault("payload_not_json"), F.concat(F.lit("{not json "), "n")).otherwise(body)
    return all_.select(
        raw.alias("raw_payload"), F.lit("recentchange").alias("kafka_topic"), "kafka_partition", "kafka_offset",
        F.col("ingested_at").alias("kafka_timestamp"), "ingested_at",
    )


def log(ev: DataFrame) -> DataFrame:
    """The frames as records of a log with dense offsets in each partition."""
    from pyspark.sql import Window

    f = frames(ev)
    dense = F.row_number().over(Window.partitionBy("kafka_partition").orderBy("kafka_offset")) - 1
    return f.select(
        F.col("raw_payload").cast("binary").alias("value"), F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"), dense.cast("long").alias("offset"), F.col("kafka_timestamp").alias("timestamp"),
    )
