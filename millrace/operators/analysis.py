"""Ad-hoc analyses: lag, keys, fields, partition balance, listings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rules import ratio

#: What may hold a semicolon that ends no statement: comments, strings and quoted names.
_QUOTED = re.compile(r"""--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`""", re.S)
# Upper bounds of the lag buckets, in seconds.
LAG_BOUNDS = (0, 60, 300, 900, 1800, 3600)


def lag_histogram(df: DataFrame, lag: str = "late_by_seconds") -> DataFrame:
    """bucket, n, share: buckets are (bound before, bound]; the last is open."""
    name = F.lit(f"> {LAG_BOUNDS[-1]}")
    for b in reversed(LAG_BOUNDS):
        name = F.when(F.col(lag) <= b, f"<= {b}").otherwise(name)
    known = df.where(F.col(lag).isNotNull())
    got = known.groupBy(name.alias("bucket")).agg(F.count("*").alias("n"))
    return got.withColumn("share", ratio(F.col("n"), F.sum("n").over(Window.partitionBy(F.lit(1))), 6))


def early_share(df: DataFrame, lag: str = "late_by_seconds") -> DataFrame:
    """rows and the share of rows with a lag below 0: the clocks' skew."""
    known = df.where(F.col(lag).isNotNull())
    return known.agg(F.count("*").alias("rows"), ratio(F.count_if(F.col(lag) < 0), F.count("*"), 6).alias("early_share"))


def nearest_rank(df: DataFrame, x: str, shares: tuple[float, ...]) -> DataFrame:
    """p, value: the value at index min(n - 1, round(p n)) of the sorted ones. Equal values are counted first, so what
    is sorted in one place is the distinct values, not the rows."""
    counts = df.where(F.col(x).isNotNull()).groupBy(x).agg(F.count("*").alias("c"))
    upto = Window.orderBy(x).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(Window.partitionBy(F.lit(1))))
    asked = F.explode(F.array(*(F.lit(float(s)) for s in shares))).alias("p")
    at = ranked.select(x, "c", "upto", "n", asked).withColumn("i", F.least(F.col("n") - 1, F.round(F.col("p") * F.col("n")).cast("long")))
    return at.where((F.col("i") < F.col("upto")) & (F.col("i") >= F.col("upto") - F.col("c"))).select("p", F.col(x).alias("value"))


def partition_skew(df: DataFrame, key: str, sizes: tuple[int, ...] = (1, 3, 6, 12, 24)) -> DataFrame:
    """For each number of partitions: share of the busiest under crc32(key) % n, idle partitions, and the floor
    that the most frequent key sets. Keys are counted once; what is multiplied by the sizes are the counts."""
    keys = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("c"))
    spread = keys.withColumn("n", F.explode(F.array(*(F.lit(s) for s in sizes))))
    placed = spread.withColumn("partition", F.coalesce(F.crc32(F.col("k").cast("binary")), F.lit(0)) % F.col("n"))
    parts = placed.groupBy("n", "partition").agg(F.sum("c").alias("rows"), F.max("c").alias("top"))
    return parts.groupBy("n").agg(
        ratio(F.max("rows"), F.sum("rows")).alias("busiest_share"), (F.first("n") - F.count("*")).cast("long").alias("idle"),
        ratio(F.max("top"), F.sum("rows")).alias("floor"),
    )


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """field, null_rate: one pass over the table."""
    row = F.struct(*(F.round(F.avg(F.col(c).isNull().cast("double")), 6).alias(f"c{k}") for k, c in enumerate(columns)))
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"r.c{k}").alias("null_rate")) for k, c in enumerate(columns)))
    return df.agg(row.alias("r")).select(F.explode(pairs).alias("x")).select("x.*")


def path_types(df: DataFrame, raw: str, paths: list[str]) -> DataFrame:
    """path, kind, n: of JSON texts, how often a dotted path has a value of each kind (absent, null, or the JSON type); texts are parsed once."""
    parsed = df.select(F.try_parse_json(raw).alias("v")).where(F.col("v").isNotNull())

    def kind(path: str):
        found = F.try_variant_get("v", f"$.{path}", "variant")
        name = F.regexp_extract(F.schema_of_variant(found), "^[A-Z]+", 0)
        number = name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
        return F.when(found.isNull(), "absent").when(F.is_variant_null(found), "null").when(number, "number").otherwise(F.lower(name))

    each = parsed.select(F.inline(F.array(*(F.struct(F.lit(p).alias("path"), kind(p).alias("kind")) for p in paths))))
    return each.groupBy("path", "kind").agg(F.count("*").alias("n"))


def id_distinctness(df: DataFrame, column: str) -> DataFrame:
    """rows, present, distinct_ids, repeated of an id column in one row."""
    got = df.agg(F.count("*").alias("rows"), F.count(column).alias("present"), F.countDistinct(column).alias("distinct_ids"))
    return got.withColumn("repeated", F.col("present") - F.col("distinct_ids"))


def key_presence(df: DataFrame, raw: str) -> DataFrame:
    """Top-level keys of JSON texts, with the number of texts that have them."""
    keys = df.select(F.explode(F.json_object_keys(raw)).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n"))


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties by value. A top-k of counts, never a full sort."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), column).limit(k)


def drift(spark: SparkSession, declared: list[str], observed: list[str]) -> DataFrame:
    """field, side: names that are only declared or only observed."""
    rows = [(f, "declared") for f in sorted(set(declared) - set(observed))] + [(f, "observed") for f in sorted(set(observed) - set(declared))]
    return spark.createDataFrame(rows, "field string, side string")


def drift_of(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """field, side of two frames with a column field: a full join, so neither side is held by the driver."""
    a, b = (x.select("field").distinct().withColumn(k, F.lit(True)) for x, k in ((declared, "d"), (observed, "o")))
    both = a.join(b, "field", "full").where("d IS NULL OR o IS NULL")
    return both.select("field", F.when(F.col("o").isNull(), "declared").otherwise("observed").alias("side"))


def outer_by_day(a: DataFrame, b: DataFrame) -> DataFrame:
    """Counts by day of two tables (columns day, n) side by side."""
    left, right = a.select("day", F.col("n").alias("left_n")), b.select("day", F.col("n").alias("right_n"))
    both = left.join(right, "day", "full")
    return both.select("day", F.coalesce("left_n", F.lit(0)).alias("left_n"), F.coalesce("right_n", F.lit(0)).alias("right_n"))


def table_listing(spark: SparkSession, database: str = "default") -> DataFrame:
    """Tables of a database with their number of columns: what the catalog lists, not rows."""
    tables = [(t.name,) for t in spark.catalog.listTables(database) if not t.isTemporary]
    columns = [(t, c.name) for (t,) in tables for c in spark.catalog.listColumns(f"{database}.{t}")]
    have = spark.createDataFrame(tables, "table_name string"), spark.createDataFrame(columns, "table_name string, column string")
    counts = have[1].groupBy("table_name").agg(F.count("*").alias("columns"))
    return have[0].join(counts, "table_name", "left").select("table_name", F.coalesce("columns", F.lit(0)).alias("columns"))


def single(sql: str) -> str:
    """The text of exactly one statement."""
    body = sql.strip().removesuffix(";").strip()
    bare = _QUOTED.sub(" ", body)
    if ";" in bare:
        raise ValueError("one statement at a time")
    if not body:
        raise ValueError("no statement")
    return body


def one_statement(spark: SparkSession, sql: str) -> DataFrame:
    """Runs exactly one SQL statement."""
    return spark.sql(single(sql))


def throughput(progress: DataFrame) -> DataFrame:
    """seconds, rows, bytes_in, bytes_stored (one row a trigger) as rates and ratios in one row."""
    return progress.agg(
        F.round(F.sum("rows") / F.nullif(F.sum("seconds"), F.lit(0)), 3).alias("rows_per_second"),
        F.round(F.sum("bytes_in") / F.nullif(F.sum("rows"), F.lit(0)), 3).alias("bytes_per_row"),
        F.round(F.sum("bytes_in") / F.nullif(F.sum("bytes_stored"), F.lit(0)), 3).alias("compression"),
    )
