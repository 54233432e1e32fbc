"""Profiles of raw JSON and of keys in one pass: nested paths found through VARIANT, frequent values by mergeable summaries."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import ratio
from ..plans import scratch

#: Counters of a summary: a value that is more than 1 in COUNTERS + 1 of all is always found.
COUNTERS = 1000
#: Depth to which paths are followed.
DEEPEST = 12


def _kind(value: str):
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    number = name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    return F.when(F.is_variant_null(value), "null").when(number, "number").otherwise(F.lower(name))


def paths(df: DataFrame, raw: str, deepest: int = DEEPEST) -> DataFrame:
    """path, kind, n: every path that occurs in JSON texts, `[]` for the elements of an array, and how many values of each kind it has.

    No path is given: each level is exploded by a lateral join from the one above, and counted; levels end where no object or array is left. A level is
    written before it is counted and exploded, with the values of objects and arrays alone, so texts are parsed once.
    A name with a dot, a bracket or a quote is put between quotes. Texts that don't parse are left out."""
    spark = df.sparkSession
    level = df.select(F.lit("").alias("path"), F.try_parse_json(raw).alias("value")).where(F.col("value").isNotNull())
    out, root = None, scratch.folder(spark)
    for depth in range(deepest):
        kind = _kind("value")
        level.select("path", kind.alias("kind"), F.when(kind.isin("object", "array"), F.col("value")).alias("value")).write.parquet(f"{root}/{depth}")
        level = spark.read.parquet(f"{root}/{depth}")
        counted = level.groupBy("path", "kind").agg(F.count("*").alias("n"))
        out = counted if out is None else out.unionByName(counted)
        inside = level.where(F.col("value").isNotNull()).drop("kind")
        if inside.isEmpty():
            break
        plain = ~F.col("key").rlike(r"[.\[\]\"]")
        step = F.when(F.col("key").isNull(), "[]").when(plain, F.col("key")).otherwise(F.to_json(F.array("key")).substr(F.lit(2), F.length(F.to_json(F.array("key"))) - 2))
        each = inside.lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).select("key", F.col("value").alias("inner")))
        join = F.when((F.col("path") == "") | F.col("key").isNull(), F.col("path")).otherwise(F.concat("path", F.lit(".")))
        level = each.select(F.concat(join, step).alias("path"), F.col("inner").alias("value"))
    return out.where("path <> ''")


def frequent(df: DataFrame, column: str, most: int = COUNTERS) -> DataFrame:
    """value, at_least, at_most, rows: summaries of at most `most` counters, made of each partition in one pass and added up by value.

    A value's count lies between at_least and at_most, which differ by rows / (most + 1) at most, and every value with more rows than that is there.
    What is shuffled are counters, not rows; nulls are left out."""

    def kept(counts: Counter) -> int:
        """Brings a summary back to `most` counters by taking the next largest count off all; how much that was."""
        if len(counts) <= most:
            return 0
        off = sorted(counts.values(), reverse=True)[most]
        for k in [k for k, c in counts.items() if c <= off]:
            del counts[k]
        for k in counts:
            counts[k] -= off
        return off

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, off, rows = Counter(), 0, 0
        for b in batches:
            for x in pc.value_counts(b.column(0)):
                if x["values"].is_valid:
                    counts[x["values"].as_py()] += x["counts"].as_py()
                    rows += x["counts"].as_py()
            off += kept(counts)
        values = [None, *counts]  # the first row has what was taken off, and how many rows there were
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, pa.string()), pa.array([off, *counts.values()], pa.int64()), pa.array([rows] + [0] * len(counts), pa.int64())], ["value", "n", "rows"]
        )

    parts = df.select(F.col(column).cast("string").alias("value")).mapInArrow(summarise, "value string, n long, rows long")
    added = parts.groupBy("value").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    total = added.where("value IS NULL").select(F.col("n").alias("off"), F.col("rows").alias("all"))  # one row
    found = added.where("value IS NOT NULL").crossJoin(F.broadcast(total))
    return found.select("value", F.col("n").alias("at_least"), (F.col("n") + F.col("off")).alias("at_most"), F.col("all").alias("rows"))


def dealt(df: DataFrame, key: str, sizes: tuple[int, ...] = (1, 3, 6, 12, 24), most: int = COUNTERS) -> DataFrame:
    """n, crc32_share, weighted_share, floor: share of the busiest of n partitions, with keys dealt by crc32 and by weight.

    By weight the frequent keys (at most `most`, from their summary) go one after the other, the heaviest first, to the partition with least so far;
    all other keys are taken as spread evenly. floor is the heaviest key's share: no way of dealing keys gets below."""
    spark = df.sparkSession
    heavy = [(r["value"], r["at_least"], r["rows"]) for r in frequent(df, key, most).orderBy(F.desc("at_least"), "value").limit(most).collect()]
    total = heavy[0][2] if heavy else 0
    rest = total - sum(c for _, c, _ in heavy)
    rows = []
    for n in sizes:
        load = [rest / n] * n
        for _, c, _ in heavy:
            k = load.index(min(load))
            load[k] += c
        rows.append((n, round(max(load) / total, 4) if total else None))
    weighted = spark.createDataFrame(rows, "n int, weighted_share double")
    keys = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count("*").alias("c"))
    spread = keys.withColumn("n", F.explode(F.array(*(F.lit(s) for s in sizes))))
    parts = spread.groupBy("n", (F.crc32(F.col("k").cast("binary")) % F.col("n")).alias("partition")).agg(F.sum("c").alias("rows"), F.max("c").alias("top"))
    by_hash = parts.groupBy("n").agg(ratio(F.max("rows"), F.sum("rows")).alias("crc32_share"), ratio(F.max("top"), F.sum("rows")).alias("floor"))
    return by_hash.join(F.broadcast(weighted), "n").select("n", "crc32_share", "weighted_share", "floor")
