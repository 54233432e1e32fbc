"""Tables in Spark's own layouts: bucketed and sorted by key for merges, partitioned by a column for pruning and for overwriting parts.

A bucketed table is read bucket by bucket, already dealt and sorted by its key, so a merge into it moves the new rows only: history has no exchange, however
long it is. Of history a merge reads the key columns alone.
"""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import medallion
from ..plans import marts


def bucketed(spark: SparkSession, path: str, schema: StructType | str, keys: tuple[str, ...], buckets: int = 64, partition: str | None = None) -> str:
    """The name of the table at path, bucketed and sorted by keys; it is made where it isn't there, and found again by a new session.

    Take about as many buckets as a merge has tasks: their number is fixed when the table is made."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    name = f"millrace_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    if spark.catalog.tableExists(name):
        return name

    def quoted(names: tuple[str, ...]) -> str:
        return ", ".join(f"`{n.replace('`', '``')}`" for n in names)

    columns = ", ".join(f"{quoted((f.name,))} {f.dataType.simpleString()}" for f in schema)
    within = f"PARTITIONED BY ({quoted((partition,))})" if partition else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {within} CLUSTERED BY ({quoted(keys)}) SORTED BY ({quoted(keys)}) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{path.replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39))}'"
    )
    if partition and spark.conf.get("spark.sql.catalogImplementation") == "hive":
        spark.catalog.recoverPartitions(name)
    return name


def read(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now: what other sessions wrote since this one last looked is seen."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def absent(name: str, source: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The rows of source whose keys the table lacks; source must have unique keys."""
    return medallion.insert_absent(read(source.sparkSession, name).select(*keys), source, keys)


def insert_absent(name: str, source: DataFrame, keys: tuple[str, ...], more: dict[str, Column] | None = None) -> dict[str, int]:
    """Appends what absent() gives, in one job: a replay of the same rows appends nothing. Returns `new`, the rows written, and
    the aggregates in `more` over source's rows, all observed while they pass by."""
    seen, written = Observation(), Observation()
    rows = source.observe(seen, F.count("*").alias("_rows"), *(c.alias(n) for n, c in (more or {}).items()))
    new = absent(name, rows, keys).select(*source.sparkSession.table(name).columns).observe(written, F.count("*").alias("new"))
    new.write.insertInto(name)
    return {n: seen.get[n] for n in more or {}} | {"new": written.get["new"]}


def write_parts(df: DataFrame, path: str, by: str) -> None:
    """Writes df by the values of a column. Where path has these values already, their parts are replaced, and no others are touched."""
    df.repartition(by, F.pmod(F.xxhash64(*[c for c in df.columns if c != by]), F.lit(8))).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(by).parquet(path)


def touched_parts(rows: DataFrame, by: str, since: datetime, cutoff: datetime) -> DataFrame:
    """rows of the parts that rows ingested in [since, cutoff) fall into. rows must be read from files partitioned by `by`: the touched values are
    found first and become a filter of the second scan, which opens only their folders."""
    new = marts.touched(rows, by, since, cutoff)
    return rows.join(F.broadcast(new), by, "left_semi")  # at most as many values as the table has parts
