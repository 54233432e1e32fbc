"""Shared pieces: lineage cuts in the shared folder, let-bindings, connected components."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free(spark) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more; else they stay until the driver happens to collect garbage.

    Twice: the first collection only ends what still refers to the last plan, and its shuffles go with the second."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.1)  # Spark's cleaner and the gateway let go in threads of their own


def give_back(spark) -> None:
    """Has every executor collect its garbage, after which its JVM returns the part of the heap that it no longer needs.

    A heap that one stage made large else stays large under the Python workers of the stages after it. One task for each core reaches all executors of an idle cluster."""
    free(spark)
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).selectExpr("java_method('java.lang.System', 'gc') AS done").write.format("noop").mode("overwrite").save()


def durable(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint.

    The folder is the one the session names in spark.checkpoint.dir, which all executors share;
    only where that is unset and Spark is local a temporary folder is used, on a cluster it is an error.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(True)


def shared_folder(spark) -> str:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="millrace-"))
    return sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()


def stored(df: DataFrame, *more: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: like durable(), but compressed, for larger tables.

    The rows of more, frames of the same columns, follow; each frame is run when the one before is written and its shuffles are freed."""
    path = f"{shared_folder(df.sparkSession)}/millrace-{uuid.uuid4().hex}"
    for part in (df, *more):
        free(df.sparkSession)
        part.write.mode("append").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._millrace_path = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that stored() gave and that no plan still to run reads."""
    for table in tables:
        sc = table.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(table._millrace_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def sized(df: DataFrame, most: int) -> DataFrame:
    """df, which must be cheap to count (stored), with a broadcast hint if it has at most so many rows."""
    return F.broadcast(df) if df.count() <= most else df


#: Bytes up to which a table is broadcast, as its rows are held in memory.
SENT_BYTES = 64 << 20


def small(df: DataFrame, most: int | None = None) -> bool:
    """Have the rows of df, which must be cheap to read (stored), at most so many bytes (SENT_BYTES)?

    A row's bytes: 16 for each column, 40 besides, and the length of its strings and arrays."""

    def long(name: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.octet_length(name)
        return F.octet_length(F.to_json(name)) if kind.startswith(("array", "map", "struct")) else F.lit(0)

    bytes_ = F.lit(40 + 16 * len(df.columns)) + sum((F.coalesce(long(n, k), F.lit(0)) for n, k in df.dtypes), F.lit(0))
    return (df.agg(F.sum(bytes_.cast("long"))).first()[0] or 0) <= (SENT_BYTES if most is None else most)


def sent(df: DataFrame, most: int | None = None) -> DataFrame:
    """df with a broadcast hint if it is small(); beyond that a shuffle joins it."""
    return F.broadcast(df) if small(df, most) else df


def unused(df: DataFrame, name: str = "") -> str:
    """A column name that df does not have and that begins none of its columns' names, in any case."""
    have = [c.lower() for c in df.columns]
    k = 0
    while any(c.startswith(f"_mr_{name}{k}_") for c in have):
        k += 1
    return f"_mr_{name}{k}_"


#: Settings for Arrow batches, our value and Spark's own.
BATCH = (("spark.sql.execution.arrow.maxRecordsPerBatch", "2000", "10000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "8m", "67108864b"))


def ship(spark) -> None:
    """Sends this package to the executors' Python, once for each Spark context (the driver serves the file).

    Rows go there in batches of at most BATCH rows and bytes, unless the session has its own setting: texts are long."""
    for key, most, usual in BATCH:
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, most)
    sc = spark.sparkContext
    if getattr(sc, "_millrace_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    name = os.path.join(tempfile.mkdtemp(prefix="millrace-ship-"), "millrace_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, str(Path(top.name, p.relative_to(top))))
    sc.addPyFile(name)
    sc._millrace_shipped = True


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body uses it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(struct: Column) -> Column:
    """The struct's fields as columns, for a select. It is a Generate of one row, which the optimizer does
    not merge with later projections; else the struct would be computed again for each field used."""
    return F.inline(F.array(struct))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (a, b), as rows (id, component).

    component is the smallest id of the component; only ids that have an edge to another id are
    returned. Alternating large-star and small-star rounds: every step is an aggregation with map-side
    combine or an equi-join, so no node's neighbours are gathered in one place. Null ends are dropped.
    """
    e = durable(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )

    def state(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    last = state(e)
    for _ in range(max_rounds):
        if not last[0]:
            break
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        e = durable(small)
        free(e.sparkSession)  # a round's shuffles and the driver's garbage
        now = state(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components: no convergence")
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
