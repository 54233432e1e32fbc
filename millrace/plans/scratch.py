"""A folder for tables that a query makes for itself."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group of a held table: a task reads a few.
ROW_GROUP = 16 << 20


def folder(spark: SparkSession) -> str:
    """A new path in the shared folder that the session names in spark.checkpoint.dir; a temporary one where that is unset and Spark is local."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir")
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="millrace-scratch-")
    return f"{base}/scratch-{uuid.uuid4().hex}"


@contextmanager
def held(df: DataFrame, root: str) -> Iterator[DataFrame]:
    """df, computed once, as a Parquet table below root for as long as the block lasts.

    Unlike a cache, in which a partition's rows are one block, its rows pass through a task and are never together in its memory."""
    spark = df.sparkSession
    path = f"{root}/held/{uuid.uuid4().hex}"
    try:
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
