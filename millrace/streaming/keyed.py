"""Exact deduplication of a stream by state for each key, kept in RocksDB.

A key's state is one flag, so a trigger looks up the keys it has and nothing else: no table of the past is scanned or joined, however long it is.
State lies with its partition on local disk and, as changes, in the checkpoint, from which a restarted query has it again. Keys never expire: a copy is found
however late it comes. To start from a table that is there already, give its keys as seen.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State in RocksDB, with changes and not whole copies written to the checkpoint. For queries that start after this."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def first_arrivals(rows: DataFrame, key: str, order: tuple[str, ...], seen: DataFrame | None = None) -> DataFrame:
    """Of a stream's rows with equal key the first, ever; within a trigger the first by order (nulls last). Rows of a null key are dropped.

    seen: a batch frame with the keys that were there before the query first started; it is read once."""
    from pyspark.sql.streaming import StatefulProcessor

    known = StructType([StructField("seen", BooleanType())])

    class First(StatefulProcessor):
        """Defined here, so that executors get it with the plan."""

        def init(self, handle) -> None:
            self.seen = handle.getValueState("seen", known)

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            if self.seen.exists():
                return
            self.seen.update((True,))
            yield min(rows, key=lambda r: [(r[c] is None, r[c]) for c in order])

        def handleInitialState(self, key, initialState, timerValues) -> None:
            self.seen.update((True,))

        def close(self) -> None: ...

    grouped = rows.where(F.col(key).isNotNull()).groupBy(key)
    start = None if seen is None else seen.where(F.col(key).isNotNull()).select(key).groupBy(key)
    return grouped.transformWithState(statefulProcessor=First(), outputStructType=rows.schema, outputMode="Append", timeMode="None", initialState=start)
