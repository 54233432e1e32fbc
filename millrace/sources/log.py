"""The record log: Kafka where its connector is there, else a folder of Parquet files with Kafka's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import text_field

LOG = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
#: Records (Kafka) and files (folder) that a trigger takes at most.
RECORDS_PER_TRIGGER, FILES_PER_TRIGGER = 20_000, 16


def has_kafka(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def read_stream(spark: SparkSession, at: str, topic: str, starting: str = "earliest", servers: str | None = None) -> DataFrame:
    """A topic as a stream; with servers from Kafka, else from the folder at/topic."""
    if servers:
        return (
            spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("startingOffsets", starting).option("failOnDataLoss", "false")
            .option("maxOffsetsPerTrigger", RECORDS_PER_TRIGGER).option("groupIdPrefix", "millrace").load()
        )
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(f"{at}/{topic}")


def read(spark: SparkSession, at: str, topic: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(f"{at}/{topic}")


def create(spark: SparkSession, at: str, topic: str, partitions: int) -> int:
    """Makes a topic of a folder log, or gives an existing one more partitions; how many it has then. It never has fewer than before."""
    from .store import Fs

    fs, path = Fs(spark, at), f"{at}/_topics/{topic}"
    have = partitions_of(fs, path)
    if have is None or partitions > have:
        if partitions < 1:
            raise ValueError("a topic has a partition at least")
        if have is not None:
            fs.delete(path)
        fs.create(path, str(partitions))
        return partitions
    return have


def partitions_of(fs, path: str) -> int | None:
    return int(fs.read(path)) if fs.list(path) else None


def partitions(spark: SparkSession, at: str, topic: str, default: int = 3) -> int:
    """Partitions of a topic of a folder log."""
    from .store import Fs

    return partitions_of(Fs(spark, at), f"{at}/_topics/{topic}") or default


def append(df: DataFrame, at: str, topic: str, partitions: int = 3) -> None:
    """Adds records (key, value, timestamp): the partition is crc32(key) % partitions, records without key are spread
    by their value; offsets go on, dense, in the order of time and value."""
    from pyspark.sql import Window

    spark = df.sparkSession
    by = F.coalesce(F.col("key"), F.col("value"))
    placed = df.withColumn("partition", (F.crc32(by) % partitions).cast("int"))
    try:
        last = read(spark, at, topic).groupBy("partition").agg(F.max("offset").alias("last"))
    except Exception as e:  # the topic's first records
        if "PATH_NOT_FOUND" not in str(e):
            raise
        last = spark.createDataFrame([], "partition int, last long")
    order = Window.partitionBy("partition").orderBy("timestamp", "value")
    numbered = placed.withColumn("i", F.row_number().over(order)).join(F.broadcast(last), "partition", "left")  # a row a partition
    numbered.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit(topic).alias("topic"), "partition",
        (F.coalesce("last", F.lit(-1)) + F.col("i")).alias("offset"), "timestamp",
    ).write.mode("append").parquet(f"{at}/{topic}")


def keyed(raw: DataFrame) -> DataFrame:
    """raw (column raw string) as records: keyed by the frame's domain, the text verbatim."""
    key = text_field(F.col("raw"), "$.meta.domain")
    return raw.select(key.cast("binary").alias("key"), F.col("raw").cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One document a line; blank lines are skipped."""
    return spark.read.text(path).where(F.col("value").rlike(r"\S"))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
