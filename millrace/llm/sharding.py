"""Sharding by a k-d tree over metadata, law `bytes`.

Texts are points in metadata space (source, language, length); the space is split recursively at
distributed weighted medians along each node's widest dimension until every leaf holds its share of the bytes. Equal
texts are one group: they take the metadata of the group's first row, so they lie at one point, and only a
cut that falls inside a group divides it.

A median is found from histograms of 4096 bins, refined bin by bin through the order (dimension,
group, row, place in the input): what reaches the driver is at most leaves x 4096 sums a pass, whatever the input. No sort
of a node's rows is needed, and a group with a third of all rows is cut like any other.

Defined results: a null text has size 8 and checksum 0 and is no member of any group of texts; null metadata
is a value of its own; repeated rows (equal doc_id and text) lie at one point and are told apart by their place in the
input, so that a cut may fall between them; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import durable, sent, stored

BINS = 4096
#: A cut may miss its target by this share of a leaf's target; finer bins are read until it does.
TOLERANCE = 0.002
#: Rows of a part of a shard that is numbered by one sort.
ROWS_PER_PART = 200_000


def _bits(h: Column, k: int) -> Column:
    """The k-th 12 bits of a 64-bit hash, from the top."""
    return F.shiftrightunsigned(h, 64 - 12 * (k + 1)).bitwiseAND(F.lit(BINS - 1).cast("long")).cast("int")


def points(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the dimensions d0 to d2 (int, 0 to BINS - 1) and the order keys k1 to k9."""
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.when(F.col("text").isNull(), F.xxhash64(F.lit("null"), "doc_id")).otherwise(F.xxhash64("text")).alias("group"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.xxhash64(F.monotonically_increasing_id()).alias("at"),
    )
    # only groups of several rows are joined, so that as a rule they are few enough to be sent to the rows
    several = stored(
        rows.groupBy("group").agg(F.min(F.struct("doc_id", "source", "lang")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    at = durable(
        rows.join(sent(several), "group", "left").select(
            "doc_id", "size", "text_crc32", "group", "at",
            # length on a log scale: 1/128 of a doubling a bin
            F.least(F.lit(BINS - 1), F.round(F.log2("size") * 128)).cast("int").alias("d0"),
            *(F.when(F.col("first").isNull(), F.col(c)).otherwise(F.col(f"first.{c}")).alias(c) for c in ("source", "lang")),
        )
    )
    # names are placed by hash: neighbours mean nothing, but equal names stay together
    return at.select(
        "doc_id", "size", "text_crc32", "d0",
        F.pmod(F.xxhash64("source"), F.lit(BINS)).cast("int").alias("d1"),
        F.pmod(F.xxhash64("lang"), F.lit(BINS)).cast("int").alias("d2"),
        *(_bits(F.col("group"), k).alias(f"k{1 + k}") for k in range(3)),
        *(_bits(F.xxhash64("doc_id", F.col("group")), k).alias(f"k{4 + k}") for k in range(3)),
        *(_bits(F.col("at"), k).alias(f"k{7 + k}") for k in range(3)),
    )


def _widest(rows: DataFrame, nodes: list[int]) -> dict[int, int]:
    """Of each node the dimension with the largest spread of its bytes (weighted standard deviation over its full range)."""
    aggs = []
    for k in range(3):
        d = F.col(f"d{k}").cast("double")
        w = F.col("size").cast("double")
        aggs += [F.sum(w * d).alias(f"s{k}"), F.sum(w * d * d).alias(f"q{k}")]
    found = {}
    for r in rows.where(F.col("node").isin(nodes)).groupBy("node").agg(F.sum(F.col("size").cast("double")).alias("w"), *aggs).collect():
        spread = [max(0.0, r[f"q{k}"] / r["w"] - (r[f"s{k}"] / r["w"]) ** 2) for k in range(3)]
        found[r["node"]] = max(range(3), key=lambda k: (spread[k], -k))
    return found


def shards(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard int and slot long (gapless from 0 within a shard) for every row."""
    rows = points(docs).withColumn("node", F.lit(0))
    leaves = {0: (0, n_shards)}  # node: the shards it will be
    keys = [f"k{j}" for j in range(1, 10)]
    total = rows.agg(F.sum("size")).first()[0] or 0
    near = TOLERANCE * total / n_shards
    while any(b - a > 1 for a, b in leaves.values()):
        now = rows
        split = [n for n, (a, b) in leaves.items() if b - a > 1]
        axis = _widest(now, split)
        weight = {r["node"]: r["w"] for r in now.groupBy("node").agg(F.sum("size").alias("w")).collect()}
        goal, cut = {}, {n: [] for n in split}
        for n in split:
            a, b = leaves[n]
            goal[n] = weight.get(n, 0) * ((b - a) // 2) / (b - a)
        first = F.lit(0)
        for n, k in axis.items():
            first = F.when(F.col("node") == n, F.col(f"d{k}")).otherwise(first)
        now = now.withColumn("k0", first)
        open_ = [n for n in split if n in axis]
        for depth, key in enumerate(["k0", *keys]):
            if not open_:
                break
            inside = F.lit(False)
            for n in open_:
                here = F.col("node") == n
                for j, v in enumerate(cut[n]):
                    here = here & (F.col("k0" if j == 0 else keys[j - 1]) == v)
                inside = inside | here
            # at most len(open_) x BINS rows
            bins = now.where(inside).groupBy("node", F.col(key).alias("bin")).agg(F.sum("size").alias("w")).collect()
            still = []
            for n in open_:
                left = goal[n]
                own = sorted((r["bin"], r["w"]) for r in bins if r["node"] == n)
                for v, w in own:
                    if left < w:
                        break
                    left -= w
                else:
                    v, w = own[-1][0] + 1, 0
                # bins below v go left; v itself is cut further unless one side of it is near enough
                if left > near and w - left <= near:
                    v, left = v + 1, 0
                cut[n].append(v)
                goal[n] = left
                if left > near and depth < len(keys):
                    still.append(n)
            open_ = still
        after = {}
        for n, (a, b) in leaves.items():
            if n not in split:
                after[2 * n] = (a, b)
                continue
            m = a + (b - a) // 2
            after[2 * n], after[2 * n + 1] = (a, m), (m, b)
        is_right = F.lit(False)
        for n in split:
            below, same = F.lit(False), F.lit(True)
            dim = F.col(f"d{axis.get(n, 0)}")
            for j, v in enumerate(cut[n]):
                x = dim if j == 0 else F.col(keys[j - 1])
                below = below | (same & (x < v))
                same = same & (x == v)
            is_right = F.when(F.col("node") == n, ~below).otherwise(is_right)
        side = F.when(is_right, 1).otherwise(0)
        rows = durable(rows.withColumn("node", F.col("node") * 2 + side))
        leaves = after
    shard = F.lit(0)
    for n, (a, _) in leaves.items():
        shard = F.when(F.col("node") == n, F.lit(a)).otherwise(shard)
    return number(rows.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), "k4", "k7"))


def number(rows: DataFrame) -> DataFrame:
    """rows with slot: each shard is numbered part by part, the parts' counts say where each begins."""
    most = rows.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    parts = max(1, min(BINS * BINS, -(-most // ROWS_PER_PART)))
    place = (F.col("k4") * BINS + F.col("k7")).cast("long")  # by row, then by place in the input: repeated rows are divided too
    parted = rows.withColumn("part", F.floor(place * parts / (BINS * BINS)).cast("int"))
    counts = parted.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    ranked = parted.withColumn("rank", F.row_number().over(within)).join(starts, ["shard", "part"])
    return ranked.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("rank") - 1).cast("long").alias("slot")
    )


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    return shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
