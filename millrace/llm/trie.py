"""A prefix trie of conversations, built level by level.

A node is a distinct sequence of first turns (role, text); its members are the conversations that begin with it, and its name is its
depth with its smallest member. Per depth, live conversations are grouped by (parent node, next turn) and get the smallest conv_id
of their group; then joins from the deepest level up to the root add up leaves and savings.

Conversations of equal turns are one class from the start (a checksum of places and turns finds them, summed in each task), so
that a group of copies is one row on every level. A class is live while its node holds another class: from where it is alone its path has no more branches, and
its nodes are written down at once. So there are as many rounds as turns that two different conversations share, however long a conversation is.
Turns are numbered within 1,024 values of turn at a time, so no conversation has to be ordered in one task.

Defined results: rows of a null conv_id belong to no conversation and are left out; a null turn comes first; rows of equal turn are
ordered by role and then by a digest of the text; null role or text is empty; repeated rows are turns of their own; an empty
table has no nodes. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import stored

#: Values of turn ordered together, and ids of a class joined to one string, as powers of two.
TURNS_BITS, IDS_BITS = 10, 12


class Trie(NamedTuple):
    #: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, all long, and ends: the class that ends there (null: none).
    nodes: DataFrame
    #: ends, conv_id: the members of each class.
    members: DataFrame


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1, by turn), role, text, key (of role and text, 16 bytes), chars."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16).alias("key"),
        F.length(text).cast("long").alias("chars"),
    ).withColumn("chunk", F.shiftright("turn", TURNS_BITS))
    counts = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    later = counts.withColumn("before", F.sum("n").over(earlier)).where("before > 0").select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "before")
    within = F.row_number().over(Window.partitionBy("conv_id", "chunk").orderBy(F.asc_nulls_first("turn"), "role", "key"))
    # only a conversation's first chunk can be null, and nothing comes before it
    at = rows.withColumn("within", within).join(later, (F.col("conv_id") == F.col("c")) & (F.col("chunk") == F.col("k")), "left")
    return at.select("conv_id", (F.col("within") + F.coalesce("before", F.lit(0))).cast("long").alias("pos"), "role", "text", "key", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin alike: each takes the first h turns of its hundred's first conversation, then its own after
    its first h; h is crc32 of its decimal conv_id, modulo 6. turns are those of ordered(); its columns come back, and conv_id, n_turns."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("long")
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    bases = own.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    convs = stored(
        own.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
        .select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    )
    rest = [c for c in turns.columns if c not in ("conv_id", "pos")]
    heads = turns.where("conv_id % 100 = 0 AND pos <= 5").withColumnRenamed("conv_id", "base")
    first = convs.where("taken > 0").join(heads, "base").where("pos <= taken").select("conv_id", "pos", *rest)
    then = turns.where(F.col("pos") > h).join(convs, "conv_id").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), *rest)
    return first.unionByName(then), convs.select("conv_id", "n_turns")


def build(turns: DataFrame, convs: DataFrame) -> Trie:
    """The trie of conversations: turns has conv_id, pos (1, 2, ...), key and chars of each turn; convs has conv_id and n_turns, of turnless ones too."""
    turns = stored(turns.select("conv_id", "pos", "key", "chars"))
    sums = turns.groupBy("conv_id").agg(*(F.bit_xor(F.xxhash64("pos", "key", F.lit(k))).alias(f"x{k}") for k in (1, 2)))
    same = ["n_turns", "x1", "x2"]
    summed = stored(convs.join(sums, "conv_id", "left").select("conv_id", "n_turns", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("x1", "x2"))))
    classes = stored(summed.groupBy(*same).agg(F.min("conv_id").alias("rep"), F.count("*").alias("w")))
    several = classes.where("w > 1").select(*same, F.col("rep").alias("ends"))
    members = classes.where("w = 1").select(F.col("rep").alias("ends"), F.col("rep").alias("conv_id")).unionByName(summed.join(several, same).select("ends", "conv_id"))

    # level by level: a row for each class, with its node; a node's own row is that of the class that names it
    levels: list[DataFrame] = []
    live = classes.select("rep", "n_turns", "w", F.lit(None).cast("long").alias("parent"), F.lit(0).cast("long").alias("chars"), F.lit(b"").alias("key"))
    while True:
        depth = len(levels)
        groups = live.groupBy(F.col("parent").alias("p"), F.col("key").alias("k")).agg(F.min("rep").alias("node"), F.count("*").alias("n_classes"), F.sum("w").alias("n_convs"))
        same_node = F.col("parent").eqNullSafe(F.col("p")) & (F.col("key") == F.col("k"))
        level = stored(live.join(groups, same_node).select("rep", "n_turns", "w", "parent", "chars", "node", "n_classes", "n_convs"))
        levels.append(level)
        live = level.where((F.col("n_classes") > 1) & (F.col("n_turns") > depth)).select("rep", "n_turns", "w", F.col("node").alias("parent"))
        if live.isEmpty():
            break
        following = turns.where(F.col("pos") == depth + 1).select(F.col("conv_id").alias("rep"), "chars", "key")
        live = live.join(following, "rep")

    # nodes of one class, from where it is alone to its end
    alone = None
    for depth, level in enumerate(levels):
        new = level.where("n_classes = 1").select("rep", "n_turns", "w", "parent", F.lit(depth).cast("long").alias("top"))
        alone = new if alone is None else alone.unionByName(new)
    alone = stored(alone)
    single = alone.where("w = 1").select("*", F.explode(F.sequence("top", "n_turns")).alias("depth"), F.lit(0).cast("long").alias("saved"))
    own = turns.select(F.col("conv_id").alias("rep"), F.col("pos").alias("depth"), "chars")
    copied = alone.where("w > 1").join(own, "rep").where("depth >= top")
    copied = copied.unionByName(alone.where("w > 1 AND top = 0").select("*", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars")))
    to_end = Window.partitionBy("rep").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    copied = copied.withColumn("saved", (F.col("w") - 1) * F.sum("chars").over(to_end)).drop("chars")
    lone = stored(single.unionByName(copied))

    # from the deepest level up: leaves and savings of the children are added to their parents
    done, below = [], None
    for depth in range(len(levels) - 1, -1, -1):
        nodes = levels[depth].where("n_classes > 1 AND rep = node")
        ends = levels[depth].where((F.col("n_classes") > 1) & (F.col("n_turns") == depth)).select("node", F.col("rep").alias("ends"))
        kids = lone.where((F.col("top") == depth + 1) & (F.col("depth") == F.col("top"))).select("parent", F.lit(1).cast("long").alias("n_leaves"), "saved")
        kids = kids if below is None else kids.unionByName(below)
        sums = kids.groupBy("parent").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")).withColumnRenamed("parent", "node")
        saved = (F.col("n_convs") - 1) * F.col("chars") + F.col("saved")
        level = stored(
            nodes.select("node", "parent", "n_convs", "chars").join(sums, "node").join(ends, "node", "left")
            .select("node", "parent", "n_convs", "n_children", "n_leaves", saved.alias("saved"), "ends")
        )
        below = level.select("parent", "n_leaves", "saved")
        done.append(level.select(F.col("node").alias("conv_id"), F.lit(depth).cast("long").alias("depth"), "parent", "n_convs", "n_children", "n_leaves", "saved", "ends"))
    last = F.col("depth") == F.col("n_turns")
    nodes = lone.select(
        F.col("rep").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("top"), F.col("parent")).otherwise(F.col("rep")).alias("parent"),
        F.col("w").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), "saved",
        F.when(last, F.col("rep")).alias("ends"),
    )
    for level in done:
        nodes = nodes.unionByName(level)
    return Trie(nodes.withColumnRenamed("parent", "parent_conv_id").withColumnRenamed("saved", "saved_tokens"), members)


def last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """nodes with role and text of the last turn of each (the root's are null); turns has conv_id, pos, role and text."""
    named = turns.select("conv_id", F.col("pos").alias("depth"), "role", "text")
    return nodes.join(named, ["conv_id", "depth"], "left")


def _hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def id_digests(members: DataFrame) -> DataFrame:
    """ends, digest: SHA-256 of each class's decimal ids, ascending, comma-joined.

    Ids are joined in each range of 2^IDS_BITS values first; these strings are then streamed past one hash, so no class is held in memory."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hashed = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([hashed.hexdigest()])], ["ends", "digest"])

        for b in batches:
            for ends, ids in zip(b.column("ends").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if hashed is None or ends != key:
                    if hashed is not None:
                        yield row()
                    key, hashed = ends, hashlib.sha256(ids.encode())
                else:
                    hashed.update(b"," + ids.encode())
        if hashed is not None:
            yield row()

    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    parts = members.groupBy("ends", F.shiftright("conv_id", IDS_BITS).alias("part")).agg(ids.alias("ids"))
    return parts.repartition("ends").sortWithinPartitions("ends", "part").select("ends", "ids").mapInArrow(digest, "ends long, digest string")


def op12_conversation_trie(spark, sf_dir: str) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations. A class of one has the digest of its own id, larger ones that of id_digests()."""
    trie = build(*rebuilt(stored(ordered(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("role", "text"))))
    copies = trie.members.where("ends != conv_id").select("ends").distinct()
    digests = stored(id_digests(trie.members.join(copies, "ends")))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    own = F.coalesce("digest", F.when(F.col("ends").isNotNull(), _hex(F.col("ends").cast("string"))), _hex(F.lit("")))
    return trie.nodes.join(digests, "ends", "left").select(*names, own.alias("ends_sha256"))


# The comparison engine has no crc32: bits are shifted out one by one, eight for each byte.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""
OP12_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, n, conv_id - conv_id % 100 AS base, {_CRC32} % 6 AS h FROM (SELECT conv_id, CAST(conv_id AS VARCHAR) AS k, max(pos) AS n FROM t GROUP BY conv_id)
), r AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base WHERE t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id LEFT JOIN c b ON b.conv_id = c.base WHERE t.pos > c.h
), x AS (SELECT conv_id, list(length(text) || ':' || md5(length(role) || ':' || role || text) ORDER BY pos) AS turns FROM r GROUP BY conv_id
), l AS (SELECT c.conv_id, coalesce(x.turns, []) AS turns FROM c LEFT JOIN x ON x.conv_id = c.conv_id
), p AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM l
), n AS (
  SELECT d, array_to_string(turns[1:d], ',') AS node, any_value(array_to_string(turns[1:d - 1], ',')) AS parent, any_value(turns[1:d]) AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    any_value(CASE WHEN d > 0 THEN CAST(split_part(turns[d], ':', 1) AS BIGINT) ELSE 0 END) AS chars,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(turns) = d), '') AS ids
  FROM p GROUP BY 1, 2
), kids AS (SELECT d - 1 AS d, parent AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2
), m AS (SELECT n.*, coalesce(kids.n_children, 0) AS n_children FROM n LEFT JOIN kids ON kids.d = n.d AND kids.node = n.node
), up AS (SELECT unnest(range(0, d + 1)) AS k, path, n_children, (n_convs - 1) * chars AS saved FROM m
), s AS (SELECT k AS d, array_to_string(path[1:k], ',') AS node, CAST(count_if(n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM up GROUP BY 1, 2)
SELECT m.conv_id, m.d AS depth, above.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens, sha256(m.ids) AS ends_sha256
FROM m JOIN s ON s.d = m.d AND s.node = m.node LEFT JOIN m above ON above.d = m.d - 1 AND above.node = m.parent AND m.d > 0
"""
