"""Near-duplicate documents by min-max hashing.

Each permutation of a document's word n-grams gives two values, its minimum and its maximum: both agree between two sets
with a chance of their Jaccard similarity, so half the hash evaluations give a signature of the same length. Within one permutation the two
are negatively correlated (they are not the same element), so the share of values that agree is unbiased and varies less than with as many minima.
A band is ROWS minima, or ROWS maxima, of different permutations. With 84 permutations there are 28 bands
of 6 values: two sets of similarity 0.85 meet in one with a probability of 1 - 2e-6, and in two with 1 - 3e-5.

Sets that are equal are one class from the start. In each bucket (classes equal in a band) every class is compared with a leader, in TURNS turns; buckets whose
classes are then still in several components give all their pairs up to CROWDED classes. In larger ones signatures are compared by blocks, all with all,
and texts then only of classes with a likely partner in another component. Before texts are fetched, a pair's share of equal values must
come within DEVIATIONS standard deviations of the bound, which one linked pair in three million misses.
Every link is confirmed on the whole sets, never on signatures.

Defined results: a document without words, or with a null text, has an empty set, is linked with nothing and kept. A null
doc_id is a member of its class and component but never names one (unless all are null) and is kept only where it does. Repeated rows each get a
row, equal in all. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, durable, ship, stored
from .ngramjoin import Shingler, _by_blocks, _digest, _mixed, _row, _verified

#: Hash functions; values of a band.
PERMUTATIONS, ROWS = 84, 6
#: Leaders that each bucket gets, one after the other.
TURNS = 2
#: Classes of a bucket up to which all its pairs are taken; classes of a part, two of which make a block of signatures.
CROWDED, PART = 24, 1000
#: How far below the bound the share of equal values may lie.
DEVIATIONS = 5
#: N-grams hashed at once.
PIECE = 2048
#: Classes that a task remembers to have met.
MOST_SEEN = 200_000

_FACTOR = np.random.default_rng(1313).integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def extremes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The minima and the maxima of a set of 64-bit hashes under each permutation (products with odd numbers, modulo 2^64)."""
    low, high = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(h), PIECE):
        v = h[at : at + PIECE, None] * _FACTOR
        np.minimum(low, v.min(axis=0), out=low)
        np.maximum(high, v.max(axis=0), out=high)
    return low, high


def bands(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A key for each band: the bands of minima, then those of maxima."""
    values = np.concatenate([low, high]).reshape(-1, ROWS)
    key = np.arange(1, len(values) + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + values[:, j]
    return _mixed(key)


def signature(low: np.ndarray, high: np.ndarray) -> bytes:
    """A byte of each value."""
    return ((np.concatenate([low, high]) >> np.uint64(24)) & np.uint64(255)).astype(np.uint8).tobytes()


def least_equal(percent: int) -> int:
    """Equal values of a signature from which on a pair may be linked."""
    p, n = percent / 100, 2 * PERMUTATIONS
    return math.floor(n * p - DEVIATIONS * math.sqrt(n * p * (1 - p)))


def _bytes(signatures: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), np.uint8).reshape(len(signatures), 2 * PERMUTATIONS)


def _described(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, t (hash of the text), n_shingles, node (digest of the set, null if empty), keys (the bands) and sig of every row; of a class a task gives keys and sig once."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, seen = Shingler(n), set()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                sizes, nodes, keys, sigs = [], [], [], []
                for h in sets.each(part.column("text")):
                    node = _digest(h) if len(h) else None
                    new = node is not None and node not in seen
                    seen.add(node)
                    sizes.append(len(h))
                    nodes.append(node)
                    ends = extremes(h) if new else None
                    keys.append(bands(*ends).view(np.int64) if new else None)
                    sigs.append(signature(*ends) if new else None)
                if len(seen) > MOST_SEEN:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("t"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                    ["doc_id", "t", "n_shingles", "node", "keys", "sig"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.withColumn("t", F.xxhash64("text")).mapInArrow(describe, f"doc_id {kind}, t long, n_shingles long, node binary, keys array<bigint>, sig binary")


def _mixed_buckets(rows: DataFrame) -> DataFrame:
    """The rows (h, node, n, c) of buckets h whose rows have several c. Buckets are counted before they are joined: none has to fit a task."""
    several = rows.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("members")).where("lo != hi").select("h", "members")
    return rows.join(several, "h")


def _near(a: str, b: str, percent: int):
    """May sets of these sizes be linked?"""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _with_leaders(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of each class with its bucket's leader, where they are in different components and near in size.

    The first leader is the class in most buckets, which in a group of near copies is the least changed; later ones go by hash."""
    rank = F.struct(*([-F.col("k")] if not turn else []), F.xxhash64("node", F.lit(turn)).alias("by"), "node", "n", "c")
    lead = rows.groupBy("h").agg(F.min(rank).alias("lead")).select("h", F.col("lead.node").alias("a"), F.col("lead.n").alias("na"), F.col("lead.c").alias("ca"))
    return rows.join(lead, "h").where("ca != c").where(_near("na", "n", percent)).select("a", F.col("node").alias("b")).distinct()


def _all_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components within buckets of at most CROWDED classes."""
    x, y = (rows.select("h", *(F.col(k).alias(k + s) for k in ("node", "n", "c"))) for s in "xy")
    met = x.join(y, "h").where("nodex < nodey AND cx != cy").where(_near("nx", "ny", percent))
    return met.select(F.col("nodex").alias("a"), F.col("nodey").alias("b")).distinct()


def _likely(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures may be those of linked sets."""
    least = least_equal(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            equal = (_bytes(b.column("x")) == _bytes(b.column("y"))).sum(axis=1)
            yield b.select(["a", "b"]).filter(pa.array(equal >= least))

    a, b = (sigs.select(F.col("node").alias(k), F.col("sig").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(compare, "a binary, b binary")


def _promising(groups: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """The rows (lead, node) of groups (lead, node, n, c) that have a likely partner of another c in their group.

    A group is dealt to parts by hash, and every two parts meet in one task: signatures of both, 168 bytes a class."""
    least = least_equal(percent)
    parts = groups.groupBy("lead").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    placed = groups.join(parts, "lead").withColumn("p", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = placed.select("lead", "node", "n", "c", "p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("q")).select(
        "lead", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"), "node", "n", "c"
    )
    rows = dealt.join(sigs, "node").select("lead", "p", "q", "node", "n", "c", "sig")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(key: tuple, held: list[tuple]) -> pa.RecordBatch:
            held = list({h[0]: h for h in held}.values())
            own = np.frombuffer(b"".join(h[3] for h in held), np.uint8).reshape(len(held), -1).T.copy()
            n = np.array([h[1] for h in held], np.int64)
            c = np.unique(np.array([h[2].hex() for h in held]), return_inverse=True)[1]
            found = np.zeros(len(held), bool)
            for at in range(0, len(held), 256):
                i = slice(at, at + 256)
                equal = np.zeros((len(c[i]), len(held)), np.uint8)
                for column in own:
                    equal += column[i, None] == column[None, :]
                near = 100 * np.minimum(n[i, None], n) >= percent * np.maximum(n[i, None], n)
                found[i] |= ((equal >= least) & (c[i, None] != c) & near).any(axis=1)
            of = [h[0] for h, yes in zip(held, found.tolist(), strict=True) if yes]
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(of), pa.binary()), pa.array(of, pa.binary())], ["lead", "node"])

        key, held = None, []
        for b in batches:
            for lead, p, q, *own in zip(*(b.column(k).to_pylist() for k in ("lead", "p", "q", "node", "n", "c", "sig")), strict=True):
                if (lead, p, q) != key:
                    if held:
                        yield done(key, held)
                    key, held = (lead, p, q), []
                held.append(tuple(own))
        if held:
            yield done(key, held)

    together = rows.repartition("lead", "p", "q").sortWithinPartitions("lead", "p", "q")
    return together.mapInArrow(compare, "lead binary, node binary").distinct()


def near_duplicates(docs: DataFrame, n: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles long, component_id (the smallest doc_id reachable by links), kept boolean (it is its component's) for every row of docs.

    Links: Jaccard similarity of the sets of word n-grams of percent / 100 or more; the bands are made for 80 and above.
    """
    ship(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    base = stored(_described(docs, n))  # the only reading of all texts
    first = base.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(_row()).alias("f")).select("node", "f.doc_id", "f.t")
    sigs = stored(base.where(F.col("sig").isNotNull()).groupBy("node").agg(F.first("sig").alias("sig")))
    rows = base.select(F.explode("keys").alias("h"), "node", F.col("n_shingles").cast("int").alias("n")).distinct()
    shared = stored(_mixed_buckets(rows.withColumn("c", F.col("node"))).drop("c", "members"))
    left = shared.join(shared.groupBy("node").agg(F.count("*").alias("k")), "node").withColumn("c", F.col("node"))
    tried = links = None
    for turn in range(TURNS):
        pairs = _with_leaders(left, turn, percent)
        pairs = stored(_likely(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), sigs, percent))
        tried = pairs if tried is None else tried.unionByName(pairs)
        new = stored(_verified(docs, first, pairs, n, percent))
        links = new if links is None else links.unionByName(new)
        label = components(links)
        at = shared.join(label.withColumnRenamed("id", "node"), "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
        left = stored(_mixed_buckets(at))
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stored(_likely(_all_pairs(left.where(F.col("members") <= CROWDED), percent).join(known, ["a", "b"], "left_anti"), sigs, percent))
    links = links.unionByName(stored(_verified(docs, first, rest, n, percent)))
    # classes of a crowded bucket are in its leader's group, which may hold several buckets
    crowded = left.where(F.col("members") > CROWDED)
    lead = crowded.groupBy("h").agg(F.min(F.struct(F.xxhash64("node", F.lit(TURNS)).alias("by"), "node")).alias("lead")).select("h", F.col("lead.node").alias("lead"))
    groups = crowded.join(lead, "h").select("lead", "node", "n", "c").distinct()
    groups = stored(_promising(groups, sigs, percent))
    links = durable(links.unionByName(_by_blocks(docs, first, groups, n, percent)))
    label = components(links)
    classes = first.join(label.withColumnRenamed("id", "node"), "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("c"))
    of = classes.join(classes.groupBy("c").agg(F.min("doc_id").alias("low")), "c").select("node", "low", "c")
    component = F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("low"))
    return base.join(of, "node", "left").select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def op13_minmax_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), each AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM s
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM each a JOIN each b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2
), links AS (SELECT a, b FROM met WHERE 100 * c >= 85 * (na + nb - c)
), ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(id, mate) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM reached r JOIN ends e ON r.mate = e.a)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM s
JOIN (SELECT id, min(mate) AS component_id FROM reached GROUP BY 1) c ON c.id = s.doc_id
"""
