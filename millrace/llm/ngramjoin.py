"""Exact Jaccard self-join of documents by word n-grams, as a blocked sparse matrix product.

The document by n-gram incidence matrix is kept to each document's prefix: its first
n - ceil(t n) + LEAST n-grams in one global order, within which any two documents of Jaccard
similarity t share LEAST n-grams at least. The product of that matrix with its transpose is computed in
blocks of columns; overlap counts are summed by pair, and pairs below the bounds that their
sizes set are discarded before the exact check of the whole sets.

Only connectivity matters for component_id, so columns are multiplied in turns: first each member with a leader of its
column (linear in the rows), and then, only where members are still in different components, with each other. Documents with equal sets are one class from the start. The global order puts n-grams that many
documents share last, so that a passage in a third of all documents makes no columns; the order is found from a
sample, but any order gives the same result.

Defined results: a document without words, or with a null text, has an empty set and is linked with nothing;
its component is its own doc_id. A null doc_id is a member of its class and component but never names one
(unless all are null). Repeated rows each get a row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import components, durable, ship, sized, stored, unused

#: Common n-grams in the two prefixes that a linked pair has at least (fewer if the sets are tiny).
LEAST = 3
#: The order is found from one document in SAMPLE; n-grams that so many of those have are common; at most so many are told apart.
SAMPLE, COMMON, MOST_COMMON = 32, 4, 1_000_000
#: A list of documents to fetch is broadcast up to so many rows (about 100 bytes each), else joined by a shuffle.
MOST_SENT = 150_000
#: Leaders that each column gets, one after the other.
TURNS = 2
#: Members of a column from which on it is multiplied by blocks; members of a part, two of which make a block.
LARGE, PART = 40, 800
#: Members of a column up to which its pairs are added one by one in a block.
FEW = 12
#: Members compared with one document in one task.
MEMBERS = 2000
#: Classes that a task remembers to have met.
MOST_SEEN = 200_000


_RNG = np.random.default_rng(23)
#: A random value for each byte, 0 for those between words; A-Z are as a-z.
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[[32, 9, 10, 11, 12, 13]] = 0
_WORD = _BYTE > 0
#: Bytes whose word hashes are computed at once.
PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_POWER = np.full(PIECE, _BASE, np.uint64)
_POWER[0] = 1
_POWER = np.cumprod(_POWER, dtype=np.uint64)
_BACK = np.full(PIECE, pow(_BASE, -1, 1 << 64), np.uint64)
_BACK[0] = 1
_BACK = np.cumprod(_BACK, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def _hash_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of the words at starts: sums of their bytes' values times powers of an odd number, by pieces of the data."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, at + PIECE)))
        if j > i + 1 and starts[j - 1] + lengths[j - 1] > at + PIECE:
            j -= 1
        end = int(starts[j - 1] + lengths[j - 1])
        power, back = _POWER, _BACK
        if end - at > PIECE:  # one word longer than a piece
            power = np.cumprod(np.concatenate(([1], np.full(end - at - 1, _BASE, np.uint64))), dtype=np.uint64)
        first = starts[i:j] - at
        values = _BYTE[data[at:end]] * power[: end - at]
        out[i:j] = np.add.reduceat(values, first) * back[first]
        i = j
    return _mixed(out + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of every text, one after the other; number of words up to each text, from 0 on)."""
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    b = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    word = _WORD[b]
    edge = np.zeros(len(b) + 1, bool)  # a text begins here
    edge[offsets] = True
    before = np.concatenate(([False], word[:-1])) if len(b) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.concatenate((word[1:], [False])) if len(b) else word
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return _hash_words(b, starts, ends - starts), np.searchsorted(starts, offsets)


class Shingler:
    """Sets of 64-bit n-gram hashes of texts, each sorted and distinct; empty for a text without words.

    Of UTF-8 bytes, A-Z alone are lower-cased and words are cut at space and \\x09-\\x0D alone.
    """

    def __init__(self, n: int) -> None:
        self.n = n

    def _grams(self, w: np.ndarray, k: int) -> np.ndarray:
        h = np.full(max(len(w) - k + 1, 0), k, np.uint64)
        for j in range(k):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + w[j : j + len(h)]
        return _mixed(h)

    def each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The set of each text."""
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        for at in range(0, len(texts), 1000):
            w, cuts = word_hashes(texts.slice(at, 1000))
            h = self._grams(w, self.n)
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if j - i >= self.n:
                    yield np.unique(h[i : j - self.n + 1])
                else:
                    yield np.unique(self._grams(w[i:j], j - i)) if j > i else np.zeros(0, np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        return next(self.each(pa.array([text], pa.string())))


def least(n: int, percent: int) -> int:
    return min(LEAST, -(-percent * n // 100))


def prefix(h: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The first n - ceil(t n) + LEAST hashes, the common ones after all others."""
    n = len(h)
    size = n - -(-percent * n // 100) + least(n, percent)
    if len(common):
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        often = common[at] == h
        h = np.concatenate([h[~often], h[often]])
    return h[:size]


def _enough(overlap: Column, n: Column, percent: int) -> Column:
    """The bound on common n-grams of two prefixes, n being the smaller set's size."""
    return overlap >= F.least(F.lit(LEAST), F.ceil(n * percent / 100))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (small + large - both)


def _digest(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def _common(docs: DataFrame, n: int) -> np.ndarray:
    """Hashes of n-grams that many documents share, sorted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Shingler(n)
        for b in batches:
            got = list(sets.each(b.column("body")))
            h, c = np.unique(np.concatenate(got) if got else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c, pa.int64())], ["h", "c"])

    part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select(F.col("text").alias("body"))
    top = (
        part.mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
        .where(F.col("c") >= COMMON).orderBy(F.desc("c"), "h").limit(MOST_COMMON)
    )
    return np.sort(np.array([r["h"] for r in top.toLocalIterator()], np.int64).view(np.uint64))


def _same_row(doc: str, text: str) -> Column:
    """Is (doc, text) the row (doc_id, t)? Null ids are equal."""
    return F.col(doc).eqNullSafe(F.col("doc_id")) & (F.col(text) == F.col("t"))


def _row() -> Column:
    """A row's key, which orders rows; null ids come last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")


def _verified(docs: DataFrame, first: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The rows (a, b) of pairs whose whole sets are linked. first has node, doc_id and t (hash of the text), a row of each class.

    Rows are brought together by (a, part): a's text, then those of its members, which are streamed past
    it; a document with many members is sent to several parts.
    """
    sizes = pairs.groupBy("a").agg(F.count("*").alias("c")).withColumn("parts", F.ceil(F.col("c") / MEMBERS).cast("int"))
    member = pairs.join(sizes, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), F.col("b").alias("node")
    )
    leader = sizes.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("a").alias("node")
    )
    wanted = stored(member.unionByName(leader).join(first, "node").select("doc_id", "t", "a", "part", "role", "node"))
    texts = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("u"), F.col("text").alias("body"))
    rows = texts.join(sized(wanted, MOST_SENT), _same_row("d", "u")).select("a", "part", "role", "node", "body")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Shingler(n)
        key, lead, done = None, None, None
        for b in batches:
            out: list[tuple[bytes, bytes]] = []
            for a, part, role, node, own in zip(*(b.column(c) for c in ("a", "part", "role", "node")), sets.each(b.column("body")), strict=True):
                now = (a.as_py(), part.as_py())
                if _digest(own) != node.as_py():  # another text under the same doc_id
                    continue
                if now != key:
                    key, lead, done = now, None, None
                if role.as_py() == 0:
                    lead = own
                elif lead is not None and node.as_py() != done:
                    done = node.as_py()
                    if linked(lead, own, percent):
                        out.append((now[0], done))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary())], ["a", "b"]
            )

    together = rows.repartition("a", "part").sortWithinPartitions("a", "part", "role", "node")
    return together.mapInArrow(compare, "a binary, b binary")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The product of the sets' incidence matrix with its transpose: elements in common of each two sets.

    Columns with few members add their pairs one by one, the others are multiplied by blocks of columns.
    """
    m = len(sets)
    rows = np.repeat(np.arange(m), [len(x) for x in sets])
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    rows, df = rows[order], df[column[order]]  # the members of a column lie together
    both = np.zeros(m * m, np.float32)
    for k in range(2, FEW + 1):
        of = rows[df == k].reshape(-1, k)
        i, j = np.triu_indices(k, 1)
        pair = of[:, i].ravel() * m + of[:, j].ravel()
        if len(pair):
            at, n = np.unique(pair, return_counts=True)
            both[at] += n
    both = both.reshape(m, m)
    both += both.T
    dense = df > FEW
    rows, column = rows[dense], np.unique(column[order][dense], return_inverse=True)[1]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        lo, hi = np.searchsorted(column, [at, at + 2048])
        block = np.zeros((m, 2048), np.float32)
        block[rows[lo:hi], column[lo:hi] - at] = 1
        both += block @ block.T
    return both


def _forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links among sets, as many as connect all that are linked."""
    both = _overlaps(sets)
    size = np.array([len(x) for x in sets])
    union = size[:, None] + size[None, :] - both
    i, j = np.nonzero(np.triu(100 * both >= percent * union, 1))
    top = list(range(len(sets)))

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(x), find(y)
        if a != b:
            top[max(a, b)] = min(a, b)
            out.append((x, y))
    return out


def _by_blocks(docs: DataFrame, first: DataFrame, groups: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) among the members of each group; groups has lead and node, each pair once.

    A group's members are dealt to parts of about PART by hash; every two parts meet in one task, which holds the sets of both.
    Texts are sent and not sets: they are smaller by half once compressed.
    """
    parts = groups.groupBy("lead").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    placed = groups.join(parts, "lead").withColumn("p", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("q")
    dealt = placed.select("lead", "node", "p", other).select(
        "lead", "node", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")
    )
    wanted = stored(dealt.join(first, "node").select("doc_id", "t", "lead", "p", "q", "node"))
    texts = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("u"), F.col("text").alias("body"))
    rows = texts.join(sized(wanted, MOST_SENT), _same_row("d", "u")).select("lead", "p", "q", "node", "body")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)

        def done(held: dict[bytes, np.ndarray]) -> pa.RecordBatch:
            names = list(held)
            found = _forest(list(held.values()), percent) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i, _ in found], pa.binary()), pa.array([names[j] for _, j in found], pa.binary())], ["a", "b"]
            )

        key, held = None, {}
        for b in batches:
            for lead, p, q, node, own in zip(*(b.column(c) for c in ("lead", "p", "q", "node")), shingles.each(b.column("body")), strict=True):
                now = (lead.as_py(), p.as_py(), q.as_py())
                if now != key:
                    if held:
                        yield done(held)
                    key, held = now, {}
                if node.as_py() not in held and _digest(own) == node.as_py():
                    held[node.as_py()] = own
        if held:
            yield done(held)

    together = rows.repartition("lead", "p", "q").sortWithinPartitions("lead", "p", "q", "node")
    return together.mapInArrow(multiply, "a binary, b binary")


def similar(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles long, component_id (the smallest doc_id reachable by links) for every row of docs.

    Links: Jaccard similarity of the sets of word n-grams of percent / 100 or more.
    """
    return _labelled(docs, n, percent).select("doc_id", "n_shingles", "component_id")


def _labelled(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The rows of similar() with t, the hash of the row's text, and c, its component (null without words)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(docs.dtypes)["doc_id"]

    common = spark.sparkContext.broadcast(_common(docs, n))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, seen = Shingler(n), set()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                sizes, nodes, prefixes = [], [], []
                for h in sets.each(part.column("text")):
                    node = _digest(h) if len(h) else None
                    sizes.append(len(h))
                    nodes.append(node)
                    new = node is not None and node not in seen  # one row of a class will do
                    prefixes.append(prefix(h, common.value, percent).view(np.int64) if new else None)
                    seen.add(node)
                if len(seen) > MOST_SEEN:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("t"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                    ["doc_id", "t", "n_shingles", "node", "prefix"],
                )

    # the only reading of all texts
    base = stored(docs.withColumn("t", F.xxhash64("text")).mapInArrow(describe, f"doc_id {kind}, t long, n_shingles long, node binary, prefix array<bigint>"))
    rows = base.select(F.explode("prefix").alias("h"), "node", F.col("n_shingles").cast("int").alias("n"))
    column = Window.partitionBy("h")
    # only columns with two members or more make products
    shared = stored(
        rows.withColumn("lo", F.min("node").over(column)).withColumn("hi", F.max("node").over(column)).where("lo != hi")
        .drop("lo", "hi").dropDuplicates(["h", "node"])
    )
    first = base.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(_row()).alias("f")).select("node", "f.doc_id", "f.t")
    near = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    # Each member with its column's leader: first the one with the most shared columns, which in a group of copies is the
    # least changed, then others by hash, among columns whose members are still apart. This may miss links; what follows doesn't.
    tried = links = None
    left = shared.join(shared.groupBy("node").agg(F.count("*").alias("k")), "node").withColumn("c", F.col("node"))
    for turn in range(TURNS):
        rank = F.struct(*([-F.col("k")] if not turn else []), F.xxhash64("node", F.lit(turn)), "node", "n", "c")
        lead = F.min(rank).over(column)
        at = left.withColumn("lead", lead).select(
            F.col("lead.node").alias("a"), F.col("lead.n").alias("na"), F.col("lead.c").alias("ca"), F.col("node").alias("b"), F.col("n").alias("nb"), "c"
        )
        pairs = at.where("ca != c").where(near).groupBy("a", "b").agg(F.count("*").alias("o"), F.min(F.least("na", "nb")).alias("n"))
        pairs = pairs.where(_enough(F.col("o"), F.col("n"), percent)).select("a", "b")
        pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        tried = pairs if tried is None else tried.unionByName(pairs)
        new = stored(_verified(docs, first, pairs, n, percent))
        links = new if links is None else links.unionByName(new)
        label = components(links)
        # the other pairs of a column, where its members are in several components
        labelled = shared.join(label.withColumnRenamed("id", "node"), "node", "left").withColumn("c", F.coalesce("component", "node"))
        mixed = labelled.withColumn("lo", F.min("c").over(column)).withColumn("hi", F.max("c").over(column)).where("lo != hi")
        left = stored(mixed.select("h", "node", "n", "c"))
    # columns with many members left: all that share such a column share its leader, so the leader's group has every pair
    counted = left.join(left.groupBy("h").agg(F.count("*").alias("members")), "h")
    lead = F.min(F.struct(F.xxhash64("node", F.lit(TURNS)), "node")).over(column)
    groups = counted.where(F.col("members") > LARGE).select(lead["node"].alias("lead"), "node").distinct()
    links = links.unionByName(stored(_by_blocks(docs, first, stored(groups), n, percent)))
    few = counted.where(F.col("members") <= LARGE)
    x, y = (few.select("h", *(F.col(k).alias(k + s) for k in ("node", "n", "c"))) for s in "xy")
    overlap = (
        x.join(y, "h").where("nodex < nodey AND cx != cy")
        .where(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
        .groupBy("nodex", "nodey").agg(F.count("*").alias("overlap"), F.min(F.least("nx", "ny")).alias("n"))
        .where(_enough(F.col("overlap"), F.col("n"), percent))
        .select(F.col("nodex").alias("a"), F.col("nodey").alias("b"))
    )
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stored(overlap.join(known, ["a", "b"], "left_anti"))
    links = durable(links.unionByName(_verified(docs, first, rest, n, percent)))
    label = components(links)
    # components get their smallest id among classes, rows get it with their class
    classes = first.join(label.withColumnRenamed("id", "node"), "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("c"))
    least_id = classes.groupBy("c").agg(F.min("doc_id").alias("low"))
    of = base.join(classes.join(least_id, "c").select("node", "c", "low"), "node", "left")
    return of.select(
        "doc_id", "t", "c", "n_shingles", F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id")
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each component: that with the smallest doc_id, of repeated rows one. Documents
    without words stay. A null doc_id comes last; rows of one doc_id with different texts are told apart."""
    found = stored(_labelled(docs, n, percent))
    stays = found.where(F.col("c").isNotNull()).groupBy("c").agg(F.min(_row()).alias("s"))
    d, t = unused(docs, "doc"), unused(docs, "text")

    def among(rows: DataFrame, of: DataFrame, how: str) -> DataFrame:
        named = of.select(F.col("doc_id").alias(d), F.col("t").alias(t))
        same = rows["doc_id"].eqNullSafe(F.col(d)) & (F.xxhash64(rows["text"].cast("string")) == F.col(t))
        return rows.join(sized(named, MOST_SENT), same, how)

    drop = stored(found.join(stays, "c").where(~_same_row("s.doc_id", "s.t")).select("doc_id", "t").distinct())
    left = among(docs, drop, "left_anti")
    # repeated rows of a document that stays: one of them
    again = stored(found.where(F.col("c").isNotNull()).groupBy("doc_id", "t").count().where("count > 1").select("doc_id", "t"))
    if again.isEmpty():
        return left
    return among(left, again, "left_anti").unionByName(among(left, again, "left_semi").dropDuplicates(["doc_id", "text"]))


def op9_ngram_join(spark, sf_dir: str) -> DataFrame:
    return similar(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), each AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM s
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM each a JOIN each b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2
), links AS (SELECT a, b FROM met WHERE 100 * c >= 85 * (na + nb - c)
), ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(id, mate) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM reached r JOIN ends e ON r.mate = e.a)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id FROM s JOIN (SELECT id, min(mate) AS component_id FROM reached GROUP BY 1) c ON c.id = s.doc_id
"""
