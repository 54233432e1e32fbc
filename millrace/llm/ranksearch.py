"""Ranked lexical search over a two-level quantised index.

A posting's impact is its term's weight times a part that depends on the document alone, at most MILLION. The index holds that part
twice: rounded up to a byte (level one), and as the integers it comes from (level two: occurrences, and words of the document). A search reads level
one only: the bytes' sum by weight is an upper bound of a document's score, and less than a byte's step for each term below it is a lower bound. Every document whose
upper bound reaches an item's k-th largest lower bound is then scored from level two, in whole numbers; there is no
limit on how many do.

Postings lie with their document, so neither building nor searching shuffles them. Items are searched in blocks, each a pass over
level one, of about BLOCK_TERMS terms and BLOCK_ITEMS items at most: what is sent to the tasks is one block, whatever the number of items.
Where the items are known when an index is built, and have at most MOST_TERMS terms, it holds their terms only.

Defined results: a null or empty text has no term and is in no ranking; an item without terms ranks nothing. Repeated rows of documents are
documents of their own, repeated items rank each on its own; equal scores go by ascending doc_id, null last. Fewer rows where fewer documents
score above 0; an empty table gives none. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import free, sent, ship, stored

#: Bound of a posting's document part, and the step of its byte.
MILLION, STEP = 1_000_000, 3922
#: Terms and items of a block; terms of items up to which an index is built for these alone.
BLOCK_TERMS, BLOCK_ITEMS, MOST_TERMS = 50_000, 1_000, 200_000
#: Bytes of a text whose terms are found at once; postings times items added at once.
PIECE, ADDED = 1 << 20, 1 << 21

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def counts(text: bytes | None) -> Counter[bytes]:
    """Occurrences of each term of a text, A-Z lower-cased. A long text is cut behind a term."""
    found: Counter[bytes] = Counter()
    text = (text or b"").lower()
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            m = _TERM.match(text, end)
            end = m.end() if m else end
        found.update(_TERM.findall(text, at, end))
        at = end
    return found


def term_id(term: bytes) -> int:
    """A term's name in the index: a 64-bit hash, as a signed number."""
    h = xxhash.xxh64_intdigest(term)
    return h - (1 << 64) if h >> 63 else h


class Index(NamedTuple):
    #: row (its place), doc_id, n (words), terms (ids, ascending), bytes (level one), tf (level two).
    postings: DataFrame
    #: Documents with a term, and all their words.
    n_docs: int
    n_words: int


def _words_of(items: DataFrame) -> DataFrame:
    """row, item_id, terms (ids, ascending) and tf of each item."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms, tf = [], []
            for text in b.column("text").cast(pa.large_binary()).to_pylist():
                found = sorted((term_id(t), c) for t, c in counts(text).items())
                terms.append([t for t, _ in found])
                tf.append([c for _, c in found])
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("item_id"), pa.array(terms, pa.list_(pa.int64())), pa.array(tf, pa.list_(pa.int32()))], ["row", "item_id", "terms", "tf"])

    kind = dict(items.dtypes)["item_id"]
    rows = items.select(F.monotonically_increasing_id().alias("row"), "item_id", F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(describe, f"row long, item_id {kind}, terms array<bigint>, tf array<int>"))


def _level_two(docs: DataFrame, only: set[int] | None) -> DataFrame:
    """row, doc_id, n, terms and tf of each document, of the terms in only if that is given. The only reading of all texts."""
    wanted = docs.sparkSession.sparkContext.broadcast(only)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, names = wanted.value, {}
        for b in batches:
            sizes, terms, tf = [], [], []
            for text in b.column("text").cast(pa.large_binary()).to_pylist():
                found, own = counts(text), []
                for t, c in found.items():
                    k = names.get(t)
                    if k is None:
                        if len(names) > 1_000_000:
                            names.clear()
                        k = term_id(t)
                        names[t] = k = k if keep is None or k in keep else 0
                    if k:
                        own.append((k, c))
                own.sort()
                sizes.append(found.total())
                terms.append([t for t, _ in own])
                tf.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int64())), pa.array(tf, pa.list_(pa.int32()))],
                ["row", "doc_id", "n", "terms", "tf"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(describe, f"row long, doc_id {kind}, n long, terms array<bigint>, tf array<int>"))


def _length_part(n, n_docs: int, n_words: int):
    """m of a document of n words; n a number, an array or a column's SQL name."""
    return 100 - 25 + (25 * n * n_docs) // max(n_words, 1)


def build(docs: DataFrame, items: DataFrame | None = None) -> Index:
    """The index of docs (doc_id, text), of all terms, or of those of items (as _words_of gives them) if these are not too many."""
    ship(docs.sparkSession)
    only = None
    if items is not None:
        ids = stored(items.select(F.explode("terms").alias("t")).distinct())
        only = {r["t"] for r in ids.toLocalIterator()} if ids.count() <= MOST_TERMS else None
    plain = _level_two(docs, only)
    total = plain.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    n_docs, n_words = total["docs"], total["words"]

    def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("tf")
            lengths = np.diff(lists.offsets.to_numpy())
            tf = lists.flatten().to_numpy().astype(np.int64)
            m = np.repeat(_length_part(b.column("n").to_numpy(), n_docs, n_words), lengths)
            part = (1_000_000_000 * tf) // (1000 * tf + 12 * m)
            up = (-(-part // STEP)).astype(np.uint8)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            of = [up[i:j].tobytes() for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("row", "doc_id", "n", "terms", "tf")), pa.array(of, pa.binary())], ["row", "doc_id", "n", "terms", "tf", "bytes"])

    kind = dict(plain.dtypes)["doc_id"]
    has = plain.where(F.size("terms") > 0)
    return Index(stored(has.mapInArrow(quantised, f"row long, doc_id {kind}, n long, terms array<bigint>, tf array<int>, bytes binary")), n_docs, n_words)


class _Block(NamedTuple):
    """A block of items in the form that tasks use: its terms (ids, ascending), and for the i-th term the items' numbers and factors (weight by repeats) from start[i] to start[i + 1]."""

    terms: np.ndarray
    start: np.ndarray
    item: np.ndarray
    factor: np.ndarray
    n_items: int


def _block(index: Index, items: DataFrame) -> tuple[_Block, DataFrame]:
    """The block of these items, and the items as rows (number, row, item_id, terms, factors)."""
    rows = sorted(items.collect(), key=lambda r: r["row"])
    terms = np.unique(np.array([t for r in rows for t in r["terms"]], np.int64))
    names = items.sparkSession.createDataFrame([(int(t),) for t in terms], "t long") if len(terms) else None
    df = {}
    if names is not None:  # at most BLOCK_TERMS or one item's
        held = index.postings.select(F.explode("terms").alias("t")).join(sent(names), "t", "left_semi").groupBy("t").agg(F.count("*").alias("df"))
        df = {r["t"]: r["df"] for r in held.collect()}
    weight = {t: math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in terms.tolist()}
    found = sorted((t, k, c * weight[t]) for k, r in enumerate(rows) for t, c in zip(r["terms"], r["tf"], strict=True))
    start = np.searchsorted(np.array([t for t, _, _ in found], np.int64), np.append(terms, np.iinfo(np.int64).max))
    block = _Block(terms, start, np.array([k for _, k, _ in found], np.int64), np.array([f for _, _, f in found], np.int64), len(rows))
    kind = dict(items.dtypes)["item_id"]
    named = [(k, r["row"], r["item_id"], r["terms"], [c * weight[t] for t, c in zip(r["terms"], r["tf"], strict=True)]) for k, r in enumerate(rows)]
    return block, items.sparkSession.createDataFrame(named, f"item long, item_row long, item_id {kind}, item_terms array<bigint>, factors array<bigint>")


def bounds(block: _Block, doc: np.ndarray, term: np.ndarray, byte: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds (documents by items) of n documents' scores; posting i is of document doc[i]. Whole numbers below 2^53, held as doubles."""
    up, terms = np.zeros(n * block.n_items), np.zeros(n * block.n_items)
    at = np.minimum(np.searchsorted(block.terms, term), max(len(block.terms) - 1, 0))
    known = block.terms[at] == term if len(block.terms) else np.zeros(len(term), bool)
    doc, at, byte = doc[known], at[known], byte[known].astype(np.int64)
    many = block.start[at + 1] - block.start[at]
    cuts = np.searchsorted(np.cumsum(many), np.arange(0, int(many.sum()) + ADDED, ADDED))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        k = many[i:j]
        place = np.repeat(block.start[at[i:j]] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
        cell = np.repeat(doc[i:j], k) * block.n_items + block.item[place]
        factor = block.factor[place]
        up += np.bincount(cell, factor * np.repeat(byte[i:j], k), n * block.n_items)
        terms += np.bincount(cell, factor, n * block.n_items)
    shape = (n, block.n_items)
    return (up * STEP).reshape(shape), ((up - terms) * STEP).reshape(shape)


def _reached(postings: DataFrame, block: _Block, k: int) -> DataFrame:
    """row, item, up, low of the documents whose upper bound reaches the k-th lower bound of what their task has read so far: all that reach that of all rows, and others."""
    spark = postings.sparkSession
    shared = spark.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best = np.zeros((k, own.n_items))  # the largest lower bounds so far, the k-th first
        for b in batches:
            rows, lists, level = b.column("row").to_numpy(), b.column("terms"), b.column("bytes")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            terms = lists.flatten().to_numpy()
            bytes_ = np.frombuffer(b"".join(level.to_pylist()), np.uint8)
            offsets = offsets - offsets[0]
            step = max(1, (1 << 20) // max(own.n_items, 1))
            for i in range(0, len(rows), step):
                j = min(i + step, len(rows))
                lo, hi = offsets[i], offsets[j]
                doc = np.repeat(np.arange(j - i), np.diff(offsets[i : j + 1]))
                up, low = bounds(own, doc, terms[lo:hi], bytes_[lo:hi], j - i)
                best = np.partition(np.concatenate([best, low]), -k, axis=0)[-k:]
                d, item = np.nonzero((up >= best[0]) & (up > 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[i + d]), pa.array(item), pa.array(up[d, item].astype(np.int64)), pa.array(low[d, item].astype(np.int64))], ["row", "item", "up", "low"]
                )

    return postings.select("row", "terms", "bytes").mapInArrow(scan, "row long, item long, up long, low long")


def _first(of: DataFrame, k: int, by: str, *order: Column) -> DataFrame:
    return of.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank int, doc_id, score long: for each item (as _words_of gives them) the k documents of highest score."""
    spark = items.sparkSession
    ship(spark)
    size = items.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms"), F.count("*").alias("items")).first()
    n_blocks = max(1, -(-size["terms"] // BLOCK_TERMS), -(-size["items"] // BLOCK_ITEMS))
    out = None
    for number in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == number)
        block, rows = _block(index, part)
        met = stored(_reached(index.postings, block, k))
        # the k-th lower bound of all rows; 0 where fewer than k documents have a term
        least = _first(met, k, "item", F.desc("low")).groupBy("item").agg(F.when(F.count("*") == k, F.min("low")).otherwise(0).alias("least"))
        left = stored(met.join(sent(stored(least)), "item").where("up >= least").select("row", "item"))
        m = F.expr(f"{100 - 25} + (25 * n * {index.n_docs}L) div {max(index.n_words, 1)}L").alias("m")
        docs = index.postings.select("row", "doc_id", m, "terms", "tf").join(sent(left), "row")
        at = "int(array_position(terms, element_at(item_terms, i)))"
        part_of = f"CASE WHEN {at} > 0 THEN element_at(factors, i) * ((1000000000L * element_at(tf, {at})) div (1000L * element_at(tf, {at}) + 12L * m)) ELSE 0L END"
        score = F.expr(f"aggregate(sequence(1, size(item_terms)), 0L, (s, i) -> s + {part_of})")
        scored = docs.join(F.broadcast(rows), "item").select("item", "item_row", "item_id", "doc_id", score.alias("score")).where("score > 0")
        best = _first(scored, k, "item", F.desc("score"), F.asc_nulls_last("doc_id")).select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
        free(spark)
    return out


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    ship(spark)
    items = _words_of(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return search(build(spark.read.parquet(f"{sf_dir}/documents.parquet"), items), items)


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
), c AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0
), each AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS t FROM d
), p AS (SELECT doc_id, n, t, count(*) AS tf FROM each WHERE t IN (SELECT t FROM b) GROUP BY 1, 2, 3
), df AS (SELECT t, count(*) AS df FROM p GROUP BY 1
), q AS (SELECT item_id, b.t, count(*) AS r, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * any_value(df) + 1))) AS BIGINT) AS w FROM b JOIN df ON df.t = b.t CROSS JOIN c GROUP BY 1, 2
), s AS (
  SELECT q.item_id, p.doc_id, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * nn) // l))))) AS BIGINT) AS score
  FROM q JOIN p ON p.t = q.t CROSS JOIN c GROUP BY 1, 2
), k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20
"""
