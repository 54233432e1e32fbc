"""Benchmark decontamination by templates.

Texts become canonical words: numbers, names (a capital, then small letters) and units turn into typed placeholders, everything else is
lower-cased. Windows of WINDOW canonical words of the documents are joined by hash with those of the benchmark;
from each joined window on the words of item and document are aligned in order, over gaps of a few changed, inserted or
deleted words, and the words that agree are added up. Slots count where they are consistent: each value of the item goes to one
value of the document. Windows with few literal words are joined on the words as they stand. So a copied question is found, and one with other numbers and names as well.

Defined results: null or empty texts and items match nothing; an item shorter than WHOLE words is one window
of its own length (below SHORTEST it is no evidence and matches nothing), one of less than three windows has windows of a third
of its length, LEAST words at least, so that two changed words leave one of them whole from 14 words on, one from 8; items of equal text are matched once and each gives its own
result, as repeated rows do; of equally long matches the first in the document counts; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sent, ship, stored, unused

#: Words of a window, and of the shortest window of a short item; words of the shortest item that is matched; words below which an item is one
#: window; literal words from which on a window is joined with its slots open.
WINDOW, LEAST, SHORTEST, WHOLE, LITERAL = 6, 4, 6, 8, 4
#: A document is contaminated by an item if one match covers this share of the item's words, or so many words.
COVER, LONG = 0.7, 25
#: Words left out on each side between two stretches of a match, at most; words that agree after such a gap, at least; words up to which the
#: stretches behind several gaps are compared: the longest is taken, of equal ones that behind the smallest gap.
GAP, AGAIN, FAR = 4, 2, 8
#: Benchmark windows are broadcast to the scan as a filter up to this many; beyond that all windows go to the join.
MOST_SENT = 4_000_000
#: Rows of one key that a task joins at least before the key is dealt to several.
EVEN = 20_000

# Units that a number may have.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months "
    "year years percent dollar dollars cent cents euro euros degree degrees watt watts volt volts joule joules newton newtons "
    "mph kmh meter meters metre metres centimeter centimeters kilometer kilometers".split()
)
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:'[^\W\d_]+)*")
#: Code points that are classified and lower-cased one by one; those beyond count as letters without case.
_CODES = 0x20000
_CHARS = [chr(c) for c in range(_CODES)]
_CLASS = np.array([2 if c.isdecimal() else 1 if c.isalnum() else 0 for c in _CHARS], np.uint8)
_UPPER = np.array([c.isupper() for c in _CHARS])
_SMALL = np.array([c.islower() for c in _CHARS])
_LOWER = np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in _CHARS], np.uint32)
del _CHARS
_TO_LOWER = {int(c): int(_LOWER[c]) for c in np.flatnonzero(_LOWER != np.arange(_CODES))}


def _is_name(w: str) -> bool:
    """A capital first, and after it small letters and no capital."""
    return w[0].isupper() and sum(map(str.isupper, w)) == 1 and any(map(str.islower, w))


def canonical(text: str) -> tuple[list[str], list[str], list[bool]]:
    """(words as they stand lower-cased, the same with slots as placeholders, whether each has a capital and small letters)."""
    capital: list[bool] = []
    plain: list[str] = []
    typed: list[str] = []
    for w in _TOKEN.findall(text):
        low = w.translate(_TO_LOWER)
        plain.append(low)
        capital.append(_is_name(w))
        if w[0].isdecimal():
            typed.append(NUM)
        elif low in UNITS and typed and typed[-1] == NUM:
            typed.append(UNIT)
        elif capital[-1]:
            typed.append(NAME)
        else:
            typed.append(low)
    return plain, typed, capital


_SPACE = re.compile(r"\s")
_M = np.uint64(0x9E3779B97F4A7C15)
#: Characters whose words are hashed at once.
PIECE = 1 << 19


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER, _BACK = _powers(int(_M), PIECE + 1), _powers(pow(int(_M), -1, 1 << 64), PIECE + 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of about PIECE characters, cut at white space only."""
    at = 0
    while len(text) - at > PIECE:
        space = _SPACE.search(text, at + PIECE - 1)
        end = space.end() if space else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _scan(text: str) -> tuple[np.ndarray, ...]:
    """Of each word of a piece: its place, the hash of its lower-cased form, whether it is a number, whether a name."""
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    known = np.minimum(c, _CODES - 1) if len(c) and c.max() >= _CODES else c
    kind = _CLASS[known]
    if known is not c:
        kind[c >= _CODES] = 1
    if len(c) > 2:
        for marks, side in (((46, 44), 2), ((39,), 1)):  # marks inside numbers, marks inside words
            at = np.flatnonzero(np.isin(c[1:-1], marks)) + 1
            kind[at[(kind[at - 1] == side) & (kind[at + 1] == side)]] = side
    edge = np.flatnonzero(np.diff(kind, prepend=0))
    starts = edge[kind[edge] > 0]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none.astype(bool), none.astype(bool)
    inside = kind > 0
    low = np.where(c < _CODES, _LOWER[known], c).astype(np.uint64) + np.uint64(1)
    low = (low ^ (low << np.uint64(17))) * np.uint64(0xD1B54A32D192ED03)
    power, back = (_POWER, _BACK) if len(c) <= len(_POWER) else (_powers(int(x), len(c)) for x in (_POWER[1], _BACK[1]))
    values = np.where(inside, _mixed(low), np.uint64(0)) * power[: len(c)]
    length = np.add.reduceat(inside, starts, dtype=np.int64)
    h = _mixed(np.add.reduceat(values, starts) * back[starts] + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    upper = _UPPER[known] & inside
    name = upper[starts] & (np.add.reduceat(upper, starts, dtype=np.int64) == 1) & (np.add.reduceat(_SMALL[known] & inside, starts, dtype=np.int64) > 0)
    return starts, h, kind[starts] == 2, name


def _hash(w: str) -> np.uint64:
    return _scan(w)[1][0]


_NUM, _NAME, _UNIT, _PLAIN = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_UNITS = np.sort(np.array([_hash(u) for u in UNITS], np.uint64))


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the plain words of all texts, one after the other; the same with slots as placeholders; words up to each text, from 0 on)."""
    held: list[tuple[np.ndarray, ...]] = []
    cuts = [0]
    pile: list[str] = []

    def flush() -> None:
        if pile:
            found = _scan("\n".join(pile))
            held.append(found[1:])
            ends = np.cumsum([len(t) + 1 for t in pile])
            cuts.extend((cuts[-1] + np.searchsorted(found[0], ends)).tolist())
            pile.clear()

    size = 0
    for t in texts:
        if len(t) > PIECE // 2:
            flush()
            size, n = 0, 0
            for piece in _pieces(t):
                held.append(_scan(piece)[1:])
                n += len(held[-1][0])
            cuts.append(cuts[-1] + n)
            continue
        if size + len(t) + 1 > PIECE:
            flush()
            size = 0
        pile.append(t)
        size += len(t) + 1
    flush()
    plain, number, name = (np.concatenate([x[k] for x in held]) if held else np.zeros(0, d) for k, d in enumerate((np.uint64, bool, bool)))
    typed = plain.copy()
    typed[name] = _NAME
    typed[number] = _NUM
    after = np.concatenate(([False], number[:-1])) if len(number) else number
    cut = np.array(cuts, np.int64)
    after[cut[:-1][cut[:-1] < len(after)]] = False
    unit = np.flatnonzero(after & ~number)
    at = np.minimum(np.searchsorted(_UNITS, plain[unit]), len(_UNITS) - 1)
    typed[unit[_UNITS[at] == plain[unit]]] = _UNIT
    return plain, typed, cut


def _rolled(w: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, hashes of the windows of so many words) for each of the ascending lengths."""
    h = np.zeros(len(w), np.uint64)
    for k in range(max(lengths, default=0)):
        if k >= len(w):
            return
        h = h[: len(w) - k]
        h = (h ^ (h >> np.uint64(31))) * _M + w[k:]
        if k + 1 in lengths:
            yield k + 1, h ^ (h >> np.uint64(32))


def exact(plain: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the windows of size words as they stand."""
    return next((h for _, h in _rolled(plain, [size])), plain[:0]) ^ _PLAIN


def windows(plain: np.ndarray, typed: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, 64-bit hashes of the windows of size typed words); windows with too few literal words have that of their plain words."""
    slot = (typed == _NUM) | (typed == _NAME) | (typed == _UNIT)
    literal = np.concatenate(([0], np.cumsum(~slot)))
    for size, h in _rolled(typed, lengths):
        few = np.flatnonzero(literal[size:] - literal[:-size] < min(LITERAL, size))
        if len(few):
            g = np.zeros(len(few), np.uint64)
            for k in range(size):
                g = (g ^ (g >> np.uint64(31))) * _M + plain[few + k]
            h = h.copy()
            h[few] = g ^ (g >> np.uint64(32)) ^ _PLAIN
        yield size, h


class Known:
    """A set of 64-bit hashes to look many up in: a table of bits first, then a binary search."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes)
        self.shift = np.uint64(64 - max(20, min(28, int(len(hashes) * 16).bit_length())))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[self.hashes >> self.shift] = True

    def places(self, h: np.ndarray) -> np.ndarray:
        """Where h holds one of the hashes."""
        at = np.flatnonzero(self.bits[h >> self.shift])
        i = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        return at[self.hashes[i] == h[at]]


def sizes(n_words: int) -> int:
    """Window size of an item: 0 if it is too short to be evidence."""
    return max(LEAST, min(WINDOW, n_words // 3)) if n_words >= WHOLE else n_words if n_words >= SHORTEST else 0


def consistent(item: list[str], item_typed: list[str], doc: list[str]) -> bool:
    """Does each slot value of the item go to one value of doc (words of equal number)?"""
    to: dict[str, str] = {}
    return all(to.setdefault(a, b) == b for a, t, b in zip(item, item_typed, doc, strict=True) if t[0] == "<")


#: (words of the item, words of the document) that a gap may have, the smallest first, changed words before others.
GAPS = sorted(((x, y) for x in range(GAP + 1) for y in range(GAP + 1) if x or y), key=lambda g: (max(g), g[0] != g[1], g))
Words = tuple[list[str], list[str], list[bool]]


def chain(item: Words, doc: Words, i: int, d: int, step: int) -> list[tuple[int, int]]:
    """Places (item, doc) of words that agree, from (i, d) on to the right or left, over gaps. In a gap of equal sides two
    words with a capital are a name that has changed."""
    (ip, it, ic), (dp, dt, dc) = item, doc

    def agree(a: int, b: int) -> bool:
        return 0 <= a < len(it) and 0 <= b < len(dt) and (it[a] == dt[b] or ip[a] == dp[b])

    out: list[tuple[int, int]] = []
    while True:
        while agree(i, d):
            out.append((i, d))
            i, d = i + step, d + step
        again, x, y = 0, 0, 0
        for u, v in GAPS:
            n = 0
            while n < FAR and agree(i + step * (u + n), d + step * (v + n)):
                n += 1
            if n > again:
                again, x, y = n, u, v
        if again < AGAIN:
            return out
        if x == y:
            gap = ((i + step * k, d + step * k) for k in range(x))
            out += [(a, b) for a, b in gap if ic[a] and dc[b]]
        i, d = i + step * x, d + step * y


def counted(item: Words, doc: Words, pairs: list[tuple[int, int]]) -> tuple[int, int, int, bool]:
    """(words, item start, doc start, literal copy) of aligned places. A slot counts where its value goes to the value of doc
    that it goes to most often; slots that differ count as many as there are literal words at most."""
    (ip, it, _), (dp, _, _) = item, doc
    to: dict[str, Counter] = {}
    for a, b in pairs:
        if it[a][0] == "<" or ip[a] != dp[b]:
            to.setdefault(ip[a], Counter())[dp[b]] += 1
    most = {v: c.most_common(1)[0][0] for v, c in to.items()}
    kept = [(a, b) for a, b in pairs if (it[a][0] != "<" and ip[a] == dp[b]) or most[ip[a]] == dp[b]]
    same = sum(ip[a] == dp[b] for a, b in kept)
    (x, y), (u, v) = kept[0], kept[-1]
    whole = len(kept) == same == u - x + 1 == v - y + 1
    literal = sum(it[a][0] != "<" and ip[a] == dp[b] for a, b in kept)
    return same + min(len(kept) - same, literal), x, y, whole


def matches(item: Words, doc: Words, starts: list[int], size: int) -> tuple[int, int, int, bool]:
    """The longest match of the item in doc through windows that start at starts: (words, item start, doc start, literal copy)."""
    ip, it, _ = item
    dp, dt, _ = doc
    places: dict[tuple[str, ...], set[int]] = {}
    for i in range(len(it) - size + 1):
        for words in (it, ip):
            places.setdefault(tuple(words[i : i + size]), set()).add(i)
    best = (0, 0, 0, False)
    done: set[tuple[int, int]] = set()
    for d in sorted(set(starts)):
        none: set[int] = set()
        for i in sorted(places.get(tuple(dt[d : d + size]), none) | places.get(tuple(dp[d : d + size]), none)):
            if (i, d) not in done:
                pairs = chain(item, doc, i - 1, d - 1, -1)[::-1] + chain(item, doc, i, d, 1)
                done.update(pairs)
                best = max(best, counted(item, doc, pairs), key=lambda m: m[0])
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document row and item that contaminates it.

    doc_id, item_id, n_windows long (joined windows), covered long (words of the longest match that agree),
    item_words long, item_start, doc_start long (words), literal boolean. benchmark has item_id and text.
    """
    return _found(docs, benchmark).drop("row_id")


def _dealt(hits: DataFrame, bench: DataFrame) -> DataFrame:
    """hits joined with bench on (h, size). A key with more hits than an even share of them is dealt to several tasks by row;
    such keys are no more than there are shuffle partitions. A broadcast of bench needs no dealing, but has it all the same."""
    counts = stored(hits.groupBy("h", "size").agg(F.count("*").alias("n")).join(bench.select("h", "size").distinct(), ["h", "size"], "left_semi"))
    parts = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    even = max(EVEN, (counts.agg(F.sum("n")).first()[0] or 0) // parts)
    hot = F.broadcast(counts.where(F.col("n") > even).select("h", "size", F.ceil(F.col("n") / even).cast("int").alias("ways")))

    def with_ways(df: DataFrame) -> DataFrame:
        return df.join(hot, ["h", "size"], "left").withColumn("ways", F.coalesce("ways", F.lit(1)))

    left = with_ways(hits).withColumn("way", F.pmod(F.xxhash64("doc_id", "row_id"), "ways").cast("int")).drop("ways")
    right = with_ways(bench).withColumn("way", F.explode(F.sequence(F.lit(0), F.col("ways") - 1))).drop("ways")
    return left.join(sent(right), ["h", "size", "way"]).drop("way")


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of contaminated() with row_id, the hash of the row's text."""
    spark = docs.sparkSession
    ship(spark)
    doc_kind = dict(docs.dtypes)["doc_id"]
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    items = items.withColumn("cls", F.xxhash64("text"))
    classes = stored(items.select("cls", "text").dropDuplicates(["cls"]))

    def bench_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            plain, typed, cuts = coded(b.column("text").to_pylist())
            for c, i, j in zip(b.column("cls").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                size = sizes(j - i)
                if size:
                    # a document's window may have other slots (words with a capital), so each has both hashes
                    both = [h for _, h in windows(plain[i:j], typed[i:j], [size])] + [exact(plain[i:j], size)]
                    out += [(h, size, c) for h in np.unique(np.concatenate(both)).view(np.int64).tolist()]
            kinds = {"h": pa.int64(), "size": pa.int32(), "cls": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds.values())], list(kinds))

    bench = stored(classes.mapInArrow(bench_rows, "h long, size int, cls long"))
    keys = bench.select("h", "size").distinct()
    small = keys.count() <= MOST_SENT
    lengths = sorted(r["size"] for r in keys.select("size").distinct().collect())
    found: dict[int, np.ndarray] = {}
    if small:
        table = keys.toArrow()
        found = {k: table.filter(pc.equal(table["size"], k))["h"].to_numpy().view(np.uint64) for k in lengths}
    shared = spark.sparkContext.broadcast(found)

    def doc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: Known(v) for k, v in shared.value.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                b = batch.slice(start, 500)
                plain, typed, cuts = coded([t.as_py() or "" for t in b.column("body")])
                parts: list[tuple[np.ndarray, ...]] = []
                for size, h in windows(plain, typed, lengths):
                    at = known[size].places(h) if small else np.arange(len(h))
                    row = np.searchsorted(cuts, at, "right") - 1
                    whole = at + size <= cuts[row + 1]  # not over the end of a text
                    at, row = at[whole], row[whole]
                    parts.append((row, h[at].view(np.int64), np.full(len(at), size, np.int32), (at - cuts[row]).astype(np.int32)))
                if not parts:
                    continue
                row, h, size, at = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.lexsort((at, h, size, row))
                row, h, size, at = row[order], h[order], size[order], at[order]
                new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(h, prepend=0) != 0) | (np.diff(size, prepend=0) != 0))
                take = pa.array(row[new].astype(np.int32))
                starts = pa.ListArray.from_arrays(pa.array(np.append(new, len(at)).astype(np.int32)), pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(take), b.column("row_id").take(take), pa.array(h[new]), pa.array(size[new]), starts],
                    ["doc_id", "row_id", "h", "size", "starts"],
                )

    # rows are told apart by their text, so that repeated doc_ids don't mix
    source = docs.select("doc_id", F.col("text").cast("string").alias("body")).withColumn("row_id", F.xxhash64("body"))
    hits = source.mapInArrow(doc_rows, f"doc_id {doc_kind}, row_id long, h long, size int, starts array<int>")
    joined = _dealt(stored(hits) if small else hits, bench)
    # a window of an item is in a document or not: at most as many rows meet as the item has windows
    pairs = joined.groupBy("doc_id", "row_id", "cls", "size").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("starts"))
    pairs = stored(pairs)
    # as a rule few documents meet any item; their places are sent to the texts if they are small, else both are shuffled
    held = source.select(F.col("doc_id").alias("d2"), F.col("row_id").alias("r2"), "body").join(
        sent(pairs), (F.col("row_id") == F.col("r2")) & F.col("doc_id").eqNullSafe(F.col("d2"))
    ).drop("d2", "r2")
    both = held.join(sent(classes.withColumnRenamed("text", "item")), "cls")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, out = [], []
            for r in range(b.num_rows):
                item, doc = canonical(b.column("item")[r].as_py() or ""), canonical(b.column("body")[r].as_py())
                size = b.column("size")[r].as_py()
                if sizes(len(item[0])) != size:
                    continue
                starts = b.column("starts")[r].as_py()
                n, i, d, copied = matches(item, doc, starts, size)
                if n >= min(LONG, max(COVER * len(item[0]), min(size, len(item[0])))):
                    kept.append(r)
                    out.append((len(starts), n, len(item[0]), i, d, copied))
            take = pa.array(kept, pa.int32())
            cols = [b.column("doc_id").take(take), b.column("row_id").take(take), b.column("cls").take(take)]
            cols += [pa.array([o[k] for o in out], pa.int64()) for k in range(5)] + [pa.array([o[5] for o in out], pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                cols, ["doc_id", "row_id", "cls", "n_windows", "covered", "item_words", "item_start", "doc_start", "literal"]
            )

    matched = both.select("doc_id", "row_id", "cls", "size", "starts", "body", "item").mapInArrow(
        check,
        f"doc_id {doc_kind}, row_id long, cls long, n_windows long, covered long, item_words long, item_start long, doc_start long, literal boolean",
    )
    named = items.select("cls", "item_id").distinct()
    return matched.join(named, "cls").select("doc_id", "row_id", "item_id", *matched.columns[3:])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without contaminated rows; all columns stay. Rows are told apart by doc_id and text: a clean row stays under
    a repeated or null doc_id."""
    found = _found(docs, benchmark)
    d, t = unused(docs, "d"), unused(docs, "t")
    bad = stored(found.select(F.col("doc_id").alias(d), F.col("row_id").alias(t)).distinct())
    row = docs["doc_id"].eqNullSafe(F.col(d)) & F.xxhash64(docs["text"].cast("string")).eqNullSafe(F.col(t))
    return docs.join(sent(bad), row, "left_anti")


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
