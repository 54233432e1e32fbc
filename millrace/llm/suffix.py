"""Removal of long repeated byte strings by a sparse, distributed suffix sort.

A byte goes if a LENGTH-byte string that covers it also starts anywhere else. Of all suffixes only those at
anchors are sorted: the places that hold the least hash of the WINDOW K-byte strings from some place on.
An anchor is chosen by content alone, so two equal LENGTH-byte strings have their anchor (that of the string's first
WINDOW places) at the same offset, which is below WINDOW: they agree on OWN = LENGTH - WINDOW + 1 bytes
from the anchor on, and on the bytes before it.

1. Anchors whose next OWN bytes occur at no other anchor are dropped (counts by fingerprint).
2. Each task sorts the suffixes of the anchors that are left, and sends them as runs, front-coded: the length of the
   prefix shared with the one before, and the rest, dealt to buckets by the fingerprint of the first OWN bytes.
   Suffixes with equal surroundings are sent once, with their number.
3. A task merges its runs with a loser tree whose nodes keep the common prefix with the last winner: strings are
   compared only beyond what is known to be common.
4. In the merged order suffixes with OWN bytes in common are neighbours. Within such a group strings that start at the same
   offset before their anchor and agree on LENGTH bytes are found, and their bytes are marked.

Defined results: a null text counts as empty; texts shorter than LENGTH lose nothing; repeated rows are
repeats like any others (all their bytes go if they have LENGTH or more); rows are told apart by
doc_id and text, so of rows equal in both each gets the same result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

LENGTH, K = 400, 16
WINDOW = 185
OWN = LENGTH - WINDOW + 1
#: Bytes of a text hashed at once.
CHUNK = 1 << 22
#: Buckets that the classes are dealt to, at least, and anchors of a bucket; context bytes that a task sorts into one run.
BUCKETS, PER_BUCKET, RUN_BYTES = 256, 20_000, 24 << 20
#: Suffixes of a run that are sent in one row, so that a batch of rows stays small.
BLOCK = 8
#: Members of a group up to which pairs are compared byte by byte; larger groups go by fingerprints, offset by offset.
PAIRWISE = 120
MULT = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _rolling(b: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the size-byte strings at every place, by doubling."""
    n = len(b) - size + 1
    out, have, at = None, b.astype(np.uint64) + np.uint64(1), 0
    width, rest = 1, size
    while rest:
        if rest & 1:
            part = have[at : at + n]
            out = part if out is None else _mix(out) * MULT + part
            at += width
        rest >>= 1
        if rest:
            have = _mix(have[: len(have) - width]) * MULT + have[width:]
            width *= 2
    return _mix(out)


def _least_places(h: np.ndarray, window: int) -> np.ndarray:
    """For each window of h the place of its least hash, the first of equals. 40 bits of hash decide, then the place."""
    v = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    n = len(h) - window + 1
    width = 1
    while width * 2 <= window:
        v = np.minimum(v[: len(v) - width], v[width:])
        width *= 2
    if width < window:
        v = np.minimum(v[:n], v[window - width : window - width + n])
    return (v[:n] & np.uint64(0xFFFFFF)).astype(np.int64)


class Anchors:
    """place: of each anchor that some LENGTH-byte string has; low, high: the first and last start of those strings."""

    def __init__(self, b: np.ndarray) -> None:
        parts = []
        for at in range(0, max(0, len(b) - LENGTH + 1), CHUNK):
            starts = min(CHUNK, len(b) - LENGTH + 1 - at)
            piece = b[at : at + starts + WINDOW + K - 2]
            parts.append(_least_places(_rolling(piece, K), WINDOW)[:starts] + at)
        of = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        cut = np.flatnonzero(np.diff(of)) + 1
        self.low = np.concatenate(([0], cut)).astype(np.int64) if len(of) else of
        self.high = np.concatenate((cut, [len(of)])) - 1 if len(of) else of
        self.place = of[self.low] if len(of) else of


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)


def _front_coded(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """(common prefix with the string before, rest) of sorted strings."""
    shared, rest, last = [], [], b""
    for s in strings:
        n = common(last, s, 0)
        shared.append(n)
        rest.append(s[n:])
        last = s
    return shared, rest


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix; the first known bytes are common and are not read."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    d = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (d.bit_length() + 7) // 8


class Run:
    """A front-coded sorted run; decodes its strings one at a time."""

    def __init__(self, shared: list[int], rest: list[bytes], load: list) -> None:
        self.shared, self.rest, self.load = shared, rest, load
        self.at, self.now = 0, b""
        self._set()

    def _set(self) -> None:
        if self.at < len(self.rest):
            self.now = self.now[: self.shared[self.at]] + self.rest[self.at]

    def step(self) -> int | None:
        """On to the next string: its common prefix with the one left, or None at the end."""
        self.at += 1
        if self.at >= len(self.rest):
            return None
        self._set()
        return self.shared[self.at]


def merge(runs: list[Run]) -> Iterator[tuple[bytes, int, object]]:
    """All strings of the runs in order, as (string, common prefix with the one before, load).

    A loser tree: at each node lies the run that lost there and the common prefix of its string with the last
    winner. Of two runs that one comes first whose common prefix with the last winner is longer; only where these
    are equal are bytes read, and only from there on.
    """
    k = len(runs)
    if not k:
        return
    size = 1
    while size < k:
        size *= 2
    lose = [-1] * size
    with_last = [0] * k
    done = [not r.rest for r in runs]

    def first(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's common prefix with the winner is noted."""
        if a < 0 or done[a]:
            return b, a
        if b < 0 or done[b]:
            return a, b
        x, y = with_last[a], with_last[b]
        if x != y:  # the loser's common prefix with the winner is the shorter one, as before
            return (a, b) if x > y else (b, a)
        s, t = runs[a].now, runs[b].now
        n = common(s, t, x)
        if n == len(s) and n == len(t):
            a, b = min(a, b), max(a, b)
        elif s > t if n == min(len(s), len(t)) else s[n] > t[n]:
            a, b = b, a
        with_last[b] = n
        return a, b

    def build(node: int) -> int:
        if node >= size:
            return node - size if node - size < k else -1
        a, b = first(build(2 * node), build(2 * node + 1))
        lose[node] = b
        return a

    top = build(1) if size > 1 else 0
    while top >= 0 and not done[top]:
        r = runs[top]
        yield r.now, with_last[top], r.load[r.at]
        n = r.step()
        if n is None:
            done[top] = True
        else:
            with_last[top] = n
        node = (top + size) // 2
        while node:
            top, lose[node] = first(top, lose[node])
            node //= 2


def _group_marks(members: list[tuple[bytes, bytes, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """For each member (left bytes reversed, right bytes, low, high offset, weight) the greatest and least offset whose LENGTH-byte
    string another shares (-1 and LENGTH: none).

    A string at offset o is the o bytes before the anchor and the LENGTH - o from it on. Offsets are taken one by one,
    over the members that have them; equal strings are found by fingerprints of the two sides.
    """
    m = len(members)
    lows, highs = (np.array([x[k] for x in members]) for k in (2, 3))
    weight = np.array([x[4] for x in members])
    first, last = int(lows.min()), int(highs.max())

    def raw(side: int, width: int) -> np.ndarray:
        out = np.zeros((width, m), np.uint8)
        for i, x in enumerate(members):
            s = x[side][:width]
            out[: len(s), i] = np.frombuffer(s, np.uint8)
        return out

    # fingerprints are sums of bytes times random weights, so that a byte more or less is one term
    left, right = raw(0, last), raw(1, LENGTH - first)
    term = lambda side, at, w: (side[at].astype(np.uint64) + np.uint64(1)) * w[at]
    a, b = np.zeros(m, np.uint64), np.zeros(m, np.uint64)
    for j in range(first):
        a += term(left, j, _LEFT)
    for j in range(LENGTH - first):
        b += term(right, j, _RIGHT)
    most, least = np.full(m, -1), np.full(m, LENGTH)
    for o in range(first, last + 1):
        have = np.flatnonzero((lows <= o) & (o <= highs))
        if len(have):
            _, inverse = np.unique(_mix(a[have]) * MULT + _mix(b[have]), return_inverse=True)
            again = have[np.bincount(inverse, weights=weight[have])[inverse] > 1]
            most[again] = o
            least[again] = np.minimum(least[again], o)
        if o < last:
            a += term(left, o, _LEFT)
            b -= term(right, LENGTH - o - 1, _RIGHT)
    return most, least


_LEFT, _RIGHT = np.random.default_rng(17).integers(1, 1 << 63, (2, LENGTH), dtype=np.uint64) | np.uint64(1)
_WEIGHTS = np.random.default_rng(11).integers(1, 1 << 63, OWN, dtype=np.uint64) | np.uint64(1)


def _fingerprints(b: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of the OWN bytes from each place on."""
    out = np.zeros(len(place), np.uint64)
    for at in range(0, len(place), 4096):
        part = place[at : at + 4096]
        out[at : at + 4096] = (b[part[:, None] + np.arange(OWN)].astype(np.uint64) * _WEIGHTS).sum(1, dtype=np.uint64)
    return _mix(out * MULT).view(np.int64)


def _context(raw: bytes, place: int, low: int, high: int) -> tuple[bytes, bytes, int, int]:
    """(left bytes reversed, right bytes, least and greatest offset) of the strings from low to high."""
    return raw[low:place][::-1], raw[place : high + LENGTH], place - high, place - low


def _name(context: tuple[bytes, bytes, int, int]) -> bytes:
    left, right, lo, hi = context
    return hashlib.blake2b(right + b"|" + left + f"|{lo}|{hi}".encode(), digest_size=16).digest()


def _chosen(text: str | None, indexes: list[int]) -> Iterator[tuple[int, bytes, tuple[bytes, bytes, int, int]]]:
    """(place, name, context) of the anchors with these numbers."""
    b = _bytes(text)
    raw, a = b.tobytes(), Anchors(b)
    for i in indexes:
        place = int(a.place[i])
        c = _context(raw, place, int(a.low[i]), int(a.high[i]))
        yield place, _name(c), c


def _reduced(members: list[tuple[tuple, int, bytes]]) -> Iterator[tuple[bytes, int, int]]:
    """(name, bytes back, bytes ahead) to remove for each context of a group."""
    back, low = [-1] * len(members), [LENGTH] * len(members)
    for i, ((_, _, lo, hi), weight, _) in enumerate(members):
        if weight > 1:  # equal surroundings elsewhere: all its strings are repeated
            back[i], low[i] = hi, lo
    if 1 < len(members) <= PAIRWISE:
        for i, ((left, right, lo, hi), _, _) in enumerate(members):
            for j in range(i):
                left2, right2, lo2, hi2 = members[j][0]
                # the offsets at which the two agree on LENGTH bytes
                least = max(lo, lo2, LENGTH - common(right, right2, OWN))
                most = min(hi, hi2)
                if least <= most:
                    most = min(most, common(left, left2, 0))
                    if least <= most:
                        back[i], back[j] = max(back[i], most), max(back[j], most)
                        low[i], low[j] = min(low[i], least), min(low[j], least)
    elif len(members) > 1:
        most, least = _group_marks([(*c, w) for c, w, _ in members])
        back, low = np.maximum(most, back).tolist(), np.minimum(least, low).tolist()
    for (_, _, name), most, least in zip(members, back, low, strict=True):
        if most >= 0:
            yield name, most, LENGTH - least


def marks(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and spans array<struct<a: int, b: int>>: bytes to remove, for each text that has any."""
    spark = docs.sparkSession
    ship(spark)
    kind = dict(docs.dtypes)["doc_id"]
    source = docs.select("doc_id", F.col("text").cast("string").alias("body")).withColumn("text_hash", F.xxhash64("body"))
    source = source.where(F.octet_length("body") >= LENGTH)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                rows, fps, index = [], [], []
                for r, x in enumerate(part.column("body")):
                    raw = _bytes(x.as_py())
                    place = Anchors(raw).place
                    rows.append(np.full(len(place), r, np.int32))
                    fps.append(_fingerprints(raw, place))
                    index.append(np.arange(len(place), dtype=np.int32))
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(fps)), part.column("doc_id").take(take), part.column("text_hash").take(take), pa.array(np.concatenate(index))],
                    ["fp", "doc_id", "text_hash", "i"],
                )

    every = stored(source.mapInArrow(anchors, f"fp long, doc_id {kind}, text_hash long, i int"))
    # stored, so that a fingerprint with very many anchors can be split in the join
    twice = stored(every.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"))
    # repeated rows have the same anchors: one list of them will do, since each row is read with it
    flagged = stored(
        every.join(twice, "fp").groupBy("doc_id", "text_hash").agg(F.collect_set("i").alias("i"))
        .select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), F.sort_array("i").alias("i"))
    )
    n_flagged = flagged.agg(F.sum(F.size("i"))).first()[0] or 0
    same = (F.col("text_hash") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d"))
    wanted = stored(source.join(flagged, same).select("doc_id", "text_hash", "body", "i"))
    n_buckets = max(BUCKETS, n_flagged // PER_BUCKET)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0
        run = TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            nonlocal run
            run += 1
            by: dict[int, list] = {}
            for name, (c, w) in held.items():
                bucket = int.from_bytes(hashlib.blake2b(c[1][:OWN], digest_size=8).digest(), "big") % n_buckets
                by.setdefault(bucket, []).append((c[1], c[0], c[2], c[3], w, name))
            cols: list[list] = [[] for _ in range(10)]
            for bucket, items in sorted(by.items()):
                items.sort()
                shared, rest = _front_coded([x[0] for x in items])
                for block, at in enumerate(range(0, len(items), BLOCK)):
                    part = slice(at, at + BLOCK)
                    for col, v in zip(cols, (bucket, run, block, shared[part], rest[part], *([x[k] for x in items[part]] for k in range(1, 6))), strict=True):
                        col.append(v)
            ints, blobs = pa.list_(pa.int32()), pa.list_(pa.binary())
            kinds = (pa.int32(), pa.int64(), pa.int32(), ints, blobs, blobs, ints, ints, ints, blobs)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], RUN)

        for b in batches:
            for body, index in zip(b.column("body"), b.column("i"), strict=True):
                for _, name, c in _chosen(body.as_py(), index.as_py()):
                    if name in held:
                        held[name][1] += 1
                    else:
                        held[name] = [c, 1]
                        size += len(c[0]) + len(c[1]) + 200
                if size >= RUN_BYTES:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    RUN = ["bucket", "run", "block", "shared", "rest", "left", "lo", "hi", "weight", "name"]
    sent = wanted.mapInArrow(
        runs,
        "bucket int, run long, block int, shared array<int>, rest array<binary>, left array<binary>, lo array<int>, hi array<int>, weight array<int>, name array<binary>",
    )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bucket_done(rows: list[Run]) -> Iterator[tuple[bytes, int, int]]:
            group: dict[bytes, list] = {}  # surroundings that several runs have count once, with their number
            for right, n, (left, lo, hi, weight, name) in merge(rows):
                if n < OWN and group:
                    yield from _reduced([(c, w, name_) for name_, (c, w) in group.items()])
                    group = {}
                if name in group:
                    group[name][1] += weight
                else:
                    group[name] = [(left, right, lo, hi), weight]
            if group:
                yield from _reduced([(c, w, name_) for name_, (c, w) in group.items()])

        def batch(found: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
            kinds = (pa.binary(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], t) for k, t in enumerate(kinds)], ["name", "back", "ahead"]
            )

        # blocks come by bucket, run and number; what is held are the runs of one bucket
        now, last, rows = None, None, []
        for b in batches:
            for bucket, run, shared, rest, *load in zip(*(b.column(c) for c in ("bucket", "run", *RUN[3:])), strict=True):
                if bucket.as_py() != now and rows:
                    yield batch(list(bucket_done([Run(*r) for r in rows])))
                    rows = []
                if not rows or run.as_py() != last:
                    rows.append(([], [], []))
                now, last = bucket.as_py(), run.as_py()
                for held, new in zip(rows[-1], (shared.as_py(), rest.as_py(), zip(*(x.as_py() for x in load), strict=True)), strict=True):
                    held.extend(new)
        if rows:
            yield batch(list(bucket_done([Run(*r) for r in rows])))

    dealt = sent.repartition("bucket").sortWithinPartitions("bucket", "run", "block")
    spans = stored(dealt.mapInArrow(merged, "name binary, back int, ahead int"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, names, at = [], [], []
            for r in range(b.num_rows):
                for place, name, _ in _chosen(b.column("body")[r].as_py(), b.column("i")[r].as_py()):
                    rows.append(r)
                    names.append(name)
                    at.append(place)
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(take), b.column("text_hash").take(take), pa.array(names, pa.binary()), pa.array(at, pa.int32())],
                ["doc_id", "text_hash", "name", "place"],
            )

    where = wanted.mapInArrow(places, f"doc_id {kind}, text_hash long, name binary, place int")
    found = where.join(spans, "name").select(
        "doc_id", "text_hash", F.struct((F.col("place") - F.col("back")).alias("a"), (F.col("place") + F.col("ahead")).alias("b")).alias("s")
    )
    return stored(found.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("s")).alias("spans")))


def unrepeated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans long, kept binary (the bytes left) for every row."""
    removed = marks(docs)
    kind = dict(docs.dtypes)["doc_id"]
    removed = removed.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), "spans")
    source = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    source = source.withColumn("text_hash", F.xxhash64("body"))
    same = (F.col("text_hash") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d"))
    joined = source.join(removed, same, "left").select("doc_id", "body", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                out = []
                for body, spans in zip(part.column("body"), part.column("spans"), strict=True):
                    raw = body.as_py().encode("utf-8", "replace")
                    kept, end, gone, runs = [], 0, 0, 0
                    for s in spans.as_py() or ():
                        if s["a"] > end or not runs:
                            kept.append(raw[end : s["a"]])
                            runs += 1
                            gone += s["b"] - s["a"]
                            end = s["b"]
                        elif s["b"] > end:
                            gone += s["b"] - end
                            end = s["b"]
                    kept.append(raw[end:])
                    out.append((len(raw), gone, runs, b"".join(kept)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array([o[k] for o in out], t) for k, t in enumerate(kinds))],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    done = unrepeated(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = """
WITH x AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), sized AS (SELECT doc_id, x, length(x) // 2 AS n FROM x
), starts AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, 800)) AS h FROM (SELECT doc_id, x, unnest(range(0, n - 399)) AS p FROM sized WHERE n >= 400)
), again AS (SELECT h FROM starts GROUP BY h HAVING count(*) > 1
), hit AS (SELECT doc_id, p, p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400, -1) AS new FROM starts WHERE h IN (SELECT h FROM again)
), numbered AS (SELECT doc_id, p, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS k FROM hit
), runs AS (SELECT doc_id, k, min(p) AS a, max(p) + 400 AS b FROM numbered GROUP BY 1, 2
), cut AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs
), kept AS (
  SELECT s.doc_id, count(a) AS n_spans, coalesce(sum(b - a), 0) AS n_removed,
    coalesce(string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a), '') || substr(any_value(x), 2 * coalesce(max(b), 0) + 1) AS left_
  FROM sized s LEFT JOIN cut c ON c.doc_id = s.doc_id GROUP BY 1
)
SELECT s.doc_id, n AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans, sha256(unhex(left_)) AS kept_sha256 FROM sized s JOIN kept k ON k.doc_id = s.doc_id
"""
