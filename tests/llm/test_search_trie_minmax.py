"""Ranked search, the conversation trie and min-max hashing against brute force, with odd rows."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import minmax, ranksearch, trie
from millrace.llm.ngramjoin import Shingler

DATA = os.environ.get("MILLRACE_DATA", "/root/testdata/sf0.001")


# Ranked search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranking(docs, items, k):
    bags = [(d, collections.Counter(terms(t))) for d, t in docs]
    bags = [(d, b, b.total()) for d, b in bags if b]
    n, words = len(bags), sum(b[2] for b in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b, size in bags:
            m = 75 + 25 * size * n // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m)) for t in terms(text) if b[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, k=20, only=True):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    ranksearch.ship(spark)
    words = ranksearch._words_of(i)
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in ranksearch.search(ranksearch.build(d, words if only else None), words, k).collect()), key=repr)


def test_ranking_of_odd_rows(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = ["alpha", "Beta", "x1", "é", "Été", "漢字", "the", "zz"]
    docs = [(i, " ".join(rng.choices(vocabulary, [1, 1, 1, 1, 1, 1, 9, 1], k=rng.randrange(0, 40)))) for i in range(150)]
    docs += [(7, docs[7][1]), (None, docs[7][1]), (None, None), (200, ""), (201, "-- !!"), (202, "the " * 3000 + "zz"), (203, "zz" * 50_000)] + [(300 + i, "alpha beta") for i in range(30)]
    items = [(0, "alpha, BETA the the"), (1, None), (2, ""), (3, "été É 漢字"), (3, "zz zz zz"), (None, "x1"), (9, "unknown words"), (10, "the")]
    want = ranking(docs, items, 20)
    assert searched(spark, docs, items) == want
    assert searched(spark, docs, items, only=False) == want  # an index of all terms
    monkeypatch.setattr(ranksearch, "BLOCK_ITEMS", 3)  # several blocks
    assert searched(spark, docs, items, k=5) == ranking(docs, items, 5)
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == [] and searched(spark, [(1, None)], items) == []


def test_long_texts_are_cut_behind_a_term(monkeypatch):
    text = "ab cd " * 30 + "e" * 100 + " é" * 40
    whole = ranksearch.counts(text.encode())
    monkeypatch.setattr(ranksearch, "PIECE", 7)
    assert ranksearch.counts(text.encode()) == whole and whole[b"e" * 100] == 1


def test_bounds_hold():
    rng = np.random.default_rng(1)
    names = np.sort(rng.choice(10**9, 60, replace=False)).astype(np.int64)
    found = sorted((int(t), int(k), int(rng.integers(1, 20_000))) for k in range(9) for t in rng.choice(names, 12, replace=False))
    block = ranksearch._Block(np.unique([t for t, _, _ in found]), np.zeros(0), np.array([k for _, k, _ in found]), np.array([f for _, _, f in found]), 9)
    block = block._replace(start=np.searchsorted([t for t, _, _ in found], np.append(block.terms, np.iinfo(np.int64).max)))
    doc, term = np.repeat(np.arange(40), 25), np.concatenate([rng.choice(names, 25, replace=False) for _ in range(40)])
    tf, m = rng.integers(1, 30, len(doc)), np.repeat(rng.integers(75, 5000, 40), 25)
    part = 1_000_000_000 * tf // (1000 * tf + 12 * m)
    byte = -(-part // ranksearch.STEP)
    assert byte.max() <= 255
    up, low = ranksearch.bounds(block, doc, term, byte.astype(np.uint8), 40)
    factor = {(t, k): f for t, k, f in found}
    for d in range(40):
        for k in range(9):
            exact = sum(factor.get((int(t), k), 0) * int(p) for t, p in zip(term[doc == d], part[doc == d], strict=True))
            assert low[d, k] <= exact <= up[d, k] and (up[d, k] > 0) == any((int(t), k) in factor for t in term[doc == d])


# The trie


def nodes_of(rows):
    conv = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, r or "", x or ""))
    path = {}
    for c, turns in conv.items():
        turns.sort(key=lambda r: r[:2])
    for c in conv:
        h = zlib.crc32(str(c).encode()) % 6
        base = conv.get(c - int(math.fmod(c, 100)), [])
        path[c] = tuple(x[2:] for x in base[:h] + conv[c][h:])
    nodes = collections.defaultdict(list)
    for c, p in path.items():
        for d in range(len(p) + 1):
            nodes[p[:d]].append(c)
    kids, leaves, saved = collections.defaultdict(list), {}, {}
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(nodes[p]) - 1) * len(p[-1][1]) if p else 0)

    def digest(p, m):
        return hashlib.sha256(",".join(str(c) for c in sorted(m) if path[c] == p).encode()).hexdigest()

    return sorted(((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], digest(p, m)) for p, m in nodes.items()), key=repr)


TURNS = "conv_id long, turn long, role string, text string, nodes long, rep string"


def trie_of(spark, rows, path):
    spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS).write.parquet(f"{path}/conversations.parquet")
    return sorted(map(tuple, trie.op12_conversation_trie(spark, str(path)).collect()), key=repr)


def test_trie_of_odd_rows(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for c in [None, -205, -5, 0, 3, 7, 100, 101, 102, 155, 305, *range(400, 450), 499]:
        same = [rng.choice("ab") for _ in range(9)]
        for t in range(rng.choice([1, 1, 2, 4, 9])):
            rows.append((c, None if t == 0 else t * 900, rng.choice(["u", None, ""]) if c == 155 else "u", rng.choice([same[t], "é漢", None, ""])))
    rows += [(c, t, "u", "copy" * t) for c in (1000, 1003, 1050, 1001, 99_000_000_000) for t in range(7)]  # copies
    rows += [(2000 + k, t, "u", f"t{t}" if t < 20 + k else f"own {k}") for k in range(2) for t in range(30)]  # a long common part
    assert trie_of(spark, rows, tmp_path / "a") == nodes_of(rows)


def test_small_tries(spark, tmp_path):
    assert trie_of(spark, [], tmp_path / "none") == []
    for k, rows in enumerate(([(5, 0, "u", "hi")], [(3, t, "u", "hi") for t in range(9)], [(c, t, "u", "hi") for c in (0, 6, 8) for t in range(8)], [(None, 1, "u", "x")])):
        assert trie_of(spark, rows, tmp_path / str(k)) == nodes_of(rows)


def test_a_long_conversation_is_ordered_in_parts(spark):
    rows = [(4, t, "u", str(t)) for t in random.Random(1).sample(range(-3000, 3000), 3000)] + [(4, None, "u", "first")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [r["text"] for r in trie.ordered(df).orderBy("pos").select("text", "pos").collect()]
    assert got == ["first"] * 2 + [str(t) for t in sorted(t for _, t, _, _ in rows if t is not None)]
    assert [r["pos"] for r in trie.ordered(df).select("pos").orderBy("pos").collect()] == list(range(1, 3003))


def test_last_turns(spark):
    df = spark.createDataFrame([(0, 0, "u", "a"), (0, 1, "v", "b"), (100, 0, "u", "a")], "conv_id long, turn long, role string, text string")
    turns, convs = trie.rebuilt(trie.ordered(df))
    got = {(r["conv_id"], r["depth"]): (r["role"], r["text"]) for r in trie.last_turns(trie.build(turns, convs).nodes, turns).collect()}
    assert got == {(0, 0): (None, None), (0, 1): ("u", "a"), (0, 2): ("v", "b")}


# Min-max hashing


def components(docs, n, percent):
    ids = sorted({d for d, _ in docs if d is not None})
    sets = {}
    for d, text in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    top = {d: d for d in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in ids)


def grouped(spark, docs):
    df = spark.createDataFrame([(*d, 5, "k") for d in docs], "doc_id long, text string, n_shingles long, node string")
    return sorted(tuple(r) for r in minmax.near_duplicates(df).collect() if r["doc_id"] is not None)


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_near_copies_and_odd_rows(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choices([f"w{j}" for j in range(400)], k=rng.choice([1, 2, 3, 7, 20, 60, 300])))) for i in range(120)]
    docs += [(200 + i, edited(rng, docs[i][1], rng.choice([0, 1, 2, 5]))) for i in range(120)]
    docs += [(400, None), (401, ""), (402, " \t\n"), (403, "One"), (404, "one"), (405, "a b"), (406, "A  B"), (407, "é " * 5000), (408, "é " * 4999)]
    assert grouped(spark, docs) == components(docs, 3, 85)
    assert grouped(spark, []) == []


def test_crowded_buckets(spark, monkeypatch):
    """Many near copies of a few texts that share a passage: pairs in crowded buckets are found by blocks."""
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(120))
    docs = []
    for g in range(40):
        own = " ".join(f"g{g}w{rng.randrange(10**6)}" for _ in range(40))
        for _ in range(6):
            docs.append((len(docs), edited(rng, f"{passage} {own}", rng.choice([0, 1, 2, 3]))))
    monkeypatch.setattr(minmax, "CROWDED", 5)
    monkeypatch.setattr(minmax, "PART", 30)
    assert grouped(spark, docs) == components(docs, 3, 85)


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (3, text), (3, text), (2, text + " end"), (None, "alone with some words"), (None, None)]
    got = minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=repr) == sorted(
        [(None, 2, False), (3, 2, False), (3, 2, False), (2, 2, True), (None, None, True), (None, None, True)], key=repr
    )


def test_signatures_are_unbiased_and_vary_less():
    """Shares of equal values over many pairs: the mean is the similarity, and minima with maxima vary less than as many minima would."""
    rng = np.random.default_rng(3)
    shares = []
    for _ in range(400):
        common, a, b = (rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) for k in (6, 1, 1))
        (la, ha), (lb, hb) = minmax.extremes(np.concatenate([common, a])), minmax.extremes(np.concatenate([common, b]))
        shares.append(np.concatenate([la == lb, ha == hb]).mean())
    s, n = 6 / 8, 2 * minmax.PERMUTATIONS
    assert abs(np.mean(shares) - s) < 5 * math.sqrt(s * (1 - s) / n / 400)
    assert np.var(shares) < s * (1 - s) / n
    h = Shingler(3)("a b c d e f g")
    assert minmax.signature(*minmax.extremes(h)) == minmax.signature(*minmax.extremes(h[::-1])) and len(minmax.bands(*minmax.extremes(h))) == 28
    assert minmax.least_equal(85) == 119 and pa.array([1]).to_pylist() == [1]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_trie_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, trie.op12_conversation_trie(spark, DATA).collect()), key=repr) == nodes_of(rows)
