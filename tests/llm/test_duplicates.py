"""Line dedup, suffix dedup, n-gram join, decontamination and sharding against brute force; odd rows."""

import hashlib
import random
import re
import zlib

import pytest

from millrace.llm import decontam, linededup, ngramjoin, sharding, suffix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, node string, h string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", None, "x", "y", "z") for i, t in rows], SCHEMA)


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def family(seed=1):
    """Documents with exact and near copies, a shared passage, and odd rows."""
    rng = random.Random(seed)
    rows, k = [], 0
    passage = " ".join(words(rng, 30))
    for _ in range(40):
        base = words(rng, rng.randint(3, 120))
        for _ in range(rng.choice([1, 1, 2, 4])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 3])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            text = " ".join(w[:40]) + "\n" + " ".join(w[40:])
            rows.append((k, text + ("\n" + passage if rng.random() < 0.5 else "")))
            k += 1
    return rows + [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "One"), (None, "lonely null id words here now"), (905, "a b c d e"), (905, "a b c d e")]


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def shingle_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_ngram_join(spark):
    rows = family()
    got = {}
    for r in ngramjoin.similar(docs(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    sets = [(i, shingle_set(t, 4)) for i, t in rows if i is not None]
    u = Union()
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                u.join(i, j)
    for i, s in sets:
        assert all(r["n_shingles"] == len(s) and r["component_id"] == u.find(i) for r in got[i]), i
    assert got[None][0]["component_id"] is None and len(got[905]) == 2 and len(got) == len({i for i, _ in rows})
    assert ngramjoin.similar(docs(spark, rows).limit(0)).count() == 0
    kept = ngramjoin.keep_one(docs(spark, rows), 4, 85)
    assert sorted((r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)) == sorted({u.find(i) for i, _ in sets})


def test_ngram_join_over_a_null_id(spark):
    """A null id links its neighbours, though it names no component."""
    w = words(random.Random(17), 60)
    end, begin = [f"n{k}" for k in range(4)], [f"b{k}" for k in range(4)]
    a, n, b = w, [*w[:-4], *end], [*begin, *w[4:-4], *end]
    sets = [shingle_set(" ".join(x), 4) for x in (a, n, b)]
    share = lambda x, y: len(x & y) / len(x | y)
    assert share(sets[0], sets[1]) >= 0.85 <= share(sets[1], sets[2]) and share(sets[0], sets[2]) < 0.85
    got = {r["doc_id"]: r["component_id"] for r in ngramjoin.similar(docs(spark, [(1, " ".join(a)), (None, " ".join(n)), (3, " ".join(b)), (4, "x y z")])).collect()}
    assert got == {1: 1, None: 1, 3: 1, 4: 4}


def test_keep_one_by_row(spark):
    rng = random.Random(14)
    a, b, c = (words(rng, 60) for _ in range(3))
    near = lambda w, k: " ".join([*w[:-1], f"new{k}"])
    rows = [(1, " ".join(a)), (2, near(a, 1)), (2, " ".join(b)), (None, near(a, 2)), (None, " ".join(c)), (None, near(c, 3)), (3, "")]
    kept = [(r["doc_id"], r["text"]) for r in ngramjoin.keep_one(docs(spark, rows)).collect()]
    assert {rows[0], rows[2], rows[6]} <= set(kept) and len(kept) == 4
    assert sum(x in kept for x in rows[4:6]) == 1 and rows[1] not in kept and rows[3] not in kept


def test_prefix_keeps_enough():
    import numpy as np

    rng = np.random.default_rng(5)
    common = np.sort(rng.integers(1, 1 << 60, 50).astype(np.uint64))
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(np.concatenate([rng.integers(1, 1 << 60, n).astype(np.uint64), common[: int(rng.integers(0, 20))]]))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.93], rng.integers(1, 1 << 60, int(rng.integers(0, 3))).astype(np.uint64)]))
        if len(b) and ngramjoin.linked(a, b, 85):
            shared = np.intersect1d(ngramjoin.prefix(a, common, 85), ngramjoin.prefix(b, common, 85))
            assert len(shared) >= min(ngramjoin.least(len(a), 85), ngramjoin.least(len(b), 85))


def test_line_dedup(spark):
    rows = [(i, t) for i, t in family(2) if i is not None and i != 905]
    rows += [(950, "Same LINE, here and now!\n\nother words stay\n--\n--"), (951, "same line here and now\n--")]
    got = {r["doc_id"]: r for r in linededup.dedup(docs(spark, rows)).collect()}
    places, u, first, sets = [], Union(), {}, {}
    for i, t in sorted(rows):
        for p, line in enumerate((t or "").split("\n")):
            n = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", line.lower()).strip(" ")
            if n:
                places.append((i, p, n))
                sets[n] = {n[j : j + 5] for j in range(max(1, len(n) - 4))}
    names = list(sets)
    for x, a in enumerate(names):
        for b in names[:x]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                u.join(names.index(b), x)
    gone = {}
    for i, p, n in places:
        c = u.find(names.index(n))
        if c in first:
            gone.setdefault(i, set()).add(p)
        first.setdefault(c, (i, p))
    wanted = missed = 0
    for i, t in rows:
        r = got[i]
        if t is None:
            assert r["text"] is None and r["n_removed"] == 0
            continue
        lines, left = t.split("\n"), r["text"].split("\n") if r["n_removed"] < len(t.split("\n")) else []
        want = [x for p, x in enumerate(lines) if p not in gone.get(i, ())]
        kept = iter(left)
        assert all(x in kept for x in want), i  # no line goes that has no partner
        wanted += len(gone.get(i, ()))
        missed += len(left) - len(want)
    assert missed <= 0.03 * wanted and wanted > 30, (missed, wanted)  # bands of lines that are just 0.8 alike meet with a probability of 0.97
    assert got[951]["text"] == "--" and got[950]["text"] == rows[-2][1]
    empty = linededup.dedup(docs(spark, rows).limit(0))
    assert empty.count() == 0 and empty.columns[:3] == ["doc_id", "text", "lang"]


def near_lines(rng, size, tries):
    """Pairs of lines of about size shingles whose similarity is 0.8 to 0.87: characters changed at an end, where few shingles hold them."""
    out = []
    while len(out) < tries:
        a = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size + 4))
        k = rng.randint(1, 1 + size // 4)
        b = a[: -k] + "".join(rng.choice("0123456789") for _ in range(k)) if rng.random() < 0.5 else a + "".join(rng.choice("0123456789") for _ in range(k))
        x, y = ({z[j : j + 5] for j in range(len(z) - 4)} for z in (a, b))
        if 80 * len(x | y) <= 100 * len(x & y) < 87 * len(x | y):
            out.append((a, b))
    return out


def test_line_dedup_recall_by_length(spark):
    rng, sizes = random.Random(12), (9, 15, 20, 23, 30, 40, 47, 50, 57, 90)
    pairs = [p for size in sizes for p in near_lines(rng, size, 150)]
    rows = [(k, "\n".join(p[k] for p in pairs)) for k in (0, 1)]
    got = linededup.removals(docs(spark, rows)).collect()
    assert [r["doc_id"] for r in got] == [1]
    found = [sum(at // 150 == k for at in got[0]["places"]) / 150 for k in range(len(sizes))]
    assert min(found) >= 0.97, dict(zip(sizes, found, strict=True))


def test_line_dedup_knows_rows_apart(spark):
    """A line goes only where it stands elsewhere, under repeated and null ids, with odd characters and clashing names."""
    common, odd = "one common line that stands in very many places of this table", "a\u2028b c\u0085d e\u2029f and more text here"
    rows = [
        (3, common + "\nalpha only in three"), (7, common + "\nbravo only in seven A"), (7, "yankee only in seven B and nowhere\n" + common),
        (None, "zulu only here\n" + common), (None, common + "\nxray only there"), (8, odd), (9, odd + "s"), (9, None), (10, ""), (10, "--"),
    ]
    d = docs(spark, rows).toDF("doc_id", "text", "_mr_doc0", "_mr_row0", "_mr_places0", "key", "hash", "c")
    got = linededup.dedup(d)
    assert got.columns == [*d.columns, "n_lines", "n_removed"]
    texts = sorted((r["doc_id"] or 0, r["text"] or "") for r in got.collect())
    assert sum(common in t for _, t in texts) == 1 and [t for i, t in texts if i == 8] == [odd]
    for alone in ("alpha only in three", "bravo only in seven A", "yankee only in seven B and nowhere", "zulu only here", "xray only there"):
        assert sum(alone in t for _, t in texts) == 1, alone
    assert (9, "") in texts and (9, odd + "s") not in texts and (10, "--") in texts


def test_line_dedup_of_lines_that_repeat_themselves(spark):
    rng = random.Random(15)
    unit = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(90))
    short = "tick tock "
    rows = [(0, "\n".join([unit * 2, short * 6])), (1, "\n".join([unit * 9, short * 40])), (2, "\n".join([unit * 30, short * 7, "entirely other words"]))]
    gone = {r["doc_id"]: list(r["places"]) for r in linededup.removals(docs(spark, rows)).collect()}
    assert gone == {1: [0, 1], 2: [0, 1]}


def test_line_dedup_recall_over_levels(spark):
    """Lines of several hundred shingles around the borders of levels; edits in the middle."""
    rng, pairs = random.Random(16), []
    for size in (100, 150, 185, 191, 193, 200, 300, 700, 765, 800, 1500):
        for _ in range(40):
            a = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size + 4)]
            b = list(a)
            for _ in range(max(1, size // 50)):
                b[rng.randrange(len(b))] = rng.choice("0123456789")
            if rng.random() < 0.5:
                b += [rng.choice("0123456789") for _ in range(size // 20)]
            x, y = ({"".join(z[j : j + 5]) for j in range(len(z) - 4)} for z in (a, b))
            if 100 * len(x & y) >= 80 * len(x | y):
                pairs.append(("x" + "".join(a), "x" + "".join(b)))
    rows = [(k, "\n".join(p[k] for p in pairs)) for k in (0, 1)]
    got = linededup.removals(docs(spark, rows)).collect()
    assert [r["doc_id"] for r in got] == [1] and len(got[0]["places"]) >= 0.97 * len(pairs) > 200


@pytest.mark.parametrize(("n", "head", "tail", "edit"), [(400, 150, 24, 15), (3000, 150, 24, 15), (1500, 200, 30, 16), (2000, 22, 12, 2)])
def test_line_dedup_in_crowded_buckets(spark, n, head, tail, edit):
    """Many different tails after one head, so that lines of different clusters share most buckets: every link is found, whatever their number."""
    rng = random.Random(13)
    letters = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    same = letters(head)
    firsts = [same + letters(tail) for _ in range(n)]
    copies = [f[:-edit] + letters(edit) for f in firsts]
    rows = [(0, "\n".join(firsts)), (1, "\n".join(copies))]
    sets = [{z[j : j + 5] for j in range(len(z) - 4)} for z in firsts + copies]
    # brute force over all pairs: shingles that are in every line count for all, the rest by an inverted list
    everywhere = set.intersection(*sets)
    held, u = {}, Union()
    for x, a in enumerate(sets):
        shared = {}
        for h in a - everywhere:
            for y in held.setdefault(h, []):
                shared[y] = shared.get(y, 0) + 1
            held[h].append(x)
        assert 180 * len(everywhere) < 80 * 2 * min(len(a), len(sets[0]))  # a pair needs more than these
        for y, k in shared.items():
            if 180 * (k + len(everywhere)) >= 80 * (len(a) + len(sets[y])):
                u.join(x, y)
    want = sum(u.find(x) != x for x in range(len(sets)))
    got = sum(len(r["places"]) for r in linededup.removals(docs(spark, rows)).collect())
    assert 0.99 * want <= got <= want and want > n // 2, (got, want)


def removed(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    for t in texts:
        cover = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cover[i : i + length] = b"\1" * length
        yield cover


def test_suffix_dedup(spark):
    rng = random.Random(4)
    long = [" ".join(words(rng, 400)) for _ in range(5)]
    p = long[0][200:700]
    rows = [(k, t) for k, t in enumerate(long)]
    rows += [(10, "start " + p + " end é" + long[1][:450]), (11, long[2][:399]), (12, long[2][3:402] + "x"), (13, long[3][100:500] + long[3][100:501])]
    rows += [(14, "ab" * 700), (15, None), (16, ""), (17, "short"), (18, long[4][5:405]), (19, "zq" + p[:401] + "yy"), (20, "qq" + p[1:402] + "yx"), (None, "n" + p[50:460])]
    rows += [(21, "z" * 1300), (22, " ".join(words(rng, 100))), (22, " ".join(words(rng, 100)))]
    d = docs(spark, rows)
    got = [r.asDict() for r in suffix.unrepeated(d).collect()]
    texts = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), t, c in zip(rows, texts, removed(texts, 400), strict=True):
        runs = sum(c[k] and not (k and c[k - 1]) for k in range(len(c)))
        want.append((i, len(t), sum(c), runs, hashlib.sha256(bytes(x for x, y in zip(t, c, strict=True) if not y)).hexdigest()))
    have = [(g["doc_id"], g["n_bytes"], g["n_removed"], g["n_spans"], hashlib.sha256(bytes(g["kept"])).hexdigest()) for g in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    twice = docs(spark, [(1, long[0]), (1, long[0])])
    assert [r["n_removed"] for r in suffix.unrepeated(twice).collect()] == [len(long[0])] * 2
    assert suffix.unrepeated(d.limit(0)).count() == 0


def test_loser_tree_and_front_coding():
    rng = random.Random(6)
    for k in (1, 2, 3, 7):
        runs, every = [], []
        for _ in range(k):
            s = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 30)))
            every += s
            shared, rest = suffix._front_coded(s)
            runs.append(suffix.Run(shared, rest, s))
        out = list(suffix.merge(runs))
        assert [x for x, _, _ in out] == sorted(every) and all(a == b for a, _, b in out)
        assert all(n == suffix.common(a[0], b[0], 0) for a, b, n in zip(out, out[1:], [x[1] for x in out[1:]], strict=False))


def test_decontamination(spark):
    item = "Mary has 5 apples and buys 9 more apples for 2 dollars each at the big market. How much does Mary pay for all the apples together?"
    plain = "the and of erblein whose shape nobody knew was lying beside seven small grey stones near a wide slow river that evening"
    bench = spark.createDataFrame([(1, item), (2, plain), (3, None), (4, "too short"), (2, plain)], "item_id long, text string")
    other = item.replace("Mary", "Tom").replace("5", "17").replace("9", "25").replace("2 dol", "3 dol")
    rows = [
        (1, "Before it. " + item + " After it."), (2, "Yes. " + other), (3, "x y " + plain.upper() + " z"), (4, " ".join(plain.split()[:9])),
        (5, "words that have nothing to do with any of the items, not even 5 apples"), (6, None), (7, ""),
        (8, other.replace("How much does Tom", "How much does Ann")), (None, item), (1, "clean text under a repeated id"),
    ]
    d = docs(spark, rows)
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.contaminated(d, bench).collect()}
    assert {(1, 1), (2, 1), (3, 2), (None, 1)} <= set(got) and not {i for i, _ in got} & {4, 5, 6, 7}
    assert got[1, 1]["literal"] and not got[2, 1]["literal"] and got[2, 1]["covered"] >= got[2, 1]["item_words"] - 1
    left = decontam.decontaminate(d, bench)
    assert left.columns == d.columns and sorted((r["doc_id"], r["text"] == rows[-1][1]) for r in left.collect()) == [(1, True), (4, False), (5, False), (6, False), (7, False)]
    assert decontam.contaminated(d, bench.limit(0)).count() == 0 == decontam.contaminated(d.limit(0), bench).count()
    texts = [item, other, plain, "Ünder 3 kg x_y 5 Kg don't O'Neil a Bob 7", "It is Ann's 3.5 miles", "a ² b 4, Kg x 7\nkg", "", "  A  Bc 5  Days", "3", "kg 𠀀x 1,2.3, 4", *(t or "" for _, t in family())]
    slots = {"<num>": decontam._NUM, "<name>": decontam._NAME, "<unit>": decontam._UNIT}
    plain_words, typed_words, cuts = decontam.coded(texts)
    for t, i, j in zip(texts, cuts[:-1], cuts[1:], strict=True):
        words_, typed, _ = decontam.canonical(t)
        assert plain_words[i:j].tolist() == [decontam._hash(w) for w in words_], t
        assert typed_words[i:j].tolist() == [slots.get(w) or decontam._hash(w) for w in typed], t
    long = " ".join(words(random.Random(3), 200_000)) + " Bob has 3 kg of " + "z" * 600_000 + " end"
    words_ = decontam.canonical(long)[0]
    assert decontam.coded(["a b", long, "c"])[2].tolist() == [0, 2, 2 + len(words_), 3 + len(words_)]
    assert decontam.coded([long])[0][-6:].tolist() == [decontam._hash(w) for w in words_[-6:]]
    a, b = decontam.canonical(item), decontam.canonical(other.replace("25 more", "17 more"))
    assert not decontam.consistent(a[0], a[1], b[0]) or decontam.consistent(a[0], a[1], decontam.canonical(other)[0])


def test_decontamination_of_edited_copies(spark):
    long = " ".join(f"alpha{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40))
    short = " ".join(long.split()[20:32]).replace("alpha", "beta")
    names = "Zelda has 5 small red apples in the old basket. Zelda buys 9 more of them at the big market. Zelda then gives 2 of all those apples to her friend. Zelda counts the rest of the apples once again."
    bench = spark.createDataFrame([(1, long), (2, short), (3, names)], "item_id long, text string")
    w, v = long.split(), short.split()
    edits = [
        (1, w[:20] + ["changed"] + w[21:]), (1, w[:20] + ["put", "in"] + w[20:]), (1, w[:20] + w[22:]),
        (1, w[:13] + ["odd"] + w[14:26] + ["odd"] + w[27:]), (2, v[:6] + ["changed"] + v[7:]), (3, names.replace("Zelda", "Quentin").split()),
    ]
    clean = [w[:9] + ["other"] * 30, w[9:18] + ["other"] * 9 + w[:9], v[:5] + ["x", "y"] + v[:5]]
    rows = [(k, "lead in " + " ".join(x) + " and out") for k, x in enumerate([x for _, x in edits] + clean)]
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs(spark, rows), bench).collect()}
    assert got == {(k, i) for k, (i, _) in enumerate(edits)}


def aligned(item, doc):
    """Most words that any alignment of item and doc under the rules of a match agrees in, slots taken as open: over all places, no hashes, no windows."""
    (ip, it, ic), (dp, dt, dc) = item, doc
    agree = {(i, d) for i in range(len(ip)) for d in range(len(dp)) if it[i] == dt[d] or ip[i] == dp[d]}
    best = {}
    for i, d in sorted(agree):
        best[i, d] = 1 + best.get((i - 1, d - 1), 0)
        if all((i + k, d + k) in agree for k in range(decontam.AGAIN)):
            for x, y in decontam.GAPS:
                before = best.get((i - 1 - x, d - 1 - y))
                if before:
                    names = sum(ic[i - k] and dc[d - k] for k in range(1, x + 1)) if x == y else 0
                    best[i, d] = max(best[i, d], 1 + before + names)
    return max(best.values(), default=0)


def test_decontamination_against_all_alignments(spark):
    """Over all pairs: what is found is aligned well enough somewhere; of what is, with words as they stand, 0.95 is found (the rest has no whole window, or slots that differ)."""
    rng = random.Random(8)
    word = lambda: rng.choice([f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(5))}", f"w{chr(97 + rng.randrange(26))}x", str(rng.randrange(50)), rng.choice(["Ann", "Bob", "Eve"]), "kg"])
    items = [[word() for _ in range(rng.randint(6, 45))] for _ in range(40)]
    items.append(list(items[0]))  # an item twice

    def edited(w):
        w = list(w)
        for _ in range(round(len(w) * rng.choice([0, 0.05, 0.1, 0.15, 0.25, 0.4]))):
            i = rng.randrange(len(w))
            w[i : i + rng.randint(0, 1)] = [word() for _ in range(rng.randint(0, 2))]
        return w

    texts = [" ".join([word() for _ in range(rng.randrange(30))] + edited(items[k % 41]) + [word() for _ in range(rng.randrange(30))]) for k in range(160)]
    texts += [" ".join(word() for _ in range(90)) for _ in range(20)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs(spark, list(enumerate(texts))), bench).collect()}
    it, dt = [decontam.canonical(" ".join(w)) for w in items], [decontam.canonical(t) for t in texts]
    least = [min(decontam.LONG, max(decontam.COVER * len(w[0]), min(decontam.sizes(len(w[0])), len(w[0])))) for w in it]
    want = {(d, k) for d in range(len(dt)) for k in range(len(it)) if aligned(it[k], dt[d]) >= least[k]}
    assert got <= want and {d for d, k in got if k == 0} == {d for d, k in got if k == 40} != set()
    literal = {(d, k) for d, k in want if aligned((it[k][0],) * 2 + (it[k][2],), (dt[d][0],) * 2 + (dt[d][2],)) >= least[k]}
    assert len(got & literal) >= 0.95 * len(literal) and len(literal) > 100, (len(got & literal), len(literal))


@pytest.mark.parametrize("kind", ["changed", "put in", "left out", "new values"])
def test_decontamination_recall(spark, kind):
    """Items of the table planted with a tenth of their words edited, or all their numbers and names: at least 0.95 are found, by their own item alone."""
    rng = random.Random(kind)
    stock = [f"stock{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]
    base = [[rng.choice(stock) for _ in range(rng.randint(12, 60))] for _ in range(150)]
    for w in base if kind == "new values" else ():
        for i in range(2, len(w), 5):
            w[i] = rng.choice(["Zelda", "Quentin", "12", "3.5", "70"])
    rows = []
    for k, w in enumerate(base):
        w = list(w)
        if kind == "new values":
            to = {"Zelda": "Ida", "Quentin": "Max", "12": "31", "3.5": "8", "70": "44"}
            w = [to.get(x, x) for x in w]
        for _ in range(0 if kind == "new values" else max(1, len(w) // 10)):
            i = rng.randrange(len(w))
            w[i : i + (kind != "put in")] = [] if kind == "left out" else [rng.choice(stock)]
        rows.append((k, " ".join([rng.choice(stock) for _ in range(40)] + w + [rng.choice(stock) for _ in range(40)])))
    rows += [(1000 + k, " ".join(rng.choice(stock) for _ in range(400))) for k in range(100)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(base)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs(spark, rows), bench).collect()}
    assert all(d == i for d, i in got) and len(got) >= 0.95 * len(base), len(got)


def test_decontamination_by_a_hot_template(spark, monkeypatch):
    """One template in all documents and half of the items: its rows are dealt to several tasks, and the result stays."""
    head = "how many of the small red apples in the old basket does"
    items = [f"{head} item{chr(97 + k)} keep for the long way home" for k in range(12)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    d = docs(spark, [(k, f"{head} nobody know {items[k % 12] if k % 3 == 0 else 'at all'}") for k in range(90)])
    once = sorted(map(tuple, decontam.contaminated(d, bench).collect()))
    monkeypatch.setattr(decontam, "EVEN", 5)
    monkeypatch.setattr(decontam, "sent", lambda df: df)
    assert sorted(map(tuple, decontam.contaminated(d, bench).collect())) == once and {r[0] for r in once} >= set(range(0, 90, 3))


def test_decontamination_of_items_full_of_slots(spark):
    few = "Anna sold 12 kg for 30 dollars"
    drill = "3 4 7 12 9 21 5 8 13 20 11 31 40 2 42 6 6 12"
    bench = spark.createDataFrame([(1, few), (2, drill)], "item_id long, text string")
    rows = [(1, "So it was. " + few + ". Then"), (2, "sums " + drill + " end"), (3, few.replace("12", "13")), (4, "sums " + " ".join(drill.split()[::-1]) + " end"), (5, drill[:20] + " 77 78 79 80 81 82 83 84 85 86 87 88 89")]
    got = [(r["doc_id"], r["item_id"], r["literal"]) for r in decontam.contaminated(docs(spark, rows), bench).collect()]
    assert sorted(got) == [(1, 1, True), (2, 2, True)]


def test_sharding(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(words(rng, rng.randint(1, 80)))) for i in range(1500)] + [(2000 + i, "one very common text of all") for i in range(800)]
    rows += [(5000, None), (5001, ""), (None, "n"), (5002, "same"), (5002, "same")]
    d = docs(spark, rows)
    got = sharding.shards(d).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) == set(range(24)) and all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    total = [sum(r["size"] for r in v) for v in by.values()]
    assert max(total) - min(total) < 0.05 * sum(total) / 24 + 1200
    text = {i: t for i, t in rows}
    assert all(r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode()) and r["size"] == len((text[r["doc_id"]] or "").encode()) + 8 for r in got)
    assert sharding.shards(d.limit(0)).count() == 0


def test_pairs_and_fingerprints_agree(monkeypatch):
    rng = random.Random(9)
    base = bytes(rng.randrange(97, 101) for _ in range(900))
    members = []
    for k in range(25):
        at = 250
        b = bytearray(base)
        for _ in range(rng.choice([0, 1, 2])):
            i = rng.choice([rng.randrange(66, at), rng.randrange(at + suffix.OWN, 650)])
            b[i] = 35 + k
        low, high = at - rng.randrange(90, 184), at - rng.randrange(0, 80)
        c = suffix._context(bytes(b), at, low, high)
        members.append((c, rng.choice([1, 1, 1, 2]), suffix._name(c)))
    pairs = sorted(suffix._reduced(members))
    monkeypatch.setattr(suffix, "PAIRWISE", 0)
    assert pairs == sorted(suffix._reduced(members)) and pairs
