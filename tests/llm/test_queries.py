"""Queries against their SQL, whole tables against independent versions, and odd rows through operators and stages."""

import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import decontam, langid, license, linededup, ngramjoin, queries, secrets, sentencepiece, sharding, suffix
from tests.llm.test_duplicates import docs, removed, words

duckdb = pytest.importorskip("duckdb")
DATA = os.environ.get("MILLRACE_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(queries.SQL[name])
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == columns
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == sorted(
        (tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall()), key=repr
    )


def test_base_spans_of_all_documents(spark):
    """Against another engine's regular expressions, one kind and one case at a time."""
    regex = pytest.importorskip("regex")
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    kinds = {
        "assign": (regex.compile(rf"(?:{word})[\"']?[ ]*[:=][ ]*[\"']?([A-Za-z0-9+/_.=\-]+)", regex.ASCII), 1, 6),
        "access": (regex.compile(r"AKIA[A-Z0-9]+", regex.ASCII), 0, 20), "hex": (regex.compile(r"[0-9a-f]+", regex.ASCII), 0, 24),
    }
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    extra = ["Api_Key = 'abcdef' apikey:\"a.b-c/d+e\" PASSWD=12345 token : x secret=abcdefg" * 3, "AKIA" + "Z9" * 8 + " AKIAAKIA" + "0" * 12, "0f" * 12 + "g" + "a" * 23]
    seen = 0
    for text in [r["text"] or "" for r in rows] + extra:
        want = []
        for k, (name, (pattern, group, least)) in enumerate(kinds.items()):
            want += [(m.start(), k, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
        assert secrets.base_spans(text) == sorted(want)
        seen += len(want)
    assert seen > 3


def test_held_out_accuracy(spark):
    larger = os.path.join(os.path.dirname(DATA), "sf0.01")  # the smallest tables have too few documents to learn from
    if not os.path.isdir(larger):
        pytest.skip("no larger tables")
    got = queries.QUERIES["op3_language_id"](spark, larger)
    truth = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang", "text").where("lang IS NOT NULL AND length(text) > 20")
    r = got.where("held_out").join(truth, "doc_id").agg(F.count("*").alias("n"), F.count_if(F.col("lang") == F.col("lang_pred")).alias("right")).first()
    assert r["n"] > 20 and r["right"] >= 0.97 * r["n"]


def test_many_languages_are_all_learned(spark):
    rng = random.Random(3)
    rows = []
    for k in range(230):
        own = "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 6))
        rows += [(k * 4 + j, " ".join("".join(rng.choice(own) for _ in range(5)) for _ in range(20)), f"l{k:03}") for j in range(2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {lang for lang, _ in langid.sample(d)}
    fold = {r["lang"] for r in d.where(~langid.held_out(F.col("doc_id"))).select("lang").distinct().collect()}
    assert learned == fold and len(fold) > 200


def test_licence_phrases_and_chains_of_any_size():
    auto = license.Automaton({"mit license": "mit", "zlib": "zlib", "...": "none"}, {"t": "a b c d e a b c f g"})
    got = license.scan(auto, "qqq MIT license zzz zlib")
    assert got["n_base"] == 2 and got["base_labels"] == "mit,zlib" and (got["first_word"], got["last_word"]) == (1, 4)
    # the second place of "a b c" in the template is chained too
    chained = license.Automaton({}, {"t": "p q r s x y z w p q r s u v"})
    assert license.scan(chained, "x y z w odd p q r s u v")["spans"] == "t:0:10"
    many = license.Automaton({}, {"t": " ".join(f"w{k}" for k in range(1000))})
    text = " ".join(" ".join(f"w{k}" for k in range(j, j + 4)) + " odd" for j in range(0, 1000, 5))
    assert license.scan(many, text)["score"] == pytest.approx(0.8)


def test_shards_divide_repeated_rows(spark):
    same = [(1, "one text that is repeated")] * 2400 + [(k, f"own {k} " + "x" * (k % 90)) for k in range(2, 1200)]
    got = sharding.shards(docs(spark, same).repartition(5)).collect()
    total, slots = {}, {}
    for r in got:
        total[r["shard"]] = total.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(total) == 24 and max(total.values()) - min(total.values()) < 0.04 * sum(total.values()) / 24 + 400
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {r["text_crc32"] for r in got if r["doc_id"] == 1} == {zlib.crc32(same[0][1].encode())}


def test_very_long_texts(spark):
    rng = random.Random(21)
    long = " ".join(words(rng, 60_000, 30_000))
    key = "Zx81kQv27LmN0pR5sT9u"
    rows = [(1, long + f"\nsecret: {key}"), (2, long.replace(" ", "\n", 50) + " end"), (3, "short text of its own"), (4, "z" * 300_000)]
    d = docs(spark, rows)
    found = {r["doc_id"]: r for r in secrets.secrets(d).collect()}
    assert found[1]["n_assign"] == 1 and found[1]["spans"].startswith(f"assign:{len(long) + 1}:")
    bench = spark.createDataFrame([(9, " ".join(long.split()[30_000:30_040]))], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(d, bench).collect()} == {(1, 9), (2, 9)}
    assert {r["doc_id"]: r["component_id"] for r in ngramjoin.similar(d).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    cut = {r["doc_id"]: r["n_removed"] for r in suffix.unrepeated(docs(spark, [rows[0], (5, "qq" + long[1000:2000] + "rr"), rows[2]])).collect()}
    assert cut == {1: 1000, 5: 1000, 3: 0}
    want = [sum(c) for c in removed([("z" * 3000).encode()], 400)]
    assert [r["n_removed"] for r in suffix.unrepeated(docs(spark, [(1, "z" * 3000)])).collect()] == want
    sizes = {r["doc_id"]: r["size"] for r in sharding.shards(d, 4).collect()}
    assert sizes == {i: len(t.encode()) + 8 for i, t in rows}
    lines = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in linededup.dedup(d).collect()}
    assert lines[1] == (2, 0) and lines[3] == (1, 0) and lines[2][0] == 51


ODD = [
    (None, "the quick brown fox jumps over the lazy dog and runs away into the dark green wood"), (None, None), (1, ""), (2, "   \n\t"), (3, None),
    (4, "tie one two three four five six seven eight nine ten"), (4, "tie one two three four five six seven eight nine ten"), (5, "123 456 !!"), (6, "é" * 5000),
    (7, "a line of its own\n\n\nanother line here\na line of its own"), (7, "other text under the same id with words that nobody else has"),
]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_over_odd_rows(spark, name):
    """Nulls in any column, empty and repeated rows, equal ids, an empty table, clashing names."""
    stage = dict(corpus_pipeline.STAGES)[name]
    d = docs(spark, ODD).withColumnRenamed("shard", "_mr_n_removed").withColumnRenamed("node", "_mr_doc0").withColumn("lang", F.when(F.col("doc_id") != 5, "en"))
    out = stage(spark, d, DATA)
    got = out.collect()
    if name == "encoding":
        assert len(got) == len(ODD)
        return
    assert out.columns == d.columns
    texts = [r["text"] for r in got]
    assert any(t and t.startswith("the quick brown") for t in texts) and any(t and t.startswith("other text") for t in texts)
    assert len(got) <= len(ODD) and stage(spark, d.limit(0), DATA).count() == 0
    if name == "ngram_join":
        assert sum(bool(t) and t.startswith("tie one") for t in texts) == 1
    if name == "decontamination":
        assert len(got) == len(ODD)


def test_clashing_names(spark):
    clash = ["_mr_gone_doc", "_mr_doc0", "_mr_bad_doc", "_mr_dropped", "_mr_again", "t", "c", "d"]
    d = docs(spark, ODD)
    for name in clash:
        d = d.withColumn(name, F.lit("q"))
    bench = spark.createDataFrame([(1, "tie one two three four five six seven eight nine ten")], "item_id long, text string")
    for out in (linededup.dedup(d).drop("n_lines", "n_removed"), decontam.decontaminate(d, bench), ngramjoin.keep_one(d)):
        assert out.columns == d.columns and 0 < out.count() <= len(ODD)
    assert decontam.decontaminate(d, bench).where("doc_id = 4").count() == 0
    v = sentencepiece.load(spark)
    assert sentencepiece.tokenize(d, v).count() == len(ODD)
