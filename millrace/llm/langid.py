"""Language identification: averaged hashed subword embeddings under a linear softmax.

train() fits the model by stochastic gradient descent in numpy on a bounded, documented sample of
labelled rows; predict() scores every whole text on the executors. Embedding table times output
matrix is folded into one table of BUCKETS rows, so what is broadcast has a fixed size.

Defined results: a null text, or one without any letter, gets `und` with score 0 and is rejected; with
nothing to learn from (an empty table, or no label) every text gets `und`. Ties between languages go to
the alphabetically first. Repeated rows are judged each by itself; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, unused

BUCKETS = 1 << 15
DIM = 16
ORDERS = (2, 3, 4)
#: Bounds of the training sample: rows of each language, rows of all languages (which share them, if there are many), characters of a row's window.
ROWS_PER_LANG, ROWS, WINDOW = 1200, 240_000, 400
#: Share of windows of known languages that calibration lets the rejection threshold turn away, and its largest value.
FALSE_REJECTS, MOST = 0.002, 0.5
SLICE = 1 << 18

_MAP = np.full(256, 32, np.uint8)
for _c in b"abcdefghijklmnopqrstuvwxyz":
    _MAP[_c] = _c
_MAP[128:] = np.arange(128, 256)
_ODD = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


def subwords(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of the byte 2- to 4-grams of the lower-cased text, word ends marked, a slice at a time."""
    for at in range(0, len(text), SLICE):
        raw = f" {text[at : at + SLICE].lower()} ".encode("utf-8", "replace")
        b = _MAP[np.frombuffer(raw, np.uint8)]
        gap = b == 32
        b = b[np.concatenate(([True], ~(gap[1:] & gap[:-1])))]
        b = b.astype(np.uint32)
        n, h, out = len(b), np.zeros(len(b), np.uint32), []
        for k in range(max(ORDERS)):
            h = (h[: n - k] + (b[k:] + np.uint32(1)) * _ODD[k]) * np.uint32(0x01000193) if k else (b + np.uint32(1)) * _ODD[0]
            if k + 1 in ORDERS:
                out.append((h ^ (h >> np.uint32(15))) % np.uint32(BUCKETS))
        yield np.concatenate(out)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    """table: logits each bucket adds (mean over a text's subwords), bias and temperature folded in later."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.langs)), 0
        for h in subwords(text):
            if len(h) < 4096:
                total += self.table[h].sum(0, dtype=np.float64)
            else:
                total += np.bincount(h, minlength=BUCKETS) @ self.table
            n += len(h)
        z = (total / max(n, 1) + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def fit(rows: list[tuple[str, str]], seed: int = 7, epochs: int = 6, rate: float = 1.0) -> Model | None:
    """The model from (lang, window) rows: a fifth of them, held back, sets temperature and threshold."""
    rows = sorted((lang, text) for lang, text in rows if text and has_letter(text))
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    cases = []
    for lang, text in rows:
        # texts of all lengths are met later, so windows of all lengths are learned and calibrated on
        size = int(np.exp(rng.uniform(np.log(12), np.log(WINDOW))))
        at = int(rng.integers(0, max(1, len(text) - size)))
        cut = text[at : at + size]
        cases.append((langs.index(lang), np.concatenate(list(subwords(cut if has_letter(cut) else text)))))
    order = rng.permutation(len(cases))
    held = {int(i) for i in order[: len(cases) // 5]} if len(cases) >= 10 else set()
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    learn = [i for i in range(len(cases)) if i not in held]
    for epoch in range(epochs):
        lr = np.float32(rate * (1 - epoch / epochs))
        for i in rng.permutation(learn):
            y, h = cases[i]
            x = emb[h].mean(0)
            z = x @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            step = lr * (out @ p)
            out -= lr * np.outer(x, p)
            bias -= lr * np.float32(0.1) * p
            np.subtract.at(emb, h, step / np.float32(len(h)))
    model = Model(langs, (emb @ out).astype(np.float64), bias.astype(np.float64), 1.0, 0.0)
    logits, truth = [], []
    for i in sorted(held):
        y, h = cases[i]
        logits.append(model.table[h].mean(0) + model.bias)
        truth.append(y)
    if logits:
        z, t = np.array(logits), np.array(truth)

        def loss(c: float) -> float:
            s = z / c
            s = s - s.max(1, keepdims=True)
            return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(t)), t]).mean())

        model.temperature = min((0.05 * 1.25**k for k in range(24)), key=loss)
        s = z / model.temperature
        s = np.exp(s - s.max(1, keepdims=True))
        best = np.sort((s / s.sum(1, keepdims=True)).max(1))
        model.threshold = float(min(MOST, best[int(FALSE_REJECTS * len(best))]))
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> list[tuple[str, str]]:
    """At most about rows_per_lang windows of each language, fewer if there are over ROWS / rows_per_lang, chosen by hash; no language is left out."""
    fold = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = fold.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return []
    most = max(1, min(rows_per_lang, ROWS // len(counts)))
    # rows are picked by hash, so a few more are asked for; a language's only rows are always taken
    shares = ((F.lit(r["lang"]), F.lit(min(1.0, max(most, 20) / r["count"]))) for r in counts)
    share = F.element_at(F.create_map(*(x for pair in shares for x in pair)), F.col("lang"))
    place = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1_000_000_007))
    start = F.lit(1) + F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - WINDOW)).cast("int")
    picked = fold.where(place < share * 1_000_000_007).select("lang", F.substring("text", start, F.lit(WINDOW)).alias("w"))
    return [(r["lang"], r["w"]) for r in picked.limit(2 * max(most, 20) * len(counts)).toLocalIterator()]


def train(docs: DataFrame) -> Model | None:
    return fit(sample(docs))


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """keep (default doc_id), lang_pred string, score double, rejected boolean (names after prefix) for every row of docs."""
    ship(docs.sparkSession)
    keep = keep or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"k{i}" for i in range(len(keep))]
    source = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), F.col("text").alias("body"))

    def judge(text: str | None) -> tuple[str, float, bool]:
        m = shared.value
        if m is None or not text or not has_letter(text):
            return "und", 0.0, True
        p = m.probabilities(text)
        k = int(p.argmax())
        return m.langs[k], float(min(1.0, p[k])), bool(p[k] < m.threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [judge(x.as_py()) for x in b.column("body")]
            cols = [b.column(n) for n in names]
            cols += [pa.array([g[k] for g in got], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(cols, [*names, "lang_pred", "score", "rejected"])

    types = dict(source.dtypes)
    schema = ", ".join(f"{n} {types[n]}" for n in names) + ", lang_pred string, score double, rejected boolean"
    done = source.mapInArrow(run, schema)
    found = (F.col(c).alias(prefix + c) for c in ("lang_pred", "score", "rejected"))
    return done.select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)), *found)


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs without those the model rejects; all columns stay."""
    own = unused(docs)
    judged = predict(docs, model, docs.columns, own)
    return judged.where(~F.col(f"{own}rejected")).select(*docs.columns)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    done = predict(docs, train(docs))
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
