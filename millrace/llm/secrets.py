"""Secret scan: fixed patterns, and strings that stay incompressible beside their surroundings.

For each candidate (a long token with a sensitive word shortly before or after it) two raw dictionaries prime a zstandard compressor:
the text around it, without it, with the identifiers there, and the identifiers of the whole text outside candidates. The candidate's
marginal cost is what it adds in compressed bytes under the dictionary that explains it better. A candidate that costs most of its own
length is news to its surroundings, as keys are; identifiers, paths and repeated names cost little.

Defined results: a null text counts as empty; offsets are code points of the whole text; several
kinds may report the same place; repeated rows are judged each by itself; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

# The base kinds in their order.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Words that make a place sensitive.
SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase)?|secret|token|api_?key|private|credential|auth|bearer|access_?key|signature|cookie|session",
    re.ASCII | re.IGNORECASE,
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
IDENTIFIER = re.compile(r"[A-Za-z_]{3,}")
#: A candidate's sensitive word ends at most so many characters before it, or begins so many after it; so many characters on each side prime the compressor; and it is reported from this share of its length on.
REACH, AROUND, NOVELTY = 48, 2048, 0.65


class Primed:
    """Marginal compressed bytes under one raw dictionary; the frame's own bytes are taken off by compressing nothing the same way."""

    def __init__(self, primer: str) -> None:
        raw = primer.encode("utf-8", "replace")
        params = zstandard.ZstdCompressionParameters.from_level(9, write_content_size=False, write_checksum=False, write_dict_id=False)
        own = {}
        if len(raw) >= 8:
            own["dict_data"] = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(compression_params=params, **own)
        self.empty = len(self.compressor.compress(b""))

    def __call__(self, data: bytes) -> int:
        return max(0, len(self.compressor.compress(data)) - self.empty)


def identifiers(text: str, without: list[tuple[int, int]] = ()) -> Primed:
    """A dictionary of the text's identifiers outside the given spans; built once for a text, whatever its number of candidates."""
    names: set[str] = set()
    at = 0
    for a, b in [*without, (len(text), len(text))]:
        names.update(IDENTIFIER.findall(text, at, a))
        at = max(at, b)
    return Primed(" ".join(sorted(names)))


def novelty(text: str, start: int, end: int, names: Primed | None = None) -> float:
    """Marginal compressed bytes of text[start:end] over its bytes, primed with what surrounds it or with the text's identifiers."""
    around = text[max(0, start - AROUND) : start] + " " + text[end : end + AROUND]
    near = Primed(" ".join(sorted(set(IDENTIFIER.findall(around)))) + "\n" + around)
    data = text[start:end].encode("utf-8", "replace")
    names = names or identifiers(text, [(start, end)])
    return min(1.0, min(near(data), names(data)) / max(1, len(data)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end), sorted."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _before(text: str, known: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Candidates, apart from known ones, that a sensitive word follows; one with such a word in it is searched behind that word only."""
    words = [s.start() for s in SENSITIVE.finditer(text)]
    taken = [b for _, b in known]
    found = []
    for m in CANDIDATE.finditer(text) if words else ():
        a, b = m.span()
        k = bisect_left(words, a)
        if k == len(words) or not b <= words[k] <= b + REACH:
            continue
        j = bisect_right(taken, a)
        if (j == len(known) or known[j][0] >= b) and any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]):
            found.append((a, b))
    return found


def novel_spans(text: str) -> list[tuple[int, int, int, float]]:
    """(start, kind's number, end, novelty) of sensitive candidates that their surroundings don't explain."""
    spans = []
    last = -1
    for s in SENSITIVE.finditer(text):
        for m in CANDIDATE.finditer(text, max(s.end(), last), s.end() + REACH + 512):
            if m.start() - s.end() > REACH:
                break
            end = m.end()
            if end == s.end() + REACH + 512:  # a candidate that the search window cut
                end = CANDIDATE.match(text, m.start()).end()
            last = max(last, end)
            value = text[m.start() : end]
            if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
                spans.append((m.start(), end))
    spans = sorted(spans + _before(text, spans))
    if not spans:
        return []
    names = identifiers(text, spans)
    shares = ((a, b, novelty(text, a, b, names)) for a, b in spans)
    return [(a, 3, b, share) for a, b, share in shares if share >= NOVELTY]


def scan(text: str | None) -> dict:
    text = text or ""
    base, extra = base_spans(text), novel_spans(text)
    write = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
    counts = [sum(k == i for _, k, _ in base) for i in range(3)]
    return {
        "n_assign": counts[0],
        "n_access": counts[1],
        "n_hex": counts[2],
        "base_sha256": hashlib.sha256(write(base).encode()).hexdigest(),
        "spans": write(sorted(base + [x[:3] for x in extra])),
        "n_novel": len(extra),
        "max_novelty": max((x[3] for x in extra), default=0.0),
    }


FIELDS = {
    "n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "base_sha256": pa.string(),
    "spans": pa.string(), "n_novel": pa.int64(), "max_novelty": pa.float64(),
}


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id and FIELDS for every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [scan(x.as_py()) for x in b.column("text")]
            cols = [pa.array([g[k] for g in got], t) for k, t in FIELDS.items()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], ["doc_id", *FIELDS])

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    schema = f"doc_id {dict(source.dtypes)['doc_id']}, " + ", ".join(f"{k} {kinds[t]}" for k, t in FIELDS.items())
    return source.mapInArrow(run, schema)


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    return secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def secret_counts(spark, sf_dir: str) -> DataFrame:
    """What of op4 SQL can say: how many matches each base kind has."""
    return op4_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


COUNTS_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id,
    regexp_extract_all(t, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) AS a,
    regexp_extract_all(t, 'AKIA[A-Z0-9]+') AS k, regexp_extract_all(t, '[0-9a-f]+') AS h FROM t
)
SELECT doc_id, CAST(len(list_filter(a, lambda x: length(x) >= 6)) AS BIGINT) AS n_assign,
  CAST(len(list_filter(k, lambda x: length(x) >= 20)) AS BIGINT) AS n_access, CAST(len(list_filter(h, lambda x: length(x) >= 24)) AS BIGINT) AS n_hex FROM m
"""
