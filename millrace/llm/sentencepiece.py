"""Unigram encoding and decoding with the pieces of a SentencePiece model file.

encode() finds the segmentation with the greatest sum of log scores (Viterbi) over a double-array
trie of the pieces, with byte pieces for characters that no piece has; decode() undoes it. No piece has
the whitespace marker after its first other character, so the best path of a text is the best paths of its words
(a run of markers and what follows it) one after the other, and words met before are looked up.

The scores of a unigram model are log probabilities and are taken as they are; those of a model whose file says that
it was trained as BPE are ranks, and become log probabilities by Zipf's law, log p = -log((rank + 1) * H). scores="file" or "zipf" says otherwise.

Defined results: a null text gives null ids and a null decoded text; an empty one no ids. Of segmentations
with equal scores the one whose last differing piece is longer wins. decode(encode(text)) is the text, but
that a literal U+2581 comes back as a space and lone surrogates can't occur. Repeated rows are
encoded each by itself; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Log score of a byte piece below the lowest piece's.
BYTE_STEP = 10.0
#: Words in each of the two generations that a worker remembers.
REMEMBERED = 250_000
_WORD = re.compile(f"{MARK}+[^{MARK}]*")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def _fields(raw: bytes) -> Iterator[tuple[int, bytes | int | float]]:
    """Fields of a protocol-buffer message."""
    at, n = 0, len(raw)

    def varint() -> int:
        nonlocal at
        x = shift = 0
        while True:
            b = raw[at]
            at += 1
            x |= (b & 127) << shift
            if b < 128:
                return x
            shift += 7

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 5:
            yield key >> 3, struct.unpack_from("<f", raw, at)[0]
            at += 4
        elif kind == 1:
            yield key >> 3, struct.unpack_from("<d", raw, at)[0]
            at += 8
        elif kind == 2:
            size = varint()
            yield key >> 3, raw[at : at + size]
            at += size
        else:
            raise ValueError(f"field kind {kind}")


def read_pieces(raw: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, kind) of a model file's bytes, by id."""
    out = []
    for key, value in _fields(raw):
        if key == 1:
            f = dict(_fields(value))
            out.append((f.get(1, b"").decode(), float(f.get(2, 0.0)), int(f.get(3, NORMAL))))
    return out


def model_type(raw: bytes) -> int:
    """1 unigram (also where the file doesn't say), 2 BPE, 3 words, 4 characters."""
    trainer = next((v for k, v in _fields(raw) if k == 2), b"")
    return next((v for k, v in _fields(trainer) if k == 3), 1)


class DoubleArray:
    """Trie over UTF-8 bytes: state s goes by byte c to base[s] + c + 1 if check there is s; value at byte code 0."""

    def __init__(self, keys: dict[bytes, int]) -> None:
        items = sorted(keys.items())
        size = 1 << 16
        self.base, self.check = array("i", [0]) * size, array("i", [-1]) * size
        self.check[0] = -2
        free = 1
        stack = [(0, 0, len(items), 0)]
        while stack:
            state, lo, hi, depth = stack.pop()
            kids: list[tuple[int, int, int]] = []
            i = lo
            while i < hi:
                key = items[i][0]
                code = key[depth] + 1 if depth < len(key) else 0
                j = i + 1
                while j < hi and len(items[j][0]) > depth and items[j][0][depth] + 1 == code and code:
                    j += 1
                kids.append((code, i, j))
                i = j
            codes = [k[0] for k in kids]
            b = max(1, free - codes[0])
            while True:
                if b + 257 >= len(self.check):
                    grow = len(self.check)
                    self.base.extend([0] * grow)
                    self.check.extend([-1] * grow)
                if all(self.check[b + c] == -1 for c in codes):
                    break
                b += 1
            self.base[state] = b
            for c, _, _ in kids:
                self.check[b + c] = state
            while self.check[free] != -1:
                free += 1
            for c, i, j in kids:
                if c == 0:
                    self.base[b] = -1 - items[i][1]
                else:
                    stack.append((b + c, i, j, depth + 1))
        # for the walk: plain lists, padded so that no step leaves them; value[s] is the id of a key that ends at s, or -1
        pad = [0] * 257
        self.base, self.check = [*self.base, *pad], [*self.check, *(-1 for _ in pad)]
        self.value = [-1] * len(self.base)
        for t, s in enumerate(self.check):
            if s >= 0 and self.base[s] == t and self.base[t] < 0:
                self.value[s] = -1 - self.base[t]


class Vocabulary:
    """Pieces, scores and the trie; a fixed size, set by the model file."""

    def __init__(self, pieces: list[tuple[str, float, int]], scores: str = "file") -> None:
        self.pieces = [p for p, _, _ in pieces]
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.control = {i for i, (_, _, k) in enumerate(pieces) if k == CONTROL}
        self.unknown = next((i for i, (_, _, k) in enumerate(pieces) if k == UNKNOWN), 0)
        normal = {i: s for i, (p, s, k) in enumerate(pieces) if k in (NORMAL, USER) and p}
        if any(MARK in self.pieces[i].lstrip(MARK) for i in normal):
            raise ValueError("a piece has the whitespace marker after another character")
        ranks = sorted(normal, key=lambda i: (-normal[i], i))
        if scores == "zipf":
            total = sum(1 / (r + 1) for r in range(len(ranks)))
            normal = {i: -log((r + 1) * total) for r, i in enumerate(ranks)}
        self.score = array("d", [normal.get(i, 0.0) for i in range(len(pieces))])
        self.byte_score = min(normal.values(), default=0.0) - BYTE_STEP
        self.trie = DoubleArray({self.pieces[i].encode(): i for i in reversed(ranks)})
        self.bytes_of = [
            bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.control else p.encode()
            for i, p in enumerate(self.pieces)
        ]
        # words met before, with their ids as bytes: half the size of tuples
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        self.memory.clear()
        self.older.clear()

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memory": {}, "older": {}}

    def viterbi(self, word: str) -> tuple[int, ...]:
        """Ids of the best path of one word, markers in place."""
        raw = word.encode("utf-8", "replace")
        n = len(raw)
        base, check, value, score = self.trie.base, self.trie.check, self.trie.value, self.score
        best = [0.0] + [-1e300] * n
        back_at, back_id = [0] * (n + 1), [-1] * (n + 1)
        i = 0
        while i < n:
            lead = raw[i]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            here = best[i]
            s, j, first = 0, i, i + width
            single = False
            while j < n:
                t = base[s] + raw[j] + 1
                if check[t] != s:
                    break
                s = t
                j += 1
                k = value[t]
                if k >= 0:
                    if j == first:
                        single = True
                    new = here + score[k]
                    if new > best[j]:
                        best[j] = new
                        back_at[j] = i
                        back_id[j] = k
            if not single:  # no piece for this character: its bytes, or the unknown piece
                new = here + self.byte_score * width
                if new > best[first]:
                    best[first] = new
                    back_at[first] = i
                    back_id[first] = -1
            i = first
        out: list[int] = []
        j = n
        while j:
            i, k = back_at[j], back_id[j]
            if k >= 0:
                out.append(k)
            elif self.byte_id:
                out += [self.byte_id[x] for x in reversed(raw[i:j])]
            else:
                out.append(self.unknown)
            j = i
        return tuple(reversed(out))

    def _word(self, word: str) -> bytes:
        """Ids of a word, without its first marker, by the older memory or Viterbi."""
        got = self.older.get(word)
        if got is None:
            got = array("i", self.viterbi(MARK + word)).tobytes()
        if len(word) <= 40:
            if len(self.memory) >= REMEMBERED:
                self.older, self.memory = self.memory, {}
            self.memory[word] = got
        return got

    def encode(self, text: str) -> array:
        if not text:
            return array("i")
        words = text.split(" ")
        if MARK in text or "" in words:  # runs of markers are one word with what follows
            text = MARK + text.replace(" ", MARK)
            words = [w[1:] for w in _WORD.findall(text)]
        got = list(map(self.memory.get, words))
        if None in got:
            got = [g if g is not None else self._word(w) for g, w in zip(got, words, strict=True)]
        out = array("i")
        out.frombytes(b"".join(got))
        return out

    def decode(self, ids: list[int] | array) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def load(spark, path: str = MODEL_FILE, scores: str = "auto") -> Vocabulary:
    """The vocabulary of a model file that the driver can open; scores "auto": as the file's model type asks."""
    with open(path, "rb") as f:
        raw = f.read()
    if scores == "auto":
        scores = "zipf" if model_type(raw) == BPE else "file"
    return Vocabulary(read_pieces(raw), scores)


def tokenize(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids array<int>, n_tokens long, ids_sha256 string (of little-endian 32-bit ids), round_trip boolean.

    round_trip: decoding the ids gives the text again (with U+2581 read as a space).
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids, count, digest, same = [], [], [], []
                for x in part.column("body"):
                    text = x.as_py()
                    if text is None:
                        for col in (ids, count, digest, same):
                            col.append(None)
                        continue
                    got = v.encode(text)
                    ids.append(memoryview(got))
                    count.append(len(got))
                    digest.append(hashlib.sha256(got.tobytes()).hexdigest())
                    same.append(v.decode(got) == text.replace(MARK, " "))
                flat = array("i")
                offsets = [0]
                for x in ids:
                    if x is not None:
                        flat.frombytes(x.tobytes())
                    offsets.append(len(flat))
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat.tobytes())]),
                    mask=pa.array([x is None for x in ids]),
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array(same, pa.bool_())],
                    ["doc_id", "ids", "n_tokens", "ids_sha256", "round_trip"],
                )
        v.forget()  # a worker that is used again would hold the words of all its tasks

    source = docs.select("doc_id", F.col("text").alias("body"))
    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(
        run, f"doc_id {kind}, ids array<int>, n_tokens long, ids_sha256 string, round_trip boolean"
    )


def detokenize(coded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and text decoded from ids; null ids give a null text."""
    ship(coded.sparkSession)
    shared = coded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if (i := x.as_py()) is None else shared.value.decode(i) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    source = coded.select("doc_id", "ids")
    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, text string")


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return tokenize(docs, load(spark))
