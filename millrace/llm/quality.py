"""Quality rules as a bitmask ledger.

ledger() evaluates every rule once per text and stores measurements and a mask of failure bits;
apply_policy() applies a versioned policy to the stored bits; ablate() tells what each rule of a policy
does, from one bitwise aggregation. All of it is DataFrame functions; nothing is shuffled but the
counts by mask, of which there are at most 2**len(RULES).

Defined results: a null text counts as without words (all measurements 0, bit 0 set); an empty text
likewise; repeated rows are judged each by itself; extra columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, once

NO_WORD = r"[\x20\x09-\x0D]+"
NO_SYMBOL = r"[^#*$%&|<>]+"
NO_UPPER = "[^A-Z]+"

#: Rule name to the condition, over the measurements, under which a text fails it. Bit k is rule k.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "capitals": "10 * n_upper > 4 * word_chars",
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")


@dataclass(frozen=True)
class Policy:
    """A text is rejected if it fails any rule of the mask."""

    name: str
    version: int
    mask: int


POLICIES = {
    "base": Policy("base", 1, BASE),
    "standard": Policy("standard", 1, sum(BIT.values())),
}


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes: two different windows of one
    text of a million words meet by chance once in 10**7 such texts. Hashes are sorted as plain longs; where only a few windows
    repeat, their places are looked up, else (hash, place) is sorted.
    """

    def windows(h: Column) -> Column:
        return F.transform(
            F.slice(h, F.lit(1), F.size(h) - 2),
            lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)),
        )

    def covered(w: Column) -> Column:
        def size(again: Column) -> Column:
            places = F.flatten(F.transform(again, lambda i: F.array(i, i + 1, i + 2)))
            return F.size(F.array_distinct(places))

        def of_sorted(s: Column) -> Column:
            repeated = F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i - 1)))
            return let(repeated, few_or_many)

        def few_or_many(d: Column) -> Column:
            places = F.transform(w, lambda x, i: F.when(F.array_contains(d, x), i))
            few = size(F.filter(places, lambda i: i.isNotNull()))
            return F.when(F.size(d) == 0, F.lit(0)).when(F.size(d) <= 12, few).otherwise(let(pairs, by_pairs))

        def by_pairs(s: Column) -> Column:
            again = F.filter(
                s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])
            )
            return size(F.transform(again, lambda x: x["i"]))

        pairs = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(F.sort_array(w), of_sorted)

    hashes = F.transform(words, lambda x: F.xxhash64(x))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(hashes, lambda h: let(windows(h), covered)))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and MEASURES, all long."""
    t = F.coalesce(F.col("text"), F.lit(""))

    def only(but: str) -> Column:
        return F.length(F.regexp_replace(t, but, ""))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("again"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).alias("n"), F.length(F.array_join(words, "")).alias("chars"), _repeat_words(words).alias("again")
        )

    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    m = docs.select(
        "doc_id",
        once(
            F.struct(
                let(F.filter(F.split(t, NO_WORD), lambda x: x != ""), of_words).alias("w"),
                let(lines, of_lines).alias("l"),
                only(NO_SYMBOL).alias("n_symbols"),
                only(NO_UPPER).alias("n_upper"),
            )
        ),
    )
    found = {
        "n_words": F.col("w.n"),
        "word_chars": F.col("w.chars"),
        "n_symbols": F.col("n_symbols"),
        "n_lines": F.col("l.n"),
        "n_dup_lines": F.col("l.again"),
        "n_repeat_words": F.col("w.again"),
        "n_upper": F.col("n_upper"),
    }
    return m.select("doc_id", *(found[k].cast("long").alias(k) for k in MEASURES))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, MEASURES and fail_bits long: bit k is set if rule k of RULES fails."""
    bits = F.lit(0).cast("long")
    for name, fails in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs).withColumn("fail_bits", bits)


def apply_policy(book: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with kept boolean under the policy; no rule is evaluated again."""
    return book.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0)


def ablate(book: DataFrame, policy: Policy) -> DataFrame:
    """One row for each rule of the policy: rule, n_fails, n_only (rejected by it alone), n_kept_without.

    The ledger is first counted by its masked bits, so what is judged by rule is at most
    2**len(RULES) rows. An empty ledger gives counts of 0.
    """
    masked = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(
        F.count("*").alias("n")
    )
    rules = [(k, b) for k, b in BIT.items() if b & policy.mask]
    sums = []
    for k, b in rules:
        has = F.col("bits").bitwiseAND(F.lit(b).cast("long")) != 0
        rest = F.col("bits").bitwiseAND(F.lit(policy.mask & ~b).cast("long")) == 0
        sums += [
            F.sum(F.when(has, F.col("n")).otherwise(0)).alias(f"fails_{k}"),
            F.sum(F.when(has & rest, F.col("n")).otherwise(0)).alias(f"only_{k}"),
            F.sum(F.when(rest, F.col("n")).otherwise(0)).alias(f"kept_{k}"),
        ]
    rows = F.array(
        *(
            F.struct(
                F.lit(k).alias("rule"),
                F.coalesce(f"fails_{k}", F.lit(0)).alias("n_fails"),
                F.coalesce(f"only_{k}", F.lit(0)).alias("n_only"),
                F.coalesce(f"kept_{k}", F.lit(0)).alias("n_kept_without"),
            )
            for k, _ in rules
        )
    )
    return masked.agg(*sums).select(F.explode(rows).alias("r")).select("r.*")


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    book = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return apply_policy(book, POLICIES["standard"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(F.lit(BASE).cast("long")) != 0).alias("base_failed"), "kept", "fail_bits",
    )


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), g AS (
  SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)
), again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid
), l AS (
  SELECT rid, count(*) AS n, count(DISTINCT l) AS u
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(l.n, 0) AS n_lines, coalesce(l.n - l.u, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g')) AS n_upper
  FROM d JOIN w USING (rid) LEFT JOIN l USING (rid) LEFT JOIN covered USING (rid)
), b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
    + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (10 * n_dup_lines > 3 * n_lines)::BIGINT
    + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 15 * n_words)::BIGINT
    + 64 * (10 * n_upper > 4 * word_chars)::BIGINT AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits % 4 <> 0 AS base_failed,
  fail_bits = 0 AS kept, fail_bits FROM b
"""


def quality_ablation(spark, sf_dir: str) -> DataFrame:
    """What each rule of the standard policy does: rows it fails, rows it alone fails, rows kept without it."""
    return ablate(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), POLICIES["standard"])


def _ablation_sql() -> str:
    mask = POLICIES["standard"].mask
    each = [
        f"SELECT '{k}' AS rule, CAST(count_if(fail_bits & {b} <> 0) AS BIGINT) AS n_fails, CAST(count_if(fail_bits & {mask} = {b}) AS BIGINT) AS n_only, "
        f"CAST(count_if(fail_bits & {mask & ~b} = 0) AS BIGINT) AS n_kept_without FROM q"
        for k, b in BIT.items()
        if b & mask
    ]
    return f"WITH q AS ({OP1_SQL}) {' UNION ALL '.join(each)}"


ABLATION_SQL = _ablation_sql()
