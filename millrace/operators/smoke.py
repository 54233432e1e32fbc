"""Smoke report over raw frames: can they be decoded and keyed, are they complete, and as declared?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules


def _blank(path: str) -> Column:
    """Is the text at a path of the variant v missing, blank or no text?"""
    return ~F.coalesce(rules.present(F.try_variant_get("v", path, "string")), F.lit(False))


def report(frames: DataFrame, key: str, required: dict[str, str], declared: list[str]) -> DataFrame:
    """check, level (ok, warn, bad), found: rows for decodable, keyable, complete and contract, from one pass over raw_payload.

    key is the JSON path of the partition key, required has a name and JSON path of each field. found counts: frames that are no JSON object (a warning: some
    are expected, and go to quarantine); frames without a key; required fields missing; frames with a name that isn't declared, and declared names that no frame has.
    No frames at all: decodable warns, the rest is ok."""
    parsed = frames.select(F.try_parse_json("raw_payload").alias("v"), F.json_object_keys("raw_payload").alias("names"))
    fine = F.col("v").isNotNull() & F.col("names").isNotNull()
    said = F.array(*(F.lit(d) for d in declared)).cast("array<string>")
    one = parsed.agg(
        F.count_if(fine).alias("n"), F.count_if(~fine).alias("undecodable"), F.count_if(fine & _blank(key)).alias("unkeyable"),
        F.count_if(fine & (F.size(F.array_except("names", said)) > 0)).alias("undeclared"),
        *(F.count_if(fine & _blank(path)).alias(f"m{k}") for k, path in enumerate(required.values())),
        *(F.coalesce(F.bool_or(fine & F.array_contains("names", d)), F.lit(False)).alias(f"d{k}") for k, d in enumerate(declared)),
    )
    unseen = sum((F.when(F.col("n") > 0, (~F.col(f"d{k}")).cast("long")).otherwise(0) for k in range(len(declared))), F.lit(0))
    missing = sum((F.col(f"m{k}") for k in range(len(required))), F.lit(0))

    def line(check: str, found: Column, level: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), level.alias("level"), found.cast("long").alias("found"))

    def bad(found: Column) -> Column:
        return F.when(found > 0, "bad").otherwise("ok")

    decodable = F.when((F.col("undecodable") > 0) | (F.col("n") == 0), "warn").otherwise("ok")
    drift = F.col("undeclared") + unseen
    lines = [line("decodable", F.col("undecodable"), decodable)]
    lines += [line(c, x, bad(x)) for c, x in (("keyable", F.col("unkeyable")), ("complete", missing), ("contract", drift))]
    return one.select(F.inline(F.array(*lines)))
