"""Scalar rules as Column expressions: derived fields and the ordered validation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Earliest event time that is believed, and seconds that an event may lie ahead of its ingestion.
FLOOR, AHEAD = "2001-01-15 00:00:00", 3600
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
TEMPORARY = r"^~[0-9]{4}-[0-9]+$"
#: A time must begin with a date; forms such as `now` or `04:00` depend on the clock and count as unparseable.
DATED = r"^\d{4}-\d{2}-\d{2}"


def present(x: Column) -> Column:
    """Not null and not blank (any white space)."""
    return x.isNotNull() & x.rlike(r"\S")


def event_time(raw: Column) -> Column:
    return F.when(raw.rlike(DATED), F.try_to_timestamp(raw))


def is_anonymous(editor: Column) -> Column:
    """Temporary accounts and bare addresses; the dots of an address are literal dots."""
    return (
        F.when(editor.isNull() | (editor == ""), F.lit(False))
        .when(editor.rlike(TEMPORARY) | editor.rlike(IPV4), F.lit(True))
        .otherwise(editor.contains(":"))
    )


def bytes_delta(old: Column, new: Column) -> Column:
    """new if the page is new, null if its size is unknown or the difference doesn't fit."""
    return F.when(new.isNull(), F.lit(None).cast("long")).when(old.isNull(), new).otherwise(F.try_subtract(new, old))


def event_key(did: Column, time_us: Column) -> Column:
    """`did:time_us`, null if either is missing."""
    return F.when(present(did) & time_us.isNotNull(), F.concat_ws(":", did, time_us.cast("string")))


def text_field(raw: Column, path: str) -> Column:
    """A string at a path of a JSON text; null if it is absent, empty or no string (a number's text is no id)."""
    found = F.try_variant_get(F.try_parse_json(raw), path, "variant")
    text = F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string"))
    return F.nullif(text, F.lit(""))


def missing(required: dict[str, Column]) -> Column:
    """Names of the required fields that are null, in order."""
    return F.array_compact(F.array(*(F.when(c.isNull(), F.lit(n)) for n, c in required.items())))


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)), digits)


@dataclass(frozen=True)
class Expectation:
    """A named rule: holds() over the candidate's columns; a candidate for which it isn't true fails it."""

    name: str
    holds: Callable[[], Column]


EXPECTATIONS = (
    Expectation("payload_not_json", lambda: ~F.col("_parse_failed")),
    Expectation("event_id_missing", lambda: present(F.col("event_id"))),
    Expectation("event_time_missing", lambda: present(F.col("raw_event_time"))),
    Expectation("event_time_unparseable", lambda: F.col("event_time").isNotNull()),
    Expectation("domain_missing", lambda: present(F.col("domain"))),
    Expectation("event_time_before_wikipedia", lambda: F.col("event_time") >= F.lit(FLOOR).cast("timestamp")),
    Expectation(
        "event_time_in_future",
        lambda: F.col("event_time") <= F.col("ingested_at") + F.expr(f"INTERVAL {AHEAD} SECONDS"),
    ),
)
REASONS = tuple(e.name for e in EXPECTATIONS)


def failure_reason(rules: tuple[Expectation, ...] = EXPECTATIONS) -> Column:
    """The first rule that doesn't hold, or null."""
    verdict = None
    for e in rules:
        fails = ~F.coalesce(e.holds(), F.lit(False))
        verdict = F.when(fails, F.lit(e.name)) if verdict is None else verdict.when(fails, F.lit(e.name))
    return verdict if verdict is not None else F.lit(None).cast("string")
