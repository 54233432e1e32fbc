"""Server-sent events: the line parser, reconnect backoff, and a Spark streaming source over them."""

from __future__ import annotations

import json
import random
import urllib.error
import urllib.request
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

#: HTTP statuses after which a retry can't help.
FATAL = frozenset({400, 401, 403, 404, 410})


@dataclass(frozen=True)
class Event:
    data: str
    event: str = "message"
    id: str | None = None
    retry: int | None = None


def parse_lines(lines: Iterable[str]) -> Iterator[Event]:
    """Events of a stream's lines.

    A blank line ends an event; data lines are joined by newlines; one space after the colon is dropped; lines that
    begin with a colon are comments; an id holds for later events too, unless it has a NUL; events without
    data aren't given; the last one is, even if no blank line follows.
    """
    data: list[str] = []
    kind, last_id, retry = "message", None, None
    for line in lines:
        line = line.rstrip("\n").removesuffix("\r")
        if not line:
            if data:
                yield Event("\n".join(data), kind, last_id, retry)
            data, kind, retry = [], "message", None
            continue
        field, colon, value = line.partition(":")
        if not field:
            continue
        value = value.removeprefix(" ") if colon else ""
        if field == "data":
            data.append(value)
        elif field == "event":
            kind = value or "message"
        elif field == "id" and "\0" not in value:
            last_id = value
        elif field == "retry" and value.isascii() and value.isdigit():
            retry = int(value)
    if data:
        yield Event("\n".join(data), kind, last_id, retry)


class Backoff:
    """Delays that double up to a cap: half of each fixed, half random. reset() once data has arrived."""

    def __init__(self, initial: float = 1.0, cap: float = 60.0, rng: random.Random | None = None) -> None:
        if initial <= 0 or cap < initial:
            raise ValueError("need 0 < initial <= cap")
        self.initial, self.cap, self.rng, self.failures = initial, cap, rng or random.Random(), 0

    def next_delay(self) -> float:
        full = min(self.cap, self.initial * 2 ** min(self.failures, 32))
        self.failures += 1
        return full / 2 + self.rng.uniform(0, full / 2)

    def reset(self) -> None:
        self.failures = 0


def frame(event: Event) -> tuple[str, str | None, bool]:
    """(text as it came, cursor, whether it is a JSON object)."""
    try:
        good = isinstance(json.loads(event.data), dict)
    except ValueError:
        good = False
    return event.data, event.id, good


def resume_url(url: str, cursor: int | None) -> str:
    """url with its cursor parameter set: for services that replay from a time in microseconds on, inclusive."""
    from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

    parts = urlsplit(url)
    query = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k != "cursor"]
    if cursor is not None:
        query.append(("cursor", str(cursor)))
    return urlunsplit(parts._replace(query=urlencode(query)))


class Refused(OSError):
    """The server's answer makes another try pointless."""


def open_lines(url: str, last_event_id: str | None, timeout: float = 30) -> Iterator[str]:
    headers = {"Accept": "text/event-stream"} | ({"Last-Event-ID": last_event_id} if last_event_id else {})
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            yield from (x.decode("utf-8", "replace") for x in r)
    except urllib.error.HTTPError as e:
        raise (Refused(f"status {e.code}") if e.code in FATAL else OSError(f"status {e.code}")) from e


class _Reader(SimpleDataSourceStreamReader):
    """Reads up to `maxEvents` frames a trigger. The offset is the last event's id, so a restart resumes after it, and the number of frames
    so far, so that frames without ids move it too."""

    def __init__(self, options: dict[str, str]) -> None:
        self.url, self.most = options["url"], int(options.get("maxEvents", "1000"))
        self.timeout = float(options.get("timeout", "30"))
        self.backoff = Backoff()

    def initialOffset(self) -> dict:
        return {"last_event_id": "", "frames": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        import time

        rows: list[tuple] = []
        at = start["last_event_id"]
        try:
            for e in parse_lines(open_lines(self.url, start["last_event_id"] or None, self.timeout)):
                self.backoff.reset()
                rows.append(frame(e))
                at = e.id or at
                if len(rows) >= self.most:
                    break
        except Refused:
            raise
        except OSError:
            time.sleep(self.backoff.next_delay())
        end = {"last_event_id": at, "frames": start.get("frames", 0) + len(rows)}
        self.given = (start, end, rows)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """The rows between two offsets: those just given, or, after a restart, read again from the first one."""
        if getattr(self, "given", None) and self.given[:2] == (start, end):
            return iter(self.given[2])
        rows = []
        for row in self.read(start)[0]:
            if len(rows) >= end.get("frames", 0) - start.get("frames", 0):
                break
            rows.append(row)
            if row[1] and row[1] == end["last_event_id"]:
                break
        return iter(rows)


class SseSource(DataSource):
    """spark.dataSource.register(SseSource); spark.readStream.format("millrace_sse").option("url", ...)."""

    @classmethod
    def name(cls) -> str:
        return "millrace_sse"

    def schema(self) -> str:
        return "raw string, cursor string, decodable boolean"

    def simpleStreamReader(self, schema) -> _Reader:
        return _Reader(dict(self.options))
