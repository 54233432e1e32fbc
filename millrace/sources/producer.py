"""The producer: a source of frames, a sink that counts deliveries, and the loop between them."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from . import log, sse

Frame = tuple[str, str | None, bool]


@dataclass
class SocketFrames:
    """Frames of a WebSocket that replays from a cursor on, inclusive: the frame at the cursor comes again and is skipped.

    connect(url) gives an iterable of text messages and may fail; frames carry their time in `time_us`. A broken connection is
    opened again after a backoff, from the last cursor.
    """

    url: str
    connect: Callable[[str], Iterable[str]] | None = None
    cursor: int | None = None
    backoff: sse.Backoff = field(default_factory=sse.Backoff)
    sleep: Callable[[float], None] = time.sleep
    attempts: int | None = None

    def __iter__(self) -> Iterator[Frame]:
        connect = self.connect or _websocket
        tries = 0
        while self.attempts is None or tries < self.attempts:
            tries += 1
            last = self.cursor
            try:
                for text in connect(sse.resume_url(self.url, self.cursor)):
                    self.backoff.reset()
                    raw, _, good = sse.frame(sse.Event(text))
                    at = json.loads(raw).get("time_us") if good else None
                    if isinstance(at, int):
                        if at == last:
                            continue
                        self.cursor = at
                    yield raw, None if self.cursor is None else str(self.cursor), good
            except OSError:
                pass
            self.sleep(self.backoff.next_delay())


def _websocket(url: str) -> Iterator[str]:
    try:
        from websockets.sync.client import connect
    except ImportError as e:
        raise RuntimeError("a WebSocket source needs the websockets package, or a connect function") from e
    with connect(url, ping_interval=20) as c:
        yield from (m if isinstance(m, str) else m.decode("utf-8", "replace") for m in c)


@dataclass
class SseFrames:
    """Frames of a server-sent event stream; open(url, last_event_id) gives its lines."""

    url: str
    open: Callable[[str, str | None], Iterable[str]] | None = None
    cursor: str | None = None
    backoff: sse.Backoff = field(default_factory=sse.Backoff)
    sleep: Callable[[float], None] = time.sleep
    attempts: int | None = None

    def __iter__(self) -> Iterator[Frame]:
        tries = 0
        while self.attempts is None or tries < self.attempts:
            tries += 1
            try:
                for e in sse.parse_lines((self.open or sse.open_lines)(self.url, self.cursor)):
                    self.backoff.reset()
                    self.cursor = e.id or self.cursor
                    yield sse.frame(e)
            except sse.Refused:
                raise
            except OSError:
                pass
            self.sleep(self.backoff.next_delay())


SOURCES = {"sse": SseFrames, "websocket": SocketFrames}


def build_source(kind: str, url: str, **options) -> Iterable[Frame]:
    if kind not in SOURCES:
        raise ValueError(f"no source {kind!r}; there are {', '.join(SOURCES)}")
    return SOURCES[kind](url, **options)


class LogSink:
    """Sends frames to the record log in batches. Counts: sent, unkeyed (frames without a domain), failed; frames that aren't sent yet are
    in flight, and a full batch is written before more are taken, so that a slow log holds the producer back."""

    def __init__(self, spark: SparkSession, at: str, topic: str, partitions: int | None = None, batch: int = 1000) -> None:
        self.spark, self.at, self.topic, self.batch = spark, at, topic, batch
        self.partitions = partitions or log.partitions(spark, at, topic)
        self.held: list[str] = []
        self.sent = self.unkeyed = self.failed = 0

    @property
    def in_flight(self) -> int:
        return len(self.held)

    def send(self, raw: str) -> None:
        self.held.append(raw)
        if len(self.held) >= self.batch:
            self.flush()

    def flush(self) -> None:
        rows, self.held = self.held, []
        if not rows:
            return
        records = log.keyed(self.spark.createDataFrame([(r,) for r in rows], "raw string"))
        unkeyed = records.where("key IS NULL").count()
        try:
            log.append(records, self.at, self.topic, self.partitions)
        except Exception:
            self.failed += len(rows)
            raise
        self.sent += len(rows)
        self.unkeyed += unkeyed

    def close(self) -> dict[str, int]:
        """Sends what is held; the counts."""
        self.flush()
        return {"sent": self.sent, "unkeyed": self.unkeyed, "failed": self.failed, "in_flight": self.in_flight}


def run(
    source: Iterable[Frame],
    sink: LogSink,
    max_events: int | None = None,
    duration: float | None = None,
    interval: float = 10.0,
    report: Callable[[dict], None] = lambda _: None,
    beat: Callable[[int], None] = lambda _: None,
    clock: Callable[[], float] = time.monotonic,
) -> int:
    """Frames taken, until the source ends, max_events are taken or duration seconds have passed.

    report gets the rate of each interval (not the mean since the start) and what is in flight; beat the frames so far.
    """
    began = mark = clock()
    n = since = 0
    try:
        if max_events is None or max_events > 0:
            for raw, _, _ in source:
                sink.send(raw)
                n += 1
                now = clock()
                if now - mark >= interval:
                    report({"events": n, "per_second": (n - since) / (now - mark), "in_flight": sink.in_flight})
                    beat(n)
                    mark, since = now, n
                if (max_events is not None and n >= max_events) or (duration is not None and now - began >= duration):
                    break
    finally:
        sink.close()
        beat(n)
    return n
