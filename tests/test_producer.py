"""The producer loop, its sources and sink, topics, and tables maintained apart."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import checks
from millrace.sources import log, producer, sse
from millrace.sources.store import Table, maintain_all
from millrace.streaming import jobs


def frame(i):
    return json.dumps({"meta": {"id": f"i{i}", "domain": f"d{i % 3}"}, "time_us": i})


def test_socket_frames_resume_at_the_cursor():
    urls = []

    def connect(url):
        urls.append(url)
        begin = int(url.rsplit("=", 1)[1]) if "cursor" in url else 1
        for i in range(begin, begin + 3):
            yield frame(i)
        raise ConnectionError

    source = producer.build_source("websocket", "wss://h/s?a=1", connect=connect, sleep=lambda _: None, attempts=3)
    got = [json.loads(raw)["time_us"] for raw, _, _ in source]
    assert got == [1, 2, 3, 4, 5, 6, 7] and urls[1:] == ["wss://h/s?a=1&cursor=3", "wss://h/s?a=1&cursor=5"]
    with pytest.raises(ValueError):
        producer.build_source("other", "x")


def test_sse_frames_resume_and_give_up():
    calls = []

    def lines(url, last):
        calls.append(last)
        if len(calls) == 3:
            raise sse.Refused("status 404")
        yield from (f"id: {len(calls)}\n", f"data: {frame(len(calls))}\n", "\n")

    source = producer.build_source("sse", "http://h", open=lines, sleep=lambda _: None)
    got = []
    with pytest.raises(sse.Refused):
        for f in source:
            got.append(f)
    assert [c for _, c, _ in got] == ["1", "2"] and calls == [None, "1", "2"]


def test_loop_limits_rates_and_counts(spark, tmp_path):
    sink = producer.LogSink(spark, str(tmp_path), "t", batch=4)
    now = iter(range(1000))
    rates, beats = [], []
    frames = [(frame(i), None, True) for i in range(20)] + [("no json", None, False)]
    assert producer.run(frames, sink, max_events=10, interval=3, report=rates.append, beat=beats.append, clock=lambda: next(now)) == 10
    assert [r["per_second"] for r in rates] == [1, 1, 1] and beats[-1] == 10
    assert sink.close() == {"sent": 10, "unkeyed": 0, "failed": 0, "in_flight": 0}
    assert producer.run(frames[10:], sink) == 11 and sink.close()["unkeyed"] == 1
    assert log.read(spark, str(tmp_path), "t").count() == 21
    assert producer.run(frames, producer.LogSink(spark, str(tmp_path), "u"), duration=5, clock=lambda n=iter(range(99)): next(n)) == 5
    assert producer.run(frames, sink, max_events=0) == 0


def test_topics_only_grow(spark, tmp_path):
    at = str(tmp_path)
    assert log.partitions(spark, at, "t") == 3
    assert [log.create(spark, at, "t", n) for n in (4, 2, 6)] == [4, 4, 6] and log.partitions(spark, at, "t") == 6
    with pytest.raises(ValueError):
        log.create(spark, at, "u", 0)


def test_tables_are_maintained_apart(spark, tmp_path):
    def table(name):
        t = Table.create(spark, str(tmp_path / name), "id string, d date", "d")
        for i in range(3):
            t.append(spark.createDataFrame([(f"{name}{i}", dt.date(2024, 1, 1 + i))], "id string, d date"))
        return t

    good, bad = table("good"), table("bad")
    for r in bad.files().collect():
        bad.fs.delete(r["file_path"])
    got = {r["table_name"]: r for r in maintain_all(spark, {"bad": bad, "good": good}, dt.datetime(2100, 1, 1), retain_last=1, orphan_hours=0).collect()}
    assert got["good"]["ok"] and got["good"]["files_before"] == 3 and got["good"]["files_after"] == 1 and not got["bad"]["ok"] and got["bad"]["error"]


def test_ranges_prune_files(spark, tmp_path):
    t = Table.create(spark, str(tmp_path / "t"), "id string, at timestamp", "at")
    utc = dt.timezone.utc
    for day in (1, 2, 3):
        t.append(spark.createDataFrame([(f"r{day}", dt.datetime(2024, 1, day, 12, tzinfo=utc))], "id string, at timestamp"))
    t.append(spark.createDataFrame([("none", None)], "id string, at timestamp"))
    low, high = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 23)
    assert len(t.met(low, high)) == 1 and [r["id"] for r in t.scan(low, high).collect()] == ["r2"]
    assert sorted(r["id"] for r in t.scan(low).collect()) == ["r2", "r3"] and t.scan().count() == 4
    assert t.stats()["partitions"] == 4
    before = {r["file_path"] for r in t.files().collect()}
    t.upsert(spark.createDataFrame([("r2", None), ("new", None)], "id string, at timestamp"), ("id",))
    assert len(before - {r["file_path"] for r in t.files().collect()}) == 1 and t.read().count() == 5
    t.rename_column("at", "time")
    assert len(t.met(low, high)) == 0 or t.scan(low, high).count() == 0


def test_levels_of_freshness(spark):
    now = dt.datetime(2024, 1, 1, 12)
    for minutes, level in ((1, "pass"), (20, "warn"), (90, "error")):
        df = spark.createDataFrame([(now - dt.timedelta(minutes=minutes),)], "ingested_at timestamp")
        assert checks.freshness_level(df, now).first()["level"] == level
    assert checks.freshness_level(df.limit(0), now).first()["level"] == "error"


def test_health_and_continuous_trigger(spark, tmp_path):
    from tests.test_rules_and_frames import frame as wire_frame

    path = str(tmp_path / "beat")
    assert not jobs.healthy(path)
    jobs.Heartbeat(path).beat(1)
    assert jobs.healthy(path) and not jobs.healthy(path, now=2e12)
    root = str(tmp_path)
    log.append(log.keyed(spark.createDataFrame([(wire_frame(),)], "raw string")), f"{root}/log", "t")
    q = jobs.start_bronze(log.read_stream(spark, f"{root}/log", "t"), root, f"{root}/c")
    try:
        q.processAllAvailable()
        assert jobs.progress(q)["batch_id"] >= 0 and jobs.tables(spark, root)["bronze"].count() == 1
    finally:
        q.stop()


def test_frames_without_ids_move_the_offset(monkeypatch):
    monkeypatch.setattr(sse, "open_lines", lambda url, last, timeout=30: iter(["data: {}\n", "\n", "data: {}\n", "\n"]))
    r = sse._Reader({"url": "http://h"})
    start = r.initialOffset()
    rows, end = r.read(start)
    assert len(list(rows)) == 2 and end != start and len(list(r.readBetweenOffsets(start, end))) == 2
    again = sse._Reader({"url": "http://h"})
    assert len(list(again.readBetweenOffsets(start, end))) == 2


@pytest.mark.parametrize("sql", ["SELECT 1 -- a; b", "SELECT /* ; */ 1", "SELECT ';' ;"])
def test_semicolons_that_end_nothing(spark, sql):
    from millrace.operators import analysis

    assert analysis.one_statement(spark, sql).count() == 1


def test_listing(spark):
    from millrace.operators import analysis

    spark.sql("CREATE TABLE IF NOT EXISTS millrace_listed (a INT, b STRING) USING parquet")
    try:
        assert analysis.table_listing(spark).where(F.col("table_name") == "millrace_listed").first()["columns"] == 2
    finally:
        spark.sql("DROP TABLE millrace_listed")


