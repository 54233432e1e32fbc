"""The event parser, backoff, log, snapshot tables and streaming jobs."""

import datetime as dt
import json
import os
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from millrace.operators import analysis, checks
from millrace.plans import scratch
from millrace.sources import log, sse
from millrace.sources.store import StoreError, Table
from millrace.streaming import jobs


def test_parse_lines():
    text = ":ok\n\nid: 1\ndata: a\ndata:  b\r\n\nevent: x\nretry: 50\nretry: no\nid: a\0b\ndata:c\n\nevent: empty\n\ndata: tail"
    got = list(sse.parse_lines(text.split("\n")))
    assert [(e.data, e.event, e.id, e.retry) for e in got] == [("a\n b", "message", "1", None), ("c", "x", "1", 50), ("tail", "message", "1", None)]
    assert [sse.frame(e)[2] for e in got] == [False] * 3 and sse.frame(sse.Event('{"a": 1}', id="7")) == ('{"a": 1}', "7", True)


def test_backoff():
    b = sse.Backoff(1, 8, random.Random(1))
    delays = [b.next_delay() for _ in range(50)]
    assert all(full / 2 <= d <= full for d, full in zip(delays, [1, 2, 4] + [8] * 47, strict=True))
    b.reset()
    assert b.next_delay() <= 1
    with pytest.raises(ValueError):
        sse.Backoff(0, 1)


def test_resume_url():
    assert sse.resume_url("wss://h/p?a=1&cursor=2", 9) == "wss://h/p?a=1&cursor=9"
    assert sse.resume_url("wss://h/p?cursor=2", None) == "wss://h/p"


def test_log_offsets_go_on(spark, tmp_path):
    rows = [(json.dumps({"meta": {"domain": f"d{i % 5}"}}),) for i in range(40)] + [("no json",)]
    records = log.keyed(spark.createDataFrame(rows, "raw string"))
    for _ in range(2):
        log.append(records, str(tmp_path), "t")
    got = log.read(spark, str(tmp_path), "t")
    assert got.count() == 82
    gaps = checks.offset_contiguity(got.select(F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset")))
    assert gaps.where("missing != 0 OR min_offset != 0").count() == 0
    assert got.where("key is not null").groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").count() == 0


def table(spark, tmp_path):
    t = Table.create(spark, str(tmp_path / "t"), "id string, v int, d date", "d", ("v",))
    t.append(spark.createDataFrame([("a", 1, dt.date(2024, 1, 1)), ("b", 2, dt.date(2024, 1, 2))], "id string, v int, d date"))
    return t


def test_store_evolution_and_travel(spark, tmp_path):
    t = table(spark, tmp_path)
    files = {r["file_path"] for r in t.files().collect()}
    t.add_column("w", "int")
    t.rename_column("v", "size")
    t.widen_column("size", "bigint")
    with pytest.raises(StoreError, match="NOT_SUPPORTED"):
        t.widen_column("size", "int")
    assert {r["file_path"] for r in t.files().collect()} == files
    t.append(spark.createDataFrame([("c", 2**40, 5)], "id string, size long, w int"))
    assert sorted((r["id"], r["size"], r["w"]) for r in t.read().collect()) == [("a", 1, None), ("b", 2, None), ("c", 2**40, 5)]
    t.drop_column("w")
    assert t.read().columns == ["id", "size", "d"] and t.read(version=2).columns == ["id", "v", "d"]
    with pytest.raises(StoreError):
        t.read(as_of=dt.datetime(2001, 1, 1))
    with pytest.raises(StoreError):
        t.append(spark.createDataFrame([(1,)], "nope int"))
    t.rollback(2)
    assert t.read().count() == 2 and t.read().columns == ["id", "v", "d"]


def test_store_batches_conflicts_and_maintenance(spark, tmp_path):
    t = table(spark, tmp_path)
    more = spark.createDataFrame([("c", 3, None)], "id string, v int, d date")
    assert t.append(more, ("q", 0)) and not t.append(more, ("q", 0)) and t.count() == 3
    m = t.manifest()
    t._commit(t._next(m), "first", m)
    with pytest.raises(StoreError, match="another writer"):
        t._commit(t._next(m), "second", m)
    t.delete_where(F.col("id") == "a")
    assert sorted(r["id"] for r in t.read().collect()) == ["b", "c"]
    done = t.maintain(dt.datetime(2100, 1, 1), retain_last=1, orphan_hours=0)
    assert done["rows"] == 2 and t.stats()["snapshots"] == 1 and t.stats()["files"] == 1
    assert t.orphans(0).count() == 0 and t.snapshots().first()["total_records"] == 2


def test_crash_replay_adds_nothing(spark, tmp_path):
    from tests.test_rules_and_frames import frame

    root = str(tmp_path)
    rows = [(frame(meta={"id": f"i{k % 7}"}),) for k in range(10)] + [("bad",)]
    log.append(log.keyed(spark.createDataFrame(rows, "raw string")), f"{root}/log", "t")

    def drain():
        stream = lambda: log.read_stream(spark, f"{root}/log", "t")
        jobs.start_bronze(stream(), root, f"{root}/c", once=True).awaitTermination()
        q = jobs.start_silver(stream(), root, f"{root}/c", once=True)
        q.awaitTermination()
        return q

    jobs.progress(drain())
    tables = jobs.tables(spark, root)
    counts = [tables[k].read().count() for k in ("bronze", "edits", "quarantine")]
    assert counts == [11, 7, 1]
    for name in (jobs.BRONZE, jobs.SILVER):  # as if the crash came before the last commit was noted
        commits = f"{root}/c/{name}/commits"
        for f in os.listdir(commits):
            os.remove(f"{commits}/{f}")
    drain()
    assert [tables[k].read().count() for k in ("bronze", "edits", "quarantine")] == counts
    assert jobs.rebuild(spark, root)["new_edits"] == 0
    with pytest.raises(ValueError):
        jobs.rebuild(spark, root, "2024-02-01", "2024-01-01")


@pytest.mark.parametrize(("how", "kept"), [("none", 3), ("watermark_only", 3), ("within_watermark", 2), ("watermark", 2)])
def test_watermarks_drop_late_rows(spark, tmp_path, how, kept):
    times = ["04:00", "03:55", "03:30"]
    for i, t in enumerate(times):  # one run for each row: late rows meet the watermark of the runs before
        folder = f"{tmp_path}/in"
        spark.createDataFrame([(f"e{i}", f"2024-01-01 {t}:00")], "event_id string, t string").select("event_id", F.col("t").cast("timestamp").alias("event_time")).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("event_id string, event_time timestamp").parquet(folder)
        q = jobs.drop_late(stream, how).writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(path=f"{tmp_path}/out", format="parquet")
        q.awaitTermination()
    assert spark.read.schema("event_id string").parquet(f"{tmp_path}/out").count() == kept


def test_heartbeat(tmp_path):
    path = str(tmp_path / "beat")
    assert jobs.age_seconds(path) is None
    jobs.Heartbeat(path).beat(3)
    assert 0 <= jobs.age_seconds(path) < 60


def test_partition_skew_against_zlib(spark):
    import zlib
    from collections import Counter

    keys = [f"d{i * i % 17}" for i in range(300)]
    got = {r["n"]: r for r in analysis.partition_skew(spark.createDataFrame([(k,) for k in keys], "k string"), "k").collect()}
    for n in (1, 3, 6, 12, 24):
        c = Counter(zlib.crc32(k.encode()) % n for k in keys)
        assert got[n]["busiest_share"] == round(max(c.values()) / 300, 4) and got[n]["idle"] == n - len(c)


def test_checks_are_seen_failing(spark):
    now = dt.datetime(2024, 1, 2, 3, 30)
    bronze = spark.createDataFrame([(0, 0), (0, 2)], "kafka_partition int, kafka_offset long")
    edits = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 2, 2, 10), "x", dt.datetime(2024, 1, 2, 3, 0))] * 2, "event_id string, event_time timestamp, domain string, ingested_at timestamp"
    )
    bad = spark.createDataFrame([("odd", now, 0, 1)], "failure_reason string, failed_at timestamp, kafka_partition int, kafka_offset long")
    got = {r.name: r.passed for r in checks.run_checks(bronze, edits, bad, {"m": edits.limit(0)}, now)}
    assert got and not any(got.values())
    gate = {r.name: r.passed for r in checks.no_duplicates_gate(edits, bad)}
    assert not gate["duplicate_event_ids"] and gate["null_event_ids"] and gate["not_empty"]


def test_one_statement(spark):
    assert analysis.one_statement(spark, "SELECT ';' AS a;").first()["a"] == ";"
    for bad in ("SELECT 1; SELECT 2", " "):
        with pytest.raises(ValueError):
            analysis.one_statement(spark, bad)


def test_drift(spark):
    assert {tuple(r) for r in analysis.drift(spark, ["a", "b"], ["b", "c"]).collect()} == {("a", "declared"), ("c", "observed")}


def test_a_cluster_needs_a_shared_folder():
    def session(master, **conf):
        context = SimpleNamespace(master=master, getConf=lambda: conf)
        return SimpleNamespace(sparkContext=context)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            scratch.folder(session(master))
        assert scratch.folder(session(master, **{"spark.checkpoint.dir": "/shared"})).startswith("/shared/scratch-")
    assert scratch.folder(session("local[8]")) != scratch.folder(session("local"))
