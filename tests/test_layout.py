"""Bucketed tables, observed metrics, and parts overwritten by value."""

import contextlib
import datetime as dt
import io
import os
import signal
import subprocess
import sys
import textwrap

from pyspark.sql import functions as F

from millrace.functions import wire
from millrace.sources import layout
from millrace.streaming import silver
from tests.test_rules_and_frames import NOW, frame


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def test_history_is_not_moved(spark, tmp_path):
    rows = spark.range(1000).selectExpr("'e' || id AS event_id", "id AS n")
    name = layout.bucketed(spark, str(tmp_path / "it's `odd`"), rows.schema, ("event_id",), 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert layout.insert_absent(name, rows.where("n < 600"), ("event_id",)) == {"new": 600}
        assert layout.insert_absent(name, rows.where("n >= 500"), ("event_id",), {"most": F.max("n")}) == {"most": 999, "new": 400}
        p = plan(layout.absent(name, rows, ("event_id",)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("\nArguments: hashpartitioning") == 1 and "Bucketed: true" in p  # the new rows' exchange alone
    assert "ReadSchema: struct<event_id:string>" in p and "SortMergeJoin" in p
    assert spark.table(name).count() == 1000 and spark.table(name).where("n < 600").count() == 600
    # a session that does not know the table finds it by its path
    again = spark.newSession()
    again.sql(f"DROP TABLE {name}")
    assert layout.bucketed(again, str(tmp_path / "it's `odd`"), rows.schema, ("event_id",), 8) == name and again.table(name).count() == 1000


def test_a_partitioned_bucketed_table(spark, tmp_path):
    rows = spark.range(40).selectExpr("'e' || id AS `a key`", "id % 3 AS day")
    name = layout.bucketed(spark, str(tmp_path / "t"), rows.schema, ("a key",), 4, "day")
    assert layout.insert_absent(name, rows, ("a key",)) == {"new": 40} and layout.insert_absent(name, rows, ("a key",)) == {"new": 0}
    assert sorted(x for x in os.listdir(tmp_path / "t") if "=" in x) == ["day=0", "day=1", "day=2"]


def test_batch_counts_are_observed_and_a_replay_adds_nothing(spark, tmp_path):
    good = [frame(meta={"id": f"x{i % 7}"}) for i in range(10)]
    rows = [(r, "t", 0, i, NOW, NOW) for i, r in enumerate([*good, "{no", frame(meta={"domain": None})])]
    frames = spark.createDataFrame(rows, wire.FRAME)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("merge", "merge")
    got = silver.merge_batch(frames, 5, str(tmp_path), 4)
    jobs = len(tracker.getJobIdsForGroup("merge"))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert got == {"batch_id": 5, "valid": 10, "rejected": 2, "new_edits": 7, "new_quarantine": 2}
    assert silver.merge_batch(frames, 5, str(tmp_path), 4) == got | {"new_edits": 0, "new_quarantine": 0}
    # the same merge, with what it observed counted by a pass of its own
    spark.sparkContext.setJobGroup("counted", "counted")
    from millrace.operators import medallion

    by = {r["rejected"]: r["n"] for r in medallion.split_counts(medallion.candidates(frames)).collect()}
    assert by == {False: got["valid"], True: got["rejected"]} and len(tracker.getJobIdsForGroup("counted")) >= 1
    spark.sparkContext.setJobGroup("rest", "rest")
    assert jobs > 0


def test_only_touched_parts_are_written(spark, tmp_path):
    def edit(day, page, hour):
        return (dt.date(2024, 1, day), page, dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour), False)

    rows = [edit(d, f"p{i}", 24 * d + i) for d in (1, 2, 3) for i in range(4)] + [edit(2, "late", 100)]
    edits = spark.createDataFrame(rows, "event_date date, page string, ingested_at timestamp, is_canary boolean")
    layout.write_parts(edits, str(tmp_path / "edits"), "event_date")
    kept = spark.read.parquet(str(tmp_path / "edits"))
    since, cutoff = dt.datetime(2024, 1, 1) + dt.timedelta(hours=99), dt.datetime(2024, 2, 1)
    touched = layout.touched_parts(kept, "event_date", since, cutoff)
    assert {(r["event_date"].day, r["page"]) for r in touched.collect()} == {(2, "p0"), (2, "p1"), (2, "p2"), (2, "p3"), (2, "late")}
    assert "dynamicpruning" in plan(touched)

    def build(of):
        layout.write_parts(of.groupBy("event_date").agg(F.count("*").alias("n")), str(tmp_path / "mart"), "event_date")

    def files():
        return {os.path.join(at, f) for at, _, names in os.walk(tmp_path / "mart") for f in names if f.startswith("part-")}

    build(kept.where(F.col("ingested_at") < F.lit(since)))
    before = files()
    build(touched)
    changed = {os.path.basename(os.path.dirname(f)) for f in before ^ files()}
    assert changed == {"event_date=2024-01-02"}
    assert {(r["event_date"].day, r["n"]) for r in spark.read.parquet(str(tmp_path / "mart")).collect()} == {(1, 4), (2, 5), (3, 4)}


def test_metrics_of_a_stream_are_observed(spark, tmp_path):
    rows = [(r.encode(), None, "t", 0, i, NOW) for i, r in enumerate([frame(meta={"id": "a"}), frame(meta={"id": "b"}), "{no"])]
    schema = "value binary, key binary, topic string, partition int, offset long, timestamp timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "log"))
    heard = silver.Observed()
    spark.streams.addListener(heard)
    try:
        q = silver.start(spark.readStream.schema(schema).parquet(str(tmp_path / "log")), str(tmp_path), str(tmp_path / "c"), once=True, buckets=4)
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(100):
            if heard.rows:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(heard)
    assert sum(r["frames"] for r in heard.rows) == 3 and heard.rows[0]["observed"] == "silver" and heard.rows[0]["bytes"] > 10
    assert spark.table(silver.tables(spark, str(tmp_path), 4)["edits"]).count() == 2


def test_a_signal_ends_the_query_after_its_batch(tmp_path):
    """In a process of its own: SIGTERM while a batch runs; the batch is written, and the process ends by itself."""
    code = f"""
        import sys, time
        sys.path.insert(0, {os.getcwd()!r})
        from pyspark.sql import SparkSession
        from millrace.streaming import jobs
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
        def each(batch, batch_id):
            n = batch.count()
            open({str(tmp_path / 'began')!r}, "w").close()
            time.sleep(3)
            open({str(tmp_path / 'batches')!r}, "a").write(f"{{batch_id}} {{n}}\\n")
        q = spark.readStream.format("rate").option("rowsPerSecond", 5).load().writeStream.option("checkpointLocation", {str(tmp_path / 'c')!r}).foreachBatch(each).start()
        jobs.stop_on_signal(q)
        while q.isActive:
            time.sleep(0.2)
        print("ended")
    """
    p = subprocess.Popen([sys.executable, "-c", textwrap.dedent(code)], stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True, start_new_session=True)
    try:
        for _ in range(600):
            if (tmp_path / "began").exists():
                break
            __import__("time").sleep(0.2)
        os.kill(p.pid, signal.SIGTERM)
        out, err = p.communicate(timeout=90)
    finally:
        if p.poll() is None:
            p.kill()
    assert "ended" in out, err[-800:]
    assert (tmp_path / "batches").read_text().startswith("0 ")


def test_first_arrivals_by_key_state(spark, tmp_path):
    """Three runs from one checkpoint, with keys that were seen before the first; within a run the first by order."""
    from millrace.streaming import keyed

    schema = "id string, at long, off long"
    runs = [[("a", 2, 0), ("a", 1, 9), ("b", None, 1), ("b", 5, 2), (None, 1, 1), ("old", 1, 1)], [("a", 0, 0), ("c", 1, 1)], [("c", 0, 0), ("b", 0, 0), ("d", 3, 3)]]
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    keyed.use_rocksdb(spark)
    try:
        seen = spark.createDataFrame([("old",), (None,)], "id string")
        for rows in runs:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            found = keyed.first_arrivals(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "id", ("at", "off"), seen)
            q = found.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).format("parquet").start(str(tmp_path / "out"))
            q.awaitTermination()
    finally:
        if provider:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    assert sorted(map(tuple, spark.read.schema(schema).parquet(str(tmp_path / "out")).collect())) == [("a", 1, 9), ("b", 5, 2), ("c", 1, 1), ("d", 3, 3)]
