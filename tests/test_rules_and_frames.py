"""Parsing, validation and deduplication over hand-made frames."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import rules, wire
from millrace.operators import medallion

NOW = dt.datetime(2026, 9, 17, 4, 5)


def frame(**change):
    meta = {"id": "a1", "dt": "2026-09-17T04:00:00Z", "domain": "en.example"} | change.pop("meta", {})
    body = {"meta": {k: v for k, v in meta.items() if v is not None}, "type": "edit", "wiki": "enw", "namespace": 0, "title": "P", "user": "Ed", "bot": False, "length": {"old": 12000, "new": 12120}}
    return json.dumps(body | change)


def frames(spark, raws):
    rows = [(r, "t", 0, i, NOW, NOW) for i, r in enumerate(raws)]
    return spark.createDataFrame(rows, wire.FRAME)


CASES = [
    (frame(), None),
    (frame(meta={"id": "a2"}, log_params={"a": 1}, length=None), None),
    (frame(meta={"id": "a3"}, log_params=[]), None),
    (frame(meta={"id": "a4"}, unknown={"x": [1]}), None),
    (frame(meta={"id": None}), "event_id_missing"),
    (frame(meta={"id": "\t"}), "event_id_missing"),
    (frame(meta={"dt": None}), "event_time_missing"),
    (frame(meta={"dt": "17/09/2026 04:00"}), "event_time_unparseable"),
    (frame(meta={"dt": "now"}), "event_time_unparseable"),
    (frame(meta={"dt": "04:00"}), "event_time_unparseable"),
    (frame(meta={"domain": None}), "domain_missing"),
    (frame(meta={"dt": "1999-01-01T00:00:00Z"}), "event_time_before_wikipedia"),
    (frame(meta={"dt": "2099-01-01T00:00:00Z"}), "event_time_in_future"),
    ("{this is not json", "payload_not_json"),
    ("", "payload_not_json"),
    ("   ", "payload_not_json"),
    ("[1, 2, 3]", "payload_not_json"),
    ("42", "payload_not_json"),
    ("null", "payload_not_json"),
    (frame(length="big"), "payload_not_json"),
    (frame(namespace="seven"), "payload_not_json"),
    (frame()[:-9], "payload_not_json"),
]


def test_reasons(spark):
    got = medallion.candidates(frames(spark, [c for c, _ in CASES])).orderBy("kafka_offset").collect()
    assert [r["failure_reason"] for r in got] == [want for _, want in CASES]


def test_values(spark):
    big = 2**63 - 1
    raws = [
        frame(comment='line\n"q" 🎉 漢'),
        frame(meta={"id": "n"}, length={"new": 1520}),
        frame(meta={"id": "o"}, length={"old": -big, "new": big}),
        frame(meta={"id": "l", "dt": "2026-09-17T03:30:00Z"}, namespace=6, length=None),
        frame(meta={"id": "c", "domain": "canary"}, wiki=None, user=None, namespace=None),
    ]
    got = {r["event_id"]: r for r in medallion.valid_rows(medallion.candidates(frames(spark, raws))).collect()}
    assert got["a1"]["comment"] == 'line\n"q" 🎉 漢' and got["a1"]["bytes_delta"] == 120 and got["a1"]["is_article"]
    assert got["n"]["bytes_delta"] == 1520
    assert got["o"]["bytes_delta"] is None
    assert got["l"]["late_by_seconds"] == 2100 and got["l"]["is_article"] is False and got["l"]["bytes_delta"] is None
    assert got["c"]["is_article"] is None and got["c"]["is_anonymous"] is False


def test_first_arrival_and_quarantine_keys(spark):
    raws = [frame(length={"old": 1, "new": 5010}), frame(length={"old": 1, "new": 5042}), "x", "x"]
    judged = medallion.candidates(frames(spark, raws))
    assert [r["bytes_new"] for r in medallion.valid_rows(judged).collect()] == [5010]
    assert medallion.quarantine_rows(judged).count() == 2
    assert medallion.valid_rows(judged).columns == wire.names(wire.EDITS)
    assert medallion.quarantine_rows(judged).columns == wire.names(wire.QUARANTINE)
    with pytest.raises(ValueError):
        medallion.candidates(judged.select("raw_payload"))


@pytest.mark.parametrize(
    ("editor", "want"),
    [("ExampleEditor", False), ("192.0.2.146", True), ("2001:db8::1", True), ("~2026-19", True), ("999.999.999.999", False), ("1.2.3", False), (None, False), ("", False), ("12345678", False), ("192x0x2x51", False)],
)
def test_is_anonymous(spark, editor, want):
    assert spark.createDataFrame([(editor,)], "e string").select(rules.is_anonymous(F.col("e"))).first()[0] is want


def test_insert_absent_is_idempotent(spark):
    a = spark.createDataFrame([("x", 1)], "event_id string, v int")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "event_id string, v int")
    one = a.unionByName(medallion.insert_absent(a, b, ("event_id",)))
    assert sorted(map(tuple, one.collect())) == [("x", 1), ("y", 3)]
    assert medallion.insert_absent(one, b, ("event_id",)).count() == 0


def test_replace_buckets_can_shrink(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "h int, p string")
    assert sorted(map(tuple, medallion.replace_buckets(a, spark.createDataFrame([(1, "z")], "h int, p string"), "h").collect())) == [(1, "z"), (2, "c")]
