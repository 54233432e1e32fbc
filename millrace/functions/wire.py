"""Schemas: the wire frame and the tables made from it. All wire fields may be null."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _struct(text: str) -> T.StructType:
    return T.StructType([T.StructField(*_field(p)) for p in text.split()])


def _field(part: str) -> tuple[str, T.DataType]:
    name, _, kind = part.partition(":")
    kinds = {"": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "bool": T.BooleanType()}
    return name, kinds[kind]


META = _struct("uri request_id id dt domain stream topic partition:int offset:long")
OLD_NEW = _struct("old:long new:long")
WIRE = T.StructType(
    [
        T.StructField("$schema", T.StringType()),
        T.StructField("meta", META),
        *_struct("id:long type namespace:int title title_url comment parsedcomment timestamp:long user").fields,
        *_struct("bot:bool minor:bool patrolled:bool").fields,
        T.StructField("length", OLD_NEW),
        T.StructField("revision", OLD_NEW),
        *_struct("server_url server_name server_script_path wiki notify_url").fields,
        # log_params is an object in some frames and a list in others: its text is the contract
        *_struct("log_id:long log_type log_action log_params log_action_comment").fields,
    ]
)
PARSED = T.StructType([*WIRE.fields, T.StructField(CORRUPT, T.StringType())])
PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

FRAME = "raw_payload string, kafka_topic string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, ingested_at timestamp"
FRAME_COLUMNS = [f.split()[0] for f in FRAME.split(", ")]
BRONZE = (
    "event_id string, event_time timestamp, schema_uri string, raw_payload string, kafka_topic string, kafka_partition int, "
    "kafka_offset long, kafka_timestamp timestamp, ingested_at timestamp, ingest_date date"
)
EDITS = (
    "event_id string, event_time timestamp, wiki string, domain string, change_type string, namespace_id int, "
    "is_article boolean, page_title string, page_url string, editor string, is_bot boolean, is_minor boolean, "
    "is_anonymous boolean, bytes_old long, bytes_new long, bytes_delta long, rev_old long, rev_new long, comment string, "
    "late_by_seconds long, ingested_at timestamp, event_date date"
)
QUARANTINE = (
    "event_id string, raw_payload string, failure_reason string, kafka_partition int, kafka_offset long, "
    "failed_at timestamp, ingest_date date"
)


def names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


EDITS_KEY = ("event_id",)
QUARANTINE_KEY = ("kafka_partition", "kafka_offset")
#: First arrival: the lower coordinates win.
ARRIVAL = ("kafka_partition", "kafka_offset")
