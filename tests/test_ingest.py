import json

import pytest
from pyspark.sql import types as T

from eventide.operators import rows
from eventide.sources import ingest
from eventide.sources.contract import clickstream_contract, contract_audit, contract_schema, spark_type
from tests.events import at, event, frame

SCHEMA = contract_schema(clickstream_contract())
GOOD = {
    "event_id": "e1", "user_id": "u1", "session_id": "s1", "event_type": "page_view", "page_url": "/", "timestamp": 1729630800000,
    "ip_address": None, "user_agent": "x", "referrer": None, "country": "US", "device_type": "mobile",
}
OTHER = {"event_id": "e2", "user_id": "USER_1", "session_id": "s", "event_type": "VIEW", "product_id": "P", "price": 2.5,
         "timestamp": 1729630800001, "processing_time": 1729630800009}


def raw(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return df.selectExpr("cast(value as binary) value")


def test_contract():
    assert [f.name for f in SCHEMA.fields][:6] == ["event_id", "user_id", "session_id", "event_type", "page_url", "timestamp"]
    assert SCHEMA["timestamp"].dataType == T.LongType() and not SCHEMA["timestamp"].nullable
    assert SCHEMA["country"].nullable and len(SCHEMA.fields) == 11


def test_contract_files(tmp_path):
    plain, wrapped, wrong = tmp_path / "a.avsc", tmp_path / "b.avsc", tmp_path / "c.avsc"
    plain.write_text(json.dumps(clickstream_contract()))
    wrapped.write_text(json.dumps({"schema": json.dumps(clickstream_contract())}))
    wrong.write_text(json.dumps({"type": "enum", "name": "x"}))
    assert contract_schema(plain) == contract_schema(wrapped) == SCHEMA
    with pytest.raises(ValueError):
        contract_schema(wrong)


@pytest.mark.parametrize(
    "avro, want",
    [
        ("int", T.IntegerType()), ("float", T.FloatType()), ("double", T.DoubleType()), ("boolean", T.BooleanType()),
        ("bytes", T.StringType()), ("null", T.StringType()), ("mystery", T.StringType()),
        (["null", "long"], T.LongType()), (["int", "string"], T.StringType()),
        ({"type": "long", "logicalType": "timestamp-micros"}, T.LongType()),
        ({"type": "array", "items": "int"}, T.ArrayType(T.IntegerType())),
        ({"type": "map", "values": ["null", "double"]}, T.MapType(T.StringType(), T.DoubleType())),
        ({"type": "record", "name": "n", "fields": [{"name": "a", "type": "int"}]},
         T.StructType([T.StructField("a", T.IntegerType(), False)])),
        ({"type": "enum", "symbols": ["A"]}, T.StringType()),
    ],
)
def test_types(avro, want):
    assert spark_type(avro) == want


def test_bytes_as_binary():
    assert spark_type("bytes", binary=True) == T.BinaryType()


def test_valid_and_quarantined_messages_partition_the_input(spark):
    no_user, no_time, word = dict(GOOD), dict(GOOD, timestamp=None), dict(GOOD, timestamp="soon")
    del no_user["user_id"]
    values = [json.dumps(v) for v in (GOOD, OTHER, dict(GOOD, extra=1), no_user, no_time, word)]
    values += ['{"event_id": "e3", "user', "", "not json", None]
    messages = raw(spark, values)
    good = ingest.valid_events(messages, SCHEMA).collect()
    assert sorted(r.event_id for r in good) == ["e1", "e1", "e2"]
    other = next(r for r in good if r.event_id == "e2")
    assert other.page_url is None and other.event_type == "VIEW"
    reasons = sorted(r.reason for r in ingest.quarantine(messages, SCHEMA).collect())
    assert reasons == ["no timestamp", "no user_id"] + ["undecodable"] * 5
    assert ingest.parse_events(messages, SCHEMA).count() == len(values)


def test_audit(spark):
    found = {r.field: r for r in contract_audit(raw(spark, [json.dumps(v) for v in (GOOD, OTHER, dict(GOOD, timestamp="soon"))]), SCHEMA).collect()}
    assert (found["page_url"].missing, found["ip_address"].nulls, found["timestamp"].bad_type) == (1, 2, 1)
    assert {f for f, r in found.items() if r.unknown} == {"product_id", "price", "processing_time"}


def test_sources_share_the_envelope(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([(json.dumps(GOOD),)], "value string").write.text(path)
    lines = ingest.read_events(spark, path, "text", streaming=False)
    assert lines.columns == ingest.ENVELOPE.names
    assert ingest.valid_events(lines, SCHEMA).count() == 1
    assert ingest.read_events(spark, path, "text").isStreaming
    with pytest.raises(Exception, match="(?i)kafka"):  # no Kafka package here
        ingest.read_events(spark, "clickstream", **{"kafka.bootstrap.servers": "localhost:9092"})


def test_jsonl_and_iso(spark):
    ev = frame(spark, [event(0, "10:00"), event(1, "10:00:00.25")])
    lines = [json.loads(r.value) for r in ingest.to_jsonl(rows.enrich_iso(ev.drop("processing_timestamp"))).collect()]
    assert [x["event_timestamp"] for x in lines] == ["2024-10-28T10:00:00Z", "2024-10-28T10:00:00.250Z"]


def test_epoch_millis_are_exact(spark):
    df = spark.createDataFrame([(1729630800000,), (1729630800123,)], "timestamp long")
    got = [r.x for r in rows.with_event_time(df).selectExpr("date_format(event_timestamp, 'yyyy-MM-dd HH:mm:ss.SSS') x").collect()]
    assert got == ["2024-10-22 21:00:00.000", "2024-10-22 21:00:00.123"]


def test_dedup_keeps_first_arrival(spark):
    copies = [event(0, "10:00", kind="view", arrived="10:05"), event(0, "10:00", kind="click", arrived="10:01"), event(1, "10:00")]
    got = {r.event_id: r.event_type for r in rows.dedup_events(frame(spark, copies)).collect()}
    assert got == {"e000000": "click", "e000001": "view"}


def test_missing_event_time_has_no_window(spark):
    ev = frame(spark, [event(0, "10:00"), event(1, "10:07")[:5] + (None,) + event(1, "10:07")[6:]])
    assert rows.with_window(ev).count() == 1
    assert at("10:00").minute == 0


def test_required_fields(spark):
    schema = T.StructType([T.StructField("event_id", T.StringType(), False), T.StructField("event_type", T.StringType(), False), T.StructField("page_url", T.StringType(), False)])
    sent = ['{"event_id":"1","event_type":"view","page_url":"/"}', '{"event_id":"2","event_type":null,"page_url":"/"}', '{"event_id":"3","event_type":"view"}']
    raw = spark.createDataFrame([(s.encode(),) for s in sent], "value binary")
    assert {r.event_id for r in ingest.valid_events(raw, schema).collect()} == {"1", "3"}
    strict = ingest.contract_fields(schema)
    assert {r.event_id for r in ingest.valid_events(raw, schema, strict).collect()} == {"1"}
    assert {r.reason for r in ingest.quarantine(raw, schema, required=strict).collect()} == {"no event_type", "no page_url"}
    judged = ingest.judged_events(raw, schema, required=strict).collect()
    assert sorted((r.reason or "", r.data.event_id) for r in judged) == [("", "1"), ("no event_type", "2"), ("no page_url", "3")]


def test_named_types_and_exact_types():
    money = {"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}
    avro = {
        "type": "record", "name": "Order", "namespace": "shop", "fields": [
            {"name": "state", "type": {"type": "enum", "name": "State", "symbols": ["NEW", "PAID"]}},
            {"name": "before", "type": ["null", "State"]}, {"name": "again", "type": "shop.State"},
            {"name": "total", "type": money}, {"name": "day", "type": {"type": "int", "logicalType": "date"}},
            {"name": "hash", "type": {"type": "fixed", "name": "Md5", "size": 16}},
            {"name": "tags", "type": {"type": "array", "items": ["null", "string"]}},
        ],
    }
    exact = contract_schema(avro, exact=True)
    assert [f.dataType for f in exact] == [
        T.StringType(), T.StringType(), T.StringType(), T.DecimalType(10, 2), T.DateType(), T.BinaryType(), T.ArrayType(T.StringType(), True),
    ]
    assert [f.nullable for f in exact] == [False, True, False, False, False, False, False]
    assert {f.dataType for f in list(contract_schema(avro))[:6]} == {T.StringType()}
    with pytest.raises(ValueError, match="no Spark type"):
        spark_type("nobody", exact=True)
