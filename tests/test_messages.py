from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beaconlake.contracts import schema
from beaconlake.sources import messages, topic
from beaconlake.plans import warehouse
from beaconlake.streaming import ingest, process
from conftest import as_tuples

BASE = {"date": "2024-01-01", "timestamp": 1, "event_id": "e"}


def _text(**changes) -> str:
    return json.dumps({**BASE, **changes})


def _parsed(spark, *texts, **options):
    rows = spark.createDataFrame([(t, "{}") for t in texts], "data string, attributes string")
    return messages.parse_messages(rows, schema("raw_events"), **options)


def _only_row(spark, text: str):
    return messages.good_rows(_parsed(spark, text), schema("raw_events")).first()


def test_unknown_keys_are_dropped_at_every_depth(spark):
    row = _only_row(spark, _text(extra=1, order={"id": "o", "extra": {"deep": 1}, "value": 3}))
    assert row["order"]["id"] == "o" and row["order"]["value"] == 3.0
    assert row["order"]["custom_params"] == []


def test_coercions(spark):
    assert _only_row(spark, '{"date":"2024-01-01","event_id":5}')["event_id"] == "5"
    assert _only_row(spark, '{"date":"2024-01-01","event_id":"a","event_id":"b"}')["event_id"] == "b"
    assert _only_row(spark, _text(TIMESTAMP=3))["timestamp"] == 1


def test_missing_null_and_empty_lists_are_empty(spark):
    for text in (_text(), _text(products=None), _text(products=[])):
        assert _only_row(spark, text)["products"] == []
    row = _only_row(spark, _text(ad_data=[{"ad_network": "n"}]))
    assert row["ad_data"][0]["values"] == []


@pytest.mark.parametrize("text, reason", [
    (_text(timestamp="12"), "does not fit the schema"),
    (_text(timestamp=1.5), "does not fit the schema"),
    (_text(date="bad"), "does not fit the schema"),
    (_text(is_test_event="true"), "does not fit the schema"),
    (_text(products={"id": "p"}), "does not fit the schema"),
    ("not json", "does not fit the schema"),
    ("[1]", "does not fit the schema"),
    ("", "empty message"),
    ("  ", "empty message"),
    ('{"date":"2024-01-01"}', "no event_id"),
    ('{"event_id":"e"}', "no date"),
])
def test_quarantine(spark, text, reason):
    parsed = _parsed(spark, text)
    assert [r["reason"] for r in messages.quarantined(parsed).collect()] == [reason]
    assert messages.good_rows(parsed, schema("raw_events")).isEmpty()


@pytest.mark.parametrize("changes, reason", [
    ({}, None),
    ({"extra": 1}, "extra"),
    ({"order": {"id": "o", "more": 1}}, "order.more"),
    ({"ad_data": [{"ad_network": "n", "values": [{"key": "k"}, {"other": 1}]}]}, "ad_data[].values[].other"),
    ({"event_params": [{"key": "k", "value": {"int_value": 1, "list": []}}]}, "event_params[].value.list"),
    ({"event_name": 'quotes ": and {"colon": 1}'}, None),
    ({"geo": None, "products": None}, None),
    ({"a\\u0062\"c": 1}, 'a\\u0062"c'),
])
def test_unknown_fields_refused(spark, changes, reason):
    (row,) = _parsed(spark, _text(**changes), drop_unknown_fields=False).collect()
    assert row["reason"] == (None if reason is None else f"unknown fields: {reason}")


def test_schema_is_an_argument(spark):
    own = StructType.fromDDL("event_id string, `date` date, note string")
    text = '{"event_id":"1","date":"2024-01-01","note":"n"}'
    rows = spark.createDataFrame([(text, "{}")], "data string, attributes string")
    assert messages.good_rows(messages.parse_messages(rows, own), own).first()["note"] == "n"


def _topic(spark, path: str, rows: list[tuple[int, str, str]], files: int = 1) -> None:
    df = spark.createDataFrame(rows, "offset bigint, data string, name string").select(
        F.lit("k").cast("binary").alias("key"), F.col("data").cast("binary").alias("value"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.timestamp_seconds(F.lit(1704067200) + F.col("offset")).alias("timestamp"),
        F.array(
            F.struct(F.lit("name").alias("key"), F.lit("old").cast("binary").alias("value")),
            F.struct(F.lit("name").alias("key"), F.col("name").cast("binary").alias("value")),
        ).alias("headers"),
    )
    df.repartition(files).write.mode("append").parquet(path)


def _event(i: int, day: int = 1, **more) -> str:
    return json.dumps({"event_id": f"e{i}", "date": f"2024-01-0{day}", "timestamp": 1704067200000 + i, **more})


@pytest.fixture
def stream(spark, tmp_path):
    def read(files_per_trigger: int = 1):
        return topic.envelopes(topic.read_topic_files(spark, str(tmp_path / "topic"), files_per_trigger), "sub")

    return read


def _start(stream, tmp_path, **options):
    ingest.ingest_events(
        stream(), schema("raw_events"), str(tmp_path / "raw"), str(tmp_path / "bad"), str(tmp_path / "checkpoint"),
        **options,
    ).awaitTermination()


def _stored(spark, tmp_path):
    return as_tuples(ingest.read_batches(spark, str(tmp_path / "raw"), schema("raw_events")), "event_id", "date")


def test_several_batches_equal_one_and_a_restart_adds_nothing(spark, tmp_path, stream):
    path = str(tmp_path / "topic")
    sent = [(i, _event(i, 1 + i % 3), "a") for i in range(20)] + [(20, "bad", "a"), (21, _event(0), "a")]
    _topic(spark, path, sent, 4)
    _start(stream, tmp_path)
    first = _stored(spark, tmp_path)
    assert len(first) == 21
    _start(stream, tmp_path)
    assert _stored(spark, tmp_path) == first
    _topic(spark, path, [(30, _event(30), "a")])
    _start(stream, tmp_path)
    assert len(_stored(spark, tmp_path)) == 22
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert as_tuples(bad, "message_id", "data", "reason") == [("t-0-20", "bad", "does not fit the schema")]


def test_a_repeated_batch_replaces_its_output(spark, tmp_path, make_events):
    events = make_events([{"event_id": str(i), "date": "2024-01-01"} for i in range(5)])
    for _ in range(2):
        ingest.write_batch(events, 4, str(tmp_path / "raw"), ("date",))
    ingest.write_batch(events.limit(2), 5, str(tmp_path / "raw"), ("date",))
    assert len(_stored(spark, tmp_path)) == 7


def test_filter_reads_the_attributes(spark, tmp_path, stream):
    _topic(spark, str(tmp_path / "topic"), [(i, _event(i), "ab"[i % 2]) for i in range(6)])
    _start(stream, tmp_path, message_filter="attr['name'] = 'b'")
    assert [e for e, _ in _stored(spark, tmp_path)] == ["e1", "e3", "e5"]


def test_fan_out_and_pull(spark, tmp_path, stream):
    _topic(spark, str(tmp_path / "topic"), [(i, _event(i), "a") for i in range(6)], 2)
    seen: dict[str, int] = {"one": 0, "two": 0}

    def counter(name):
        def consumer(batch, batch_id):
            seen[name] += batch.count()
        return consumer

    ingest.fan_out(stream(), str(tmp_path / "c1"), [counter("one"), counter("two")]).awaitTermination()
    assert seen == {"one": 6, "two": 6}
    ingest.consume(stream(), str(tmp_path / "c2"), counter("one")).awaitTermination()
    assert seen == {"one": 12, "two": 6}


def test_landing_and_replay(spark, tmp_path, stream):
    _topic(spark, str(tmp_path / "topic"), [(i, _event(i, 1 + i // 5), "a") for i in range(10)], 2)
    ingest.land_messages(stream(), str(tmp_path / "landed"), str(tmp_path / "checkpoint")).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "landed"))
    assert sorted(landed.columns) == sorted([*schema("event_messages").names, "publish_date"])
    assert {r["attributes"] for r in landed.collect()} == {'{"name":"a"}'}
    start, end = datetime(2024, 1, 1, 0, 0, 2), datetime(2024, 1, 1, 0, 0, 3)
    assert as_tuples(ingest.replay_window(landed, schema("raw_events"), start, end), "event_id") == [("e2",), ("e3",)]
    target = str(tmp_path / "rebuilt")
    for window in ((start, end), (start, end), (datetime(2024, 1, 1), datetime(2024, 1, 2))):
        ingest.replay_into(landed, schema("raw_events"), *window, target)
        rebuilt = ingest.read_batches(spark, target, schema("raw_events"))
        wanted = [("e2",), ("e3",)] if window == (start, end) else [(f"e{i}",) for i in range(10)]
        assert as_tuples(rebuilt, "event_id") == wanted


def test_replay_keeps_what_landing_no_longer_holds(spark, tmp_path, stream):
    _topic(spark, str(tmp_path / "topic"), [(i, _event(i, 1), "a") for i in range(10)], 1)
    out = [str(tmp_path / name) for name in ("raw", "quarantine", "checkpoint")]
    ingest.ingest_events(stream(), schema("raw_events"), *out).awaitTermination()
    ingest.land_messages(stream(), str(tmp_path / "landed"), str(tmp_path / "landing")).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "landed"))
    late = landed.where(F.col("data").contains("e3")).withColumn("data", F.regexp_replace("data", "e3", "late"))
    ingest.replay_into(late, schema("raw_events"), datetime(2024, 1, 1), datetime(2025, 1, 1), out[0])
    stored = ingest.read_batches(spark, out[0], schema("raw_events"))
    assert as_tuples(stored, "event_id") == [*[(f"e{i}",) for i in range(10)], ("late",)]


def test_impossible_timestamps_and_hidden_unknown_fields(spark):
    rows = spark.createDataFrame([
        ('{"event_id":"a","date":"2024-01-01","timestamp":100000000000000000}',),
        ('{"event_id":"b","date":"2024-01-01","timestamp":4102444800000}',),
        ('{"event_id":"c","date":"2024-01-01","event_name":"a\\u0022:b","extra":1}',),
    ], "data string")
    parsed = messages.parse_messages(rows, schema("raw_events"), drop_unknown_fields=False)
    assert as_tuples(parsed, "row.event_id", "reason") == [
        ("a", "timestamp out of range"), ("b", None), ("c", "unknown fields: extra"),
    ]


def test_processing_removes_copies_across_batches_and_restarts(spark, tmp_path, stream):
    path = str(tmp_path / "topic")
    url = [{"key": "landing_page_url", "value": {"string_value": "https://Shop.example/p?a=1"}}]

    def run():
        process.process_events(
            stream(), schema("raw_events"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
        ).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    _topic(spark, path, [(i, _event(i % 7, event_params=url), "a") for i in range(14)]
           + [(20, _event(20, is_test_event=True), "a"), (21, "bad", "a")], 3)
    once = run()
    assert as_tuples(once, "event_id") == [(f"e{i}",) for i in range(7)]
    assert {(r["landing_hostname"], r["landing_page_path"]) for r in once.collect()} == {("shop.example", "/p")}
    _topic(spark, path, [(30, _event(3), "a"), (31, _event(8), "a")])
    assert as_tuples(run(), "event_id") == [(f"e{i}",) for i in (0, 1, 2, 3, 4, 5, 6, 8)]
    assert as_tuples(run(), "event_id") == [(f"e{i}",) for i in (0, 1, 2, 3, 4, 5, 6, 8)]


def test_late_events_are_found_beside_the_stream(spark, tmp_path, stream):
    path = str(tmp_path / "topic")

    def run():
        process.process_events(
            stream(), schema("raw_events"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), delay="1 second"
        ).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    _topic(spark, path, [(100 + i, _event(i), "a") for i in range(3)])
    run()
    _topic(spark, path, [(1, _event(8), "a"), (2, _event(8), "a"), (3, _event(0), "a"), (200, _event(9), "a")])
    processed = run()
    assert as_tuples(processed, "event_id") == [("e0",), ("e1",), ("e2",), ("e9",)]
    ingest.land_messages(stream(), str(tmp_path / "landed"), str(tmp_path / "landing")).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "landed"))
    window = landed, schema("raw_events"), datetime(2024, 1, 1), datetime(2024, 1, 2)
    late = process.late_events(*window, processed)
    assert as_tuples(late, "event_id") == [("e8",)] and set(late.columns) == set(processed.columns)
    assert process.late_events(*window, processed.unionByName(late)).isEmpty()


def test_a_table_takes_each_event_once(spark, tmp_path, make_events):
    table = warehouse.bootstrap(spark, 77_001, str(tmp_path / "project"))["raw_events"]
    rows = make_events([{"event_id": f"e{i % 3}", "date": "2024-01-01", "event_name": "view"} for i in range(5)])
    for _ in range(2):
        ingest.add_to_table(rows, table)
    ingest.add_to_table(make_events([{"event_id": "e0", "date": "2024-01-02"}, {"event_id": "e2", "date": "2024-01-01"}]), table)
    ingest.add_to_table(rows.limit(0), table)
    assert as_tuples(spark.table(table), "event_id") == [("e0",), ("e0",), ("e1",), ("e2",)]
