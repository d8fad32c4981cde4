"""Loads with a ledger, compaction, landed messages that expire, strict field names, dates of partitions."""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from beaconlake.contracts import schema
from beaconlake.operators import seen
from beaconlake.plans import loads, materialize, project, retention, storage, warehouse
from beaconlake.session import run_path
from beaconlake.sources.messages import parse_messages
from beaconlake.streaming import ingest
from conftest import as_tuples

ENVELOPE = "subscription_name string, message_id string, publish_time timestamp, data string, attributes string"


@pytest.fixture
def database(spark, tmp_path):
    number = uuid.uuid4().int % 10**12
    name = warehouse.create_database(spark, number, str(tmp_path / "warehouse"))
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def send(spark, path, events):
    """Add a file of messages, which is a micro-batch of its own."""
    rows = [("s", f"m{e['event_id']}", datetime(2024, 1, 1), json.dumps(e), "{}") for e in events]
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(path)


def event(number, day="2024-01-01", name="view"):
    return {"event_id": str(number), "date": day, "event_name": name, "timestamp": 1_704_067_200_000 + number}


@pytest.fixture
def ingested(spark, database, tmp_path):
    """(table, target, a function that sends events and ingests them)."""
    contract = schema("raw_events")
    warehouse.create_table(spark, database, "raw_events", contract)
    source, target = str(tmp_path / "topic"), str(tmp_path / "ingested")

    def add(*events):
        send(spark, source, events)
        stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.ingest_events(stream, contract, target, str(tmp_path / "bad"), str(tmp_path / "checkpoint")).awaitTermination()

    return f"{database}.raw_events", target, add


def test_a_load_reads_only_open_batches(spark, ingested):
    table, target, add = ingested
    contract = schema("raw_events")
    assert loads.load_batches(spark, target, contract, table) == []
    add(event(1), event(2))
    add(event(2), event(3, "2024-01-02"))
    assert loads.load_batches(spark, target, contract, table) == [0, 1]
    add({"event_id": "x"})
    add(event(4, "2024-01-02"))
    assert loads.open_batches(spark, target, table) == [2, 3]
    rows = loads.batch_rows(spark, target, contract, [2, 3])
    assert "PartitionFilters: [isnotnull(ingest_batch" in rows._jdf.queryExecution().executedPlan().toString()
    assert loads.load_batches(spark, target, contract, table) == [2, 3]
    assert loads.load_batches(spark, target, contract, table) == []
    assert as_tuples(spark.table(table), "event_id") == [("1",), ("2",), ("3",), ("4",)]
    ledger = as_tuples(loads.ledger(spark, table), ingest.BATCH, "date")
    assert ledger == [(0, date(2024, 1, 1)), (1, date(2024, 1, 1)), (1, date(2024, 1, 2)), (2, None), (3, date(2024, 1, 2))]


def test_a_load_that_fails_before_its_ledger_is_repeated(spark, ingested, monkeypatch):
    table, target, add = ingested
    add(event(1), event(2))

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(loads, "note_load", fail)
    with pytest.raises(RuntimeError):
        loads.load_batches(spark, target, schema("raw_events"), table)
    monkeypatch.undo()
    assert spark.table(table).count() == 2
    assert loads.load_batches(spark, target, schema("raw_events"), table) == [0]
    assert spark.table(table).count() == 2


def test_a_project_logs_its_loads(spark, tmp_path):
    number = uuid.uuid4().int % 10**12
    names = project.register_project(spark, number, str(tmp_path / "w"), buckets=2)
    target = str(tmp_path / "ingested")
    send(spark, str(tmp_path / "topic"), [event(1)])
    stream = spark.readStream.schema(ENVELOPE).parquet(str(tmp_path / "topic"))
    ingest.ingest_events(stream, schema("raw_events"), target, str(tmp_path / "bad"), str(tmp_path / "checkpoint")).awaitTermination()
    assert project.load_raw_events(spark, number, target) == [0]
    assert project.load_raw_events(spark, number, target) == []
    runs = project.run_log(spark, number).where("job = 'load_raw_events' and status = 'success'")
    assert runs.count() == 2 and spark.table(names["raw_events"]).count() == 1
    spark.sql(f"DROP DATABASE `{names['database']}` CASCADE")


def test_an_unfinished_batch_is_not_loaded(spark, ingested, tmp_path):
    table, target, add = ingested
    add(event(1))
    half = spark.read.parquet(target).drop("ingest_batch")
    ingest.write_batch(half.withColumn("event_id", F.lit("half")), 7, target, ("date",))
    assert loads.load_batches(spark, target, schema("raw_events"), table) == [0]
    assert as_tuples(spark.table(table), "event_id") == [("1",)]


def test_ranges_of_numbers(spark):
    rows = spark.range(20)
    for numbers in ([], [3], [0, 1, 2, 9, 19], list(range(20))):
        assert [r.id for r in rows.where(loads.in_ranges(F.col("id"), numbers)).collect()] == numbers


def small_loads(spark, database, make_events, n=6):
    warehouse.create_table(spark, database, "raw_events", schema("raw_events"))
    table = f"{database}.raw_events"
    for i in range(n):
        warehouse.save_rows(spark, make_events([event(i), event(i + 100, "2024-01-02"), event(i + 200, "2024-01-03")]), table)
    return table


def test_closed_dates_get_few_files(spark, database, make_events):
    table = small_loads(spark, database, make_events)
    before = as_tuples(spark.table(table), "date", "event_id")
    old = storage.location(spark, table, {"date": "2024-01-01"})
    assert loads.compact_dates(spark, table, date(2024, 1, 3)) == [date(2024, 1, 1), date(2024, 1, 2)]
    files = {r["date"].day: r.files for r in loads.file_sizes(spark, table, date(2025, 1, 1)).collect()}
    assert files[1] <= 2 and files[2] <= 2 and files[3] == 6
    assert as_tuples(spark.table(table), "date", "event_id") == before
    # The folder that was replaced is there until the next run, for readers that have it open.
    assert spark.read.parquet(old).count() == 6
    assert loads.compact_dates(spark, table, date(2024, 1, 3)) == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(old).count()
    # A compacted date takes rows, is replaced and expires like any other.
    warehouse.save_rows(spark, make_events([event(999)]), table)
    assert spark.table(table).where("date = '2024-01-01'").count() == 7
    warehouse.save_rows(spark, make_events([event(7, "2024-01-02")]), table, overwrite=True)
    assert as_tuples(spark.table(table).where("date = '2024-01-02'"), "event_id") == [("7",)]
    assert len(retention.expire_partitions(spark, table, date(2024, 1, 3), 86_400_000)) == 1
    assert spark.table(table).count() == 7


def test_a_date_that_grows_meanwhile_is_left(spark, database, make_events, monkeypatch):
    table = small_loads(spark, database, make_events)
    real = loads.gathered

    def late(rows, *keys):
        warehouse.save_rows(spark, make_events([event(500)]), table)
        return real(rows, *keys)

    monkeypatch.setattr(loads, "gathered", late)
    assert loads.compact_dates(spark, table, date(2024, 1, 3)) == [date(2024, 1, 2)]
    assert spark.table(table).count() == 19


def test_landed_days_expire_with_their_files(spark, database, tmp_path):
    table = ingest.create_landing(spark, database)
    source = str(tmp_path / "messages")
    for part in range(2):
        rows = [("s", f"{part}-{i}", datetime(2024, 1, 1) + timedelta(days=i), "{}", "{}") for i in range(40)]
        spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ENVELOPE).parquet(source)
        ingest.land_into_table(stream, table, str(tmp_path / "checkpoint")).awaitTermination()
        if part == 0:
            folder = storage.location(spark, table, {"publish_date": "2024-01-02", "ingest_batch": "0"})
            assert len(retention.expire_partitions(spark, table, date(2024, 2, 9))) == 8
            with pytest.raises(Exception, match="PATH_NOT_FOUND"):
                spark.read.parquet(folder).count()
    assert spark.table(table).count() == 32 + 40
    recent = ingest.in_window(spark.table(table), datetime(2024, 1, 20), datetime(2024, 1, 20, 12))
    assert as_tuples(recent, "message_id") == [("0-19",), ("1-19",)]


@pytest.mark.parametrize("data, reason", [
    ("{'event_name':'a',\"extra\":1,\"event_id\":\"1\",\"date\":\"2024-01-01\"}", "does not fit the schema"),
    ("{\"event_id\":\"1\",\"date\":\"2024-01-01\",'extra':1}", "does not fit the schema"),
    ('{"event_id":"1","date":"2024-01-01","extra":1}', "unknown fields: extra"),
    ('{"event_id":"1","date":"2024-01-01","event_name":null}', None),
    ('{"event_id":"a\\": b","date":"2024-01-01","geo":{"zip":1,"city":"x"}}', "unknown fields: geo.zip"),
    ('{"event_id":"it\'s","date":"2024-01-01"}', None),
])
def test_unknown_names_are_found_at_every_level(spark, data, reason):
    messages = spark.createDataFrame([("s", "m", None, data, "{}")], ENVELOPE)
    assert parse_messages(messages, schema("raw_events"), drop_unknown_fields=False).first()["reason"] == reason


ROWS = "event_id string, timestamp bigint, inserted_at bigint, `date` date"
HOUR_MS = 3_600_000
NOON = 1_715_774_400_000  # 2024-05-15T12:00Z


@pytest.mark.parametrize("unit", warehouse.PARTITION_UNITS)
@pytest.mark.parametrize("field", ["timestamp", "inserted_at"])
def test_reads_by_date_lose_no_row(spark, database, unit, field):
    """Dates of senders east and west of UTC, and rows that were inserted years after their date."""
    rows = [
        ("east", NOON - 13 * HOUR_MS, NOON, date(2024, 5, 15)), ("utc", NOON, NOON, date(2024, 5, 15)),
        ("west", NOON + 14 * HOUR_MS, NOON, date(2024, 5, 15)), ("other", NOON, NOON, date(2024, 5, 16)),
        ("late", NOON, NOON + 800 * 24 * HOUR_MS, date(2024, 5, 15)), ("old", NOON - 700 * 24 * HOUR_MS, 0, date(2022, 6, 15)),
        ("untimed", None, None, date(2024, 5, 15)), ("undated", NOON, NOON, None),
    ]
    df = spark.createDataFrame(rows, ROWS)
    warehouse.create_table(spark, database, "t", df.schema, unit=unit, unit_field=field, require_partition_filter=True)
    table = f"{database}.t"
    for half in range(2):
        warehouse.save_rows(spark, df.where(F.length("event_id") % 2 == half), table)
    day = date(2024, 5, 15)
    found = warehouse.read_table(spark, table, day, day)
    assert as_tuples(found, "event_id") == [("east",), ("late",), ("untimed",), ("utc",), ("west",)]
    assert as_tuples(warehouse.read_table(spark, table, date_to=date(2023, 1, 1)), "event_id") == [("old",)]
    assert warehouse.read_table(spark, table, date(2030, 1, 1)).count() == 0
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in text
    if unit == "HOUR" and field == "timestamp":
        files = warehouse.read_table(spark, table, date(2024, 5, 16)).inputFiles()
        assert all("2024-05-15-12" in path for path in files) and files
    with pytest.raises(ValueError):
        warehouse.read_table(spark, table)
    # Rows that came by other means are in partitions whose dates are not known, and are read.
    if unit == "DAY":
        return
    spark.sql(f"INSERT INTO {table} VALUES ('direct', {NOON}, {NOON}, DATE'2024-05-15', '1999')")
    assert ("direct",) in as_tuples(warehouse.read_table(spark, table, day, day), "event_id")


def test_replacing_a_table_keeps_what_belongs_to_it(spark, database):
    day = date(2024, 2, 3)
    spark.range(4).createOrReplaceTempView("four")
    query = "select id, cast(id % 2 as int) as part from four"
    table = materialize.materialize(spark, query, database, day, partitioning_field="part")
    labels = {"transient_team": "a", "owner_team": "b", "external_ref": "c", "option.x": "d", "locationless": "e"}
    for name, value in labels.items():
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{name}' = '{value}')")
    spark.sql(f"COMMENT ON TABLE {table} IS 'it''s mine'")
    first = storage.location(spark, table)
    for text in (query, f"{query} where id < 3", "select id, id * 2 as twice, cast(id % 2 as int) as part from four"):
        materialize.materialize(spark, text, database, day, partitioning_field="part")
        properties = warehouse.table_properties(spark, table)
        assert {name: properties.get(name) for name in labels} == labels
        assert spark.catalog.getTable(table).description == "it's mine"
    assert as_tuples(spark.table(table), "id", "twice") == [(0, 0), (1, 2), (2, 4), (3, 6)]
    assert first != storage.location(spark, table)


def test_a_failure_in_the_write_leaves_the_old_version(spark, database):
    day = date(2024, 2, 3)
    fail = F.udf(lambda n: 1 // (2 - n), "int")
    spark.range(4).select(fail("id").alias("x")).createOrReplaceTempView("failing")
    table = materialize.materialize(spark, "select 1 as x", database, day)
    before = storage.location(spark, table)
    with pytest.raises(Exception):
        materialize.materialize(spark, "select x from failing", database, day)
    assert storage.location(spark, table) == before and as_tuples(spark.table(table), "x") == [(1,)]
    # A reader keeps its version over one replacement; the one after removes it.
    reader = spark.table(table)
    materialize.materialize(spark, "select 2 as x", database, day)
    assert as_tuples(spark.table(table), "x") == [(2,)] and spark.read.parquet(before).count() == 1
    materialize.materialize(spark, f"select x + 1 as x from {table}", database, day)
    assert as_tuples(spark.table(table), "x") == [(3,)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(before).count()
    assert reader.columns == ["x"]


def test_a_table_of_another_origin_is_replaced(spark, database):
    spark.range(4).selectExpr("id", "cast(id % 2 as int) as part").write.partitionBy("part").saveAsTable(f"{database}.made")
    spark.sql(f"ALTER TABLE {database}.made SET TBLPROPERTIES ('team' = 'x')")
    for n in (2, 1):
        materialize.replace_table(spark, f"`{database}`.`made`", spark.range(n).selectExpr("id", "0 as part"), ("part",))
        assert spark.table(f"{database}.made").count() == n
    assert warehouse.table_properties(spark, f"{database}.made")["team"] == "x"


def test_materialized_tables_expire_with_their_files(spark, tmp_path):
    name = warehouse.create_database(spark, uuid.uuid4().int % 10**12, str(tmp_path / "w"), default_table_expiration_ms=1000)
    table = materialize.materialize(spark, "select 1 as x", name, date(2024, 1, 1))
    materialize.materialize(spark, "select 2 as x", name, date(2024, 1, 1))
    folders = storage.version_folders(spark, table)
    assert len(folders) == 2
    assert retention.expire_tables(spark, name, datetime.now().astimezone() + timedelta(hours=1)) == ["scheduled_20240101"]
    for folder in folders:
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(folder).count()
    spark.sql(f"DROP DATABASE `{name}` CASCADE")


@pytest.mark.parametrize("buckets", [4, 8])
def test_stored_ids_are_not_shuffled(spark, database, make_events, buckets):
    table = f"`{database}`.`seen_events`"
    seen.create_seen(spark, table, buckets)
    first = make_events([event(1), event(1), event(2), {"date": "2024-01-01"}, {"date": "2024-01-01"}])
    kept = seen.new_events(first, spark.table(table), buckets)
    assert kept.count() == 4
    seen.remember(spark, kept, table, 1)
    seen.remember(spark, kept, table, 1)
    assert spark.table(table).count() == 2

    earlier = {**event(1), "timestamp": 5}
    later = {**event(2), "timestamp": 10**13 * 2}
    path = run_path(spark, "events")
    make_events([earlier, later, event(3), event(2)]).write.parquet(path)
    found = seen.new_events(spark.read.schema(schema("raw_events")).parquet(path), spark.table(table), buckets)
    assert as_tuples(found, "event_id", "timestamp", "replaces") == [
        ("1", 5, date(2024, 1, 1)), ("2", event(2)["timestamp"], None), ("3", event(3)["timestamp"], None),
    ]
    # The new events are brought to the buckets of the stored ids, which stay where they are.
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text
    assert [line for line in text.splitlines() if "Exchange" in line and "#" in line and _scans_stored(text, line)] == []


def _scans_stored(text: str, line: str) -> bool:
    """Whether the scan of the stored ids lies below a line of a plan."""
    lines = text.splitlines()
    at = lines.index(line)
    level = max(line.find("+- "), line.find(":- "))
    below = []
    for other in lines[at + 1:]:
        if max(other.find("+- "), other.find(":- ")) <= level:
            break
        below.append(other)
    return any("seen_events" in other for other in below)
