"""Work that must not grow faster than its input: what is shuffled, read again or asked of a state store."""

import math
import random

import pytest

from beaconlake import fixtures as fx
from beaconlake.streaming import ordering

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_automatic_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


# ---- derived tables ----

def test_events_are_dealt_before_they_are_nested(spark, no_automatic_broadcast):
    for derived in (fx.raw_events, fx.topic_rows):
        plan = _plan(derived(spark, SMALL))
        assert "SortMergeJoin" not in plan and plan.count("- Exchange ") == 1
        assert "event_params" not in plan[plan.index("- Exchange "):]


def test_derived_rows_are_the_same_either_way(spark, monkeypatch):
    few = {name: derived(spark, SMALL) for name, derived in (("raw", fx.raw_events), ("topic", fx.topic_rows))}
    events = fx.table(spark, SMALL, "events").count()
    monkeypatch.setattr(fx, "MAX_BROADCAST_PAGES", 0)
    monkeypatch.setattr(fx, "EVENTS_PER_TASK", 50)
    for name, derived in (("raw", fx.raw_events), ("topic", fx.topic_rows)):
        many = derived(spark, SMALL)
        assert few[name].exceptAll(many).isEmpty() and many.exceptAll(few[name]).isEmpty()
    # The topic's files grow with the events.
    assert fx.topic_files(spark, SMALL) == math.ceil(events / 50) > fx.TOPIC_FILES


# ---- order ----

class Store:
    """A state variable and timers in memory that count what is asked of them."""

    def __init__(self):
        self.rows, self.value, self.timers, self.calls = {}, None, set(), 0

    def __getattribute__(self, name):
        if name in ("updateValue", "getValue", "removeKey", "containsKey", "registerTimer", "get", "update", "exists"):
            self.calls += 1
        return object.__getattribute__(self, name)

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return self

    def updateValue(self, key, value):
        self.rows[key] = value

    def getValue(self, key):
        return self.rows.get(key)

    def removeKey(self, key):
        del self.rows[key]

    def containsKey(self, key):
        return key in self.rows

    def registerTimer(self, moment):
        self.timers.add(moment)

    def get(self):
        return self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value


class At:
    def __init__(self, moment):
        self.moment = moment

    def getExpiryTimeInMs(self):
        return self.moment

    def getCurrentWatermarkInMs(self):
        return self.moment


def test_a_key_asks_little_of_the_state_store(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(ordering, "CHUNK_ROWS", 300)
    random_, store, events, given = random.Random(1), Store(), [], []
    processor = ordering.InOrder()
    processor.init(store)
    for batch in range(4):
        come = [(batch * 1000 + random_.randrange(2000), f"é{random_.randrange(10**6)}", f"row{batch}-{i}") for i in range(1000)]
        # What comes is later than the watermark.
        come = [event for event in come if event[0] > batch * 1000]
        events += come
        processor.handleInputRows(("k",), iter([pd.DataFrame(come, columns=["timestamp", "event_id", "event_row"])]), None)
        while due := [moment for moment in store.timers if moment <= (batch + 1) * 1000]:
            store.timers.remove(min(due))
            for frame in processor.handleExpiredTimer(("k",), At((batch + 1) * 1000), At(min(due))):
                given += list(zip(frame["event_row"], frame["position"]))
        assert len(given) == sum(event[0] <= (batch + 1) * 1000 for event in events)
    while store.timers:
        store.timers.remove(last := min(store.timers))
        for frame in processor.handleExpiredTimer(("k",), At(10**6), At(last)):
            given += list(zip(frame["event_row"], frame["position"]))
    wanted = sorted(events, key=lambda event: (event[0], event[1].encode()))
    assert [row for row, _ in given] == [event[2] for event in wanted]
    assert [position for _, position in given] == list(range(1, len(events) + 1))
    assert not store.rows and store.calls < 100


# ---- writes ----

def test_rows_are_not_sorted_to_be_written_by_day(spark, tmp_path):
    from datetime import date, timedelta

    from beaconlake.session import OPEN_FILES, OPEN_FILES_SETTING, open_files

    # More days than a task keeps open.
    days = [date(2024, 1, 1) + timedelta(i * 7 % (OPEN_FILES + 13)) for i in range(450)]
    rows = spark.createDataFrame([(f"e{i}", day) for i, day in enumerate(days)], "event_id string, `date` date").coalesce(1)
    rows.createOrReplaceTempView("days_mixed")
    spark.sql(f"CREATE TABLE days_open (event_id STRING, `date` DATE) USING parquet PARTITIONED BY (`date`) LOCATION '{tmp_path}/plain'")
    before = spark.conf.get(OPEN_FILES_SETTING)
    try:
        with open_files(spark):
            plan = spark.sql("EXPLAIN INSERT INTO days_open SELECT * FROM days_mixed").first()[0]
            assert "WriteFiles" in plan and "Sort" not in plan
            spark.table("days_mixed").write.insertInto("days_open")
        assert spark.table("days_open").exceptAll(rows).isEmpty() and spark.table("days_open").count() == 450
    finally:
        spark.sql("DROP TABLE days_open")
    assert spark.conf.get(OPEN_FILES_SETTING) == before


def test_landing_and_ingestion_write_without_a_sort(spark, monkeypatch):
    from beaconlake import reports
    from beaconlake.session import OPEN_FILES, OPEN_FILES_SETTING
    from beaconlake.streaming import ingest

    found, land, write_batch = [], ingest.land_messages, ingest.write_batch

    class Landing:
        def awaitTermination(self):
            found.append(spark.conf.get(OPEN_FILES_SETTING))
            self.stream.awaitTermination()

    def landing(*given):
        waits = Landing()
        waits.stream = land(*given)
        return waits

    def write(rows, batch_id, path, *more):
        found.append(rows.sparkSession.conf.get(OPEN_FILES_SETTING))
        write_batch(rows, batch_id, path, *more)

    monkeypatch.setattr(ingest, "land_messages", landing)
    assert reports._landed(spark, SMALL).count() > 0 and found == [str(OPEN_FILES)]
    monkeypatch.setattr(ingest, "write_batch", write)
    reports._ingest(spark, SMALL)
    assert found[1:3] == [str(OPEN_FILES)] * 2


# ---- ingestion ----

def test_nested_rows_end_where_they_become_messages(spark, no_automatic_broadcast):
    plan = _plan(fx.topic_rows(spark, SMALL))
    # No step above the exchange copies nested rows beside their message, and the message is made once.
    above = plan[:plan.index("- Exchange ")]
    assert "Generate" not in above and above.count("StructsToJson") == 1


def test_good_and_bad_messages_are_written_at_once(spark, tmp_path, monkeypatch):
    import threading

    from beaconlake.contracts import schema
    from beaconlake.sources import topic
    from beaconlake.streaming import ingest

    both, write_batch = threading.Barrier(2), ingest.write_batch

    def write(rows, batch_id, path, *more):
        if not path.endswith("_finished"):
            both.wait(60)
        write_batch(rows, batch_id, path, *more)

    monkeypatch.setattr(ingest, "write_batch", write)
    fx.topic_rows(spark, SMALL).write.parquet(str(tmp_path / "topic"))
    messages = topic.envelopes(topic.read_topic_files(spark, str(tmp_path / "topic")), "sub")
    out = [str(tmp_path / name) for name in ("raw", "bad")]
    ingest.ingest_events(messages, schema("raw_events"), *out, str(tmp_path / "checkpoint")).awaitTermination()
    stored = [spark.read.parquet(path).count() for path in out]
    assert all(stored) and sum(stored) == spark.read.parquet(str(tmp_path / "topic")).count()
    assert ingest.finished_batches(spark, out[0]).count() == 1


def test_a_batch_is_not_finished_when_a_write_fails(spark):
    from beaconlake.streaming import ingest

    ended = []

    def fails():
        raise ValueError("no space")

    with pytest.raises(ValueError, match="no space"):
        ingest.at_once(spark, fails, lambda: ended.append(spark.range(3).count()))
    assert ended == [3]


def test_read_messages_are_not_looked_through_again(spark):
    from pyspark.sql import functions as F

    from beaconlake.contracts import schema
    from beaconlake.sources import messages

    contract = schema("raw_events")
    good = '{"event_id": "e", "date": "2024-01-01", "timestamp": 5, "order" : {"id":":x", "value" :1}, "products":[{"id":"p"}]}'
    texts = {
        good: True,
        good.replace('"id":"p"', '"id":"p","value" : 2,"zip"  :3'): False,
        good.replace('"timestamp"', '"zip"\n:null,"timestamp"'): False,
        good.replace('"id":":x"', '"id":":x","event_id":1'): False,
        # Quotes inside a text and fields that are null are looked at in the slow way.
        good.replace('"id":":x"', '"id":"\\u0022:"'): False,
        good.replace('"id":":x"', '"id":null'): False,
    }
    rows = spark.createDataFrame([(text,) for text in texts], "data string")
    parsed = messages.parse_messages(rows, contract)
    found = {row.data: row.read for row in parsed.select("data", messages._all_read(F.col("data"), F.col("row")).alias("read")).collect()}
    assert found == texts
    strict = {row.data: row.reason for row in messages.parse_messages(rows, contract, drop_unknown_fields=False).collect()}
    assert list(strict.values()) == [
        None, "unknown fields: products[].zip", "unknown fields: zip", "unknown fields: order.event_id", None, None]


def test_missing_rows_are_found_from_the_keys(spark, tmp_path):
    from datetime import date

    from beaconlake.streaming import ingest

    days = [date(2024, 1, 1), date(2024, 1, 2), None]
    types = "event_id string, `date` date, note string"
    rows = spark.createDataFrame([(f"e{i % 40}" if i % 40 else None, days[i % 40 % 3], "new") for i in range(60)], types)
    once = rows.dropDuplicates(["date", "event_id"])
    stored = spark.createDataFrame([(f"e{i}", days[i % 3], "old") for i in range(10, 90)], types)

    def missing(rows, stored, name):
        found = ingest.missing_rows(rows, stored, str(tmp_path / name))
        got = sorted(map(str, found.collect()))
        return got, (tmp_path / name / "missing").exists()

    expected = [row for row in once.collect() if row.event_id is None or int(row.event_id[1:]) < 10 or row.date is None]
    assert missing(rows, stored, "some") == (sorted(map(str, expected)), True)
    assert missing(rows, None, "copies") == (sorted(map(str, once.collect())), True)
    # Nothing has to be left out, or everything: whole rows stay where they are.
    assert missing(once, None, "all") == (sorted(map(str, once.collect())), False)
    assert missing(rows.where("event_id is not null and `date` is not null and note = 'new'"), once, "none") == ([], False)


# ---- stored ids ----

def test_rows_with_an_id_of_their_own_stay_where_they_are(spark, monkeypatch, no_automatic_broadcast):
    from datetime import date

    from beaconlake.operators import seen

    day = date(2024, 1, 1)
    types, types_of = "event_id string, `date` date, `timestamp` bigint, note string", ("event_id", "date", "timestamp", "note")
    rows = [(f"e{i}", day, i, "one") for i in range(20)] + [("e3", day, 1, "first"), (None, day, 1, "x"), (None, day, 1, "x")]
    # The id is not the first column.
    events = spark.createDataFrame(rows, types).select("note", "event_id", "date", "timestamp")
    # A stored row that is earlier, one that is later, and one that no event names.
    stored = spark.createDataFrame([("e5", day, 4, 0), ("e6", day, 7, 0), ("z", day, 1, 0)], seen.SEEN)

    def found(events):
        return sorted((tuple(row) for row in seen.new_events(events, stored, 3).select(*types_of, "row_hash", "replaces").collect()), key=str)

    few = found(events)
    assert [row[0] for row in few if row[0]] == sorted(f"e{i}" for i in range(20) if i != 5)
    assert {row[0]: row[5] for row in few if row[5]} == {"e6": day} and sum(row[0] is None for row in few) == 2
    assert next(row[3] for row in few if row[0] == "e3") == "first"
    alone = _plan(seen.new_events(events.where("`timestamp` > 7"), stored, 3))
    assert "Exchange hashpartitioning" not in alone and "SortMergeJoin" not in alone
    monkeypatch.setattr(seen, "MAX_BROADCAST_ROWS", 0)
    assert found(events) == few
