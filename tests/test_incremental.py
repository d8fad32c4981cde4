"""Identity and attribution from changed dates against the full run."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from beaconlake.contracts import schema
from beaconlake.operators import attribution, bitmaps, commerce, costs, identity, quality, rollups, seen
from beaconlake.plans import incremental, loads, project, warehouse
from beaconlake.session import run_path
from beaconlake.streaming import ordering
from conftest import as_tuples

START = 1_704_067_200_000  # 2024-01-01
DAY_MS = 86_400_000


def event(number, day, name="view", avid=None, user=None, at=None, source=None, **fields):
    page = f"http://x.org/?utm_source={source}" if source else "http://x.org/"
    return {
        "event_id": str(number), "date": str(date(2024, 1, 1) + timedelta(days=day)), "event_name": name,
        "timestamp": START + day * DAY_MS + number if at is None else at, "avid": avid,
        "user_external_ids": [] if user is None else [{"key": "u", "value": user}],
        "event_params": [{"key": "landing_page_url", "value": {"string_value": page}}], **fields,
    }


@pytest.fixture
def store(spark, make_events):
    """A project; ``add`` saves events and brings identity and attribution up to date, ``full`` is the whole run."""
    number = uuid.uuid4().int % 10**12
    names = project.register_project(spark, number, run_path(spark, "project"), buckets=4)
    database = names["database"]

    class Store:
        raw, identified, attributed = (names[n] for n in ("raw_events", "identified_events", "attributed_events"))
        name = database

        @staticmethod
        def add(*events, overwrite=False, **options):
            rows = make_events(list(events))
            warehouse.save_rows(spark, rows, names["raw_events"], overwrite)
            loads.note_dates(spark, names["raw_events"], [r[0] for r in rows.select("date").distinct().collect()])
            return Store.update(**options)

        @staticmethod
        def update(attribute=True, **options):
            changed = incremental.identify_dates(spark, database, inserted_at=F.lit(1))
            return changed, incremental.attribute_dates(spark, database, **options) if attribute else []

        @staticmethod
        def profiles():
            return as_tuples(spark.table(Store.identified), "event_id", "date", "profile_id")

        @staticmethod
        def conversions():
            return as_tuples(spark.table(Store.attributed), "event_id", "date", "key", "touch_event_id", "source")

        @staticmethod
        def check(events=("purchase",), model="last_touch", lookback=7, attribute=True):
            once = quality.dedupe_events(spark.table(Store.raw))
            identified = identity.identify_events(once, F.lit(1))
            assert Store.profiles() == as_tuples(identified, "event_id", "date", "profile_id")
            if not attribute:
                return
            full = attribution.attribute_events(
                identified, list(events), model, lookback, excluded=spark.table(names["excluded_referrers"])
            )
            assert Store.conversions() == as_tuples(full, "event_id", "date", "key", "touch_event_id", "source")

    yield Store
    spark.sql(f"DROP DATABASE `{database}` CASCADE")


def test_new_links_rename_profiles_on_old_dates_only_where_needed(spark, store):
    changed, _ = store.add(event(1, 0, avid="m"), event(2, 0, avid="z"), event(3, 1, avid="z", user="u1"), event(4, 2, avid="q"), attribute=False)
    assert len(changed) == 3
    store.check(attribute=False)
    # The raw rows of the first dates are gone: what follows does not read them.
    before = as_tuples(spark.table(store.raw), "event_id")
    spark.sql(f"ALTER TABLE {store.raw} DROP PARTITION (`date` = '2024-01-03')")
    changed, _ = store.add(event(5, 5, avid="m", user="u1"), attribute=False)
    assert changed == [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 6)]
    assert {(e, p) for e, _, p in store.profiles()} == {
        ("1", "avid:m"), ("2", "avid:m"), ("3", "avid:m"), ("5", "avid:m"), ("4", "avid:q"),
    }
    # A smaller name for all of them, by a node that no new event names.
    changed, _ = store.add(event(6, 6, avid="a", user="u1"), attribute=False)
    assert {p for e, _, p in store.profiles() if e != "4"} == {"avid:a"} and len(before) == 4
    assert date(2024, 1, 3) not in changed
    store.add(event(7, 7, avid="z"), attribute=False)
    assert ("7", date(2024, 1, 8), "avid:a") in store.profiles()


def test_copies_across_dates_leave_the_first(spark, store):
    store.add(event(1, 3, avid="a"), event(2, 3, avid="a"), attribute=False)
    changed, _ = store.add(event(1, 1, avid="a"), event(2, 5, avid="a"), attribute=False)
    assert changed == [date(2024, 1, 2), date(2024, 1, 4), date(2024, 1, 6)]
    store.check(attribute=False)
    assert [(e, d.day) for e, d, _ in store.profiles()] == [("1", 2), ("2", 4)]
    # The same dates again change nothing.
    loads.note_dates(spark, store.raw, [date(2024, 1, 2), date(2024, 1, 4)])
    store.update(attribute=False)
    store.check(attribute=False)


def test_a_late_touch_reaches_the_conversions_behind_it(spark, store):
    buy = {"name": "purchase", "order": {"value": 1.0}}
    _, out = store.add(event(1, 0, avid="a", source="s1"), event(10, 4, avid="a", **buy), event(11, 9, avid="a", **buy), event(12, 30, avid="a", **buy))
    store.check()
    _, out = store.add(event(2, 3, avid="a", source="s2"))
    assert out == [date(2024, 1, 4), date(2024, 1, 5), date(2024, 1, 10)]
    store.check()
    assert [c[3] for c in store.conversions()] == ["2", "2", None]
    assert store.update() == ([], [])


def test_dates_of_senders_may_differ_from_the_day(spark, store):
    buy = {"name": "purchase", "order": {"value": 1.0}}
    store.add(
        event(1, 2, avid="a", source="s1", at=START + DAY_MS - 5), event(2, 1, avid="a", at=START + DAY_MS - 1, **buy),
        event(3, 0, avid="a", at=START + 40 * DAY_MS, **buy), event(4, 0, avid="a", at=None, **buy),
    )
    store.check()
    store.add(event(5, 20, avid="a", source="s5", at=START + 39 * DAY_MS), event(6, 21, avid="b", source="s6"))
    store.check()


def test_a_date_without_conversions_loses_its_rows(spark, store, make_events):
    buy = {"name": "purchase", "order": {"value": 1.0}}
    store.add(event(1, 0, avid="a", source="s"), event(2, 1, avid="a", **buy), event(3, 2, avid="a", **buy))
    store.add(event(4, 1, avid="a"), overwrite=True)
    assert [c[0] for c in store.conversions()] == ["3"]
    assert incremental.partition_dates(spark, store.attributed) == [date(2024, 1, 3)]
    # Other conversion events: nothing of the old ones stays.
    _, out = store.add(event(5, 1, name="signup", avid="a"), conversion_events=("signup",))
    assert [c[0] for c in store.conversions()] == ["5"] and len(out) == 3
    store.check(("signup",))


@pytest.mark.parametrize("model, lookback", [("last_touch", 7), ("first_touch", 1)])
def test_many_parts_give_the_full_run(spark, store, model, lookback):
    import random

    random_ = random.Random(5)
    events = []
    for n in range(160):
        day = random_.randrange(20)
        avid = f"v{random_.randrange(9)}" if random_.random() < 0.9 else None
        user = f"u{random_.randrange(7)}" if random_.random() < 0.3 else None
        at = START + (day + random_.choice([-1, 0, 0, 0, 1])) * DAY_MS + random_.randrange(DAY_MS)
        name = random_.choice(["view", "click", "purchase", "signup"])
        events.append(event(n, day, name, avid, user, at, random_.choice(["s", "t", None])))
    random_.shuffle(events)
    copies = [{**e, "timestamp": e["timestamp"] + random_.choice([-50, 50])} for e in events[:20]]
    events += copies
    for i in range(2):
        store.add(*events[i * 90:(i + 1) * 90], model=model, lookback_days=lookback)
    store.check(model=model, lookback=lookback)


def test_a_run_that_fails_is_repeated(spark, store, monkeypatch):
    store.add(event(1, 0, avid="m"), event(2, 1, avid="z", user="u"), attribute=False)
    real = incremental.replace_dates

    def fail(*arguments, **options):
        real(*arguments, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "replace_dates", fail)
    with pytest.raises(RuntimeError):
        store.add(event(3, 2, avid="m", user="u"), attribute=False)
    monkeypatch.undo()
    store.update(attribute=False)
    store.check(attribute=False)
    assert {p for _, _, p in store.profiles()} == {"avid:m"}


def test_versions_are_folded(spark, store, monkeypatch):
    monkeypatch.setattr(incremental, "VERSIONS_TO_FOLD", 1)
    for n in range(3):
        store.add(event(n, n, avid=f"v{n}", user="u" if n % 2 else None), attribute=False)
    store.check(attribute=False)
    assert len(incremental._versions(spark, f"{store.name}.identity_nodes")) == 2


def test_stored_nodes_are_not_shuffled(spark, store):
    store.add(event(1, 0, avid="a", user="u"))
    named = spark.createDataFrame([("avid:a",)], "node string").distinct()
    given = spark.table(f"{store.name}.identity_nodes").groupBy("node").agg(F.min("profile_id").alias("profile_id"))
    text = seen.meet_buckets(named, "node", 4).join(given.hint("merge"), "node")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 2 and text.count("Exchange hashpartitioning(node") == 2 and "Bucketed: true" in text
    assert text.index("Bucketed: true") > text.rindex("Exchange")


# ---- roll-ups from days ----

def test_bitmaps_count_like_events(spark):
    rows = [
        (date(2024, 1, 1 + n % 5), ("Europe" if n % 3 else None, ["DE", "FR", None][n % 3], f"c{n % 4}"), f"p{n * n % 37}" if n % 11 else None)
        for n in range(400)
    ]
    events = spark.createDataFrame(rows, "`date` date, geo struct<continent:string,country:string,city:string>, profile_id string")
    numbers = bitmaps.number_profiles(events, parts=4).cache()
    assert sorted(r.number for r in numbers.collect())[0] >= 0
    assert numbers.select("number").distinct().count() == numbers.count() == events.select("profile_id").where("profile_id is not null").distinct().count()
    daily = bitmaps.daily_profiles(events, numbers, bitmaps.GEO)
    for first, last in ((1, 5), (2, 3), (4, 4)):
        inside = F.col("date").between(date(2024, 1, first), date(2024, 1, last))
        wanted = rollups.geo_rollup(events.where(inside))
        found = bitmaps.rollup_days(daily.where(inside), tuple(bitmaps.GEO))
        columns = ("continent", "country", "city", "level", "events", "profiles")
        assert as_tuples(found, *columns) == as_tuples(wanted, *columns)


def test_later_profiles_get_numbers_of_their_own(spark):
    def named(*ids):
        return spark.createDataFrame([(i,) for i in ids], "profile_id string")

    first = bitmaps.number_profiles(named(*[f"p{i}" for i in range(50)], None), parts=4).cache()
    later = bitmaps.number_profiles(named(*[f"p{i}" for i in range(40, 120)]), first, parts=4).cache()
    assert as_tuples(later, "profile_id") == sorted((f"p{i}",) for i in range(50, 120))
    both = first.unionByName(later)
    assert both.select("number").distinct().count() == 120
    # Dense: parts differ by chance only.
    assert both.agg(F.max("number")).first()[0] < 4 * 120


# ---- order ----

def test_events_go_out_in_order_whatever_the_batches(spark, tmp_path):
    import random

    random_ = random.Random(2)
    minute = 60_000
    rows = [(f"k{i % 3}", START + random_.randrange(200) * minute, f"e{i:03}") for i in range(150)]
    rows += [("k0", rows[0][1], "e000x"), (None, START, "lost"), ("k0", None, "untimed")]
    path = str(tmp_path / "in")
    timed = sorted((r for r in rows if r[1] is not None), key=lambda r: r[1] + random_.randrange(30) * minute)
    timed += [("end", START + 400 * minute, "end")]
    types = "key string, timestamp bigint, event_id string"
    for i in range(0, len(timed), 40):
        part = timed[i:i + 40]
        random_.shuffle(part)
        spark.createDataFrame(part, types).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(types).option("maxFilesPerTrigger", 1).parquet(path)
    ordered = ordering.ordered_by_key(stream, "key", "30 minutes")
    for _ in range(2):
        # A restart adds nothing.
        ordered.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    found = as_tuples(spark.read.parquet(str(tmp_path / "out")), "key", "position", "event_id")
    wanted = []
    for key in ("k0", "k1", "k2"):
        mine = sorted((at, e) for k, at, e in rows if k == key and at is not None)
        wanted += [(key, i + 1, e) for i, (_, e) in enumerate(mine)]
    assert sorted(found) == sorted(wanted)


# ---- amounts and uploads ----

def test_one_amount_does_not_stop_a_report(spark):
    spent = spark.createDataFrame([("s", 1.5, 1, 1, 1), ("s", 1e33, 1, 1, 1), ("s", float("nan"), 1, 1, 1)], "source string, cost double, impressions bigint, clicks bigint, reach bigint")
    earned = spark.createDataFrame([("s", 2.0), ("s", 1e33)], "source string, value double")
    row = rollups.campaign_performance(spent, earned, ("source",), report_left_out=True).first()
    assert (row.cost, row.revenue, row.conversions, row.left_out) == (1.5, 2.0, 2, 3)
    assert "left_out" not in rollups.campaign_performance(spent, earned, ("source",)).columns
    states = spark.createDataFrame([("USD", 1e33, 1.0), ("USD", 5.0, None)], "currency string, paid_value double, refund_value double")
    row = commerce.balance_by_currency(states, report_left_out=True).first()
    assert (row.records, row.paid_value, row.refund_value, row.net_value, row.left_out) == (2, 5.0, 1.0, 4.0, 1)


def test_uploads_without_files_or_with_odd_names(spark, tmp_path):
    good, bad = costs.load_manual_costs(spark, str(tmp_path))
    assert good.count() == bad.count() == 0 and set(good.columns) == set(schema("ad_costs").names)
    for i in range(5):
        (tmp_path / f"part {i}%20.csv").write_text("date,cost\n2024-01-01,1\n" if i % 2 else "cost,date\n2,2024-01-02\n")
    good, _ = costs.load_manual_costs(spark, str(tmp_path))
    assert as_tuples(good, "date", "cost") == [(date(2024, 1, 1), 1.0)] * 2 + [(date(2024, 1, 2), 2.0)] * 3
