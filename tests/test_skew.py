"""Operators with a key that holds a large share of the rows, against brute force."""

from __future__ import annotations

import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from beaconlake.operators import attribution, checks, costs, quality, skew
from conftest import as_tuples

DAY = attribution.DAY_MS


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_join(spark, how, null_safe):
    keys = [1] * 40 + [2] * 30 + [None] * 30 + list(range(3, 20))
    big = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    small = spark.createDataFrame([(1, "a"), (3, "c"), (7, "g"), (None, "n"), (99, "z")], "k int, v string")
    split = skew.lookup_join(big, small, ["k"], how, null_safe=null_safe, max_group_rows=10)
    plain = skew.lookup_join(big, small, ["k"], how, null_safe=null_safe, look_for_heavy=False)
    assert skew.heavy_keys(big, ["k"], 10).count() == 3
    assert split.columns == plain.columns
    assert as_tuples(split, *split.columns) == as_tuples(plain, *plain.columns)
    matched = {1, 3, 7} | ({None} if null_safe else set())
    wanted = {"inner": matched.__contains__, "left": lambda k: True, "left_semi": matched.__contains__,
              "left_anti": lambda k: k not in matched}[how]
    assert sorted(r["i"] for r in split.collect()) == [i for i, k in enumerate(keys) if wanted(k)]


def test_small_lookup_join_beyond_its_limit(spark):
    big = spark.createDataFrame([(i % 7,) for i in range(50)], "k int")
    small = spark.createDataFrame([(i, str(i)) for i in range(5)], "k int, v string")
    inside = skew.small_lookup_join(big, small, ["k"], max_rows=10)
    beyond = skew.small_lookup_join(big, small, ["k"], max_rows=2)
    assert as_tuples(inside, "k", "v") == as_tuples(beyond, "k", "v")


@pytest.mark.parametrize("limit", [1_000_000, 7])
def test_running(spark, limit):
    rng = random.Random(1)
    rows = [(rng.choice("aaab") if i % 3 else f"u{i}", rng.randrange(30), i, rng.choice([None, 1, 2, 5]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, i int, v int")
    heavy = skew.heavy_keys(df, ["k"], limit)
    assert (heavy is None) == (limit > 300)
    found = skew.running(
        df, ["k"], [F.col("t"), F.col("i").desc()],
        {"total": ("sum", F.col("v")), "latest": ("last", F.col("v"))}, heavy, limit,
    )
    wanted = []
    by_key = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[1], -r[2])):
        seen = by_key[row[0]]
        seen.append(row[3])
        known = [v for v in seen if v is not None]
        wanted.append((row[2], sum(known) if known else None, known[-1] if known else None))
    assert as_tuples(found, "i", "total", "latest") == sorted(wanted, key=lambda t: tuple(map(str, t)))


def _history(size: int = 400, seed: int = 3) -> list[dict]:
    """A busy key with a third of the rows, many equal times, keyless events and quiet keys."""
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        key = "hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{rng.randrange(40)}"
        name = rng.choice(["view", "click", "purchase", "purchase", "other"])
        moment = rng.choice([0, 1, 5, 9]) * DAY + rng.randrange(3) * rng.choice([1, DAY])
        params = []
        if rng.random() < 0.8:
            params = [{"key": "referrer_url", "value": {"string_value": f"https://s{rng.randrange(4)}.example/"}}]
        rows.append({"event_id": f"e{rng.randrange(10**9)}-{i}", "event_name": name, "timestamp": moment,
                     "date": "2024-01-01", "profile_id": key, "event_params": params,
                     "order": {"value": round(rng.random() * 100, 2)} if name == "purchase" else None})
    return rows


def _in_reach(rows: list[dict], days: int) -> dict[str, list[dict]]:
    touches = [r for r in rows if r["event_name"] in ("view", "click") and r["event_params"]]
    reach = {}
    for c in rows:
        if c["event_name"] != "purchase":
            continue
        mine = [t for t in touches if c["profile_id"] is not None and t["profile_id"] == c["profile_id"]
                and (t["timestamp"], t["event_id"]) < (c["timestamp"], c["event_id"])
                and c["timestamp"] - t["timestamp"] <= days * DAY]
        reach[c["event_id"]] = sorted(mine, key=lambda t: (t["timestamp"], t["event_id"]))
    return reach


@pytest.mark.parametrize("limit", [1_000_000, 15])
@pytest.mark.parametrize("model", ["last_touch", "first_touch"])
def test_single_touch_models(make_events, model, limit):
    rows = _history()
    found = attribution.attribute_events(
        make_events(rows, "identified_events"), "purchase", model, lookback_days=2, max_group_rows=limit
    )
    reach = _in_reach(rows, 2)
    place = -1 if model == "last_touch" else 0
    wanted = [(c, ts[place]["event_id"] if ts else None) for c, ts in reach.items()]
    assert as_tuples(found, "event_id", "touch_event_id") == sorted(wanted, key=lambda t: tuple(map(str, t)))


@pytest.mark.parametrize("limit", [1_000_000, 15])
@pytest.mark.parametrize("model", ["linear", "position"])
def test_shared_models(make_events, model, limit):
    rows = _history()
    values = {r["event_id"]: r["order"]["value"] for r in rows if r["order"]}
    credit, money, unattributed = defaultdict(Fraction), defaultdict(Fraction), set()
    for conversion, touches in _in_reach(rows, 2).items():
        if not touches:
            unattributed.add(conversion)
        for place, touch in enumerate(touches):
            n = len(touches)
            if model == "linear" or n <= 2:
                share = Fraction(1, n)
            else:
                share = Fraction(2, 5) if place in (0, n - 1) else Fraction(1, 5) / (n - 2)
            credit[touch["event_id"]] += share
            money[touch["event_id"]] += share * Fraction(str(values[conversion]))
    found = attribution.attribute_events(
        make_events(rows, "identified_events"), "purchase", model, lookback_days=2, max_group_rows=limit
    ).collect()
    earned = {r["event_id"]: r for r in found if r["source"] is not None}
    assert set(earned) == set(credit)
    for touch, row in earned.items():
        assert row["conversions"] == pytest.approx(float(credit[touch]), abs=1e-6)
        assert row["value"] == pytest.approx(float(money[touch]), abs=1e-5)
    assert {r["event_id"] for r in found if r["source"] is None} == unattributed


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_dedupe_keeps_the_first_copy(make_events, limit):
    rows = [{"event_id": f"e{i}", "timestamp": 10, "event_name": "first"} for i in range(20)]
    rows += [{"event_id": "e0", "timestamp": 11 + i, "event_name": "copy"} for i in range(15)]
    rows += [{"event_id": "e1", "timestamp": 10, "event_name": "first"} for _ in range(9)]
    rows += [{"event_id": None, "timestamp": 1, "event_name": "no id"} for _ in range(3)]
    broadcast_rows = 100 if limit > 5 else 0
    found = quality.dedupe_events(make_events(rows), max_group_rows=limit, max_broadcast_rows=broadcast_rows)
    wanted = [("first", f"e{i}", 10) for i in range(20)] + [("no id", None, 1)] * 3
    assert as_tuples(found, "event_name", "event_id", "timestamp") == sorted(wanted, key=lambda t: tuple(map(str, t)))


def test_newest_snapshot_of_a_busy_account(spark):
    rows = [(s, "2024-01-01", "busy", f"ad{i}", float(i)) for i in range(30) for s in (1, 2)]
    rows += [(1, "2024-01-01", None, "nobody", 1.0), (7, "2024-01-02", "busy", "next", 1.0)]
    columns = "inserted_at bigint, date string, ad_account_id string, ad_id string, cost double"
    network = spark.createDataFrame(rows, columns)
    network = network.withColumn("date", F.to_date("date"))
    for limit, broadcast_rows in ((1_000_000, 100), (1_000_000, 0), (10, 0)):
        current = costs.update_network_costs(
            network, "tiktok_ads", max_group_rows=limit, max_broadcast_rows=broadcast_rows
        )
        assert current.count() == 32
        assert {r["data_source"] for r in current.collect()} == {"tiktok_ads"}


def test_costs_without_visits_compares_nulls(spark):
    text = "date string, source string, medium string, campaign string, content string, term string, cost double"
    rows = [("d", "s", None, "c", None, None, 1.0)] * 20 + [("d", "s", None, "x", None, None, 1.0),
                                                            ("d", "s", None, "y", None, None, 0.0)]
    visits = spark.createDataFrame([("d", "s", None, "c", None, None, 0.0)], text)
    for limit in (1_000_000, 5):
        found = checks.check_costs_without_visits(spark.createDataFrame(rows, text), visits, limit)
        assert as_tuples(found, "campaign") == [("x",)]
