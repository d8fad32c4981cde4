from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from beaconlake.contracts import COLUMNS, schema
from beaconlake.functions import urls
from beaconlake.functions.params import ad_value, param, string_value
from beaconlake.operators import checks, commerce, flatten, quality, referrers
from conftest import as_tuples


def test_contract_sizes(spark):
    sizes = {table: len(schema(table)) for table in COLUMNS}
    assert sizes == {
        "raw_events": 18, "identified_events": 20, "ad_costs": 25, "facebook_ads_ad_costs": 27,
        "google_ads_ad_costs": 22, "tiktok_ads_ad_costs": 21, "event_messages": 5,
    }
    assert "acme_avid" in schema("raw_events", "acme_").names
    assert "acme_refid" in schema("ad_costs", "acme_").names


def test_contract_diff(spark):
    df = spark.createDataFrame([(1, "x")], "event_id int, other string")
    expected = schema("raw_events")
    found = quality.contract_diff(df, expected)
    assert ("extra", "other", None, "string") in found
    assert ("type", "event_id", "string", "int") in found
    assert ("missing", "geo.city", "string", None) in found
    assert quality.contract_diff(spark.createDataFrame([], expected), expected) == []


def test_lookups_take_the_first_and_survive_empty_lists(make_events):
    events = make_events([
        {"event_id": "1", "event_params": [
            {"key": "a", "value": {"int_value": 1}}, {"key": "a", "value": {"int_value": 2}},
        ], "user_external_ids": [{"key": "crm", "value": "x"}], "ad_data": [
            {"ad_network": "n1", "values": [{"key": "k1", "value": "v1"}, {"key": "k2", "value": "v2"}]},
            {"ad_network": "n2", "values": [{"key": "k1", "value": "v3"}, {"key": "k2", "value": "v4"}]},
        ]},
        {"event_id": "2", "event_params": []},
        {"event_id": "3"},
    ])
    found = events.select(
        "event_id", param("event_params", "a", "int_value").alias("a"),
        string_value("user_external_ids", "crm").alias("crm"), ad_value("ad_data", "n2", "k2").alias("ad"),
    )
    assert as_tuples(found, "event_id", "a", "crm", "ad") == [
        ("1", 1, "x", "v4"), ("2", None, None, None), ("3", None, None, None),
    ]
    assert flatten.ad_data_flat(events).count() == 4


def test_urls(spark):
    cases = {
        "http://a b/": (None, None, []),
        "some-site.com": (None, "some-site.com", []),
        "": (None, None, []),
        "?x=%zz": (None, None, [("x", "%zz")]),
        "https://A.example:80/p?x=%zz&q=f%20d&y=1=2&z#f": (
            "a.example", "a.example", [("x", "%zz"), ("q", "f d"), ("y", "1=2"), ("z", "")]
        ),
        "https://some-site.com/": ("some-site.com", "some-site.com", []),
        "Some-Site.com/page": (None, "some-site.com", []),
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    rows = df.select(
        "u", urls.host(F.col("u")), urls.host_or_text(F.col("u")), urls.query_params(F.col("u"))
    ).collect()
    found = {r[0]: (r[1], r[2], [(p["key"], p["value"]["string_value"]) for p in r[3]]) for r in rows}
    assert found == cases
    one = df.where("u like 'https://A%'").select(
        urls.query_value(F.col("u"), "q"), urls.query_value(F.col("u"), "z"), urls.path(F.col("u"))
    ).first()
    assert tuple(one) == ("f d", None, "/p")


def _visit(event_id: str, landing: str | None, referrer: str | None) -> dict:
    params = [("landing_page_url", landing), ("referrer_url", referrer)]
    return {"event_id": event_id, "event_params": [
        {"key": k, "value": {"string_value": v}} for k, v in params if v is not None
    ]}


def test_sources(spark, make_events):
    events = make_events([
        _visit("utm", "https://shop.example/?utm_source=feed&utm_medium=cpc&utm_campaign=c", "https://other.example/"),
        _visit("referral", "https://shop.example/", "https://other.example/x"),
        _visit("own", "https://shop.example/", "https://shop.example/x"),
        _visit("excluded", "https://shop.example/", "https://some-site.com/x"),
        _visit("bare", "https://shop.example/", "http://bare.example/x"),
        _visit("direct", "https://shop.example/", None),
        _visit("no landing", None, "https://other.example/x"),
    ])
    excluded = spark.sql("select array('https://some-site.com/', 'bare.example') as hosts")
    assert as_tuples(referrers.with_source(events, excluded), "event_id", "source", "medium", "campaign") == [
        ("bare", None, None, None), ("direct", None, None, None), ("excluded", None, None, None),
        ("no landing", "other.example", "referral", None), ("own", None, None, None),
        ("referral", "other.example", "referral", None), ("utm", "feed", "cpc", "c"),
    ]
    assert as_tuples(referrers.external_referrals(events, excluded), "event_id") == [
        ("no landing",), ("referral",), ("utm",)
    ]
    assert referrers.external_referrals(events, None).count() == 5


def test_product_lines_with_missing_discounts(make_events):
    events = make_events([
        {"event_id": "1", "products": [
            {"id": "a", "quantity": 2, "value": 10.0}, {"id": "b", "value": 10.0, "discount_percentage": 50.0},
            {"id": "c", "quantity": 1, "value": 10.0, "discount_amount": 3.0},
        ]},
        {"event_id": "2", "products": []},
    ])
    assert as_tuples(flatten.product_lines(events), "event_id", "product_id", "net_value") == [
        ("1", "a", 20.0), ("1", "b", 5.0), ("1", "c", 7.0), ("2", None, None),
    ]


def test_order_states_and_links(make_events):
    def state(event_id, timestamp, **columns):
        return {"event_id": event_id, "timestamp": timestamp, **columns}

    events = make_events([
        state("e1", 1, order={"id": "o1", "status": "created", "currency": "USD"}),
        state("e2", 2, order={"id": "o1", "status": "paid", "paid_value": 10.0, "currency": "USD"}),
        state("e3", 3, order={"id": "o1", "status": "part-refunded", "paid_value": 10.0, "refund_value": 2.5,
                              "currency": "USD"}),
        state("e4", 1, deal={"id": "d1", "status": "won"}),
        state("e5", 1, deal={"id": "d2", "status": "lost"}),
        state("e6", 5, transaction={"id": "t1", "order_id": "o1", "deal_id": "d1"}),
        state("e7", 5, transaction={"id": "t2", "deal_id": "d2"}),
        state("e8", 5, transaction={"id": "t3", "order_id": "gone"}),
    ])
    orders = commerce.latest_state(events, "order")
    assert as_tuples(orders, "id", "status", "state_event_id") == [("o1", "part-refunded", "e3")]
    assert as_tuples(commerce.balance_by_currency(orders), "currency", "records", "net_value") == [("USD", 1, 7.5)]
    wanted = [
        ("t1", "part-refunded", True, "won", True), ("t2", None, False, "lost", True), ("t3", None, False, None, False),
    ]
    for limit in (1_000_000, 1):
        links = commerce.transaction_links(events, max_group_rows=limit)
        assert as_tuples(
            links, "transaction_id", "order_status", "has_order", "deal_status", "has_deal"
        ) == wanted


def test_variant_slots(make_events):
    two = {"key": "k", "value": {"string_value": "a", "int_value": 1}}
    one = {"key": "k", "value": {"string_value": "a"}}
    events = make_events([
        {"event_id": "1", "event_params": [one, two], "order": {"custom_params": [two]}},
        {"event_id": "2", "event_params": [one, {"key": "none", "value": None}]},
        {"event_id": "3"},
    ])
    assert as_tuples(quality.variant_slot_violations(events), "event_id", "list", "slots_set") == [
        ("1", "event_params", 2), ("1", "order.custom_params", 2),
    ]


def test_local_dates_across_midnight(make_events):
    late = 1704067199000  # 2023-12-31 23:59:59 UTC
    events = make_events([
        {"event_id": "west", "date": "2023-12-31", "timestamp": late,
         "device_info": {"timezone_offset_seconds": -3600}},
        {"event_id": "east", "date": "2023-12-31", "timestamp": late, "device_info": {"timezone_offset_seconds": 3600}},
        {"event_id": "none", "date": "2023-12-31", "timestamp": late},
        {"event_id": "old", "date": "1969-12-31", "timestamp": -1},
    ])
    assert as_tuples(quality.local_dates(events), "event_id", "local_date", "date_differs") == [
        ("east", date(2024, 1, 1), True), ("none", date(2023, 12, 31), False), ("old", date(1969, 12, 31), False),
        ("west", date(2023, 12, 31), False),
    ]
    berlin = quality.local_dates(events, "Europe/Berlin").where("event_id = 'none'")
    assert as_tuples(berlin, "local_date", "date_differs") == [(date(2024, 1, 1), True)]


def test_real_events(make_events):
    events = make_events([
        {"event_id": "1", "is_test_event": True}, {"event_id": "2", "is_test_event": False}, {"event_id": "3"},
    ])
    assert as_tuples(quality.real_events(events), "event_id") == [("2",), ("3",)]


def test_ignored_filters(make_events):
    def event(event_id, name, *params):
        return {"event_id": event_id, "event_name": name,
                "event_params": [{"key": k, "value": {"string_value": v}} for k, v in params]}

    events = make_events([
        event("1", "a"), event("2", "b", ("k", "x")), event("3", "b", ("k", "y")), event("4", "b"),
        {"event_id": "5", "event_name": None},
    ])
    assert checks.drop_ignored(events, []).count() == 5
    assert as_tuples(checks.drop_ignored(events, [("a", None, None), ("b", "k", "x")]), "event_id") == [
        ("3",), ("4",), ("5",),
    ]
    assert as_tuples(checks.drop_ignored(events, [("b", "k", None)]), "event_id") == [("1",), ("4",), ("5",)]
