from __future__ import annotations

import random

import pytest

from beaconlake.contracts import schema
from beaconlake.operators import identity
from beaconlake.operators.quality import contract_diff
from conftest import as_tuples


def _components(pairs: list[tuple[str, str]]) -> dict[str, str]:
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in parent}


def _edges(spark, pairs):
    return spark.createDataFrame(
        sorted({(max(p), min(p)) for p in pairs}), "larger string, smaller string"
    )


@pytest.mark.parametrize("limit", [1_000_000, 20])
@pytest.mark.parametrize("shape", ["chain", "star", "random", "cycle"])
def test_components(spark, shape, limit):
    rng = random.Random(5)
    names = [f"n{i:03d}" for i in range(120)]
    rng.shuffle(names)
    if shape == "chain":
        pairs = list(zip(names, names[1:]))
    elif shape == "star":
        pairs = [(names[0], n) for n in names[1:]]
    elif shape == "cycle":
        pairs = list(zip(names, names[1:] + names[:1]))
    else:
        pairs = [tuple(rng.sample(names, 2)) for _ in range(70)]
    found = {r["node"]: r["profile_id"] for r in identity.components(_edges(spark, pairs), limit).collect()}
    assert found == _components(pairs)


def _event(event_id: str, avid: str | None, *external: str, **more) -> dict:
    return {"event_id": event_id, "avid": avid,
            "user_external_ids": [{"key": "crm", "value": value} for value in external], **more}


def test_events_without_identifiers_and_empty_input(spark, make_events):
    events = make_events([_event("1", "v1", "x"), _event("2", "v2", "x"), _event("3", "v3"), {"event_id": "4"}])
    found = identity.identify_events(events)
    assert found.columns == schema("identified_events").names
    assert contract_diff(found, schema("identified_events")) == []
    assert as_tuples(found, "event_id", "profile_id") == [
        ("1", "avid:v1"), ("2", "avid:v1"), ("3", "avid:v3"), ("4", None),
    ]
    assert identity.identity_components(events).count() == 4
    assert identity.identify_events(events.limit(0)).count() == 0


def test_an_identifier_shared_by_many(make_events):
    shared = [_event(str(i), f"v{i:04d}", "shared") for i in range(1001)]
    events = make_events([*shared, _event("last", "v0000", "own")])
    everyone = identity.identify_events(events, max_group_rows=300)
    assert everyone.select("profile_id").distinct().count() == 1


def test_contacts_are_off_by_default(make_events):
    events = make_events([
        _event("1", "v1", user_data={"email": " A@B.example "}), _event("2", "v2", user_data={"email": "a@b.example"}),
        _event("3", "v3", user_data={"phone_number": "+1 (2) 3"}), _event("4", "v4", user_data={"phone_number": "123"}),
    ])
    assert identity.identify_events(events).select("profile_id").distinct().count() == 4
    linked = identity.identify_events(events, use_contacts=True)
    assert as_tuples(linked, "event_id", "profile_id") == [
        ("1", "avid:v1"), ("2", "avid:v1"), ("3", "avid:v3"), ("4", "avid:v3"),
    ]


def test_new_links_give_the_same_profiles_as_all_links_at_once(spark):
    rng = random.Random(9)
    names = [f"n{i:02d}" for i in range(60)]
    old = [tuple(rng.sample(names[:50], 2)) for _ in range(30)]
    new = [tuple(rng.sample(names, 2)) for _ in range(15)]
    before = identity.components(_edges(spark, old))
    after, aliases = identity.extend_profiles(before, _edges(spark, new))
    wanted = _components(old + new)
    assert dict(as_tuples(after, "node", "profile_id")) == wanted
    renamed = {(a, wanted[a]) for a in set(_components(old).values()) if wanted[a] != a}
    assert set(as_tuples(aliases, "old_profile_id", "profile_id")) == renamed
