"""The ledger scan against plain matching, and what a second run scans."""

from __future__ import annotations

import re

import pytest

from beaconlake.llm import common, secrets
from beaconlake.session import run_path

TEXTS = [
    "", None, "password=secret=abcdef token: token: abcdefgh", "é\U0001f600 AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 13 + " AKIA" + "C" * 15,
    "ghp_" + "a" * 36 + " x " + "0123456789abcdef" * 2, "://u:p@h ://:@ -----BEGIN RSA PRIVATE KEY-----\nMIIE\n-----END RSA PRIVATE KEY-----",
    "eyJ" + "a" * 20 + ".eyJ" + "b" * 9 + "." + "c" * 8, "Api_Key' = 'ABCDEFG', apikey:x PASSWD=123456 tokens = abcdefg",
    "xoxb-1234567890ab AIza" + "b" * 35 + " sk_live_" + "4" * 16, "A clean page about passwords, tokens and a secret.", "f" * 23 + " " + "f" * 24,
]


def plain(text, rules=secrets.RULES):
    spans = []
    for no, rule in enumerate(rules):
        for match in re.finditer(rule.pattern, text or ""):
            if not rule.least or len(match.group(rule.group)) >= rule.least:
                spans.append((match.start(), no, rule.name, match.end()))
    return sorted(spans)


def history(spark, rows):
    return spark.createDataFrame(rows, "path string, version int, text string, blob string")


def spans(scanned):
    return {(r.path, r.version): [tuple(s) for s in r.spans] for r in scanned.collect()}


@pytest.mark.parametrize("limit", [common.BROADCAST_ROWS, -1])
def test_against_plain_matching(spark, monkeypatch, limit):
    """Also without broadcasts, with a group of copies kept in place."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(secrets, "MAX_COPIES", 10)
    rows = [(f"p{i}", 0, text, "x") for i, text in enumerate(TEXTS)] + [(f"copy{i}", 1, TEXTS[2], "x") for i in range(40)]
    rows += [(None, None, TEXTS[4], "x"), ("p5", 0, TEXTS[5], "x"), ("p5", 1, TEXTS[7], "x")]
    found = secrets.scan_history(history(spark, rows), run_path(spark, "ledger"))
    assert found.count() == len(rows)
    assert spans(found) == {(path, version): plain(text) for path, version, text, _ in rows}


def test_clean_text_has_no_findings(spark):
    assert plain(TEXTS[9]) == []
    found = secrets.scan_history(history(spark, [("p", 0, TEXTS[9], "")]), run_path(spark, "ledger")).first()
    assert found.spans == []


def scanned_pairs(spark, ledger):
    return sorted((bytes(r.blob), v) for r in secrets.read_ledger(spark, ledger).collect() for v in r.versions)


def test_a_run_scans_only_what_the_ledger_lacks(spark):
    ledger = run_path(spark, "ledger")
    old = [("a", 0, TEXTS[2], ""), ("b", 0, TEXTS[4], ""), ("c", 0, TEXTS[2], "")]
    secrets.scan_history(history(spark, old), ledger)
    assert secrets.read_ledger(spark, ledger).count() == 2
    first = scanned_pairs(spark, ledger)
    assert len(first) == len(set(first)) == 2 * len(secrets.RULES)

    # A known text under new paths and versions, and one new text.
    new = [*old, ("d", 0, TEXTS[4], ""), ("a", 1, TEXTS[4], ""), ("a", 2, TEXTS[7], "")]
    assert spans(secrets.scan_history(history(spark, new), ledger)) == {(p, v): plain(t) for p, v, t, _ in new}
    second = scanned_pairs(spark, ledger)
    assert len(second) == len(set(second)) == 3 * len(secrets.RULES)

    # A changed rule is tried on every blob, the others on none; findings of its old version are gone.
    rules = (secrets.RULES[0]._replace(least=7), *secrets.RULES[1:])
    assert spans(secrets.scan_history(history(spark, new), ledger, rules)) == {(p, v): plain(t, rules) for p, v, t, _ in new}
    third = scanned_pairs(spark, ledger)
    assert len(third) == len(set(third)) == 3 * len(secrets.RULES) + 3
    assert {v for _, v in set(third) - set(second)} == {rules[0].version}


def test_only_owners_are_scanned(spark):
    named = secrets.entries(history(spark, [(f"p{i}", 0, TEXTS[i % 3], "") for i in range(60)]))
    todo = secrets.unseen(named, spark.createDataFrame([], secrets.LEDGER), secrets.RULES)
    # The empty text and the null one are one blob; the owner is the first path in text order.
    assert sorted(r.path for r in todo.collect()) == ["p0", "p11"]


def test_long_texts(spark):
    text = "password: hunter22 " * 20_000 + "eyJ" * 50_000 + " " + "AKIA" * 50_000 + "://" + "a" * 200_000
    found = secrets.scan_history(history(spark, [("long", 0, text, "")]), run_path(spark, "ledger")).first().spans
    assert [tuple(s) for s in found] == plain(text) and len(found) == 20_002


def test_no_python_in_the_plan(spark):
    rows = history(spark, [("p", 0, TEXTS[2], "")])
    texts = spark.createDataFrame([(b"b", "t", 1)], "blob binary, text string, todo long")
    for df in (secrets.scan_history(rows, run_path(spark, "ledger")), secrets.scan(texts, secrets.RULES)):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("InArrow", "EvalPython", "InPandas"))
