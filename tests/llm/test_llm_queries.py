"""Registered queries of the package against SQL or brute force on the smallest tables."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
import compare
from beaconlake.llm import common
from beaconlake.llm.sql import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    columns, found = compare.spark_rows(entry.queries()[name](spark, SF_DIR))
    wanted_columns, wanted = compare.sql_rows(con, entry.oracle_sql()[name])
    assert columns == wanted_columns
    assert found == wanted


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql_without_broadcasts(spark, con, name, monkeypatch):
    """Lookups beyond the limits of a broadcast take another plan and give the same rows."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    _, found = compare.spark_rows(entry.queries()[name](spark, SF_DIR))
    assert found == compare.sql_rows(con, entry.oracle_sql()[name])[1]


def run(spark, name):
    return entry.queries()[name](spark, SF_DIR).collect()


def documents(con):
    return con.execute("select doc_id, text from documents").fetchall()


def test_op1_scores_every_document(spark, con):
    rows = {r.doc_id: r for r in run(spark, "op1_pseudo_likelihood")}
    for doc_id, text in documents(con):
        assert rows[doc_id].n_tokens == len(text.encode().split())
        assert rows[doc_id].log_likelihood < 0
        assert math.isclose(rows[doc_id].mean_log_likelihood * rows[doc_id].n_tokens, rows[doc_id].log_likelihood, rel_tol=1e-9)


def brute_repetition(words, window=5, least=10):
    n = len(words)
    longest = [0] * (n + 1)
    best = [0] * n
    # Longest common prefix of all pairs of suffixes.
    for i in range(n - 1, -1, -1):
        for j in range(i + 1, n + 1):
            longest[j - 1] = longest[j] + 1 if j < n and words[i] == words[j] else 0 if j <= n else 0
        for j in range(i + 1, n):
            if longest[j - 1] > best[i]:
                best[i] = longest[j - 1]
            if longest[j - 1] > best[j]:
                best[j] = longest[j - 1]
    def covered(spans):
        return len({k for i, length in spans for k in range(i, i + length)})
    return (
        covered([(i, window) for i in range(n) if best[i] >= window]),
        covered([(i, best[i]) for i in range(n) if best[i] >= least]), max(best, default=0),
    )


def test_op2_against_brute_force(spark, con):
    rows = {r.doc_id: r for r in run(spark, "op2_suffix_rules")}
    texts = documents(con)
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        row, words = rows[doc_id], text.encode().split()
        assert row.n_words == len(words)
        assert row.word_chars == sum(len(w.decode()) for w in words)
        assert row.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        lines = [line for line in text.split("\n") if line.encode().split()]
        assert row.n_dup_lines == sum(line in lines[:i] for i, line in enumerate(lines))
        windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        repeated = {k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
        assert row.n_repeat_words == len(repeated)
        assert row.base_failed == (len(words) < 10 or 100 * len(repeated) > 20 * len(words))
        assert not (row.base_failed and row.kept)
        if len(words) <= 400:
            assert (row.n_repeat_words, row.n_covered_words, row.longest_repeat) == brute_repetition(words)


def test_op4_learns_and_leaves_out_held_out(spark, con):
    rows = {r.doc_id: r for r in run(spark, "op4_ranking_classifier")}
    labels = con.execute("select doc_id, quality from labels").fetchall()
    assert len(rows) == len(documents(con))
    for r in rows.values():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(rows[d].predicted, q) for d, q in labels if rows[d].held_out]
    assert sum(p == q for p, q in held) >= 0.85 * len(held)


def components_by_brute_force(texts, percent):
    sets = {}
    for doc_id, text in texts:
        words = [w.lower() if w.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in (text or "").encode().split()]
        sets[doc_id] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_op8_against_all_pairs(spark, con):
    wanted = components_by_brute_force(documents(con), 85)
    rows = run(spark, "op8_near_dedup")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert any(not r.kept for r in rows)


def test_op9_limits(spark, con):
    rows = run(spark, "op9_mixing")
    per_source = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        per_source[r.source_size, r.target] += r.taken
    for (_, target), taken in per_source.items():
        assert abs(taken - target) <= 2 * 64
    assert sorted(map(tuple, rows)) == sorted(map(tuple, run(spark, "op9_mixing")))


def test_op3_finds_the_notices(spark, con):
    rows = {r.doc_id: r for r in run(spark, "op3_license_scan")}
    notices = {
        "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "All-rights-reserved",
    }
    for doc_id, text in documents(con):
        lines = [notices[line.strip()] for line in text.split("\n") if line.strip() in notices]
        assert rows[doc_id].n_notices == len(lines)
        assert rows[doc_id].licenses == ",".join(sorted(set(lines)))


def test_op5_finds_the_article(spark, con):
    import html
    import re

    rows = {r.page_id: r for r in run(spark, "op5_html_regions")}
    for page_id, url, page in con.execute("select page_id, url, html from pages").fetchall():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", article)]
        wanted = "\n".join(b for b in blocks if b)
        assert (rows[page_id].url, rows[page_id].text, rows[page_id].n_chars) == (url, wanted, len(wanted))
