"""op1: a word is scored by its own share of its bucket, whether tasks hold it, it is joined, or it was never counted."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest

from beaconlake.llm import pseudo_likelihood as lm


@pytest.mark.parametrize("hot_words", [0, 20, 10_000])
def test_each_word_has_its_own_probability(spark, hot_words):
    frequent = [f"f{i}" for i in range(lm.TOKENS - lm.BUCKETS)]
    others = [f"rare{i}" for i in range(600)]
    texts = [" ".join(frequent * 50), " ".join(w for i, w in enumerate(others) for _ in range(1 + i % 7)), "f1 rare6 f2 rare7 Rare6", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    counts = lm.word_counts(docs)
    known = lm.vocabulary(docs, counts)
    within = lm.within_buckets(counts, known, hot_words)
    assert len(within.hot) <= hot_words
    parameters = lm.start(known.counts)
    asked = docs.union(spark.createDataFrame([(9, "f1 neverseen f2"), (10, "f1 rare6 f2")], docs.schema))
    tokens = {r.doc_id: r for r in lm.score(asked, known, parameters).collect()}
    found = {r.doc_id: r for r in lm.score(asked, known, parameters, within).collect()}

    uses = Counter(w for t in texts for w in (t or "").lower().split() if w not in frequent)
    buckets = defaultdict(dict)
    for w, n in uses.items():
        buckets[zlib.crc32(w.encode()) % lm.BUCKETS][w] = n

    def log(word):
        own = buckets[zlib.crc32(word.encode()) % lm.BUCKETS]
        kinds = max(len(own), 1)
        total = sum(own.values()) + kinds
        return math.log(own[word] / total) if word in own else math.log(kinds / total) - (len(word) + 1) * math.log(257)

    for r in asked.collect():
        words = [w for w in (r.text or "").lower().split() if w not in frequent]
        wanted = tokens[r.doc_id].log_likelihood + sum(map(log, words))
        assert found[r.doc_id].n_tokens == tokens[r.doc_id].n_tokens
        assert math.isclose(found[r.doc_id].log_likelihood, wanted, rel_tol=1e-6, abs_tol=1e-6)
    assert found[9].mean_log_likelihood < found[10].mean_log_likelihood
    assert found[3].mean_log_likelihood is None and found[4].log_likelihood == 0
