"""The pipeline against a plain version of each stage, and the scoring network against sums over all tokens."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from beaconlake.llm import pseudo_likelihood, ranking_classifier
from beaconlake.llm.sql import OP9
from test_llm_queries import SF_DIR, components_by_brute_force


def in_repeats(words, length):
    """Words that stand in windows of this length found twice or more."""
    windows = [tuple(words[i:i + length]) for i in range(len(words) - length + 1)]
    counts = Counter(windows)
    return len({k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + length)})


def passes_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if n < 10 or 100 * in_repeats(words, 5) > 20 * n:
        return False
    # Repeats of ten words or more are made of windows of ten; one of over 40 words holds a window of 41.
    return in_repeats(words, 10) <= 0.1 * n and in_repeats(words, 41) == 0


def is_contaminated(text, windows):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _plain(text))
    hit = set()
    for length in {len(w) for w in windows}:
        for i in range(len(words) - length + 1):
            if tuple(words[i:i + length]) in windows:
                hit.update(range(i, i + length))
    return bool(hit) and 20 * len(hit) >= len(words)


def _plain(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def test_run_against_a_plain_version(spark):
    con = compare.connect(SF_DIR)
    texts = dict(con.execute("select doc_id, text from documents").fetchall())
    by_rules = {d: t for d, t in texts.items() if passes_rules(t)}

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = ranking_classifier.train(docs.where(F.col("doc_id").isin(*by_rules)), spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    features = np.array([ranking_classifier.text_features(t) for t in by_rules.values()])
    by_score = {d: t for (d, t), s in zip(by_rules.items(), model.score(features)) if s >= ranking_classifier.CUT}

    components = components_by_brute_force(by_score.items(), 80)
    once = {d: t for d, t in by_score.items() if components[d][1] == d}

    windows = set()
    for (text,) in con.execute("select text from benchmark").fetchall():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _plain(text))
        windows |= {tuple(words[i:i + 13]) for i in range(max(1, len(words) - 12))} if words else set()
    clean = [d for d, t in once.items() if not is_contaminated(t, windows)]
    assert len(texts) > len(by_rules) > len(by_score) > len(once) > len(clean) > 0

    con.execute("create table kept as select * from documents where list_contains(?, doc_id)", [clean])
    con.execute("create or replace view documents as select * from kept")
    wanted = con.execute(f"select doc_id, source, size, target, taken from ({OP9}) join kept using (doc_id) where taken > 0").fetchall()
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == ["doc_id", "source", "size", "target", "taken"]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_good_labels_stay(spark):
    """Of documents labelled good, a stage only removes copies, contaminated ones and a few that its rules name."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = docs.join(labels.where("quality = 1"), "doc_id").count()
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.quality_classifier):
        assert stage(spark, docs, SF_DIR).join(labels.where("quality = 1"), "doc_id").count() >= 0.95 * good


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    learnt, held_out = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")
    vocabulary = pseudo_likelihood.vocabulary(learnt)
    return vocabulary, pseudo_likelihood.train(learnt, vocabulary), held_out


def test_the_network_predicts_held_out_text_better_than_frequencies(scored):
    vocabulary, parameters, held_out = scored
    sums = pseudo_likelihood.score(held_out, vocabulary, parameters).agg(F.sum("log_likelihood"), F.sum("n_tokens")).first()
    tokens, _ = pseudo_likelihood.encode([r.text for r in held_out.collect()], vocabulary)
    frequencies = np.log((vocabulary.counts + 1) / (vocabulary.counts + 1).sum())
    assert len(tokens) == sums[1]
    assert sums[0] > frequencies[tokens].sum()


def test_probabilities_of_all_tokens_sum_to_one(scored):
    vocabulary, parameters, held_out = scored
    tokens, counts = pseudo_likelihood.encode([held_out.first().text], vocabulary)
    around = pseudo_likelihood.contexts(tokens, counts)[:3]
    every = np.arange(pseudo_likelihood.TOKENS)
    for row in around:
        logs = pseudo_likelihood.log_probabilities(parameters, every, np.repeat(row[None], len(every), 0))
        assert abs(np.exp(logs).sum() - 1) < 1e-4


def test_the_gradient_is_that_of_the_loss(scored):
    """A training step against differences of the loss, in the hidden layer and in an embedding."""
    vocabulary, parameters, _ = scored
    random = np.random.default_rng(5)
    tokens = random.integers(0, pseudo_likelihood.TOKENS, 50)
    around = pseudo_likelihood.contexts(tokens, np.array([20, 30]))
    before = {name: value.astype(np.float64) for name, value in parameters.items()}

    def loss(p):
        return -pseudo_likelihood.log_probabilities(p, tokens, around).mean()

    squares = {name: np.zeros_like(value) for name, value in before.items()}
    after = {name: value.copy() for name, value in before.items()}
    pseudo_likelihood.train_step(after, squares, tokens, around)
    for name, at in (("hidden", (3, 4)), ("embedding", (int(tokens[1]), 2)), ("cluster", (1, 5)), ("hidden_bias", (0,))):
        moved = {n: v.copy() for n, v in before.items()}
        moved[name][at] += 1e-5
        slope = (loss(moved) - loss(before)) / 1e-5
        assert np.isclose(slope ** 2, squares[name][at], rtol=1e-2, atol=1e-12), name
        assert np.sign(before[name][at] - after[name][at]) == np.sign(slope), name
