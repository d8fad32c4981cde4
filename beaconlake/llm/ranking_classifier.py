"""Quality classifier by Bradley-Terry ranking.

A labelled sample gives preference pairs: a good document is preferred to a bad one. A document's strength is linear in
its features, and the probability that one is preferred is the logistic of the difference of strengths, so the weights are
fitted by logistic loss on feature differences. The threshold is a quantile of the sample's strengths: the share of bad
labels. Scores are the logistic of strength, shifted so that the threshold lies at ``CUT``.

Features are shares and lengths computed from the text alone. The sample is bounded by ``SAMPLE_ROWS`` (the labelled rows
with the smallest hash of their id, whatever the table's size); everything is scored.

Defined results: null and empty texts have the features of a text without words and get a score like any other; without
labels of both kinds all scores are 0.5; repeated documents score alike; contradicting labels of an id count as bad; an
empty table gives no rows. Labels without an id or a quality are left out. Texts are read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.llm.common import table

SAMPLE_ROWS = 20_000
PAIRS_PER_ROW = 10
PENALTY = 1e-3
CUT = 0.3
SYMBOLS, CAPITALS, DIGITS = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58))
STOPS = b".!?"

FEATURES = (
    "log_words", "word_length", "symbols", "capitals", "digits", "stops", "shout", "line_words", "same_neighbours",
    "distinct", "repeated_windows", "repeated_lines", "commonest",
)


def _share(raw: bytes, chars: bytes) -> float:
    return (len(raw) - len(raw.translate(None, chars))) / max(1, len(raw))


def text_features(text: str | None) -> list[float]:
    """The values of ``FEATURES`` for a text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = max(1, len(words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    windows = max(1, len(words) - 2)
    counts = Counter(words)
    return [
        np.log1p(len(words)), min(20.0, len(raw) / n), _share(raw, SYMBOLS) ** 0.5, _share(raw, CAPITALS) ** 0.5,
        _share(raw, DIGITS) ** 0.5, min(1.0, sum(raw.count(STOPS[i:i + 1]) for i in range(3)) / n),
        min(1.0, raw.count(b"!!") / n) ** 0.5, np.log1p(n / max(1, len(lines))),
        (sum(map(eq, words, words[1:])) / n) ** 0.5, len(counts) / n,
        (1 - len(set(zip(words, words[1:], words[2:]))) / windows) if len(words) > 2 else 0.0,
        1 - len(set(lines)) / max(1, len(lines)), max(counts.values(), default=0) / n,
    ]


def add_features(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) without the text, and ``features``."""
    own = [f for f in docs.schema.fields if f.name not in ("text", "features")]
    schema = T.StructType([*own, T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [text_features(t.as_py()) for t in batch.column("text")]
            columns = [batch.column(f.name) for f in own] + [pa.array(values, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


class Model:
    """Weights and threshold; ``score`` maps features to (0, 1), with ``CUT`` at the threshold."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, threshold: float):
        self.mean, self.scale, self.weights, self.threshold = mean, scale, weights, threshold

    def strength(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(features), 0.5)
        above = self.strength(features) - self.threshold
        return 1 / (1 + np.exp(-np.clip(above + np.log(CUT / (1 - CUT)), -30, 30)))


def fit(features: np.ndarray, quality: np.ndarray, pairs_per_row: int = PAIRS_PER_ROW, penalty: float = PENALTY, seed: int = 7) -> Model:
    """Bradley-Terry weights by Newton steps on pairs of a good and a bad row; a row meets some random rows of the others."""
    n_features = features.shape[1] if features.ndim == 2 else len(FEATURES)
    good, bad = np.flatnonzero(quality == 1), np.flatnonzero(quality == 0)
    if not len(good) or not len(bad):
        return Model(np.zeros(n_features), np.ones(n_features), np.zeros(n_features), 0.0)
    mean, scale = features.mean(0), features.std(0)
    scale[scale == 0] = 1
    z = np.clip((features - mean) / scale, -8, 8)
    random = np.random.default_rng(seed)
    # Every row is in as many pairs: each good row meets bad ones, each bad row good ones.
    left = np.r_[np.repeat(good, pairs_per_row), random.choice(good, len(bad) * pairs_per_row)]
    right = np.r_[random.choice(bad, len(good) * pairs_per_row), np.repeat(bad, pairs_per_row)]
    difference = z[left] - z[right]
    weights = np.zeros(n_features)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(difference @ weights, -30, 30)))
        gradient = difference.T @ (1 - p) / len(difference) - penalty * weights
        curvature = (difference * (p * (1 - p))[:, None]).T @ difference / len(difference) + penalty * np.eye(n_features)
        step = np.linalg.solve(curvature, gradient)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    strength = z @ weights
    # Between the worst rows, as many as are bad, and the others.
    cut = np.sort(strength)
    k = len(bad)
    return Model(mean, scale, weights, float((cut[k - 1] + cut[min(k, len(cut) - 1)]) / 2))


def labelled_sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` (doc_id, quality), those with the smallest hash of their id."""
    one = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``labels`` (doc_id, quality) and the documents they belong to."""
    # The sample is at most ``rows`` narrow rows, so broadcasting it is bounded.
    chosen = docs.select("doc_id", "text").join(F.broadcast(labelled_sample(labels, rows)), "doc_id")
    # Repeated ids could bring more rows: the bound holds for them too.
    sample = add_features(chosen.select("text", "quality", F.xxhash64("doc_id", "text").alias("order")))
    found = sample.orderBy("order", "features").limit(rows).select("features", "quality").toPandas()
    features = np.array(found["features"].tolist(), dtype=float).reshape(len(found), len(FEATURES))
    return fit(features, found["quality"].to_numpy())


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (with ``text``) and ``score``; all its columns are kept."""
    own = [f for f in docs.schema.fields if f.name != "score"]
    schema = T.StructType([*own, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([text_features(t.as_py()) for t in batch.column("text")], dtype=float).reshape(-1, len(FEATURES))
            columns = [batch.column(f.name) for f in own] + [pa.array(model.score(values))]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def op4_ranking_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt from labels of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out(F.col("doc_id")))
    scored = classify(docs, train(docs, labels))
    predicted = F.when(F.col("score") >= CUT, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
