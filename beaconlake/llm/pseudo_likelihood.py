"""Masked pseudo-likelihood: a bidirectional window network scores each token from the tokens on both its sides.

The network's vocabulary holds the most frequent words of the whole corpus; every other word falls into one of a fixed
number of buckets by its hash. A word in a bucket is scored as P(bucket | context) * P(word | bucket): the second factor
comes from the counts of all words of the corpus, with the Witten-Bell share left for words that were never counted. The
most used of these words are looked up where the document is scored; the others are joined by shuffle and summed per
document, so the table of words may grow with the corpus. The network joins the embeddings of two tokens to the left and
two to the right, passes them through a hidden layer, and predicts the masked token in two steps: its cluster, then the
token within the cluster.

Training is parameter averaging: each task trains a copy on all the documents of its partition, from the same start, and
hands over its parameters with the number of tokens seen; Spark averages them parameter by parameter. So every document
takes part, no task sees more than its partition, and what is gathered grows with the number of partitions. Output biases
start at the logarithm of corpus frequencies. A document's score is the sum of its tokens' conditional log-probabilities.

Defined results: null, empty and wordless texts have no tokens, score 0 and a null mean; a corpus without words leaves the
network at its start; repeated rows score alike; empty tables give no rows. A text's context never crosses its ends:
positions outside hold a boundary token. Whole texts are read; columns other than ``text`` are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.llm.common import table, written

CLUSTERS, MEMBERS = 32, 32
TOKENS = CLUSTERS * MEMBERS
BUCKETS = 256
HOT_WORDS = 200_000  # words in buckets that every task holds; all others are joined
SIDE = 2  # tokens to each side
WIDTH, HIDDEN = 8, 16
STEP_TOKENS = 8192
RATE = 0.05
SAFE_LOGIT = 60.0
BATCH_WORDS = 200_000


def split(texts: list[str | None] | pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(place of each word of all texts among the distinct ones, distinct words, words per text).

    Words lie between ASCII white space, with A-Z in lower case.
    """
    if not isinstance(texts, pa.Array):
        texts = pa.array(texts, pa.string())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, of_text = parts.flatten(), pc.list_parent_indices(parts)
    # White space at a text's ends leaves an empty part there.
    filled = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(filled).dictionary_encode()
    counts = np.bincount(of_text.filter(filled).to_numpy(), minlength=len(texts))
    return coded.indices.to_numpy(), coded.dictionary.cast(pa.binary()), counts


def ranges(texts: pa.Array, words: int = BATCH_WORDS) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many words (of six bytes); a longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text.as_buffer()) if text.is_valid else 0
        if held and held + size > 6 * words:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


# ---- vocabulary ----

def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): uses of every word in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start, end in ranges(texts, 5 * BATCH_WORDS):
                codes, distinct, _ = split(texts.slice(start, end - start))
                yield pa.RecordBatch.from_arrays([distinct, pa.array(np.bincount(codes, minlength=len(distinct)))], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Frequent words by rank, then buckets; ``counts`` per token number. Fixed size, whatever the corpus."""

    def __init__(self, frequent: list[bytes], counts: np.ndarray):
        self.number = {w: i for i, w in enumerate(frequent)}
        self.frequent = frequent
        self.counts = counts

    def of_words(self, words: pa.Array) -> np.ndarray:
        found = pc.index_in(words, value_set=pa.array(self.frequent, pa.binary()))
        numbers = found.fill_null(TOKENS - BUCKETS).to_numpy().copy()
        bucketed = pc.is_null(found)
        buckets = [zlib.crc32(word) % BUCKETS for word in words.filter(bucketed).to_numpy(zero_copy_only=False)]
        numbers[bucketed.to_numpy(zero_copy_only=False)] += np.array(buckets, np.int32)
        return numbers


def vocabulary(docs: DataFrame, counts: DataFrame | None = None) -> Vocabulary:
    """``counts`` are the ``word_counts`` of ``docs``, when they are already written."""
    counts = written(word_counts(docs), "lm-words") if counts is None else counts
    top = counts.orderBy(F.desc("n"), "word").limit(TOKENS - BUCKETS).collect()
    bucket = F.pmod(F.crc32("word"), F.lit(BUCKETS)).cast("int")
    per_bucket = counts.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n")).collect()
    numbers = np.zeros(TOKENS)
    numbers[: len(top)] = [r.n for r in top]
    for row in per_bucket:
        numbers[TOKENS - BUCKETS + row.bucket] = row.n
    for row in top:  # frequent words are not in their bucket
        numbers[TOKENS - BUCKETS + zlib.crc32(row.word) % BUCKETS] -= row.n
    return Vocabulary([bytes(r.word) for r in top], numbers)


@dataclass
class Within:
    """P(word | bucket): uses of a word among the ``total`` uses in its bucket and the ``kinds`` of words there."""

    hot: dict[bytes, int]
    rest: DataFrame  # (word, n) of all words that are not hot
    total: np.ndarray
    kinds: np.ndarray


def within_buckets(counts: DataFrame, vocabulary: Vocabulary, hot_words: int = HOT_WORDS) -> Within:
    """From the counts of all words. At most ``hot_words`` are gathered: those from the least level of use that allows it."""
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()  # some hundred rows
    least, held = 1 << 30, 0
    for row in sorted(levels, reverse=True):
        held += row.words
        if held > hot_words:
            break
        least = row.level
    hot = counts.where(level >= least).select("word", "n").toArrow()
    bucket = F.pmod(F.crc32("word"), F.lit(BUCKETS)).cast("int")
    kinds = np.zeros(BUCKETS)
    for row in counts.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("words")).collect():
        kinds[row.bucket] = row.words
    for word in vocabulary.number:  # frequent words are not in their bucket
        kinds[zlib.crc32(word) % BUCKETS] -= 1
    return Within(
        dict(zip(hot["word"].to_pylist(), hot["n"].to_pylist())), counts.where(level < least).select("word", "n"),
        vocabulary.counts[TOKENS - BUCKETS:], np.maximum(kinds, 1),
    )


def unseen_log(word: Column, kinds: np.ndarray) -> Column:
    """For a word that was never counted: the logarithm of its bucket's kinds, and as many times 1/257 as it has bytes, and an end."""
    per_bucket = F.array(*[F.lit(float(x)) for x in np.log(kinds)])
    bucket = F.pmod(F.crc32(word), F.lit(BUCKETS)).cast("int")
    return F.get(per_bucket, bucket) - (F.octet_length(word) + 1) * F.lit(float(np.log(257)))


def encode(texts: list[str | None] | pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(token numbers of all texts, tokens per text)."""
    codes, distinct, counts = split(texts)
    return vocabulary.of_words(distinct)[codes], counts


def contexts(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(tokens, 2 * SIDE): the tokens around each, number ``TOKENS`` beyond the ends of its text."""
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(tokens)) + doc * SIDE + SIDE
    padded = np.full(len(tokens) + (len(counts) + 1) * SIDE, TOKENS, np.int32)
    padded[place] = tokens
    return np.stack([padded[place + k] for k in range(-SIDE, SIDE + 1) if k], axis=1)


# ---- network ----

SHAPES = {
    "embedding": (TOKENS + 1, WIDTH), "hidden": (2 * SIDE * WIDTH, HIDDEN), "hidden_bias": (HIDDEN,),
    "cluster": (HIDDEN, CLUSTERS), "cluster_bias": (CLUSTERS,), "member": (CLUSTERS, HIDDEN, MEMBERS), "member_bias": (CLUSTERS, MEMBERS),
}


def start(counts: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
    """Parameters before training: small random weights, biases from frequencies. Token t is member t // CLUSTERS of its cluster."""
    random = np.random.default_rng(seed)
    out = {name: (random.standard_normal(shape) * 0.2).astype(np.float32) for name, shape in SHAPES.items()}
    share = (counts + 1).reshape(MEMBERS, CLUSTERS).T
    out["hidden_bias"][:] = 0
    out["cluster_bias"][:] = np.log(share.sum(1) / share.sum())
    out["member_bias"][:] = np.log(share / share.sum(1, keepdims=True))
    return out


def flatten(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parameters[name].ravel() for name in SHAPES]).astype(np.float64)


def unflatten(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = values[at:at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def _softmax(logits: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities, logarithm of the sum of powers) per row; ``logits`` is overwritten.

    No logit is further from zero than ``bound``. While that is small, powers neither overflow nor vanish as they are;
    beyond, each row's largest logit is taken off first.
    """
    shift = 0
    if bound > SAFE_LOGIT:
        shift = logits.max(1, keepdims=True)
        logits -= shift
        shift = shift[:, 0]
    power = np.exp(logits, out=logits)
    total = power @ np.ones(power.shape[1], power.dtype)
    power *= (1 / total)[:, None]
    return power, np.log(total) + shift


def _bound(weights: np.ndarray, bias: np.ndarray) -> float:
    """How far from zero a logit can be, as hidden units lie between -1 and 1."""
    return float((np.abs(weights).sum(-2) + np.abs(bias)).max())


class Forward:
    """One batch through the network: hidden units, the clusters' probabilities and, for tokens in the order of their
    cluster, the probabilities of the members of each one's own cluster."""

    def __init__(self, p: dict[str, np.ndarray], tokens: np.ndarray, around: np.ndarray):
        n = len(tokens)
        self.x = p["embedding"].take(around.ravel(), axis=0).reshape(n, -1)
        self.h = np.tanh(self.x @ p["hidden"] + p["hidden_bias"])
        self.cluster, self.member, self.rows = tokens % CLUSTERS, tokens // CLUSTERS, np.arange(n)
        logits = self.h @ p["cluster"] + p["cluster_bias"]
        own = logits[self.rows, self.cluster]
        self.c_prob, log_total = _softmax(logits, _bound(p["cluster"], p["cluster_bias"]))
        self.log_p = own - log_total

        self.order = np.argsort(self.cluster.astype(np.int16), kind="stable")
        ends = np.cumsum(np.bincount(self.cluster, minlength=CLUSTERS))
        self.parts = [(c, slice(ends[c - 1] if c else 0, ends[c])) for c in range(CLUSTERS) if ends[c] > (ends[c - 1] if c else 0)]
        self.h_sorted, self.member_sorted = self.h.take(self.order, axis=0), self.member[self.order]
        logits = np.empty((n, MEMBERS), self.h.dtype)
        for c, at in self.parts:
            np.matmul(self.h_sorted[at], p["member"][c], out=logits[at])
            logits[at] += p["member_bias"][c]
        own = logits[self.rows, self.member_sorted]
        self.m_prob, log_total = _softmax(logits, _bound(p["member"], p["member_bias"]))
        self.log_p[self.order] += own - log_total


def log_probabilities(p: dict[str, np.ndarray], tokens: np.ndarray, around: np.ndarray) -> np.ndarray:
    """The conditional log-probability of each token, given the tokens around it."""
    out = np.empty(len(tokens))
    for at in range(0, len(tokens), STEP_TOKENS):
        out[at:at + STEP_TOKENS] = Forward(p, tokens[at:at + STEP_TOKENS], around[at:at + STEP_TOKENS]).log_p
    return out


def train_step(p: dict[str, np.ndarray], squares: dict[str, np.ndarray], tokens: np.ndarray, around: np.ndarray) -> None:
    """One step of AdaGrad on a batch of tokens."""
    n = np.float32(len(tokens))
    f = Forward(p, tokens, around)
    c_error, m_error = f.c_prob, f.m_prob
    c_error[f.rows, f.cluster] -= 1
    m_error[f.rows, f.member_sorted] -= 1
    gradient = {"cluster": f.h.T @ c_error / n, "cluster_bias": c_error.sum(0) / n}
    g_member, g_bias = np.zeros_like(p["member"]), np.zeros_like(p["member_bias"])
    d_sorted = np.empty_like(f.h_sorted)
    for c, at in f.parts:
        error = m_error[at]
        g_member[c] = f.h_sorted[at].T @ error / n
        g_bias[c] = error.sum(0) / n
        np.matmul(error, p["member"][c].T, out=d_sorted[at])
    gradient |= {"member": g_member, "member_bias": g_bias}
    d_h = c_error @ p["cluster"].T
    d_h[f.order] += d_sorted
    d_h *= 1 - f.h * f.h
    gradient |= {"hidden": f.x.T @ d_h / n, "hidden_bias": d_h.sum(0) / n}
    d_x = np.ascontiguousarray((d_h @ p["hidden"].T).reshape(-1, WIDTH).T)
    flat = around.ravel()
    gradient["embedding"] = np.stack([np.bincount(flat, d, TOKENS + 1) for d in d_x], axis=1).astype(np.float32) / n
    for name, g in gradient.items():
        squares[name] += g * g
        p[name] -= np.float32(RATE) * g / (np.sqrt(squares[name]) + np.float32(1e-6))


# ---- Spark ----

def train(docs: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Parameters averaged over the partitions of ``docs``, each weighted by its tokens."""
    begin = start(vocabulary.counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = {name: value.copy() for name, value in begin.items()}
        squares = {name: np.zeros_like(value) for name, value in begin.items()}
        seen = 0
        for batch in batches:
            texts = batch.column("text")
            for first, end in ranges(texts):
                tokens, counts = encode(texts.slice(first, end - first), vocabulary)
                around = contexts(tokens, counts)
                for at in range(0, len(tokens), STEP_TOKENS):
                    train_step(p, squares, tokens[at:at + STEP_TOKENS], around[at:at + STEP_TOKENS])
                seen += len(tokens)
        if seen:
            values = flatten(p)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values * seen), pa.array(np.full(len(values), seen))],
                ["parameter", "value", "tokens"])

    copies = docs.select("text").mapInArrow(run, "parameter int, value double, tokens long")
    means = copies.groupBy("parameter").agg((F.sum("value") / F.sum("tokens")).alias("value"))
    # As many rows as the network has parameters, whatever the corpus.
    rows = written(means, "lm-parameters").toPandas().sort_values("parameter")
    return unflatten(rows["value"].to_numpy()) if len(rows) else begin


def score(docs: DataFrame, vocabulary: Vocabulary, parameters: dict[str, np.ndarray], within: Within | None = None) -> DataFrame:
    """``docs`` without the text, and n_tokens, log_likelihood (sum) and mean_log_likelihood.

    With ``within`` they are of the words themselves, otherwise of the network's tokens, where a bucket is one token.
    """
    ours = ("text", "n_tokens", "log_likelihood", "mean_log_likelihood", "_lm_row", "_lm_rare")
    own = [f for f in docs.schema.fields if f.name not in ours]
    added = "n_tokens long, log_likelihood double, _lm_row long, _lm_rare array<binary>"
    schema = T.StructType([*own, *T.StructType.fromDDL(added).fields])
    first_bucket = TOKENS - BUCKETS
    hot, share = (within.hot, -np.log(within.total + within.kinds)) if within else ({}, np.zeros(BUCKETS))
    whole = within is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column("text")
            for first, end in ranges(texts):
                codes, distinct, counts = split(texts.slice(first, end - first))
                number = vocabulary.of_words(distinct)
                tokens = number[codes]
                values = log_probabilities(parameters, tokens, contexts(tokens, counts))
                of_doc = np.repeat(np.arange(len(counts)), counts)
                rare = np.zeros(len(distinct), bool)
                if whole:
                    inside = np.flatnonzero(number >= first_bucket)
                    uses = np.array([hot.get(w, 0) for w in distinct.take(pa.array(inside)).to_numpy(zero_copy_only=False)], np.float64)
                    logs = np.zeros(len(distinct))
                    logs[inside] = share[number[inside] - first_bucket] + np.log(np.maximum(uses, 1))
                    rare[inside] = uses == 0
                    values += logs[codes]
                at = np.flatnonzero(rare[codes])
                ends = np.cumsum(np.bincount(of_doc[at], minlength=len(counts)))
                words = distinct.take(pa.array(codes[at]))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), words)
                sums = np.bincount(of_doc, values, len(counts))
                kept = [batch.column(f.name).slice(first, end - first) for f in own]
                rows = pa.array(np.arange(row, row + len(counts)))
                row += len(counts)
                results = [pa.array(counts), pa.array(sums, pa.float64()), rows, lists]
                yield pa.RecordBatch.from_arrays(kept + results, [f.name for f in schema.fields])

    scored = docs.mapInArrow(run, schema)
    total = F.col("log_likelihood")
    if whole:
        scored = written(scored, "lm-scored")  # row numbers must not change between the uses
        rare = scored.select("_lm_row", F.explode("_lm_rare").alias("word")).join(within.rest, "word", "left")
        log = F.coalesce(F.log("n"), unseen_log(F.col("word"), within.kinds))
        scored = scored.join(rare.groupBy("_lm_row").agg(F.sum(log).alias("_lm_log")), "_lm_row", "left")
        total = total + F.coalesce("_lm_log", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, total / F.col("n_tokens"))
    return scored.select(*[F.col(f"`{f.name}`") for f in own], "n_tokens", total.alias("log_likelihood"), mean.alias("mean_log_likelihood"))


def op1_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under a network trained on all of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = written(word_counts(docs), "lm-words")
    known = vocabulary(docs, counts)
    return score(docs, known, train(docs, known), within_buckets(counts, known))
