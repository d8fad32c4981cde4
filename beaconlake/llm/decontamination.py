"""Benchmark decontamination: which words of a document stand in a benchmark item's windows.

A set join with prefix filtering, for containment of 1: a window of n words can only occur where each of its words does,
so one word of it, the rarest in the corpus, is its necessary prefix. Document words meet those prefix words (equal
join); the prefix's position in the window gives where the window would start, and windows that would begin before or
end after the document are dropped by length; what is left is compared word for word with the window.

Defined results: null, empty and wordless texts have no words and no hits; an item without words has no window; items
with equal windows are all reported; an item id that is null counts as one with an empty name; repeated documents are
judged alike, each in its own row; an empty table on either side gives no hits. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import NOT_WORD, broadcast_if_small, is_small, lower_ascii, table, words, written

WINDOW_WORDS = 13
MIN_SHARE = 0.05


def _words(text: Column) -> Column:
    return words(lower_ascii(text), NOT_WORD)


def text_key(text: Column) -> Column:
    """Stands for a text: equal texts have equal keys, so copies are looked at once after the map side."""
    return F.md5(F.coalesce(text, F.lit("")))


def item_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(item, window): distinct windows of each item's words, in order, joined by blanks; shorter items are one window."""
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    items = benchmark.select(item.alias("item"), _words(F.col("text")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window + 1, F.lit(1))
    starts = items.select("item", "words", F.explode(F.sequence(F.lit(1), last)).alias("start"))
    return starts.select("item", F.array_join(F.slice("words", F.col("start"), F.lit(window)), " ").alias("window")).distinct()


def word_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(key, uses): how often the words of ``vocabulary`` (key) stand in all documents."""
    # Outer, so that Spark does not split each text a second time to look for empty ones; their null words match nothing.
    used = docs.select(F.explode_outer(_words(F.col("text"))).alias("word")).select(word_key(F.col("word")).alias("key"))
    uses = F.count(F.lit(1)).alias("uses")
    if is_small(vocabulary):
        return used.join(F.broadcast(vocabulary), "key", "left_semi").groupBy("key").agg(uses)
    return used.groupBy("key").agg(uses).join(vocabulary, "key", "left_semi")


def word_key(word: Column) -> Column:
    """Words are looked up by this number; should two have the same, the comparison of windows tells them apart."""
    return F.xxhash64(word)


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, places): each window's rarest word, and the distinct (offset, length) at which it stands in such windows."""
    placed = windows.select("window", F.posexplode(F.split("window", " ")).alias("offset", "word"))
    placed = placed.select("window", "offset", word_key(F.col("word")).alias("key"), F.size(F.split("window", " ")).alias("length"))
    rarity = F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "key", "offset")
    rarest = placed.join(counts, "key", "left").groupBy("window", "length").agg(F.min(rarity).alias("rarest"))
    place = F.struct(F.col("rarest.offset").alias("offset"), "length")
    return rarest.groupBy(F.col("rarest.key").alias("key")).agg(F.collect_set(place).alias("places"))


def find_windows(docs: DataFrame, windows: DataFrame, prefix: DataFrame) -> DataFrame:
    """(text_key, start, length, window): every occurrence of a window in a text, equal texts once."""
    texts = docs.select(text_key(F.col("text")).alias("text_key"), _words(F.col("text")).alias("words"))
    candidates = _candidates_in_stage(texts, prefix) if is_small(prefix) else _candidates_by_shuffle(texts, prefix)
    found = candidates.select(
        "text_key", "start", "length", F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ").alias("window")
    )
    known = windows.select("window").distinct()
    return found.join(broadcast_if_small(known), "window", "left_semi").distinct()


def _places(met: DataFrame, *columns: str) -> DataFrame:
    """Where the windows of the prefixes met would start and how long they are, if they fit into the text."""
    start = F.col("position") - F.col("place.offset")
    fits = (start >= 0) & (start + F.col("place.length") <= F.col("n_words"))
    placed = met.select(*columns, "n_words", "position", F.explode("places").alias("place")).where(fits)
    return placed.select(*columns, start.alias("start"), F.col("place.length").alias("length"))


def _candidates_in_stage(texts: DataFrame, prefix: DataFrame) -> DataFrame:
    """(text_key, words, start, length). The word array of a document is exploded, looked up and sliced within one stage."""
    used = texts.select("text_key", "words", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("position", "word"))
    used = used.select("text_key", "words", "n_words", "position", word_key(F.col("word")).alias("key"))
    return _places(used.join(F.broadcast(prefix), "key"), "text_key", "words")


def _candidates_by_shuffle(texts: DataFrame, prefix: DataFrame) -> DataFrame:
    """The same for prefixes too many to broadcast: positions alone are shuffled, and the texts once, to their candidates."""
    used = texts.select("text_key", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("position", "word"))
    used = used.select("text_key", "n_words", "position", word_key(F.col("word")).alias("key")).distinct()
    placed = _places(used.join(prefix, "key"), "text_key")
    per_text = placed.groupBy("text_key").agg(F.collect_set(F.struct("start", "length")).alias("candidates"))
    per_text = broadcast_if_small(written(per_text, "benchmark-candidates"))
    return texts.join(per_text, "text_key").select("text_key", "words", F.inline("candidates"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, min_share: float = MIN_SHARE,
) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted names), n_items and ``contaminated``; all its columns are kept.

    A document is contaminated when words are hit and they are at least ``min_share`` of its words.
    """
    windows = written(item_windows(benchmark, window), "benchmark-windows")
    vocabulary = windows.select(F.explode(F.split("window", " ")).alias("word")).select(word_key(F.col("word")).alias("key")).distinct()
    counts = written(word_counts(docs, written(vocabulary, "benchmark-words")), "benchmark-word-counts")
    prefix = written(prefixes(windows.select("window").distinct(), counts), "benchmark-prefixes")
    found = written(find_windows(docs, windows, prefix), "benchmark-hits")

    position = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1))
    hit = found.select("text_key", position.alias("position")).distinct().groupBy("text_key").agg(
        F.count(F.lit(1)).alias("_n_hit")
    )
    named = found.select("text_key", "window").distinct().join(broadcast_if_small(windows), "window")
    named = named.select("text_key", "item").distinct().groupBy("text_key").agg(
        F.array_sort(F.collect_list("item")).alias("_items")
    )
    per_text = written(hit.join(named, "text_key"), "benchmark-texts")
    keyed = docs.select("*", text_key(F.col("text")).alias("_key"), F.size(words(F.col("text"), NOT_WORD)).cast("bigint").alias("_n_words"))
    joined = keyed.join(broadcast_if_small(per_text.withColumnRenamed("text_key", "_key")), "_key", "left")
    n_hit = F.coalesce("_n_hit", F.lit(0)).cast("bigint")
    items = F.coalesce("_items", F.array().cast("array<string>"))
    own = [c for c in docs.columns if c not in ("n_words", "n_hit", "n_items", "items", "contaminated")]
    return joined.select(
        *[F.col(f"`{c}`") for c in own], F.col("_n_words").alias("n_words"), n_hit.alias("n_hit"), items.alias("items"),
        F.size(items).cast("bigint").alias("n_items"),
        ((n_hit > 0) & (n_hit >= min_share * F.col("_n_words"))).alias("contaminated"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document hit by benchmark windows, and which items they are from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), contaminated.alias("contaminated"))
