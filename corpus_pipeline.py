"""From raw documents to a training mix: rules, classifier, near copies, benchmark passages, mixing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and returns a DataFrame; ``run`` writes
each as Parquet in the shared folder and reads it again for the next. All stages but the last return the columns of
documents. The last returns the mix: a row per document that it takes, with the words taken, repeats counted.

A stage's decisions rest on its input alone. Labels for the classifier are those of documents that are still there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm import decontamination, mixing, near_dedup, ranking_classifier, suffix_rules
from beaconlake.llm.common import table, written
from beaconlake.session import configure

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on length and on repetition inside the text."""
    configure(spark)
    return suffix_rules.judge_repetition(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at the threshold or above."""
    configure(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = ranking_classifier.train(docs, labels)
    scored = ranking_classifier.classify(docs.select(*COLUMNS), model)
    return scored.where(F.col("score") >= ranking_classifier.CUT).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; documents without words are all kept."""
    configure(spark)
    return near_dedup.keep_one(docs.select(*COLUMNS)).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    configure(spark)
    benchmark = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontamination.contamination(docs.select(*COLUMNS), benchmark).where("not contaminated").select(*COLUMNS)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, target, taken) of the documents that the mix takes words from."""
    configure(spark)
    mixed = mixing.mix(docs.select("doc_id", "source", "text"))[1]
    return mixed.where("taken > 0").select("doc_id", "source", "size", "target", "taken")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_sources", mixing_sources),
]

#: Neither the classifier's fit nor near-duplicate components can be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written before the next stage reads it."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
