"""A training corpus from raw documents: no toxic texts, no near copies, no repeated passages, packed.

Each stage takes the documents that the one before it kept. The model of the first is
learnt from the labels, so no SQL states the result; tests compare it with a plain
version of every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import chosen_path, packing, suffix_dedup, toxicity
from carelake.llm.common import keep, table

#: Scores from here on are rejected.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the smallest doc_id."""
    return chosen_path.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one holds; n_chars counts what remains."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    kept = suffix_dedup.deduplicated(docs, texts=True, columns=others)
    counted = kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept
    return counted.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bucket, batch and slot of each document."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", drop_repeats),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; each stage's rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
