"""One query for each operator of this package, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path as vocabulary_path

from carelake.llm import (
    chosen_path, chunked_bpe, importance, kdtree, lattice, onebit, packing, pseudo_likelihood, seekable_warc, sharded_lloyd,
    suffix_dedup, toxicity, url_filter,
)
from carelake.llm.common import table
from carelake.llm.oracle import ORACLE  # noqa: F401
from carelake.session import workspace

#: Rules of the URL query.
URL_RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)
SHARDS = 40


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, model)


def op2_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op5_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.shard(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similar(table(spark, sf_dir, "documents"))


def op9_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.encode(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op10_onebit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onebit.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_lloyd_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_lloyd.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dimensions=64, salt="3")


def op12_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = seekable_warc.write(table(spark, sf_dir, "pages"), workspace(spark, "warc"), min_bytes=0)
    return seekable_warc.read(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=1, buckets=10_000, percent=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter, op2_lattice_dedup, op3_toxicity, op4_suffix_dedup, op5_kd_sharding, op6_pseudo_likelihood, op7_packing,
        op8_chosen_path_join, op9_chunked_bpe, op10_onebit_search, op11_lloyd_clusters, op12_seekable_warc,
        op13_importance_resampling,
    )
}
