"""Linkage clusters that grow with each batch of records.

Kept in hash parts, as `sources.parts` has them: the link keys that records hold, the
cluster of each record, and the records of each cluster. A batch meets the kept keys it
shares, its links are drawn between the clusters that it touches, and only the parts of
these keys, records and clusters are rewritten.

A key whose holders are linked is kept as one row, its head, so a key that a third of all
records hold costs a batch no more than its own holders. A key with holders on one side
only keeps them all, since the first one on the other side links them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators.components import connected_components
from carelake.operators.linkage import KEY, LinkModel, LinkSettings, link_keys
from carelake.session import materialize
from carelake.sources.parts import PARTS, commit, read_parts, settle, stage, together, touched_parts

KEYS, BY_ID, MEMBERS = "link_keys", "cluster_by_id", "cluster_members"


@dataclass(frozen=True)
class Grown:
    """What a batch changes: records with their old cluster, null for new ones, and their new one; and staged paths."""

    moved: DataFrame
    paths: list[str]


def _held(spark: SparkSession, path: str, key: str, touched: list[int], like: DataFrame) -> DataFrame:
    """The touched parts of a table, or no rows in the columns of `like`."""
    rows = read_parts(spark, path, key, touched)
    return spark.createDataFrame([], like.schema) if rows is None else rows.select(*like.columns)


def stage_records(
    spark: SparkSession, root: str, records: DataFrame, settings: LinkSettings, model: LinkModel,
    threshold: float = 0.8, parts: int = PARTS,
) -> Grown:
    """Stage the clusters after `records` have joined those kept below `root`.

    Settings, model and threshold are the same in all batches. Records are added: one that
    comes again unchanged changes nothing, one that comes with other values keeps its old
    links too. A record without a block, or with a null id, links with nothing; the latter
    is left out. A cluster is named by its smallest record id, so a smaller one that joins
    renames all its records.
    """
    record_id = settings.unique_id
    known = records.filter(F.col(record_id).isNotNull())
    ids = known.select(F.col(record_id).alias("id")).distinct()
    found = link_keys(known, settings, model, threshold)
    links, paths = None, []
    if found is not None:
        keys = materialize(
            found.select(*KEY, "id", "side", "sides", F.lit(False).alias("linked")).distinct(), "link-keys")
        links, path = _linked(spark, root, keys, parts)
        paths.append(path)

    in_links = ids if links is None else ids.union(links.select("left")).union(links.select("right")).distinct()
    by_id, members = f"{root}/{BY_ID}", f"{root}/{MEMBERS}"
    none = in_links.select("id", F.col("id").alias("cluster_id"))
    held = _held(spark, by_id, "id", touched_parts(in_links, "id", parts), none)
    labels = materialize(in_links.join(held, "id", "left"), "cluster-labels")  # a null cluster: a new record
    renamed = spark.createDataFrame([], none.schema).toDF("old", "new")
    if links is not None:
        label = labels.select("id", F.coalesce("cluster_id", "id").alias("label"))
        edges = links.join(label.toDF("left", "a"), "left").join(label.toDF("right", "b"), "right").filter("a <> b")
        renamed = materialize(
            connected_components(edges.select(F.col("a").alias("left"), F.col("b").alias("right"))).toDF("old", "new").filter(
                "old <> new"), "cluster-renamed")
    fresh = labels.filter("cluster_id is null").select("id", F.col("id").alias("old"), F.lit(True).alias("fresh"))
    of_old = _held(spark, members, "cluster_id", touched_parts(renamed, "old", parts), none)
    settled = of_old.join(renamed.select(F.col("old").alias("cluster_id")), "cluster_id", "left_semi").select(
        "id", F.col("cluster_id").alias("old"), F.lit(False).alias("fresh"))
    moved = materialize(
        fresh.unionByName(settled).join(renamed, "old", "left").select(
            "id", F.when(~F.col("fresh"), F.col("old")).alias("old"), F.coalesce("new", "old").alias("new")),
        "cluster-moved")

    rows = moved.select("id", F.col("new").alias("cluster_id"))
    both = moved.select(F.col("old").alias("cluster_id")).union(moved.select("new"))
    jobs = []
    for path, key, touched in (
        (by_id, "id", touched_parts(rows, "id", parts)), (members, "cluster_id", touched_parts(both, "cluster_id", parts)),
    ):
        kept = _held(spark, path, key, touched, none).join(moved.select("id"), "id", "left_anti")
        jobs.append(partial(stage, kept.unionByName(rows), path, key, touched, parts))
        paths.append(path)
    together(jobs)
    return Grown(moved, paths)


def _linked(spark: SparkSession, root: str, keys: DataFrame, parts: int) -> tuple[DataFrame, str]:
    """The links of a batch's keys with each other and with those kept, and the path of the staged keys."""
    path = f"{root}/{KEYS}"
    touched = touched_parts(keys, KEY[0], parts)
    held = _held(spark, path, KEY[0], touched, keys)
    names = keys.select(*KEY).distinct()
    met = materialize(held.join(names, list(KEY), "left_semi").unionByName(keys).distinct(), "link-keys-met")
    heads = met.groupBy(*KEY).agg(
        F.min("id").alias("head"), F.min("side").alias("first"), F.max("side").alias("last"),
        F.max("sides").alias("sides"), F.bool_or("linked").alias("was"),
    ).withColumn("now", F.col("was") | (F.col("sides") == 1) | (F.col("first") != F.col("last")))
    joined = met.join(heads.select(*KEY, "head", "now"), list(KEY))
    links = joined.filter("now and id <> head").select(F.col("id").alias("left"), F.col("head").alias("right")).distinct()
    compact = heads.filter("now").select(
        *KEY, F.col("head").alias("id"), F.col("first").alias("side"), "sides", F.lit(True).alias("linked"))
    waiting = joined.filter("not now").select(*keys.columns)
    kept = held.join(names, list(KEY), "left_anti")
    stage(kept.unionByName(compact).unionByName(waiting), path, KEY[0], touched, parts)
    return materialize(links, "links"), path


def add_records(
    spark: SparkSession, root: str, records: DataFrame, settings: LinkSettings, model: LinkModel,
    threshold: float = 0.8, parts: int = PARTS,
) -> None:
    """Let `records` join the clusters below `root`; a run that died may simply be run again. See `stage_records`."""
    settle(spark, root)
    commit(spark, root, stage_records(spark, root, records, settings, model, threshold, parts).paths)


def read_clusters(spark: SparkSession, root: str) -> DataFrame | None:
    """`id` and `cluster_id` of all records so far, or None before the first batch."""
    return read_parts(spark, f"{root}/{BY_ID}", "id")
