"""What the operators of this package share."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.session import materialize, workspace

#: Rows that one task numbers at most, about.
ROWS_PER_CHUNK = 100_000
#: Chunks of a group at least, so that a small table is numbered in parallel too.
LEAST_CHUNKS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Rows written to the shared folder of spark.checkpoint.dir and read back."""
    return materialize(df, purpose)


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` checkpointed to the shared folder, which keeps its partitioning, so joins on it need no shuffle."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(workspace(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def let_go(df: DataFrame) -> None:
    """Have Spark remove the shuffle files of jobs that have ended.

    It does so once the driver's garbage is collected, and a driver that waits for its
    executors hardly makes any (see spark.cleaner.periodicGC.interval).
    """
    for _ in range(3):  # what is found once may have held more
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def text_bytes(text: str = "text") -> Column:
    """Bytes of the text in UTF-8; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def numbered(df: DataFrame, group: str, key: str, rows: int, groups: int, name: str) -> DataFrame:
    """`df` with `name`: a gapless number from 0 within each value of `group`.

    A group is dealt into chunks by a hash of `key`, so no group meets in one task: rows
    are numbered inside their chunk, and the chunk's first number is the running sum of
    the chunks' counts. `rows` and `groups` are the table's sizes; they set the number
    of chunks only.
    """
    chunks = max(LEAST_CHUNKS, rows // (max(1, groups) * ROWS_PER_CHUNK) + 1)
    dealt = df.withColumn("_chunk", F.pmod(F.xxhash64(key), F.lit(chunks)))
    before = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy(group, "_chunk").agg(F.count(F.lit(1)).alias("_n")).select(
        group, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
    )
    inside = Window.partitionBy(group, "_chunk").orderBy(key, *[c for c in df.columns if c not in (group, key)])
    counted = dealt.withColumn("_row", F.row_number().over(inside) - 1)
    return counted.join(firsts, [group, "_chunk"]).withColumn(
        name, (F.col("_first") + F.col("_row")).cast("long")
    ).drop("_chunk", "_first", "_row")


def paired_blocks(df: DataFrame, row: str, rows: str, block: int) -> DataFrame:
    """`df` with `block`, `first` and `second`, in place of the column `rows`, its group's size.

    A group of more than `block` rows is dealt into blocks by a hash of `row`, and every
    pair of blocks, named by the smaller number and the larger, becomes a group of its own.
    """
    blocks = F.ceil(F.col(rows) / block).cast("int")
    dealt = df.withColumn("_blocks", blocks).withColumn("block", F.pmod(F.xxhash64(row), F.col("_blocks")).cast("int"))
    met = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return met.withColumns({
        "first": F.least("block", "_other"), "second": F.greatest("block", "_other"),
    }).drop("_blocks", "_other", rows)


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str], at_once: int) -> Iterator[pa.Table]:
    """Tables of about `at_once` rows, no group of equal `names` parted; rows come in order of `names`."""
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        waiting.append(batch)
        rows += len(batch)
        if rows < at_once:
            continue
        table = pa.Table.from_batches(waiting)
        same = np.logical_and.reduce([(c := table[n].to_numpy()) == c[-1] for n in names])
        cut = int(np.argmax(same))  # the last group may go on
        if cut:
            yield table.slice(0, cut).combine_chunks()
            waiting, rows = table.slice(cut).to_batches(), len(table) - cut
    if rows:
        yield pa.Table.from_batches(waiting).combine_chunks()


def group_bounds(table: pa.Table, names: list[str]) -> list[tuple[int, int]]:
    """Starts and ends of the groups of equal `names`."""
    changes = np.logical_or.reduce([np.diff(table[n].to_numpy()) != 0 for n in names])
    new = (np.flatnonzero(changes) + 1).tolist()
    return list(zip([0, *new], [*new, len(table)]))


def roots(a: np.ndarray, b: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each node the place of the node of least `rank` that the links (a, b) reach; a node is a place in `rank`."""
    order = np.argsort(rank, kind="stable")
    low = np.empty(len(rank), dtype=np.int64)
    low[order] = np.arange(len(rank))
    while True:
        before = low.copy()
        least = np.minimum(low[a], low[b])
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        low = np.minimum(low, low[order[low]])
        if (low == before).all():
            return order[low]


def link_rows(ids: np.ndarray, weight: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """id, n_links and root of the ids that the links (a, b), places in `ids`, join: a row each."""
    nodes, at = np.unique(np.concatenate([ids[a], ids[b]]), return_inverse=True)
    left, right = at[: len(a)], at[len(a):]
    n = np.bincount(left, weights=weight[b], minlength=len(nodes)) + np.bincount(right, weights=weight[a], minlength=len(nodes))
    root = nodes[roots(left, right, nodes)] if len(nodes) else nodes
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes), pa.array(n.astype(np.int64)), pa.array(root)], names=["id", "n_links", "root"])
