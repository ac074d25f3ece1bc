"""Centroid clustering by Lloyd's rounds over blocks of columns, in whole numbers.

A vector is cut into blocks of BLOCK columns. A task holds rows of one block and meets
that block's slice of the centroids only: it gives exact partial squared distances, the
blocks of a row are added by key, the least sum assigns the row, and the assignment goes
back to the blocks, each of which updates its own slice. The vectors are packed and dealt
once; a round ships partial distances and assignments. Everything is whole numbers, so no
result depends on the order of sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import checkpointed, keep

#: Columns of a block.
BLOCK = 16
#: Rows that are packed together.
ROWS = 512
#: Packed bytes of a partition, about.
PARTITION_BYTES = 32 << 20
#: Components stand for whole numbers below this, so that every squared distance fits a long.
LIMIT = 1 << 26

_PACKED = "chunk long, block int, n int, ids binary, data binary"
_NULL_ID = np.iinfo(np.int64).min


def whole_components(vectors: DataFrame, dimensions: int, scale: int = 1024) -> DataFrame:
    """vec_id and `parts`, the whole numbers floor(scale * x), of the vectors that take part."""
    parts = F.transform("embedding", lambda x: F.floor(x.cast("double") * float(scale)))
    usable = (F.size("embedding") == dimensions) & F.forall(
        "embedding", lambda x: F.coalesce(F.abs(x.cast("double") * float(scale)) < float(LIMIT), F.lit(False)))
    # NaN is greater than any number here, so the bound leaves it out too
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(
        F.coalesce(usable, F.lit(False))).select("vec_id", parts.alias("parts"))


def first_centroids(kept: DataFrame, k: int, salt: str) -> DataFrame:
    """cluster and parts of the k vectors whose sha256 of `salt:vec_id` is least; a top-k, so k rows a task."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    chosen = kept.select(order.alias("place"), "parts").orderBy(F.asc_nulls_last("place"), "parts").limit(k)
    # one array of k vectors, whose places are the cluster numbers
    return chosen.agg(F.sort_array(F.collect_list(F.struct(F.col("place").isNull(), "place", "parts"))).alias("all")).select(
        F.posexplode(F.transform("all", lambda s: s["parts"])).alias("cluster", "parts"))


def _pack(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                some = batch.slice(start, ROWS)
                ids = some.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                x = some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1).astype("<i4")
                blocks = range(0, x.shape[1], width)
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk] * len(blocks), pa.int64()), pa.array(range(len(blocks)), pa.int32()),
                    pa.array([len(some)] * len(blocks), pa.int32()),
                    # the ids travel once, with the first block
                    pa.array([ids if b == 0 else None for b in blocks], pa.binary()),
                    pa.array([np.ascontiguousarray(x[:, b:b + width]).tobytes() for b in blocks], pa.binary()),
                ], names=["chunk", "block", "n", "ids", "data"])
                chunk += 1
    return run


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Squared distances of each row's block from the block's slice of every centroid."""
    for batch in batches:
        out = []
        for n, data, slices in zip(*(batch.column(c).to_pylist() for c in ("n", "data", "slices"))):
            x = np.frombuffer(data, "<i4").reshape(n, -1).astype(np.int64)
            c = np.array(slices, dtype=np.int64)
            out.append(np.stack([((x - one) ** 2).sum(axis=1) for one in c], axis=1).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("chunk"), batch.column("n"), batch.column("ids"), pa.array(out, pa.binary())],
            names=["chunk", "n", "ids", "partial"])


def _nearest(group: pa.Table) -> pa.Table:
    """The blocks of one chunk added; the least distance wins, then the smaller number."""
    n = group["n"][0].as_py()
    total = np.zeros(0, dtype=np.int64)
    for part in group["partial"].to_pylist():
        partial = np.frombuffer(part, "<i8")
        total = partial if not len(total) else total + partial
    total = total.reshape(n, -1)
    nearest = total.argmin(axis=1)
    ids = next(i for i in group["ids"].to_pylist() if i is not None)
    return pa.table({
        "chunk": group["chunk"].slice(0, 1), "ids": pa.array([ids], pa.binary()),
        "cluster": pa.array([nearest.astype("<i4").tobytes()], pa.binary()),
        "distance": pa.array([total[np.arange(n), nearest].astype("<i8").tobytes()], pa.binary()),
    })


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and sums of each block's columns by cluster, over the rows of a batch."""
    for batch in batches:
        found: dict[tuple[int, int], list] = {}
        for block, n, data, cluster in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "data", "cluster"))):
            x = np.frombuffer(data, "<i4").reshape(n, -1).astype(np.int64)
            near = np.frombuffer(cluster, "<i4")
            for k in np.unique(near).tolist():
                mine = x[near == k]
                entry = found.setdefault((block, k), [0, 0])
                entry[0] += len(mine)
                entry[1] = entry[1] + mine.sum(axis=0)
        rows = [(b, k, d, int(v), count) for (b, k), (count, sums) in found.items() for d, v in enumerate(sums)]
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
            names=["block", "cluster", "place", "total", "count"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, cluster, distance in zip(*(batch.column(c).to_pylist() for c in ("ids", "cluster", "distance"))):
            vec = np.frombuffer(ids, "<i8")
            yield pa.RecordBatch.from_arrays([
                pa.array(vec, pa.int64(), mask=vec == _NULL_ID), pa.array(np.frombuffer(cluster, "<i4"), pa.int32()),
                pa.array(np.frombuffer(distance, "<i8"), pa.int64())], names=["vec_id", "cluster", "distance"])


def _by_number(columns: list[str], values: Column) -> Column:
    """The values of a group in the order of `columns`."""
    ordered = F.sort_array(F.collect_list(F.struct(*columns, values.alias("_value"))))
    return F.transform(ordered, lambda s: s["_value"])


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dimensions: int = 64, salt: str = "3", scale: int = 1024,
    width: int = BLOCK,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of the vectors (vec_id, embedding).

    Kept are vectors of exactly `dimensions` components, none null or not finite, nor of
    LIMIT / scale and more (a squared distance would not fit a long). Each row counts, repeated
    ones too. A row with a null vec_id is clustered, and comes last where the first centroids
    are chosen; of equal ids there, the smaller components come first. Fewer than k kept vectors
    give fewer centroids, none an empty result. Other columns are not read. Small tables only
    are broadcast: k vectors of `dimensions` components.
    """
    kept = whole_components(vectors, dimensions, scale)
    packed = keep(kept.mapInArrow(_pack(width), _PACKED), "lloyd-packed")
    size = packed.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    deal = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    slices = checkpointed(packed.repartition(deal, "chunk", "block"))

    blocks = F.transform(
        F.sequence(F.lit(0), F.lit(dimensions - 1), F.lit(width)),
        lambda at: F.struct((at / width).cast("int").alias("block"), F.slice("parts", at + 1, width).alias("values")))
    start = first_centroids(kept, k, salt).select("cluster", F.explode(blocks).alias("b")).select(
        "b.block", "cluster", F.posexplode("b.values").alias("place", "value"))
    centroids = keep(start, "lloyd-centroids")

    def assigned() -> DataFrame:
        sliced = centroids.groupBy("block", "cluster").agg(_by_number(["place"], F.col("value")).alias("one")).groupBy(
            "block").agg(_by_number(["cluster"], F.col("one")).alias("slices"))
        met = slices.join(F.broadcast(sliced), "block").select("chunk", "n", "ids", "data", "slices")
        partial = met.mapInArrow(_partial, "chunk long, n int, ids binary, partial binary")
        return partial.groupBy("chunk").applyInArrow(_nearest, "chunk long, ids binary, cluster binary, distance binary")

    n_blocks = -(-dimensions // width)
    for _ in range(rounds):
        to_blocks = assigned().select(
            "chunk", "cluster", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
        sums = slices.select("chunk", "block", "n", "data").join(to_blocks, ["chunk", "block"]).select(
            "block", "n", "data", "cluster").mapInArrow(_sums, "block int, cluster int, place int, total long, count long")
        # decimals, so that no number of rows overflows
        added = sums.groupBy("block", "cluster", "place").agg(
            F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("count").alias("count"))
        count = F.col("count").cast("decimal(20,0)")
        floor = ((F.col("total") - F.pmod("total", count)) / count).cast("long")
        moved = added.select("block", "cluster", "place", floor.alias("moved"))
        centroids = keep(
            centroids.join(moved, ["block", "cluster", "place"], "left").select(
                "block", "cluster", "place", F.coalesce("moved", "value").alias("value")), "lloyd-centroids")

    rows = keep(assigned().mapInArrow(_unpack, "vec_id long, cluster int, distance long"), "lloyd-assigned")
    digits = F.array_join(_by_number(["block", "place"], F.col("value").cast("string")), ",")
    digests = centroids.groupBy("cluster").agg(F.sha2(digits, 256).alias("centroid_sha256"))
    all_clusters = Window.partitionBy(F.lit(0))  # of at most k rows
    inertia = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).withColumn(
        "inertia", F.sum("cluster_inertia").over(all_clusters))
    return rows.join(F.broadcast(inertia), "cluster").join(F.broadcast(digests), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
