"""Near-duplicate vectors by E8 lattice hashing: probe neighbouring cells, verify the cosine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import group_bounds, keep, link_rows, paired_blocks, whole_groups
from carelake.llm.e8 import nearest_cells
from carelake.llm.onebit import usable
from carelake.operators.components import connected_components

#: Rows of a cell that meet at once; a larger cell is parted into blocks that meet in pairs.
BLOCK = 1024
#: Rows that a task looks at together, about.
AT_ONCE = 20_000
GROUP = ["key", "first", "second"]


@dataclass(frozen=True)
class Lattice:
    """`tables` hashes, each of `blocks` random projections to 8 dimensions.

    `scale` is the width of a cell, `probes` the neighbouring cells that a row visits in
    each block beside its own. Two vectors meet in a table if one visits the other's cell.
    """

    dimension: int
    tables: int
    blocks: int
    scale: float
    probes: int
    seed: int = 11

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """rows x tables x cells visited, as 64-bit keys; the first cell is the row's own."""
        out = []
        for t in range(self.tables):
            rng = np.random.default_rng((self.seed, t))
            own, probed = rng.integers(1 << 62, dtype=np.int64).astype(np.uint64), []
            for _ in range(self.blocks):
                turn = rng.standard_normal((self.dimension, 8)) / self.scale
                # rounded, so that a row's cell does not depend on the rows beside it
                x = np.round((unit @ turn + rng.random(8)) * 2.0**20) / 2.0**20
                weights = rng.integers(1 << 63, size=8, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
                hashes = (nearest_cells(x, self.probes).astype(np.uint64) * weights).sum(axis=2, dtype=np.uint64)
                own = own + hashes[:, 0]
                probed.append(hashes[:, 1:] - hashes[:, :1])
            out.append(np.concatenate([own[:, None], *[own[:, None] + p for p in probed]], axis=1))
        return np.stack(out, axis=1).view(np.int64)


def lattice_for(dimension: int, rows: int) -> Lattice:
    """Settings that find 99.9 % and more of the pairs of cosine 0.9, nearly all of those above, at every size.

    One projection of 8 dimensions parts up to some hundred thousand rows well enough;
    each further one parts a thousand times more, and needs more tables.
    """
    if rows <= 200_000:
        return Lattice(dimension, tables=14, blocks=1, scale=1.4, probes=4)
    if rows <= 200_000_000:
        return Lattice(dimension, tables=14, blocks=2, scale=2.0, probes=8)
    return Lattice(dimension, tables=24, blocks=3, scale=2.4, probes=8)


def _unit(values: pa.Array, dimension: int) -> np.ndarray:
    x = np.asarray(values.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dimension)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _meetings(table: pa.Table, lattice: Lattice, threshold: float) -> pa.RecordBatch:
    """id, n_links and root of the links that count in the cells of `table`, whole and in order.

    A pair may meet in several cells; it counts in the one of the smallest key.
    """
    key, first, second, block = (table[c].to_numpy() for c in (*GROUP, "block"))
    home = table["home"].to_numpy(zero_copy_only=False)
    ids, weight = table["vec_id"].to_numpy(), table["weight"].to_numpy()
    unit = _unit(table["v"].combine_chunks(), lattice.dimension)
    left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for start, stop in group_bounds(table, GROUP):
        if stop - start < 2:
            continue
        rows = unit[start:stop]
        near = np.triu(rows @ rows.T >= threshold, 1)
        a, b = np.nonzero(near)
        if not len(a):
            continue
        a, b = a + start, b + start
        fits = home[a] | home[b]
        if first[start] != second[start]:
            fits &= block[a] != block[b]
        left.append(a[fits])
        right.append(b[fits])
    a, b = np.concatenate(left), np.concatenate(right)
    rows, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    keys = lattice.keys(unit[rows])
    a_at, b_at = at[: len(a)], at[len(a):]
    counts = np.ones(len(a), dtype=bool)
    for t in range(lattice.tables):
        for x, y in ((a_at, b_at), (b_at, a_at)):
            theirs = keys[y, t, 0]
            counts &= ~((theirs < key[a]) & (keys[x, t] == theirs[:, None]).any(axis=1))
    return link_rows(ids, weight, a[counts], b[counts])


def _linked(vectors: DataFrame, lattice: Lattice, threshold: float) -> DataFrame:
    """id, n_links and root: partial counts and edges of `vectors` (vec_id, weight, v)."""
    d, tables = lattice.dimension, lattice.tables
    visited = 1 + lattice.blocks * lattice.probes

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = lattice.keys(_unit(batch.column("v"), d))
            n = len(keys)
            home = np.zeros((n, tables, visited), dtype=bool)
            home[:, :, 0] = True
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column("vec_id").to_numpy(), tables * visited)),
                pa.array(keys.reshape(-1)), pa.array(home.reshape(-1))], names=["vec_id", "key", "home"])

    visits = keep(vectors.select("vec_id", "v").mapInArrow(cells, "vec_id long, key long, home boolean"), "lattice-visits")
    sizes = keep(visits.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.max("home").alias("home"),
    ).filter(F.col("home") & (F.col("n") > 1)).select("key", "n"), "lattice-cells")
    met = paired_blocks(visits.join(sizes, "key"), "vec_id", "n", BLOCK)
    full = met.join(vectors, "vec_id").select(*GROUP, "block", "home", "vec_id", "weight", "v")
    count = int(full.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, GROUP, AT_ONCE):
            yield _meetings(table, lattice, threshold)

    return full.repartition(count, *GROUP).sortWithinPartitions(*GROUP).mapInArrow(compare, "id long, n_links long, root long")


def near_duplicates(embeddings: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector of `embeddings` (vec_id, embedding).

    Two vectors are linked if they meet in a lattice cell and their cosine, in double
    precision, reaches `threshold`. n_links counts the vectors linked directly;
    component_id is the smallest id reachable by links, kept marks that id. Null, empty
    and zero vectors, those with null or non-finite components, and vectors of different
    dimensions link with nothing. Rows repeated under one vec_id count as one, with the
    smallest vector. A null id has no links and no component. Other columns are not read.

    Equal vectors are taken together first. Cells too large for one task are parted into
    blocks that meet in pairs; a task returns counts and one edge a vector, never pairs.
    """
    rows = keep(embeddings.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("v")), "vectors")
    good = rows.filter(F.col("vec_id").isNotNull() & usable("v"))
    same = keep(good.groupBy("v").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight")), "distinct-vectors")
    parts = []
    for size in same.groupBy(F.size("v").alias("d")).count().collect():
        lattice = lattice_for(size["d"], size["count"])
        parts.append(_linked(same.filter(F.size("v") == size["d"]), lattice, threshold))
    if not parts:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = keep(found, "lattice-links")
    counts = found.groupBy(F.col("id").alias("vec_id")).agg(F.sum("n_links").alias("linked"))
    components = connected_components(found.select(F.col("id").alias("left"), F.col("root").alias("right")))
    classes = same.join(counts, "vec_id", "left").join(
        components.withColumnRenamed("id", "vec_id"), "vec_id", "left",
    ).select(
        "v", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )
    classes = keep(classes, "vector-classes")
    member = good.join(classes, "v").select("vec_id", "n_links", "component_id")
    return rows.select("vec_id").join(member, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
