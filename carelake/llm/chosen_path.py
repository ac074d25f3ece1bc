"""Set similarity join of word shingles by chosen paths."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import group_bounds, keep, link_rows, paired_blocks, whole_groups
from carelake.llm.shingles import SKETCH, Shingler, mixed, sketches
from carelake.operators.components import connected_components

#: Sets of a bucket that is compared as it is, in one piece; a larger one is split again.
SMALL = 512
#: Levels of the tree at most.
LEVELS = 4
#: A large bucket is not split further if this share of it resembles one of PIVOTS of its sets.
DENSE, PIVOTS = 0.5, 4
#: Runs at most: a recall that takes more asks for more branches.
MOST_RUNS = 64
#: Sets of a bucket that meet at once.
BLOCK = SMALL
#: Rows of sketches, and of sets, that a task looks at together.
SKETCHES_AT_ONCE, SETS_AT_ONCE = 8_192, 1_024
#: Distinct shingles that a task compares at once.
COLUMNS = 4_096
GROUP = ["key", "first", "second"]


@dataclass(frozen=True)
class Paths:
    """How often to split and repeat.

    At each node a set goes to a child for each token that the node's hash samples, in the
    mean `branches` / `threshold` of its SKETCH tokens; two sets of that similarity share
    `branches` of these children in the mean. Runs from other seeds repeat until a pair at
    the threshold is found with a chance of `recall` or more, pairs above it more surely.
    What is lost is at most half the rest for too few equal min-hashes (`least_agreement`)
    and the whole rest for that and for paths that part in every run (`loss`).
    """

    threshold: float = 0.8
    branches: float = 2.0
    recall: float = 0.9997

    @property
    def chance(self) -> float:
        """That a node samples a token."""
        return min(1.0, self.branches / (self.threshold * SKETCH))

    @property
    def least_agreement(self) -> int:
        """Equal min-hashes that make a candidate: the most that half of the allowed loss permits."""
        least = 0
        while self._agreement_below(least + 1) <= (1 - self.recall) / 2:
            least += 1
        return least

    @property
    def runs(self) -> int:
        """Runs that reach the recall."""
        return next(n for n in range(1, MOST_RUNS + 1) if n == MOST_RUNS or self.loss(n) <= 1 - self.recall)

    def _agreeing(self, equal: int) -> float:
        return math.comb(SKETCH, equal) * self.threshold**equal * (1 - self.threshold) ** (SKETCH - equal)

    def _agreement_below(self, least: int) -> float:
        return sum(self._agreeing(a) for a in range(least))

    def loss(self, runs: int) -> float:
        """The chance that a pair at the threshold is not found in so many runs of LEVELS levels."""
        lost = self._agreement_below(self.least_agreement)
        for equal in range(self.least_agreement, SKETCH + 1):
            parted = 0.0  # that no path is shared down to a level, from the last level up
            for _ in range(LEVELS):
                parted = (1 - self.chance + self.chance * parted) ** equal
            lost += self._agreeing(equal) * parted**runs
        return lost

    def children(self, sketch: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, child) for each child of the node `nodes[row]` that the set of the row goes to."""
        place = (np.arange(SKETCH, dtype=np.uint64) + np.uint64(1)) << np.uint64(32)
        token = mixed(sketch.astype(np.uint64) | place)
        child = mixed(token ^ nodes[:, None])
        row, column = np.nonzero(mixed(child) < np.uint64(int(self.chance * (2**64 - 1))))
        return row, child[row, column]


def _sketch_rows(values: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), dtype=np.uint32).reshape(-1, SKETCH)


def sketched(documents: DataFrame) -> DataFrame:
    """doc_id, same, node and sketch of each row: `node` names the set, equal for equal sets; null without words."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in batches:
            sets = [shingle(t.as_py()) for t in batch.column("text")]
            full = [i for i, s in enumerate(sets) if len(s)]
            sketch: list[bytes | None] = [None] * len(sets)
            for k in range(0, len(full), 256):
                some = full[k:k + 256]
                for i, row in zip(some, sketches([sets[i] for i in some])):
                    sketch[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("same"), pa.array([node_of(s) if len(s) else None for s in sets], type=pa.int64()),
                pa.array(sketch, type=pa.binary()),
            ], names=["doc_id", "same", "node", "sketch"])

    same = F.xxhash64(F.coalesce("text", F.lit(""))).alias("same")
    return documents.select("doc_id", "text", same).mapInArrow(run, f"doc_id {kind}, same long, node long, sketch binary")


def node_of(shingles: np.ndarray) -> int:
    """64 bits for a set."""
    line = mixed(shingles + (np.arange(len(shingles), dtype=np.uint64) << np.uint64(1)))
    return int(mixed(np.array([line.sum(dtype=np.uint64) + np.uint64(len(shingles))])).view(np.int64)[0])


def _first_level(classes: DataFrame, paths: Paths) -> DataFrame:
    runs = paths.runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch, node = _sketch_rows(batch.column("sketch")), batch.column("node").to_numpy()
            for r in range(runs):
                root = mixed(np.full(len(node), r + 1, dtype=np.uint64))
                row, child = paths.children(sketch, root)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(node[row])], names=["key", "node"])

    return classes.select("node", "sketch").mapInArrow(run, "key long, node long")


def _next_level(rows: DataFrame, paths: Paths) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            row, child = paths.children(_sketch_rows(batch.column("sketch")), batch.column("key").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(node[row])], names=["key", "node"])

    return rows.select("key", "node", "sketch").mapInArrow(run, "key long, node long")


def _resembling(rows: DataFrame, paths: Paths) -> DataFrame:
    """key and share: how many sets of each bucket are candidates with one of PIVOTS sets of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, like = _sketch_rows(batch.column("sketch")), np.zeros(len(batch), dtype=bool)
            for p in pivots:
                like |= (own == _sketch_rows(batch.column(p))).sum(axis=1) >= paths.least_agreement
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(like.astype(np.float64))], names=["key", "like"])

    pivots = [f"pivot{i}" for i in range(PIVOTS)]
    # of each key the set whose hash is the least, once for each of PIVOTS hashes
    chosen = rows.groupBy("key").agg(*[
        F.min(F.struct(F.xxhash64("node", F.lit(i)), "sketch"))["sketch"].alias(p) for i, p in enumerate(pivots)])
    return rows.join(chosen, "key").select("key", "sketch", *pivots).mapInArrow(run, "key long, like double").groupBy("key").agg(
        F.avg("like").alias("share"))


def buckets(classes: DataFrame, paths: Paths) -> DataFrame:
    """key, node and n: the buckets of two sets and more that are not split further."""
    rows = keep(_first_level(classes, paths), "paths")
    out = None
    for level in range(1, LEVELS + 1):
        sizes = keep(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "path-sizes")
        ends = sizes
        more = level < LEVELS and bool(sizes.filter(F.col("n") > SMALL).take(1))
        if more:
            large = keep(
                rows.join(sizes.filter(F.col("n") > SMALL).select("key"), "key").join(classes.select("node", "sketch"), "node"),
                "path-large")
            split = keep(_resembling(large, paths).filter(F.col("share") < DENSE).select("key"), "path-splits")
            ends = sizes.join(split, "key", "left_anti")
        part = rows.join(ends, "key")
        out = part if out is None else out.unionByName(part)
        if not more:
            break
        rows = keep(_next_level(large.join(split, "key"), paths), "paths")
    return out.select("key", "node", "n")


def _earlier(key: int, lists: list[np.ndarray]) -> np.ndarray:
    """Which pairs of rows share a bucket of a smaller key; `lists` has the keys of each row."""
    sizes = [len(x) for x in lists]
    line, row = np.concatenate(lists), np.repeat(np.arange(len(lists)), sizes)
    low = line < key
    found, at, n = np.unique(line[low], return_inverse=True, return_counts=True)
    shared = n > 1
    column = np.cumsum(shared) - 1
    member = np.zeros((len(lists), int(shared.sum())), dtype=np.float32)
    rows, at = row[low], at.reshape(-1)
    member[rows[shared[at]], column[at[shared[at]]]] = 1
    return (member @ member.T) > 0


def _open_pairs(table: pa.Table, start: int, stop: int) -> np.ndarray:
    """Pairs of rows of one group that count in it: met in no earlier bucket, and in no other pair of blocks."""
    key = table["key"][start].as_py()
    keys = table["keys"].chunk(0)
    lists = [np.asarray(keys[i].values) for i in range(start, stop)]
    pairs = np.triu(~_earlier(key, lists), 1)
    if table["first"][start].as_py() != table["second"][start].as_py():
        block = table["block"].to_numpy()[start:stop]
        pairs &= block[:, None] != block[None, :]
    node = table["node"].to_numpy()[start:stop]
    return pairs & (node[:, None] != node[None, :])


def _candidates(rows: DataFrame, paths: Paths) -> DataFrame:
    """The rows of `rows` that have a candidate among the pairs that count in their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, GROUP, SKETCHES_AT_ONCE):
            sketch = _sketch_rows(table["sketch"].combine_chunks())
            wanted = np.zeros(len(table), dtype=bool)
            for start, stop in group_bounds(table, GROUP):
                own = sketch[start:stop]
                agree = np.zeros((stop - start, stop - start), dtype=np.uint8)
                for c in range(SKETCH):
                    agree += own[:, c, None] == own[None, :, c]
                near = np.triu(agree >= paths.least_agreement, 1)
                if near.any():
                    near &= _open_pairs(table, start, stop)
                    wanted[start:stop] = near.any(axis=0) | near.any(axis=1)
            yield from table.select([*GROUP, "block", "node", "keys"]).filter(pa.array(wanted)).to_batches()

    return rows.mapInArrow(run, "key long, first int, second int, block int, node long, keys array<long>")


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    at = at.reshape(-1)
    twice = n[at] > 1
    row, at = row[twice], (np.cumsum(n > 1) - 1)[at[twice]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        a, b = np.searchsorted(at, [low, low + COLUMNS])
        member = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        member[row[a:b], at[a:b] - low] = 1
        out += member @ member.T
    return out


def _verified(rows: DataFrame, paths: Paths) -> DataFrame:
    """id, n_links and root: partial counts and edges of the pairs that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, GROUP, SETS_AT_ONCE):
            node, weight = table["node"].to_numpy(), table["weight"].to_numpy()
            data = table["set"].to_pylist()
            left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for start, stop in group_bounds(table, GROUP):
                once = start + np.sort(np.unique(node[start:stop], return_index=True)[1])
                sets = [np.frombuffer(data[i], dtype=np.uint64) for i in once]
                if len(sets) < 2:
                    continue
                size = np.array([len(s) for s in sets], dtype=np.float64)
                shared = _shared_counts(sets)
                total = size[:, None] + size[None, :] - shared
                near = _open_pairs(table, start, stop)[np.ix_(once - start, once - start)]
                a, b = np.nonzero(np.triu(near, 1) & (shared >= paths.threshold * total - 1e-9))
                left.append(once[a])
                right.append(once[b])
            yield link_rows(node, weight, np.concatenate(left), np.concatenate(right))

    return rows.mapInArrow(run, "id long, n_links long, root long")


def _sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and set of the classes `wanted` (node, doc_id), from the texts of their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in batches:
            sets = [shingle(t.as_py()) for t in batch.column("text")]
            nodes = batch.column("node").to_pylist()
            # an id may stand for several texts
            own = [(n, s.tobytes()) for n, s in zip(nodes, sets) if len(s) and node_of(s) == n]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in own], type=pa.int64()), pa.array([s for _, s in own], type=pa.binary())],
                names=["node", "set"])

    return documents.select("doc_id", "text").join(wanted, "doc_id").select("node", "text").mapInArrow(run, "node long, set binary")


def _grouped(df: DataFrame) -> DataFrame:
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count, *GROUP).sortWithinPartitions(*GROUP)


def one_of_each(documents: DataFrame, paths: Paths = Paths()) -> DataFrame:
    """The rows of `documents` that are their class's own document, with all their columns.

    Of rows repeated under one doc_id with one text a single one stays; rows without an id stay.
    """
    chosen = similar(documents, paths).filter("kept").select("doc_id", "same").distinct()
    marked = documents.withColumn("same", F.xxhash64(F.coalesce("text", F.lit(""))))
    named = marked.filter(F.col("doc_id").isNotNull()).join(chosen, ["doc_id", "same"], "left_semi").dropDuplicates(["doc_id", "same"])
    return named.unionByName(marked.filter(F.col("doc_id").isNull())).select(*documents.columns)


def similar(documents: DataFrame, paths: Paths = Paths()) -> DataFrame:
    """doc_id, class_id, n_links, kept and same for every row of `documents` (doc_id, text).

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles
    reaches the threshold; words are parted by white space, and a text of fewer words is
    one shingle. class_id is the smallest doc_id reachable by links, n_links the number of
    documents linked directly, kept marks the class's own document. Null and blank texts
    have no words and link with nothing; a null doc_id keeps a null class. Rows repeated
    under one doc_id are documents of their own in the counts. `same` is a hash of the
    text. Other columns are not read.

    Documents of equal sets are one class from the start. Classes are split by chosen
    paths until buckets are small or all alike; a pair counts in the bucket of the
    smallest key that it shares. Sketches choose the rows whose sets are compared exactly.
    Tasks return counts and one edge a set, never pairs.
    """
    rows = keep(sketched(documents), "path-sketches")
    known = rows.filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    classes = keep(known.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("weight"), F.min("sketch").alias("sketch")), "path-classes")
    ends = keep(buckets(classes, paths), "path-buckets")
    lists = ends.groupBy("node").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    met = paired_blocks(ends, "node", "n", BLOCK).join(lists.join(classes.select("node", "sketch"), "node"), "node")
    chosen = keep(_candidates(_grouped(met.select(*GROUP, "block", "node", "keys", "sketch")), paths), "path-candidates")
    wanted = keep(chosen.select("node").distinct().join(classes, "node").select("node", "doc_id", "weight"), "path-wanted")
    sets = _sets(documents, wanted.select("node", "doc_id")).join(wanted.select("node", "weight"), "node")
    found = keep(_verified(_grouped(chosen.join(sets, "node")), paths), "path-links")
    components = connected_components(found.select(F.col("id").alias("left"), F.col("root").alias("right")))
    reached = classes.select("node", "doc_id", "weight").join(
        found.groupBy(F.col("id").alias("node")).agg(F.sum("n_links").alias("linked")), "node", "left",
    ).join(components.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = reached.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    numbers = keep(reached.join(smallest, "component").select(
        "node", "class_id", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "path-numbers")
    named = rows.select("doc_id", "same", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
    return named.join(numbers, "node", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.coalesce("class_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"), "same",
    )
