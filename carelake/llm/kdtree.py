"""K-d tree sharding: split at weighted medians along the widest metadata dimension."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import keep, numbered, text_bytes

#: Bytes that each document costs beside its text.
OVERHEAD = 16
#: Buckets of one histogram of a node; the driver reads that many rows a node.
BUCKETS = 512
#: A cut may miss its weight by this share of a shard.
TOLERANCE = 0.002
#: Equal texts of less than this share of a shard are not parted by a cut.
WHOLE_GROUP = 0.01
DIMENSIONS = ("by_size", "by_source", "by_lang")


@dataclass
class Node:
    """Rows of shards `first` to `first + shards - 1`; `cut` parts them into two nodes.

    A row goes left if its code is below `code`, or equal to it and its doc_id below `doc`.
    """

    first: int
    shards: int
    cut: tuple[str, int, int | None] | None = None
    parts: list[Node] = field(default_factory=list)

    def leaf(self) -> Column:
        """The first shard of the leaf of a row."""
        if not self.parts:
            return F.lit(self.first)
        dimension, code, doc = self.cut
        left = F.col(dimension) < code
        if doc is not None:
            left = left | ((F.col(dimension) == code) & (F.col("doc_id") < doc))
        return F.when(left, self.parts[0].leaf()).otherwise(self.parts[1].leaf())

    def leaves(self) -> list[Node]:
        return [self] if not self.parts else [x for p in self.parts for x in p.leaves()]


def cells(documents: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, weight and a code in each dimension.

    A code is a position of 31 bits, then 32 bits of the text's hash, so that equal texts
    have equal codes and others rarely do. Size is its own position; source and language,
    which have no order, take one from a hash. Of equal texts the smallest source and
    language count for all, so copies stay neighbours whatever their rows say.
    """
    rows = documents.select(
        "doc_id",
        (text_bytes() + OVERHEAD).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("same"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
    )
    groups = rows.groupBy("same").agg(F.min("source").alias("source"), F.min("lang").alias("lang"))
    low = F.col("same").bitwiseAND(0xFFFFFFFF)

    def code(position: Column) -> Column:
        return F.shiftleft(position.cast("long"), 32).bitwiseOR(low)

    return rows.drop("source", "lang").join(groups, "same").select(
        "doc_id", "size", "text_crc32",
        code(F.least("size", F.lit((1 << 31) - 1))).alias("by_size"),
        code(F.shiftright(F.crc32("source"), 1)).alias("by_source"),
        code(F.shiftright(F.crc32("lang"), 1)).alias("by_lang"),
    )


@dataclass
class _Search:
    """The weighted quantile of one node, narrowed from histogram to histogram."""

    node: Node
    dimension: str
    low: int
    high: int
    wanted: float
    code: int | None = None  # set when the search goes on among the doc_ids of one code
    done: bool = False

    def width(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // BUCKETS))

    def setting(self) -> Column:
        """What a row needs to find its bucket; a struct of literals."""
        return F.struct(
            F.lit(DIMENSIONS.index(self.dimension) + 1).alias("dimension"), F.lit(self.low).cast("long").alias("low"),
            F.lit(self.high).cast("long").alias("high"), F.lit(self.width()).cast("long").alias("width"),
            F.lit(self.code).cast("long").alias("code"),
        )

    def take(self, buckets: list, leaf: float) -> None:
        """Go on in the bucket that holds the wanted weight, or cut beside it."""
        before = 0
        for b in buckets:
            if before + b["w"] >= self.wanted or b is buckets[-1]:
                break
            before += b["w"]
        over = b["w"]
        alone = b["low"] == b["high"]
        fine = over <= TOLERANCE * leaf
        if not fine and not alone:
            self.low, self.high, self.wanted = b["low"], b["high"], self.wanted - before
        elif alone and not fine and self.code is None and over > WHOLE_GROUP * leaf and b["doc_low"] < b["doc_high"]:
            self.code, self.low, self.high, self.wanted = b["low"], b["doc_low"], b["doc_high"], self.wanted - before
        else:
            nearer = b["low"] if self.wanted - before < over / 2 else b["high"] + 1
            self.node.cut = (self.dimension, nearer, None) if self.code is None else (self.dimension, self.code, nearer)
            self.done = True


def _histograms(rows: DataFrame, root: Node, searches: list[_Search]) -> dict[int, list]:
    """For each search its buckets in order: weight, extent of values and of doc_ids.

    A row finds its search by its leaf's first shard; other rows fall into no bucket.
    """
    kind = "struct<dimension:int,low:bigint,high:bigint,width:bigint,code:bigint>"
    by_first = {s.node.first: s.setting() for s in searches}
    settings = F.array(*[by_first.get(k, F.lit(None)).cast(kind) for k in range(root.shards)])
    at = rows.select("*", root.leaf().alias("node")).withColumn("s", F.element_at(settings, F.col("node") + 1))
    code = F.element_at(F.array(*DIMENSIONS), F.col("s.dimension"))
    value = F.when(F.col("s.code").isNull(), code).when(F.col("s.code") == code, F.col("doc_id"))
    found = at.select("node", "size", "doc_id", "s", value.alias("value")).select(
        "node", "size", "doc_id", "value",
        F.when(F.col("value").between(F.col("s.low"), F.col("s.high")),
               F.floor((F.col("value") - F.col("s.low")) / F.col("s.width"))).alias("bucket"),
    ).groupBy("node", "bucket").agg(
        F.sum("size").alias("w"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.min("doc_id").alias("doc_low"), F.max("doc_id").alias("doc_high"),
    ).collect()
    return {
        s.node.first: sorted((r for r in found if r["node"] == s.node.first and r["bucket"] is not None), key=lambda r: r["bucket"])
        for s in searches
    }


def grow(rows: DataFrame, shards: int) -> Node:
    """The tree over `rows` (as of `cells`) with that many leaves of near equal size.

    Each level takes one job for the nodes' extents and a few for the histograms of all
    its nodes; the driver reads at most BUCKETS rows of a node at a time.
    """
    root = Node(0, shards)
    wide: dict[str, float] = {}
    leaf = 0.0
    while open_nodes := [n for n in root.leaves() if n.shards > 1]:
        extents = {
            r["node"]: r for r in rows.withColumn("node", root.leaf()).groupBy("node").agg(
                F.sum("size").alias("w"),
                *[f(d).alias(f"{k}_{d}") for d in DIMENSIONS for k, f in (("low", F.min), ("high", F.max))],
            ).collect()
        }
        if not wide:
            top = extents.get(0)
            wide = {d: max(1.0, float(top[f"high_{d}"] - top[f"low_{d}"])) if top else 1.0 for d in DIMENSIONS}
            leaf = top["w"] / shards if top else 1.0
        searches = []
        for node in open_nodes:
            half = node.shards // 2
            if (e := extents.get(node.first)) is None:
                node.cut = (DIMENSIONS[0], 0, None)  # no rows: nothing to part
            else:
                widest = max(DIMENSIONS, key=lambda d: (e[f"high_{d}"] - e[f"low_{d}"]) / wide[d])
                searches.append(_Search(node, widest, e[f"low_{widest}"], e[f"high_{widest}"], e["w"] * half / node.shards))
        while active := [s for s in searches if not s.done]:
            found = _histograms(rows, root, active)
            for s in active:
                s.take(found[s.node.first], leaf)
        for node in open_nodes:
            half = node.shards // 2
            node.parts = [Node(node.first, half), Node(node.first + half, node.shards - half)]
    return root


def shard(documents: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of `documents`.

    Shards have near equal bytes: a cut may miss its weight by a document, by equal texts
    of up to WHOLE_GROUP of a shard, or by TOLERANCE. Larger groups of equal texts are
    parted by doc_id. Null texts have no bytes; null sources and languages count as empty;
    a null doc_id goes with the largest. Rows repeated under one doc_id are kept, and stay
    together. An empty table gives no rows. Other columns are not read.
    """
    rows = keep(cells(documents), "shard-cells")
    tree = grow(rows, shards)
    placed = rows.select("doc_id", "size", "text_crc32", tree.leaf().alias("shard"))
    return numbered(placed, "shard", "doc_id", rows.count(), shards, "slot")
