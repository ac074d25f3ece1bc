"""Length buckets of least padding, and token-budget batches inside each bucket."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import keep, numbered


def word_count(text: str = "text") -> Column:
    """Words parted by white space; null and blank texts have none."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), " ")
    return F.when(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")) == "", 0).otherwise(F.size(words))


@dataclass(frozen=True)
class Buckets:
    """Ascending padded lengths; a document goes to the first that is long enough."""

    lengths: tuple[int, ...]
    counts: tuple[int, ...]
    padding: int


def boundaries(tops: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> Buckets:
    """The cut of ascending lengths into at most `buckets` runs of least padding.

    cost(i, j) = tops[j-1] * count(i..j-1) - sum(i..j-1). The best start of the last run
    never moves down as j moves up, so each layer is solved by divide and conquer.
    """
    n = len(tops)
    if n == 0:
        return Buckets((), (), 0)
    c = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    s = np.concatenate([[0], np.cumsum(sums, dtype=np.int64)])
    top = np.asarray(tops, dtype=np.int64)
    best = np.concatenate([[0], top * c[1:] - s[1:]])  # one run
    starts = []
    for _ in range(min(buckets, n) - 1):
        layer, start = np.empty(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        layer[0] = 0
        todo = [(1, n, 0, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = best[i] + top[j - 1] * (c[j] - c[i]) - (s[j] - s[i])
            k = int(np.argmin(cost))
            layer[j], start[j] = cost[k], i[k]
            todo += [(low, j - 1, first, int(i[k])), (j + 1, high, int(i[k]), last)]
        starts.append(start)
        best = layer
    cuts, j = [], n
    for start in reversed(starts):
        cuts.append(j)
        j = int(start[j])
        if j == 0:
            break
    else:
        cuts.append(j)
    ends = [j for j in reversed(cuts) if j > 0]
    begins = [0, *ends[:-1]]
    return Buckets(
        tuple(int(top[e - 1]) for e in ends), tuple(int(c[e] - c[b]) for b, e in zip(begins, ends)), int(best[n]))


def fit(lengths: DataFrame, buckets: int) -> Buckets:
    """Bucket lengths from the histogram of the column `n_tokens` over all rows.

    The driver reads one row a distinct length. Different lengths add up, so they are fewer
    than the root of twice the number of tokens.
    """
    rows = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    rows.sort(key=lambda r: r["n_tokens"])
    tops, counts = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("n_tokens", "n"))
    return boundaries(tops, counts, tops * counts, buckets)


def pack(documents: DataFrame, buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_length, batch and slot of every row of `documents`.

    A batch holds documents of one bucket, each padded to the bucket's length, within
    `budget` tokens; a document longer than the budget is a batch of its own. Every row
    of `documents` (doc_id, text) is packed: null and blank texts have no tokens, and
    equal rows take slots of their own. Batches are numbered within a bucket from 0,
    slots within a batch from 0; a hash of doc_id deals the order. An empty table gives
    no rows. Other columns are not read.
    """
    lengths = keep(documents.select("doc_id", word_count().cast("long").alias("n_tokens")), "packing-lengths")
    chosen = fit(lengths, buckets)
    tops = chosen.lengths or (0,)
    bucket = F.lit(len(tops) - 1)
    for k in reversed(range(len(tops) - 1)):
        bucket = F.when(F.col("n_tokens") <= tops[k], k).otherwise(bucket)
    length = F.element_at(F.array(*[F.lit(x).cast("long") for x in tops]), F.col("bucket") + 1)
    capacity = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1))))
    dealt = lengths.withColumn("bucket", bucket.cast("int")).withColumn("bucket_length", length)
    placed = numbered(dealt, "bucket", "doc_id", sum(chosen.counts), len(tops), "at")
    return placed.withColumn("batch", F.floor(F.col("at") / capacity)).withColumn(
        "slot", F.col("at") - F.col("batch") * capacity).drop("at")
