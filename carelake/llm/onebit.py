"""Nearest neighbours by randomly rotated one-bit codes, reranked within error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block of candidates and of queries, and queries that are looked at together.
CANDIDATES, QUERIES, AT_ONCE = 8192, 4096, 128
#: Width of the error bound, in standard errors of the estimate.
BOUND = 2.0


def usable(vector: str) -> Column:
    """Not null or empty, only finite components, and not all of them zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def rotation(dimension: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def code(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated residuals, the residuals' lengths, and their
    inner products with the unit vectors of their codes."""
    residual = (vectors - centre) @ turn.T
    length = np.linalg.norm(residual, axis=1)
    bits = residual >= 0
    signs = np.where(bits, 1.0, -1.0) / np.sqrt(vectors.shape[1])
    with np.errstate(invalid="ignore", divide="ignore"):
        agreement = np.where(length > 0, (signs * residual).sum(axis=1) / length, 1.0)
    return np.packbits(bits, axis=1), length, agreement


def estimates(queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, bits: np.ndarray, length: np.ndarray,
              agreement: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries (rows) with coded vectors, and their error bounds.

    <v, q> = <centre, q> + |v - centre| <o, q'>, where q' is the rotated query and o the
    residual's direction. <code, q'> / <code, o> estimates the last term without bias; its
    error is about |q'| sqrt((1 - a^2) / a^2) / sqrt(d - 1) with a = <code, o>.
    """
    d = queries.shape[1]
    turned = queries @ turn.T
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
    raw = (turned.astype(np.float32) @ signs.T) / np.float32(np.sqrt(d))
    guess = (queries @ centre)[:, None] + raw * (length / agreement)[None, :]
    spread = length * np.sqrt(np.maximum(0.0, 1 - agreement**2)) / agreement / np.sqrt(max(1, d - 1))
    slack = 1e-5 * length + 1e-12
    return guess, np.linalg.norm(queries, axis=1)[:, None] * (BOUND * spread + slack)[None, :]


def _rows(values: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(values.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dimension)


def _block_search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, coded: tuple,
                  centre: np.ndarray, turn: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of the k best candidates of a block for each query.

    The candidates of the best estimates are scored first; the k-th of these scores is a
    floor. All others whose estimate plus error bound reaches it are scored too, on the
    original vectors.
    """
    guess, error = estimates(queries, centre, turn, *coded)
    own = query_ids[:, None] == ids[None, :]
    guess[own] = -np.inf
    first = min(len(ids), 4 * k)
    start = np.argpartition(guess, len(ids) - first, axis=1)[:, len(ids) - first:]
    out_q, out_v, out_s = [], [], []
    for i in range(len(query_ids)):
        scores = (vectors[start[i]] * queries[i]).sum(axis=1)
        scores[own[i, start[i]]] = -np.inf
        floor = np.partition(scores, first - k)[first - k] if first > k else -np.inf
        near = np.flatnonzero(guess[i] + error[i] >= floor)
        near = np.union1d(near, start[i])
        near = near[~own[i, near]]
        score = (vectors[near] * queries[i]).sum(axis=1)
        best = np.lexsort((ids[near], -score))[:k]
        out_q.append(np.full(len(best), query_ids[i]))
        out_v.append(ids[near][best])
        out_s.append(score[best])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def search(embeddings: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score: for each query its k nearest rows by inner product.

    `embeddings` has vec_id and embedding; `queries` is a condition that names the rows
    to search for. Candidates are all other usable rows of the same dimension; the query's
    own id is left out, also where it is repeated. Nearest first, ties to the smaller
    vec_id, all candidates if there are fewer than k. Scores are inner products in double
    precision on the original vectors. Null, empty and zero vectors, vectors with null or
    non-finite components, and rows without an id take no part. Other columns are not read.

    Every row is coded; blocks of queries meet blocks of candidates by block number, and
    each meeting leaves the k best of a query, so no task holds more than two blocks.
    """
    rows = embeddings.filter(F.col("vec_id").isNotNull() & usable("embedding")).select(
        "vec_id", F.size("embedding").alias("dimension"), F.col("embedding").alias("v"),
        queries.alias("asked"),
    )
    sizes = rows.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asked"), 1)).alias("asked"),
    ).collect()
    found = None
    for size in (s for s in sizes if s["asked"]):
        part = _search_dimension(rows.filter(F.col("dimension") == size["dimension"]), size["dimension"], size["n"], size["asked"], k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(
            F.col("vec_id").cast("long").alias("query_id"), F.lit(0).alias("rank"), F.col("vec_id").cast("long").alias("vec_id"),
            F.lit(0.0).alias("score")).limit(0)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _search_dimension(rows: DataFrame, d: int, n: int, asked: int, k: int) -> DataFrame:
    mean = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("x")).collect()
    centre = np.array([r["x"] for r in sorted(mean, key=lambda r: r["at"])])
    turn = rotation(d)
    q_blocks, c_blocks = -(-asked // QUERIES), -(-n // CANDIDATES)
    kind = rows.schema["v"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, length, agreement = code(_rows(batch.column("v"), d), centre, turn)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("v"), pa.array([b.tobytes() for b in bits], type=pa.binary()),
                pa.array(length), pa.array(agreement)], names=["vec_id", "v", "bits", "length", "agreement"])

    ids = F.col("vec_id").cast("long").alias("vec_id")
    wanted = rows.filter("asked").select(ids, "v").withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)))
    wanted = wanted.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)).cast("array<long>")))
    coded = rows.select(ids, "v").mapInArrow(
        index, f"vec_id long, v {kind}, bits binary, length double, agreement double")
    stored = coded.withColumn("c", F.pmod(F.xxhash64("vec_id", F.lit("c")), F.lit(c_blocks))).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)).cast("array<long>")))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            held = right.combine_chunks()
            vectors, stored_ids = _rows(held["v"].combine_chunks(), d), held["vec_id"].to_numpy()
            packed = np.frombuffer(b"".join(held["bits"].to_pylist()), dtype=np.uint8).reshape(len(stored_ids), -1)
            codes = packed, held["length"].to_numpy(), held["agreement"].to_numpy()
            for start in range(0, left.num_rows, AT_ONCE):
                some = left.slice(start, AT_ONCE).combine_chunks()
                out.append(_block_search(
                    some["vec_id"].to_numpy(), _rows(some["v"].combine_chunks(), d), stored_ids, vectors, codes, centre, turn, k))
        names = ["query_id", "vec_id", "score"]
        if not out:
            return pa.table([pa.array([], type=t) for t in (pa.int64(), pa.int64(), pa.float64())], names=names)
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out)], names=names)

    return wanted.groupBy("q", "c").cogroup(stored.groupBy("q", "c")).applyInArrow(
        meet, "query_id long, vec_id long, score double")
