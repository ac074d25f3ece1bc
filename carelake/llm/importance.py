"""Importance resampling towards a target: hashed n-grams from an Aho-Corasick dictionary.

Words are runs of digits, letters and characters beyond ASCII; A to Z count as a to z. The
distinct words of a few texts, each bounded by a delimiter on both sides, are the patterns
of an automaton, and their payloads are CRC-32 and length. One scan over the texts emits a
payload for each word; the payloads of adjacent words compose to those of n-grams, so no
n-gram is ever built as a string. A payload's CRC modulo the buckets is the feature. Each
dictionary lives as long as its few texts do, so it needs no bound on the vocabulary.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import keep

#: Bytes of the texts that share a dictionary; a longer text has one of its own.
SCAN_BYTES = 4 << 20
#: A longer word is scanned under a short name, since the automaton has a node for each byte.
LONG_WORD = 512

_DELIMITERS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_NORMAL = bytes.maketrans(bytes(range(65, 91)) + _DELIMITERS, bytes(range(97, 123)) + b" " * len(_DELIMITERS))

_CODED = "n_words long, n_features long, buckets binary"


def _columns_of_shift(n_bytes: int) -> np.ndarray:
    """What n zero bytes after a message do to its CRC register: the images of the 32 bits."""
    images = np.uint32(1) << np.arange(32, dtype=np.uint32)
    # one zero byte, then squared and multiplied as the bits of n say
    step = images.copy()
    for _ in range(8):
        step = np.where(step & np.uint32(1), (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
    while n_bytes:
        if n_bytes & 1:
            images = _applied(step, images)
        step = _applied(step, step)
        n_bytes >>= 1
    return images


def _applied(images: np.ndarray, registers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(registers), dtype=np.uint32)
    for bit in range(32):
        out ^= np.where(registers >> np.uint32(bit) & np.uint32(1), images[bit], np.uint32(0))
    return out


def composed(crc: np.ndarray, following: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of pairs of byte strings, from the CRCs of both and the second one's length."""
    out = np.empty(len(crc), dtype=np.uint32)
    for n in np.unique(length).tolist():
        here = length == n
        out[here] = _applied(_columns_of_shift(n), crc[here])
    return out ^ following


@dataclass(frozen=True)
class Payloads:
    """CRC and length of each word of some texts, in order, and the texts' numbers of words."""

    crc: np.ndarray
    length: np.ndarray
    words: np.ndarray


def scan(texts: list[bytes]) -> Payloads:
    """The payloads of all words of `texts`, through one dictionary of their distinct words."""
    normal = [b" " + t.translate(_NORMAL) + b" " for t in texts]
    dictionary = sorted(set().union(*(t.split() for t in normal))) if normal else []
    empty = np.zeros(0, dtype=np.uint32)
    if not dictionary:
        return Payloads(empty, empty, np.zeros(len(texts), dtype=np.int64))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    # no normal text has a capital, so the names are no one's words
    names = {w: b"W%d" % place for place, w in enumerate(dictionary) if len(w) > LONG_WORD}
    for place, word in enumerate(dictionary):
        # a byte is a letter of the automaton; the delimiters let whole words match only
        automaton.add_word(f" {names.get(word, word).decode('latin-1')} ", place)
    automaton.make_automaton()
    if names:
        normal = [b" " + b" ".join(names.get(w, w) for w in t.split()) + b" " for t in normal]
    found, counts = [], np.empty(len(texts), dtype=np.int64)
    for i, text in enumerate(normal):
        places = np.fromiter((place for _, place in automaton.iter(text.decode("latin-1"))), dtype=np.int64)
        found.append(places)
        counts[i] = len(places)
    places = np.concatenate(found)
    crc = np.array([zlib.crc32(w) for w in dictionary], dtype=np.uint32)
    length = np.array([len(w) for w in dictionary], dtype=np.uint32)
    return Payloads(crc[places], length[places], counts)


def features(payloads: Payloads, n: int, buckets: int) -> list[np.ndarray]:
    """For each text the buckets of all runs of 1 to n consecutive words."""
    bounds = np.concatenate([[0], np.cumsum(payloads.words)])
    text = np.repeat(np.arange(len(payloads.words)), payloads.words)
    parts = [[(payloads.crc[a:b] % np.uint32(buckets))] for a, b in zip(bounds[:-1], bounds[1:])]
    if n > 1 and len(payloads.crc):
        # a word after a space, which is what is appended to a run
        space = np.full(len(payloads.crc), zlib.crc32(b" "), dtype=np.uint32)
        after = composed(space, payloads.crc, payloads.length)
        run = payloads.crc
        for size in range(2, n + 1):
            if len(run) < 2:
                break
            run = composed(run[:-1], after[size - 1:], payloads.length[size - 1:] + np.uint32(1))
            inside = text[: len(run)] == text[size - 1:]
            for i in range(len(parts)):
                a, b = bounds[i], min(bounds[i + 1], len(run))
                parts[i].append(run[a:b][inside[a:b]] % np.uint32(buckets))
    return [np.concatenate(p) for p in parts]


def _coder(n: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def coded(rows: list[tuple], first: pa.Field) -> pa.RecordBatch:
        payloads = scan([t for _, t in rows])
        hit = features(payloads, n, buckets)
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in rows], first.type), pa.array(payloads.words, pa.int64()),
            pa.array([len(h) for h in hit], pa.int64()), pa.array([h.astype("<u4").tobytes() for h in hit], pa.binary()),
        ], names=[first.name, "n_words", "n_features", "buckets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.schema.field(0)
            rows, size = [], 0
            for i, text in zip(batch.column(0), batch.column(1)):
                data = text.as_py() or b""
                if rows and size + len(data) > SCAN_BYTES:
                    yield coded(rows, first)
                    rows, size = [], 0
                rows.append((i.as_py(), data))
                size += len(data)
            if rows:
                yield coded(rows, first)
    return run


def coded(texts: DataFrame, key: str, n: int, buckets: int) -> DataFrame:
    """`key`, n_words, n_features and `buckets`, 32-bit numbers of each feature, of every row of `texts` (key, text)."""
    picked = texts.select(F.col(key).cast("long").alias(key), F.col("text").cast("binary").alias("text"))
    return picked.mapInArrow(_coder(n, buckets), f"{key} long, {_CODED}")


def _counter(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for data in batch.column(0):
                counts += np.bincount(np.frombuffer(data.as_py(), "<u4"), minlength=buckets)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(counts[hit], pa.int64())], names=["bucket", "n"])
    return run


def bucket_counts(coded_rows: DataFrame, buckets: int) -> list[int]:
    """How often each bucket occurs: one number a bucket reaches the driver, added up in Spark."""
    added = coded_rows.select("buckets").mapInArrow(_counter(buckets), "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n"))
    out = [0] * buckets
    for bucket, count in added.collect():
        out[bucket] = count
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 * ln) of the smoothed ratio of each bucket's share in the target and in the source."""
    buckets, s_all, t_all = len(source), sum(source), sum(target)
    return [
        math.floor(1000 * math.log(float(t + 1) * float(s_all + buckets) / (float(s + 1) * float(t_all + buckets))))
        for s, t in zip(source, target)
    ]


def _weigher(gain: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gain, dtype=np.int64)
        for batch in batches:
            weights = [int(table[np.frombuffer(d.as_py(), "<u4")].sum()) for d in batch.column("buckets")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(weights, pa.int64())], names=[*batch.schema.names[:3], "weight"])
    return run


def ranked(rows: DataFrame, percent: int, least_words: int) -> DataFrame:
    """`rows` with `rank`, from 1, of the floor(percent * N / 100) best scores of the N rows with `least_words` words.

    The rows are range-partitioned in order, their place in a partition and the number of rows
    in the partitions before it give the rank; one number a partition is gathered.
    """
    short = F.col("n_words") < least_words
    order = [F.col("short"), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("short", short).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the id holds the partition above its 33rd bit and the row's place below
    placed = keep(dealt.withColumn("place", F.monotonically_increasing_id()), "resampling-order").withColumns({
        "part": F.shiftright("place", 33), "place": F.col("place").bitwiseAND((1 << 33) - 1)})
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("short")).alias("long"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"),
        F.floor(F.sum("long").over(Window.partitionBy(F.lit(0))) * percent / 100).cast("long").alias("drawn"))
    rank = (F.col("first") + F.col("place") + 1).cast("long")
    return placed.join(F.broadcast(firsts), "part").withColumn(
        "rank", F.when(~F.col("short") & (rank <= F.col("drawn")), rank))


def resample(
    documents: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, percent: int = 10,
    least_words: int = 20, seed: str = "2024", target_key: str = "item_id",
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of `documents` (doc_id, text).

    Drawn, with a rank, are `percent` % of the documents with `least_words` words or more, those
    with the highest scores; ties go to the smaller doc_id. A score is the document's log
    importance weight plus noise from its doc_id, which makes the best scores a draw without
    replacement. A null text has no words; a text without words weighs 0. A null doc_id takes
    its noise from the seed alone and comes last among equal scores. Repeated rows count each,
    in the counts, in N and in the ranks. An empty target or table of documents leaves its
    counts at 0. Other columns are not read. The driver and every task hold `buckets` numbers.
    """
    rows = keep(coded(documents, "doc_id", n, buckets), "resampling-buckets")
    gain = gains(bucket_counts(rows, buckets), bucket_counts(coded(target, target_key, n, buckets), buckets))
    weighed = rows.mapInArrow(_weigher(gain), "doc_id long, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.withColumn("score", F.col("weight") + noise)
    return ranked(scored, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")
