"""Removal of byte strings that an earlier document holds, by sorted suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import checkpointed, keep, let_go, whole_groups
from carelake.llm.shingles import mixed
from carelake.llm.suffixes import Anchors, multikey_order, words

#: Bytes of an anchor's own string, by which suffixes meet.
GRAM = 20
#: Anchors that one task looks through for repeats, about, and such tasks at least.
ANCHORS, LEAST_BUCKETS = 4_000_000, 16
#: Documents of the sample that shows very frequent grams, at least, and the share of them that makes one frequent.
SAMPLE, FREQUENT = 2_000, 0.05
#: Documents that make a gram frequent whatever their share, about, and how many of these the sample has to hold.
HOT, SEEN = ANCHORS // 8, 8
#: Bytes of texts in a partition, at most, about.
PARTITION = 128 << 20
#: Contexts of one group that are sorted as they are; a larger group is split.
LARGE = 20_000
#: Contexts that are sorted together.
AT_ONCE = 8_192
#: Bytes of texts that are looked at together, about: what is made of them stays in a core's cache.
TOGETHER = 128 << 10
#: Texts that one number of _BITS bits tells apart.
_BITS = 14


def _rows(documents: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, same, data and rest: the bytes of the texts, and other columns. Rows of one id and text are alike."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(data).alias("same"), data.alias("data"),
        F.struct(*columns, F.col("text").isNull().alias("_null")).alias("rest"))


def _packed(rows: DataFrame) -> DataFrame:
    """`rows` with compressed data, for a shuffle of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data = [press.compress(d.as_buffer()) for d in batch.column("data")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("same"), pa.array(data, type=pa.binary()), batch.column("rest")],
                names=["doc_id", "same", "data", "rest"])

    return rows.mapInArrow(run, rows.schema)


def _frequent(rows: DataFrame, documents: int, length: int) -> np.ndarray:
    """Hashes of grams that many documents of a sample have, sorted.

    They are known to repeat, so their places need not be sought. A gram is one of them in
    FREQUENT of the documents or in HOT of them, so other buckets stay near ANCHORS at any
    size; there are at most as many as all anchors divided by the smaller of the two. The
    sample decides the way only, not the result.
    """
    share = max(1, min(documents // SAMPLE, HOT // SEEN))
    some = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(share)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, GRAM)
        for batch in batches:
            found = [np.unique(anchors(d.as_py())[0]) for d in batch.column("data")]
            line = np.concatenate([*found, np.zeros(0, dtype=np.uint64)])
            keys, n = np.unique(line, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    counts = some.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    least = max(SEEN, int(min(FREQUENT * documents, HOT) / share))
    found = [r["gram"] for r in counts.filter(F.col("n") >= least).select("gram").collect()]
    return np.sort(np.array(found, dtype=np.int64).view(np.uint64))


def _dealt(gram: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each gram hash, and the 32 bits that name it there."""
    return (gram >> np.uint64(32)) % np.uint64(buckets), gram & np.uint64(0xFFFFFFFF)


def _held(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of `values` the sorted `known` holds; many of either cost little."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of so few texts that _BITS bits number them."""
    for batch in batches:
        for k in range(0, len(batch), 1 << _BITS):
            yield batch.slice(k, 1 << _BITS)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of binary values one after the other, and where each begins and the last ends."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, cuts, data = column.buffers()
    own = np.frombuffer(cuts, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", dtype=np.uint8), own


def _together(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Texts from one number up to another, of TOGETHER bytes about or a single one."""
    ends = np.cumsum(sizes)
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + TOGETHER, side="right")))
        yield low, high
        low = high


def _plain(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts that follow each other: the first one's number, their bytes, and where each begins and the last ends."""
    data, cuts = _bytes(column)
    for low, high in _together(np.diff(cuts)):
        yield low, data[cuts[low]:cuts[high]], cuts[low:high + 1] - cuts[low]


def _expanded(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The same of compressed texts."""
    expand = zstandard.ZstdDecompressor()
    values = [d.as_buffer() for d in column]
    sizes = np.array([zstandard.frame_content_size(v) for v in values], dtype=np.int64)
    for low, high in _together(sizes):
        data = b"".join([expand.decompress(v) for v in values[low:high]])
        yield low, np.frombuffer(data, dtype=np.uint8), np.concatenate([[0], np.cumsum(sizes[low:high])])


def _planes(values: np.ndarray) -> bytes:
    """The bytes of numbers, first the lowest of all of them: the high ones, mostly alike, then take little of a shuffle."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers of values that _planes made."""
    size = np.dtype(kind).itemsize
    parts = [np.frombuffer(p, dtype=np.uint8).reshape(size, len(p) // size).T.reshape(-1).view(kind) for p in column.to_pylist()]
    return np.concatenate([np.zeros(0, dtype=kind), *parts])


def _line(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers of values that hold their bytes as they are."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _counted(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of `lengths`."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _repeated(rows: DataFrame, buckets: int, frequent: np.ndarray, length: int) -> DataFrame:
    """doc_id, same and grams: for each document the grams that another document may have too.

    A document's grams go to their buckets packed, four bytes each. Equal names of
    different grams only mean that suffixes meet in vain later.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, GRAM)
        for batch in _few(batches):
            found = [np.zeros(0, dtype=np.uint64)]
            for low, data, cuts in _plain(batch.column("data")):
                doc, gram, *_ = anchors.of_texts(data, cuts)
                bucket, name = _dealt(gram, buckets)
                keys = (bucket << np.uint64(32 + _BITS)) | ((doc + low).astype(np.uint64) << np.uint64(32)) | name
                found.append(keys[~_held(gram, frequent)])
            keys = np.sort(np.concatenate(found))  # by bucket, document and name
            keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys  # np.unique is far slower
            names, held = keys.astype(np.uint32), keys >> np.uint64(32)
            first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else np.zeros(0, dtype=np.int64)
            n = np.diff(np.append(first, len(held)))
            docs = (held[first] & np.uint64((1 << _BITS) - 1)).astype(np.int64)
            ids, same = batch.column("doc_id").to_numpy()[docs], batch.column("same").to_numpy()[docs]
            ends = np.searchsorted(held[first] >> np.uint64(_BITS), np.arange(buckets + 1, dtype=np.uint64))
            places = np.append(first, len(held))[ends]
            out = []
            for b in np.flatnonzero(np.diff(ends)).tolist():
                own = slice(ends[b], ends[b + 1])
                out.append((b, _planes(ids[own]), same[own].tobytes(), _planes(n[own].astype(np.uint32)), names[places[b]:places[b + 1]].tobytes()))
            columns = list(zip(*out)) or [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], type=pa.int64())] + [pa.array(c, type=pa.binary()) for c in columns[1:]],
                names=["bucket", "ids", "same", "n", "names"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket"], 1):
            for bucket in np.unique(table["bucket"].to_numpy()):
                own = table.filter(pa.array(table["bucket"].to_numpy() == bucket))
                ids, same = _numbers(own["ids"], np.int64), _line(own["same"], np.int64)
                n, names = _numbers(own["n"], np.uint32), _line(own["names"], np.uint32)
                doc = np.repeat(np.arange(len(ids), dtype=np.int32), n)
                keys = (names.astype(np.uint64) << np.uint64(32)) | np.arange(len(names), dtype=np.uint32)
                keys.sort()
                order, keys = keys.astype(np.uint32), (keys >> np.uint64(32)).astype(np.uint32)
                starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
                del keys
                held = ids[doc[order]]
                twice = np.minimum.reduceat(held, starts) < np.maximum.reduceat(held, starts)
                del held
                found = np.sort(order[np.repeat(twice, np.diff(np.concatenate([starts, [len(order)]])))])  # by document
                del order
                docs, first = np.unique(doc[found], return_index=True)
                parts = [x.tobytes() for x in np.split(names[found], first[1:])] if len(docs) else []
                for k in range(0, len(docs), 10_000):
                    some = docs[k:k + 10_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[some]), pa.array(same[some]), pa.array(np.full(len(some), bucket)),
                        pa.array(parts[k:k + 10_000], type=pa.binary())], names=["doc_id", "same", "bucket", "names"])

    packed = rows.filter(F.col("doc_id").isNotNull()).drop("rest").mapInArrow(
        emit, "bucket long, ids binary, same binary, n binary, names binary")
    found = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        find, "doc_id long, same long, bucket long, names binary")
    return found.groupBy("doc_id", "same").agg(F.collect_list(F.struct("bucket", "names")).alias("grams"))


def _wanted(grams: pa.ListArray) -> np.ndarray:
    """What _repeated found for each text of a batch, as sorted numbers of text, bucket and name."""
    entries = grams.values
    data, cuts = _bytes(entries.field("names"))
    ends = grams.offsets.to_numpy().astype(np.int64)
    entry = np.repeat(ends[:-1], np.diff(ends)) + _counted(np.diff(ends))
    n = (cuts[entry + 1] - cuts[entry]) // 4
    text = np.repeat(np.repeat(np.arange(len(grams)), np.diff(ends)), n).astype(np.uint64)
    bucket = np.repeat(entries.field("bucket").to_numpy(zero_copy_only=False)[entry], n).astype(np.uint64)
    name = np.frombuffer(data, dtype=np.uint32, count=len(data) // 4)[np.repeat(cuts[entry] // 4, n) + _counted(n)]
    return np.sort((text << np.uint64(64 - _BITS)) | (bucket << np.uint64(32)) | name)


def _members(texts: DataFrame, repeated: DataFrame, buckets: int, frequent: np.ndarray, salts: int, length: int) -> DataFrame:
    """doc_id, same, whole and open: each document's repeated anchors, after they have met.

    An anchor stands for n strings that start one after the other; their bytes are its
    context. `whole` has (start, n) of contexts that a document with a smaller id has too:
    they go as a whole. `open` has (start, n, offset, context_id) of the others whose gram
    stands in another context as well: their bytes must be compared. Both are packed.

    Anchors meet by their gram; those of frequent grams meet by context and one of `salts`,
    so that none gathers in one task, and stay open where they are the first of their salt.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, GRAM)
        for batch in _few(batches):
            ids, same = batch.column("doc_id").to_numpy(), batch.column("same").to_numpy()
            wanted = _wanted(batch.column("grams"))
            firsts = np.searchsorted(wanted, np.arange(len(batch) + 1, dtype=np.uint64) << np.uint64(64 - _BITS))
            found: list[tuple] = []
            for low, data, cuts in _expanded(batch.column("data")):
                doc, gram, at, start, n = anchors.of_texts(data, cuts)
                bucket, name = _dealt(gram, buckets)
                often = _held(gram, frequent)
                keys = ((doc + low).astype(np.uint64) << np.uint64(64 - _BITS)) | (bucket << np.uint64(32)) | name
                own = wanted[firsts[low]:firsts[low + len(cuts) - 1]]
                chosen = np.flatnonzero(often | _held(keys, own))
                if not len(chosen):
                    continue
                doc, at, start, n, often = doc[chosen], at[chosen], start[chosen], n[chosen], often[chosen]
                context = anchors.context_ids(data, at, start, n)
                salted = mixed(context.view(np.uint64) + (ids[doc + low] % salts).astype(np.uint64))
                bucket = np.where(often, (salted >> np.uint64(32)) % np.uint64(buckets), bucket[chosen]).astype(np.int64)
                found.append((
                    bucket, doc + low, name[chosen].astype(np.uint32), context,
                    (start - cuts[doc]).astype(np.uint32), n.astype(np.uint8), (at - start).astype(np.uint8)))
            if not found:
                continue
            bucket, doc, *rest = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            out = []
            for b in np.flatnonzero(np.diff(ends)).tolist():
                own = order[ends[b]:ends[b + 1]]
                docs, count = np.unique(doc[own], return_counts=True)
                name, context, *others = (x[own] for x in rest)
                out.append((b, _planes(ids[docs]), same[docs].tobytes(), _planes(count.astype(np.uint32)), name.tobytes(),
                            context.tobytes(), *[_planes(x) for x in others]))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], type=pa.int64())] + [pa.array(c, type=pa.binary()) for c in columns[1:]], names=names)

    known = np.unique(frequent.astype(np.uint32))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket"], 1):
            for b in np.unique(table["bucket"].to_numpy()):
                own = table.filter(pa.array(table["bucket"].to_numpy() == b))
                ids, same, count = _numbers(own["ids"], np.int64), _line(own["same"], np.int64), _numbers(own["n"], np.uint32)
                name, context = _line(own["names"], np.uint32), _line(own["contexts"], np.int64)
                start, n, offset = _numbers(own["starts"], np.uint32), _line(own["strings"], np.uint8), _line(own["offsets"], np.uint8)
                doc = np.repeat(np.arange(len(ids), dtype=np.int32), count)
                order = np.lexsort((context, name))
                first = np.concatenate([[True], (np.diff(name[order]) != 0) | (np.diff(context[order]) != 0)])
                low = np.minimum.reduceat(ids[doc[order]], np.flatnonzero(first))  # the first document of each context
                lowest = np.empty(len(order), dtype=np.int64)
                lowest[order] = low[np.cumsum(first) - 1]
                whole = ids[doc] > lowest
                begin = np.flatnonzero(np.concatenate([[True], np.diff(name[order][first]) != 0]))
                several = np.minimum.reduceat(low, begin) < np.maximum.reduceat(low, begin)
                alone = np.repeat(~several, np.diff(np.concatenate([begin, [len(low)]])))  # of each context
                useless = np.empty(len(order), dtype=bool)
                useless[order] = alone[np.cumsum(first) - 1]
                useless &= ~_held(name, known)  # of frequent grams nothing is known here
                for k in range(0, len(ids), 20_000):
                    a, z = np.searchsorted(doc, [k, k + 20_000])
                    parts = []
                    for chosen, fields in ((whole[a:z], (start, n)), (~whole[a:z] & ~useless[a:z], (start, n, offset, context))):
                        places = np.flatnonzero(chosen) + a
                        cuts = np.searchsorted(doc[places], np.arange(k, min(k + 20_000, len(ids)) + 1))
                        parts.append([b"".join(f[places[x:y]].tobytes() for f in fields) for x, y in zip(cuts, cuts[1:])])
                    full = [i for i, (w, o) in enumerate(zip(*parts)) if w or o]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[k:k + 20_000][full]), pa.array(same[k:k + 20_000][full]),
                        pa.array([parts[0][i] for i in full], type=pa.binary()), pa.array([parts[1][i] for i in full], type=pa.binary()),
                    ], names=["doc_id", "same", "whole", "open"])

    names = ["bucket", "ids", "same", "n", "names", "contexts", "starts", "strings", "offsets"]
    packed = texts.join(repeated, ["doc_id", "same"], "left").select("doc_id", "same", "data", "grams").mapInArrow(
        emit, "bucket long, " + ", ".join(f"{c} binary" for c in names[1:]))
    found = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        meet, "doc_id long, same long, whole binary, open binary")
    return found.groupBy("doc_id", "same").agg(F.collect_list("whole").alias("whole"), F.collect_list("open").alias("open"))


_WHOLE = (np.uint32, np.uint8)
_OPEN = (np.uint32, np.uint8, np.uint8, np.int64)


def _unpacked(column: pa.ListArray, kinds: tuple[type, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The number of the list, and the columns of `kinds` that _members packed one after the other into each of its values."""
    data, cuts = _bytes(column.values)
    ends = column.offsets.to_numpy().astype(np.int64)
    value = np.repeat(ends[:-1], np.diff(ends)) + _counted(np.diff(ends))
    n = (cuts[value + 1] - cuts[value]) // sum(np.dtype(k).itemsize for k in kinds)
    begin, place = cuts[value], _counted(n)
    columns = []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        at = np.repeat(begin, n) + place * size
        columns.append(data[at[:, None] + np.arange(size)].view(kind)[:, 0].astype(np.int64))
        begin = begin + n * size
    return np.repeat(np.repeat(np.arange(len(column)), np.diff(ends)), n), columns


def _contexts(texts: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """doc_id, same, start, n, context_id, context, offset: the open contexts with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, (start, n, offset, context) = _unpacked(batch.column("open"), _OPEN)
            firsts = np.searchsorted(row, np.arange(len(batch) + 1))
            contexts: list[bytes] = []
            for low, data, cuts in _expanded(batch.column("data")):
                own = slice(firsts[low], firsts[low + len(cuts) - 1])
                begin = cuts[row[own] - low] + start[own]
                held = data.tobytes()
                contexts += [held[a:z] for a, z in zip(begin.tolist(), (begin + n[own] - 1 + length).tolist())]
            doc, same = (batch.column(c).to_numpy()[row] for c in ("doc_id", "same"))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip((doc, same, start, n, context, contexts, offset), kinds)],
                names=["doc_id", "same", "start", "n", "context_id", "context", "offset"])

    return texts.join(members.select("doc_id", "same", "open"), ["doc_id", "same"]).select(
        "doc_id", "same", "data", "open").mapInArrow(
        run, "doc_id long, same long, start int, n int, context_id long, context binary, offset int")


def _check() -> F.Column:
    """32 more bits for a context beside its id, hashed in another way; made where the bytes are, to save disk."""
    return F.hash("context", "offset", "n").alias("check")


def _distinct(contexts: DataFrame) -> DataFrame:
    """context_id, context, offset, n and doc: each context once, by all its bytes, with its first document."""
    return contexts.groupBy("context_id", "context", "offset", "n").agg(F.min("doc_id").alias("doc"))


def _core(low: str, high: str, length: int) -> F.Column:
    """The bytes that all strings share which start `low` to `high` bytes before their anchor."""
    return F.expr(f"substring(context, offset - {low} + 1, {length} - {high} + {low})")


def _shared(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which rows are of a group, whose rows follow each other, that two documents have."""
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
    return np.repeat(several, np.diff(np.append(first, len(group))))


def _earlier(distinct: DataFrame, length: int) -> DataFrame:
    """context_id, check and mask: which strings of a distinct context another context of an earlier document holds too.

    Contexts are range-partitioned by the leading bytes of their suffixes at splitters
    that Spark samples; equal suffixes share these bytes, so no splitter parts them. A
    group of very many contexts is split by how far before the anchor a string starts,
    which makes the shared bytes longer, until it is small or of one string.
    """
    parts = []
    rows = distinct.withColumns({"low": F.lit(0), "high": F.lit(length - GRAM)}).withColumn("core", _core("low", "high", length))
    while True:
        # small groups are weighed where they are sorted, so that their rows cross one shuffle only
        large = keep(rows.groupBy("core", "low", "high").agg(
            F.count(F.lit(1)).alias("_n"), F.min("doc").alias("_first"), F.max("doc").alias("_last"),
        ).filter(F.col("_n") > LARGE), "suffix-groups")
        if not large.take(1):
            parts.append(rows)
            break
        parts.append(rows.join(large, ["core", "low", "high"], "left_anti"))
        split = rows.join(large.filter("_first < _last"), ["core", "low", "high"])
        # strings that start alike are one string: only the earliest document matters
        alike = split.filter((F.col("low") == F.col("high")) & (F.col("_first") < F.col("doc")))
        parts.append(alike.drop("_n", "_first", "_last"))
        half = F.expr("(low + high) div 2").cast("int")
        more = split.filter("low < high").drop("_n", "_first", "_last", "core").withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).withColumns({
            "low": F.when(F.col("side") == 0, F.col("low")).otherwise(half + 1),
            "high": F.when(F.col("side") == 0, half).otherwise(F.col("high")),
        }).drop("side").filter((F.col("offset") >= F.col("low")) & (F.col("offset") - F.col("n") + 1 <= F.col("high")))
        rows = keep(more.withColumn("core", _core("low", "high", length)).select(*rows.columns), "suffix-split")
    columns = ["core", "low", "high", "context_id", "context", "offset", "n", "doc"]
    grouped = parts[0].select(*columns)
    single = None
    for k, part in enumerate(parts[1:], 1):
        if k % 2:  # strings alike
            bit = F.expr("shiftleft(1L, offset - low)").alias("mask")
            own = part.select("context_id", _check(), bit)
            single = own if single is None else single.unionByName(own)
        else:
            grouped = grouped.unionByName(part.select(*columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["group"], AT_ONCE):
            table = table.filter(pa.array(_shared(table["group"].to_numpy(), table["doc"].to_numpy()))).combine_chunks()
            if not len(table):
                continue
            low, high = table["low"].to_numpy(), table["high"].to_numpy()
            offset, n, doc = (table[c].to_numpy().astype(np.int64) for c in ("offset", "n", "doc"))
            data, cuts = _bytes(table["context"].combine_chunks())
            begin = cuts[:-1]
            first, last = np.maximum(0, offset - high), np.minimum(n - 1, offset - low)
            count = np.maximum(0, last - first + 1)
            row = np.repeat(np.arange(len(begin)), count)
            string = _counted(count) + np.repeat(first, count)
            keys = words(data, begin[row] + string, length)
            order = multikey_order(keys)
            keys, row, string = keys[order], row[order], string[order]
            starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1])
            least = np.repeat(np.minimum.reduceat(doc[row], starts), np.diff(np.concatenate([starts, [len(row)]])))
            later = least < doc[row]
            mask = np.bincount(row[later], weights=2.0 ** string[later], minlength=len(begin)).astype(np.int64)
            found = np.flatnonzero(mask)
            names = [pa.array(table[c].to_numpy()[found]) for c in ("context_id", "check")]
            yield pa.RecordBatch.from_arrays([*names, pa.array(mask[found])], names=["context_id", "check", "mask"])

    count = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = grouped.withColumn("group", F.xxhash64("core", "low", "high")).repartitionByRange(count, "core")
    masks = dealt.sortWithinPartitions("core", "group").select("*", _check()).mapInArrow(
        run, "context_id long, check int, mask long")
    if single is not None:
        masks = masks.unionByName(single)
    return masks.groupBy("context_id", "check").agg(F.bit_or("mask").alias("mask"))


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> str:
    """The characters that are not removed whole."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(lead):
        return ""
    whole = np.logical_and.reduceat(gone, lead)
    return data[~np.repeat(whole, np.diff(np.concatenate([lead, [len(data)]])))].tobytes().decode("utf-8")


def deduplicated(documents: DataFrame, length: int = 50, texts: bool = False, columns: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of `documents` (doc_id, text).

    A byte is removed if a string of `length` bytes that covers it also starts in a
    document with a smaller doc_id, judged on the input. Texts are their UTF-8 bytes;
    null counts as empty. n_spans counts the maximal removed runs. A row with a null
    doc_id keeps all and removes nothing from others; rows of one doc_id do not match
    each other. `texts` adds `text`, what remains of it in whole characters: one that a
    run's end parts is kept; null stays null. `columns` of `documents` follow unchanged;
    others are not read.

    Suffixes meet at anchors that equal strings have in common. A first pass finds the
    anchors that repeat; only their contexts are sorted, each distinct one once.
    """
    rows = _rows(documents, columns)
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("data")).alias("bytes")).first()
    size = total["bytes"] or 0
    buckets = max(LEAST_BUCKETS, 2 * size // (length - GRAM + 2) // ANCHORS + 1)
    count = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PARTITION)
    frequent = _frequent(rows, total["rows"], length)
    repeated = _repeated(rows, buckets, frequent, length)
    # all later steps join on this partitioning, so the texts are shuffled once
    packed = checkpointed(_packed(rows).repartition(count, "doc_id", "same"))
    let_go(rows)  # of the shuffle that the checkpoint was made from, and so below
    known_texts = packed.filter(F.col("doc_id").isNotNull())
    salts = max(LEAST_BUCKETS, total["rows"] // 1_000_000)
    members = keep(_members(known_texts, repeated, buckets, frequent, salts, length), "suffix-members")
    let_go(rows)
    contexts = keep(_contexts(known_texts, members, length), "suffix-contexts")
    distinct = keep(_distinct(contexts), "suffix-distinct")
    let_go(rows)
    masks = keep(_earlier(distinct, length), "suffix-masks")
    let_go(rows)
    known = distinct.select("context_id", _check(), "doc").join(masks, ["context_id", "check"], "left")
    every = F.expr("shiftleft(1L, n) - 1")
    held = contexts.select("doc_id", "same", "start", "n", "context_id", _check()).join(known, ["context_id", "check"]).select(
        "doc_id", "same", "start", F.when(F.col("doc_id") > F.col("doc"), every).otherwise(F.coalesce("mask", F.lit(0))).alias("mask"),
    ).filter("mask != 0")
    spans = held.groupBy("doc_id", "same").agg(F.collect_list(F.struct("start", "mask")).alias("spans")).join(
        members.select("doc_id", "same", "whole"), ["doc_id", "same"], "full")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            rest, spans = batch.column("rest"), batch.column("spans")
            absent = rest.field("_null").to_pylist()
            # where covered runs of strings begin and where they end, by row
            row, (start, n) = _unpacked(batch.column("whole"), _WHOLE)
            ends = spans.offsets.to_numpy().astype(np.int64)
            entry = np.repeat(ends[:-1], np.diff(ends)) + _counted(np.diff(ends))
            first, mask = (spans.values.field(c).to_numpy(zero_copy_only=False)[entry].astype(np.int64) for c in ("start", "mask"))
            held, bit = np.nonzero((mask[:, None] >> np.arange(length - GRAM + 1)) & 1)
            rows = np.concatenate([row, np.repeat(np.arange(len(batch)), np.diff(ends))[held]])
            order = np.argsort(rows, kind="stable")
            begin = np.concatenate([start, first[held] + bit])[order]
            end = np.concatenate([start + n - 1, first[held] + bit])[order] + length
            rows = rows[order]
            firsts = np.searchsorted(rows, np.arange(len(batch) + 1))
            for low, data, cuts in _expanded(batch.column("data")):
                own = slice(firsts[low], firsts[low + len(cuts) - 1])
                covered = np.bincount(cuts[rows[own] - low] + begin[own], minlength=len(data) + 1)
                covered -= np.bincount(cuts[rows[own] - low] + end[own], minlength=len(data) + 1)
                gone = np.cumsum(covered[:-1]) > 0
                new = gone.copy()
                new[1:] &= ~gone[:-1]
                edge = cuts[:-1][cuts[:-1] < len(data)]
                new[edge] = gone[edge]
                n_gone, n_new = (np.concatenate([[0], np.cumsum(x)])[cuts] for x in (gone, new))
                kept, left = data[~gone].tobytes(), cuts - n_gone
                for i in range(len(cuts) - 1):
                    removed, rest_of = int(n_gone[i + 1] - n_gone[i]), kept[left[i]:left[i + 1]]
                    text = None
                    if texts and not absent[low + i]:
                        places = slice(cuts[i], cuts[i + 1])
                        text = _whole_characters(data[places], gone[places]) if removed else rest_of.decode("utf-8")
                    out.append((int(cuts[i + 1] - cuts[i]), removed, int(n_new[i + 1] - n_new[i]), hashlib.sha256(rest_of).hexdigest(), text))
            found = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(c, type=t) for c, t in zip(found, kinds)][: len(names) - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays, *[rest.field(c) for c in columns]], names=[*names, *columns])

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["text"] if texts else [])]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", text string" if texts else "")
    schema += "".join(f", `{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)
    return packed.join(spans, ["doc_id", "same"], "left").select("doc_id", "data", "rest", "spans", "whole").mapInArrow(run, schema)
