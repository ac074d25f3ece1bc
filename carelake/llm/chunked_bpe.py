"""BPE encoding that reuses content-defined chunks, and decoding."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: A chunk ends where this many low bits of the rolling hash are set: 512 bytes on average.
MASK_BITS = 9
#: Bytes that the rolling hash covers, a power of two.
WINDOW = 16
#: Bytes of a chunk, at most: a longer one is cut this far from its start, so equal chunks still are.
LONGEST = 4_096
#: Bytes of the shared chunks whose encodings every task gets, at most, and their number.
DICTIONARY_BYTES, DICTIONARY_CHUNKS = 4 << 20, 8_192
#: Encodings that a task remembers, at most.
PIECES, CHUNKS = 600_000, 5_000
#: Characters of texts that are encoded together.
AT_ONCE = 2_000_000

#: White space at which a text may be parted whatever the tokenizer's own classes are.
_SPACE = re.compile(r"[ \t\r\n]+")
_TABLE = np.random.default_rng(20_240_601).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the content-defined chunks of UTF-8 `data`, its length last.

    The rolling hash of the last WINDOW bytes decides, so equal passages are cut alike
    wherever they stand; after LONGEST bytes without such a place there is a cut too. No
    cut falls inside a character.
    """
    if not data:
        return []
    b = np.frombuffer(data, dtype=np.uint8)
    h = _TABLE[b]
    width = 1
    while width < WINDOW:  # a window of twice the width is two windows, one of them shifted
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    mask = np.uint32((1 << MASK_BITS) - 1) << np.uint32(WINDOW - MASK_BITS)
    ends = np.flatnonzero((h[WINDOW - 1:-1] & mask) == mask) + WINDOW
    ends = [*ends[(b[ends] & 0xC0) != 0x80].tolist(), len(data)]
    starts = [0, *ends[:-1]]
    if max(map(int.__sub__, ends, starts)) <= LONGEST:
        return ends
    out = []
    for start, end in zip(starts, ends):
        while end - start > LONGEST:
            start += LONGEST
            while (data[start] & 0xC0) == 0x80:
                start -= 1
            out.append(start)
        out.append(end)
    return out


def chunks(text: str) -> list[str]:
    data = text.encode("utf-8", "surrogatepass")
    out, start = [], 0
    for end in chunk_ends(data):
        out.append(data[start:end].decode("utf-8", "surrogatepass"))
        start = end
    return out


def parts_at_spaces(tokenizer: Tokenizer) -> bool:
    """Whether ids do not change where a text is parted at white space, tried on pieces of all kinds.

    Added tokens must not hold white space or take it from beside them.
    """
    added = tokenizer.get_added_tokens_decoder().values()
    if any(t.lstrip or t.rstrip or _SPACE.search(t.content) for t in added):
        return False
    pieces = ["", "a", "The", "ab's", "'s", "7", "1984", "-", "...", "é", "e\u0301", "\u0301", "\u4e2d\u6587", "\U0001f642", "\u00a0",
              *[t.content for t in added][:8]]
    alone = {x: tokenizer.encode(x, add_special_tokens=False).ids for x in pieces}
    whole = [(x, y, x + space + y) for x in pieces for y in pieces for space in (" ", "\t", "\r\n", "  ")]
    found = tokenizer.encode_batch_fast([t for _, _, t in whole], add_special_tokens=False)
    return all(e.ids == alone[x] + alone[y] for (x, y, _), e in zip(whole, found))


@dataclass(frozen=True, slots=True)
class Chunk:
    """A chunk parted at its first and last white space; without any, all is head."""

    head: str
    body: bytes | None  # its ids, four bytes each
    tail: str


class Encoder:
    """Encodes texts chunk by chunk; `shared` has chunks that were encoded before."""

    def __init__(self, vocabulary: str, shared: dict[str, Chunk] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.shared = shared or {}
        self.seen: dict[str, Chunk] = {}
        self.pieces: dict[str, bytes] = {}  # ids of pieces between white space
        if self.tokenizer.decoder is not None:
            raise ValueError("only tokenizers that decode to their tokens, joined by spaces")
        if not parts_at_spaces(self.tokenizer):
            raise ValueError("only tokenizers that drop white space and encode what it parts on its own")
        known = range(self.tokenizer.get_vocab_size())
        self.decimals = [str(i) for i in known]
        self.tokens = self.tokenizer.decode_batch([[i] for i in known], skip_special_tokens=False)

    def _learn(self, words: set[str]) -> None:
        """Encode pieces between white space, each once as long as it is remembered."""
        new = list(words.difference(self.pieces))
        if len(self.pieces) + len(new) > PIECES:
            self.pieces = {}
            new = list(words)
        if new:
            found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            self.pieces.update(zip(new, [array("I", e.ids).tobytes() for e in found]))

    def _of(self, words: list[str]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, words))

    def texts(self, ids: bytes) -> tuple[str, str]:
        """Ids in decimal, and the decoded text."""
        own = array("I", ids).tolist()
        return " ".join(map(self.decimals.__getitem__, own)), " ".join(map(self.tokens.__getitem__, own))

    def chunks(self, texts: list[str]) -> dict[str, Chunk]:
        """The encodings of distinct chunks. Nothing outside a chunk can change the ids
        between its first and its last white space; the rest belongs to the joins."""
        out, new = {}, {}
        for text in texts:
            if known := self.shared.get(text) or self.seen.get(text):
                out[text] = known
            elif text not in new:
                new[text] = _SPACE.split(text)
        self._learn(set().union(*[parts[1:-1] for parts in new.values()]))
        if len(self.seen) + len(new) > CHUNKS:
            self.seen = {}
        for text, parts in new.items():
            out[text] = Chunk(text, None, "") if len(parts) == 1 else Chunk(parts[0], self._of(parts[1:-1]), parts[-1])
            self.seen[text] = out[text]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, four bytes each, as the tokenizer gives them for the whole text.

        A join is re-encoded from the last white space before it to the first after it.
        A chunk without any agrees with neither side yet: the join grows over it until
        both of its ends are at white space, where the ids are those of the whole text.
        """
        parted = [chunks(t) for t in texts]
        known = self.chunks([c for own in parted for c in own])
        runs: list[list[str | bytes]] = []  # joins, and bodies between them
        for own in parted:
            run: list[str | bytes] = []
            joint = ""
            for c in map(known.__getitem__, own):
                joint += c.head
                if c.body is not None:
                    run += [joint, c.body]
                    joint = c.tail
            runs.append([*run, joint])
        self._learn({x for run in runs for x in run if isinstance(x, str)})
        return [b"".join([x if isinstance(x, bytes) else self.pieces[x] for x in run]) for run in runs]


def _slices(items: list[str]) -> Iterator[list[str]]:
    """Runs of `items` of AT_ONCE characters or one item."""
    run, size = [], 0
    for item in items:
        run.append(item)
        size += len(item)
        if size >= AT_ONCE:
            yield run
            run, size = [], 0
    if run:
        yield run


def _hash(chunk: str) -> int:
    return xxhash.xxh64_intdigest(chunk.encode("utf-8", "surrogatepass")) - (1 << 63)


def shared_chunks(documents: DataFrame, vocabulary: str, size: int = DICTIONARY_BYTES) -> dict[str, tuple]:
    """The chunks that repeat most, by the bytes their reuse saves, each encoded once: its
    text, then head, ids between and tail.

    Counts cover every chunk of every text and leave a task as one row a chunk and batch.
    `size` bytes of chunks, and DICTIONARY_CHUNKS of them, bound what the driver reads and
    sends to the tasks; chunks beyond that are encoded where they are.
    """
    texts = documents.select("text").filter(F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [(_hash(c), len(c.encode("utf-8", "surrogatepass"))) for t in batch.column("text") for c in chunks(t.as_py())]
            if own:
                pairs = np.array(own, dtype=np.int64)
                keys, first, n = np.unique(pairs[:, 0], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(pairs[first, 1]), pa.array(n.astype(np.int64))], names=["chunk", "length", "n"])

    repeated = texts.mapInArrow(count, "chunk long, length long, n long").groupBy("chunk").agg(
        F.sum("n").alias("n"), F.max("length").alias("length")).filter(F.col("n") > 1)
    saved = ((F.col("n") - 1) * F.col("length")).alias("saved")
    wanted, room = set(), size
    for r in repeated.select("chunk", "length", saved).orderBy(F.desc("saved"), "chunk").limit(DICTIONARY_CHUNKS).collect():
        if r["length"] <= room:
            wanted.add(r["chunk"])
            room -= r["length"]
    if not wanted:
        return {}

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            out: dict[int, str] = {}
            for t in batch.column("text"):
                for c in chunks(t.as_py()):
                    h = _hash(c)
                    if h in wanted and h not in given:
                        given.add(h)
                        out[h] = c
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), type=pa.int64()), pa.array(list(out.values()), type=pa.string())], names=["chunk", "text"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            rows = [(t, c) for t, c in encoder.chunks(batch.column("text").to_pylist()).items() if c.body is not None]
            yield pa.RecordBatch.from_arrays([
                pa.array([t for t, _ in rows], type=pa.string()), pa.array([c.head for _, c in rows], type=pa.string()),
                pa.array([c.body for _, c in rows], type=pa.binary()), pa.array([c.tail for _, c in rows], type=pa.string()),
            ], names=["text", "head", "body", "tail"])

    once = texts.mapInArrow(pick, "chunk long, text string").groupBy("chunk").agg(F.min("text").alias("text")).select("text")
    found = once.mapInArrow(encode, "text string, head string, body binary, tail string").collect()
    return {r["text"]: (r["head"], bytes(r["body"]), r["tail"]) for r in found}


def encode(documents: DataFrame, vocabulary: str, full: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of `documents` (doc_id, text).

    Ids are those of the whole text under the tokenizer file `vocabulary`, without special
    tokens added; `full` adds `ids` (their decimals joined by spaces) and `decoded`. Null
    counts as empty, which has no ids. Repeated rows are encoded each; other columns are
    not read.
    """
    session = documents.sparkSession
    shared = session.sparkContext.broadcast(shared_chunks(documents, vocabulary))
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if full else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, {text: Chunk(*parts) for text, parts in shared.value.items()})
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [e for some in _slices(texts) for e in encoder.encode(some)]
            columns = [batch.column("doc_id"), pa.array([len(e) // 4 for e in found], type=pa.int64())]
            columns += [pa.array(x, type=pa.string()) for x in _digests(map(encoder.texts, found))]
            if full:
                columns += [pa.array(x, type=pa.string()) for x in zip(*map(encoder.texts, found))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", ids string, decoded string" if full else "")
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _digests(pairs: Iterator[tuple[str, str]]) -> tuple[list[str], list[str]]:
    ids, decoded = [], []
    for i, d in pairs:
        ids.append(hashlib.sha256(i.encode()).hexdigest())
        decoded.append(hashlib.sha256(d.encode("utf-8", "surrogatepass")).hexdigest())
    return ids, decoded
