"""Masked pseudo-likelihood: a bidirectional window network predicts every token from both sides."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import keep

#: Token ids are pairs (a, b) of digits below SIDE, so that a softmax has SIDE outputs, twice.
SIDE = 32
SIZE = SIDE * SIDE
#: Id 0 stands outside a text, the next COMMON ids are the most frequent words; all others share the last RARE ids by a hash.
RARE = 256
COMMON = SIZE - 1 - RARE
#: At most so many of the most frequent words, of at most LONGEST characters, have their counts in every task. Others' counts are joined.
KNOWN, LONGEST = 131_072, 256
#: Outputs within these need no shift before their exponential.
SAFE = 60.0
WIDTH = 16
#: Positions on either side that the network sees.
OFFSETS = (-2, -1, 1, 2)
EDGE = max(OFFSETS)
BATCH = 2048
#: Positions that are scored together.
AT_ONCE = 2048
#: Networks that a task takes the mean of, about.
TOGETHER = 8


def words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def word_counts(documents: DataFrame) -> DataFrame:
    """word and n: how often each word is in the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[str] = Counter()
            for t in batch.column("text"):
                seen.update(words(t.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), type=pa.string()), pa.array(list(seen.values()), type=pa.int64())], names=["word", "n"])

    return documents.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The words that every task holds, at most KNOWN, and how many tokens each group of words has."""

    place: dict[str, int]
    ids: np.ndarray  # by place; one more entry, 0, stands for all other words, here and in log_share
    log_share: np.ndarray  # of the tokens of a word's id, how many are this word
    log_total: np.ndarray  # tokens of each group
    common: int


def vocabulary(counts: DataFrame, common: int = COMMON, groups: int = RARE, held: int = KNOWN) -> Vocabulary:
    """From the counts of all words: `common` words with ids of their own, `groups` for all others, at most `held` words at hand.

    Words are held down to the least count, in steps of 1/64 of a power of two, that at most
    `held` words reach, so the driver takes no more than these from all partitions together.
    """
    short, step = counts.filter(F.length("word") <= LONGEST), F.floor(F.log2("n") * 64)
    sizes = sorted(((r["step"], r["size"]) for r in short.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("size")).collect()), reverse=True)
    fit = [k for (k, _), size in zip(sizes, np.cumsum([size for _, size in sizes])) if size <= held]
    held_rows = short.filter(step >= fit[-1] if fit else F.lit(False)).select("word", "n").toArrow().to_pydict()
    top = sorted(zip(held_rows["word"], held_rows["n"]), key=lambda x: (-x[1], x[0]))
    sums = counts.groupBy((F.crc32(F.col("word").cast("binary")) % groups).alias("group")).agg(F.sum("n").alias("n")).collect()
    total = np.zeros(groups)
    for r in sums:
        total[r["group"]] = r["n"]
    group = np.array([zlib.crc32(w.encode()) % groups for w, _ in top], dtype=np.int64)
    n = np.array([k for _, k in top], dtype=np.float64)
    np.subtract.at(total, group[:common], n[:common])
    log_total = np.log(np.maximum(total, 1.0))
    ids, share = common + 1 + group, np.log(n) - log_total[group]
    ids[:common], share[:common] = np.arange(1, len(ids[:common]) + 1), 0.0
    return Vocabulary({w: k for k, (w, _) in enumerate(top)}, np.append(ids, 0).astype(np.uint16), np.append(share, 0.0), log_total, common)


def token_ids(text: str | None, known: Vocabulary) -> tuple[np.ndarray, float, Counter[str]]:
    """Ids of the words, the sum of their log shares as far as `known` tells, and the words whose log count is still to be added."""
    found = words(text)
    place = np.fromiter(map(known.place.get, found, repeat(-1)), dtype=np.int64, count=len(found))
    ids = known.ids[place]  # the last entry is that of words that are not held
    share = known.log_share[place].sum()
    others = np.flatnonzero(place < 0).tolist()
    rest = [found[k] for k in others]
    if rest:
        groups = np.array([zlib.crc32(w.encode()) for w in rest]) % len(known.log_total)
        ids[others] = known.common + 1 + groups
        share -= known.log_total[groups].sum()
    return ids, float(share), Counter(rest)


def encoded(documents: DataFrame, known: Vocabulary) -> DataFrame:
    """doc_id, a number of the row, and its `token_ids`: ids (two bytes each), share and rest (words with how often they occur)."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [token_ids(t.as_py(), known) for t in batch.column("text")]
            pairs = pa.StructArray.from_arrays(
                [pa.array([w for r in rows for w in r[2]], type=pa.string()), pa.array([n for r in rows for n in r[2].values()], type=pa.int32())],
                names=["word", "times"])
            ends = np.cumsum([0, *(len(r[2]) for r in rows)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("row"), pa.array([r[0].tobytes() for r in rows], type=pa.binary()),
                pa.array([r[1] for r in rows], type=pa.float64()), pa.ListArray.from_arrays(pa.array(ends), pairs),
            ], names=["doc_id", "row", "ids", "share", "rest"])

    numbered = documents.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return numbered.mapInArrow(run, f"doc_id {kind}, row long, ids binary, share double, rest array<struct<word: string, times: int>>")


@dataclass
class Network:
    """Summed context embeddings, a hidden layer, and a softmax for each digit of the id.

    hidden = tanh(bias + sum of context[o][neighbour at o]); the first digit is predicted
    from hidden, the second from tanh(hidden + digit[a]) with a bias for each first digit.
    """

    context: np.ndarray  # offsets x SIZE x WIDTH
    bias: np.ndarray
    first: np.ndarray  # WIDTH x SIDE
    first_bias: np.ndarray
    digit: np.ndarray  # SIDE x WIDTH
    second: np.ndarray
    second_bias: np.ndarray  # SIDE x SIDE

    NAMES = ("context", "bias", "first", "first_bias", "digit", "second", "second_bias")

    @classmethod
    def new(cls, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)

        def weights(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.1).astype(np.float32)

        def zeros(*shape: int) -> np.ndarray:
            return np.zeros(shape, np.float32)

        return cls(
            weights(len(OFFSETS), SIZE, WIDTH), zeros(WIDTH), weights(WIDTH, SIDE), zeros(SIDE),
            weights(SIDE, WIDTH), weights(WIDTH, SIDE), zeros(SIDE, SIDE))

    def vector(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def with_vector(self, flat: np.ndarray) -> Network:
        parts, at = [], 0
        for n in self.NAMES:
            old = getattr(self, n)
            parts.append(flat[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return Network(*parts)

    def _hidden(self, near: np.ndarray) -> np.ndarray:
        hidden = self.context[0][near[0]]
        for o in range(1, len(OFFSETS)):
            hidden += self.context[o][near[o]]
        hidden += self.bias
        return np.tanh(hidden, out=hidden)

    def _levels(self, hidden: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both digits, the second level's inputs, and both levels' outputs."""
        a, b = np.divmod(token, SIDE)
        inner = np.tanh(hidden + self.digit[a])
        return a, b, inner, hidden @ self.first + self.first_bias, inner @ self.second + self.second_bias[a]

    def log_probability(self, near: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Of each `token` given its neighbours: `near` is offsets x positions."""
        a, b, _, x, y = self._levels(self._hidden(near), token)
        return _log_softmax_at(x, a) + _log_softmax_at(y, b)

    def gradient(self, near: np.ndarray, token: np.ndarray) -> Iterator[tuple[str, np.ndarray | None, np.ndarray]]:
        """Of the mean negative log-probability: names, rows (None for all) and their gradients."""
        hidden = self._hidden(near)
        a, b, inner, x, y = self._levels(hidden, token)
        dx, dy = _softmax_gradient(x, a), _softmax_gradient(y, b)
        yield "first", None, hidden.T @ dx
        yield "first_bias", None, dx.sum(0)
        yield "second", None, inner.T @ dy
        yield "second_bias", *_summed(a, dy)
        d_inner = (dy @ self.second.T) * (1 - inner**2)
        yield "digit", *_summed(a, d_inner)
        d_hidden = (dx @ self.first.T + d_inner) * (1 - hidden**2)
        yield "bias", None, d_hidden.sum(0)
        rows = near + np.arange(len(OFFSETS))[:, None] * SIZE
        yield "context", *_summed(rows.ravel(), d_hidden)

    def learn(self, near: np.ndarray, token: np.ndarray, state: dict[str, np.ndarray], rate: float) -> None:
        """One Adagrad step; `state` holds the sums of squares."""
        for name, rows, g in list(self.gradient(near, token)):
            w, s = getattr(self, name), state[name]
            if rows is None:
                s += g * g
                w -= rate * g / (np.sqrt(s) + 1e-4)
            else:
                w, s = w.reshape(-1, w.shape[-1]), s.reshape(-1, w.shape[-1])
                new = s[rows] + g * g
                s[rows] = new
                w[rows] -= rate * g / (np.sqrt(new) + 1e-4)


def _summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each of `rows` (below 65,536, which sort fast) once, with the sum of its values; `values` may be repeated for more rows."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    ordered = rows[order]
    firsts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[firsts], np.add.reduceat(values.take(order % len(values), axis=0), firsts, axis=0)


def _shifted(x: np.ndarray) -> np.ndarray:
    """`x`, each row less its largest where an output is not SAFE: the softmax is the same, and exp(x) is finite."""
    if x.size and not (x.max() < SAFE and x.min() > -SAFE):
        x -= x.max(axis=1, keepdims=True)
    return x


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probability of the output `at` in each row; `x` is overwritten."""
    own = _shifted(x)[np.arange(len(at)), at]
    return own - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype))


def _softmax_gradient(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the mean negative log-probability of the outputs `at`; `x` is overwritten."""
    total = np.exp(_shifted(x), out=x) @ np.ones(x.shape[1], x.dtype)
    x *= (1 / (len(at) * total))[:, None]
    x[np.arange(len(at)), at] -= 1 / len(at)
    return x


def _laid_out(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array with EDGE zeros around each, where each begins, and their lengths."""
    texts = [np.frombuffer(x, dtype=np.uint16) for x in batch.column("ids").to_pylist()]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begins = EDGE + np.concatenate([[0], np.cumsum(sizes + EDGE)[:-1]]) if len(texts) else np.zeros(0, dtype=np.int64)
    line = np.zeros(int(sizes.sum()) + EDGE * (len(texts) + 1), dtype=np.int64)
    for t, at in zip(texts, begins):
        line[at:at + len(t)] = t
    return line, begins, sizes


def _near(line: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.stack([line[at + o] for o in OFFSETS])


def _positions(begins: np.ndarray, sizes: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Where round `turn` trains: in each text every position whose number leaves `turn` when divided by `rounds`."""
    return np.concatenate([np.zeros(0, dtype=np.int64), *(np.arange(b + turn, b + s, rounds) for b, s in zip(begins, sizes))])


def _trained(ids: DataFrame, start: Network, turn: int, rounds: int, rate: float) -> Network:
    """One round: each task learns on its rows from the same start; the mean, by positions, goes on.

    Means are taken of about TOGETHER networks at a time, until one is left, so no
    task holds many and the driver takes one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, n = start.with_vector(start.vector()), 0
        state = {x: np.zeros_like(getattr(network, x)) for x in network.NAMES}
        rng = np.random.default_rng(turn)
        for batch in batches:
            line, begins, sizes = _laid_out(batch)
            at = rng.permutation(_positions(begins, sizes, turn, rounds))
            for k in range(0, len(at), BATCH):
                own = at[k:k + BATCH]
                network.learn(_near(line, own), line[own], state, rate)
            n += len(at)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([network.vector().astype(np.float32).tobytes()], type=pa.binary()), pa.array([n], type=pa.int64())],
                names=["weights", "n"])

    def mean(table: pa.Table) -> pa.Table:
        total, n = 0.0, 0
        for w, k in zip(table["weights"], table["n"]):
            total, n = total + np.frombuffer(w.as_py(), dtype=np.float32).astype(np.float64) * k.as_py(), n + k.as_py()
        return pa.table({"weights": pa.array([(total / n).astype(np.float32).tobytes()], type=pa.binary()), "n": [n]})

    ids = ids.select("ids")
    means, left = ids.mapInArrow(run, "weights binary, n long"), ids.rdd.getNumPartitions()
    while left > 1:
        left = math.ceil(left / TOGETHER)
        dealt = means.withColumn("part", F.pmod(F.xxhash64("weights"), F.lit(left)))
        means = dealt.groupBy("part").applyInArrow(mean, "weights binary, n long")
    rows = means.collect()
    if not rows:
        return start
    rows.sort(key=lambda r: bytes(r["weights"]))
    total = sum(r["n"] for r in rows)
    flat = sum(np.frombuffer(bytes(r["weights"]), dtype=np.float32).astype(np.float64) * (r["n"] / total) for r in rows)
    return start.with_vector(flat)


def fit(ids: DataFrame, rounds: int = 3, rate: float = 0.1) -> Network:
    """A network trained on every position of every row of `ids`: each position in one of the rounds."""
    network = Network.new()
    for turn in range(rounds):
        network = _trained(ids, network, turn, rounds, rate)
    return network


def log_likelihoods(batch: pa.RecordBatch, network: Network) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and summed log-probabilities of each row of a batch of ids."""
    line, begins, sizes = _laid_out(batch)
    inside = np.zeros(len(line), dtype=bool)
    for b, s in zip(begins, sizes):
        inside[b:b + s] = True
    at = np.flatnonzero(inside)
    scores = np.zeros(len(line) + 1)
    for k in range(0, len(at), AT_ONCE):
        own = at[k:k + AT_ONCE]
        scores[own] = network.log_probability(_near(line, own), line[own])
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    return sizes, np.where(sizes > 0, sums[begins + sizes] - sums[begins], 0.0)


def score(documents: DataFrame, rounds: int = 3) -> DataFrame:
    """doc_id, n_tokens, log_likelihood and per_token of every row of `documents` (doc_id, text).

    log_likelihood sums the log-probability of each token given EDGE tokens on both
    sides; per_token divides it by their number. Tokens are words of the lower-cased
    text. Words beyond the COMMON most frequent share the ids of groups, and such a token's
    probability is its group's times its word's share of the group's tokens in all rows:
    a word that occurs less is less likely. The network's size is fixed; the counts grow
    with the corpus and stay in Spark, but for those of KNOWN words. All positions of all
    rows are trained on. Null and blank texts have no tokens, a sum of zero and a null
    mean. Equal texts score equally, up to rounding; repeated rows are scored each. Other
    columns are not read. An empty table gives no rows.
    """
    counts = keep(word_counts(documents), "lm-words")
    ids = keep(encoded(documents, vocabulary(counts)), "lm-ids")
    network = fit(ids, rounds)
    kind = ids.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = log_likelihoods(batch, network)
            share = batch.column("share").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(n), pa.array(total + share)], names=["doc_id", "row", "n_tokens", "known"])

    scored = ids.select("doc_id", "row", "ids", "share").mapInArrow(run, f"doc_id {kind}, row long, n_tokens long, known double")
    more = counts.filter(F.col("n") > 1)  # log 1 adds nothing
    rest = ids.select("row", F.inline("rest")).join(more, "word").groupBy("row").agg(F.sum(F.col("times") * F.log("n")).alias("rest"))
    both = scored.join(rest, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("rest", F.lit(0.0))).alias("log_likelihood"))
    return both.withColumn("per_token", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
