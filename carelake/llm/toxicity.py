"""Toxicity: boosted trees over dense features of a text, with isotonic calibration."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that insult, in four languages.
INSULTS = (
    "idiot", "idiots", "moron", "morons", "loser", "losers", "scum", "trash", "clown", "pathetic",
    "worthless", "stupid", "disgusting", "dumb", "fool", "imbecile", "jerk", "vermin",
    "dummkopf", "trottel", "abschaum", "versager", "wertlos", "widerlich", "erbärmlich",
    "imbécile", "crétin", "abruti", "ordure", "minable", "débile",
    "idiota", "imbécil", "estúpido", "basura", "escoria", "patético", "inútil",
)
#: Pronouns of the second person, in four languages.
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "euch", "ihr",
    "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos",
    "usted", "ustedes", "tú", "ti", "tus", "vosotros", "vuestro",
)
FEATURES = (
    "insults", "learned", "learned_weight", "strongest", "near_second_person", "second_person", "capitals",
    "shouted_words", "exclamations", "questions", "punctuation", "repeated_marks", "mixed_words",
    "stretched_words", "log_words",
)
#: Labelled rows that the model is fitted on, at most (chosen by a hash, so about).
FIT_ROWS = 20_000
PREFIXES = (4, 5, 6)
#: Folds of the calibration.
FOLDS = 4
NEAR = 6

_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[^\W\d_][\d@$*!|]+[^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_MARKS = re.compile(r"[!?]{2,}")
_PUNCTUATION = re.compile(r"[^\w\s]")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4. A null id counts as empty."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(4))


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """The values of FEATURES for a text; rates are per word or per character."""
    low = text.lower()
    words = _WORD.findall(low)
    n, size = max(1, len(words)), max(1, len(text))
    insults = near = second = hits = 0
    weight, strongest = 0.0, 0.0
    at_second = -NEAR - 1
    waiting: list[int] = []  # insults that no second person has been near to yet
    get = lexicon.get
    for i, w in enumerate(words):
        if w in _SECOND:
            second += 1
            at_second = i
            near += sum(i - k <= NEAR for k in waiting)
            waiting.clear()
            continue
        score = get(w, 0.0)
        for k in PREFIXES:
            if len(w) >= k and (s := get("^" + w[:k], 0.0)) > score:
                score = s
        bad = w in _INSULTS
        insults += bad
        if score:
            hits += 1
            weight += score
            strongest = max(strongest, score)
        if bad or score:
            if i - at_second <= NEAR:
                near += 1
            else:
                waiting.append(i)
    upper = sum(map(str.isupper, text)) if low != text else 0
    shouted = sum(len(w) > 2 and w.isupper() for w in _WORD.findall(text)) if upper else 0
    return [
        insults / n, hits / n, weight / n, strongest, near / n, second / n, upper / size, shouted / n,
        text.count("!") / size, text.count("?") / size, len(_PUNCTUATION.findall(text)) / size,
        len(_MARKS.findall(text)) / n, len(_MIXED.findall(text)) / n, len(_STRETCHED.findall(low)) / n,
        float(np.log1p(len(words))),
    ]


_INSULTS, _SECOND = frozenset(INSULTS), frozenset(SECOND_PERSON)


@dataclass(frozen=True)
class Trees:
    """Depth-wise complete trees: `feature` and `cut` of inner nodes, `value` of leaves."""

    base: float
    feature: np.ndarray  # tree x inner node
    cut: np.ndarray
    value: np.ndarray  # tree x leaf

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - (2**depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32) -> Trees:
    """Gradient boosting of the logistic loss on histograms of quantile bins."""
    if not len(y):
        return Trees(float(np.log(1e-3)), np.zeros((0, 1), dtype=np.int64), np.zeros((0, 1)), np.zeros((0, 2)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    mean = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), base)
    inner, leaves = 2**depth - 1, 2**depth
    out_f, out_c, out_v = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for k in range(inner):
            own = np.flatnonzero(node == k)
            best = (1e-6, 0, np.inf)
            total_g, total_h = g[own].sum(), h[own].sum()
            for f, e in enumerate(edges):
                if len(e) == 0 or len(own) < 2:
                    continue
                left_g = np.cumsum(np.bincount(code[own, f], weights=g[own], minlength=len(e) + 1))[:-1]
                left_h = np.cumsum(np.bincount(code[own, f], weights=h[own], minlength=len(e) + 1))[:-1]
                gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
                j = int(np.argmax(gain))
                if gain[j] > best[0]:
                    best = (gain[j], f, e[j])
            feature[k], cut[k] = best[1], best[2]
            node[own] = 2 * k + 1 + (x[own, feature[k]] > cut[k])
        leaf = node - inner
        value = -rate * np.bincount(leaf, weights=g, minlength=leaves) / (np.bincount(leaf, weights=h, minlength=leaves) + 1)
        margin += value[leaf]
        out_f.append(feature)
        out_c.append(cut)
        out_v.append(value)
    return Trees(base, np.array(out_f), np.array(out_c), np.array(out_v))


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the middles of the pools and their rates, with a prior of one row of each label."""
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []  # sum of labels, rows, sum of margins
    for m, label in zip(margin[order], y[order]):
        pools.append([float(label), 1.0, float(m)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, t = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2] + t]
    at = np.array([t / n for _, n, t in pools])
    rate = np.maximum.accumulate(np.array([(s + 0.01) / (n + 0.02) for s, n, _ in pools]))
    return at, rate


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, float]
    trees: Trees
    at: np.ndarray
    rate: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated, and rising with the margin inside a pool too."""
        margin = self.trees.margin(x)
        raw = 1 / (1 + np.exp(-margin))
        level = np.interp(margin, self.at, self.rate) if len(self.at) else raw
        return np.clip(0.99 * level + 0.01 * raw, 0.0, 1.0)


def _feature_rows(df: DataFrame, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    """The columns `keep` and `x`, the features of `text`."""
    fields = [df.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", x array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py() or "", lexicon) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(x, type=pa.list_(pa.float64()))], names=[*keep, "x"])

    return df.select(*keep, "text").mapInArrow(run, schema)


def learned_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words, and beginnings of words, that mark toxic texts of `sample` (text, toxic).

    A term's weight is its smoothed log odds ratio between the labels by document counts;
    all that are at least three standard errors above zero are kept, so the bound on the
    sample's rows is the only one.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))

    def beginnings(k: int) -> Column:
        return F.transform(
            F.filter(words, lambda w: F.length(w) >= k), lambda w: F.concat(F.lit("^"), F.substring(w, 1, k)))

    terms = F.concat(words, *[beginnings(k) for k in PREFIXES])
    counts = sample.groupBy("toxic").count().collect()
    total = {r["toxic"]: r["count"] for r in counts}
    bad, good = total.get(1, 0), total.get(0, 0)
    if not bad or not good:
        return {}
    found = sample.select("toxic", F.explode(F.array_distinct(terms)).alias("term")).groupBy("term").agg(
        F.sum("toxic").alias("b"), F.sum(1 - F.col("toxic")).alias("g"))
    odds = F.log((F.col("b") + 0.5) / (bad - F.col("b") + 0.5)) - F.log((F.col("g") + 0.5) / (good - F.col("g") + 0.5))
    error = F.sqrt(1 / (F.col("b") + 0.5) + 1 / (F.col("g") + 0.5))
    surest = found.filter(F.col("b") >= 2).select("term", odds.alias("odds"), (odds / error).alias("z")).filter(
        (F.col("z") >= 3) & (F.col("odds") >= 2)).orderBy(F.desc("z"), "term")
    return {r["term"]: round(float(r["odds"]), 6) for r in surest.collect()}


def fit(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> ToxicityModel:
    """A model from the labelled documents outside the held-out fold.

    `rows` bounds the labelled sample, which a hash of doc_id chooses. Half of it gives the
    lexicon, the other half the trees, which so have not seen their lexicon's texts. The
    calibration uses margins of trees fitted without the row's own fold. The driver gets
    the features of that sample only.
    """
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & (fold() != 2)).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    share = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1_000_000)) < int(1_000_000 * min(1.0, rows / max(1, n)))
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(2 * FOLDS)).cast("int")
    chosen = F.broadcast(known.filter(share).withColumn("part", part))  # about `rows` rows
    sample = documents.select("doc_id", "text").join(chosen, "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), "toxic", "part")
    lexicon = learned_lexicon(sample.filter(F.col("part") < FOLDS))
    table = _feature_rows(sample.filter(F.col("part") >= FOLDS), lexicon, ["toxic", "part"]).toArrow()
    y, part_of = table["toxic"].to_numpy().astype(float), table["part"].to_numpy()
    x = np.array(table["x"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    order = np.lexsort([*x.T, y, part_of])  # the same model whatever order rows come in
    x, y, part_of = x[order], y[order], part_of[order]
    margin = np.zeros(len(y))
    for k in range(FOLDS, 2 * FOLDS):
        own = part_of == k
        margin[own] = boost(x[~own], y[~own]).margin(x[own])
    return ToxicityModel(lexicon, boost(x, y), *isotonic(margin, y))


def accepted(documents: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of `documents` whose score is below `threshold`, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py() or "", model.lexicon) for t in batch.column("text")]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.probability(x) < threshold))

    return documents.mapInArrow(run, documents.schema)


def score(documents: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `documents` (doc_id, text).

    The whole text counts; null counts as empty, and an empty text has a score too.
    Repeated rows are scored each; other columns are not read.
    """
    rows = documents.select("doc_id", "text", (fold() == 2).alias("held_out"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py() or "", model.lexicon) for t in batch.column("text")]).reshape(-1, len(FEATURES))
            p = model.probability(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, schema)
