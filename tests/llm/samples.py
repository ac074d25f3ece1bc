"""Small tables for the tests of the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    *[T.StructField(c, T.StringType()) for c in ("node", "same", "score", "weight", "slot")],
])
WORDS = ("river stone lamp green winter table paper cloud engine market silver window bread north signal "
         "garden copper tunnel violet harbour ladder museum pepper rocket saddle").split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "ly"]) for _ in range(words))


def texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, empty, null, short, very long and accented texts, repeated rows."""
    rng = random.Random(seed)
    base = [prose(rng, 60) for _ in range(12)]
    passage = prose(rng, 30)
    out: list[tuple[int | None, str | None]] = list(enumerate(base))
    out += [(100 + i, t) for i, t in enumerate(base[:4])]
    out += [(200 + i, base[5] + f" tail{i}") for i in range(6)]
    out += [(300 + i, prose(rng, 20) + " " + passage + " " + prose(rng, 20)) for i in range(5)]
    out += [(400, ""), (401, None), (402, "  \n"), (403, "one two"), (404, "one two"), (405, "é" * 70), (406, "è" * 70 + "é" * 60)]
    out += [(500, " ".join([base[0], prose(rng, 4000), base[1]])), (501, "a" * 5000), (502, "x" + "a" * 3000)]
    out += [(600, base[7]), (600, base[7]), (None, base[8]), (-3, base[9])]
    return out


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"src{k % 3}", None, "n", "s", "c", "w", "l")
         for k, (i, t) in enumerate(rows)], DOCUMENT)
