"""Importance resampling against a plain version; composed CRCs against real ones."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from samples import documents, prose, texts

from carelake.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def grams(text, n):
    w = words(text)
    return [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, n, buckets, percent, least):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for rows, counts in ((docs, s), (target, t)):
        for _, text in rows:
            for g in grams(text, n):
                counts[bucket(g)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        found = grams(text, n)
        weight = sum(gain[bucket(g)] for g in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, len(words(text)) >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = math.floor(percent * len(able) / 100)
    rows = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)]
    return sorted(rows + [(*r[:4], None) for r in out if not r[4]], key=str)


def odd_texts():
    rng = random.Random(8)
    rows = texts()
    rows += [(700, "ÀB c-DéE 9x\x7fy z  _ " * 10), (701, "!!! ... \n\t"), (702, "one"), (703, "ONE one One"), (704, "a" * 70_000 + " b")]
    rows += [(800 + i, prose(rng, 25)) for i in range(60)]
    return rows


TARGET = [(1, "river stone lamp green"), (2, None), (3, ""), (3, "Garden COPPER tunnel garden-copper")]


@pytest.mark.parametrize("n, buckets", [(1, 10_000), (3, 997)])
def test_equals_a_plain_version(spark, n, buckets):
    rows = odd_texts()
    target = spark.createDataFrame([(i, t, 1) for i, t in TARGET], "item_id long, text string, bucket int")
    got = importance.resample(documents(spark, rows).repartition(3), target, n=n, buckets=buckets, percent=40)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, TARGET, n, buckets, 40, 20)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(documents(spark, []), none).collect() == []
    rows = odd_texts()[:20]
    got = importance.resample(documents(spark, rows), none, buckets=100, percent=100)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, [], 1, 100, 100, 20)


def test_dictionaries_of_few_texts_change_nothing(spark, monkeypatch):
    rows = [t.encode() for _, t in odd_texts() if t]
    whole = importance.features(importance.scan(rows), 2, 5000)
    single = [importance.features(importance.scan([t]), 2, 5000)[0] for t in rows]
    assert all((a == b).all() for a, b in zip(whole, single))


def test_composed_crc():
    rng = random.Random(2)
    pairs = [(rng.randbytes(rng.randrange(40)), rng.randbytes(rng.randrange(3000))) for _ in range(60)]
    got = importance.composed(
        np.array([zlib.crc32(a) for a, _ in pairs], dtype=np.uint32), np.array([zlib.crc32(b) for _, b in pairs], dtype=np.uint32),
        np.array([len(b) for _, b in pairs], dtype=np.uint32))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]
