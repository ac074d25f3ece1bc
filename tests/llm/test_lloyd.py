"""Dimension-sharded Lloyd against a plain one."""

import hashlib
import math
import random

from carelake.llm import sharded_lloyd

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, chunk int, data string, parts string"


def plain(rows, k, rounds, d, salt):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == d and all(x is not None and math.isfinite(x) and abs(x * 1024) < 1 << 26 for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            dist = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            best = min(range(len(centres)), key=lambda n: (dist[n], n))
            out.append((i, best, dist[best]))
        return out

    for _ in range(rounds):
        near = assign()
        for n in range(len(centres)):
            mine = [v for (_, v), (_, c, _) in zip(kept, near) if c == n]
            if mine:
                centres[n] = [sum(col) // len(mine) for col in zip(*mine)]
    near = assign()
    inertia = [sum(x for _, c, x in near if c == n) for n in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, x, inertia[c], sum(inertia), digest[c]) for i, c, x in near), key=str)


def clustered(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, None, "x", 1, "d", "p") for i, v in rows], SCHEMA).repartition(3)
    got = sharded_lloyd.cluster(frame, **options)
    return sorted((tuple(r) for r in got.collect()), key=str)


def sample(n, d, seed=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.3) for x in centres[i % 5]]) for i in range(n)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (None, rows[4][1])]
    rows += [(9000 + i, list(rows[0][1])) for i in range(n)]  # half of all rows are copies
    rows += [(5000, None), (5001, []), (5002, rows[1][1][:-1]), (5003, [None] * d), (5004, [math.nan] * d),
             (5005, [math.inf] + [0.0] * (d - 1)), (5006, [1e200] * d), (5007, rows[1][1] + [0.0]), (5008, [0.0] * d)]
    return rows


def test_lloyd_equals_a_plain_one(spark):
    rows = sample(300, 10)
    for width in (4, 16):
        assert clustered(spark, rows, k=6, rounds=3, dimensions=10, width=width) == plain(rows, 6, 3, 10, "3")


def test_lloyd_small_tables(spark):
    assert clustered(spark, [], k=4, rounds=2, dimensions=4) == []
    assert clustered(spark, [(1, None)], k=4, rounds=2, dimensions=4) == []
    few = [(1, [0.5, -0.25, 3.0, 0.0]), (2, [1.0, 1.0, 1.0, 1.0])]
    assert clustered(spark, few, k=4, rounds=2, dimensions=4) == plain(few, 4, 2, 4, "3")
    # all vectors alike: every centroid but the first stays empty
    same = [(i, [1.0, 2.0]) for i in range(20)]
    assert clustered(spark, same, k=3, rounds=2, dimensions=2) == plain(same, 3, 2, 2, "3")


def test_columns_are_not_dealt_again(spark):
    """The packed vectors are shuffled once; a round ships partial distances and assignments."""
    rows = spark.createDataFrame([(i, [float(i), 1.0], None, "x", 1, "d", "p") for i in range(50)], SCHEMA)
    packed = rows.select("vec_id", "label").repartition(4, "vec_id")
    kept = sharded_lloyd.checkpointed(packed)
    joined = kept.join(spark.range(5).withColumnRenamed("id", "vec_id").hint("merge"), "vec_id")
    joined.collect()
    text = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Exchange") <= 2, text
