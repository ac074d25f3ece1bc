"""Linkage against brute force over all pairs of small tables."""

import random
from collections import Counter
from itertools import combinations

import pytest
from conftest import plan

from carelake.operators import linkage as k
from carelake.operators.components import connected_components

SCHEMA = "unique_id int, dob string, first_name string, last_name string, city string"
SETTINGS = k.LinkSettings(compare=("first_name", "last_name", "dob", "city"))
FREE = k.LinkSettings(compare=("first_name", "last_name", "city"))
MODEL = k.LinkModel(
    m={c: 0.9 for c in SETTINGS.compare},
    u={"first_name": 0.02, "last_name": 0.05, "dob": 0.01, "city": 0.3}, prior=0.05,
)


def people(seed, n=150, nulls=0.2):
    """A third of the people share a block, and copies abound."""
    rng = random.Random(seed)

    def value(options):
        return None if rng.random() < nulls else rng.choice(options)

    return [
        (i, "hot" if rng.random() < 0.34 else value(["d1", "d2", "d3", "d4"]),
         value(["Jo", "Al", "Mo", "Di"]), value(["X", "Y", "Z", "W"]), value(["P", "Q"]))
        for i in range(n)
    ]


def brute_pairs(data, settings):
    names = ["unique_id", "dob", "first_name", "last_name", "city"]
    place = [names.index(c) for c in settings.compare]
    for a, b in combinations(data, 2):
        if a[1] is not None and a[1] == b[1]:
            yield a, b, tuple(
                -1 if a[i] is None or b[i] is None else int(a[i] == b[i]) for i in place
            )


def components(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return sorted(label.items())


@pytest.mark.parametrize("settings, seed", [(SETTINGS, 1), (FREE, 2)])
def test_pattern_counts(spark, settings, seed):
    data = people(seed)
    df = spark.createDataFrame(data, SCHEMA)
    expected = Counter(p for _, _, p in brute_pairs(data, settings))
    got = {tuple(r)[:-1]: int(r["n_pairs"]) for r in k.pattern_counts(df, settings).collect()}
    assert got == expected
    by_block = Counter((a[1], p) for a, _, p in brute_pairs(data, settings))
    got = {(r[0], tuple(r)[1:-1]): int(r["n_pairs"]) for r in k.pattern_counts(df, settings, by_block=True).collect()}
    assert got == by_block


def test_candidates_share_a_block(spark):
    df = spark.createDataFrame([
        (11, "1981-07-30", "Ida", None, "Graz"), (12, "1981-07-30", "Ida", "Moser", "Linz"),
        (13, "1981-07-30", "Otto", "Moser", "Linz"), (14, "1962-02-11", "Otto", "Moser", "Linz"),
    ], SCHEMA)
    assert sorted(tuple(map(int, r)) for r in k.pattern_counts(df, SETTINGS).collect()) == [
        (0, -1, 1, 0, 1), (0, 1, 1, 1, 1), (1, -1, 1, 0, 1),
    ]


def test_agreement_rates(spark):
    data = people(3)
    got = {r["column_name"]: r for r in k.agreement_rates(spark.createDataFrame(data, SCHEMA), SETTINGS).collect()}
    for c, i in {"first_name": 2, "last_name": 3, "dob": 1, "city": 4}.items():
        pairs = [(a, b) for a, b in combinations(data, 2) if a[i] is not None and b[i] is not None]
        agree = sum(a[i] == b[i] for a, b in pairs)
        assert (int(got[c]["n_agree"]), int(got[c]["n_pairs"])) == (agree, len(pairs))
        assert got[c]["u"] == pytest.approx(agree / len(pairs))


@pytest.mark.parametrize("settings, threshold", [(FREE, 0.3), (SETTINGS, 0.8), (FREE, 0.97)])
def test_predictions_partners_and_clusters(spark, settings, threshold):
    data = people(4)
    df = spark.createDataFrame(data, SCHEMA)
    hits = [
        (a, b, p) for a, b, p in brute_pairs(data, settings)
        if MODEL.probability(settings.compare, p) >= threshold
    ]
    assert hits
    names = ["unique_id", "dob", "first_name", "last_name", "city"]
    grouped = Counter(
        (a[1], tuple(a[names.index(c)] if g == 1 else None for c, g in zip(settings.compare, p) if c != "dob"), p)
        for a, _, p in hits
    )
    values = [c for c in settings.compare if c != "dob"]
    found = k.predict(df, settings, MODEL, threshold).collect()
    assert {
        (r["dob"], tuple(r[c] for c in values), tuple(r[f"gamma_{c}"] for c in settings.compare)): int(r["n_pairs"])
        for r in found
    } == grouped
    assert all(
        r["match_probability"] == pytest.approx(MODEL.probability(settings.compare, tuple(r[f"gamma_{c}"] for c in settings.compare)))
        for r in found
    )
    listed = k.partners(df, df, settings, MODEL, threshold).collect()
    assert sorted((r["unique_id_l"], r["unique_id_r"]) for r in listed) == sorted(
        pair for a, b, _ in hits for pair in ((a[0], b[0]), (b[0], a[0]))
    )
    expected = components([d[0] for d in data], [(a[0], b[0]) for a, b, _ in hits])
    assert sorted(map(tuple, k.clusters(df, settings, MODEL, threshold).collect())) == expected


@pytest.mark.parametrize("seed", range(2))
def test_clusters_with_missing_values_that_decide(spark, seed):
    """City decides: a pair is a match if it agrees or is missing, not if it differs."""
    settings = k.LinkSettings(compare=("first_name", "last_name", "city"))
    model = k.LinkModel(
        m={"first_name": 0.6, "last_name": 0.9, "city": 0.99},
        u={"first_name": 0.4, "last_name": 0.05, "city": 0.3}, prior=0.2,
    )
    data = people(seed, n=60, nulls=0.4)
    hits = [(a[0], b[0]) for a, b, p in brute_pairs(data, settings) if model.probability(settings.compare, p) >= 0.6]
    got = k.clusters(spark.createDataFrame(data, SCHEMA), settings, model, 0.6)
    assert sorted(map(tuple, got.collect())) == components([d[0] for d in data], hits)


def test_clusters_without_matches_and_with_a_bad_column(spark):
    df = spark.createDataFrame(people(1, n=10), SCHEMA)
    got = k.clusters(df, FREE, MODEL, threshold=0.999999)
    assert all(r["unique_id"] == r["cluster_id"] for r in got.collect())
    bad = k.LinkModel(m={**MODEL.m, "city": 0.1}, u=MODEL.u, prior=0.05)
    with pytest.raises(ValueError, match="city"):
        k.clusters(df, FREE, bad)


def test_em_recovers_what_the_pairs_were_drawn_with(spark):
    """Copies of 400 people whose names survive with known rates."""
    rng = random.Random(11)
    data = []
    for i in range(400):
        first, last, city = (f"{c}{rng.randrange(n)}" for c, n in (("f", 60), ("l", 80), ("c", 12)))
        data.append((i, f"d{i % 40}", first, last, city))
        data.append((
            10_000 + i, f"d{i % 40}",
            first if rng.random() < 0.9 else f"f{rng.randrange(60)}",
            last if rng.random() < 0.8 else f"l{rng.randrange(80)}",
            city if rng.random() < 0.95 else f"c{rng.randrange(12)}",
        ))
    model = k.estimate(spark.createDataFrame(data, SCHEMA), SETTINGS)
    assert model.m["first_name"] == pytest.approx(0.9, abs=0.06)
    assert model.m["last_name"] == pytest.approx(0.8, abs=0.06)
    assert model.m["city"] == pytest.approx(0.95, abs=0.06)
    assert model.m["dob"] == 0.9
    assert model.history[-1] < 1e-6
    table = {r["column_name"]: r for r in k.model_frame(spark.createDataFrame(data, SCHEMA), SETTINGS, model).collect()}
    assert table["city"]["u"] == pytest.approx(1 / 12, abs=0.02)


def test_no_pair_is_formed_in_a_block(spark):
    """100,000 records of one block form 5 billion pairs; the counts need none of them."""
    df = spark.range(100_000).selectExpr(
        "cast(id as int) unique_id", "'hot' dob", "cast(id % 50 as string) first_name",
        "cast(id % 7 as string) last_name", "cast(id % 3 as string) city",
    )
    counts = k.pattern_counts(df, SETTINGS).collect()
    assert sum(int(r["n_pairs"]) for r in counts) == 100_000 * 99_999 // 2
    found = k.predict(df, SETTINGS, MODEL, 0.99)
    assert "CartesianProduct" not in plan(found) and "NestedLoop" not in plan(found)
    assert sum(int(r["n_pairs"]) for r in found.collect()) > 1_000_000
    got = k.clusters(df, FREE, MODEL, 0.5)
    assert got.count() == 100_000


@pytest.mark.parametrize("seed", range(2))
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(200)]
    edges += [(5000, 5001 + i) for i in range(300)]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    got = connected_components(spark.createDataFrame(edges, "left int, right int"))
    assert sorted(map(tuple, got.collect())) == components(nodes, [e for e in edges if e[0] != e[1]])


def test_no_edges_have_no_components(spark):
    assert connected_components(spark.createDataFrame([], "left int, right int")).count() == 0
    assert connected_components(spark.createDataFrame([(1, 1)], "left int, right int")).count() == 0


def test_a_model_that_has_not_settled_is_an_error(spark):
    with pytest.raises(ValueError, match="not settled"):
        k.estimate(spark.createDataFrame(people(3), SCHEMA), SETTINGS, max_iterations=1, tolerance=0.0)


def test_six_columns_with_few_rows_per_record(spark):
    """Equal to the pairs themselves; a record is copied for the asked sets only, and holds few keys."""
    rng = random.Random(6)
    columns = [f"v{i}" for i in range(6)]
    six = k.LinkSettings(unique_id="unique_id", block=("b",), compare=tuple(columns))
    people = [
        (i, rng.choice("xy"), *[None if c == 5 and rng.random() < 0.3 else rng.choice("pqr"[: 2 + c % 2]) for c in range(6)])
        for i in range(60)
    ]
    frame = spark.createDataFrame(people, "unique_id int, b string, " + ", ".join(f"{c} string" for c in columns))
    model = k.LinkModel(m={c: 0.9 for c in columns}, u={c: 0.1 for c in columns}, prior=0.01)

    def level(a, b):
        return -1 if a is None or b is None else int(a == b)

    plain = Counter(
        tuple(level(a, b) for a, b in zip(p[2:], q[2:])) for p, q in combinations(people, 2) if p[1] == q[1])
    got = {tuple(r[f"gamma_{c}"] for c in columns): int(r["n_pairs"]) for r in k.pattern_counts(frame, six).collect()}
    assert got == plain
    matches = {p: n for p, n in plain.items() if model.probability(columns, p) >= 0.8}
    found = Counter()
    for r in k.predict(frame, six, model).collect():
        found[tuple(r[f"gamma_{c}"] for c in columns)] += int(r["n_pairs"])
    assert found == matches
    patterns = k._predicted(six, model, 0.8)
    asked = {agree for _, _, agree, _, _ in k._signs(patterns)}
    assert 0 not in asked and len(asked) <= 42  # sets of three columns and more: 63 without pruning
    seen = {0b111111, 0b011111}
    per_record = Counter(have for have, *_ in k._held_keys(patterns, 6, seen))
    assert set(per_record) == seen and max(per_record.values()) <= 65  # 792 without pruning
