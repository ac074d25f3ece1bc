"""Gold marts: examples, edges, and random tables against self joins."""

import datetime as dt
import random

import duckdb
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from carelake.plans import marts
from carelake.schemas import MEASUREMENT

D = dt.date


def starts(spark, data):
    return spark.createDataFrame(data, "condition_occurrence_id string, person_id string, condition_start_date date")


EXAMPLE = [
    ("s1", "ida", D(2020, 2, 20)), ("s2", "ida", D(2020, 3, 1)), ("s3", "ida", D(2020, 3, 21)),
    ("s4", "ida", D(2020, 8, 1)), ("s5", "otto", D(2020, 5, 1)), ("s6", "otto", D(2020, 6, 1)),
    ("s7", "uma", D(2020, 5, 5)),
]


@pytest.mark.parametrize("unique_ids", [True, False])
def test_30_day_readmission(spark, unique_ids):
    df = starts(spark, EXAMPLE)
    assert rows(marts.readmission_30d(df, unique_ids=unique_ids)) == [("ida", 2, 2, 1.0)]
    assert rows(marts.readmission_30d(df, unique_ids=unique_ids, include_all=True)) == [
        ("ida", 2, 2, 1.0), ("otto", 0, 0, 0.0), ("uma", 0, 0, 0.0),
    ]


@pytest.mark.parametrize("unique_ids", [True, False])
def test_30_day_edges(spark, unique_ids):
    first = D(2023, 1, 1)
    df = starts(spark, [
        ("a1", "thirty", first), ("a2", "thirty", first + dt.timedelta(30)),
        ("b1", "more", first), ("b2", "more", first + dt.timedelta(31)),
        ("c1", "same", first), ("c2", "same", first),
        ("d1", "three", first), ("d2", "three", first + dt.timedelta(5)), ("d3", "three", first + dt.timedelta(9)),
        ("e1", None, first), ("e2", None, first + dt.timedelta(1)),
        (None, "noid", first), ("f2", "noid", first + dt.timedelta(1)),
        ("g1", "nodate", None), ("g2", "nodate", first),
    ])
    assert rows(marts.readmission_30d(df, unique_ids=unique_ids)) == [
        ("thirty", 1, 1, 1.0), ("three", 2, 2, 1.0),
    ]


def test_repeated_ids(spark):
    first = D(2023, 1, 1)
    df = starts(spark, [
        ("a", "P", first), ("a", "P", first), ("a", "P", first + dt.timedelta(2)),
        ("b", "Q", first), ("b", "Q", first + dt.timedelta(3)), ("c", "Q", first + dt.timedelta(4)),
    ])
    assert rows(marts.readmission_30d(df)) == [("Q", 1, 1, 1.0)]


def random_conditions(seed, ids):
    """A third of the rows belong to one person; nulls occur everywhere."""
    rng = random.Random(seed)
    out = []
    for i in range(600):
        person = "hot" if rng.random() < 0.34 else rng.choice([None, "a", "b", "c", "d", "e"])
        start = None if rng.random() < 0.05 else D(2023, 1, 1) + dt.timedelta(rng.randrange(200))
        end = None if start is None or rng.random() < 0.2 else start + dt.timedelta(rng.randrange(-2, 40))
        number = i if ids is None else rng.randrange(ids)
        out.append((None if rng.random() < 0.03 else f"i{number}", person, start, end, rng.choice([9201, 9201, 201820])))
    return out


SCHEMA = "condition_occurrence_id string, person_id string, condition_start_date date, condition_end_date date, condition_concept_id int"


def duck(data):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (condition_occurrence_id VARCHAR, person_id VARCHAR, condition_start_date DATE, condition_end_date DATE, condition_concept_id INT)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", data)
    return con


def ordered(result):
    return sorted(result, key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.mark.parametrize("ids", [None, 40, 250])
def test_random_readmissions_equal_the_self_join(spark, ids):
    data = random_conditions(3, ids)
    expected = ordered(duck(data).execute("""
        SELECT a.person_id, count(DISTINCT a.condition_occurrence_id), count(DISTINCT b.condition_occurrence_id),
               CAST(count(DISTINCT b.condition_occurrence_id) AS DOUBLE) / count(DISTINCT a.condition_occurrence_id)
        FROM t a JOIN t b ON a.person_id = b.person_id AND a.condition_occurrence_id <> b.condition_occurrence_id
         AND b.condition_start_date > a.condition_start_date AND b.condition_start_date <= a.condition_start_date + 30
        GROUP BY 1""").fetchall())
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(marts.readmission_30d(df)) == expected
    if ids is None:
        assert rows(marts.readmission_30d(df, unique_ids=True)) == expected


def test_random_intervals_equal_the_self_join(spark):
    data = random_conditions(4, None)
    expected = ordered(duck(data).execute("""
        SELECT a.person_id, count(*), CAST(min(b.condition_start_date - a.condition_start_date) AS INT),
               CAST(max(b.condition_start_date - a.condition_start_date) AS INT),
               CAST(sum(b.condition_start_date - a.condition_start_date) AS DOUBLE) / count(*)
        FROM t a JOIN t b ON a.person_id = b.person_id AND a.condition_occurrence_id <> b.condition_occurrence_id
         AND b.condition_start_date > a.condition_start_date AND b.condition_start_date <= a.condition_start_date + 30
        GROUP BY 1""").fetchall())
    assert rows(marts.readmission_intervals(spark.createDataFrame(data, SCHEMA))) == expected


@pytest.mark.parametrize("days", [30, 7])
def test_random_pairs_equal_the_left_join(spark, days):
    data = random_conditions(5, None)
    expected = ordered(duck(data).execute(f"""
        WITH s AS (SELECT * FROM t WHERE condition_concept_id = 9201)
        SELECT a.person_id, a.condition_start_date, a.condition_end_date, b.condition_start_date,
               CASE WHEN b.condition_start_date IS NULL THEN 0 ELSE 1 END
        FROM s a LEFT JOIN s b ON a.person_id = b.person_id
         AND b.condition_start_date > a.condition_end_date AND b.condition_start_date <= a.condition_end_date + {days}
    """).fetchall())
    assert rows(marts.readmission_pairs(spark.createDataFrame(data, SCHEMA), days=days)) == expected


def test_pairs_edges(spark, monkeypatch):
    monkeypatch.setattr(marts, "_EXPANSION", 2)
    day = D(2023, 1, 1)
    after = lambda n: day + dt.timedelta(n)
    df = spark.createDataFrame([
        ("1", "A", day, after(2), 9201), ("2", "A", after(2), None, 9201), ("3", "A", after(32), None, 9201),
        ("4", "A", after(33), None, 9201), ("5", "A", after(5), None, 1),
        *[(f"x{i}", "B", after(10), None, 9201) for i in range(5)], ("6", "B", day, day, 9201),
    ], SCHEMA)
    got = rows(marts.readmission_pairs(df))
    assert [r for r in got if r[0] == "A" and r[1] == day] == [("A", day, after(2), after(32), 1)]
    assert [r for r in got if r[0] == "B" and r[1] == day] == [("B", day, day, after(10), 1)] * 5
    assert len(got) == 4 + 5 + 5


def test_hedis(spark):
    conditions = spark.createDataFrame(
        [("A", 201820), ("A", 201820), ("B", 201820), ("C", 9201), (None, 201820), ("D", 201820)],
        "person_id string, condition_concept_id int",
    )
    measurements = spark.createDataFrame([
        ("A", 3004410, D(2023, 1, 1), 9.0), ("A", 3004410, D(2023, 6, 1), 6.0), ("A", 3004410, D(2023, 6, 1), 5.0),
        ("A", 1, D(2024, 1, 1), 99.0), ("C", 3004410, D(2023, 1, 1), 1.0), (None, 3004410, D(2023, 1, 1), 1.0),
        ("D", 3004410, None, None),
    ], "person_id string, measurement_concept_id int, measurement_date date, value_as_number double")
    rest = [("B", 0, None, None), ("D", 1, None, None), (None, 0, None, None)]
    assert rows(marts.hedis(conditions, measurements)) == [("A", 1, D(2023, 6, 1), 9.0), *rest]
    assert rows(marts.hedis(conditions, measurements, latest=True)) == [("A", 1, D(2023, 6, 1), 6.0), *rest]


def test_admission_counts(spark):
    data = [row for row in EXAMPLE if row[1] != "otto"] + [(None, "uma", D(2020, 5, 9))]
    assert rows(marts.admission_count(starts(spark, data), min_count=2)) == [("ida", 4)]
    assert rows(marts.admission_count(starts(spark, EXAMPLE), min_count=2)) == [("ida", 4), ("otto", 2)]
    assert rows(marts.admission_count(starts(spark, [(None, "P", None)]))) == [("P", 0)]


def test_a_hot_person_is_reduced_to_days_before_the_window(spark, tmp_path):
    path = str(tmp_path / "conditions")
    spark.range(200_000).selectExpr(
        "cast(id as string) condition_occurrence_id",
        "if(id % 3 = 0, 'hot', cast(id % 1000 as string)) person_id",
        "date_add(date'2020-01-01', cast(id % 400 as int)) condition_start_date",
    ).write.parquet(path)
    df = spark.read.parquet(path)
    got = {r[0]: r[1] for r in marts.readmission_30d(df, unique_ids=True).collect()}
    last_day = df.filter("person_id = 'hot' and condition_start_date = date'2021-02-03'").count()
    assert got["hot"] == df.filter("person_id = 'hot'").count() - last_day
    text = plan(marts.readmission_30d(df, unique_ids=True))
    assert "Join" not in text and "Python" not in text


def test_concept_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "conditions")
    spark.createDataFrame(random_conditions(6, None), SCHEMA).withColumn("unused", F.lit(1)).write.parquet(path)
    df = spark.read.parquet(path)
    measurements = spark.createDataFrame([], MEASUREMENT)
    for mart, concept in ((marts.hedis(df, measurements), 201820), (marts.readmission_pairs(df), 9201)):
        text = plan(mart)
        assert f"EqualTo(condition_concept_id,{concept})" in text
        assert "unused" not in text


def test_pairs_per_day_stand_for_the_pairs(spark):
    df = spark.createDataFrame(random_conditions(8, None), SCHEMA)
    listed = marts.readmission_pairs(df).filter("is_readmitted_30_days = 1")
    per_day = marts.readmission_pairs(df, per_day=True)
    total = per_day.agg(F.sum("n_readmissions")).first()[0]
    assert total == listed.count() > 0
    assert per_day.filter("is_readmitted_30_days = 0").agg(F.sum("n_readmissions")).first()[0] == 0
