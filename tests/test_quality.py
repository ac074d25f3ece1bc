"""Metrics, report, circuit breaker and routing."""

import pytest
from conftest import rows

from carelake.operators import quality as q

ROWS = [
    ("q1", "ida", 0), ("q2", None, 410), ("q3", "uma", -7), (None, "pia", 0), ("q4", "otto", 3),
]
SCHEMA = "condition_occurrence_id string, person_id string, condition_concept_id long"


def test_report(spark):
    got = q.report(spark.createDataFrame(ROWS, SCHEMA))
    assert {r["constraint"]: (r["constraint_status"], r["metric"]) for r in got.collect()} == {
        "size >= 1": ("Success", 5.0),
        "complete(person_id)": ("Failure", 0.8),
        "complete(condition_occurrence_id)": ("Failure", 0.8),
        "non_negative(condition_concept_id)": ("Failure", 0.8),
    }
    with pytest.raises(q.QualityBreach, match="person_id"):
        q.require_quality(got)
    q.require_quality(q.report(spark.createDataFrame(ROWS[:1], SCHEMA)))


def test_report_of_an_empty_table(spark):
    got = q.report(spark.createDataFrame([], SCHEMA)).collect()
    assert [(r["constraint_status"], r["metric"]) for r in got] == [("Failure", 0.0)] + [("Success", None)] * 3


def test_routing_is_an_exact_partition(spark):
    df = spark.createDataFrame([*ROWS, ("q5", "rex", None), (None, None, -3)], SCHEMA)
    assert rows(q.valid_rows(df), "person_id") == [("ida",), ("otto",), ("rex",)]
    assert rows(q.valid_rows(df, q.KEY_RULES), "person_id") == [("ida",), ("otto",), ("rex",), ("uma",)]
    dead = {tuple(r)[:3]: r["reasons"] for r in q.dead_letters(df).collect()}
    assert dead[(None, None, -3)] == [
        "complete(person_id)", "complete(condition_occurrence_id)", "non_negative(condition_concept_id)",
    ]
    assert q.valid_rows(df).count() + len(dead) == df.count()
    assert q.tagged(df).filter("size(reasons) = 0").count() == q.valid_rows(df).count()


def test_a_predicate_that_is_null_holds(spark):
    df = spark.sql("SELECT * FROM VALUES (date '2999-01-01'), (date '2000-01-01'), (CAST(NULL AS DATE)) t(condition_start_date)")
    assert q.valid_rows(df, [q.NOT_IN_FUTURE]).count() == 2
    assert q.metrics(df, [q.NOT_IN_FUTURE]).first()[1] == 1


def test_metrics_are_observed_by_the_write(spark, tmp_path):
    df, seen = q.observed(spark.createDataFrame(ROWS, SCHEMA))
    q.valid_rows(df).write.parquet(str(tmp_path / "valid"))
    assert seen.get == {
        "size": 5, "complete(person_id)": 1, "complete(condition_occurrence_id)": 1,
        "non_negative(condition_concept_id)": 1,
    }
