"""Hash parts: touched ones are rewritten, others keep their files; marts equal a full rebuild."""

import datetime as dt
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import PySparkException

from carelake.operators import merge as m
from carelake.plans import gold, marts
from carelake.plans.chain import lab_settings, read_mart, read_silver, run_day, run_measurements, stay_settings
from carelake.sources import bronze, parts

SCHEMA = "condition_occurrence_id string, person_id string, updated_at timestamp, cdc_op string"
DAY = lambda n: dt.datetime(2024, 1, n)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def files(path):
    return {f.parent.name: f.name for f in Path(path).rglob("*.parquet")}


def test_untouched_parts_keep_their_files(spark, tmp_path):
    lake, table = str(tmp_path), f"{tmp_path}/table"
    first = frame(spark, [(str(i), f"p{i}", DAY(1), "c") for i in range(200)])
    m.merge_parts(spark, lake, table, first, parts=8)
    before = files(table)
    assert len(before) == 8
    second = frame(spark, [("7", "q", DAY(2), "u"), ("200", "q", DAY(2), "c")])
    touched = {f"part={p}" for p in parts.touched_parts(second, m.KEY, 8)}
    m.merge_parts(spark, lake, table, second, parts=8)
    after = files(table)
    assert {p for p in after if after[p] != before.get(p)} == touched and 1 <= len(touched) <= 2
    expected = m.merge_frames(first, second)
    assert rows(parts.read_parts(spark, table, m.KEY)) == rows(expected)


def test_a_part_that_loses_all_rows(spark, tmp_path):
    lake, table = str(tmp_path), f"{tmp_path}/table"
    m.merge_parts(spark, lake, table, frame(spark, [("a", "p", DAY(1), "c")]), parts=4)
    m.merge_parts(spark, lake, table, frame(spark, [("a", "p", DAY(2), "d")]), parts=4)
    assert rows(parts.read_parts(spark, table, m.KEY)) == []
    m.merge_parts(spark, lake, table, frame(spark, []), parts=4)
    m.merge_parts(spark, lake, table, frame(spark, [("a", "p", DAY(3), "c")]), parts=4)
    assert rows(parts.read_parts(spark, table, m.KEY), "person_id") == [("p",)]
    assert parts.read_parts(spark, f"{tmp_path}/none", m.KEY) is None


def test_a_declared_change_is_finished_and_another_forgotten(spark, tmp_path, monkeypatch):
    lake, table = str(tmp_path), f"{tmp_path}/table"
    m.merge_parts(spark, lake, table, frame(spark, [("a", "p", DAY(1), "c")]), parts=4)
    # dies before the declaration
    m.stage_merge(spark, table, frame(spark, [("a", "x", DAY(2), "u")]), parts=4)
    assert rows(parts.read_parts(spark, table, m.KEY), "person_id") == [("p",)]
    # dies after it
    m.stage_merge(spark, table, frame(spark, [("a", "q", DAY(2), "u")]), parts=4)
    with monkeypatch.context() as patch:
        patch.setattr(parts, "settle", lambda *_: None)
        parts.commit(spark, lake, [table])
    assert rows(parts.read_parts(spark, table, m.KEY), "person_id") == [("p",)]
    for _ in range(2):
        parts.settle(spark, lake)
        assert rows(parts.read_parts(spark, table, m.KEY), "person_id") == [("q",)]


def test_rows_of_other_parts_and_null_keys_fail(spark, tmp_path):
    data = frame(spark, [(str(i), "p", DAY(1), "c") for i in range(50)])
    with pytest.raises(PySparkException, match="untouched part"):
        parts.stage(data, f"{tmp_path}/table", m.KEY, [0], 8)
    with pytest.raises(PySparkException, match="null condition_occurrence_id"):
        m.merge_parts(spark, str(tmp_path), f"{tmp_path}/table", frame(spark, [(None, "p", DAY(1), "c")]), parts=4)
    with pytest.raises(ValueError, match="null keys"):
        m.merge_parts(spark, str(tmp_path), f"{tmp_path}/table", data, null_keys="insert")


def payload(number, op, day, **values):
    import json
    return (str(number), "EHR", json.dumps({**values, "cdc_op": op, "updated_at": f"2024-01-0{day} 08:00:00"}), DAY(day))


def stay(number, op, day, patient, code, start, end):
    return payload(number, op, day, patient_id=patient, patient_mrn=f"M{patient}", diagnosis_code=code, admission_date=start, discharge_date=end)


def lab(number, op, day, patient, code, taken, result):
    return payload(number, op, day, patient_id=patient, patient_mrn=f"M{patient}", test_code=code, taken_on=taken, result=result)


STAYS = {
    1: [stay(1, "c", 1, "a", "I", "2023-01-01", "2023-01-03"), stay(2, "c", 1, "a", "I", "2023-01-20", "2023-01-21"),
        stay(3, "c", 1, "b", "I", "2023-02-01", "2023-02-03"), stay(4, "c", 1, "b", "E", "2023-02-10", "2023-02-10"),
        stay(5, "c", 1, "c", "E", "2023-02-10", "2023-02-10"), stay(6, "c", 1, "d", "I", "2023-05-01", "2023-05-02")],
    2: [payload(2, "d", 2), stay(3, "u", 2, "b", "I", "2023-02-05", "2023-02-08"), payload(5, "d", 2),
        stay(7, "c", 2, "b", "I", "2023-02-20", "2023-02-21")],
    3: [stay(6, "u", 3, "a", "I", "2023-01-10", "2023-01-11"), stay(5, "c", 3, "e", "E", "2023-03-01", "2023-03-01")],
}
LABS = {
    1: [lab(1, "c", 1, "b", "A1C", "2023-02-11", 7.5), lab(2, "c", 1, "b", "A1C", "2023-02-01", 8.5), lab(3, "c", 1, "c", "A1C", "2023-02-11", 6.0),
        lab(4, "c", 1, "e", "other", "2023-03-02", 1.0)],
    3: [payload(2, "d", 3), lab(5, "c", 3, "e", "A1C", "2023-03-04", 5.5)],
}


def test_marts_equal_a_full_rebuild(spark, tmp_path):
    """After each of three days with deletes, moved dates, another person's stay and tests."""
    lake = str(tmp_path / "lake")
    schema = "payload_id string, source_system_id string, raw_payload_json string, ingestion_timestamp timestamp"
    codes = spark.createDataFrame([("I", marts.INPATIENT_VISIT), ("E", marts.DIABETES)], "source_code string, concept_id int")
    tests = spark.createDataFrame([("A1C", marts.HBA1C)], "source_code string, concept_id int")
    for day in (1, 2, 3):
        bronze.land(spark.createDataFrame(STAYS[day], schema), lake, "stays", 0)
        assert run_day(spark, lake, "stays", DAY(day).date(), stay_settings("s"), codes, parts=4)["size"] == len(STAYS[day])
        if day in LABS:
            bronze.land(spark.createDataFrame(LABS[day], schema), lake, "labs", 0)
            run_measurements(spark, lake, "labs", DAY(day).date(), lab_settings("s"), tests, parts=4)
        conditions = m.live_rows(read_silver(spark, lake))
        measured = m.live_rows(parts.read_parts(spark, f"{lake}/{gold.MEASUREMENTS}", gold.MEASUREMENT_KEY))
        for name, build in gold.CONDITION_MARTS.items():
            assert rows(read_mart(spark, lake, name)) == rows(build(conditions)), (day, name)
        hedis = read_mart(spark, lake, "hedis")
        assert rows(hedis) == rows(marts.hedis(conditions, measured)), day
        assert hedis.filter("had_hba1c_test = 1").count() >= 1
        assert read_mart(spark, lake, "readmission_days").filter("is_readmitted_30_days = 1").count() >= 1
    # the last day again moves nothing, and writes no mart
    before = files(gold.gold(lake, "hedis"))
    run_day(spark, lake, "stays", DAY(3).date(), stay_settings("s"), codes, parts=4)
    assert files(gold.gold(lake, "hedis")) == before


def test_a_merge_shuffles_rows_once_and_commits_by_renaming(spark, tmp_path, monkeypatch):
    """One exchange holds all rows and changes of a merge, and the staged files become the table's."""
    lake, table = str(tmp_path), f"{tmp_path}/table"
    plans, write = [], parts.stage_spread

    def watched(rows, path, key):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(rows, path, key)

    monkeypatch.setattr(parts, "stage_spread", watched)
    m.merge_parts(spark, lake, table, frame(spark, [(str(i), f"p{i}", DAY(1), "c") for i in range(50)]), parts=4)
    staged = m.stage_merge(spark, table, frame(spark, [("1", "q", DAY(2), "u"), ("2", None, DAY(2), "d"), ("x", "r", DAY(2), "c")]), parts=4, tombstones=True)
    assert [p.count("Exchange ") for p in plans] == [1, 1]
    out, new = staged.moved(m.KEY, [m.KEY, "person_id"])
    assert rows(out) == [("1", "p1"), ("2", "p2")] and rows(new) == [("1", "q"), ("x", "r")]
    written = files(f"{table}.staged")
    parts.commit(spark, lake, [table])
    assert {p: files(table)[p] for p in written} == written and files(f"{table}.staged") == {}
    assert rows(parts.read_parts(spark, table, m.KEY).filter("condition_occurrence_id in ('1', 'x')"), "person_id") == [("q",), ("r",)]


def test_packed_text_comes_back(spark):
    from pyspark.sql import functions as F

    from carelake.functions import deid

    whole = "DEID-" + "0a" * 32
    texts = [whole, whole.upper(), whole + "\n", whole[:-2], "", None, "\x01abc", "x\x00é"]
    found = spark.createDataFrame([(t,) for t in texts], "v string").select("v", deid.packed(F.col("v")).alias("p"))
    assert found.filter(~deid.unpacked(F.col("p")).eqNullSafe(F.col("v"))).count() == 0
    assert found.filter(F.length("p") == 33).count() == 1


@pytest.mark.parametrize("few", [0, 1000])
def test_marts_of_few_and_of_many_persons(spark, tmp_path, monkeypatch, few):
    """Marts are the same whether the moved persons' rows or their whole parts are read, with linked persons too."""
    monkeypatch.setattr(gold, "FEW_PERSONS", few)
    lake = str(tmp_path)
    schema = "condition_occurrence_id string, person_id string, condition_concept_id int, condition_start_date date, condition_end_date date, updated_at timestamp, cdc_op string"
    day = lambda n: dt.date(2023, 1, n)
    batches = [
        [(str(i), f"p{i % 5}", marts.INPATIENT_VISIT, day(1 + i), day(2 + i), DAY(1), "c") for i in range(15)],
        [("3", "p1", marts.INPATIENT_VISIT, day(20), day(21), DAY(2), "u"), ("4", None, None, None, None, DAY(2), "d"), ("99", "q", 0, day(9), day(9), DAY(2), "c")],
    ]
    for batch in batches:
        merged = m.stage_merge(spark, f"{lake}/{gold.SILVER}", spark.createDataFrame(batch, schema), parts=2, tombstones=True)
        parts.commit(spark, lake, [f"{lake}/{gold.SILVER}", *gold.stage_conditions(spark, lake, merged, parts=2)])
    renamed = spark.createDataFrame([("p1", "p1", "p0"), ("q", "q", "p0")], "source_person string, old string, new string")
    parts.commit(spark, lake, gold.stage_links(spark, lake, renamed, parts=2))
    person = {"p1": "p0", "q": "p0"}
    live = m.live_rows(read_silver(spark, lake)).replace(person, subset=["person_id"])
    for name, build in gold.CONDITION_MARTS.items():
        assert rows(read_mart(spark, lake, name)) == rows(build(live)), name
    copied = parts.read_parts(spark, gold.by_person(lake, gold.SILVER), gold.PERSON)
    assert rows(copied.filter("source_person is not null").select("source_person").distinct()) == [("p1",), ("q",)]


def test_rows_are_dealt_out_without_a_sample(spark, tmp_path, monkeypatch):
    """No range is sought for the rows of a merge, of the copy by person and of the marts, as that computes them twice."""
    plans, write = [], parts.stage_spread

    def watched(found, path, key):
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return write(found, path, key)

    for module in (parts, gold):
        monkeypatch.setattr(module, "stage_spread", watched)
    schema = "condition_occurrence_id string, person_id string, condition_concept_id int, condition_start_date date, condition_end_date date, updated_at timestamp, cdc_op string"
    day = dt.date(2023, 1, 1)
    first = spark.createDataFrame([(str(i), f"p{i % 5}", marts.DIABETES, day, day, DAY(1), "c") for i in range(15)], schema)
    merged = m.stage_merge(spark, f"{tmp_path}/{gold.SILVER}", first, parts=2, tombstones=True)
    gold.stage_conditions(spark, str(tmp_path), merged, parts=2)
    assert len(plans) == 2 + len(gold.CONDITION_MARTS) + 1
    assert not any("rangepartitioning" in p for p in plans)


def test_a_person_with_most_rows_has_several_slices(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(parts, "LEAST_ROWS", 100)
    data = spark.range(4000).select(
        F.col("id").cast("string").alias("key"), F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).otherwise("hot").alias("person"))
    known = data.union(data.limit(200))
    touched = parts.touched_parts(known, "person", 8)
    slices = parts.Slices.counted(known, "person", touched, 8)
    near = parts.spread(known, "table", "person", touched, 8, ["key"], slices=slices)
    held = near.withColumn("at", F.spark_partition_id()).cache()
    assert rows(held.filter("person is not null").select("key", "person")) == rows(known)
    assert held.filter("person is null").count() == len(touched)
    together = held.filter("person is not null").groupBy("part", "person", "key").agg(F.count_distinct("at").alias("n"))
    assert together.filter("n > 1").count() == 0
    assert held.filter("person = 'hot'").select("at").distinct().count() > 1
    largest = held.groupBy("at").count().agg(F.max("count")).first()[0]
    assert largest < 2000
    ordered = held.groupBy("at").agg(F.min("part").alias("low"), F.max("part").alias("high")).orderBy("at").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(ordered, ordered[1:]))


def test_a_row_that_another_replaces_does_not_go_out(spark, tmp_path):
    table = f"{tmp_path}/table"
    m.merge_parts(spark, str(tmp_path), table, frame(spark, [(k, "p", DAY(1), "c") for k in "abcd"]), parts=2)
    changes = frame(spark, [("a", "p", DAY(2), "u"), ("b", "q", DAY(2), "u"), ("c", None, DAY(2), "d"), ("e", "r", DAY(2), "c")])
    delta = m.stage_merge(spark, table, changes, parts=2, tombstones=True).delta(m.KEY, [m.KEY, "person_id", m.TIME], ["person_id"])
    assert rows(delta, m.KEY, "person_id", "comes") == [
        ("a", "p", True), ("b", "p", False), ("b", "q", True), ("c", "p", False), ("e", "r", True)]
