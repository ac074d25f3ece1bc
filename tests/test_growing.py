"""Clusters that grow by batches equal those of one run over all records."""

import datetime as dt
import hashlib
import random

from conftest import rows
from test_parts import DAY, lab, stay

from carelake.operators import growing, linkage
from carelake.operators.merge import live_rows
from carelake.plans import gold, marts
from carelake.plans.chain import lab_settings, read_mart, read_silver, run_day, run_measurements, run_persons, stay_settings
from carelake.sources import bronze

SCHEMA = "unique_id int, dob string, first_name string, last_name string, city string"
SETTINGS = linkage.LinkSettings(compare=("first_name", "last_name", "city"))
MODEL = linkage.LinkModel(
    m={c: 0.9 for c in SETTINGS.compare}, u={"first_name": 0.02, "last_name": 0.05, "city": 0.3}, prior=0.05)


def people(seed, n):
    rng = random.Random(seed)
    value = lambda options: None if rng.random() < 0.25 else rng.choice(options)
    return [
        (i, "hot" if rng.random() < 0.34 else value(["d1", "d2", "d3", None]), value([f"f{k}" for k in range(12)]),
         value([f"l{k}" for k in range(12)]), value(["P", "Q"]))
        for i in range(n)
    ]


def test_three_batches_equal_one_run(spark, tmp_path):
    lake = str(tmp_path)
    everyone = people(3, 150)
    random.Random(4).shuffle(everyone)  # small ids come late too, and rename clusters
    so_far, merges = [], 0
    for batch in (everyone[:70], everyone[70:110], everyone[110:] + everyone[:5]):
        before = {} if not so_far else dict(tuple(r) for r in growing.read_clusters(spark, lake).collect())
        frame = spark.createDataFrame(batch, SCHEMA)
        growing.add_records(spark, lake, frame, SETTINGS, MODEL, parts=4)
        so_far = list(dict.fromkeys([*so_far, *batch]))
        fresh = linkage.clusters(spark.createDataFrame(so_far, SCHEMA), SETTINGS, MODEL)
        got = growing.read_clusters(spark, lake)
        assert rows(got, "id", "cluster_id") == rows(fresh, "unique_id", "cluster_id")
        after = dict(tuple(r) for r in got.select("id", "cluster_id").collect())
        merges += sum(after[i] != c for i, c in before.items())
    assert merges > 3 and len(set(after.values())) < 140


def test_a_batch_that_comes_again_moves_nothing(spark, tmp_path):
    lake = str(tmp_path)
    frame = spark.createDataFrame(people(5, 30) + [(None, "hot", "f1", "l1", "P")], SCHEMA)
    growing.add_records(spark, lake, frame, SETTINGS, MODEL, parts=2)
    before = rows(growing.read_clusters(spark, lake))
    assert len(before) == 30
    assert growing.stage_records(spark, lake, frame, SETTINGS, MODEL, parts=2).moved.count() == 0
    growing.add_records(spark, lake, frame.limit(0), SETTINGS, MODEL, parts=2)
    assert rows(growing.read_clusters(spark, lake)) == before


def test_a_readmission_spans_two_ids_of_one_person(spark, tmp_path):
    """Joined after their stays have landed: the rows move in Gold, Silver keeps the sources' names."""
    lake = str(tmp_path / "lake")
    schema = "payload_id string, source_system_id string, raw_payload_json string, ingestion_timestamp timestamp"
    codes = spark.createDataFrame([("I", marts.INPATIENT_VISIT), ("E", marts.DIABETES)], "source_code string, concept_id int")
    tests = spark.createDataFrame([("A1C", marts.HBA1C)], "source_code string, concept_id int")
    stays = [stay(1, "c", 1, "a", "I", "2023-01-01", "2023-01-02"), stay(2, "c", 1, "a", "E", "2023-09-01", "2023-09-02"),
             stay(3, "c", 1, "x", "I", "2023-05-01", "2023-05-02")]
    bronze.land(spark.createDataFrame(stays, schema), lake, "stays", 0)
    run_day(spark, lake, "stays", DAY(1).date(), stay_settings("s"), codes, parts=2)
    bronze.land(spark.createDataFrame([lab(1, "c", 1, "b", "A1C", "2023-02-01", 7.0)], schema), lake, "labs", 0)
    run_measurements(spark, lake, "labs", DAY(1).date(), lab_settings("s"), tests, parts=2)
    assert read_mart(spark, lake, "readmissions_30_day") is None or read_mart(spark, lake, "readmissions_30_day").count() == 0
    assert rows(read_mart(spark, lake, "hedis"), "had_hba1c_test") == [(0,)]

    token = {p: "DEID-" + hashlib.sha256(f"M{p}s".encode()).hexdigest() for p in "abx"}
    people = spark.createDataFrame(
        [(token[p], "d", n, n, "P") for p, n in (("a", "ann"), ("b", "ann"), ("x", "xi"))], SCHEMA.replace("unique_id int", "unique_id string"))
    linked = linkage.LinkSettings(block=("dob",), compare=("first_name", "last_name", "city"))
    model = linkage.LinkModel(m={c: 0.9 for c in linked.compare}, u={"first_name": 0.02, "last_name": 0.05, "city": 0.3}, prior=0.05)
    person = min(token["a"], token["b"])
    for _ in range(2):
        run_persons(spark, lake, people, linked, model, parts=2)
        assert rows(read_mart(spark, lake, "hedis"), "person_id", "had_hba1c_test") == [(person, 1)]
    # a later stay under the other id; the shift of dates is by patient, so its day is set by it
    shift = lambda p: int(hashlib.sha256(p.encode()).hexdigest(), 16) % 61 - 30
    day = dt.date(2023, 1, 20) + dt.timedelta(days=shift("a") - shift("b"))
    bronze.land(spark.createDataFrame([stay(4, "c", 2, "b", "I", str(day), str(day))], schema), lake, "stays", 0)
    run_day(spark, lake, "stays", DAY(2).date(), stay_settings("s"), codes, parts=2)
    assert rows(read_mart(spark, lake, "readmissions_30_day")) == [(person, 1, 1, 1.0)]
    assert sorted(rows(read_mart(spark, lake, "admission_count"))) == sorted([(person, 3), (token["x"], 1)])
    silver = live_rows(read_silver(spark, lake))
    assert {r["person_id"] for r in silver.collect()} == set(token.values())
    whole = gold.linked(spark, lake, silver, 2)
    assert rows(read_mart(spark, lake, "readmissions_30_day")) == rows(marts.readmission_30d(whole, unique_ids=True))
