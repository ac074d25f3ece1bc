"""The whole chain, in memory and through the zones."""

import datetime as dt
import hashlib
import json

import pytest
from conftest import rows
from pyspark.sql import types as T

from carelake.operators.deidentify import DeidPolicy
from carelake.operators.quality import QualityBreach
from carelake.operators.merge import live_rows
from carelake.plans.chain import ChainSettings, chain, read_mart, read_silver, run_day
from carelake.sources import bronze

SALT = "chain_salt"
RECORD = T.StructType([
    *[T.StructField(n, T.StringType()) for n in ("note_no", "who", "policy", "came_on")],
])
SETTINGS = ChainSettings(
    salt=SALT, record=RECORD, policy=DeidPolicy(tokens={"policy": "policy_deid"}),
    columns={
        "condition_occurrence_id": "note_no", "person_id": "who", "condition_start_date": "came_on",
        "condition_source_value": "policy_deid",
    },
)
MESSAGES = [
    '{"note_no":"n-31","who":"ida","policy":"K 4-77","came_on":"2021-05-04"}',
    '{"note_no":"n-32","who":"ida","policy":"K 4-77","came_on":"2021-05-20"}',
    '{"note_no":"n-33","policy":"K 9-02","came_on":"2021-05-21"}',
    '{"note_no":"n-34","who":"otto","came_on":"2021-05-05"}',
]
TOKEN = "DEID-" + hashlib.sha256(f"K 4-77{SALT}".encode()).hexdigest()
AT = dt.datetime(2024, 1, 1, 6)
MESSAGE_IDS = "messages/EDI_X12_BATCH/"


def test_lazy_chain(spark):
    raw = bronze.land_text(spark.createDataFrame([(m,) for m in MESSAGES], "value string"), at=AT)
    run = chain(raw, SETTINGS)
    assert rows(run.valid, "condition_occurrence_id", "condition_source_value") == [
        ("n-31", TOKEN), ("n-32", TOKEN), ("n-34", None),
    ]
    assert rows(run.dead_letters, "condition_occurrence_id") == [("n-33",)]
    assert rows(run.readmissions) == [("ida", 1, 1, 1.0)]
    assert "policy" not in run.conditions.columns and "raw_payload_json" not in run.conditions.columns
    again = chain(raw, SETTINGS, target=run.silver)
    assert rows(again.silver) == rows(run.silver)


def daily(spark, tmp_path, at, settings=SETTINGS):
    lake = str(tmp_path / "lake")
    bronze.land(bronze.land_text(bronze.text_lines(spark, str(tmp_path / "in")), at=at), lake, "messages", batch=0)
    return run_day(spark, lake, "messages", at.date(), settings, parts=4)


def test_daily_run_is_replay_safe(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.txt").write_text("\n".join(MESSAGES) + "\n")
    lake = str(tmp_path / "lake")
    for _ in range(2):
        measured = daily(spark, tmp_path, AT)
        assert (measured["size"], measured["complete(person_id)"]) == (4, 1)
        assert spark.read.parquet(f"{lake}/bronze").count() == 4
        assert rows(spark.read.parquet(f"{lake}/dead_letters"), "condition_occurrence_id") == [(f"{MESSAGE_IDS}n-33",)]
        assert rows(read_silver(spark, lake), "condition_occurrence_id") == [
            (f"{MESSAGE_IDS}n-31",), (f"{MESSAGE_IDS}n-32",), (f"{MESSAGE_IDS}n-34",),
        ]
        assert rows(read_mart(spark, lake, "readmissions_30_day")) == [("ida", 1, 1, 1.0)]
    (inbox / "a.txt").write_text('{"note_no":"n-35","who":"ida","came_on":"2021-05-29"}\n')
    daily(spark, tmp_path, AT + dt.timedelta(days=1))
    assert spark.read.parquet(f"{lake}/bronze").count() == 5
    assert rows(read_mart(spark, lake, "readmissions_30_day")) == [("ida", 2, 2, 1.0)]
    assert rows(read_mart(spark, lake, "admission_count")) == [("ida", 3), ("otto", 1)]


def change(op, at, before=None, after=None):
    images = {k: v for k, v in (("before", before), ("after", after)) if v}
    return json.dumps({"payload": {**images, "source": {"db": "pg"}, "op": op, "at": at}})


CHANGE_SETTINGS = ChainSettings(
    salt=SALT,
    record=T.StructType([
        *[T.StructField(n, T.StringType()) for n in ("mrn", "who", "came_on", "cdc_op")],
        T.StructField("updated_at", T.TimestampType()),
    ]),
    paths={
        **{n: (f"payload.after.{n}", f"payload.before.{n}") for n in ("mrn", "who", "came_on")},
        "cdc_op": "payload.op", "updated_at": "payload.at",
    },
    policy=DeidPolicy(tokens={"mrn": "person"}, shifts={"admitted": ("came_on", "who")}),
    columns={
        "condition_occurrence_id": "payload_id", "person_id": "person", "condition_start_date": "admitted",
        "condition_source_value": "source_system_id",
    },
)


def test_changes_of_two_days_reach_silver(spark, tmp_path):
    lake = str(tmp_path / "lake")
    row = lambda i, day: {"id": i, "mrn": "M1", "who": "P1", "came_on": day}
    days = [
        [change("c", "2024-01-01 08:00:00", after=row("a", "2023-01-01")),
         change("c", "2024-01-01 08:00:00", after=row("b", "2023-01-10")),
         change("c", "2024-01-01 08:00:00", after=row("c", "2023-06-01")),
         change("r", "2024-01-01 08:00:00", after=row("snapshot", "2023-06-01")), "broken"],
        [change("u", "2024-01-02 08:00:00", before=row("c", "2023-06-01"), after=row("c", "2023-01-20")),
         change("d", "2024-01-02 08:00:00", before=row("b", "2023-01-10"))],
    ]
    ids = lambda names: [(f"changes/pg/{n}",) for n in names]
    expected = [(ids("abc"), (1, 1)), (ids("ac"), (1, 1))]
    live = lambda: live_rows(read_silver(spark, lake))
    for number, (lines, (left, totals)) in enumerate(zip(days, expected)):
        at = AT + dt.timedelta(days=number)
        landed = bronze.cdc_extract(spark.createDataFrame([(v,) for v in lines], "value string"), at=at)
        bronze.land(landed, lake, "changes", batch=0)
        assert run_day(spark, lake, "changes", at.date(), CHANGE_SETTINGS, parts=4)["size"] == len(lines) - 2 * (number == 0)
        assert rows(live(), "condition_occurrence_id") == left
        gold = read_mart(spark, lake, "readmissions_30_day")
        assert rows(gold, "total_index_admissions", "total_30_day_readmissions") == [totals]
    # the first day again revives nothing
    run_day(spark, lake, "changes", AT.date(), CHANGE_SETTINGS, parts=4)
    assert rows(live(), "condition_occurrence_id") == ids("ac")


def test_a_delete_needs_its_key_only(spark, tmp_path):
    lake = str(tmp_path / "lake")
    row = {"id": "a", "mrn": "M1", "who": "P1", "came_on": "2023-01-01"}
    for number, line in enumerate([change("c", "2024-01-01 08:00:00", after=row), change("d", "2024-01-02 08:00:00", before={"id": "a"})]):
        at = AT + dt.timedelta(days=number)
        landed = bronze.cdc_extract(spark.createDataFrame([(line,)], "value string"), at=at)
        bronze.land(landed, lake, "changes", batch=0)
        run_day(spark, lake, "changes", at.date(), CHANGE_SETTINGS, parts=4)
    assert rows(live_rows(read_silver(spark, lake))) == []
    assert spark.read.parquet(f"{lake}/dead_letters").count() == 0


def test_a_corrected_row_leaves_the_dead_letters(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    dead = lambda: spark.read.parquet(f"{tmp_path}/lake/dead_letters").count()
    (inbox / "a.txt").write_text(MESSAGES[2] + "\n")
    daily(spark, tmp_path, AT)
    assert dead() == 1
    (inbox / "a.txt").write_text(MESSAGES[2].replace('"policy"', '"who":"uma","policy"') + "\n")
    daily(spark, tmp_path, AT)
    assert dead() == 0


def test_files_under_their_own_numbers_stay(spark, tmp_path):
    lake = str(tmp_path / "lake")
    for number, line in enumerate("ab"):
        bronze.land(bronze.land_text(spark.createDataFrame([(line,)], "value string"), at=AT), lake, "one", batch=number)
    assert rows(spark.read.parquet(f"{lake}/bronze"), "raw_payload_json") == [("a",), ("b",)]


def test_feeds_do_not_replace_each_other(spark, tmp_path):
    lake = str(tmp_path / "lake")
    lines = spark.createDataFrame([("x",)], "value string")
    for feed in ("one", "two", "one"):
        bronze.land(bronze.land_text(lines, at=AT), lake, feed, batch=0)
    assert rows(spark.read.parquet(f"{lake}/bronze"), "feed") == [("one",), ("two",)]


def test_the_circuit_breaks_before_the_merge(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(MESSAGES) + "\n")
    strict = ChainSettings(**{**SETTINGS.__dict__, "on_fail": "raise"})
    with pytest.raises(QualityBreach):
        daily(spark, tmp_path, AT, strict)
    assert read_silver(spark, str(tmp_path / "lake")) is None


def test_a_vocabulary_sets_the_concept(spark):
    raw = bronze.land_text(spark.createDataFrame([(m,) for m in MESSAGES], "value string"), at=AT)
    vocabulary = spark.createDataFrame([(TOKEN, 9201)], "source_code string, concept_id int")
    got = chain(raw, SETTINGS, vocabulary=vocabulary)
    assert rows(got.valid, "condition_concept_id") == [(0,), (9201,), (9201,)]


def test_feeds_with_equal_ids_keep_their_rows(spark, tmp_path):
    lake = str(tmp_path / "lake")
    for feed, came in (("north", "2021-05-04"), ("south", "2021-06-11")):
        line = change("c", "2024-01-01 08:00:00", after={"id": "a", "mrn": "M1", "who": "P1", "came_on": came})
        landed = bronze.cdc_extract(spark.createDataFrame([(line,)], "value string"), at=AT)
        bronze.land(landed, lake, feed, batch=0)
        run_day(spark, lake, feed, AT.date(), CHANGE_SETTINGS, parts=4)
    assert rows(live_rows(read_silver(spark, lake)), "condition_occurrence_id") == [
        ("north/pg/a",), ("south/pg/a",),
    ]
    with pytest.raises(ValueError, match="feed"):
        run_day(spark, lake, "a/b", AT.date(), CHANGE_SETTINGS)
