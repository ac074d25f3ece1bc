"""De-identification against the definitions in plain Python."""

import datetime as dt
import hashlib

import pytest
from conftest import plan, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carelake.functions import deid
from carelake.operators.deidentify import CLINICAL_POLICY, DeidPolicy, deidentify
from carelake.schemas import CLINICAL_RECORD, MissingColumns

SALT = "test_salt_123"


def token_of(value, salt=SALT):
    return f"DEID-{hashlib.sha256((value + salt).encode()).hexdigest()}" if value else None


def shift_of(person):
    return int(hashlib.sha256(person.encode()).hexdigest(), 16) % 61 - 30 if person else None


def records(spark):
    return spark.createDataFrame([
        ("K-17", "404-11-2020", "R5501", dt.datetime(2021, 3, 9), "Broken wrist, number 404-11-2020 on the form."),
        ("K-18", "505-22-3131", "R5502", dt.datetime(2022, 11, 30), "Cast removed, moves well."),
    ], CLINICAL_RECORD)


def test_clinical_policy(spark):
    got = deidentify(records(spark), CLINICAL_POLICY, SALT, drop_source=False)
    assert got.columns == [
        "patient_id", "clinical_notes", "patient_ssn_deid", "patient_mrn_deid",
        "admission_date_shifted", "clinical_notes_redacted",
    ]
    assert rows(got.drop("clinical_notes")) == [
        ("K-17", token_of("404-11-2020"), token_of("R5501"), dt.date(2021, 3, 9) + dt.timedelta(days=shift_of("K-17")),
         "Broken wrist, number [REDACTED_SSN] on the form."),
        ("K-18", token_of("505-22-3131"), token_of("R5502"), dt.date(2022, 11, 30) + dt.timedelta(days=shift_of("K-18")),
         "Cast removed, moves well."),
    ]


def test_sources_are_dropped_by_default(spark):
    got = deidentify(records(spark), CLINICAL_POLICY, SALT)
    assert got.columns == [
        "patient_ssn_deid", "patient_mrn_deid", "admission_date_shifted", "clinical_notes_redacted",
    ]


def test_missing_columns(spark):
    part = records(spark).drop("clinical_notes", "patient_ssn")
    with pytest.raises(MissingColumns):
        deidentify(part, CLINICAL_POLICY, SALT)
    got = deidentify(part, CLINICAL_POLICY, SALT, strict=False, drop_source=False)
    assert got.columns == ["patient_id", "patient_mrn_deid", "admission_date_shifted"]


def test_edges(spark):
    df = spark.createDataFrame(
        [(None, None, None), ("", "", "1123-45-67899"), ("x", "y", "a 1-2 b")],
        "value string, person string, note string",
    )
    day = F.lit("2023-01-01 23:59:59").cast("timestamp")
    got = df.select(
        deid.token(F.col("value"), SALT), deid.shifted_date(day, F.col("person")), deid.redacted(F.col("note"))
    )
    shifted = dt.date(2023, 1, 1) + dt.timedelta(days=shift_of("y"))
    assert rows(got) == [
        (token_of("x"), shifted, "a 1-2 b"), (None, None, "1[REDACTED_SSN]9"), (None, None, None),
    ]


def test_a_salt_is_required_and_tokens_can_be_longer(spark):
    with pytest.raises(ValueError):
        deid.token(F.lit("x"), "")
    policy = DeidPolicy(tokens={"patient_mrn": "m"}, token_hex_digits=32)
    got = deidentify(records(spark), policy, SALT).select("m").first()[0]
    assert got == "DEID-" + hashlib.sha256(f"R5501{SALT}".encode()).hexdigest()[:32]


def test_numbers_are_taken_as_text(spark):
    got = spark.range(5).select("id", deid.token(F.col("id"), SALT), deid.shift_days(F.col("id")))
    assert rows(got) == [(i, token_of(str(i)), shift_of(str(i))) for i in range(5)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=12), min_size=1, max_size=200))
def test_any_text_equals_the_definition(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", deid.token(F.col("v"), SALT), deid.shift_days(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [(v, token_of(v), shift_of(v)) for v in values]


def test_ages_are_top_coded(spark):
    got = spark.createDataFrame([(89,), (90,), (104,), (None,)], "age int").select(deid.top_coded_age(F.col("age")))
    assert rows(got) == [(89,), (90,), (90,), (None,)]


def test_no_python_worker_and_no_shuffle(spark, tmp_path):
    path = str(tmp_path / "records")
    records(spark).write.parquet(path)
    text = plan(deidentify(spark.read.parquet(path), CLINICAL_POLICY, SALT))
    assert "Python" not in text and "Exchange" not in text
