"""Mapping, vocabulary lookup and masks."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carelake.operators import masking, silver
from carelake.schemas import CONDITION_OCCURRENCE

PERSONS = [
    ("a7", "Ida", "1981-07-30", "Graz"), ("a8", "Otto", "1962-02-11", "Linz"), ("a9", None, "1962-02-11", "Linz"),
]
COLUMNS = {
    "condition_occurrence_id": "unique_id", "person_id": "unique_id", "condition_start_date": "dob",
    "condition_start_datetime": "dob", "condition_source_value": "city",
}


def persons(spark):
    return spark.createDataFrame(PERSONS, "unique_id string, name string, dob string, city string")


def test_twelve_columns(spark):
    mapped = silver.condition_map(persons(spark), COLUMNS)
    assert mapped.schema.fieldNames() == CONDITION_OCCURRENCE.fieldNames()
    assert [f.dataType for f in mapped.schema] == [f.dataType for f in CONDITION_OCCURRENCE]
    assert rows(mapped)[0] == (
        "a7", "a7", 0, dt.date(1981, 7, 30), dt.datetime(1981, 7, 30), None, None, 32020, "Graz", 0, None, 0,
    )


def test_change_columns_and_a_discharge_are_carried(spark):
    df = persons(spark).withColumns({
        "left_on": F.lit("1981-08-02"), "updated_at": F.lit("2023-01-01 10:00:00"), "cdc_op": F.lit("u"),
    })
    mapped = silver.condition_map(df, {**COLUMNS, "condition_end_date": "left_on"})
    assert rows(mapped, "condition_end_date", "updated_at", "cdc_op")[0] == (
        dt.date(1981, 8, 2), dt.datetime(2023, 1, 1, 10), "u",
    )


def test_lookup_never_multiplies_rows(spark):
    mapped = silver.condition_map(persons(spark), COLUMNS)
    vocabulary = spark.createDataFrame([("Linz", 7), ("Linz", 7), (None, 5), ("Wien", 1), ("Wien", 2)], "source_code string, concept_id int")
    got = silver.concept_lookup(mapped, vocabulary)
    assert got.columns == mapped.columns
    assert rows(got, "condition_occurrence_id", "condition_concept_id") == [("a7", 0), ("a8", 7), ("a9", 7)]
    unknown = mapped.withColumn("condition_source_value", F.lit(None).cast("string"))
    assert set(rows(silver.concept_lookup(unknown, vocabulary), "condition_concept_id")) == {(0,)}


def test_a_code_of_two_vocabularies(spark):
    mapped = silver.condition_map(persons(spark), COLUMNS).withColumn("system", F.lit("towns"))
    vocabulary = spark.createDataFrame(
        [("Linz", 7, "towns"), ("Linz", 9, "ships"), ("Graz", 3, None)], "source_code string, concept_id int, kind string"
    )
    got = silver.concept_lookup(mapped, vocabulary, on={"system": "kind"})
    assert rows(got, "condition_occurrence_id", "condition_concept_id") == [("a7", 0), ("a8", 7), ("a9", 7)]
    with pytest.raises(Exception, match="more than one concept for code Linz"):
        silver.concept_lookup(mapped, vocabulary).collect()


def sensitive(spark):
    return spark.createDataFrame([("P1", "123-45-6789", "M1", 3)], "person_id string, ssn string, mrn string, n int")


def test_masks_deny_by_default(spark):
    clear, hidden = ("P1", "123-45-6789", "M1", 3), ("REDACTED", "***-**-****", "REDACTED_MRN", 3)
    for role, expected in [("data_engineer", clear), ("DATA_ANALYST", hidden), ("other", hidden), (None, hidden)]:
        assert rows(masking.mask_for(sensitive(spark), role)) == [expected]


def test_masked_view_follows_the_session_role(spark):
    sensitive(spark).createOrReplaceTempView("patients")
    masking.set_role(spark, "DATA_ANALYST")
    masking.create_masked_view(spark, "patients", "patients_masked")
    seen = []
    for role in ("DATA_ANALYST", "DATA_ENGINEER", None):
        masking.set_role(spark, role)
        seen.append(rows(spark.table("patients_masked"), "person_id", "mrn"))
    assert seen == [[("REDACTED", "REDACTED_MRN")], [("P1", "M1")], [("REDACTED", "REDACTED_MRN")]]
