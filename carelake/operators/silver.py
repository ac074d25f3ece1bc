"""Mapping of de-identified records to the condition table of the common data model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.schemas import CHANGE_COLUMNS, CONDITION_OCCURRENCE, MEASUREMENT_OCCURRENCE, require_columns

# Fixed values of the vocabulary.
UNMAPPED_CONCEPT = 0
EHR_CONDITION_TYPE = 32020

# Columns of the condition table and the record columns they are read from.
RECORD_COLUMNS = {
    "condition_occurrence_id": "payload_id",
    "person_id": "patient_mrn_deid",
    "condition_start_date": "admission_date_shifted",
    "condition_start_datetime": "admission_date_shifted",
    "condition_source_value": "source_system_id",
}
# The same for a stay with its diagnosis and discharge.
STAY_COLUMNS = {
    **RECORD_COLUMNS,
    "condition_end_date": "discharge_date_shifted",
    "condition_end_datetime": "discharge_date_shifted",
    "condition_source_value": "diagnosis_code",
}
# The same for a test.
MEASUREMENT_COLUMNS = {
    "measurement_id": "payload_id",
    "person_id": "patient_mrn_deid",
    "measurement_date": "taken_on_shifted",
    "value_as_number": "result",
    "measurement_source_value": "test_code",
}
CONSTANTS = {
    "measurement_concept_id": UNMAPPED_CONCEPT,
    "condition_concept_id": UNMAPPED_CONCEPT,
    "condition_type_concept_id": EHR_CONDITION_TYPE,
    "condition_source_concept_id": UNMAPPED_CONCEPT,
    "condition_status_concept_id": UNMAPPED_CONCEPT,
}


def condition_map(
    records: DataFrame, columns: Mapping[str, str] = RECORD_COLUMNS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The twelve condition columns, plus change columns and `carry` where present.

    `columns` may name a record column for any of the twelve, for example a
    discharge date for `condition_end_date`; the others are constant or null.
    """
    return _mapped(records, CONDITION_OCCURRENCE, columns, carry, "condition_map")


def measurement_map(
    records: DataFrame, columns: Mapping[str, str] = MEASUREMENT_COLUMNS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The measurement columns, plus change columns and `carry` where present."""
    return _mapped(records, MEASUREMENT_OCCURRENCE, columns, carry, "measurement_map")


def _mapped(
    records: DataFrame, schema: T.StructType, columns: Mapping[str, str], carry: tuple[str, ...], operator: str
) -> DataFrame:
    require_columns(records, [*columns.values(), *carry], operator)

    def source(name: str) -> Column:
        if name in columns:
            return F.col(columns[name])
        return F.lit(CONSTANTS.get(name))

    mapped = [source(f.name).cast(f.dataType).alias(f.name) for f in schema]
    changes = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        for f in CHANGE_COLUMNS if f.name in records.columns
    ]
    return records.select(*mapped, *changes, *carry)


def concept_lookup(
    df: DataFrame, vocabulary: DataFrame, code: str = "condition_source_value",
    concept: str = "condition_concept_id", vocabulary_code: str = "source_code",
    vocabulary_concept: str = "concept_id", on: Mapping[str, str] | None = None,
) -> DataFrame:
    """Set `concept` to the vocabulary's id of `code`; an unknown or null code gives 0.

    `on` names further columns that must agree, as column of `df` -> column of the
    vocabulary: one code may stand for different things in different vocabularies. A
    code that a row uses and that has two concepts all the same fails the job. The
    vocabulary is cut to one id per code first, so rows are never multiplied.
    No broadcast is forced: Spark takes one where the size it knows allows that, and
    otherwise splits the partitions of a frequent code while it runs.
    """
    keys = {code: vocabulary_code, **(on or {})}
    require_columns(df, list(keys), "concept_lookup")
    require_columns(vocabulary, [*keys.values(), vocabulary_concept], "concept_lookup vocabulary")
    number = F.col(vocabulary_concept).cast("int")
    ids = (
        vocabulary.dropna(subset=list(keys.values()))
        .groupBy(*[F.col(v).alias(f"_key{i}") for i, v in enumerate(keys.values())])
        .agg(F.min(number).alias("_concept"), F.max(number).alias("_other"))
    )
    joined = df.join(ids, [df[c] == ids[f"_key{i}"] for i, c in enumerate(keys)], "left")
    message = F.concat(F.lit("concept_lookup: more than one concept for code "), df[code].cast("string"))
    single = F.when(F.col("_concept") < F.col("_other"), F.raise_error(message).cast("int")).otherwise(F.col("_concept"))
    found = F.coalesce(single, F.lit(UNMAPPED_CONCEPT)).alias(concept)
    if concept in df.columns:
        return joined.select(*[found if c == concept else df[c] for c in df.columns])
    return joined.select(*[df[c] for c in df.columns], found)
