"""Table contracts of the three zones, and the checks operators make on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BRONZE_PAYLOADS = T.StructType([
    T.StructField("payload_id", T.StringType()),
    T.StructField("source_system_id", T.StringType()),
    T.StructField("raw_payload_json", T.StringType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
])

_STRING_MAP = T.MapType(T.StringType(), T.StringType())
CHANGE_ENVELOPE = T.StructType([
    T.StructField("payload", T.StructType([
        T.StructField("before", _STRING_MAP),
        T.StructField("after", _STRING_MAP),
        T.StructField("source", _STRING_MAP),
        T.StructField("op", T.StringType()),
    ])),
])

# The change code alone: from_json builds every nested field that is declared, so
# looking for the code with this schema is cheaper than with the whole envelope.
CHANGE_CODE = T.StructType([
    T.StructField("payload", T.StructType([T.StructField("op", T.StringType())])),
])

RESOURCE_ENVELOPE = T.StructType([
    T.StructField("resourceType", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("payload", T.StringType()),
])

CLINICAL_RECORD = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("patient_ssn", T.StringType()),
    T.StructField("patient_mrn", T.StringType()),
    T.StructField("admission_date", T.TimestampType()),
    T.StructField("clinical_notes", T.StringType()),
])

# A stay with its diagnosis, and a test, as they arrive.
STAY_RECORD = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("patient_mrn", T.StringType()),
    T.StructField("diagnosis_code", T.StringType()),
    T.StructField("admission_date", T.TimestampType()),
    T.StructField("discharge_date", T.TimestampType()),
])
TEST_RECORD = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("patient_mrn", T.StringType()),
    T.StructField("test_code", T.StringType()),
    T.StructField("taken_on", T.TimestampType()),
    T.StructField("result", T.DoubleType()),
])

CONDITION_OCCURRENCE = T.StructType([
    T.StructField("condition_occurrence_id", T.StringType()),
    T.StructField("person_id", T.StringType()),
    T.StructField("condition_concept_id", T.IntegerType()),
    T.StructField("condition_start_date", T.DateType()),
    T.StructField("condition_start_datetime", T.TimestampType()),
    T.StructField("condition_end_date", T.DateType()),
    T.StructField("condition_end_datetime", T.TimestampType()),
    T.StructField("condition_type_concept_id", T.IntegerType()),
    T.StructField("condition_source_value", T.StringType()),
    T.StructField("condition_source_concept_id", T.IntegerType()),
    T.StructField("condition_status_source_value", T.StringType()),
    T.StructField("condition_status_concept_id", T.IntegerType()),
])

CHANGE_COLUMNS = T.StructType([
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("cdc_op", T.StringType()),
])

MEASUREMENT = T.StructType([
    T.StructField("person_id", T.StringType()),
    T.StructField("measurement_concept_id", T.IntegerType()),
    T.StructField("measurement_date", T.DateType()),
    T.StructField("value_as_number", T.DoubleType()),
])

# A test with its id and source code, as the daily run keeps it.
MEASUREMENT_OCCURRENCE = T.StructType([
    T.StructField("measurement_id", T.StringType()), *MEASUREMENT,
    T.StructField("measurement_source_value", T.StringType()),
])


class MissingColumns(ValueError):
    """An operator was given a table that lacks columns of its contract."""


def require_columns(df: DataFrame, columns: Iterable[str], operator: str) -> None:
    """Fail while the plan is built, instead of passing data through unchanged."""
    missing = [c for c in dict.fromkeys(columns) if c not in df.columns]
    if missing:
        raise MissingColumns(f"{operator}: missing columns {missing}; got {df.columns}")


def conform(df: DataFrame, schema: T.StructType, operator: str = "conform") -> DataFrame:
    """Exactly the columns of `schema`, in its order and with its types."""
    require_columns(df, schema.fieldNames(), operator)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
