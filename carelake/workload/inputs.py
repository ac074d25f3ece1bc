"""Clinical stand-ins made from the given tables, as lazy projections of whole tables.

The tables hold no nulls, change codes or personal numbers; these are derived from the
keys of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions import deid
from carelake.operators.linkage import LinkModel, LinkSettings
from carelake.plans.marts import DIABETES, HBA1C, INPATIENT_VISIT

SALT = "workload-salt"

# Key of a change that meets no row: beyond every key of the tables.
NEW_KEY_OFFSET = 10**12

# EM settles to this before six digits are compared; the SQL stops at the same tolerance.
EM_TOLERANCE = 1e-12

LINK = LinkSettings(unique_id="unique_id", block=("nation",), compare=("name", "segment", "balance"))
LINK_MODEL = LinkModel(
    m={"name": 0.9, "segment": 0.85, "balance": 0.8},
    u={"name": 0.001, "segment": 0.2, "balance": 0.0005},
    prior=0.01,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is an occurrence of its customer: urgent ones a diagnosis, others a stay."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"),
        F.col("o_orderkey").alias("condition_occurrence_id"),
        F.when(urgent, DIABETES).otherwise(INPATIENT_VISIT).alias("condition_concept_id"),
        order_day().alias("condition_start_date"),
        F.date_add(order_day(), (F.col("o_orderkey") % 7).cast("int")).alias("condition_end_date"),
    )


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A purchase is a test of its user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("person_id"),
        F.when(F.col("event_type") == "purchase", HBA1C).otherwise(0).alias("measurement_concept_id"),
        F.col("ts").cast("date").alias("measurement_date"),
        F.col("value").alias("value_as_number"),
    )


def flawed_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions with missing persons, ids and concepts, and negative concepts."""
    return flawed(table(spark, sf_dir, "orders"))


def flawed(orders: DataFrame) -> DataFrame:
    """The same of a table or a stream of orders."""
    key = F.col("o_orderkey")
    return orders.select(
        key.alias("row_key"),
        F.when(key % 70 != 0, key.cast("string")).alias("condition_occurrence_id"),
        F.when(key % 50 != 0, F.col("o_custkey").cast("string")).alias("person_id"),
        F.when(key % 30 == 0, -1).when(key % 11 != 0, 32020).alias("condition_concept_id"),
    )


def ssn(person: Column) -> Column:
    def digits(n: int) -> Column:
        return F.lpad((person % 10**n).cast("string"), n, "0")

    return F.concat_ws("-", digits(3), digits(2), digits(4))


def clinical_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    person = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("payload_id"),
        F.col("o_orderpriority").alias("source_system_id"),
        person.cast("string").alias("patient_id"),
        ssn(person).alias("patient_ssn"),
        F.concat(F.lit("MRN"), person.cast("string")).alias("patient_mrn"),
        F.col("o_orderdate").alias("admission_date"),
        F.concat(
            F.lit("Patient admitted. SSN: "), ssn(person), F.lit(". Seen as "),
            F.col("o_orderpriority"), F.lit("; repeat "), ssn(person), F.lit("."),
        ).alias("clinical_notes"),
    )


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change-log lines; every hundredth one is not JSON."""
    kind = F.col("event_type")
    op = F.when(kind == "signup", "c").when(kind.isin("click", "purchase"), "u").when(kind == "error", "d").otherwise("r")
    image = F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("person"), F.col("props"))
    payload = F.struct(
        F.when(kind == "error", image).alias("before"),
        F.when(kind != "error", image).alias("after"),
        F.struct(F.lit("events").alias("db")).alias("source"),
        op.alias("op"),
    )
    line = F.to_json(F.struct(payload.alias("payload")))
    broken = F.concat(F.lit("not json "), F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 100 == 0, broken).otherwise(line).alias("value")
    )


def resource_lines(events: DataFrame) -> DataFrame:
    """Events as JSON resources; works on a table and on a stream."""
    return events.select(F.to_json(F.struct(
        F.col("event_type").alias("resourceType"),
        F.col("event_id").cast("string").alias("id"),
        F.col("props").alias("payload"),
    )).alias("value"))


def event_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of events; every 25th day is not a date."""
    day = F.when(F.col("event_id") % 25 == 0, "unknown").otherwise(F.col("ts").cast("date").cast("string"))
    raw = F.concat(
        F.lit('{"user":'), F.col("user_id").cast("string"), F.lit(',"kind":"'), F.col("event_type"),
        F.lit('","day":"'), day, F.lit('","props":'), F.col("props"), F.lit("}"),
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("payload_id"), raw.alias("raw_payload_json")
    )


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("condition_occurrence_id"),
        F.col("o_custkey").alias("person_id"),
        F.lit(32020).alias("condition_concept_id"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.lit("c").alias("cdc_op"),
    )


def change_op(number: Column) -> Column:
    """All change codes in turn: create, update, delete, none, unknown."""
    return F.when(number % 5 == 0, "c").when(number % 5 == 1, "u").when(number % 5 == 2, "d").when(number % 5 == 4, "x")


def order_changes(orders: DataFrame) -> DataFrame:
    """One change per order: every seventh key is new, times are older, equal, newer or null."""
    key = F.col("o_orderkey")
    moved = F.date_add(order_day(), (key % 3).cast("int") - 1).cast("timestamp")
    return orders.select(
        F.when(key % 7 == 0, key + NEW_KEY_OFFSET).otherwise(key).alias("condition_occurrence_id"),
        F.col("o_custkey").alias("person_id"),
        F.lit(32021).alias("condition_concept_id"),
        F.when(key % 13 != 0, moved).alias("updated_at"),
        change_op(key).alias("cdc_op"),
    )


def repeated_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change in two versions, some of the same time."""
    first = order_changes(table(spark, sf_dir, "orders"))
    key = F.col("condition_occurrence_id")
    later = F.date_add(F.col("updated_at").cast("date"), (key % 2).cast("int")).cast("timestamp")
    second = first.select(
        key, "person_id", F.lit(32022).alias("condition_concept_id"), later.alias("updated_at"),
        change_op(F.floor(key / 5)).alias("cdc_op"),
    )
    return first.unionByName(second)


def original_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("unique_id"), F.col("c_nationkey").alias("nation"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def copied_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of every customer with misspelt, missing or changed values."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        (key + NEW_KEY_OFFSET).alias("unique_id"),
        F.col("c_nationkey").alias("nation"),
        F.when(key % 4 == 0, F.concat("c_name", F.lit("x"))).otherwise(F.col("c_name")).alias("name"),
        F.when(key % 3 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(key % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("balance"),
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return original_persons(spark, sf_dir).unionByName(copied_persons(spark, sf_dir))


def daily_payloads(spark: SparkSession, sf_dir: str, day: int, later: int = 0, corrected: bool = False) -> DataFrame:
    """What the orders are as landed changes on one of two days.

    Day 1 creates every order, some without a record number unless `corrected`. Day 2
    deletes every fourth order by its key alone and moves another fourth by a week.
    `later` moves all admissions by so many days.
    """
    key, person = F.col("o_orderkey"), F.col("o_custkey")
    orders = table(spark, sf_dir, "orders")
    if day == 2:
        orders = orders.filter(key % 4 < 2)
    whole = key % 4 != 0 if day == 2 else F.lit(True)
    numbered = whole if corrected or day == 2 else key % 50 != 0
    at = f"2024-01-0{day} 08:00:00"
    record = F.struct(
        F.when(whole, person.cast("string")).alias("patient_id"),
        F.when(whole, ssn(person)).alias("patient_ssn"),
        F.when(numbered, F.concat(F.lit("MRN"), person.cast("string"))).alias("patient_mrn"),
        F.when(whole, F.date_add(order_day(), later + 7 * (day - 1)).cast("string")).alias("admission_date"),
        F.when(whole, F.concat(F.lit("SSN "), ssn(person))).alias("clinical_notes"),
        (F.lit("c") if day == 1 else F.when(whole, "u").otherwise("d")).alias("cdc_op"),
        F.lit(at).alias("updated_at"),
    )
    return orders.select(
        key.cast("string").alias("payload_id"),
        F.lit("ORDERS").alias("source_system_id"),
        F.to_json(record).alias("raw_payload_json"),
        F.lit(at).cast("timestamp").alias("ingestion_timestamp"),
    )


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw clinical JSON in Bronze; some lack the record number."""
    person = F.col("o_custkey")
    record = F.struct(
        person.cast("string").alias("patient_id"),
        ssn(person).alias("patient_ssn"),
        F.when(F.col("o_orderkey") % 50 != 0, F.concat(F.lit("MRN"), person.cast("string"))).alias("patient_mrn"),
        order_day().cast("string").alias("admission_date"),
        F.concat(F.lit("SSN "), ssn(person)).alias("clinical_notes"),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("payload_id"),
        F.lit("ORDERS").alias("source_system_id"),
        F.to_json(record).alias("raw_payload_json"),
        F.lit("2024-01-01").cast("timestamp").alias("ingestion_timestamp"),
    )


def _change_time(day: int) -> str:
    return f"2024-01-0{day} 08:00:00"


def _landed_payload(rows: DataFrame, key: Column, system: str, record: Column, at: str) -> DataFrame:
    return rows.select(
        key.cast("string").alias("payload_id"), F.lit(system).alias("source_system_id"),
        F.to_json(record).alias("raw_payload_json"), F.lit(at).cast("timestamp").alias("ingestion_timestamp"),
    )


def stay_payloads(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Orders as stays with diagnosis and discharge, landed as changes on one of three days.

    Day 1 creates all. Day 2 deletes every fourth by its key alone and moves another fourth
    by a week. Day 3 finds that every eighth was another patient's, the next one's.
    """
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").filter([F.lit(True), key % 4 < 2, key % 8 == 2][day - 1])
    whole = key % 4 != 0 if day == 2 else F.lit(True)
    patient = F.col("o_custkey") + (1 if day == 3 else 0)
    admitted = F.date_add(order_day(), 7 if day == 2 else 0)
    at = _change_time(day)
    record = F.struct(
        F.when(whole, patient.cast("string")).alias("patient_id"),
        F.when(whole, F.concat(F.lit("MRN"), patient.cast("string"))).alias("patient_mrn"),
        F.when(whole, F.col("o_orderpriority")).alias("diagnosis_code"),
        F.when(whole, admitted.cast("string")).alias("admission_date"),
        F.when(whole, F.date_add(admitted, (key % 7).cast("int")).cast("string")).alias("discharge_date"),
        (F.lit("c") if day == 1 else F.when(whole, "u").otherwise("d")).alias("cdc_op"),
        F.lit(at).alias("updated_at"),
    )
    return _landed_payload(orders, key, "ORDERS", record, at)


def lab_payloads(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Events as tests of their users: day 1 creates all, day 3 deletes every tenth by its key alone."""
    key = F.col("event_id")
    events = table(spark, sf_dir, "events")
    if day == 3:
        events = events.filter(key % 10 == 0)
    whole = F.lit(day == 1)
    at = _change_time(day)
    record = F.struct(
        F.when(whole, F.col("user_id").cast("string")).alias("patient_id"),
        F.when(whole, F.concat(F.lit("MRN"), F.col("user_id").cast("string"))).alias("patient_mrn"),
        F.when(whole, F.col("event_type")).alias("test_code"),
        F.when(whole, F.col("ts").cast("date").cast("string")).alias("taken_on"),
        F.when(whole, F.col("value")).alias("result"),
        F.lit("c" if day == 1 else "d").alias("cdc_op"),
        F.lit(at).alias("updated_at"),
    )
    return _landed_payload(events, key, "LAB", record, at)


def diagnosis_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The priorities of orders as diagnosis codes."""
    code = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(code.alias("source_code")).distinct().withColumn(
        "concept_id", F.when(F.col("source_code") == "1-URGENT", DIABETES).otherwise(INPATIENT_VISIT))


def lab_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of events as test codes, of which purchases are the test of the mart."""
    return table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(
        F.col("event_type").alias("source_code"), F.lit(HBA1C).alias("concept_id")).distinct()


LINKED = LinkSettings(unique_id="token", block=("born",), compare=("name", "city"))
LINKED_MODEL = LinkModel(m={"name": 0.95, "city": 0.9}, u={"name": 0.001, "city": 0.2}, prior=0.01)


def person_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as person records of which two neighbours each, 2n and 2n + 1, are one person."""
    key = F.col("c_custkey")
    first = key - key % 2
    return table(spark, sf_dir, "customer").select(
        key.alias("customer"), deid.token(F.concat(F.lit("MRN"), key.cast("string")), SALT).alias("token"),
        F.date_add(F.lit("1950-01-01").cast("date"), (first % 20_000).cast("int")).alias("born"),
        F.concat(F.lit("person "), first.cast("string")).alias("name"), (first % 5).alias("city"),
    )
