"""One query per operator. Each takes (spark, sf_dir) and gives a lazy result."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions import deid
from carelake.operators import linkage, masking, merge, quality, silver
from carelake.operators.deidentify import CLINICAL_POLICY, DeidPolicy, deidentify
from carelake.plans import marts
from carelake.plans.chain import (
    Chain, ChainSettings, chain, lab_settings, read_mart, read_silver, run_day, run_measurements, run_persons,
    stay_settings,
)
from carelake.schemas import CHANGE_COLUMNS, CLINICAL_RECORD
from carelake.session import materialize, workspace
from carelake.sources import bronze, streams, tables
from carelake.sources.parts import read_parts
from carelake.streaming import sinks
from carelake.workload import inputs
from carelake.workload.inputs import LINK, LINK_MODEL, SALT, table

Query = Callable[[SparkSession, str], DataFrame]

INGESTED = datetime(2024, 1, 1)
ROUND = 9
# Hash parts of the lakes here; their tables are small.
LAKE_PARTS = 16

# Patterns the document query redacts besides the default one.
# A run of letters without an @ is looked at once: a match begins where a run or the last match ends.
EMAIL_RULE = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[REDACTED_EMAIL]")
PHONE_RULE = (r"\d{3}-\d{3}-\d{4}", "[REDACTED_PHONE]")

FLAT_RECORD = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("k", T.IntegerType()),
])


def land_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(
        F.col("text").alias("value"), F.col("source").alias("origin")
    )
    return bronze.land_text(lines, source="DOCUMENTS", at=INGESTED).drop("ingestion_timestamp")


def land_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as text files, landed twice: how many rows and ids each line has."""
    out = workspace(spark, "lines")
    table(spark, sf_dir, "documents").select(F.regexp_replace("text", r"\r", " ").alias("value")).write.text(f"{out}/in")
    for _ in range(2):
        bronze.land(bronze.land_text(bronze.text_lines(spark, f"{out}/in"), at=INGESTED), out, "claims", batch=0)
    return bronze.landed(spark, out).groupBy(F.col("raw_payload_json").alias("line")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("payload_id").alias("n_ids"))


def cdc_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.cdc_extract(inputs.change_lines(spark, sf_dir)).drop("ingestion_timestamp")


def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.cdc_rejects(inputs.change_lines(spark, sf_dir))


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files. The file source takes a pattern, not one file."""
    schema = table(spark, sf_dir, name).schema
    return streams.file_rows(spark, f"{sf_dir}/{name}*.parquet", schema)


def stream_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _stream(spark, sf_dir, "events")
    resources = bronze.stream_extract(inputs.resource_lines(events)).drop("ingestion_timestamp")
    out = workspace(spark, "stream-extract")
    sinks.start_append(resources, f"{out}/rows", f"{out}/checkpoint", trigger=None).awaitTermination()
    return spark.read.schema(resources.schema).parquet(f"{out}/rows")


def flatten_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.flatten_payload(
        inputs.event_bronze(spark, sf_dir), FLAT_RECORD, {"patient_id": "user", "k": "props.k"}
    )


def deid_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", deid.token(F.col("c_name"), SALT, hex_digits=10).alias("c_name_deid")
    )


def deid_dateshift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", deid.shifted_date(F.col("o_orderdate"), F.col("o_custkey")).alias("o_orderdate_shifted")
    )


def redact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.clinical_records(spark, sf_dir).select(
        "payload_id", deid.redacted(F.col("clinical_notes")).alias("clinical_notes_redacted")
    )


def redact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = (deid.SSN_RULE, EMAIL_RULE, PHONE_RULE)
    return table(spark, sf_dir, "documents").select(
        "doc_id", deid.redacted(F.col("text"), rules).alias("text_redacted")
    )


def deid_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deidentify(inputs.clinical_records(spark, sf_dir), CLINICAL_POLICY, SALT, drop_source=False)


def deid_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salted shift, top-coded age, and a name that is dropped."""
    people = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("patient_id"), F.col("o_orderstatus").alias("name"),
        (F.col("o_custkey") % 110).alias("age"), F.col("o_orderdate").alias("admitted"),
    )
    policy = DeidPolicy(
        shifts={"admitted_shifted": ("admitted", "patient_id")}, ages={"age": "age_coded"},
        drop=("name",), salted_shifts=True,
    )
    return deidentify(people, policy, SALT)


def condition_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.condition_map(deidentify(inputs.clinical_records(spark, sf_dir), CLINICAL_POLICY, SALT))


def concept_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("c_nationkey") + 10 * (F.col("c_custkey") % 3)
    coded = table(spark, sf_dir, "customer").select(
        "c_custkey", code.cast("string").alias("condition_source_value")
    )
    vocabulary = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("source_code"),
        (F.col("n_regionkey") + 40000).alias("concept_id"),
    )
    return silver.concept_lookup(coded, vocabulary)


def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.metrics(inputs.flawed_conditions(spark, sf_dir)).toDF(
        "size", "no_person", "no_id", "negative_concept"
    )


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(inputs.flawed_conditions(spark, sf_dir)).withColumn(
        "metric", F.round("metric", ROUND)
    )


def _concept_as_text(routed: DataFrame) -> DataFrame:
    """Null concepts are compared as text, since some clients show a null integer as a float."""
    return routed.withColumn("condition_concept_id", F.col("condition_concept_id").cast("string"))


def dq_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _concept_as_text(quality.valid_rows(inputs.flawed_conditions(spark, sf_dir)))


def dq_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = quality.dead_letters(inputs.flawed_conditions(spark, sf_dir))
    return _concept_as_text(dead).withColumn("reasons", F.array_join("reasons", ","))


def dq_satisfies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicate of the caller's own; null counts as satisfied."""
    rule = quality.Satisfies("concept_is_known", "condition_concept_id IN (0, 32020)")
    return quality.metrics(inputs.flawed_conditions(spark, sf_dir), (rule,)).toDF("size", "n_broken")


def dq_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the circuit breaker says of the flawed conditions, a row for each failed check, and of the valid ones."""
    flawed = inputs.flawed_conditions(spark, sf_dir)
    said = []
    for name, checked in (("flawed", flawed), ("valid", quality.valid_rows(flawed))):
        try:
            quality.require_quality(quality.report(checked))
            said.append((name, "passed"))
        except quality.QualityBreach as breach:
            said += [(name, line) for line in str(breach).split("; ")]
    return spark.createDataFrame(said, "checked string, said string")


def dq_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flawed conditions as a stream, routed in its batches."""
    out = workspace(spark, "dq-stream")
    flawed = inputs.flawed(_stream(spark, sf_dir, "orders"))
    sinks.start_routing(flawed, out, f"{out}/checkpoint", trigger=None).awaitTermination()
    valid = spark.read.parquet(f"{out}/valid").withColumn("reasons", F.lit(""))
    dead = spark.read.parquet(f"{out}/dead_letters").withColumn("reasons", F.array_join("reasons", ","))
    return _concept_as_text(valid.unionByName(dead).drop("batch"))


def landed_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that carry the time of their landing, which lies within the run."""
    started = datetime.now(timezone.utc).replace(microsecond=0)
    lines = table(spark, sf_dir, "documents").select(F.col("text").alias("value"), F.col("source").alias("origin"))
    landed = materialize(bronze.land_text(lines, source="DOCUMENTS"), "landed-now")
    in_time = F.col("ingestion_timestamp").between(F.lit(started), F.current_timestamp())
    return landed.groupBy("source_system_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(in_time).alias("n_in_time"),
        F.count_distinct("ingestion_timestamp").alias("n_times"))


def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions appended in two batches, partitioned by concept."""
    path = workspace(spark, "appended")
    conditions = inputs.conditions(spark, sf_dir)
    for half in (0, 1):
        tables.append_files(conditions.filter(F.col("condition_occurrence_id") % 2 == half), path, ["condition_concept_id"])
    return spark.read.parquet(path)


def _dated(merged: DataFrame) -> DataFrame:
    return merged.withColumn("updated_at", F.col("updated_at").cast("date"))


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = inputs.order_changes(table(spark, sf_dir, "orders"))
    return _dated(merge.merge_frames(inputs.merge_target(spark, sf_dir), changes, dedupe=False))


def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(merge.latest_per_key(inputs.repeated_changes(spark, sf_dir)))


def merge_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = inputs.repeated_changes(spark, sf_dir)
    return _dated(merge.merge_frames(inputs.merge_target(spark, sf_dir), changes))


def merge_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = inputs.order_changes(table(spark, sf_dir, "orders"))
    target = inputs.merge_target(spark, sf_dir)
    return _dated(merge.merge_frames(target, changes, dedupe=False, tombstones=True))


def merge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = inputs.order_changes(_stream(spark, sf_dir, "orders"))
    out = workspace(spark, "merge-stream")
    sinks.start_merge(changes, f"{out}/table", f"{out}/checkpoint", trigger=None, parts=LAKE_PARTS).awaitTermination()
    return _dated(read_parts(spark, f"{out}/table", merge.KEY))


def hedis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hedis(inputs.conditions(spark, sf_dir), inputs.measurements(spark, sf_dir))


def hedis_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hedis(inputs.conditions(spark, sf_dir), inputs.measurements(spark, sf_dir), latest=True)


def readmission_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.readmission_pairs(inputs.conditions(spark, sf_dir))


def readmission_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.readmission_pairs(inputs.conditions(spark, sf_dir), per_day=True)


def readmission_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.readmission_30d(inputs.conditions(spark, sf_dir), unique_ids=True)


def readmission_30d_any_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeated = inputs.conditions(spark, sf_dir).withColumn(
        "condition_occurrence_id", F.floor(F.col("condition_occurrence_id") / 2)
    )
    return marts.readmission_30d(repeated)


def readmission_30d_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.readmission_30d(inputs.conditions(spark, sf_dir), unique_ids=True, include_all=True)


def readmission_30d_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = inputs.conditions(spark, sf_dir)
    intervals = marts.readmission_intervals(conditions)
    return marts.readmission_30d(conditions, unique_ids=True).join(intervals, "person_id").withColumn(
        "mean_days_to_readmit", F.round("mean_days_to_readmit", ROUND)
    )


def admission_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.admission_count(inputs.conditions(spark, sf_dir))


def repeat_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.admission_count(inputs.conditions(spark, sf_dir), min_count=2)


def admission_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _stream(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("condition_occurrence_id")
    )
    out = workspace(spark, "admission-count")
    sinks.start_counts(orders, f"{out}/counts", f"{out}/checkpoint", trigger=None, parts=LAKE_PARTS).awaitTermination()
    return read_parts(spark, f"{out}/counts", "person_id")


def _sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.clinical_records(spark, sf_dir).select(
        "payload_id", F.col("patient_id").alias("person_id"), F.col("patient_ssn").alias("ssn"),
        F.col("patient_mrn").alias("mrn"),
    )


def mask_engineer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masking.mask_for(_sensitive(spark, sf_dir), "DATA_ENGINEER")


def mask_analyst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masking.mask_for(_sensitive(spark, sf_dir), "DATA_ANALYST")


def link_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = linkage.pattern_counts(inputs.persons(spark, sf_dir), LINK, by_block=True)
    return counts.withColumn("n_pairs", F.col("n_pairs").cast("bigint"))


def link_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = linkage.agreement_rates(inputs.persons(spark, sf_dir), LINK)
    return rates.select(
        "column_name", F.col("n_agree").cast("bigint").alias("n_agree"),
        F.col("n_pairs").cast("bigint").alias("n_pairs"), F.round("u", ROUND).alias("u"),
    )


def link_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linkage.predict(inputs.persons(spark, sf_dir), LINK, LINK_MODEL)
    return found.withColumns({
        "match_weight": F.round("match_weight", ROUND),
        "match_probability": F.round("match_probability", ROUND),
        "n_pairs": F.col("n_pairs").cast("bigint"),
    })


def link_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linkage.partners(
        inputs.copied_persons(spark, sf_dir), inputs.original_persons(spark, sf_dir), LINK, LINK_MODEL
    )
    return found.withColumns({
        "match_weight": F.round("match_weight", ROUND),
        "match_probability": F.round("match_probability", ROUND),
    })


def link_em(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = inputs.persons(spark, sf_dir)
    model = linkage.estimate(persons, LINK, tolerance=inputs.EM_TOLERANCE)
    return linkage.model_frame(persons, LINK, model).select(
        "column_name", *[F.round(c, 6).alias(c) for c in ("m", "u", "prior")]
    )


def link_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.clusters(inputs.persons(spark, sf_dir), LINK, LINK_MODEL)


def _order_chain(spark: SparkSession, sf_dir: str) -> Chain:
    return chain(
        inputs.order_payloads(spark, sf_dir), ChainSettings(salt=SALT),
        boundary=lambda raw: materialize(raw, "silver-raw"),
    )


def chain_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_chain(spark, sf_dir).readmissions


def chain_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_chain(spark, sf_dir).dead_letters.select(
        "condition_occurrence_id", "person_id", "condition_start_date",
        F.array_join("reasons", ",").alias("reasons"),
    )


DAILY = ChainSettings(salt=SALT, record=T.StructType([*CLINICAL_RECORD, *CHANGE_COLUMNS]))


def _land_first_day(spark: SparkSession, sf_dir: str, lake: str, corrected: bool) -> None:
    """Feed `orders` in two batches."""
    first = inputs.daily_payloads(spark, sf_dir, 1, corrected=corrected)
    for batch in (0, 1):
        bronze.land(first.filter(F.col("payload_id").cast("bigint") % 2 == batch), lake, "orders", batch)


def _first_day(spark: SparkSession, sf_dir: str) -> str:
    """A lake after the first day of two feeds that give the same ids to different rows."""
    lake = workspace(spark, "lake")
    _land_first_day(spark, sf_dir, lake, corrected=False)
    bronze.land(inputs.daily_payloads(spark, sf_dir, 1, later=1), lake, "refills", 0)
    for feed in ("orders", "refills"):
        run_day(spark, lake, feed, date(2024, 1, 1), DAILY, parts=LAKE_PARTS)
    return lake


def _corrected_lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake after a second day of changes, and the first day again with its bad rows corrected."""
    lake = _first_day(spark, sf_dir)
    bronze.land(inputs.daily_payloads(spark, sf_dir, 2), lake, "orders", 0)
    run_day(spark, lake, "orders", date(2024, 1, 2), DAILY, parts=LAKE_PARTS)
    _land_first_day(spark, sf_dir, lake, corrected=True)
    run_day(spark, lake, "orders", date(2024, 1, 1), DAILY, parts=LAKE_PARTS)
    return lake


def _zones(spark: SparkSession, lake: str) -> DataFrame:
    """The rows of Silver and of the dead letters."""
    silver = merge.live_rows(read_silver(spark, lake))
    dead = spark.read.parquet(f"{lake}/dead_letters")
    columns = ("condition_occurrence_id", "person_id", "condition_start_date")
    return silver.select(F.lit("silver").alias("zone"), *columns).unionByName(
        dead.select(F.lit("dead").alias("zone"), *columns)
    )


def pipeline_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zones(spark, _first_day(spark, sf_dir))


def pipeline_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zones(spark, _corrected_lake(spark, sf_dir))


def pipeline_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_mart(spark, _corrected_lake(spark, sf_dir), "readmissions_30_day")


def _vocabulary(rows: DataFrame) -> DataFrame:
    """A vocabulary as a table, of which the planner knows the size: that of the rows it is taken from says nothing."""
    return materialize(rows, "vocabulary")


def stay_lake(spark: SparkSession, sf_dir: str) -> str:
    """A lake after three days of stays and tests, with deletes, moved dates and another patient's stays."""
    lake = workspace(spark, "stay-lake")
    stays, labs = stay_settings(SALT), lab_settings(SALT)
    diagnoses, tests = (
        _vocabulary(v(spark, sf_dir)) for v in (inputs.diagnosis_vocabulary, inputs.lab_vocabulary))
    for day in (1, 2, 3):
        bronze.land(inputs.stay_payloads(spark, sf_dir, day), lake, "stays", 0)
        run_day(spark, lake, "stays", date(2024, 1, day), stays, diagnoses, parts=LAKE_PARTS)
        if day != 2:
            bronze.land(inputs.lab_payloads(spark, sf_dir, day), lake, "labs", 0)
            run_measurements(spark, lake, "labs", date(2024, 1, day), labs, tests, parts=LAKE_PARTS)
    return lake


def gold_rows(read: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of all four marts in columns that they share, as text."""
    columns = {
        "readmissions_30_day": ("total_index_admissions", "total_30_day_readmissions", F.lit(None)),
        "admission_count": ("admission_count", F.lit(None), F.lit(None)),
        "readmission_days": (F.concat_ws("/", "admission_date", "discharge_date"), "readmission_date", "n_readmissions"),
        "hedis": ("had_hba1c_test", "last_test_date", F.round("last_test_value", ROUND).cast("decimal(20,4)")),
    }
    found = []
    for mart, values in columns.items():
        texts = [(F.col(v) if isinstance(v, str) else v).cast("string").alias(n) for v, n in zip(values, "abc")]
        found.append(read(mart).select(F.lit(mart).alias("mart"), "person_id", *texts))
    return reduce(DataFrame.unionByName, found)


def pipeline_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = stay_lake(spark, sf_dir)
    return gold_rows(lambda mart: read_mart(spark, lake, mart))


def pipeline_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts by linked person, of which a third are joined after their stays have landed."""
    lake = workspace(spark, "linked-lake")
    people = inputs.person_records(spark, sf_dir)
    late = F.col("customer") % 6 == 5
    diagnoses = _vocabulary(inputs.diagnosis_vocabulary(spark, sf_dir))

    def persons(batch: DataFrame) -> None:
        run_persons(spark, lake, batch, inputs.LINKED, inputs.LINKED_MODEL, parts=LAKE_PARTS)

    def stays(day: int) -> None:
        bronze.land(inputs.stay_payloads(spark, sf_dir, day), lake, "stays", 0)
        run_day(spark, lake, "stays", date(2024, 1, day), stay_settings(SALT), diagnoses, parts=LAKE_PARTS)

    persons(people.filter(~late))
    stays(1)
    persons(people.filter(late))
    stays(2)
    counts = read_mart(spark, lake, "admission_count")
    return read_mart(spark, lake, "readmissions_30_day").join(counts, "person_id", "right")


def merge_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in hash parts after a small second batch."""
    lake = workspace(spark, "parted")
    path = f"{lake}/table"
    merge.merge_parts(spark, lake, path, inputs.merge_target(spark, sf_dir), parts=LAKE_PARTS)
    small = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 97 == 1)
    merge.merge_parts(spark, lake, path, inputs.order_changes(small), parts=LAKE_PARTS)
    return _dated(read_parts(spark, path, merge.KEY))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        land_text, land_lines, cdc_extract, cdc_rejects, stream_extract, flatten_payload,
        deid_token, deid_dateshift, redact_text, redact_documents, deid_drop, deid_salted,
        condition_map, concept_lookup, dq_metrics, dq_report, dq_valid, dq_dlq,
        dq_satisfies, dq_breaker, dq_stream, landed_now, append_batches,
        merge_upsert, merge_latest, merge_repeated, merge_tombstones, merge_stream,
        hedis, hedis_latest, readmission_pairs, readmission_days, readmission_30d, readmission_30d_any_ids,
        readmission_30d_all, readmission_30d_join, admission_count, repeat_admissions,
        admission_count_stream, mask_engineer, mask_analyst,
        link_pairs, link_rates, link_predict, link_partners, link_em, link_clusters,
        chain_e2e, chain_dead_letters, pipeline_e2e, pipeline_rerun, pipeline_marts, pipeline_gold, pipeline_linked, merge_touched,
    )
}
