"""The daily chain: Bronze, de-identified, Silver, quality, merge, Gold."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators import quality
from carelake.operators.deidentify import CLINICAL_POLICY, STAY_POLICY, TEST_POLICY, DeidPolicy, deidentify
from carelake.operators.growing import stage_records
from carelake.operators.linkage import LinkModel, LinkSettings
from carelake.operators.merge import KEY, merge_frames, stage_merge
from carelake.operators.silver import (
    MEASUREMENT_COLUMNS, RECORD_COLUMNS, STAY_COLUMNS, concept_lookup, condition_map, measurement_map,
)
from carelake.plans import gold, marts
from carelake.schemas import CHANGE_COLUMNS, CLINICAL_RECORD, STAY_RECORD, TEST_RECORD
from carelake.sources.bronze import flatten_payload, landed
from carelake.sources.parts import PARTS, commit, read_parts, settle
from carelake.sources.tables import replace_partition


@dataclass(frozen=True)
class ChainSettings:
    """How payloads of one source become conditions."""

    salt: str
    policy: DeidPolicy = CLINICAL_POLICY
    record: T.StructType = CLINICAL_RECORD
    paths: Mapping[str, str | Sequence[str]] | None = None
    columns: Mapping[str, str] | None = None
    rules: Sequence[quality.Rule] = quality.CHANGE_RULES
    on_fail: str = "route"


def stay_settings(salt: str) -> ChainSettings:
    """Stays with diagnosis and discharge, as changes with code and time."""
    record = T.StructType([*STAY_RECORD, *CHANGE_COLUMNS])
    return ChainSettings(salt, STAY_POLICY, record, columns=STAY_COLUMNS)


def lab_settings(salt: str) -> ChainSettings:
    """Tests, as changes with code and time; with the salt of the stays they meet the same persons."""
    record = T.StructType([*TEST_RECORD, *CHANGE_COLUMNS])
    return ChainSettings(salt, TEST_POLICY, record, columns=MEASUREMENT_COLUMNS, rules=quality.MEASUREMENT_RULES)


def to_conditions(
    bronze: DataFrame, settings: ChainSettings, vocabulary: DataFrame | None = None, feed: str | None = None
) -> DataFrame:
    """Bronze payloads to condition rows with change columns, as one lazy projection.

    The time of a change is its `updated_at` where the payload has one, else the time
    it was ingested. With a vocabulary the source code gets its concept. With a feed,
    ids read `feed/source system/id`, as two sources may give one id to different rows.
    """
    if feed is not None and "/" in feed:
        raise ValueError("to_conditions: no / in the name of a feed")
    safe, columns = _safe_records(bronze, settings, feed, settings.columns or RECORD_COLUMNS, KEY)
    mapped = condition_map(safe, columns)
    return mapped if vocabulary is None else concept_lookup(mapped, vocabulary)


def _safe_records(
    bronze: DataFrame, settings: ChainSettings, feed: str | None, columns: Mapping[str, str], key: str
) -> tuple[DataFrame, Mapping[str, str]]:
    """De-identified records with change columns, and the columns of the mapping with the whole id as `key`."""
    flat = flatten_payload(bronze, settings.record, settings.paths)
    if "updated_at" not in flat.columns:
        flat = flat.withColumn("updated_at", F.col("ingestion_timestamp"))
    if "cdc_op" not in flat.columns:
        flat = flat.withColumn("cdc_op", F.lit(None).cast("string"))
    safe = deidentify(flat, settings.policy, settings.salt)
    if feed is None:
        return safe, columns
    system = F.coalesce(F.replace("source_system_id", F.lit("/"), F.lit("%2F")), F.lit(""))
    whole = F.concat(F.lit(f"{feed}/"), system, F.lit("/"), F.col(columns[key]).cast("string"))
    return safe.withColumn("_whole_id", whole), {**columns, key: "_whole_id"}


def to_measurements(
    bronze: DataFrame, settings: ChainSettings, vocabulary: DataFrame | None = None, feed: str | None = None
) -> DataFrame:
    """Bronze payloads of tests to measurement rows with change columns; ids and times as in `to_conditions`.

    Tokens and shifts are those of the conditions where salt, policy and patient are, so a
    person's tests meet their conditions.
    """
    if feed is not None and "/" in feed:
        raise ValueError("to_measurements: no / in the name of a feed")
    safe, columns = _safe_records(bronze, settings, feed, settings.columns or MEASUREMENT_COLUMNS, gold.MEASUREMENT_KEY)
    mapped = measurement_map(safe, columns)
    if vocabulary is None:
        return mapped
    return concept_lookup(mapped, vocabulary, code="measurement_source_value", concept="measurement_concept_id")


@dataclass(frozen=True)
class Chain:
    """The stages of one run as lazy frames."""

    conditions: DataFrame
    valid: DataFrame
    dead_letters: DataFrame
    silver: DataFrame
    readmissions: DataFrame


def chain(
    bronze: DataFrame, settings: ChainSettings, target: DataFrame | None = None,
    vocabulary: DataFrame | None = None,
    boundary: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Chain:
    """The whole chain for a batch.

    `boundary` is applied to the raw Silver rows, which routing and merge both read.
    By default it is nothing and no write happens, but then every reader parses and
    hashes the payloads again: pass a function that writes the rows and reads them
    back, such as `materialize`, for anything large.
    """
    conditions = boundary(to_conditions(bronze, settings, vocabulary))
    valid = quality.valid_rows(conditions, settings.rules)
    if target is None:
        target = conditions.limit(0)
    silver = merge_frames(target, valid)
    return Chain(
        conditions, valid, quality.dead_letters(conditions, settings.rules), silver,
        marts.readmission_30d(silver, unique_ids=True),
    )


def run_day(
    spark: SparkSession, root: str, feed: str, day: date, settings: ChainSettings,
    vocabulary: DataFrame | None = None, measurements: DataFrame | None = None, parts: int = PARTS,
) -> dict[str, int]:
    """Carry what a feed landed on a day through the zones below `root`; the metrics.

    Each zone is written once: raw Silver and dead letters replace the day's partition,
    the merge rewrites the hash parts that the day's keys fall into, and the marts change
    for the persons whose rows it moved (see `gold`). Silver and Gold change together, so a
    run that failed or ran twice is simply run again, also after later days: deleted keys
    stay in Silver with code `d` (see `live_rows`), so an older day does not revive them.
    Quality is measured while raw Silver is written. With `on_fail="raise"` a broken rule
    stops the run before the merge. Runs over one `root` follow each other, as all feeds
    share Silver, and name the same number of `parts`.
    """
    conditions = to_conditions(_of_day(spark, root, feed, day), settings, vocabulary, feed)
    valid, measured = _routed(spark, root, "silver_raw", "dead_letters", conditions, feed, day, settings)
    settle(spark, root)
    merged = stage_merge(spark, f"{root}/{gold.SILVER}", valid, parts=parts, tombstones=True)
    paths = gold.stage_conditions(spark, root, merged, measurements, parts)
    commit(spark, root, [f"{root}/{gold.SILVER}", *paths])
    return measured


def run_measurements(
    spark: SparkSession, root: str, feed: str, day: date, settings: ChainSettings,
    vocabulary: DataFrame | None = None, parts: int = PARTS,
) -> dict[str, int]:
    """The same for a feed of tests: to the measurement table and the mart of tests."""
    found = to_measurements(_of_day(spark, root, feed, day), settings, vocabulary, feed)
    valid, measured = _routed(spark, root, "measurement_raw", "measurement_dead_letters", found, feed, day, settings)
    settle(spark, root)
    table = f"{root}/{gold.MEASUREMENTS}"
    merged = stage_merge(spark, table, valid, gold.MEASUREMENT_KEY, parts=parts, tombstones=True)
    commit(spark, root, [table, *gold.stage_measurements(spark, root, merged, parts)])
    return measured


def run_persons(
    spark: SparkSession, root: str, records: DataFrame, settings: LinkSettings, model: LinkModel,
    threshold: float = 0.8, parts: int = PARTS,
) -> None:
    """Let a batch of person records join the linked persons, and the rows of joined persons move in Gold.

    The records' unique id is the token that conditions and tests have as `person_id`. Links and
    Gold change together, so a batch that failed or came before is simply run again.
    """
    settle(spark, root)
    grown = stage_records(spark, f"{root}/{gold.PERSONS}", records, settings, model, threshold, parts)
    renamed = grown.moved.select(
        F.col("id").cast("string").alias(gold.SOURCE), F.coalesce("old", "id").cast("string").alias("old"),
        F.col("new").cast("string").alias("new"),
    ).filter("old <> new")
    commit(spark, root, [*grown.paths, *gold.stage_links(spark, root, renamed, parts)])


def _here(feed: str, day: date) -> Column:
    return (F.col("feed") == feed) & (F.col("ingestion_date") == F.lit(day))


def _of_day(spark: SparkSession, root: str, feed: str, day: date) -> DataFrame:
    return landed(spark, root).filter(_here(feed, day))


def _routed(
    spark: SparkSession, root: str, raw_zone: str, dead_zone: str, rows: DataFrame, feed: str, day: date, settings: ChainSettings
) -> tuple[DataFrame, dict[str, int]]:
    """Write the day's raw rows and dead letters; the valid rows and the metrics."""
    watched, seen = quality.observed(rows, settings.rules, name=f"quality-{raw_zone}-{feed}-{day}")
    place = {"feed": F.lit(feed), "ingestion_date": F.lit(day)}
    replace_partition(watched, f"{root}/{raw_zone}", {"feed": feed, "ingestion_date": day})
    measured = {k: int(v) for k, v in seen.get.items()}
    raw = spark.read.schema(rows.withColumns(place).schema).parquet(f"{root}/{raw_zone}").filter(_here(feed, day))
    raw = raw.drop(*place)
    dead = quality.dead_letters(raw, settings.rules)
    replace_partition(dead, f"{root}/{dead_zone}", {"feed": feed, "ingestion_date": day})
    broken = {k: n for k, n in measured.items() if k != "size" and n}
    if settings.on_fail == "raise" and (broken or not measured["size"]):
        raise quality.QualityBreach(f"{feed} {day}: {broken or 'no rows'}")
    return quality.valid_rows(raw, settings.rules), measured


def read_silver(spark: SparkSession, root: str) -> DataFrame | None:
    """The merged conditions below `root`, deleted keys included (see `live_rows`); None before the first merge."""
    return read_parts(spark, f"{root}/{gold.SILVER}", KEY)


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A Gold mart below `root`, or None before its first row."""
    return read_parts(spark, gold.gold(root, name), gold.PERSON)
