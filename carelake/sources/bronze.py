"""Raw payloads to Bronze rows.

The functions take a frame with a `value` column and have no source or sink of
their own, so one expression serves a file scan, a table and a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.payload import content_id
from carelake.schemas import (
    BRONZE_PAYLOADS, CHANGE_CODE, CHANGE_ENVELOPE, RESOURCE_ENVELOPE, conform, require_columns,
)
from carelake.sources.tables import replace_files

# The source name of claim files, and the change codes that are kept by default.
CLAIM_SOURCE = "EDI_X12_BATCH"
KEPT_CHANGES = ("c", "u", "d")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of the text files at `path`, with its file and its position in it, from 0.

    Lines are numbered inside the split that they are read in, and a split's first number is
    the running sum of the counts of the file's earlier splits; so no file meets in one task,
    and what is joined is one row a split. The splits of a session do not show in the result.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("origin"), F.col("_metadata.file_block_start").alias("_split")
    ).withColumn("_row", F.monotonically_increasing_id())  # a split's lines follow each other in one task
    splits = lines.groupBy("origin", "_split").agg(F.count(F.lit(1)).alias("_lines"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy("origin").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("origin", "_split", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    return lines.join(starts, ["origin", "_split"]).select(
        "value", "origin", (F.col("_before") + F.col("_row") - F.col("_first")).alias("position"))


def _ingested(at: datetime | None) -> Column:
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def land_text(lines: DataFrame, source: str = CLAIM_SOURCE, at: datetime | None = None) -> DataFrame:
    """Bronze rows of raw text lines, unchanged.

    The id is a hash of source, file, line and the line's position where there is one (see
    `text_lines`), so landing a file twice gives the same ids and equal lines of it have
    their own; without positions they share one. `ingestion_date` is the storage partition.
    """
    require_columns(lines, ["value"], "land_text")
    origin = F.col("origin") if "origin" in lines.columns else F.lit("")
    position = [F.col("position")] if "position" in lines.columns else []
    return lines.select(
        content_id(F.lit(source), origin, F.col("value"), *position).alias("payload_id"),
        F.lit(source).alias("source_system_id"),
        F.col("value").alias("raw_payload_json"),
        _ingested(at).alias("ingestion_timestamp"),
    ).withColumn("ingestion_date", F.to_date("ingestion_timestamp"))


def _change_text(lines: DataFrame, operator: str) -> DataFrame:
    require_columns(lines, ["value"], operator)
    return lines.select(F.col("value").cast("string").alias("raw_payload_json"))


def _change_code() -> Column:
    return F.from_json(F.col("raw_payload_json"), CHANGE_CODE)["payload"]["op"]


def cdc_extract(
    lines: DataFrame, at: datetime | None = None, strict_after: bool = False,
    kept: Sequence[str] = KEPT_CHANGES,
) -> DataFrame:
    """Bronze rows of change-log lines with one of the `kept` codes.

    By default these are create, update and delete. An initial load writes code `r`
    only: add it where such lines should land. What is left out is in `cdc_rejects`.
    A delete has no `after` image; its id is taken from `before`, unless
    `strict_after` asks for the image after the change only.
    """
    changes = _change_text(lines, "cdc_extract").filter(_change_code().isin(*kept))
    after_id = F.col("change.after")["id"]
    row_id = after_id if strict_after else F.coalesce(after_id, F.col("change.before")["id"])
    change = F.from_json(F.col("raw_payload_json"), CHANGE_ENVELOPE)["payload"]
    return changes.withColumn("change", change).select(
        row_id.alias("payload_id"),
        F.col("change.source")["db"].alias("source_system_id"),
        "raw_payload_json",
        _ingested(at).alias("ingestion_timestamp"),
    )


def cdc_rejects(lines: DataFrame, kept: Sequence[str] = KEPT_CHANGES) -> DataFrame:
    """Change-log lines that `cdc_extract` leaves out: no readable change code, or another one."""
    left_out = ~F.coalesce(_change_code().isin(*kept), F.lit(False))
    return _change_text(lines, "cdc_rejects").filter(left_out)


def stream_extract(lines: DataFrame, at: datetime | None = None) -> DataFrame:
    """Bronze rows of JSON resources; unreadable lines are kept with null ids."""
    require_columns(lines, ["value"], "stream_extract")
    text = F.col("value").cast("string")
    return lines.select(
        text.alias("raw_payload_json"), F.from_json(text, RESOURCE_ENVELOPE).alias("resource")
    ).select(
        F.col("resource.id").alias("payload_id"),
        F.col("resource.resourceType").alias("source_system_id"),
        "raw_payload_json",
        _ingested(at).alias("ingestion_timestamp"),
    )


def land(bronze: DataFrame, root: str, feed: str, batch: int) -> None:
    """Write Bronze rows of a feed below `root`, partitioned by feed, day and batch.

    What the feed landed on the same days under the same batch number is replaced, so
    landing one batch again adds nothing. Every file or offset range needs a number of
    its own: another one under a used number would replace the earlier rows.
    """
    dated = conform(bronze, BRONZE_PAYLOADS, "land").withColumns({
        "feed": F.lit(feed),
        "ingestion_date": F.to_date("ingestion_timestamp"),
        "batch": F.lit(batch).cast("bigint"),
    })
    replace_files(dated, f"{root}/bronze", ["feed", "ingestion_date", "batch"])


def landed(spark: SparkSession, root: str) -> DataFrame:
    """All Bronze rows below `root` with their feed and day."""
    schema = T.StructType([
        *BRONZE_PAYLOADS, T.StructField("feed", T.StringType()),
        T.StructField("ingestion_date", T.DateType()), T.StructField("batch", T.LongType()),
    ])
    return spark.read.schema(schema).parquet(f"{root}/bronze").drop("batch")


def flatten_payload(
    bronze: DataFrame, schema: T.StructType, paths: Mapping[str, str | Sequence[str]] | None = None
) -> DataFrame:
    """Bronze ids plus the typed fields of the raw JSON; the JSON itself is dropped.

    `paths` gives the dotted path of a field where it is not the field's own name at
    the top level, or several paths, of which the first with a value counts: a change
    log holds a deleted row under `payload.before` only. The JSON is read once, as
    text, and each value is then cast: one that does not fit its type becomes null,
    never an error, so that quality rules can route the row.
    """
    require_columns(bronze, ["raw_payload_json"], "flatten_payload")
    given = dict(paths or {})
    places: dict[str, list[list[str]]] = {}
    for f in schema:
        path = given.get(f.name, f.name)
        places[f.name] = [p.split(".") for p in ([path] if isinstance(path, str) else path)]
    parsed = F.from_json(
        F.col("raw_payload_json"), _text_schema([place for options in places.values() for place in options])
    )
    kept = [c for c in bronze.columns if c != "raw_payload_json"]

    def value(place: list[str]) -> Column:
        return reduce(lambda column, name: column[name], place, F.col("_parsed"))

    return bronze.withColumn("_parsed", parsed).select(*kept, *[
        F.coalesce(*[value(place) for place in places[f.name]]).try_cast(f.dataType).alias(f.name)
        for f in schema
    ])


def _text_schema(places: Sequence[Sequence[str]]) -> T.StructType:
    """A struct that holds the value at every place as text."""
    fields = []
    for name in dict.fromkeys(p[0] for p in places):
        below = [p[1:] for p in places if p[0] == name and len(p) > 1]
        fields.append(T.StructField(name, _text_schema(below) if below else T.StringType()))
    return T.StructType(fields)
