"""Streaming writes: append, routing by quality, running counts and merge.

The checkpoint folder holds offsets and state and must be shared by the cluster. A
restart with the same folder goes on where the last batch ended. `trigger` is a
processing time such as "1 minute"; None takes what is there and stops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from carelake.operators import quality
from carelake.operators.merge import KEY, merge_into, merge_parts
from carelake.session import materialize
from carelake.sources.bronze import land
from carelake.sources.parts import PARTS, commit, read_parts, settle, stage, touched_parts
from carelake.sources.tables import replace_partition

INGEST_TRIGGER = "1 minute"
SILVER_TRIGGER = "5 minutes"
GOLD_TRIGGER = "60 minutes"


def _started(writer: DataStreamWriter, checkpoint: str, trigger: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def start_append(
    stream: DataFrame, path: str, checkpoint: str, trigger: str | None = INGEST_TRIGGER,
    fmt: str = "parquet", partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append every batch to files, exactly once.

    The stream logs its files in the folder, and readers of the folder see only these:
    let no one else write there. See `start_landing` for a shared folder.
    """
    writer = stream.writeStream.format(fmt).outputMode("append").option("path", path)
    return _started(writer.partitionBy(*partition_by) if partition_by else writer, checkpoint, trigger)


def start_landing(
    stream: DataFrame, root: str, feed: str, checkpoint: str, trigger: str | None = INGEST_TRIGGER
) -> StreamingQuery:
    """Land the Bronze rows of a stream beside those of other feeds.

    A batch that runs twice has the same number and replaces its own rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        land(batch, root, feed, number)

    return _started(stream.writeStream.foreachBatch(write), checkpoint, trigger)


def start_append_table(
    stream: DataFrame, table: str, checkpoint: str, trigger: str | None = INGEST_TRIGGER,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append every batch to a catalog table, created where it is absent."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    timed = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return timed.toTable(table)


def start_counts(
    stream: DataFrame, path: str, checkpoint: str, key: str = "person_id",
    counted: str = "condition_occurrence_id", trigger: str | None = GOLD_TRIGGER, parts: int = PARTS,
) -> StreamingQuery:
    """Keep the count per key up to date in the hash parts at `path` (see `read_parts`).

    The state store holds one number per key. A batch brings the new counts of the keys it
    saw, and the parts of these keys only are rewritten; counts only grow, so the greater one
    is the newer, and a batch that runs twice changes nothing. A null key is not counted.
    """
    counts = stream.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(counted).alias("admission_count"))

    def write(batch: DataFrame, number: int) -> None:
        settle(batch.sparkSession, _journal(path))
        changed = materialize(batch, "changed-counts")  # the state is read once
        touched = touched_parts(changed, key, parts)
        before = read_parts(batch.sparkSession, path, key, touched)
        known = changed if before is None else before.unionByName(changed)
        newest = known.groupBy(key).agg(F.max("admission_count").alias("admission_count"))
        stage(newest, path, key, touched, parts)
        commit(batch.sparkSession, _journal(path), [path])

    return _started(counts.writeStream.outputMode("update").foreachBatch(write), checkpoint, trigger)


def _journal(path: str) -> str:
    return f"{path}.log"


def start_merge(
    stream: DataFrame, path: str, checkpoint: str, trigger: str | None = SILVER_TRIGGER, key: str = KEY,
    parts: int = PARTS, **options: object,
) -> StreamingQuery:
    """Merge every batch of changes into the hash parts at `path` (see `read_parts`), of which it rewrites those it touches.

    A batch that runs twice changes nothing the second time, because a change must be newer
    than the row it meets. A key that a batch deletes is an exception: its older update,
    should it come again, inserts it, unless `tombstones=True`. A null key fails the batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        merge_parts(batch.sparkSession, _journal(path), path, batch, key, parts=parts, **options)

    return _started(stream.writeStream.foreachBatch(write), checkpoint, trigger)


def start_routing(
    stream: DataFrame, root: str, checkpoint: str, rules: Sequence[quality.Rule] = quality.CONDITION_RULES,
    on_fail: str = "route", trigger: str | None = SILVER_TRIGGER,
) -> StreamingQuery:
    """Valid rows of every batch to `valid` below `root`, the others with their reasons to `dead_letters`.

    Both are partitioned by batch, and a batch that runs twice replaces its own. The metrics
    are observed while the batch is read, once; with `on_fail="raise"` a broken rule stops the
    query before either is written, and the batch comes again when it is started anew.
    """
    if on_fail not in ("route", "raise"):
        raise ValueError("start_routing: on_fail is 'route' or 'raise'")

    def write(batch: DataFrame, number: int) -> None:
        watched, seen = quality.observed(quality.tagged(batch, rules), rules, name=f"batch-{number}")
        checked = materialize(watched, "checked-batch")
        broken = {k: n for k, n in seen.get.items() if k != "size" and n}
        if on_fail == "raise" and broken:
            raise quality.QualityBreach(f"batch {number}: {broken}")
        bad = F.size("reasons") > 0
        replace_partition(checked.filter(~bad).drop("reasons"), f"{root}/valid", {"batch": number})
        replace_partition(checked.filter(bad), f"{root}/dead_letters", {"batch": number})

    return _started(stream.writeStream.foreachBatch(write), checkpoint, trigger)


def start_merge_into(
    stream: DataFrame, table: str, checkpoint: str, trigger: str | None = SILVER_TRIGGER
) -> StreamingQuery:
    """Merge every batch into a catalog table whose format rewrites single rows."""

    def write(batch: DataFrame, number: int) -> None:
        merge_into(batch, table)

    return _started(stream.writeStream.foreachBatch(write), checkpoint, trigger)
