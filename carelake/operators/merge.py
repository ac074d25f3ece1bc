"""Keyed merge of a change batch into a table.

Rules, with `newer` meaning the change's time is later than the row's:
matched and delete and newer: the row goes. Matched and (update or no code) and
newer: the change replaces the row. Not matched and (create, update or no code): the
change is inserted. Anything else, a null time included, changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.deid import unpacked
from carelake.schemas import require_columns
from carelake.sources import parts as hash_parts
from carelake.sources.snapshots import read_snapshot, write_snapshot

KEY = "condition_occurrence_id"
TIME = "updated_at"
OP = "cdc_op"


def latest_per_key(changes: DataFrame, key: str = KEY, time: str = TIME, op: str = OP) -> DataFrame:
    """The newest version of every key; rows with a null key are kept as they are.

    At equal times a delete wins over an update and an update over a create; what is
    still equal is decided by the other columns, so the outcome does not depend on
    the order of the rows. This is a `max`, not a ranked window: versions are reduced
    before the shuffle, so a key with very many versions loads no task.
    """
    require_columns(changes, [key, time, op], "latest_per_key")
    newest = _newest(changes.filter(F.col(key).isNotNull()), key, time, op)
    return newest.unionByName(changes.filter(F.col(key).isNull()))


def _version(columns: list[str], key: str, time: str, op: str) -> Column:
    """A row but for its key, which is greater the newer it is."""
    rank = (
        F.when(F.col(op) == "d", 3).when((F.col(op) == "u") | F.col(op).isNull(), 2)
        .when(F.col(op) == "c", 1).otherwise(0)
    )
    return F.struct(F.col(time), rank.alias("_rank"), *[F.col(c) for c in columns if c not in (key, time)])


def _newest(changes: DataFrame, key: str, time: str, op: str) -> DataFrame:
    return changes.groupBy(key).agg(F.max(_version(changes.columns, key, time, op)).alias("_newest")).select(
        *[F.col(c) if c == key else F.col(f"_newest.{c}").alias(c) for c in changes.columns]
    )


def _checked_key(key: str) -> Column:
    message = f"merge: null {key}; route such rows to the dead letters first"
    return F.coalesce(F.col(key), F.raise_error(F.lit(message)))


def merge_frames(
    target: DataFrame, changes: DataFrame, key: str = KEY, time: str = TIME, op: str = OP,
    null_keys: str = "error", dedupe: bool = True, tombstones: bool = False,
) -> DataFrame:
    """The target after the change batch.

    Target keys must be unique. `dedupe` first takes the newest version per key of
    the batch; without it the batch's keys must be unique too. A null key fails the
    job, or with `null_keys="insert"` is inserted by its change code, once more with
    every replay. With `tombstones` deleted keys stay as rows with code `d` (see
    `live_rows`), so that an older update that arrives late does not revive them; a
    newer create or update does.
    """
    if null_keys not in ("error", "insert"):
        raise ValueError("merge_frames: null_keys is 'error' or 'insert'")
    require_columns(target, [key, time, op], "merge_frames target")
    require_columns(changes, target.columns, "merge_frames changes")
    columns = target.columns
    changes = changes.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in columns])
    if null_keys == "error":
        changes = changes.withColumn(key, _checked_key(key))
        source = _newest(changes, key, time, op) if dedupe else changes
        return _merge_keyed(target, source, key, time, op, tombstones)
    # Null keys match nothing. They are kept out of the join, which would send all of
    # them to one task.
    keyed = changes.filter(F.col(key).isNotNull())
    unkeyed = changes.filter(F.col(key).isNull() & _inserts(F.col(op)))
    source = _newest(keyed, key, time, op) if dedupe else keyed
    merged = _merge_keyed(target.filter(F.col(key).isNotNull()), source, key, time, op, tombstones)
    return merged.unionByName(target.filter(F.col(key).isNull())).unionByName(unkeyed)


def _inserts(op: Column) -> Column:
    return op.isin("c", "u") | op.isNull()


def _takes(in_t: Column, in_s: Column, t_time: Column, s_time: Column, t_op: Column, s_op: Column, tombstones: bool) -> Column:
    """True takes the change, false keeps the row, null leaves the key out."""
    newer = in_t & in_s & (s_time > t_time)
    updates = (s_op == "u") | s_op.isNull()
    deletes = s_op == "d"
    if tombstones:
        revives = (t_op == "d") & (s_op == "c")
        takes = F.when(newer & (deletes | updates | revives), True)
        inserts = _inserts(s_op) | deletes
    else:
        takes = F.when(newer & deletes, F.lit(None)).when(newer & updates, True)
        inserts = _inserts(s_op)
    return takes.when(in_t, False).when(inserts, True)


def _merge_keyed(
    target: DataFrame, source: DataFrame, key: str, time: str, op: str, tombstones: bool
) -> DataFrame:
    columns = target.columns
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in columns], F.lit(True).alias("in_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in columns], F.lit(True).alias("in_s"))
    joined = t.join(s, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer")
    takes = _takes(
        F.col("in_t"), F.col("in_s"), F.col(f"t_{time}"), F.col(f"s_{time}"), F.col(f"t_{op}"), F.col(f"s_{op}"), tombstones)
    chosen = joined.withColumn("takes", takes).filter(F.col("takes").isNotNull())
    return chosen.select(*[
        F.when(F.col("takes"), F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in columns
    ])


def live_rows(table: DataFrame, op: str = OP) -> DataFrame:
    """A table kept with tombstones, without them."""
    return table.filter(F.coalesce(F.col(op) != "d", F.lit(True)))


def merge_into(changes: DataFrame, table: str, key: str = KEY, time: str = TIME, op: str = OP) -> None:
    """The same merge done by a catalog whose table format rewrites single rows."""
    require_columns(changes, [key, time, op], "merge_into")
    source = _newest(changes.withColumn(key, _checked_key(key)), key, time, op).alias("s")
    code = F.col(f"s.{op}")
    newer = F.col(f"s.{time}") > F.col(f"{table}.{time}")
    (
        source.mergeInto(table, F.col(f"{table}.{key}") == F.col(f"s.{key}"))
        .whenMatched((code == "d") & newer).delete()
        .whenMatched(((code == "u") | code.isNull()) & newer).updateAll()
        .whenNotMatched(_inserts(code)).insertAll()
        .merge()
    )


def merge_snapshot(
    spark: SparkSession, path: str, changes: DataFrame, key: str = KEY, time: str = TIME,
    op: str = OP, keep: int | None = None, **options: object,
) -> int:
    """Merge into the newest snapshot below `path` and write the next one; its number.

    For plain files. Every merge writes the whole table again, so at size prefer
    `merge_into` and a table format. A merge that dies half-way leaves the last
    snapshot as it was, and may simply be run again.
    """
    target = read_snapshot(spark, path)
    if target is None:
        target = spark.createDataFrame([], changes.schema)
    return write_snapshot(merge_frames(target, changes, key, time, op, **options), path, keep)


@dataclass(frozen=True)
class Staged:
    """A merge that is staged: the table's touched parts after it, with the marks of what it did."""

    after: DataFrame

    def moved(self, key: str, columns: list[str], op: str = OP) -> tuple[DataFrame, DataFrame]:
        """Live rows that go out and that come in, in `columns`; rows that the merge left as they were are in neither.

        Read from the staged rows, so nothing is shuffled. What a merge without tombstones deletes is not marked.
        """
        both = self.delta(key, columns, (), op)
        return both.filter(~F.col("comes")).drop("comes"), both.filter("comes").drop("comes")

    def delta(self, key: str, columns: list[str], within: Sequence[str], op: str = OP) -> DataFrame:
        """The same in one scan: rows in `columns` that go out, with false as `comes`, and that come in, with true.

        With `within` a row does not go out if one comes in that is alike in these columns, since that one takes its place.
        """
        new, old = ({c: F.col(f"{side}{c}") for c in {*columns, op, key}} for side in ("", f"{hash_parts.OLD}."))
        old[key] = F.col(key)  # the same in both
        lives = [F.coalesce(side[op] != "d", F.lit(True)) for side in (new, old)]
        replaces = F.col(hash_parts.OLD).isNotNull()
        same = reduce(and_, [replaces, *lives, *[new[c].eqNullSafe(old[c]) for c in columns]])
        goes = replaces & lives[1]
        if within:
            goes &= ~reduce(and_, [lives[0], *[new[c].eqNullSafe(old[c]) for c in within]])
        sides = [
            F.when(met, F.struct(*[side[c].alias(c) for c in columns], F.lit(comes).alias("comes")))
            for met, side, comes in ((goes, old, False), (lives[0], new, True))]
        taken = self.after.filter(F.col(hash_parts.TAKEN) & ~same)
        return taken.select(F.inline(F.array(*sides))).filter("comes is not null")


def stage_merge(
    spark: SparkSession, path: str, changes: DataFrame, key: str = KEY, time: str = TIME, op: str = OP,
    parts: int = hash_parts.PARTS, tombstones: bool = False, null_keys: str = "error", dedupe: bool = True,
) -> Staged:
    """Merge `changes` into the hash parts of their keys and stage these; see `sources.parts` and `merge_frames`.

    Reads and writes the parts that the batch has keys of, and no other. Rows and changes are
    shuffled once, into the slices of part and key that are written; there the versions of a key
    lie side by side, and are reduced one by one. Without `dedupe` the batch's keys are unique
    anyway, and its newest version of a key is its only one.
    """
    if null_keys != "error":
        raise ValueError("stage_merge: null keys have no part")
    counts = hash_parts.part_counts(changes, key, parts)
    touched = sorted(counts)
    before = hash_parts.read_parts(spark, path, key, touched)
    if before is None:
        before = spark.createDataFrame([], changes.schema)
    require_columns(before, [key, time, op], "stage_merge target")
    require_columns(changes, before.columns, "stage_merge changes")
    columns = before.columns
    source = changes.select(*[F.col(c).cast(before.schema[c].dataType).alias(c) for c in columns]).withColumn(key, _checked_key(key))
    both = before.withColumn("_change", F.lit(False)).unionByName(source.withColumn("_change", F.lit(True)))
    version, change = _version(columns, key, time, op), F.col("_change")
    tokens = [c for c in hash_parts.texts(both) if c == hash_parts.PERSON != key]
    slices = hash_parts.Slices.even(spark, touched, parts, sum(counts.values()) + before.count())
    near = hash_parts.spread(both, path, key, touched, parts, pack=tokens, slices=slices).withColumns(
        {c: unpacked(F.col(c)) for c in tokens})
    # a row without a key marks its part, and is no change
    found = near.groupBy(hash_parts.PART, key, hash_parts.SLICE).agg(
        F.max(F.when(~change, version)).alias("t"), F.max(F.when(change, version)).alias("s"))
    takes = _takes(
        F.col("t").isNotNull(), F.col("s").isNotNull(), F.col(f"t.{time}"), F.col(f"s.{time}"), F.col(f"t.{op}"), F.col(f"s.{op}"),
        tombstones)
    chosen = found.withColumn(hash_parts.TAKEN, F.when(F.col(key).isNull(), False).otherwise(takes)).filter(
        F.col(hash_parts.TAKEN).isNotNull())
    rest = [c for c in columns if c != key]
    kept = F.when(F.col(hash_parts.TAKEN), F.col("s")).otherwise(F.col("t"))
    old = F.when(F.col(hash_parts.TAKEN) & F.col("t").isNotNull(), F.struct(*[F.col(f"t.{c}").alias(c) for c in rest]))
    merged = chosen.select(
        *[F.col(key) if c == key else kept[c].alias(c) for c in columns], hash_parts.TAKEN, old.alias(hash_parts.OLD),
        hash_parts.PART)
    return Staged(hash_parts.stage_spread(merged, path, key))


def merge_parts(
    spark: SparkSession, root: str, path: str, changes: DataFrame, key: str = KEY, time: str = TIME, op: str = OP,
    parts: int = hash_parts.PARTS, **options: object,
) -> None:
    """Merge `changes` into the table at `path` below `root`: untouched parts keep their files.

    A merge that died is finished or forgotten first, and may simply be run again. Null keys
    fail: they have no part.
    """
    if options.get("null_keys", "error") != "error":
        raise ValueError("merge_parts: null keys have no part")
    hash_parts.settle(spark, root)
    stage_merge(spark, path, changes, key, time, op, parts, **options)
    hash_parts.commit(spark, root, [path])
