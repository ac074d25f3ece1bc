"""Gold marts, kept up to date for the persons whose rows a merge moves.

A merge gives the live rows that go out and come in. They are applied to a copy of the
live rows in hash parts of the person, where all rows of a person are found without
reading the history of the others; the marts of these persons are built from it, and the
rows of all other persons are carried over. Tables and marts change under one declaration.

Silver names persons as the sources do. The copies and the marts name the linked person, as
the batches of person records say so far; where a batch joins two persons, their rows move.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.deid import packed, unpacked
from carelake.operators import growing
from carelake.operators.merge import KEY, Staged
from carelake.plans import marts
from carelake.schemas import MEASUREMENT
from carelake.session import materialize
from carelake.sources.parts import (
    PART, PARTS, PERSON, SLICE, Slices, part_of, read_parts, spread, stage, stage_spread, texts, together, touched_parts,
)

SOURCE = "source_person"
PERSONS = "persons"
MEASUREMENT_KEY = "measurement_id"
SILVER, MEASUREMENTS = "condition_occurrence", "measurement"
#: What the marts read of a condition and of a measurement.
CONDITION_COLUMNS = [KEY, PERSON, "condition_concept_id", "condition_start_date", "condition_end_date"]
MEASUREMENT_COLUMNS = [MEASUREMENT_KEY, PERSON, "measurement_concept_id", "measurement_date", "value_as_number"]

#: Marts of the conditions alone.
CONDITION_MARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    # a person's rows lie side by side in the copies and stay so in this shuffle, the only one, so names pack well
    "readmissions_30_day": lambda conditions: marts.readmission_30d(conditions.repartition(PERSON), unique_ids=True),
    # a row per stay and day: one per pair of stays grows with the square of a person's stays
    "readmission_days": lambda conditions: marts.readmission_pairs(conditions, per_day=True),
    "admission_count": marts.admission_count,
}
HEDIS = "hedis"
#: So many persons are sent to every task; the marts of more are built with those of their whole parts.
FEW_PERSONS = 50_000


def gold(root: str, name: str) -> str:
    return f"{root}/gold/{name}"


def by_person(root: str, table: str) -> str:
    return f"{root}/{table}_by_person"


def linked(spark: SparkSession, root: str, rows: DataFrame, parts: int) -> DataFrame:
    """`rows` with the linked person as `person_id`, and as `source_person` the one that the source names where it is another.

    A source person that no batch of person records has named stands for itself.
    """
    path = f"{root}/{PERSONS}/{growing.BY_ID}"
    if read_parts(spark, path, "id") is None:
        return rows.withColumn(SOURCE, F.lit(None).cast(rows.schema[PERSON].dataType))
    names = read_parts(spark, path, "id", touched_parts(rows, PERSON, parts))
    source, other = F.col("id").cast("string"), F.col("cluster_id").cast("string")
    names = names.filter(source != other).select(packed(source).alias("_id"), packed(other).alias("_linked"))
    found = rows.withColumn(PERSON, packed(F.col(PERSON))).join(names, F.col(PERSON) == F.col("_id"), "left")
    named = {PERSON: unpacked(F.coalesce("_linked", PERSON)), SOURCE: F.when(F.col("_linked").isNotNull(), unpacked(F.col(PERSON)))}
    return materialize(found.withColumns(named).select(*rows.columns, SOURCE), "linked")


class Moved:
    """Rows that go out and that come in, `delta`, as a change of a table's copy by person.

    `delta` has the copy's columns and `comes`. The marts of `persons`, by default its own, are built anew:
    from their rows alone where these are few, and else for all persons of their parts, which are rewritten anyhow.
    """

    def __init__(
        self, spark: SparkSession, root: str, table: str, delta: DataFrame, key: str, columns: list[str], parts: int,
        persons: DataFrame | None = None,
    ):
        known = delta.filter(F.col(PERSON).isNotNull())
        named = (known if persons is None else persons).select(PERSON)
        counts = named.groupBy(part_of(PERSON, parts).alias(PART)).agg(F.approx_count_distinct(PERSON).alias("n")).collect()
        self.touched = sorted(r[PART] for r in counts)
        few = sum(r["n"] for r in counts) <= FEW_PERSONS
        self.persons = materialize(named.distinct(), f"moved-{table}") if few else None
        self.path = by_person(root, table)
        held = read_parts(spark, self.path, PERSON, self.touched)
        own = known.select(*columns, SOURCE, "comes")
        whole = own if held is None else held.select(*columns, SOURCE).withColumn("comes", F.lit(None).cast("boolean")).unionByName(own)
        # a person may hold a large share of all rows: its rows are then dealt out by their key
        self.slices = Slices.counted(whole, PERSON, self.touched, parts)
        place, rest = [PART, PERSON, key, SLICE], [c for c in (*columns, SOURCE) if c not in (PERSON, key)]
        row, comes = F.struct(*rest), F.col("comes")
        # the copy's row, null `comes`, stays unless one goes out or another comes in
        packs = [c for c in texts(whole) if c in (PERSON, SOURCE)]
        found = spread(whole, self.path, PERSON, self.touched, parts, [key], packs, self.slices).groupBy(*place).agg(
            F.max(F.when(comes, row)).alias("new"), F.max(F.when(comes.isNull(), row)).alias("held"),
            F.count_if(~comes).alias("gone"))
        kept = F.coalesce("new", F.when(F.col("gone") == 0, F.col("held")))
        rows = found.withColumn("kept", kept).filter(F.col("kept").isNotNull())
        plain = rows.select(*[F.col(f"kept.{c}") if c in rest else c for c in (*columns, SOURCE)], PART)
        self.rows = stage_spread(plain.withColumns({c: unpacked(F.col(c)) for c in packs}), self.path, PERSON)

    @classmethod
    def by_merge(cls, spark: SparkSession, root: str, table: str, staged: Staged, key: str, columns: list[str], parts: int) -> Moved:
        # a row that comes in takes the place of its person's earlier one
        return cls(spark, root, table, linked(spark, root, staged.delta(key, columns, [PERSON]), parts), key, columns, parts)

    def mine(self, rows: DataFrame) -> DataFrame:
        """The rows of the persons whose marts are built anew, of rows in their parts."""
        return rows if self.persons is None else rows.join(F.broadcast(self.persons), PERSON, "left_semi")

    def others(self, rows: DataFrame) -> DataFrame | None:
        """The other persons' rows of a mart, None where there are none."""
        return None if self.persons is None else rows.join(F.broadcast(self.persons), PERSON, "left_anti")


def _no_tests(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MEASUREMENT)


def _built(build: Callable[..., DataFrame], *tables: DataFrame) -> DataFrame:
    """A mart of `tables`, whose persons are packed while rows are shuffled."""
    mart = build(*[t.withColumn(PERSON, packed(F.col(PERSON))) for t in tables])
    return mart.withColumn(PERSON, unpacked(F.col(PERSON)))


def _stage_mart(spark: SparkSession, root: str, name: str, mart: DataFrame, moved: Moved, parts: int) -> str:
    path = gold(root, name)
    held = read_parts(spark, path, PERSON, moved.touched)
    others = None if held is None else moved.others(held)
    stage(mart if others is None else others.unionByName(mart), path, PERSON, moved.touched, parts, moved.slices)
    return path


def stage_conditions(
    spark: SparkSession, root: str, merged: Staged, measurements: DataFrame | None = None, parts: int = PARTS
) -> list[str]:
    """Stage what a staged merge of conditions changes in Gold; the paths to commit with it.

    `measurements` is a table that is kept elsewhere: the whole mart of tests is then built
    anew, since it is not known what changed there.
    """
    moved = Moved.by_merge(spark, root, SILVER, merged, KEY, CONDITION_COLUMNS, parts)
    if not moved.touched and measurements is None:
        return []
    mine = moved.mine(moved.rows)
    built = {name: _built(build, mine) for name, build in CONDITION_MARTS.items()}
    tests = read_parts(spark, by_person(root, MEASUREMENTS), PERSON, moved.touched)
    if measurements is None:
        built[HEDIS] = _built(marts.hedis, mine, _no_tests(spark) if tests is None else moved.mine(tests))
    jobs = [partial(_stage_mart, spark, root, name, mart, moved, parts) for name, mart in built.items()]
    if measurements is not None:
        others = read_parts(spark, moved.path, PERSON, [p for p in range(parts) if p not in moved.touched])
        everyone = moved.rows if others is None else moved.rows.unionByName(others)
        jobs.append(partial(_stage_whole, marts.hedis(everyone, measurements), gold(root, HEDIS), parts))
    return [moved.path, *together(jobs)]


def _stage_whole(mart: DataFrame, path: str, parts: int) -> str:
    stage(mart, path, PERSON, range(parts), parts)
    return path


def stage_measurements(spark: SparkSession, root: str, merged: Staged, parts: int = PARTS) -> list[str]:
    """Stage what a staged merge of measurements changes in Gold; the paths to commit with it."""
    moved = Moved.by_merge(spark, root, MEASUREMENTS, merged, MEASUREMENT_KEY, MEASUREMENT_COLUMNS, parts)
    if not moved.touched:
        return []
    conditions = read_parts(spark, by_person(root, SILVER), PERSON, moved.touched)
    if conditions is None:  # the tests wait for their persons' conditions
        return [moved.path]
    mart = _built(marts.hedis, moved.mine(conditions), moved.mine(moved.rows))
    return [moved.path, _stage_mart(spark, root, HEDIS, mart, moved, parts)]


def stage_links(spark: SparkSession, root: str, renamed: DataFrame, parts: int = PARTS) -> list[str]:
    """Stage what other linked persons, `renamed` (source_person, old, new), change in Gold; the paths to commit."""
    persons = renamed.select(F.col("old").alias(PERSON)).union(renamed.select("new"))
    touched = touched_parts(renamed, "old", parts)
    moved = {}
    for table, key, columns in ((SILVER, KEY, CONDITION_COLUMNS), (MEASUREMENTS, MEASUREMENT_KEY, MEASUREMENT_COLUMNS)):
        held = read_parts(spark, by_person(root, table), PERSON, touched)
        if held is None or not touched:
            continue
        source = F.coalesce(SOURCE, PERSON)
        leaving = materialize(
            held.join(renamed.select(F.col(SOURCE).alias("_source"), "new"), source == F.col("_source")).drop("_source"),
            f"renamed-{table}")
        out = leaving.withColumn("comes", F.lit(False)).drop("new")
        other = F.when(source != F.col("new"), source)
        delta = out.unionByName(leaving.withColumns({SOURCE: other, PERSON: F.col("new"), "comes": F.lit(True)}).drop("new"))
        moved[table] = Moved(spark, root, table, delta, key, columns, parts, persons)
    if SILVER not in moved:
        return [m.path for m in moved.values()]
    conditions = moved[SILVER]
    mine = conditions.mine(conditions.rows)
    built = {name: _built(build, mine) for name, build in CONDITION_MARTS.items()}
    tests = moved[MEASUREMENTS].rows if MEASUREMENTS in moved else _no_tests(spark)
    built[HEDIS] = _built(marts.hedis, mine, conditions.mine(tests))
    jobs = [partial(_stage_mart, spark, root, name, mart, conditions, parts) for name, mart in built.items()]
    return [*[m.path for m in moved.values()], *together(jobs)]
