"""Gold marts over `condition_occurrence` and `measurement`.

A person may hold a large share of all rows. Where rows of one person have to meet,
they are first reduced to one row per person and day, which the calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.schemas import require_columns

# Fixed values of the vocabulary.
INPATIENT_VISIT = 9201
DIABETES = 201820
HBA1C = 3004410

READMISSION_DAYS = 30

# Longest array a copy of equal readmissions is expanded from.
_EXPANSION = 10_000


def hedis(
    conditions: DataFrame, measurements: DataFrame, condition_concept: int = DIABETES,
    measurement_concept: int = HBA1C, latest: bool = False,
) -> DataFrame:
    """Per person with the condition: whether the test was done, its last date and value.

    `last_test_value` is the highest value of any date; with `latest` it is the value
    of the last date, the highest one where a day has several.
    """
    require_columns(conditions, ["person_id", "condition_concept_id"], "hedis")
    require_columns(
        measurements,
        ["person_id", "measurement_concept_id", "measurement_date", "value_as_number"], "hedis",
    )
    persons = (
        conditions.filter(F.col("condition_concept_id") == condition_concept)
        .select("person_id").distinct()
    )
    value = F.max("value_as_number")
    if latest:
        value = F.max(F.struct("measurement_date", "value_as_number"))["value_as_number"]
    tests = (
        measurements.filter(F.col("measurement_concept_id") == measurement_concept)
        .filter(F.col("person_id").isNotNull())
        .groupBy("person_id")
        .agg(
            F.lit(1).alias("had_hba1c_test"),
            F.max("measurement_date").alias("last_test_date"),
            value.alias("last_test_value"),
        )
    )
    return persons.join(tests, "person_id", "left").select(
        "person_id",
        F.coalesce("had_hba1c_test", F.lit(0)).alias("had_hba1c_test"),
        "last_test_date", "last_test_value",
    )


def readmission_pairs(
    conditions: DataFrame, concept: int = INPATIENT_VISIT, days: int = READMISSION_DAYS,
    per_day: bool = False,
) -> DataFrame:
    """Inpatient stays with each readmission up to `days` days after the discharge.

    One row per stay and readmission, and one with a null readmission for a stay
    without any. That is a row per pair, which for a person with very many stays a day
    is far more than there are stays: `per_day` gives a row per stay and day of
    readmission instead, at most `days` of them, with the number of readmissions as
    `n_readmissions`.

    Readmissions are first counted per person and day. Days are cut into blocks of
    `days` days, and each block is given the days of the next one too, so the window
    of a stay lies in one block. The join is on person and block: a stay meets at most
    2 x `days` rows, and a person with very many stays is spread over the blocks.
    """
    require_columns(
        conditions,
        ["person_id", "condition_start_date", "condition_end_date", "condition_concept_id"],
        "readmission_pairs",
    )
    stays = conditions.filter(F.col("condition_concept_id") == concept)

    def block(day: Column) -> Column:
        return F.floor(F.unix_date(day) / days)

    start, end = F.col("condition_start_date").cast("date"), F.col("condition_end_date").cast("date")
    day_counts = (
        stays.filter(F.col("person_id").isNotNull() & start.isNotNull())
        .groupBy("person_id", start.alias("readmission_date"))
        .agg(F.count(F.lit(1)).alias("stays"))
    )
    day_block = block(F.col("readmission_date"))
    later = day_counts.withColumn("block", F.explode(F.array(day_block, day_block - 1))).alias("r")
    index = stays.select(
        "person_id", start.alias("admission_date"), end.alias("discharge_date"),
        block(F.date_add(end, 1)).alias("block"),
    ).alias("i")
    discharge, day = F.col("discharge_date"), F.col("readmission_date")
    on = [
        F.col("i.person_id") == F.col("r.person_id"), F.col("i.block") == F.col("r.block"),
        day > discharge, day <= F.date_add(discharge, days),
    ]
    matched = index.join(later, on, "left").select(
        "i.person_id", "admission_date", "discharge_date", "readmission_date", "stays"
    )
    flag = F.when(day.isNotNull(), 1).otherwise(0)
    columns = ["person_id", "admission_date", "discharge_date", "readmission_date"]
    if per_day:
        return matched.select(
            *columns, flag.alias("is_readmitted_30_days"),
            F.coalesce(F.col("stays"), F.lit(0)).alias("n_readmissions"),
        )
    # Back to one row per readmission, in chunks that keep the arrays short when one
    # day of a person holds very many stays.
    number = F.coalesce(F.col("stays"), F.lit(1))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), number - 1, F.lit(_EXPANSION).cast("bigint")))
    in_chunk = F.least(number - F.col("chunk"), F.lit(_EXPANSION)).cast("int")
    return matched.withColumn("chunk", chunk).select(
        *columns, F.explode(F.array_repeat(flag, in_chunk)).alias("is_readmitted_30_days")
    )


def _starts(conditions: DataFrame) -> DataFrame:
    columns = ["person_id", "condition_occurrence_id", "condition_start_date"]
    require_columns(conditions, columns, "readmissions")
    return conditions.select(
        "person_id",
        F.col("condition_occurrence_id").alias("id"),
        F.col("condition_start_date").cast("date").alias("day"),
    ).dropna()


def _around(days: int) -> tuple[Column, Column]:
    """Frames over one person's days: the `days` days after a day, and those before."""
    by_day = Window.partitionBy("person_id").orderBy(F.unix_date("day"))
    return by_day.rangeBetween(1, days), by_day.rangeBetween(-days, -1)


def _with_rate(totals: DataFrame) -> DataFrame:
    n, m = F.col("total_index_admissions"), F.col("total_30_day_readmissions")
    rate = F.when(n > 0, m.cast("double") / n).otherwise(F.lit(0.0))
    return totals.withColumn("readmission_rate", rate)


def _all_persons(totals: DataFrame, conditions: DataFrame) -> DataFrame:
    persons = conditions.select("person_id").filter(F.col("person_id").isNotNull()).distinct()
    counts = ["total_index_admissions", "total_30_day_readmissions", "readmission_rate"]
    return persons.join(totals, "person_id", "left").fillna(0, counts)


def readmission_30d(
    conditions: DataFrame, days: int = READMISSION_DAYS, unique_ids: bool = False,
    include_all: bool = False,
) -> DataFrame:
    """Per person: occurrences followed by another one within `days` days, such
    followers, and their ratio. Persons without any are absent, or have zeros with
    `include_all`.

    Pairs are never formed. A window over the person's days tells which ids lie
    within reach of a day: an occurrence has a follower if the smallest or the
    largest id in reach is not its own. `unique_ids` says that no id repeats, as
    after a merge; a count per day and its neighbouring days then suffice, and the
    rows are shuffled once instead of four times.
    """
    starts = _starts(conditions)
    totals = _totals_of_unique(starts, days) if unique_ids else _totals_of_any(starts, days)
    totals = _with_rate(totals)
    return _all_persons(totals, conditions) if include_all else totals


def _totals_of_unique(starts: DataFrame, days: int) -> DataFrame:
    """The nearest other days decide: any further one is out of reach if they are."""
    per_day = starts.groupBy("person_id", "day").agg(F.count(F.lit(1)).alias("n"))
    by_day = Window.partitionBy("person_id").orderBy("day")
    seen = per_day.select(
        "person_id", "n",
        (F.date_diff(F.lead("day").over(by_day), "day") <= days).alias("followed"),
        (F.date_diff("day", F.lag("day").over(by_day)) <= days).alias("follows"),
    )
    return seen.groupBy("person_id").agg(
        F.sum(F.when(F.col("followed"), F.col("n")).otherwise(0)).alias("total_index_admissions"),
        F.sum(F.when(F.col("follows"), F.col("n")).otherwise(0)).alias("total_30_day_readmissions"),
    ).filter(F.col("total_index_admissions") > 0)


def _totals_of_any(starts: DataFrame, days: int) -> DataFrame:
    after, before = _around(days)
    starts = starts.distinct()
    reach = starts.groupBy("person_id", "day").agg(
        F.min("id").alias("low"), F.max("id").alias("high")
    ).select(
        "person_id", "day",
        F.min("low").over(after).alias("after_low"), F.max("high").over(after).alias("after_high"),
        F.min("low").over(before).alias("before_low"), F.max("high").over(before).alias("before_high"),
    )

    def other(low: str, high: str) -> Column:
        differs = (F.col(low) != F.col("id")) | (F.col(high) != F.col("id"))
        return F.coalesce(differs, F.lit(False)).cast("int")

    flagged = starts.join(reach, ["person_id", "day"]).select(
        "person_id", "id",
        other("after_low", "after_high").alias("is_index"),
        other("before_low", "before_high").alias("is_again"),
    )
    # An id may lie on several days; it counts once.
    per_id = flagged.groupBy("person_id", "id").agg(
        F.max("is_index").alias("is_index"), F.max("is_again").alias("is_again")
    )
    return per_id.groupBy("person_id").agg(
        F.sum("is_index").alias("total_index_admissions"),
        F.sum("is_again").alias("total_30_day_readmissions"),
    ).filter(F.col("total_index_admissions") > 0)


def readmission_intervals(conditions: DataFrame, days: int = READMISSION_DAYS) -> DataFrame:
    """Per person: number of (index, follower) pairs, and the least, the greatest and
    the mean days between them. Ids must be unique.

    Sums over the window of a day stand for its pairs, so none is formed.
    """
    after, _ = _around(days)
    number = F.unix_date("day").cast("bigint")
    per_day = _starts(conditions).groupBy("person_id", "day").agg(F.count(F.lit(1)).alias("n"))
    reach = per_day.select(
        "person_id", "n", number.alias("number"),
        F.sum("n").over(after).alias("later_n"),
        F.sum(F.col("n") * number).over(after).alias("later_sum"),
        F.min(number).over(after).alias("nearest"), F.max(number).over(after).alias("farthest"),
    ).filter(F.col("later_n") > 0)
    pairs = F.col("n") * F.col("later_n")
    gaps = F.col("n") * (F.col("later_sum") - F.col("number") * F.col("later_n"))
    return reach.groupBy("person_id").agg(
        F.sum(pairs).alias("n_pairs"),
        F.min(F.col("nearest") - F.col("number")).cast("int").alias("min_days_to_readmit"),
        F.max(F.col("farthest") - F.col("number")).cast("int").alias("max_days_to_readmit"),
        (F.sum(gaps).cast("double") / F.sum(pairs)).alias("mean_days_to_readmit"),
    )


def admission_count(conditions: DataFrame, min_count: int = 0) -> DataFrame:
    """Occurrences per person; `min_count` keeps persons with at least that many."""
    require_columns(conditions, ["person_id", "condition_occurrence_id"], "admission_count")
    counts = conditions.groupBy("person_id").agg(
        F.count("condition_occurrence_id").alias("admission_count")
    )
    return counts.filter(F.col("admission_count") >= min_count) if min_count else counts
