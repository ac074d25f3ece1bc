"""Data-quality metrics, check report, circuit breaker and dead-letter routing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from carelake.schemas import require_columns


class QualityBreach(RuntimeError):
    """A checked table failed an error-level check."""


@dataclass(frozen=True)
class Complete:
    """The column is never null."""

    column: str

    @property
    def name(self) -> str:
        return f"complete({self.column})"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class NonNegative:
    """The column is null or at least 0."""

    column: str

    @property
    def name(self) -> str:
        return f"non_negative({self.column})"

    def broken(self) -> Column:
        return F.coalesce(F.col(self.column) < 0, F.lit(False))


@dataclass(frozen=True)
class Satisfies:
    """A predicate on a row; null counts as satisfied."""

    label: str
    predicate: str

    @property
    def name(self) -> str:
        return f"satisfies({self.label})"

    def broken(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(True))


@dataclass(frozen=True)
class Unless:
    """Another rule, which rows that satisfy `predicate` need not keep."""

    rule: Complete | NonNegative
    predicate: str

    @property
    def name(self) -> str:
        return self.rule.name

    @property
    def column(self) -> str:
        return self.rule.column

    def broken(self) -> Column:
        return self.rule.broken() & ~F.coalesce(F.expr(self.predicate), F.lit(False))


Rule = Complete | NonNegative | Satisfies | Unless

KEY_RULES: tuple[Rule, ...] = (Complete("person_id"), Complete("condition_occurrence_id"))
CONDITION_RULES: tuple[Rule, ...] = (*KEY_RULES, NonNegative("condition_concept_id"))
# The image before a delete may hold the key only.
CHANGE_RULES: tuple[Rule, ...] = (
    Unless(Complete("person_id"), "cdc_op = 'd'"), Complete("condition_occurrence_id"),
    Unless(NonNegative("condition_concept_id"), "cdc_op = 'd'"),
)
MEASUREMENT_RULES: tuple[Rule, ...] = (
    Unless(Complete("person_id"), "cdc_op = 'd'"), Complete("measurement_id"),
    Unless(Complete("measurement_date"), "cdc_op = 'd'"), Unless(NonNegative("measurement_concept_id"), "cdc_op = 'd'"),
)
NOT_IN_FUTURE = Satisfies("start_not_in_future", "condition_start_date <= current_date()")


def _require(df: DataFrame, rules: Sequence[Rule], operator: str) -> None:
    require_columns(df, [r.column for r in rules if not isinstance(r, Satisfies)], operator)


def _measures(rules: Sequence[Rule]) -> list[Column]:
    broken = [F.count_if(r.broken()).alias(r.name) for r in rules]
    return [F.count(F.lit(1)).alias("size"), *broken]


def metrics(df: DataFrame, rules: Sequence[Rule] = CONDITION_RULES) -> DataFrame:
    """One row: the table's size and, per rule, how many rows break it. One pass."""
    _require(df, rules, "metrics")
    return df.agg(*_measures(rules))


def report(
    df: DataFrame, rules: Sequence[Rule] = CONDITION_RULES, min_size: int = 1,
    check: str = "condition quality", level: str = "Error",
) -> DataFrame:
    """One row per check: whether it holds, and the measured value.

    The value is the row count for the size check, the share of rows that hold a
    value for completeness, and else the share of rows that satisfy the rule. Shares
    of an empty table are null and its rules hold.
    """
    return _report_of(metrics(df, rules), rules, min_size, check, level)


def _report_of(
    measured: DataFrame, rules: Sequence[Rule], min_size: int, check: str, level: str
) -> DataFrame:
    def line(constraint: str, passed: Column, metric: Column, message: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"), F.lit(level).alias("check_level"),
            F.lit(constraint).alias("constraint"),
            F.when(passed, "Success").otherwise("Failure").alias("constraint_status"),
            metric.cast("double").alias("metric"),
            F.when(~passed, message).alias("message"),
        )

    size = F.col("size")
    lines = [line(
        f"size >= {min_size}", size >= min_size, size,
        F.concat(size.cast("string"), F.lit(f" rows, at least {min_size} required")),
    )]
    for rule in rules:
        bad = F.col(f"`{rule.name}`")
        lines.append(line(
            rule.name, bad == 0, F.try_divide(size - bad, size),
            F.concat(bad.cast("string"), F.lit(" rows break the rule")),
        ))
    return measured.select(F.inline(F.array(*lines)))


def require_quality(checks: DataFrame) -> None:
    """Circuit breaker: stop with the failed checks of a `report`, if there are any.

    The report has one row per check, so the driver receives no table data.
    """
    failed = checks.filter(F.col("constraint_status") == "Failure").collect()
    if failed:
        raise QualityBreach("; ".join(f"{r['constraint']}: {r['message']}" for r in failed))


def observed(
    df: DataFrame, rules: Sequence[Rule] = CONDITION_RULES, name: str = "quality"
) -> tuple[DataFrame, Observation]:
    """`df` with its metrics measured by whatever action runs it next, without another scan."""
    _require(df, rules, "observed")
    observation = Observation(name)
    return df.observe(observation, *_measures(rules)), observation


def tagged(df: DataFrame, rules: Sequence[Rule] = CONDITION_RULES) -> DataFrame:
    """`df` with `reasons`, the names of the rules each row breaks; empty for a valid row."""
    _require(df, rules, "tagged")
    hits = F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules])
    return df.withColumn("reasons", F.array_compact(hits))


def _any_broken(rules: Sequence[Rule]) -> Column:
    broken = F.lit(False)
    for rule in rules:
        broken = broken | rule.broken()
    return broken


def valid_rows(df: DataFrame, rules: Sequence[Rule] = CONDITION_RULES) -> DataFrame:
    """Rows that break no rule."""
    _require(df, rules, "valid_rows")
    return df.filter(~_any_broken(rules))


def dead_letters(df: DataFrame, rules: Sequence[Rule] = CONDITION_RULES) -> DataFrame:
    """Rows that break a rule, with the reasons. With `valid_rows` an exact partition."""
    _require(df, rules, "dead_letters")
    return tagged(df.filter(_any_broken(rules)), rules)
