"""Role-dependent masks.

A masked view is a convenience, not a security boundary: whoever may read the base
table sees the clear values. Grant the view and keep the table closed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.deid import masked

# The mask of each sensitive column, and the role that sees it clear.
MASKS = {"ssn": "***-**-****", "mrn": "REDACTED_MRN", "person_id": "REDACTED"}
CLEAR_ROLES = ("DATA_ENGINEER",)
ROLE_VARIABLE = "carelake_role"


def mask_for(
    df: DataFrame, role: str | None, masks: Mapping[str, str] = MASKS,
    clear_roles: Sequence[str] = CLEAR_ROLES,
) -> DataFrame:
    """`df` as `role` may see it. Any role not listed, none included, gets the masks."""
    role_column = F.lit(role).cast("string")
    return df.select(*[
        masked(F.col(c), role_column, masks[c], clear_roles).alias(c) if c in masks else F.col(c)
        for c in df.columns
    ])


def set_role(spark: SparkSession, role: str | None) -> None:
    """Set the session's role, which masked views read anew in every query."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING")
    if role is not None:
        spark.sql(f"SET VARIABLE {ROLE_VARIABLE} = :role", {"role": role})


def create_masked_view(
    spark: SparkSession, table: str, view: str, masks: Mapping[str, str] = MASKS,
    clear_roles: Sequence[str] = CLEAR_ROLES,
) -> None:
    """A temporary view of `table` masked by the session's role. Call `set_role` first."""
    df = spark.table(table)
    roles = ", ".join(f"'{r.upper()}'" for r in clear_roles)
    columns = [
        f"CASE WHEN upper(session.{ROLE_VARIABLE}) IN ({roles}) "
        f"THEN cast(`{c}` AS STRING) ELSE '{masks[c]}' END AS `{c}`" if c in masks else f"`{c}`"
        for c in df.columns
    ]
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {', '.join(columns)} FROM {table}")
