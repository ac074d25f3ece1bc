"""Expressions over raw payload lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(*parts: Column) -> Column:
    """Stable id of a payload: the same content from the same place keeps its id.

    Parts are joined with a unit separator; a null part counts as empty text.
    """
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("\u001f", *texts), 256)
