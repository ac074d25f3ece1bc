"""Zone tables: read, append, replace. Any catalog format works; Parquet is the default."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T


def create_zone(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def read_table(spark: SparkSession, name: str, fmt: str | None = None) -> DataFrame:
    """A catalog table by name, or a path in a file format."""
    return spark.read.format(fmt).load(name) if fmt else spark.table(name)


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
    partition_by: Sequence[str] = (), location: str | None = None,
) -> None:
    """Create a table if it is absent.

    Formats with hidden partitioning take a transform such as
    `days(ingestion_timestamp)`; for Parquet name a column such as `ingestion_date`.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{partitions}{place}")


def append_table(df: DataFrame, name: str) -> None:
    """Append by column name. An append repeated is a duplicate: merge where runs may repeat."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Materialize a mart, replacing the last build."""
    df.write.format(fmt).mode("overwrite").saveAsTable(name)


def append_files(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def replace_files(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Overwrite the partitions that `df` holds and leave the others as they are."""
    writer = _writer(df, fmt).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).save(path)


def replace_partition(df: DataFrame, path: str, partition: Mapping[str, object], fmt: str = "parquet") -> None:
    """Overwrite one named partition with `df`, which does not hold its columns; with no rows it becomes empty.

    An overwrite of the partitions that a frame holds would leave the old rows of one
    that has no rows any more.
    """
    place = "/".join(f"{quote(k, safe='')}={quote(str(v), safe='')}" for k, v in partition.items())
    _writer(df, fmt).save(f"{path}/{place}")


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    writer = df.write.format(fmt).mode("overwrite")
    return writer.option("compression", "zstd") if fmt == "parquet" else writer  # digests take half the bytes
