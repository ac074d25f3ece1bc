"""Numbered full copies of a table in a folder; readers take the newest finished one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_NAME = "snapshot="


def _folders(spark: SparkSession, path: str) -> tuple[object, dict[int, object]]:
    """The file system, and the folder of every finished snapshot."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return files, {}
    folders = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith(_NAME)]
    return files, {
        int(f.getName()[len(_NAME):]): f for f in folders
        if files.exists(jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))
    }


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest finished snapshot, or None where there is none."""
    _, finished = _folders(spark, path)
    return spark.read.parquet(f"{path}/{_NAME}{max(finished)}") if finished else None


def write_snapshot(df: DataFrame, path: str, keep: int | None = None) -> int:
    """Write `df` as the next snapshot; its number. One writer at a time.

    An unfinished folder of that number, left by a job that died, is written over.
    `keep` removes all but so many of the newest snapshots afterwards; keep as many
    as the longest reader needs.
    """
    if keep is not None and keep < 1:
        raise ValueError("write_snapshot: keep is at least 1")
    files, finished = _folders(df.sparkSession, path)
    number = max(finished, default=0) + 1
    df.write.mode("overwrite").parquet(f"{path}/{_NAME}{number}")
    if keep is not None:
        for old in sorted(finished)[: max(len(finished) + 1 - keep, 0)]:
            files.delete(finished[old], True)
    return number
