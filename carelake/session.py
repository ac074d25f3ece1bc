"""Session settings, and the shared folder that jobs may write intermediate data to."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "carelake", **conf: str) -> SparkSession:
    """A session for tests and the benchmark. On a cluster, use the cluster's own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="carelake-")


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder of `spark.checkpoint.dir`.

    Every executor must see it, so a machine-local folder is only made up for a
    local master without that setting. What is written there is not removed; clean
    the folder as any checkpoint folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _own_folder(context.applicationId)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back.

    Unlike blocks cached on executors, the files outlive a lost executor, and the
    planner sees their size.
    """
    path = workspace(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)  # written once and read a few times
    return df.sparkSession.read.schema(df.schema).parquet(path)
