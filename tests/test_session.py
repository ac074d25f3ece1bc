"""Where intermediate data goes."""

from types import SimpleNamespace

import pytest

from carelake.session import materialize, workspace


def fake(master, conf=None, checkpoint=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf or default),
        sparkContext=SimpleNamespace(
            master=master, applicationId="app", getCheckpointDir=lambda: checkpoint
        ),
    )


def test_the_clusters_folder_is_used():
    assert workspace(fake("yarn", conf="hdfs://x/shared/"), "p").startswith("hdfs://x/shared/p-")
    assert workspace(fake("yarn", checkpoint="hdfs://x/check"), "p").startswith("hdfs://x/check/p-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace(fake("spark://host:7077"), "p")


def test_materialized_rows_have_no_lineage(spark):
    df = spark.range(10).selectExpr("id", "id * 2 twice")
    kept = materialize(df, "session-test")
    assert kept.dtypes == df.dtypes
    assert sorted(kept.collect()) == sorted(df.collect())
    assert "Range" not in kept._jdf.queryExecution().toString()
