"""Session helpers: settings sized from the input, the checkpoint folder from the session."""

import pytest

from orderflow.session import apply_settings, checkpoint_root, cluster_settings, scratch_path


def test_cluster_settings_sized_from_input():
    s = cluster_settings(100 * (1 << 40))          # 100 TB
    assert int(s["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert s["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_settings(None)["spark.sql.shuffle.partitions"]) == 200


def test_apply_settings_warns_of_static_ones_and_scratch_is_under_checkpoint_dir(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.warns(UserWarning, match="spark.sql.warehouse.dir"):
        apply_settings(spark, {"spark.sql.shuffle.partitions": before, "spark.sql.warehouse.dir": "/elsewhere"})
    root = checkpoint_root(spark)
    assert scratch_path(spark, "x").startswith(root + "/orderflow/x-")


class _Conf(dict):
    set = dict.__setitem__


class _Session:
    """A session on a cluster without a checkpoint folder."""

    conf = _Conf({"spark.master": "spark://host:7077"})

    class sparkContext:  # noqa: N801
        @staticmethod
        def getCheckpointDir():
            return None


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session())
