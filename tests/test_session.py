"""Where snapshots go."""

from __future__ import annotations

from baton.session import SNAPSHOT_PREFIX, checkpoint_root, new_snapshot_path


def test_root_is_the_sessions_shared_folder(spark):
    root = checkpoint_root(spark)
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root == named


def test_paths_are_fresh_with_one_slash(spark, tmp_dir):
    a = new_snapshot_path(spark, tmp_dir)
    b = new_snapshot_path(spark, tmp_dir + "/")
    assert a != b
    for p in (a, b):
        assert p.startswith(tmp_dir + "/" + SNAPSHOT_PREFIX)
        assert "//" not in p
    assert new_snapshot_path(spark).startswith(checkpoint_root(spark).rstrip("/") + "/" + SNAPSHOT_PREFIX)


def test_no_folder_is_made_up(spark, monkeypatch):
    import pytest

    import baton.session as session

    class Unset:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None), "master": "local[2]"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Unset)


def test_the_sessions_own_file_system_settings_count(spark):
    from baton.session import _hadoop_path
    spark.conf.set("spark.hadoop.baton.test.key", "context")  # not a Hadoop setting once the context runs
    spark.conf.set("baton.test.key", "session")
    _, fs = _hadoop_path(spark, "file:///tmp")
    assert spark._jsparkSession.sessionState().newHadoopConf().get("baton.test.key") == "session"
    assert fs is not None
