import types

import pytest

from cadence.session import checkpoint_dir


def test_checkpoint_dir_respects_the_configured_folder(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    got = checkpoint_dir(spark)
    if configured:
        # Spark adds a per-application subfolder under the configured folder
        assert configured.rstrip("/").split(":")[-1] in got


def test_cluster_without_a_shared_folder_is_an_error():
    undefined = types.SimpleNamespace(isDefined=lambda: False)
    context = types.SimpleNamespace(
        master="spark://host:7077", getConf=lambda: {},
        _jsc=types.SimpleNamespace(sc=lambda: types.SimpleNamespace(
            getCheckpointDir=lambda: undefined)))
    session = types.SimpleNamespace(conf={}, sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)


def test_session_defaults(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
