"""Session settings: required settings fill gaps only; the checkpoint folder comes from the
session."""

from types import SimpleNamespace

import pytest

from planscore.session import REQUIRED_CONF, checkpoint_dir, ensure_conf


def test_ensure_conf_fills_unset_and_respects_explicit(spark):
    s = spark.newSession()   # own SQL conf, same context
    key = "spark.sql.sources.fileCompressionFactor"
    ensure_conf(s)
    assert s.conf.get(key) == REQUIRED_CONF[key]
    s2 = spark.newSession()
    s2.conf.set(key, "3.0")
    ensure_conf(s2)
    assert s2.conf.get(key) == "3.0"
    assert s2.conf.get("spark.sql.adaptive.enabled") == "true"


def test_checkpoint_dir_is_the_sessions(spark):
    d = checkpoint_dir(spark)
    assert d and d == checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or d == named


class _Session:
    """A session on ``master`` that names no shared folder."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = SimpleNamespace(getCheckpointDir=lambda: None, master=master)


def test_a_cluster_must_name_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError):
            checkpoint_dir(_Session(master))
    for master in ("local", "local[8]", "local[*]"):
        assert checkpoint_dir(_Session(master))
