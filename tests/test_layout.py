from types import SimpleNamespace

import pytest

from tributary.layout import Layout, scratch_path


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda name, default: folder if name == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_follows_the_cluster():
    first = scratch_path(session("yarn", "hdfs://host/checkpoints/"))
    second = scratch_path(session("yarn", "hdfs://host/checkpoints/"))
    assert first.startswith("hdfs://host/checkpoints/tributary-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("yarn"))
    assert "tributary-" in scratch_path(session("local[2]"))


def test_environments_do_not_share_tables():
    dev, prod = Layout("/lake"), Layout("/lake", "prod")
    assert dev.dead_letter == "/lake/dev/silver/dead_letter"
    assert prod.checkpoint("load") == "/lake/prod/checkpoints/load"
