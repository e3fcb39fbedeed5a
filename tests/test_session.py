"""Scratch data goes to the folder the cluster names; only a local master may do without."""

from types import SimpleNamespace

import pytest

from reelmart.session import checkpoint_root


def _session(master, conf=None, folder=None):
    set_to = []
    sc = SimpleNamespace(master=master, getConf=lambda: {"spark.checkpoint.dir": conf} if conf else {},
                         getCheckpointDir=lambda: folder, setCheckpointDir=set_to.append)
    return SimpleNamespace(sparkContext=sc), set_to


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_session(master)[0])


def test_the_named_folder_is_used():
    session, set_to = _session("yarn", "hdfs://shared/ckpt/")
    assert checkpoint_root(session) == "hdfs://shared/ckpt" and set_to == ["hdfs://shared/ckpt/"]


def test_a_local_master_gets_a_scratch_folder():
    session, set_to = _session("local[4]")
    assert checkpoint_root(session) and set_to
