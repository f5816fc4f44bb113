"""Sessions keep their settings; scratch folders must be shared."""

from types import SimpleNamespace

import pytest

from ashgrid.session import checkpoint_root, get_session


def test_an_existing_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        again = get_session("local[2]")
        assert again.conf.get("spark.sql.session.timeZone") == "America/Sao_Paulo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def fake(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default,
                           set=lambda key, value: None)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(
        master=master, getCheckpointDir=lambda: folder, setCheckpointDir=lambda d: None))


def test_a_cluster_must_name_a_shared_folder():
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(fake(master))
        assert checkpoint_root(fake(master, "hdfs:///shared/")) == "hdfs:///shared"
    assert checkpoint_root(fake("local[4]"))
