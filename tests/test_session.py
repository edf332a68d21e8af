import types

import pytest

from lodeweave.session import SharedPath, discard, materialize, shared_folder


def test_a_cluster_needs_a_shared_folder():
    conf = types.SimpleNamespace(get=lambda key, default=None: default)
    context = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(types.SimpleNamespace(conf=conf, sparkContext=context))
    context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        shared_folder(types.SimpleNamespace(conf=conf, sparkContext=context))


def test_superseded_tables_are_deleted(spark):
    df = materialize(spark.range(3))
    path = SharedPath(spark, df._lodeweave_path)
    assert df.count() == 3 and path.exists()
    discard(df)
    assert not path.exists()
    discard(spark.range(3))


def test_files_are_replaced_whole(spark, tmp_path):
    path = SharedPath(spark, f"file://{tmp_path}/a/b")
    path.write("one")
    path.write("two é")
    assert path.read() == "two é" and SharedPath(spark, f"file://{tmp_path}/a").names() == ["b"] and SharedPath(spark, f"file://{tmp_path}/none").names() == []
