import os
from types import SimpleNamespace

import pytest
from compare import rows_of_spark

from kinrank.session import ensure_checkpoint_dir, forget, release_tables, scratch, written


def fake(master, conf):
    context = SimpleNamespace(
        master=master,
        folder=None,
        getConf=lambda: SimpleNamespace(get=conf.get),
        getCheckpointDir=lambda: context.folder,
        setCheckpointDir=lambda folder: setattr(context, "folder", folder),
    )
    return SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default)
    )


def test_the_named_folder_is_used():
    session = fake("yarn", {"spark.checkpoint.dir": "hdfs://shared/checkpoints"})
    ensure_checkpoint_dir(session)
    assert session.sparkContext.folder == "hdfs://shared/checkpoints"


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake("yarn", {}))


def test_a_local_session_gets_its_own():
    session = fake("local[2]", {})
    ensure_checkpoint_dir(session)
    first = session.sparkContext.folder
    ensure_checkpoint_dir(session)
    assert first and session.sparkContext.folder == first


def test_written(spark, frame):
    ratings = frame([(1, 2, 3.0), (1, 3, 4.0)])
    table = written(ratings)
    assert table.dtypes == ratings.dtypes
    assert rows_of_spark(table) == rows_of_spark(ratings)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert all(folder in file for file in table.inputFiles())


def _there(table):
    return os.path.isdir(table.written_path.removeprefix("file:"))


def test_tables_go_when_they_are_done_with(spark, frame):
    ratings = frame([(1, 2, 3.0)])
    before = written(ratings)
    with scratch(spark):
        inside = written(ratings)
        assert inside.count() == 1
    assert _there(before) and not _there(inside)
    forget(before)
    assert not _there(before)


def test_all_tables_of_a_session_can_be_released(spark, frame):
    table = written(frame([(1, 2, 3.0)]))
    release_tables(spark)
    assert not _there(table)
    assert written(frame([(1, 2, 3.0)])).count() == 1
