"""Session settings, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g"):
    """A one-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kinrank")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a cluster a
    machine-local folder would be lost with the executor that wrote it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="kinrank-checkpoint-")
    context.setCheckpointDir(shared)


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application's tables beside its checkpoints."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(frame: DataFrame) -> DataFrame:
    """``frame`` as a table written once to the shared checkpoint folder.

    For derived input that several branches of a plan read: unlike a cache it outlives lost
    executors, and later scans read only the columns they need. The table stays until
    ``forget``, the end of a ``scratch`` block, or ``release_tables``.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table.written_path = path
    for block in _OPEN_BLOCKS:
        block.append(path)
    return table


def forget(table: DataFrame) -> None:
    """Delete what ``written`` wrote; nothing that reads the table may run after."""
    _delete(table.sparkSession, table.written_path)


def release_tables(spark: SparkSession) -> None:
    """Delete all tables of this application, when no result that reads them is open.

    To be called before a session is stopped that others with the same folder outlive.
    """
    if spark.sparkContext.getCheckpointDir() is not None:
        _delete(spark, shared_folder(spark))


_OPEN_BLOCKS: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables written inside the block when it ends; use up results inside."""
    paths: list[str] = []
    _OPEN_BLOCKS.append(paths)
    try:
        yield
    finally:
        _OPEN_BLOCKS.remove(paths)
        for path in paths:
            _delete(spark, path)
