"""Intermediate results kept as Parquet in the shared checkpoint folder.

A staged table survives the loss of executors and is read back column by
column; nothing is kept in a machine-local folder on a cluster.
"""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; where none is named, one below the warehouse folder.

    On a cluster a warehouse folder on the machine's own disk is refused: executors would not see one another's files.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    return below_warehouse(spark.conf.get("spark.sql.warehouse.dir"), sc.master)


def below_warehouse(warehouse: str, master: str) -> str:
    # Spark writes the scheme of a local folder with the setting; a path without one is of the default file system.
    if warehouse.startswith("file:") and not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_staged"


# Each thread and context has its own open scope.
_scope: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system takes it."""
    sc = spark.sparkContext
    found = sc._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(sc._jsc.hadoopConfiguration()), found


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder in the shared place, deleted with the open scope or else when the program ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    fs, folder = hadoop_path(spark, path)
    fs.mkdirs(folder)
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    else:
        fs.deleteOnExit(folder)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back."""
    path = f"{scratch_path(df.sparkSession, label)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = hadoop_path(spark, path)
    fs.delete(folder, True)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when the block ends, that is after its results are stored."""
    staged: list[str] = []
    token = _scope.set(staged)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in staged:
            delete(spark, path)
