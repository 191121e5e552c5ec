"""Brings this package to the Python workers of a session."""

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import hirelens

# Kept until the program ends: the driver serves the archive to executors that start later.
_folders: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Give the package to all executors of the session, once; needless but harmless where it is installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _folders:
        return
    folder = _folders[sc.applicationId] = tempfile.TemporaryDirectory(prefix="hirelens-package-")
    root, archive = Path(hirelens.__file__).parent, Path(folder.name) / "hirelens.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, Path("hirelens") / module.relative_to(root))
    sc.addPyFile(str(archive))


def shipped(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``function``, whose first argument is the session, with the package shipped before it runs."""

    @functools.wraps(function)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship_package(spark)
        return function(spark, *args)

    return run
