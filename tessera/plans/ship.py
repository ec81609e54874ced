"""The package's own files on every executor, wherever the session's workers look for modules."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_SENT: set[str] = set()


def send(spark: SparkSession) -> None:
    """Once per application: the package as an archive that Spark hands to its workers."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    where = tempfile.mkdtemp(prefix="tessera-code-")
    os.makedirs(f"{where}/x")
    shutil.copytree(f"{root}/tessera", f"{where}/x/tessera", ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(f"{where}/tessera-package", "zip", f"{where}/x"))
    _SENT.add(app)


def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        send(spark)
        return f(spark, sf_dir)

    return run
