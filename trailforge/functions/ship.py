"""Hands this package to the executors, for functions in Python that they must import."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query that ships the package before it is planned."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args: object) -> DataFrame:
        ship(spark)
        return query(spark, *args)

    return run
