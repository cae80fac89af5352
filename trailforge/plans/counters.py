"""Counters of a job that are taken while its own pass runs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
_EMPTY = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


class Counters:
    """Named counts over tables that a job goes through; they are there once its rows have been written."""

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        """`df`, which counts its rows on the way."""
        seen = Observation()
        for name in counts:
            self._watched[name] = seen
        return df.observe(seen, *[c.alias(name) for name, c in counts.items()])

    @contextmanager
    def counting(self, spark: SparkSession) -> Iterator[None]:
        """The pass runs in here: a part of the plan that turns out to be empty is not cut off with its counts."""
        before = spark.conf.get(_EXCLUDED, "")
        spark.conf.set(_EXCLUDED, ",".join(filter(None, (before, _EMPTY))))
        try:
            yield
        finally:
            spark.conf.set(_EXCLUDED, before) if before else spark.conf.unset(_EXCLUDED)

    def read(self) -> dict[str, int]:
        """Every count; waits for the pass."""
        return {name: seen.get[name] or 0 for name, seen in self._watched.items()}
