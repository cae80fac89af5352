"""Unique visitors of partitions and over all of them, over streams, by HyperLogLog sketches.

Sketches are Spark's own and live in the state store: the aggregation by part, or by part and
epoch where parts can be reset, is in complete mode, so that totals are over all parts after a
restart as well, and at each tick whether events came or not (`with_ticks`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trailforge.functions.ship import ship
from trailforge.streaming.state import frame

RESET = "reset"
EPOCHS = "part string, epoch long, user string"


def app_events(lines: DataFrame, part_at: int, user_at: int, regex: str = r"\s+") -> DataFrame:
    """part, user of each line; lines that are too short are dropped."""
    field = lambda i: F.get(F.split("value", regex), i)
    return lines.select(field(part_at).alias("part"), field(user_at).alias("user")).where("part is not null and user is not null")


def counts(events: DataFrame, bits: int = 12, least: int = 0) -> DataFrame:
    """part, users, sketch of every part with more than `least` events, by Spark's own sketch; for complete or update mode."""
    sketched = events.where("part is not null").groupBy("part").agg(F.hll_sketch_agg("user", F.lit(bits)).alias("sketch"), F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    return sketched.select("part", F.hll_sketch_estimate("sketch").alias("users"), "sketch")


def totals(counted: DataFrame) -> DataFrame:
    """One row: time in ms, the sum of the parts' estimates, and the estimate of their union. For whatever parts a trigger has."""
    found = counted.agg(F.sum("users").alias("users"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("union_users")).where("users is not null")
    return found.select(F.unix_millis(F.current_timestamp()).alias("ms"), "users", "union_users")


def totals_sink(write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that hands the totals of each batch of `counts` (complete mode) to `write`."""
    return lambda batch, number: write(totals(batch), number)


def total_lines(totals: DataFrame) -> DataFrame:
    """`<ms>  <users>` lines of `totals`."""
    return totals.select(F.concat_ws("  ", F.col("ms").cast("string"), F.col("users").cast("string")).alias("value"))


def with_ticks(events: DataFrame, seconds: int) -> DataFrame:
    """`events` and a row without a part every so many seconds, so that a trigger always has something to report on."""
    clock = events.sparkSession.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("advanceMillisPerBatch", seconds * 1000).load()
    return events.unionByName(clock.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema]))


class _Epochs(StatefulProcessor):
    """Numbers the times between resets of a part."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("epoch", "epoch long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        epoch = self.held.get()[0] if self.held.exists() else 0
        came = pd.concat(list(rows), ignore_index=True)
        if (came["command"] == RESET).any():
            epoch += 1
            self.held.update((epoch,))
            # A row without a user opens the epoch.
            yield frame(part=[key[0]], epoch=[epoch], user=[None])
        users = came.loc[came["command"].isna(), "user"].astype(object).tolist()
        if users:
            yield frame(part=[key[0]] * len(users), epoch=[epoch] * len(users), user=users)

    def close(self) -> None:
        pass


def epochs(events: DataFrame, commands: DataFrame) -> DataFrame:
    """part, epoch, user of each event; a command (part, 'reset') begins an epoch of the part before the trigger's events."""
    ship(events.sparkSession)
    said = commands.select("part", F.lit(None).cast("string").alias("user"), "command")
    rows = events.select("part", "user", F.lit(None).cast("string").alias("command")).unionByName(said)
    return rows.groupBy("part").transformWithStateInPandas(_Epochs(), EPOCHS, "append", "none")


def epoch_counts(numbered: DataFrame, bits: int = 12) -> DataFrame:
    """part, epoch, sketch, n of all parts and epochs of a stream of `epochs`; for complete mode."""
    return numbered.where("part is not null").groupBy("part", "epoch").agg(F.hll_sketch_agg("user", F.lit(bits)).alias("sketch"), F.count("user").alias("n"))


def current(counted: DataFrame, least: int = 0) -> DataFrame:
    """part, users, sketch of each part's last epoch, if it has more than `least` events."""
    last = counted.groupBy("part").agg(F.max_by(F.struct("sketch", "n"), "epoch").alias("last")).where(F.col("last.n") > least)
    return last.select("part", F.hll_sketch_estimate("last.sketch").alias("users"), "last.sketch")


def command_lines(lines: DataFrame) -> DataFrame:
    """part, command of each line `part,command`; other lines are dropped."""
    pair = F.split("value", ",")
    return lines.select(F.trim(F.get(pair, 0)).alias("part"), F.trim(F.get(pair, 1)).alias("command")).where("command is not null")


def epoch_totals_sink(write: Callable[[DataFrame, int], None], least: int = 0) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that hands the totals over the last epochs of all parts of `epoch_counts` (complete mode) to `write`."""
    return lambda batch, number: write(totals(current(batch, least)), number)
