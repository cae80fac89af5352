"""Log files: chronological merge, partitioning by time or entity, and tokens with positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailforge.functions import scalars as S
from trailforge.operators.events import between
from trailforge.sources import logs as L


def merge_logs(lines: DataFrame, time_regex: str = r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", time_format: str = "yyyy-MM-dd HH:mm:ss", sep: str = "_", sort: bool = True) -> DataFrame:
    """ts, source, line_no, record of every record of all files, each line prefixed with its source, in the order of time.

    A record starts at a line in which the time is found; the lines before a file's first one are left out.
    The sort is global and by ranges, not in one task.
    """
    prefixed = lines.withColumn("source", L.source_prefix(F.col("file"), sep))
    records = L.multi_line(prefixed.select("file", "line_no", F.concat_ws(" ", "source", "value").alias("value")), time_regex)
    timed = records.select(
        F.to_timestamp(F.regexp_extract("record", f"({time_regex})", 1), time_format).alias("ts"), L.source_prefix(F.col("file"), sep).alias("source"), "line_no", "record"
    )
    return timed.orderBy("ts", "source", "line_no") if sort else timed


def partition_lines(lines: DataFrame, time_regex: str, time_format: str, unit: str | None = None, entity_regex: str | None = None, low=None, high=None, value: str = "value") -> DataFrame:
    """partition, ts, line of the lines between the bounds: by the epoch hour or day of their time, or by an entity in them.

    Lines without a time, or without an entity, are dropped.
    """
    if (unit is None) == (entity_regex is None):
        raise ValueError("either a time unit or an entity")
    ts = F.try_to_timestamp(S.group(F.col(value), time_regex), F.lit(time_format))
    timed = lines.select(ts.alias("ts"), F.col(value).alias("line")).where(F.col("ts").isNotNull() & between(F.col("ts"), low, high))
    if unit is not None:
        if unit not in ("hour", "day"):
            raise ValueError("the unit is hour or day")
        part = S.pad_number(S.to_unit(S.epoch_ms(F.col("ts")), unit), 12)
    else:
        part = S.group(F.col("line"), entity_regex)
    return timed.select(part.alias("partition"), "ts", "line").where("partition is not null")


def write_partitions(parts: DataFrame, path: str) -> None:
    """One folder for each partition, its lines in the order of time; a partition may be many files, so none is held by one task."""
    parts.repartitionByRange("partition", "ts").sortWithinPartitions("partition", "ts", "line").select("partition", F.col("line").alias("value")).write.partitionBy("partition").mode("overwrite").text(path)


def tokenize(lines: DataFrame, regex: str = r"\s+", out: str = " ", prefix: int = 8, offset_digits: int = 12, token_digits: int = 3) -> DataFrame:
    """A line of file prefix and byte offset, then every token behind its number; `lines` has file, byte_offset, value."""
    key = F.concat(L.fixed_prefix(F.col("file"), prefix), F.lit(":"), S.pad_number(F.col("byte_offset"), offset_digits))
    tokens = F.transform(F.split("value", regex), lambda t, i: F.concat(S.pad_number(i, token_digits), F.lit(":"), t))
    return lines.select("file", "byte_offset", F.concat(key, F.lit(out), F.array_join(tokens, out)).alias("tokens"))
