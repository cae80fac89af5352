"""Events in logs with the records around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailforge.operators.patterns import FEW, matches

#: Buckets of positions that are summed up together.
STRETCH = 10_000


def pattern_list(config: dict[str, str], prefix: str = "event.pattern") -> list[tuple[str, str]]:
    """(name, regex) of prefix.1, prefix.2 and so on, up to the first number that is missing."""
    out, n = [], 1
    while f"{prefix}.{n}.name" in config and f"{prefix}.{n}.regex" in config:
        out.append((config[f"{prefix}.{n}.name"], config[f"{prefix}.{n}.regex"]))
        n += 1
    return out


def between(ts: Column, low=None, high=None) -> Column:
    """Strictly between bounds, each of which may be missing."""
    good = F.lit(True)
    if low is not None:
        good = good & (ts > F.lit(low).cast("timestamp"))
    if high is not None:
        good = good & (ts < F.lit(high).cast("timestamp"))
    return good


def session_event_context(records: DataFrame, found: list[tuple[str, str]], before: int = 3, after: int = 2, session: str = "session_id", order: tuple[str, ...] = ("ts", "event_id"), record: str = "record") -> DataFrame:
    """session, event, match_no, context_offset, line: for each record in which a pattern is found, the records around it in its session.

    One window over the session holds at most before + after + 1 records in each row.
    """
    w = Window.partitionBy(session).orderBy(*order)
    here = F.row_number().over(w)
    frame = F.collect_list(F.struct(F.col(record).alias("line"))).over(w.rowsBetween(-before, after))
    if len(found) <= FEW:
        names = F.array_compact(F.array(*[F.when(F.col(record).rlike(regex), F.lit(name)) for name, regex in found]))
        placed = records.withColumn("names", names)
    else:
        # What the patterns find is put back beside its record, in the partitions that the windows need.
        hits = matches(records.select(session, *order, record), record, _fields(found)).groupBy(session, *order).agg(F.array_sort(F.collect_list(F.struct("i", "event"))).alias("hits"))
        placed = records.join(hits, [session, *order], "left").withColumn("names", F.coalesce(F.transform("hits", lambda h: h["event"]), F.array()))
    matched = placed.select(F.col(session), here.alias("at"), frame.alias("around"), "names").where(F.size("names") > 0)
    first = F.least(F.col("at") - 1, F.lit(before))
    return (
        matched.select(session, "at", "around", F.explode("names").alias("event"))
        .select(session, "event", F.col("at").alias("match_no"), first.alias("lead"), F.posexplode("around").alias("p", "r"))
        .select(session, "event", "match_no", (F.col("p") - F.col("lead")).alias("context_offset"), F.col("r.line").alias("line"))
    )


def _fields(found: list[tuple[str, str]]) -> list[dict[str, object]]:
    return [{"i": i, "event": name, "regex": regex} for i, (name, regex) in enumerate(found)]


def dense_positions(df: DataFrame, key: str, width: int = 100_000, name: str = "position") -> DataFrame:
    """`df` with the place of each row, from 1, in the order of a unique number: counted inside buckets of `width` values, then over buckets.

    No task sorts the whole table. Buckets are summed in stretches of STRETCH of them, and those, a row for each, at once.
    """
    bucket, stretch = F.floor(F.col(key) / width).cast("long"), F.floor(F.col("__bucket") / STRETCH).cast("long")
    counted = df.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("n")).withColumn("__stretch", stretch)
    earlier = lambda *parts: Window.partitionBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    stretches = counted.groupBy("__stretch").agg(F.sum("n").alias("n"))
    stretches = stretches.select("__stretch", F.coalesce(F.sum("n").over(earlier().orderBy("__stretch")), F.lit(0)).alias("__before"))
    inner = F.coalesce(F.sum("n").over(earlier("__stretch").orderBy("__bucket")), F.lit(0))
    starts = counted.withColumn("__inner", inner).join(stretches, "__stretch").select("__bucket", (F.col("__before") + F.col("__inner")).alias("__start"))
    inside = Window.partitionBy("__bucket").orderBy(key)
    placed = df.withColumn("__bucket", bucket).withColumn("__n", F.row_number().over(inside)).join(starts, "__bucket")
    return placed.withColumn(name, F.col("__start") + F.col("__n")).drop("__bucket", "__start", "__n")


def stream_event_context(records: DataFrame, found: list[tuple[str, str]], before: int = 3, after: int = 2, position: str = "position", record: str = "record") -> DataFrame:
    """event, match_no, context_offset, line for each record that a pattern matches as a whole and that has a full context.

    `position` counts the records without a gap. Matches are joined to their neighbours by position, so that
    no task sees the whole log.
    """
    matched = matches(records.select(position, record), record, _fields(found), whole=True).select(F.col(position).alias("match_no"), "event")
    wanted = matched.withColumn("context_offset", F.explode(F.sequence(F.lit(-before), F.lit(after)))).withColumn(position, F.col("match_no") + F.col("context_offset"))
    around = wanted.join(records.select(position, F.col(record).alias("line")), position)
    # A context is full if both its ends are there.
    ends = records.agg(F.min(position).alias("lo"), F.max(position).alias("hi"))
    full = around.crossJoin(F.broadcast(ends)).where((F.col("match_no") - before >= F.col("lo")) & (F.col("match_no") + after <= F.col("hi")))
    return full.select("event", "match_no", "context_offset", "line")
