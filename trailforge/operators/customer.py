"""Customers: gaps, recency, frequency and value, lifetime value, lifecycles and retention.

Inferred, for want of a written definition: gap generation, min-max normalisation, weighted
averages, numeric statistics, and when the bound of a temporal cluster counts as found.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.functions import scalars as S
from trailforge.operators.stretches import neighbours


@dataclass(frozen=True)
class Transactions:
    """Column names of a transaction or visit table; `tie` breaks equal times."""

    id: str = "cust_id"
    ts: str = "ts"
    value: str | None = "value"
    tie: str = "xaction_id"


TRANSACTIONS = Transactions()


#: The stretch of an id's rows: thirty days.
WIDTH_MS = 2_592_000_000


def _timed(df: DataFrame, c: Transactions, *more: Column) -> DataFrame:
    """id, ts, tie, ms and `more` of the rows with an id and a time."""
    known = df.where(F.col(c.id).isNotNull() & F.col(c.ts).isNotNull())
    return known.select(F.col(c.id).alias("id"), F.col(c.ts).alias("ts"), F.col(c.tie).alias("tie"), S.epoch_ms(F.col(c.ts)).alias("ms"), *more)


def time_gaps(df: DataFrame, unit: str = "day", c: Transactions = TRANSACTIONS, legacy_units: bool = False) -> DataFrame:
    """id, ts, gap to the id's next transaction in whole units; ids with one transaction have none."""
    met = neighbours(_timed(df, c), "id", ["ts", "tie"], lag={"before": "ms"}, width=WIDTH_MS)
    return met.select("id", "ts", S.to_unit(F.col("ms") - F.col("before"), unit, legacy_units).alias("gap")).where("gap is not null")


def rfm(df: DataFrame, reference: Column, unit: str = "day", recency_count: int = 1, fraction: float = 0.5, c: Transactions = TRANSACTIONS, legacy_units: bool = False, watch: Callable[..., DataFrame] = lambda df, **counts: df) -> DataFrame:
    """id, av_time_gap, recency, av_value of every id with at least two gaps; `watch` is told the ids and those with fewer (`ids`, `short_histories`).

    Gaps are cut to whole units before they are averaged. Recency is the time from the k-th last
    transaction to the reference time, over k, then cut to units; k is the least of `recency_count`
    and the given fraction of the transactions (1 at least). Values are summed as decimals, so the
    mean does not hang on the order of rows. Ids are taken in stretches (`stretches`), so none is whole in a task.
    """
    one = F.lit(1).cast("long")
    rows = _timed(df, c, F.col(c.value).try_cast("decimal(28,4)").alias("value"))
    met = neighbours(rows, "id", ["ts", "tie"], lag={"before": "ms"}, running={"place": one}, total={"n": one}, width=WIDTH_MS)
    ranked = met.select("id", "ms", "value", S.to_unit(F.col("ms") - F.col("before"), unit, legacy_units).alias("gap"), (F.col("n") - F.col("place") + 1).alias("back"), "n")
    k = F.least(F.lit(recency_count), F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(fraction)).cast("int")))
    since = S.to_unit(S.int_div(S.epoch_ms(reference) - F.max(F.when(F.col("back") == k, F.col("ms"))), F.max(k)), unit, legacy_units)
    scored = ranked.groupBy("id").agg(
        S.int_div(F.sum("gap"), F.count("gap")).alias("av_time_gap"),
        since.alias("recency"),
        F.round(F.avg("value"), 2).cast("double").alias("av_value"),
        F.count("gap").alias("__gaps"),
    )
    return watch(scored, ids=F.count(F.lit(1)), short_histories=F.count_if(F.col("__gaps") < 2)).where("__gaps >= 2").drop("__gaps")


def rfm_stats(scored: DataFrame, *more: Column) -> DataFrame:
    """One row over all customers: least and greatest mean gap and value, mean and population deviation of gaps, and `more` aggregates."""
    return scored.agg(
        F.min("av_time_gap").alias("min_av_time_gap"), F.max("av_time_gap").alias("max_av_time_gap"), F.min("av_value").alias("min_av_value"),
        F.max("av_value").alias("max_av_value"), F.round(F.avg("av_time_gap"), 3).alias("global_av_time_gap"), F.round(F.stddev_pop("av_time_gap"), 3).alias("global_std_dev_time_gap"), *more,
    )


#: The statistics that each law of gaps needs.
GAP_STATS = {"normal": ["global_av_time_gap", "global_std_dev_time_gap"], "exponential": ["global_av_time_gap"]}


def recency_score(scored: DataFrame, stats: DataFrame, distribution: str = "normal", precision: int = 3) -> DataFrame:
    """`scored` with recency replaced by the probability of a longer gap, under a normal or an exponential law of gaps."""
    if distribution not in GAP_STATS:
        raise ValueError("the distribution is normal or exponential")
    met = scored.crossJoin(F.broadcast(stats.select(*GAP_STATS[distribution])))
    return met.select("id", "av_time_gap", longer_gap(F.col("recency"), distribution, precision).alias("recency"), "av_value")


def longer_gap(recency: Column, distribution: str, precision: int = 3) -> Column:
    """The probability of a gap over `recency`, from the statistics that GAP_STATS names, which are columns of the same row."""
    mean = F.col("global_av_time_gap")
    p = S.normal_cdf(recency, mean, F.col("global_std_dev_time_gap")) if distribution == "normal" else S.exponential_cdf(recency, mean)
    return F.round(F.lit(1.0) - p, precision)


def normalize(df: DataFrame, columns: list[str], inverted: tuple[str, ...] = (), scale: float = 100.0, precision: int = 3) -> DataFrame:
    """`columns` from least 0 to greatest `scale` (0 if all are alike), `inverted` ones the other way round. Two reads, one partial aggregate, no shuffle of rows."""
    bounds = df.agg(*[f(c).cast("double").alias(f"__{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
    return scaled(df.crossJoin(F.broadcast(bounds)), columns, inverted, scale, precision).select(*df.columns)


def scaled(met: DataFrame, columns: list[str], inverted: tuple[str, ...] = (), scale: float = 100.0, precision: int = 3) -> DataFrame:
    """`normalize` of rows that hold their columns' bounds already, as __lo_ and __hi_."""

    def put(c: str) -> Column:
        low, high = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        x = F.coalesce((F.col(c).cast("double") - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0)) * scale
        return F.round(F.lit(scale) - x if c in inverted else x, precision)

    return met.withColumns({c: put(c) for c in columns})


def weighted_average(df: DataFrame, weights: dict[str, float], key: str = "id", name: str = "score", as_int: bool = True) -> DataFrame:
    """key and the weighted mean of the weighted columns."""
    total = sum(weights.values())
    mean = sum((F.col(c) * float(w) for c, w in weights.items()), F.lit(0.0)) / F.lit(float(total))
    return df.select(key, (F.floor(mean).cast("int") if as_int else mean).alias(name))


def numeric_stats(df: DataFrame, column: str, precision: int = 3) -> DataFrame:
    """One row: count, mean, population deviation, least and greatest."""
    return df.agg(
        F.count(column).alias("count"), F.round(F.avg(column), precision).alias("mean"), F.round(F.stddev_pop(column), precision).alias("std_dev"),
        F.min(column).alias("min"), F.max(column).alias("max"),
    )


def min_gap(visits: DataFrame, z: float = 3.0, c: Transactions = TRANSACTIONS) -> DataFrame:
    """One row with min_gap_ms: the mean gap between visits plus z population deviations."""
    return time_gaps(visits, "ms", c).agg((F.avg("gap") + F.lit(float(z)) * F.stddev_pop("gap")).alias("min_gap_ms"))


def clusters(visits: DataFrame, gap: DataFrame, start: Column, end: Column, c: Transactions = TRANSACTIONS) -> DataFrame:
    """Runs of an id's visits without a gap over min_gap_ms: id, cluster, first_ms, last_ms, whether each bound is found, and is_last.

    A bound is found if the horizon lies more than the gap beyond it.
    """
    rows = neighbours(_timed(visits, c).drop("ts"), "id", ["ms", "tie"], lag={"before": "ms"}, last={"end_ms": "ms"}, width=WIDTH_MS)
    rows = rows.crossJoin(F.broadcast(gap.select("min_gap_ms")))
    # A run ends with the row before the next one's first, or with the id's last row.
    firsts = rows.where("before is null or ms - before > min_gap_ms")
    runs = neighbours(firsts, "id", ["ms", "tie"], lead={"next_before": "before"}, running={"number": F.lit(1)}, width=WIDTH_MS)
    runs = runs.select("id", (F.col("number") - 1).alias("cluster"), F.col("ms").alias("first_ms"), F.coalesce("next_before", "end_ms").alias("last_ms"), "min_gap_ms", F.col("next_before").isNull().alias("is_last"))
    return runs.select(
        "id", "cluster", "first_ms", "last_ms",
        (F.col("first_ms") - S.epoch_ms(start) > F.col("min_gap_ms")).alias("start_found"), (S.epoch_ms(end) - F.col("last_ms") > F.col("min_gap_ms")).alias("end_found"), "is_last",
    )


def lifecycles(runs: DataFrame, mode: str, start: Column, end: Column, use_horizon: bool = True) -> DataFrame:
    """id, start_ms, end_ms of the lifecycles of a mode; a bound that is not found is the horizon's, or null.

    all: every cluster; complete: those with both bounds; current: an id's last cluster if it has no end yet.
    """
    low, high = (S.epoch_ms(x) if use_horizon else F.lit(None).cast("long") for x in (start, end))
    begin = F.when(F.col("start_found"), F.col("first_ms")).otherwise(low)
    finish = F.when(F.col("end_found"), F.col("last_ms")).otherwise(high)
    if mode == "all":
        return runs.select("id", begin.alias("start_ms"), finish.alias("end_ms"))
    if mode == "complete":
        return runs.where("start_found and end_found").select("id", F.col("first_ms").alias("start_ms"), F.col("last_ms").alias("end_ms"))
    if mode == "current":
        return runs.where("is_last and not end_found").select("id", F.col("first_ms").alias("start_ms"), high.alias("end_ms"))
    raise ValueError("the mode is all, complete or current")


def lifecycle_length(cycles: DataFrame, unit: str = "day") -> DataFrame:
    """id and length in whole units, null without both bounds."""
    return cycles.select("id", S.to_unit(F.col("end_ms") - F.col("start_ms"), unit).alias("length"))


def retention(cycles: DataFrame, unit: str = "month") -> DataFrame:
    """Ids acquired and lost in each year, month (from 0) or day, and the difference."""
    if unit not in ("year", "month", "day"):
        raise ValueError("the unit is year, month or day")
    bounds = cycles.select(F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.col("start_ms").alias("ms")), F.struct(F.lit(1).alias("kind"), F.col("end_ms").alias("ms"))))).where("ms > 0")
    parts = dict(zip(("year", "month", "day"), S.year_month0_day(F.timestamp_millis("ms"))))
    names = ["year", "month", "day"][: ["year", "month", "day"].index(unit) + 1]
    counted = bounds.groupBy(*[parts[n].alias(n) for n in names]).agg(F.count_if(F.col("kind") == 0).alias("acquired"), F.count_if(F.col("kind") == 1).alias("lost"))
    return counted.withColumn("net", F.col("acquired") - F.col("lost"))


def short_histories(df: DataFrame, c: Transactions = TRANSACTIONS) -> DataFrame:
    """One row: how many ids `rfm` leaves out because they have fewer than two gaps."""
    known = df.where(F.col(c.id).isNotNull() & F.col(c.ts).isNotNull())
    return known.groupBy(c.id).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") < 3).alias("ids"))
