"""Neighbours, firsts and running sums in the order of a key, however many rows the key has.

A key's rows are taken in stretches of time. Windows run inside a stretch; what crosses its edges
comes from a table with one row for each stretch, on which a window over the key runs. So no task has
a key whole, and a key with most of all rows is as many groups as it has stretches. Rows are
shuffled once, by key and stretch; the table of edges is a partial aggregate of them.

Rows of one key in one stretch stay together: that is what WIDTH_MS bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH_MS = 3_600_000


def stretch(ms: Column, width: int = WIDTH_MS) -> Column:
    return F.floor(ms / width).cast("long")


def neighbours(
    rows: DataFrame, key: str, order: list[str], ms: str = "ms", lead: dict[str, str] | None = None, lag: dict[str, str] | None = None, first: dict[str, str] | None = None,
    last: dict[str, str] | None = None, running: dict[str, Column] | None = None, total: dict[str, Column] | None = None, width: int = WIDTH_MS,
) -> DataFrame:
    """`rows` with columns from their neighbours in a key, by name.

    `lead` and `lag` take a column of the next and of the earlier row, `first` and `last` of the key's first and
    last row; `running` sums up to the row itself, `total` over the key. `order` tells rows of a
    key apart and begins with a time that goes with `ms`, which has no null; nor has the key.
    """
    lead, lag, first, last, running, total = (x or {} for x in (lead, lag, first, last, running, total))
    at = F.struct(*order)
    cut = rows.withColumn("__stretch", stretch(F.col(ms), width))
    ends = cut.groupBy(key, "__stretch").agg(
        *[F.min_by(c, at).alias(f"__{a}") for a, c in (lead | first).items()], *[F.max_by(c, at).alias(f"__{a}") for a, c in (lag | last).items()],
        *[F.sum(c).alias(f"__{a}") for a, c in (running | total).items()], F.count(F.lit(1)).alias("__rows"),
    )
    over = Window.partitionBy(key).orderBy("__stretch")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"__{a}": F.lead(f"__{a}").over(over) for a in lead} | {f"__{a}": F.lag(f"__{a}").over(over) for a in lag}
    carried |= {f"__{a}": F.first(f"__{a}").over(whole) for a in first} | {f"__{a}": F.last(f"__{a}").over(whole) for a in last}
    carried |= {f"__{a}": F.coalesce(F.sum(f"__{a}").over(earlier), F.lit(0)) for a in running} | {f"__{a}": F.sum(f"__{a}").over(whole) for a in total}
    ends = ends.select(key, "__stretch", *[c.alias(a) for a, c in carried.items()])
    here = Window.partitionBy(key, "__stretch").orderBy(*order)
    up_to = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = {a: F.when(F.lead(F.lit(1)).over(here).isNull(), F.col(f"__{a}")).otherwise(F.lead(c).over(here)) for a, c in lead.items()}
    told |= {a: F.when(F.lag(F.lit(1)).over(here).isNull(), F.col(f"__{a}")).otherwise(F.lag(c).over(here)) for a, c in lag.items()}
    told |= {a: F.col(f"__{a}") for a in (*first, *last, *total)} | {a: F.col(f"__{a}") + F.sum(c).over(up_to) for a, c in running.items()}
    return cut.join(ends, [key, "__stretch"]).withColumns(told).drop("__stretch", *carried)
