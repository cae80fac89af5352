"""Links between the members of meeting places, with no place whole in a task.

A place is a key that several members have. `connect` finds links among them in two steps.
First each place names one member its pivot, and every other member is compared with it; the
pivot's thing is copied for each STAR of them. A place is settled once its members are
connected. What is left is compared exactly: the members outside the place's largest component
in slices, each with every slice of the place, so a cluster is never compared with itself,
whatever its size.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.llm import common

#: Members that a pivot is compared with in one group of rows, and members of a slice.
STAR, SLICE = 128, 256
#: Members of a component that one is compared with in a tile before distances to a pivot are worth their while.
FEW = 8


@dataclass(frozen=True)
class Metric:
    """What `same` stands for: a distance of two things that is at most their limit."""

    distance: Callable
    limit: Callable


def stars(pairs: DataFrame, things: DataFrame, ready: Callable, same: Callable, many: Callable | None = None) -> DataFrame:
    """The pairs (u, v), where many may have one v, whose things are `same`; `things` has id and what `ready` takes.

    `many(things)`, if given, is asked for many pairs of places in a list at once instead of `same`.
    """
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = common.weighed(pairs.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "sizes", "n")
    parts = F.ceil(F.col("n") / STAR).cast("int")
    placed = common.hot_join(pairs, sizes, ["v"], "n").select(F.col("u").alias("id"), "v", F.pmod(F.xxhash64("u"), parts).cast("int").alias("part"), F.lit(1).alias("turn"))
    heads = sizes[0].select(F.col("v").alias("id"), "v", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("turn"))
    rows = heads.unionByName(placed).join(things, "id").select("id", "v", "turn", "part", *things.columns[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = None
        for batch in batches:
            u, v, left, held = [], [], [], []
            for i, of, turn, _, *thing in zip(*(c.to_pylist() for c in batch.columns)):
                if many:
                    if not turn:
                        pivot = tuple(thing)
                    else:
                        u.append(i)
                        v.append(of)
                        left.append(pivot)
                        held.append(tuple(thing))
                elif not turn:
                    pivot = ready(*thing)
                elif same(pivot, ready(*thing)):
                    u.append(i)
                    v.append(of)
            if u and many:
                alike = many(left + held)(np.arange(len(u)), np.arange(len(u)) + len(u))
                u, v = (list(itertools.compress(x, alike.tolist())) for x in (u, v))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return rows.repartition(n, "v", "part").sortWithinPartitions("v", "part", "turn").mapInArrow(run, "u long, v long")


def tiles(rows: DataFrame, keys: list[str], things: DataFrame, ready: Callable, same: Callable, near: Callable, metric: Metric | None = None, gate: Callable = lambda place: 0, allow: Callable | None = None) -> DataFrame:
    """u, v: links between members of different components that meet in a place, enough to connect what is linked.

    `rows` has the keys, id, root, tag and perhaps `places`, all places of the member: a pair is
    compared in the first that it shares of those with one `gate`, by which `near` decides alike.
    `near(key, tags, i)` says which of the members before i to compare with i. With a `metric`, pairs are ruled out by the triangle inequality where a
    component has many members to compare with. `allow(things)` says of many pairs of places in the list of
    things at once which may be the same; the others are not compared.
    """
    counted = rows.groupBy(*keys, "root").agg(F.count(F.lit(1)).alias("n"))
    most = F.max(F.struct("n", "root"))
    open_ = common.weighed(counted.groupBy(*keys).agg(F.sum("n").alias("size"), most["n"].alias("large"), most["root"].alias("main")).where("size > large and size > 2"), "unsettled", "size")
    rest, whole = F.ceil((F.col("size") - F.col("large")) / SLICE).cast("int"), F.ceil(F.col("large") / SLICE).cast("int")
    outside = F.col("root") != F.col("main")
    part = F.when(outside, F.pmod(F.xxhash64("id"), rest)).otherwise(rest + F.pmod(F.xxhash64("id"), whole)).cast("int")
    more = [c for c in rows.columns if c == "places"]
    tiled = (
        common.hot_join(rows, open_, keys, "size")
        .withColumns({"part": part, "other": F.explode(F.sequence(F.lit(0), F.when(outside, rest + whole).otherwise(rest) - 1))})
        .select(*keys, "id", "root", "tag", *more, "part", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"))
    )
    names = things.columns[1:]

    def compare(key: tuple, held: dict[str, list]) -> list[tuple[int, int]]:
        ids, parts, n = held["id"], np.array(held["part"]), len(held["id"])
        group = np.unique(np.array(held["root"], np.int64), return_inverse=True)[1]
        root, tags, rows_ = group.copy(), np.array(held["tag"], np.int64), list(zip(*(held[c] for c in names)))
        places = [set(p) for p in held["places"]] if more else None
        made: list = [None] * n
        pivots: dict[int, int] = {}
        known: dict[tuple[int, int], float] = {}

        may = allow(rows_) if allow else None

        def thing(k: int):
            if made[k] is None:
                made[k] = ready(*rows_[k])
            return made[k]

        def apart(i: int, j: int) -> float:
            pair = (i, j) if i < j else (j, i)
            if pair not in known:
                known[pair] = metric.distance(thing(i), thing(j))
            return known[pair]

        out = []
        for i in range(1, n):
            close = near(key, tags, i) & (root[:i] != root[i])
            if key[-2] != key[-1]:
                close &= parts[:i] != parts[i]
            close = np.flatnonzero(close)
            if may and len(close):
                close = close[may(np.full(len(close), i), close)]
            often = np.bincount(group[close], minlength=1) > FEW
            for j in close.tolist():
                if root[j] == root[i] or (places and min(p for p in places[i] & places[j] if gate(p) == gate(key[0])) != key[0]):
                    continue
                if metric and often[group[j]]:
                    pivot = pivots.setdefault(int(group[j]), j)
                    if pivot != j and abs(apart(i, pivot) - apart(pivot, j)) > metric.limit(thing(i), thing(j)):
                        continue
                if same(thing(i), thing(j)):
                    root[root == root[i]] = root[j]
                    out.append((ids[j], ids[i]))
        return out

    return common.per_run(tiled.join(things, "id"), [*keys, "a", "b"], compare)


def pivoted(members: DataFrame, keys: list[str]) -> DataFrame:
    """`members` (keys, id and perhaps tag) of places with more than one, with the place's pivot and its size n."""
    pivot = F.min(F.struct(F.xxhash64("id").alias("order"), *[c for c in members.columns if c not in keys]))
    pivots = common.weighed(members.groupBy(*keys).agg(pivot.alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1"), "pivots", "n")
    met = common.stored(common.hot_join(members, pivots, keys, "n"), "met")
    common.forget(pivots[0])
    return met


def connect(met: DataFrame, keys: list[str], things: DataFrame, ready: Callable, same: Callable, near: Callable, alike: Column | None = None, links: DataFrame | None = None, tags: DataFrame | None = None, metric: Metric | None = None, gate: Callable = lambda place: 0, many: Callable | None = None, allow: Callable | None = None) -> DataFrame:
    """node, root of all members that are linked to another: those of `links`, and those in a common place of `met` (of `pivoted`) that are `same`.

    Members that are not `alike` their pivot are not compared with it, nor others unless `near`
    their tags, which are in `met` or, by id, in `tags`; `tags` may have `places` too (see `tiles`).
    """
    pairs = met.where(F.col("id") != F.col("pivot.id"))
    pairs = (pairs if alike is None else pairs.where(alike)).select(F.col("id").alias("u"), F.col("pivot.id").alias("v"))
    pairs = common.stored(pairs.distinct(), "pairs")
    found = stars(pairs, things, ready, same, many)
    named = common.stored(common.components(found if links is None else found.union(links)), "named")
    # A place of two has been compared whole.
    rows = met.where("n > 2").drop("pivot", "n").join(named.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    rows = common.stored(rows if tags is None else rows.join(tags, "id"), "rooted")
    last, seen = common.measured(tiles(rows, keys, things, ready, same, near, metric, gate, allow), "links", n=F.count(F.lit(1)))
    common.forget(pairs, rows)
    if not seen["n"]:
        return named
    # Links that are found last join whole components, so their roots alone are connected.
    roots = named.withColumnRenamed("node", "of")
    ends = last
    for end in ("u", "v"):
        ends = ends.join(roots.select(F.col("of").alias(end), F.col("root").alias(f"root_{end}")), end, "left").withColumn(end, F.coalesce(f"root_{end}", end)).drop(f"root_{end}")
    onto = common.stored(common.components(ends.select("u", "v")).select(F.col("node").alias("root"), F.col("root").alias("onto")), "onto")
    joined = named.join(onto, "root", "left").select("node", F.coalesce("onto", "root").alias("root"))
    fresh = onto.join(named.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("onto").alias("root"))
    return joined.unionByName(fresh)
