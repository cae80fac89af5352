"""Engagement events of items in a session, and implicit ratings from them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.functions import scalars as S
from trailforge.operators.patterns import matches as patterns_in
from trailforge.operators.sessions import CLICKS, Clicks
from trailforge.operators.stretches import neighbours, stretch

BROWSE = 1


@dataclass(frozen=True)
class Pattern:
    """An event of `event` with `value`; the last capture group is the item, and a pattern without one is a step of the whole session."""

    regex: str
    event: int
    value: int = 0

    @property
    def groups(self) -> int:
        return re.compile(self.regex).groups


def patterns(spec: str) -> list[Pattern]:
    """Patterns from regex:event[:value], parted by commas."""
    out = []
    for item in spec.split(","):
        regex, event, *value = item.rsplit(":", 2) if re.search(r":\d+:\d+$", item) else item.rsplit(":", 1)
        out.append(Pattern(regex, int(event), int(value[0]) if value else 0))
    return out


def time_mapping(spec: str) -> list[tuple[int, int]]:
    """Pairs (seconds below which, rating) from seconds:rating, parted by commas."""
    return [tuple(int(x) for x in pair.split(":")) for pair in spec.split(",")]


def hits(clicks: DataFrame, found: list[Pattern], c: Clicks = CLICKS) -> DataFrame:
    """A row for each pattern that a page matches: session, user, order, place of the pattern, item (null for a step), event, value, seconds on page."""
    rows = c.known(clicks).select(
        F.col(c.session).alias("session_id"), F.col(c.ts).alias("ts"), F.col(c.tie).alias("tie"), S.epoch_ms(F.col(c.ts)).alias("ms"), F.col(c.user).alias("user"), F.col(c.url).alias("url")
    )
    met = neighbours(rows, "session_id", ["ts", "tie"], lead={"next_ms": "ms"}, first={"user_id": "user"})
    spent = F.coalesce(S.int_div(F.col("next_ms") - F.col("ms"), 1000), F.lit(0))
    fields = [{"pattern": i, "regex": p.regex, "group": p.groups, "event": p.event, "value": p.value} for i, p in enumerate(found)]
    item = F.when(F.col("group") > 0, F.call_function("regexp_extract", F.col("url"), F.col("regex"), F.col("group").cast("int")))
    return patterns_in(met.select("session_id", "user_id", "ts", "tie", spent.alias("spent"), "url"), "url", fields).select(
        "session_id", "user_id", "ts", "tie", "spent", F.col("pattern").cast("int").alias("pattern"), item.alias("item"), F.col("event").cast("int").alias("event"), "value"
    )


#: Where an item stands: its event and value, both null before its first hit; `own` tells a value from that of the state before.
_STATE = "struct<event: int, value: bigint, own: boolean>"


def _states(event: Column, value: Column, own: bool) -> Column:
    return F.struct(event.alias("event"), value.alias("value"), F.lit(own).alias("own")).cast(_STATE)


def _after(rows: Column, state: Column) -> Column:
    """The state of an item after its own hits and its session's steps in order.

    A first hit is stored, with the seconds on the page if its pattern has no value; a later one
    replaces it if its event is greater. A step promotes an item that stands one event below it.
    """

    def go(held: Column, hit: Column) -> Column:
        step, none = hit["item"].isNull(), held["event"].isNull()
        first = F.when(hit["value"] == 0, hit["spent"]).otherwise(hit["value"])
        moves = F.when(none, ~step).when(step, held["event"] == hit["event"] - 1).otherwise(held["event"] < hit["event"])
        return F.when(moves, _states(hit["event"], F.when(none, first).otherwise(hit["value"]), True)).otherwise(held)

    return F.aggregate(rows, state, go)


def _moves(rows: Column, levels: list[int]) -> Column:
    """The state after `rows` for each that may be before: none, and each event of `levels` with a value that is not known here."""
    before = [F.lit(None).cast("int"), *[F.lit(e) for e in levels]]
    return F.array(*[_after(rows, _states(e, F.lit(None).cast("long"), False)) for e in before])


def _through(held: Column, moves: Column, levels: list[int]) -> Column:
    """The state `held` put through moves."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(e) for e in levels]), held["event"]), F.lit(0)).cast("int")
    then = F.get(moves, place)
    return F.when(then["own"], then).otherwise(held)


def engagement_events(clicks: DataFrame, found: list[Pattern], c: Clicks = CLICKS) -> DataFrame:
    """session_id, user_id, item_id, event_id, value: where each item of a session ended up.

    Hits are functions of where an item stands, and functions compose: a stretch of a session's steps is one,
    a stretch of an item's hits and the steps between them is one, and an item goes through those of its
    session in order, its own where it has hits. So a row holds the hits of a stretch at most,
    and an item meets a function for each stretch of its session, not its steps.
    """
    hit = F.struct("ts", "tie", "pattern", "item", "event", "value", "spent")
    levels = sorted({p.event for p in found})
    seen = hits(clicks, found, c).withColumn("stretch", stretch(S.epoch_ms(F.col("ts"))))
    own = seen.where("item is not null").groupBy("session_id", "stretch", "item").agg(F.first("user_id").alias("user_id"), F.collect_list(hit).alias("hits"))
    moves = lambda rows: F.struct("stretch", _moves(F.array_sort(rows), levels).alias("to")).alias("moves")
    if any(not p.groups for p in found):
        steps = seen.where("item is null").groupBy("session_id", "stretch").agg(F.collect_list(hit).alias("steps"))
        own = own.join(steps, ["session_id", "stretch"], "left").withColumn("hits", F.concat("hits", F.coalesce("steps", F.array())))
        between = steps.select("session_id", moves(F.col("steps"))).groupBy("session_id").agg(F.collect_list("moves").alias("between"))
    own = own.select("session_id", "item", "user_id", moves(F.col("hits"))).groupBy("session_id", "item").agg(F.first("user_id").alias("user_id"), F.collect_list("moves").alias("all"))
    if any(not p.groups for p in found):
        stretches = F.transform("all", lambda m: m["stretch"])
        others = F.filter(F.coalesce("between", F.array()), lambda m: ~F.array_contains(F.col("stretches"), m["stretch"]))
        own = own.join(between, "session_id", "left").withColumn("stretches", stretches).withColumn("all", F.concat("all", others))
    nothing = _states(F.lit(None).cast("int"), F.lit(None).cast("long"), False)
    at = F.aggregate(F.array_sort("all", lambda a, b: F.signum(a["stretch"] - b["stretch"]).cast("int")), nothing, lambda held, m: _through(held, m["to"], levels))
    return own.select("session_id", "user_id", F.col("item").alias("item_id"), at.alias("at")).select(
        "session_id", "user_id", "item_id", F.col("at.event").alias("event_id"), F.col("at.value").alias("value")
    )


def item_events(clicks: DataFrame, found: list[Pattern], c: Clicks = CLICKS) -> DataFrame:
    """`engagement_events` without promotion, as one aggregation: the first hit of the greatest event of each item."""
    at = F.struct("ts", "tie", "pattern")
    items = hits(clicks, [p for p in found if p.groups], c)
    best = F.struct("event", -F.unix_micros(F.col("ts").cast("timestamp")), -F.col("tie"), -F.col("pattern"))
    return (
        items.groupBy("session_id", "item")
        .agg(
            F.first("user_id").alias("user_id"),
            F.min_by("event", at).alias("first_event"),
            F.min_by("spent", at).alias("spent"),
            F.max("event").alias("event_id"),
            F.max_by("value", best).alias("best_value"),
        )
        .select(
            "session_id", "user_id", F.col("item").alias("item_id"), "event_id",
            F.when((F.col("first_event") == F.col("event_id")) & (F.col("best_value") == 0), F.col("spent")).otherwise(F.col("best_value")).alias("value"),
        )
    )


def ratings(events: DataFrame, mapping: list[tuple[int, int]], user: str = "user_id", item: str = "item_id", item_first: bool = False) -> DataFrame:
    """A rating for each user and item: the greatest value of events past browsing, else the total browsing time put through `mapping`.

    A time takes the rating of the first threshold above it, and one more than the last past them all.
    """
    browse = F.col("event_id") == BROWSE
    per_pair = events.groupBy(user, item).agg(F.max(F.when(~browse, F.col("value"))).alias("__best"), F.coalesce(F.sum(F.when(browse, F.col("value"))), F.lit(0)).alias("__time"))
    ladder = F
    for below, rating in mapping:
        ladder = ladder.when(F.col("__time") < below, rating)
    rated = F.coalesce(F.col("__best"), ladder.otherwise(mapping[-1][1] + 1).cast("long"))
    return per_pair.select(*([item, user] if item_first else [user, item]), rated.alias("rating"))
