"""Sessions: pages with dwell time, summaries with funnel status, and users over their sessions.

Rows without a session or a time are dropped. No session and no user is whole in a task: windows run
inside stretches of time (`stretches`), and the funnel is a function of what was reached before,
composed over a session's stretches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.functions import scalars as S
from trailforge.operators.stretches import neighbours, stretch


@dataclass(frozen=True)
class Clicks:
    """Column names of a click table; `tie` breaks equal times."""

    session: str = "session_id"
    user: str = "user_id"
    ts: str = "ts"
    url: str = "url"
    referrer: str = "referrer"
    tie: str = "event_id"

    def known(self, df: DataFrame) -> DataFrame:
        return df.where(F.col(self.session).isNotNull() & F.col(self.ts).isNotNull())

    @property
    def order(self) -> tuple[Column, Column]:
        return F.col(self.ts), F.col(self.tie)


CLICKS = Clicks()
#: The stretch of a user's sessions: thirty days.
USER_MS = 2_592_000_000


def sessions_from_cookie(df: DataFrame, session_name: str, user_name: str, cookie: str = "cookie", separator: str = r";\+") -> DataFrame:
    """`df` with session_id and user_id from its cookie; rows without a session are dropped."""
    found = df.withColumns({"session_id": S.cookie_value(F.col(cookie), session_name, separator), "user_id": S.cookie_value(F.col(cookie), user_name, separator)})
    return found.where("session_id is not null")


def _timed(clicks: DataFrame, c: Clicks, *more: Column) -> DataFrame:
    """session_id, ts, event_id, ms, url and `more` of the rows with a session and a time."""
    ms = S.epoch_ms(F.col(c.ts))
    return c.known(clicks).select(F.col(c.session).alias("session_id"), F.col(c.ts).alias("ts"), F.col(c.tie).alias("event_id"), ms.alias("ms"), F.col(c.url).alias("url"), *more)


def session_pages(clicks: DataFrame, c: Clicks = CLICKS) -> DataFrame:
    """A row for each page with the whole seconds until the next one (0 for the last), the session's user and start."""
    rows = _timed(clicks, c, F.col(c.user).alias("user"))
    met = neighbours(rows, "session_id", ["ts", "event_id"], lead={"next_ms": "ms"}, first={"user_id": "user", "session_start": "ms"})
    return met.select(
        "session_id", "user_id", "session_start", F.date_format("ts", "HH:mm:ss").alias("visit_time"), "url",
        F.coalesce(S.int_div(F.col("next_ms") - F.col("ms"), 1000), F.lit(0)).alias("time_on_page"), "event_id",
    )


def session_elapsed(clicks: DataFrame, c: Clicks = CLICKS) -> DataFrame:
    """session_id, event_id, time and the milliseconds until the session's next page, 0 for the last."""
    met = neighbours(_timed(clicks, c), "session_id", ["ts", "event_id"], lead={"next_ms": "ms"})
    return met.select("session_id", "event_id", "url", F.col("ms").alias("epoch_ms"), F.coalesce(F.col("next_ms") - F.col("ms"), F.lit(0)).alias("elapsed_ms"))


def flow_moves(pages: Column, flow: list[str]) -> Column:
    """How many steps of the funnel are done after `pages` (structs with `url` in order), for each number that may be done before.

    A page takes the funnel one step on if it starts with the step that is due. The moves of stretches
    compose: what is done before goes through one after the other.
    """
    steps = F.array(*[F.lit(s) for s in flow])
    step = lambda k, p: k + F.coalesce(p["url"].startswith(F.get(steps, k)), F.lit(False)).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(len(flow))), lambda k: F.aggregate(pages, k, step))


def flow_status(reached: Column, flow: list[str]) -> Column:
    """0, 1 or 2: the funnel not entered, entered, completed."""
    return F.when(reached == len(flow), 2).when(reached > 0, 1).otherwise(0)


def session_summary(clicks: DataFrame, flow: list[str], c: Clicks = CLICKS) -> DataFrame:
    """A row for each session: user, pages, start, seconds spent, last page, funnel status, first referrer."""
    rows = _timed(clicks, c, F.col(c.user).alias("user"), F.col(c.referrer).alias("referrer")).withColumns({"at": F.struct("ts", "event_id"), "stretch": stretch(F.col("ms"))})
    # Pages of the funnel alone are collected, a stretch at a time; the others cannot change its status.
    on_flow = F.exists(F.array(*[F.lit(s) for s in flow]), lambda s: F.col("url").startswith(s))
    visited = F.array_sort(F.collect_list(F.when(on_flow, F.struct("ts", "event_id", "url"))))
    parts = rows.groupBy("session_id", "stretch").agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.min("ms").alias("low"), F.max("ms").alias("high"), F.count(F.lit(1)).alias("pages"), F.min_by("user", "at").alias("user"),
        F.min_by("referrer", "at").alias("referrer"), F.max_by("url", "at").alias("last_page"), visited.alias("visited"),
    )
    parts = parts.withColumn("moves", F.when(F.size("visited") > 0, F.struct("stretch", flow_moves(F.col("visited"), flow).alias("to"))))
    reached = F.aggregate(F.array_sort(F.collect_list("moves")), F.lit(0), lambda k, m: F.get(m["to"], k))
    return parts.groupBy("session_id").agg(
        F.min_by("user", "first").alias("user_id"),
        F.sum("pages").alias("num_pages"),
        F.min("low").alias("time_start"),
        S.int_div(F.max("high") - F.min("low"), 1000).alias("time_spent"),
        F.max_by("last_page", "last").alias("last_page"),
        flow_status(reached, flow).alias("flow_stat"),
        F.min_by("referrer", "first").alias("referrer"),
    )


def session_average(elapsed: DataFrame) -> DataFrame:
    """From `session_elapsed`: first time, total and count of each session, and the mean between pages (null for one page)."""
    return elapsed.groupBy("session_id").agg(
        F.min("epoch_ms").alias("start_ms"),
        F.min_by("url", F.struct("epoch_ms", "event_id")).alias("first_url"),
        F.sum("elapsed_ms").alias("total_ms"),
        F.count(F.lit(1)).alias("num_pages"),
        S.int_div(F.sum("elapsed_ms"), F.count(F.lit(1)) - 1).alias("avg_ms"),
    )


def user_session_summary(summary: DataFrame) -> DataFrame:
    """A row for each user over the sessions of `session_summary`, by their starts.

    count_to_conversion is the place of the last completed session, status tells whether the last
    session is completed, in_between is the mean time between starts in ms.
    """
    at = F.struct("time_start", "session_id")
    return (
        neighbours(summary.where("user_id is not null and time_start is not null"), "user_id", ["time_start", "session_id"], "time_start", running={"__n": F.lit(1)}, width=USER_MS)
        .groupBy("user_id")
        .agg(
            F.min_by("referrer", at).alias("referrer"),
            F.coalesce(F.max(F.when(F.col("flow_stat") == 2, F.col("__n"))), F.lit(0)).alias("count_to_conversion"),
            S.int_div(F.sum("num_pages"), F.count(F.lit(1))).alias("av_num_pages"),
            S.int_div(F.sum("time_spent"), F.count(F.lit(1))).alias("av_time_spent"),
            (F.max_by("flow_stat", at) == 2).cast("int").alias("status"),
            F.count(F.lit(1)).alias("session_count"),
            F.coalesce(S.int_div(F.max("time_start") - F.min("time_start"), F.count(F.lit(1)) - 1), F.lit(0)).alias("av_in_between"),
        )
    )
