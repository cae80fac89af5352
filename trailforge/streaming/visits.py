"""Visits of sessions and the depth of visits to pages, over streams.

A visit ends with a logout page, or when the watermark (or the clock) passes its last page by the
timeout. The stream is dealt out by session for visits and by page for depths. A run that ends
when all is read leaves the visits open that the watermark has not passed: the next run, or a
later line of any session, closes them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from trailforge.functions import scalars as S
from trailforge.functions.ship import ship
from trailforge.streaming.state import SAMPLE, Visit, depth_stats as stats_of, follow, frame, latest, next_tick

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VISIT = "session_id string, page_id string, depth int, end_ms long"
RESULTS = {"bounceRate": "bounce_rate", "depthDistr": "depth_distr", "avDepth": "av_depth"}


def use_rocks_db(spark: SparkSession) -> None:
    """The state store that arbitrary state needs; state then grows past the memory of executors."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)


def read_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the lines of text files that arrive in a folder."""
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(path)


def visit_pages(lines: DataFrame, session_regex: str, date_at: int = 0, time_at: int = 1, url_at: int = 4) -> DataFrame:
    """session_id, ts, url of each line; the session is group 1 of a regex that matches the whole URL. Lines that fail are dropped."""
    part = lambda i: F.get(F.split("value", r"\s+"), i)
    url = part(url_at)
    rows = lines.select(
        F.when(S.whole(url, session_regex), F.regexp_extract(url, f"^(?:{session_regex})$", 1)).alias("session_id"),
        F.try_to_timestamp(F.concat_ws(" ", part(date_at), part(time_at)), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        url.alias("url"),
    )
    return rows.where("session_id is not null and ts is not null")


class _Visits(StatefulProcessor):
    def __init__(self, timeout_ms: int, event_time: bool) -> None:
        self.timeout_ms, self.event_time = timeout_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("visit", "depth int, last_ms long, page string")

    def _load(self) -> Visit:
        return Visit(*self.open.get()) if self.open.exists() else Visit()

    def _rest(self, visit: Visit, now: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not visit.depth:
            self.open.clear()
            return
        self.open.update((visit.depth, visit.last_ms, visit.page))
        self.handle.registerTimer((visit.last_ms if self.event_time else now) + self.timeout_ms + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # What one trigger brings for one session is put in the order of time.
        came = pd.concat(list(rows), ignore_index=True).sort_values(["ms", "url"], kind="stable")
        page = came["page"].astype(object).where(came["page"].notna(), None)
        came = list(zip(came["ms"].tolist(), came["url"], page, came["logout"].tolist()))
        visit, done = follow(self._load(), [(ms, page, out) for ms, _, page, out in came], self.timeout_ms)
        self._rest(visit, 0 if self.event_time else timerValues.getCurrentProcessingTimeInMs())
        if done:
            yield self._told(key[0], done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        done = self._load().closed()
        self.open.clear()
        if done:
            yield self._told(key[0], [done])

    @staticmethod
    def _told(session: str, done: list[tuple[str, int, int]]) -> pd.DataFrame:
        pages, depths, ends = zip(*done)
        return frame(session_id=[session] * len(done), page_id=list(pages), depth=list(depths), end_ms=list(ends))

    def close(self) -> None:
        pass


def visits(pages: DataFrame, page_regex: str, logout: str, timeout_s: int = 30, watermark: str = "30 seconds", event_time: bool = True) -> DataFrame:
    """session_id, page_id, depth, end_ms of every visit that ended and has a page; `pages` is a stream of session_id, ts, url."""
    ship(pages.sparkSession)
    rows = pages.select(
        "session_id", "ts", S.epoch_ms(F.col("ts")).alias("ms"), "url", S.group(F.col("url"), page_regex).alias("page"), F.col("url").contains(logout).alias("logout")
    )
    if event_time:
        rows = rows.withWatermark("ts", watermark)
    return rows.groupBy("session_id").transformWithStateInPandas(
        _Visits(timeout_s * 1000, event_time), VISIT, "append", "eventTime" if event_time else "processingTime"
    )


class _Depths(StatefulProcessor):
    """A sample of a page's depths. Without ticks it reports when visits come, with ticks at each of them, whether visits came or not."""

    def __init__(self, least: int, tick_ms: int | None) -> None:
        self.least, self.tick_ms = least, tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("sample", "slots array<long>, ends array<long>, sessions array<string>, depths array<int>")

    def _sample(self) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(SAMPLE, map(list, self.held.get())))) if self.held.exists() else pd.DataFrame(columns=SAMPLE)

    def _report(self, page: str, depths: pd.Series) -> Iterator[pd.DataFrame]:
        if len(depths) >= max(self.least, 1):
            yield frame(page_id=[page], **{k: [v] for k, v in stats_of(depths.astype(int)).items()})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._sample()
        came = pd.concat([*([held] if len(held) else []), *(part[SAMPLE] for part in rows)], ignore_index=True)
        kept = latest(came)
        self.held.update(tuple(kept[c].tolist() for c in SAMPLE))
        if self.tick_ms is None:
            yield from self._report(key[0], kept["depth"])
        elif not list(self.handle.listTimers()):
            self.handle.registerTimer(next_tick(timerValues.getCurrentProcessingTimeInMs(), self.tick_ms))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.handle.registerTimer(next_tick(timerValues.getCurrentProcessingTimeInMs(), self.tick_ms))
        yield from self._report(key[0], self._sample()["depth"])

    def close(self) -> None:
        pass


def depth_stats(ended: DataFrame, window: int = 20, least: int | None = None, tick_s: int | None = None) -> DataFrame:
    """page_id, bounce_rate, depth_distr, av_depth of pages with `least` depths in a biased sample of `window` slots.

    `ended` is a stream of session_id, page_id, depth, end_ms. Pages report when a trigger brings visits
    of theirs; with `tick_s`, all pages report at each tick of so many seconds instead, idle ones too.
    """
    ship(ended.sparkSession)
    least = window * 3 // 4 if least is None else least
    rows = ended.select("page_id", S.sample_slot(window, "session_id", "end_ms").alias("slot"), "end_ms", "session_id", "depth")
    return rows.groupBy("page_id").transformWithStateInPandas(
        _Depths(least, tick_s and tick_s * 1000), "page_id string, bounce_rate long, depth_distr string, av_depth long", "update", "processingTime" if tick_s else "none"
    )


def result_lines(stats: DataFrame, result: str = "bounceRate") -> DataFrame:
    """page:value lines of one statistic."""
    return stats.select(F.concat("page_id", F.lit(":"), F.col(RESULTS[result]).cast("string")).alias("value"))


def start(df: DataFrame, name: str | None, checkpoint: str, mode: str = "append", tick: str | None = None, sink=None) -> StreamingQuery:
    """Starts a stream into `sink` (called with each batch and its number) or a memory table; with no tick it ends when all is read."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    writer = writer.trigger(processingTime=tick) if tick else writer.trigger(availableNow=True)
    return (writer.foreachBatch(sink) if sink else writer.format("memory")).start()
