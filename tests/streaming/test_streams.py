import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailforge.functions import scalars as S
from trailforge.plans import pipelines
from trailforge.streaming import state, visitors, visits

SESSION = r".*?sessionid=(\w+).*"


@pytest.fixture
def rocks(spark):
    visits.use_rocks_db(spark)
    return spark


def drop(folder, name, lines):
    """A file that counts as newer than those that are there."""
    folder.mkdir(exist_ok=True)
    at = 1_700_000_000 + 10 * len(list(folder.iterdir()))
    (folder / name).write_text("\n".join(lines) + "\n")
    os.utime(folder / name, (at, at))


def run(df, tmp_path, name, mode="append"):
    query = visits.start(df, name, str(tmp_path / f"ckpt-{name}"), mode)
    assert query.awaitTermination(120)
    return df.sparkSession.table(name).collect()


def line(second, session, page):
    return f"2024-01-01 10:{second // 60:02d}:{second % 60:02d} 10.0.0.1 GET /{page}?sessionid={session} 200"


def test_follow_closes_on_logout_and_timeout():
    rows = [(0, "home1", False), (5, None, False), (9, None, True), (20, None, False), (90_000, "home2", False)]
    left, done = state.follow(state.Visit(), rows, 30_000)
    assert done == [("home1", 3, 9)] and left == state.Visit(1, 90_000, "home2")


def test_streamed_visits_match_the_batch_twin(rocks, tmp_path):
    rng = random.Random(9)
    made = []
    for s in range(30):
        second = rng.randrange(60)
        for _ in range(rng.randrange(1, 9)):
            made.append((second, f"s{s}", rng.choice(["home1", "home2", "cart", "logout"])))
            second += rng.choice([1, 5, 40, 100])
    # The last line moves the watermark past every visit; files come in the order of time.
    made.sort()
    drop(tmp_path / "in", "a.txt", [line(*m) for m in made])
    drop(tmp_path / "in", "b.txt", [line(3500, "zz", "cart"), "not a line"])
    drop(tmp_path / "in", "c.txt", [line(3501, "zz", "cart")])
    pages = visits.visit_pages(visits.read_lines(rocks, str(tmp_path / "in"), 1), SESSION)
    got = run(visits.visits(pages, r"/(home\d)", "logout", 30), tmp_path, "visits")
    rows = rocks.createDataFrame([(s, sec, f"/{p}?sessionid={s}", i) for i, (sec, s, p) in enumerate(made)], "session_id string, sec long, url string, event_id long")
    batch = pipelines.batch_visits(rows.withColumn("ts", F.timestamp_seconds("sec")).withColumn("user_id", F.lit(1)), r"/(home\d)", "logout", 30)
    want = sorted((r["session_id"], r["page_id"], r["depth"]) for r in batch.collect())
    assert sorted((r["session_id"], r["page_id"], r["depth"]) for r in got) == want and want


def ended_lines(spark, folder):
    parts = F.split("value", " ")
    return visits.read_lines(spark, str(folder)).select(parts[0].alias("page_id"), parts[1].cast("int").alias("depth"), parts[2].cast("long").alias("end_ms"), parts[3].alias("session_id"))


def test_depth_stats_over_a_stream(rocks, tmp_path):
    drop(tmp_path / "in", "a.txt", ["home 1 1 a", "home 1 2 b", "home 3 3 c", "home 1 4 d", "rare 2 5 e"])
    got = run(visits.depth_stats(ended_lines(rocks, tmp_path / "in"), 10**9, 4), tmp_path, "depths", "update")
    assert [tuple(r) for r in got] == [("home", 75, "1:3,3:1", 2)]


def test_the_streamed_sample_is_the_batch_sample(rocks, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(1, 9), rng.randrange(10**6), f"s{i}") for i in range(300)]
    for k in range(3):
        drop(tmp_path / "in", f"{k}.txt", [" ".join(map(str, r)) for r in rows[100 * k : 100 * k + 100]])
    got = {}
    query = visits.start(visits.depth_stats(ended_lines(rocks, tmp_path / "in"), 16, 1), None, str(tmp_path / "ck"), "update", sink=lambda df, n: got.update({r["page_id"]: tuple(r) for r in df.collect()}))
    assert query.awaitTermination(120)
    batch = rocks.createDataFrame(rows, "page_id string, depth int, end_ms long, session_id string")
    assert got == {r["page_id"]: tuple(r) for r in pipelines.biased_depth_stats(batch, 16, 1).collect()}


class Handle:
    """The state and timers of one key, with a clock that is set by hand."""

    def __init__(self):
        self.value, self.timers, self.now = None, [], 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def listTimers(self):
        return iter(self.timers)

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_idle_pages_report_at_each_tick():
    handle, page = Handle(), visits._Depths(2, 10_000)
    page.init(handle)
    came = state.frame(slot=[1, 2, 3], end_ms=[5, 6, 7], session_id=["a", "b", "c"], depth=[1, 4, 1])
    handle.now = 12_345
    assert list(page.handleInputRows(("home",), iter([came]), handle)) == [] and handle.timers == [20_000]
    for at in (20_001, 30_000, 47_000):
        handle.now = at
        handle.timers.pop(0)
        (told,) = page.handleExpiredTimer(("home",), handle, None)
        assert told.to_dict("records") == [{"page_id": "home", "bounce_rate": 66, "depth_distr": "1:2,4:1", "av_depth": 2}]
    assert handle.timers == [50_000]
    rare = visits._Depths(9, 10_000)
    rare.init(handle)
    assert list(rare.handleExpiredTimer(("home",), handle, None)) == []


def test_ticks_of_a_running_stream(rocks, tmp_path):
    """A page with visits in the first trigger alone reports again and again, and so do the totals of parts."""
    drop(tmp_path / "in", "a.txt", ["home 1 1 a", "home 1 2 b"])
    seen, totals = [], []
    query = visits.start(visits.depth_stats(ended_lines(rocks, tmp_path / "in"), 10**9, 2, tick_s=1), None, str(tmp_path / "ck"), "update", "1 second", lambda df, n: seen.extend(df.collect()))
    drop(tmp_path / "app", "a.txt", ["d t s p1 u1", "d t s p2 u2", "d t s p2 u3"])
    events = visitors.with_ticks(visitors.app_events(visits.read_lines(rocks, str(tmp_path / "app")), 3, 4), 1)
    other = visits.start(visitors.counts(events), None, str(tmp_path / "ck2"), "complete", "1 second", visitors.totals_sink(lambda df, n: totals.extend(df.collect())))
    until = time.time() + 90
    while time.time() < until and not (len(seen) > 2 and len(totals) > 2):
        time.sleep(0.5)
    query.stop()
    other.stop()
    assert len(seen) > 2 and {tuple(r) for r in seen} == {("home", 100, "1:2", 1)}
    assert len(totals) > 2 and {(r["users"], r["union_users"]) for r in totals} == {(3, 3)}


def test_sample_ages_follow_the_published_law(spark):
    """A value stays with probability (1 - 1/n) for each later one, so the mean age of a full sample is n - 1."""
    n, pages = 20, 400
    rows = spark.range(pages * 300).select((F.col("id") % pages).cast("string").alias("page_id"), F.floor(F.col("id") / pages).cast("int").alias("depth"), F.col("id").alias("end_ms"), F.lit("s").alias("session_id"))
    slots = rows.groupBy("page_id", S.sample_slot(n, "session_id", "end_ms").alias("slot")).agg(F.max("depth").alias("depth"))
    ages = [299 - r["depth"] for r in slots.collect()]
    assert abs(np.mean(ages) - (n - 1)) < 1
    for k in (0, 5, 20, 60):
        share = sum(a >= k for a in ages) / len(ages)
        assert abs(share - (1 - 1 / n) ** k) < 0.03


def test_visitor_counts_totals_and_gate(rocks, tmp_path):
    drop(tmp_path / "in", "a.txt", [f"d t s a{i % 3} u{i}" for i in range(900)] + ["short line", "d t s few u1"])
    events = visitors.app_events(visits.read_lines(rocks, str(tmp_path / "in")), 3, 4)
    seen = []
    query = visits.start(visitors.counts(events, 12, 20), "visitors", str(tmp_path / "ckpt"), "complete", sink=visitors.totals_sink(lambda df, n: seen.extend(df.collect())))
    assert query.awaitTermination(120)
    assert abs(seen[-1]["users"] - 900) < 45 and abs(seen[-1]["union_users"] - 900) < 45


def test_reset_opens_an_epoch(rocks, tmp_path):
    def once(events, commands):
        for name, lines in (("ev", events), ("co", commands)):
            drop(tmp_path / name, f"{len(list((tmp_path / name).glob('*'))) if (tmp_path / name).exists() else 0}.txt", lines)
        e = visitors.app_events(visits.read_lines(rocks, str(tmp_path / "ev")), 0, 1)
        c = visitors.command_lines(visits.read_lines(rocks, str(tmp_path / "co")))
        seen = []
        query = visits.start(visitors.epochs(e, c), None, str(tmp_path / "ck"), "append", sink=lambda df, n: seen.extend(df.collect()))
        assert query.awaitTermination(120)
        return sorted(tuple(r) for r in seen if r["user"]), sorted(tuple(r)[:2] for r in seen if r["user"] is None)

    assert once(["p u", "q u"], ["none"]) == ([("p", 0, "u"), ("q", 0, "u")], [])
    assert once(["p v"], ["p,reset", "q,reset", "r, other"]) == ([("p", 1, "v")], [("p", 1), ("q", 1)])
    assert once(["p w", "q w"], ["none"]) == ([("p", 1, "w"), ("q", 1, "w")], [])


def test_current_epochs_and_lines(spark):
    numbered = spark.createDataFrame([("p", 0, f"u{i}") for i in range(50)] + [("p", 1, None), ("p", 1, "x"), ("q", 0, "x"), ("q", 0, "y"), ("r", 2, None), ("r", 1, "z"), (None, None, None)], visitors.EPOCHS)
    counted = visitors.epoch_counts(numbered)
    got = visitors.current(counted)
    assert sorted((r["part"], r["users"]) for r in got.collect()) == [("p", 1), ("q", 2)]
    assert sorted(r["part"] for r in visitors.current(counted, 1).collect()) == ["q"]
    (row,) = visitors.total_lines(visitors.totals(got)).collect()
    assert row["value"].split("  ")[1] == "3"
