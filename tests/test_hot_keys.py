"""Keys that hold most rows: the same results as plain folds, and a bound on the rows that meet in a task."""

import random

import pytest
from pyspark.sql import functions as F

from trailforge.operators import customer, engagement, sessions
from trailforge.operators.stretches import WIDTH_MS, neighbours, stretch

FLOW = ["/a", "/b", "/c"]
FOUND = engagement.patterns(r"/product/(\w+):1,/addToCart/(\w+):2:4,/checkOut:3:6,/placeOrder:4:10")


def by_session(plan):
    """The keys of the plan's hash exchanges."""
    return [line.split("hashpartitioning(")[1].split(", [plan")[0] for line in plan.splitlines() if "hashpartitioning(" in line]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width", [7, 1000])
def test_neighbours_against_plain_loops(spark, width):
    rng = random.Random(width)
    rows = [(rng.choice("aaaab"), rng.randrange(60), i, rng.choice([None, 1, 2])) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, ms long, i long, x int")
    got = neighbours(df, "k", ["ms", "i"], lead={"next": "x"}, lag={"prev": "x"}, first={"head": "x"}, last={"tail": "x"}, running={"upto": F.lit(1)}, total={"n": F.col("ms")}, width=width)
    found = {r["i"]: tuple(r[c] for c in ("next", "prev", "head", "tail", "upto", "n")) for r in got.collect()}
    for k in "ab":
        own = sorted((r[1:] for r in rows if r[0] == k))
        for at, (_, i, _) in enumerate(own):
            x = lambda j: own[j][2] if 0 <= j < len(own) else None
            assert found[i] == (x(at + 1), x(at - 1), x(0), x(len(own) - 1), at + 1, sum(o[0] for o in own))


def plain_items(rows):
    """item: (event, value) by one loop over the session."""
    held = {}
    for at, (ms, url) in enumerate(rows):
        spent = (rows[at + 1][0] - ms) // 1000 if at + 1 < len(rows) else 0
        name, _, item = url[1:].partition("/")
        event, value = {"product": (1, 0), "addToCart": (2, 4), "checkOut": (3, 6), "placeOrder": (4, 10)}.get(name, (0, 0))
        if not event:
            continue
        if event > 2:
            held |= {i: (event, value) for i, (e, _) in held.items() if e == event - 1}
        elif item not in held:
            held[item] = (event, value or spent)
        elif held[item][0] < event:
            held[item] = (event, value)
    return held


def plain_flow(rows):
    k = 0
    for _, url in rows:
        k += k < len(FLOW) and url.startswith(FLOW[k])
    return 2 if k == len(FLOW) else int(k > 0)


def test_sessions_over_many_stretches(spark):
    """Sessions whose hits spread over days, so that folds go over many stretches."""
    rng = random.Random(8)
    made = {}
    for s in range(25):
        at, rows = 1_700_000_000_000, []
        for _ in range(rng.choice([1, 5, 80])):
            at += rng.choice([1000, 400_000, 5_000_000])
            rows.append((at, rng.choice(["/product/A", "/product/B", "/product/C", "/addToCart/A", "/addToCart/B", "/checkOut", "/placeOrder", "/a", "/b", "/c", "/other"])))
        made[f"s{s}"] = rows
    flat = [(s, "u", ms, url, None, i) for s, rows in made.items() for i, (ms, url) in enumerate(rows)]
    df = spark.createDataFrame(flat, "session_id string, user_id string, ms long, url string, referrer string, event_id long").withColumn("ts", F.timestamp_millis("ms"))
    got = {}
    for r in engagement.engagement_events(df, FOUND).collect():
        got.setdefault(r["session_id"], {})[r["item_id"]] = (r["event_id"], r["value"])
    want = {s: plain_items(rows) for s, rows in made.items()}
    assert got == {s: items for s, items in want.items() if items}
    flow = {r["session_id"]: (r["flow_stat"], r["num_pages"], r["last_page"]) for r in sessions.session_summary(df, FLOW).collect()}
    assert flow == {s: (plain_flow(rows), len(rows), rows[-1][1]) for s, rows in made.items()}


def test_a_session_of_a_million_hits(spark):
    """Half of all rows are one session; no exchange is by session alone but of what stretches leave."""
    n = 1_000_000
    hot = spark.range(n).select(F.lit("hot").alias("session_id"), F.col("id"))
    rest = spark.range(20_000).select(F.concat(F.lit("s"), (F.col("id") % 2000).cast("string")).alias("session_id"), F.col("id"))
    i = F.col("id")
    url = F.when(i % 1000 == 7, F.concat(F.lit("/product/p"), (i % 11).cast("string"))).when(i == 900_000, "/a").when(i == 950_000, "/b").when(i == 999_990, "/c").when(i == n - 2, "/addToCart/p7").otherwise("/x")
    df = hot.union(rest).select("session_id", F.lit("u").alias("user_id"), F.timestamp_seconds(i + 1_700_000_000).alias("ts"), url.alias("url"), F.lit(None).cast("string").alias("referrer"), i.alias("event_id"))
    most = df.groupBy("session_id", stretch(F.unix_millis("ts"))).count().agg(F.max("count")).first()[0]
    assert most <= WIDTH_MS // 1000 and most < n / 200
    pages = sessions.session_pages(df)
    total = pages.where("session_id = 'hot'").agg(F.sum("time_on_page"), F.min("session_start"), F.max("session_start"), F.count("*")).first()
    assert tuple(total) == (n - 1, 1_700_000_000_000, 1_700_000_000_000, n)
    (row,) = sessions.session_summary(df, FLOW).where("session_id = 'hot'").collect()
    assert (row["flow_stat"], row["num_pages"], row["time_spent"], row["last_page"]) == (2, n, n - 1, "/x")
    items = {r["item_id"]: (r["event_id"], r["value"]) for r in engagement.engagement_events(df, FOUND).where("session_id = 'hot'").collect()}
    assert items["p7"] == (2, 4) and len(items) == 11 and all(v == (1, 1) for k, v in items.items() if k != "p7")
    # Rows of hits are dealt by session and stretch; by session alone go the edges, one row a stretch.
    keys = by_session(plan_of(pages))
    assert sum("__stretch" in k for k in keys) >= 1 and sum("__stretch" not in k for k in keys) == 1


def test_an_id_with_half_of_all_rows(spark):
    rng = random.Random(2)
    day = 86_400_000
    flat, at = [], 0
    for i in range(4000):
        at += rng.choice([day // 7, day // 2, 3 * day])
        flat.append(("hot", at, float(i % 9), i))
    flat += [(f"c{i % 400}", rng.randrange(at), 1.0, 10_000 + i) for i in range(4000)]
    df = spark.createDataFrame(flat, "cust_id string, ms long, value double, xaction_id long").withColumn("ts", F.timestamp_millis("ms"))
    own = sorted(ms for k, ms, _, _ in flat if k == "hot")
    gaps = [r["gap"] for r in customer.time_gaps(df, "day").where("id = 'hot'").orderBy("ts").collect()]
    assert gaps == [(b - a) // day for a, b in zip(own, own[1:])]
    gap = spark.createDataFrame([(float(2 * day),)], "min_gap_ms double")
    runs = customer.clusters(df, gap, F.timestamp_millis(F.lit(0)), F.timestamp_millis(F.lit(at + 9 * day))).where("id = 'hot'").orderBy("cluster").collect()
    want, first = [], own[0]
    for a, b in zip(own, [*own[1:], None]):
        if b is None or b - a > 2 * day:
            want.append((len(want), first, a, b is None))
            first = b
    assert [(r["cluster"], r["first_ms"], r["last_ms"], r["is_last"]) for r in runs] == want and len(want) > 500
    (row,) = customer.rfm(df, F.timestamp_millis(F.lit(at + 10 * day)), "day", 3).where("id = 'hot'").collect()
    assert (row["recency"], row["av_time_gap"]) == ((at + 10 * day - own[-3]) // 3 // day, sum(gaps) // len(gaps))
