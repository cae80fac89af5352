"""Small cases whose results were worked out by hand."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailforge.functions import scalars as S
from trailforge.operators import classify, customer, engagement, events, logs, search, sessions
from trailforge.plans import pipelines
from trailforge.sources import logs as L

T0 = dt.datetime(2015, 5, 15, 10, 0, 0)
SECOND = dt.timedelta(seconds=1)
SHOP = "/product/(\\w+):1,/addToCart/(\\w+):2:8,/checkOut:3:9,/placeOrder:4:10"


def click_table(spark, rows):
    """Rows of (session, user, seconds after T0, url, referrer)."""
    data = [(s, u, T0 + sec * SECOND, url, ref, i) for i, (s, u, sec, url, ref) in enumerate(rows)]
    return spark.createDataFrame(data, "session_id string, user_id string, ts timestamp, url string, referrer string, event_id long")


@pytest.fixture(scope="module")
def two_sessions(spark):
    g = "http://www.google.com"
    return click_table(
        spark,
        [
            ("S1", "U1", 0, "/search/allergy", g), ("S1", "U1", 35, "/shoppingCart", g), ("S1", "U1", 110, "/checkOut", g), ("S1", "U1", 120, "/placeOrder", g),
            ("S2", "U1", 3600, "/help", "-"), (None, "U9", 5, "/x", "-"),
        ],
    )


def test_session_pages(two_sessions):
    got = sorted(tuple(r)[:6] for r in sessions.session_pages(two_sessions).collect())
    start = 1431684000000
    assert got == [
        ("S1", "U1", start, "10:00:00", "/search/allergy", 35), ("S1", "U1", start, "10:00:35", "/shoppingCart", 75), ("S1", "U1", start, "10:01:50", "/checkOut", 10),
        ("S1", "U1", start, "10:02:00", "/placeOrder", 0), ("S2", "U1", start + 3600000, "11:00:00", "/help", 0),
    ]


SEVEN = ["/shoppingCart", "/checkOut", "/signin", "/signup", "/billing", "/confirmShipping", "/placeOrder"]


@pytest.mark.parametrize(
    "flow, first, second",
    [(SEVEN, 1, 0), (["/shoppingCart", "/checkOut", "/placeOrder"], 2, 0), (["/checkOut", "/shoppingCart"], 1, 0), (["/help"], 0, 2), (["/checkOut", "/checkOut"], 1, 0)],
)
def test_flow_status(two_sessions, flow, first, second):
    got = {r["session_id"]: r["flow_stat"] for r in sessions.session_summary(two_sessions, flow).collect()}
    assert got == {"S1": first, "S2": second}


def test_summary_and_user_summary(two_sessions):
    flow = ["/shoppingCart", "/checkOut", "/placeOrder"]
    rows = sorted(tuple(r) for r in sessions.session_summary(two_sessions, flow).collect())
    start = 1431684000000
    assert rows == [("S1", "U1", 4, start, 120, "/placeOrder", 2, "http://www.google.com"), ("S2", "U1", 1, start + 3600000, 0, "/help", 0, "-")]
    assert [tuple(r) for r in pipelines.web_analytics(two_sessions, flow).collect()] == [("U1", "http://www.google.com", 1, 2, 60, 0, 2, 3600000)]
    average = {r["session_id"]: (r["total_ms"], r["avg_ms"]) for r in sessions.session_average(sessions.session_elapsed(two_sessions)).collect()}
    assert average == {"S1": (120000, 40000), "S2": (0, None)}


def fold_flow(urls, flow):
    k = 0
    for u in urls:
        if k < len(flow) and u.startswith(flow[k]):
            k += 1
    return 2 if k == len(flow) else int(k > 0)


def fold_engagement(pages, found):
    """Plain Python: items to (event, value); pages of (second, url)."""
    import re

    state = {}
    for i, (sec, url) in enumerate(pages):
        spent = pages[i + 1][0] - sec if i + 1 < len(pages) else 0
        for p in found:
            m = re.search(p.regex, url)
            if m and p.groups:
                item = m.group(p.groups)
                if item not in state:
                    state[item] = (p.event, p.value or spent)
                elif state[item][0] < p.event:
                    state[item] = (p.event, p.value)
            elif m:
                state = {k: (p.event, p.value) if v[0] == p.event - 1 else v for k, v in state.items()}
    return state


def test_random_sessions_against_plain_folds(spark):
    rng = random.Random(8)
    found, flow = engagement.patterns(SHOP), ["/product/A", "/checkOut", "/placeOrder"]
    made = {}
    for s in range(80):
        second, pages = 0, []
        for _ in range(rng.randrange(1, 10)):
            pages.append((second, rng.choice(["/product/A", "/product/B", "/addToCart/A", "/addToCart/B", "/checkOut", "/placeOrder", "/x"])))
            second += rng.randrange(1, 60)
        made[f"s{s}"] = pages
    df = click_table(spark, [(s, "u", sec, url, "-") for s, pages in made.items() for sec, url in pages])
    got = {}
    for r in engagement.engagement_events(df, found).collect():
        got.setdefault(r["session_id"], {})[r["item_id"]] = (r["event_id"], r["value"])
    assert got == {s: state for s, p in made.items() if (state := fold_engagement(p, found))}
    status = {r["session_id"]: r["flow_stat"] for r in sessions.session_summary(df, flow).collect()}
    assert status == {s: fold_flow([u for _, u in p], flow) for s, p in made.items()}
    plain = [p for p in found if p.groups]
    items = {}
    for r in engagement.item_events(df, plain).collect():
        items.setdefault(r["session_id"], {})[r["item_id"]] = (r["event_id"], r["value"])
    assert items == {s: state for s, p in made.items() if (state := fold_engagement(p, plain))}


def test_engagement_and_rating_example(spark):
    pages = [(0, "/product/A"), (20, "/product/B"), (50, "/addToCart/A"), (60, "/product/A"), (90, "/checkOut"), (100, "/placeOrder")]
    df = click_table(spark, [("s", "u", sec, url, "-") for sec, url in pages])
    found, times = engagement.patterns(SHOP), engagement.time_mapping("10:1,20:2,35:3,55:4,80:5,120:6")
    rows = engagement.engagement_events(df, found)
    assert sorted(tuple(r)[2:] for r in rows.collect()) == [("A", 4, 10), ("B", 1, 30)]
    assert sorted(tuple(r) for r in engagement.ratings(rows, times).collect()) == [("u", "A", 10), ("u", "B", 3)]
    edges = spark.createDataFrame([("u", str(t), 1, t) for t in (0, 10, 120)], "user_id string, item_id string, event_id int, value long")
    assert {r["item_id"]: r["rating"] for r in engagement.ratings(edges, times).collect()} == {"0": 1, "10": 2, "120": 7}
    assert engagement.ratings(edges, times, item_first=True).columns == ["item_id", "user_id", "rating"]


@pytest.mark.parametrize("hits, in_session, in_stream", [([1], [0, 1, 2, 3], []), ([3], [0, 1, 2, 3, 4, 5], [0, 1, 2, 3, 4, 5])])
def test_event_context(spark, hits, in_session, in_stream):
    rows = [("s", i, i + 1, f"r{i} hit" if i in hits else f"r{i}") for i in range(6)]
    df = spark.createDataFrame(rows, "session_id string, event_id long, position long, record string").withColumn("ts", F.timestamp_seconds("event_id"))
    got = events.session_event_context(df, [("e", "hit")]).orderBy("context_offset").collect()
    assert [int(r["line"][1]) for r in got] == in_session and [r["context_offset"] for r in got] == [i - hits[0] for i in in_session]
    assert [int(r["line"][1]) for r in events.stream_event_context(df, [("e", r"r\d hit")]).orderBy("context_offset").collect()] == in_stream


def test_dense_positions_and_pattern_list(spark):
    df = spark.createDataFrame([(k,) for k in (5, 250_000, 99_999, 100_000, 7)], "key long")
    assert [tuple(r) for r in events.dense_positions(df, "key").orderBy("position").collect()] == [(5, 1), (7, 2), (99_999, 3), (100_000, 4), (250_000, 5)]
    config = {"event.pattern.1.name": "a", "event.pattern.1.regex": "x", "event.pattern.3.name": "c", "event.pattern.3.regex": "y"}
    assert events.pattern_list(config) == [("a", "x")]


DAY = dt.timedelta(days=1)
D0 = dt.datetime(2020, 1, 1)


def at(*days):
    return [D0 + d * DAY for d in days]


def test_rfm_and_stats(spark):
    rows = [("a", t, v, i) for i, (t, v) in enumerate(zip(at(0, 2.5, 5, 9), (10, 20, 30, 40)))] + [("b", D0, 1, 9), ("b", D0 + DAY, 1, 10)]
    df = spark.createDataFrame([(a, b, float(c), d) for a, b, c, d in rows], "cust_id string, ts timestamp, value double, xaction_id long")
    got = customer.rfm(df, F.lit(D0 + 19 * DAY), "day", 2, 0.5)
    assert [tuple(r) for r in got.collect()] == [("a", 2, 7, 25.0)]
    assert sorted(tuple(r) for r in customer.time_gaps(df).select("id", "gap").collect()) == [("a", 2), ("a", 2), ("a", 4), ("b", 1)]
    stats = customer.numeric_stats(customer.time_gaps(df).where("id = 'a'"), "gap").first()
    assert (stats["mean"], stats["std_dev"]) == (2.667, 0.943)
    hours = customer.rfm(df, F.lit(D0 + 19 * DAY), "hour", 2, 0.5, legacy_units=True).first()
    assert hours["av_time_gap"] == (3 + 3 + 5) // 3


def test_recency_scores(spark):
    stats = spark.createDataFrame([(10.0, 5.0)], "global_av_time_gap double, global_std_dev_time_gap double")
    df = spark.createDataFrame([("a", 1, 10, 1.0), ("b", 1, 15, 1.0)], "id string, av_time_gap long, recency long, av_value double")
    assert [r["recency"] for r in customer.recency_score(df, stats, "exponential").orderBy("id").collect()] == [0.368, 0.223]
    assert [r["recency"] for r in customer.recency_score(df, stats, "normal").orderBy("id").collect()] == [0.5, 0.159]


def test_normal_cdf_is_the_error_function(spark):
    df = spark.range(-1000, 1001).select((F.col("id") / 97).alias("z"))
    for r in df.select("z", S.normal_cdf(F.col("z"), 0, 1).alias("a"), S.normal_cdf(F.col("z") * 3 + 5, 5, 3).alias("b"), S.normal_cdf(F.col("z"), 0, 0).alias("none")).collect():
        want = 0.5 * math.erfc(-r["z"] / math.sqrt(2))
        assert abs(r["a"] - want) < 1e-14 and abs(r["b"] - want) < 1e-14 and r["none"] is None
        # The lower tail is right in proportion too.
        assert r["z"] > 0 or abs(r["a"] / want - 1) < 1e-8


def test_lifecycles(spark):
    df = spark.createDataFrame([("a", t, i) for i, t in enumerate(at(5, 10, 15, 50, 60, 95))], "cust_id string, ts timestamp, xaction_id long")
    gap = spark.createDataFrame([(20.0 * 86_400_000,)], "min_gap_ms double")
    start, end = F.lit(D0), F.lit(D0 + 100 * DAY)
    runs = customer.clusters(df, gap, start, end)
    ms0 = int(D0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)

    def days(mode, **kw):
        rows = customer.lifecycles(runs, mode, start, end, **kw).collect()
        return sorted(tuple(None if r[c] is None else (r[c] - ms0) // 86_400_000 for c in ("start_ms", "end_ms")) for r in rows)

    assert days("all") == [(0, 15), (50, 60), (95, 100)]
    assert days("complete") == [(50, 60)] and days("current") == [(95, 100)] and days("current", use_horizon=False) == [(95, None)]
    assert [r["length"] for r in customer.lifecycle_length(customer.lifecycles(runs, "complete", start, end)).collect()] == [10]


def test_retention(spark):
    ms = lambda *d: int(dt.datetime(*d, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(ms(2024, 1, 10), ms(2024, 3, 5)), (ms(2024, 1, 20), None), (None, ms(2024, 1, 31))], "start_ms long, end_ms long")
    assert sorted(tuple(r) for r in customer.retention(df, "month").collect()) == [(2024, 0, 2, 1, 1), (2024, 2, 0, 1, -1)]
    assert [tuple(r) for r in customer.retention(df, "year").collect()] == [(2024, 2, 2, 0)]


def test_normalize_and_weighted_average(spark):
    df = spark.createDataFrame([("a", 0.0, 5.0), ("b", 4.0, 5.0)], "id string, x double, y double")
    got = customer.normalize(df, ["x", "y"], inverted=("x",)).orderBy("id")
    assert [tuple(r) for r in got.collect()] == [("a", 100.0, 0.0), ("b", 0.0, 0.0)]
    assert [tuple(r) for r in customer.weighted_average(got, {"x": 30, "y": 70}).orderBy("id").collect()] == [("a", 30), ("b", 0)]


def test_posterior(spark):
    rows = [(0, 1)] * 3 + [(0, 2)] + [(1, 1)] + [(1, 2)] * 3 + [(1, 5), (0, 6)]
    counts = classify.class_counts(spark.createDataFrame(rows, "class int, value int"))
    assert sorted((r["class"], r["value"] or 0, r["count"]) for r in counts.collect())[:2] == [(0, 0, 5), (0, 1, 3)]
    got = {r["value"]: r["posterior"] for r in classify.class_posterior(counts).collect()}
    assert got[1] == pytest.approx(0.25) and got[2] == pytest.approx(0.75) and got[5] == 1 and got[6] == 0 and got[3] is None


def test_ndcg(spark):
    scores = spark.createDataFrame([("q", "a", 3.0), ("q", "b", 2.0), ("q", "c", 1.0), ("z", "a", 1.0), ("q", "a", 0.5)], "query_id string, doc_id string, score double")
    rel = spark.createDataFrame([("q", "a", 1), ("q", "b", 1), ("q", "b", 1), ("q", "b", 1), ("q", "only", 9)], "query_id string, doc_id string, relevance int")
    summed = search.relevance(rel)
    got = {r["query_id"]: r["ndcg"] for r in search.ndcg(scores, summed).collect()}
    assert got == {"q": 0.71, "z": None}
    logged = {r["query_id"]: r["ndcg"] for r in search.ndcg(scores, summed, "logNatural", None).collect()}
    assert logged["q"] == pytest.approx(1 / math.log2(3))


def test_depth_columns(spark):
    df = spark.createDataFrame([("p", i, 1, d, i) for i, d in enumerate([1, 1, 3, 1])], "page_id string, session_id long, visit int, depth long, end_ms long")
    assert [tuple(r) for r in pipelines.depth_stats(df, 20, 4).collect()] == [("p", 75, "1:3,3:1", 2)]
    assert pipelines.depth_stats(df, 20, 5).collect() == [] and pipelines.depth_stats(df, 2, 1).first()["depth_distr"] == "1:1,3:1"


def test_scalars(spark):
    df = spark.createDataFrame([(" a | b ", "x=1;+SES=s=9;+SESX=t", -7)], "t string, c string, n int")
    tokens = S.split_tokens(F.col("t"), r"\|")
    row = df.select(
        tokens.alias("tokens"), S.sublist(tokens, 0, 1).alias("one"), S.sublist(tokens, 1, 5).alias("none"), S.pick(tokens, [1, 0]).alias("picked"),
        S.cookie_value(F.col("c"), "SES").alias("last"), S.cookie_value(F.col("c"), "no").alias("no"), S.int_div(F.col("n"), 2).alias("half"),
        S.int_div(F.col("n"), 0).alias("zero"), S.group(F.col("c"), r"x=(\d)").alias("g"), S.whole(F.col("c"), "x").alias("w"),
        S.pad_number(F.lit(5), 3).alias("p"), S.map_str(S.str_map(F.lit("b:2,a:1"))).alias("m"), S.fixed(F.lit(1.23456), 3).alias("f"),
    ).first()
    assert tuple(row) == (["a", "b"], ["a"], [], ["b", "a"], "t", None, -3, None, "1", False, "005", "a:1,b:2", 1.235)
    with pytest.raises(ValueError):
        S.unit_ms("year")


def test_logs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "ab.log").write_text("GET /x\nGET /yé\n\nlast")
    lines = L.read_lines_with_offsets(spark, str(tmp_path / "in")).orderBy("line_no")
    assert [(r["line_no"], r["byte_offset"], r["value"]) for r in lines.collect()] == [(0, 0, "GET /x"), (1, 7, "GET /yé"), (2, 16, ""), (3, 17, "last")]
    assert logs.tokenize(lines).orderBy("byte_offset").first()["tokens"] == "ab.logxx:000000000000 000:GET 001:/x"
    assert L.read_lines(spark, str(tmp_path / "in")).first()["file"] == "ab.log"
    raw = spark.createDataFrame([("f_1", 0, "  lost"), ("f_1", 1, "2020-01-01 00:00:01 a"), ("f_1", 2, "  more"), ("g_1", 0, "2020-01-01 00:00:00 b")], "file string, line_no int, value string")
    merged = logs.merge_logs(raw).collect()
    assert [(r["source"], r["record"]) for r in merged] == [("g", "g 2020-01-01 00:00:00 b"), ("f", "f 2020-01-01 00:00:01 a\\nf   more")]
    other = L.multi_line(raw, r"^\s", starts=False).orderBy("file").collect()
    assert [r["record"] for r in other] == ["2020-01-01 00:00:01 a\\n  more", "2020-01-01 00:00:00 b"]
    parts = logs.partition_lines(raw, r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)", "yyyy-MM-dd HH:mm:ss", unit="hour", low="2020-01-01 00:00:00")
    assert [(r["partition"], r["line"]) for r in parts.collect()] == [("000000438288", "2020-01-01 00:00:01 a")]
    logs.write_partitions(parts, str(tmp_path / "parts"))
    assert (tmp_path / "parts" / "partition=000000438288").exists() or any("438288" in p.name for p in (tmp_path / "parts").iterdir())


def test_parsers_and_files(spark, tmp_path):
    ncsa = '1.2.3.4 - me [10/Oct/2020:13:55:36 +0000] "GET /a b" 200 12 "http://r" "agent x" "a=1;sid=s1;uid=u"'
    w3c = "2020-10-10 13:55:36 1.2.3.4 me 5.6.7.8 GET /a q=1 200 1 2 3 HTTP/1.1 agent sid=s2;uid=u2 http://r"
    df = spark.createDataFrame([(ncsa,), (w3c,), ("junk",)], "value string")
    got = L.parse_log(df, L.NCSA, ["sessionId", "userId", "status", "csNumBytes", "referrer", "dateTimeEpoch"], "sid", "uid").collect()
    assert [tuple(r) for r in got] == [("s1", "u", "200", 12, "http://r", 1602338136000)]
    got = L.parse_log(df, L.W3C, ["sessionId", "userId", "scNumBytes", "timeTaken", "referrer"], "sid", "uid").collect()
    assert [tuple(r) for r in got] == [("s2", "u2", 1, 3, "http://r")]
    with pytest.raises(ValueError):
        L.parse_log(df, "CSV", [], "sid")
    own = lambda line, session, user: F.struct(line.alias("sessionId"), F.length(line).cast("long").alias("dateTimeEpoch"))
    assert L.parse_log(df, own, ["sessionId"], "sid").count() == 3
    text = spark.createDataFrame([("7", "8", "x"), ("y", "9", "z")], "timeTaken string, dateTimeEpoch string, url string")
    assert [tuple(r) for r in L.typed(text).collect()] == [(7, 8, "x"), (None, 9, "z")]
    stats = spark.createDataFrame([(1.5, 2.5)], "a double, b double")
    L.write_stats(stats, str(tmp_path / "stats"))
    assert tuple(L.read_stats(spark, str(tmp_path / "stats"), ["a", "b"]).first()) == (1.5, 2.5)
    with pytest.raises(Exception, match="no statistic c"):
        L.read_stats(spark, str(tmp_path / "stats"), ["c"]).collect()
    L.write_lines(spark.createDataFrame([(1, "x"), (2, None)], "n int, s string"), str(tmp_path / "csv"), files=1)
    back = L.read_delimited(spark, str(tmp_path / "csv"), {"s": (1, "string"), "n": (0, "int")})
    assert sorted(tuple(r) for r in back.collect()) == [("", 2), ("x", 1)]


def test_lines_of_a_file_in_many_tasks(spark, tmp_path):
    rng = random.Random(2)
    lines = [("2020-01-01 00:00:%02d %d " % (i % 60, i) if rng.random() < 0.5 else "  more ") + "é" * rng.randrange(40) + ("\r" if i % 50 == 0 else "") for i in range(4000)]
    (tmp_path / "a_1.log").write_bytes("\n".join(lines).encode() + b"\n")
    (tmp_path / "b_1.log").write_bytes(b"x\n\n2020-01-01 00:00:00 last")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.minPartitionNum", "20")
    try:
        read = L.read_lines_with_offsets(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        found = sorted((r["file"], r["line_no"], r["byte_offset"], r["value"]) for r in read.collect())
        records = {(r["file"], r["line_no"]): r["record"] for r in L.multi_line(read, r"^\d{4}-", width=64, sep="\n").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    want, at = [], 0
    for i, x in enumerate(lines):
        want.append(("a_1.log", i, at, x.rstrip("\r")))
        at += len(x.encode()) + 1
    assert found == [*want, ("b_1.log", 0, 0, "x"), ("b_1.log", 1, 2, ""), ("b_1.log", 2, 3, "2020-01-01 00:00:00 last")]
    plain, begin = {}, None
    for i, x in enumerate(lines):
        x = x.rstrip("\r")
        if x.startswith("2020-"):
            begin = i
            plain["a_1.log", i] = x
        elif begin is not None:
            plain["a_1.log", begin] += "\n" + x
    assert records == plain | {("b_1.log", 2): "2020-01-01 00:00:00 last"}


def test_wide_ranges_and_far_positions(spark, monkeypatch):
    rows = spark.createDataFrame([(0, 0), (1, 30_000), (1, 30_000)], "class int, value int")
    got = classify.class_posterior(classify.class_counts(rows))
    assert got.count() == 30_001 and got.where("value = 30000").first()["posterior"] == 1.0
    monkeypatch.setattr(events, "STRETCH", 3)
    keys = sorted(random.Random(4).sample(range(10**6), 500))
    placed = events.dense_positions(spark.createDataFrame([(k,) for k in keys], "k long"), "k", width=1000).collect()
    assert {r["k"]: r["position"] for r in placed} == {k: i + 1 for i, k in enumerate(keys)}


def test_steps_promote_each_item_alone(spark):
    hits = [("/product/a", 0), ("/addToCart/b", 5), ("/product/a", 7), ("/checkOut", 9), ("/product/c", 12), ("/placeOrder", 20)]
    clicks = click_table(spark, [("s", "u", sec, url, None) for url, sec in hits])
    got = {r["item_id"]: (r["event_id"], r["value"]) for r in engagement.engagement_events(clicks, engagement.patterns(SHOP)).collect()}
    assert got == {"a": (1, 5), "b": (4, 10), "c": (1, 8)}


def plain_logit(x, y, ridge=0.0):
    """Newton steps with numpy over all rows at once."""
    x = np.column_stack([np.ones(len(x)), x])
    w, held = np.zeros(x.shape[1]), np.diag([0.0, *[ridge] * (x.shape[1] - 1)])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + held, x.T @ (y - p) - held @ w)
    return w


def test_logit_against_a_plain_fit(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(0, 1, 3000), rng.exponential(20, 3000), rng.integers(0, 2, 3000)])
    y = (rng.random(3000) < 1 / (1 + np.exp(-(0.7 * x[:, 0] - 0.1 * x[:, 1] + 2 * x[:, 2] + 0.3)))).astype(int)
    rows = [(float(a), float(b), int(c), int(k)) for (a, b, c), k in zip(x, y)]
    df = spark.createDataFrame([*rows, (None, 1.0, 1, 1), (1.0, 1.0, 1, None)], "a double, b double, c int, class int")
    for ridge in (0.0, 5.0):
        fitted = classify.logit_fit(df, ["a", "b", "c"], ridge=ridge)
        got = [r["weight"] for r in fitted.collect()]
        assert [r["term"] for r in fitted.collect()] == ["(intercept)", "a", "b", "c"]
        assert np.abs(np.array(got) - plain_logit(x, y, ridge)).max() < 1e-8
    scored = classify.logit_score(df, fitted, ["a", "b", "c"])
    assert scored.where("probability is null").count() == 1
    right = scored.dropna().where("(probability > 0.5) = (class = 1)").count()
    assert right > 0.7 * len(rows)
    one = classify.logit_fit(spark.createDataFrame([(1.0, 0), (2.0, 1), (3.0, 0), (2.0, 1)], "a double, class int"), ["a"])
    assert np.abs(np.array([r["weight"] for r in one.collect()]) - plain_logit(np.array([1.0, 2, 3, 2]), np.array([0, 1, 0, 1]))).max() < 1e-8
    assert [r["weight"] for r in classify.logit_fit(df.limit(0), ["a"]).collect()] == [0.0, 0.0]


def test_a_byte_order_mark_counts(spark, tmp_path):
    for name, data, want in (("a", b"\xef\xbb\xbfab\ncd\n", [0, 6]), ("b", b"\xef\xbb\xbfab\r\ncd", [0, 7]), ("c", b"ab\ncd", [0, 3]), ("d", b"ab\n\n\n", [0, 3, 4])):
        (tmp_path / name).write_bytes(data)
        got = L.read_lines_with_offsets(spark, str(tmp_path / name)).orderBy("line_no").collect()
        assert [r["byte_offset"] for r in got] == want and [r["line_no"] for r in got] == list(range(len(want))), name
