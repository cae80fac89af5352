"""Every query over the driver's tables by name, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailforge.functions import scalars as S, sql
from trailforge.operators import classify, customer, engagement, events, logs, search, sessions
from trailforge.plans import pipelines
from trailforge.sources import logs as L

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

FLOW = ["/view", "/click", "/purchase"]
PATTERNS = "^/view/(\\w+)$:1,^/click/(\\w+)$:2:8,^/signup$:3:9,^/purchase$:4:10"
RATING_TIMES = "10:1,20:2,35:3,55:4,80:5,120:6"
REF_DATE = "2001-09-01"
HORIZON = ("1995-01-01", "2001-08-01")
ORDERS = customer.Transactions("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as page views; a session is a user's week."""
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), week).alias("session_id"), "user_id", "ts", F.concat(F.lit("/"), "event_type").alias("url"), F.col("props").alias("referrer"), "event_id"
    )


CLICKS = """clicks AS (
  SELECT user_id || '-' || strftime(date_trunc('week', ts), '%Y-%m-%d') AS session_id, user_id, ts, epoch_us(ts) // 1000 AS ms, '/' || event_type AS url, props AS referrer, event_id FROM events)"""


@query(f"""WITH {CLICKS}
SELECT session_id, first_value(user_id) OVER w AS user_id, first_value(ms) OVER w AS session_start, strftime(ts, '%H:%M:%S') AS visit_time, url,
  coalesce((lead(ms) OVER w - ms) // 1000, 0)::BIGINT AS time_on_page, event_id FROM clicks WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id)""")
def session_pages(spark, sf_dir):
    return sessions.session_pages(clicks(spark, sf_dir))


@query(f"""WITH {CLICKS}
SELECT session_id, event_id, url, ms AS epoch_ms, coalesce(lead(ms) OVER (PARTITION BY session_id ORDER BY ts, event_id) - ms, 0)::BIGINT AS elapsed_ms FROM clicks""")
def session_elapsed(spark, sf_dir):
    return sessions.session_elapsed(clicks(spark, sf_dir))


SUMMARY = f"""{CLICKS},
placed AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS n FROM clicks),
one AS (SELECT session_id, min(n) AS n FROM placed WHERE starts_with(url, '{FLOW[0]}') GROUP BY session_id),
two AS (SELECT p.session_id, min(p.n) AS n FROM placed p JOIN one USING (session_id) WHERE p.n > one.n AND starts_with(url, '{FLOW[1]}') GROUP BY p.session_id),
three AS (SELECT p.session_id, min(p.n) AS n FROM placed p JOIN two USING (session_id) WHERE p.n > two.n AND starts_with(url, '{FLOW[2]}') GROUP BY p.session_id),
summary AS (
  SELECT session_id, arg_min(user_id, p.n) AS user_id, count(*)::BIGINT AS num_pages, min(ms) AS time_start, ((max(ms) - min(ms)) // 1000)::BIGINT AS time_spent, arg_max(url, p.n) AS last_page,
    (CASE WHEN any_value(three.n) IS NOT NULL THEN 2 WHEN any_value(one.n) IS NOT NULL THEN 1 ELSE 0 END)::INT AS flow_stat, arg_min(referrer, p.n) AS referrer
  FROM placed p LEFT JOIN one USING (session_id) LEFT JOIN three USING (session_id) GROUP BY session_id)"""


@query(f"WITH {SUMMARY} SELECT * FROM summary")
def session_summary(spark, sf_dir):
    return sessions.session_summary(clicks(spark, sf_dir), FLOW)


@query(f"WITH {SUMMARY} SELECT flow_stat, count(*)::BIGINT AS sessions FROM summary GROUP BY flow_stat")
def flow_status(spark, sf_dir):
    return sessions.session_summary(clicks(spark, sf_dir), FLOW).groupBy("flow_stat").agg(F.count(F.lit(1)).alias("sessions"))


@query(f"""WITH {CLICKS},
e AS (SELECT session_id, event_id, url, ms, coalesce(lead(ms) OVER (PARTITION BY session_id ORDER BY ts, event_id) - ms, 0) AS elapsed FROM clicks)
SELECT session_id, min(ms) AS start_ms, arg_min(url, (ms, event_id)) AS first_url, sum(elapsed)::BIGINT AS total_ms, count(*)::BIGINT AS num_pages,
  CASE WHEN count(*) > 1 THEN (sum(elapsed) // (count(*) - 1))::BIGINT END AS avg_ms FROM e GROUP BY session_id""")
def session_average(spark, sf_dir):
    return sessions.session_average(sessions.session_elapsed(clicks(spark, sf_dir)))


@query(f"""WITH {SUMMARY},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_start, session_id) AS n FROM summary)
SELECT user_id, arg_min(referrer, n) AS referrer, coalesce(max(n) FILTER (flow_stat = 2), 0)::INT AS count_to_conversion, (sum(num_pages) // count(*))::BIGINT AS av_num_pages,
  (sum(time_spent) // count(*))::BIGINT AS av_time_spent, (arg_max(flow_stat, n) = 2)::INT AS status, count(*)::BIGINT AS session_count,
  CASE WHEN count(*) > 1 THEN ((max(time_start) - min(time_start)) // (count(*) - 1))::BIGINT ELSE 0 END AS av_in_between FROM r GROUP BY user_id""")
def user_session_summary(spark, sf_dir):
    return pipelines.web_analytics(clicks(spark, sf_dir), FLOW)


def item_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks whose views and clicks name an item, k of props modulo 20."""
    k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("int") % 20
    named = F.col("url").isin("/view", "/click")
    return clicks(spark, sf_dir).withColumn("props", F.col("referrer")).withColumn("url", F.when(named, F.concat("url", F.lit("/"), k.cast("string"))).otherwise(F.col("url"))).drop("props")


ITEM_HITS = f"""{CLICKS},
timed AS (SELECT *, coalesce((lead(ms) OVER w - ms) // 1000, 0) AS spent, first_value(user_id) OVER w AS first_user FROM clicks WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id)),
hits AS (
  SELECT session_id, first_user AS user_id, ts, event_id AS tie, spent, (regexp_extract(referrer, '"k": (\\d+)', 1)::INT % 20)::VARCHAR AS item,
    CASE url WHEN '/view' THEN 1 ELSE 2 END AS event, CASE url WHEN '/view' THEN 0 ELSE 8 END AS value FROM timed WHERE url IN ('/view', '/click')),
items AS (
  SELECT session_id, any_value(user_id) AS user_id, item AS item_id, max(event)::INT AS event_id,
    (CASE WHEN max(event) = 1 THEN arg_min(spent, (ts, tie)) ELSE 8 END)::BIGINT AS value FROM hits GROUP BY session_id, item)"""


@query(f"WITH {ITEM_HITS} SELECT * FROM items")
def engagement_item(spark, sf_dir):
    return engagement.item_events(item_clicks(spark, sf_dir), engagement.patterns(PATTERNS))


# Every promotion depends on where its items stand, so an item's state is followed step by step:
# by its first view, first click, and the first sign-up and purchase that find it one event below.
@query(f"""WITH RECURSIVE {CLICKS},
timed AS (SELECT *, coalesce((lead(ms) OVER w - ms) // 1000, 0) AS spent, first_value(user_id) OVER w AS first_user, row_number() OVER w AS n
  FROM clicks WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id)),
hits AS (
  SELECT session_id, first_user, n, spent, CASE WHEN url IN ('/view', '/click') THEN (regexp_extract(referrer, '"k": (\\d+)', 1)::INT % 20)::VARCHAR END AS item,
    CASE url WHEN '/view' THEN 1 WHEN '/click' THEN 2 WHEN '/signup' THEN 3 ELSE 4 END AS event, CASE url WHEN '/view' THEN 0 WHEN '/click' THEN 8 WHEN '/signup' THEN 9 ELSE 10 END AS value
  FROM timed WHERE url IN ('/view', '/click', '/signup', '/purchase')),
born AS (SELECT session_id, item, min(n) AS n FROM hits WHERE item IS NOT NULL GROUP BY session_id, item),
steps AS (
  SELECT b.session_id, b.item, h.first_user, h.event, h.value, h.spent, row_number() OVER (PARTITION BY b.session_id, b.item ORDER BY h.n) AS k
  FROM born b JOIN hits h ON h.session_id = b.session_id AND h.n >= b.n AND (h.item = b.item OR h.item IS NULL)),
walk AS (
  SELECT session_id, item, first_user, k, event, CASE WHEN value = 0 THEN spent ELSE value END AS value FROM steps WHERE k = 1
  UNION ALL
  SELECT w.session_id, w.item, w.first_user, s.k,
    CASE WHEN (s.event <= 2 AND w.event < s.event) OR (s.event > 2 AND w.event = s.event - 1) THEN s.event ELSE w.event END,
    CASE WHEN (s.event <= 2 AND w.event < s.event) OR (s.event > 2 AND w.event = s.event - 1) THEN s.value ELSE w.value END
  FROM walk w JOIN steps s ON s.session_id = w.session_id AND s.item = w.item AND s.k = w.k + 1)
SELECT session_id, any_value(first_user) AS user_id, item AS item_id, arg_max(event, k)::INT AS event_id, arg_max(value, k)::BIGINT AS value FROM walk GROUP BY session_id, item""")
def engagement_promote(spark, sf_dir):
    return engagement.engagement_events(item_clicks(spark, sf_dir), engagement.patterns(PATTERNS))


def _ladder(column: str) -> str:
    pairs = engagement.time_mapping(RATING_TIMES)
    return "CASE " + " ".join(f"WHEN {column} < {t} THEN {r}" for t, r in pairs) + f" ELSE {pairs[-1][1] + 1} END"


@query(f"""WITH {ITEM_HITS},
p AS (SELECT user_id, item_id, max(value) FILTER (event_id <> 1) AS best, coalesce(sum(value) FILTER (event_id = 1), 0) AS spent FROM items GROUP BY user_id, item_id)
SELECT user_id, item_id, coalesce(best, {_ladder("spent")})::BIGINT AS rating FROM p""")
def rating(spark, sf_dir):
    return engagement.ratings(engagement_item(spark, sf_dir), engagement.time_mapping(RATING_TIMES))


@query("""WITH e AS (
  SELECT user_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 0 END AS event_id,
    (regexp_extract(props, '"k": (\\d+)', 1)::INT % 20)::VARCHAR AS item_id, floor(value)::BIGINT AS value FROM events),
p AS (SELECT user_id, item_id, max(value) FILTER (event_id <> 1) AS best, coalesce(sum(value) FILTER (event_id = 1), 0) AS spent FROM e GROUP BY user_id, item_id)
SELECT item_id, user_id, coalesce(best, """ + _ladder("spent") + ")::BIGINT AS rating FROM p")
def rating_item_first(spark, sf_dir):
    kind = F.expr("CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 0 END")
    k = (F.regexp_extract("props", r'"k": (\d+)', 1).cast("int") % 20).cast("string")
    rows = table(spark, sf_dir, "events").select("user_id", kind.alias("event_id"), k.alias("item_id"), F.floor("value").alias("value"))
    return engagement.ratings(rows, engagement.time_mapping(RATING_TIMES), item_first=True)


EVENT_PATTERNS = [("failed", "error"), ("sold", "purchase .*7$")]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks(spark, sf_dir).select("session_id", "ts", "event_id", F.concat(F.substring("url", 2, 20), F.lit(" "), F.col("event_id").cast("string")).alias("record"))


RECORDS = f"""{CLICKS},
records AS (SELECT session_id, ts, event_id, url[2:] || ' ' || event_id AS record, row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS n FROM clicks),
patterns AS (SELECT * FROM (VALUES ('failed', 'error'), ('sold', 'purchase .*7$')) AS v(event, regex))"""


@query(f"""WITH {RECORDS}
SELECT m.session_id, p.event, m.n::INT AS match_no, (r.n - m.n)::INT AS context_offset, r.record AS line
FROM records m JOIN patterns p ON regexp_matches(m.record, p.regex) JOIN records r ON r.session_id = m.session_id AND r.n BETWEEN m.n - 3 AND m.n + 2""")
def event_context(spark, sf_dir):
    return events.session_event_context(records(spark, sf_dir), EVENT_PATTERNS)


@query("""WITH records AS (SELECT event_type || ' ' || event_id AS record, row_number() OVER (ORDER BY event_id) AS n FROM events)
SELECT 'failed' AS event, m.n AS match_no, (r.n - m.n)::INT AS context_offset, r.record AS line
FROM records m JOIN records r ON r.n BETWEEN m.n - 3 AND m.n + 2 WHERE regexp_full_match(m.record, 'error .*') AND m.n > 3 AND m.n <= (SELECT max(n) FROM records) - 2""")
def event_context_stream(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("record"))
    return events.stream_event_context(events.dense_positions(rows, "event_id"), [("failed", "error .*")])


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as files of lines, one file for each event type; errors have a second line."""
    first = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.concat(F.lit("user="), F.col("user_id").cast("string")), "props")
    lines = F.when(F.col("event_type") == "error", F.array(first, F.concat(F.lit("  caused by event "), F.col("event_id").cast("string")))).otherwise(F.array(first))
    return table(spark, sf_dir, "events").select(F.concat("event_type", F.lit("_log")).alias("file"), "event_id", F.posexplode(lines).alias("i", "value")).select(
        "file", (F.col("event_id") * 2 + F.col("i")).alias("line_no"), "value"
    )


FIRST_LINE = "strftime(ts, '%Y-%m-%d %H:%M:%S') || ' user=' || user_id || ' ' || props"


@query(f"""SELECT date_trunc('second', ts) AS ts, event_type AS source, event_id * 2 AS line_no,
  event_type || ' ' || {FIRST_LINE} || CASE WHEN event_type = 'error' THEN '\\n' || event_type || '   caused by event ' || event_id ELSE '' END AS record FROM events""")
def log_merge(spark, sf_dir):
    return logs.merge_logs(log_lines(spark, sf_dir))


TIME = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)"
FORMAT = "yyyy-MM-dd HH:mm:ss"
PART_SQL = "SELECT {part} AS partition, date_trunc('second', ts) AS ts, {line} AS line FROM events WHERE date_trunc('second', ts) > '2024-01-05 00:00:00' AND date_trunc('second', ts) < '2024-01-25 00:00:00'"


def _partitioned(spark, sf_dir, **how):
    return logs.partition_lines(log_lines(spark, sf_dir), TIME, FORMAT, low="2024-01-05 00:00:00", high="2024-01-25 00:00:00", **how)


@query(PART_SQL.format(part="lpad((epoch_us(ts) // 1000 // 3600000)::VARCHAR, 12, '0')", line=FIRST_LINE))
def log_partition_hour(spark, sf_dir):
    return _partitioned(spark, sf_dir, unit="hour")


@query(PART_SQL.format(part="lpad((epoch_us(ts) // 1000 // 86400000)::VARCHAR, 12, '0')", line=FIRST_LINE))
def log_partition_day(spark, sf_dir):
    return _partitioned(spark, sf_dir, unit="day")


@query(PART_SQL.format(part="user_id::VARCHAR", line=FIRST_LINE))
def log_partition_entity(spark, sf_dir):
    return _partitioned(spark, sf_dir, entity_regex=r"user=(\d+)")


ALL_PART_SQL = "SELECT {part} AS partition, date_trunc('second', ts) AS ts, {line} AS line FROM events"


@query(ALL_PART_SQL.format(part="lpad((epoch_us(ts) // 1000 // 3600000)::VARCHAR, 12, '0')", line=FIRST_LINE))
def log_partition_hour_all(spark, sf_dir):
    """Every line with a time; the variants without `_all` show the open time interval."""
    return logs.partition_lines(log_lines(spark, sf_dir), TIME, FORMAT, unit="hour")


@query(ALL_PART_SQL.format(part="lpad((epoch_us(ts) // 1000 // 86400000)::VARCHAR, 12, '0')", line=FIRST_LINE))
def log_partition_day_all(spark, sf_dir):
    return logs.partition_lines(log_lines(spark, sf_dir), TIME, FORMAT, unit="day")


@query(ALL_PART_SQL.format(part="user_id::VARCHAR", line=FIRST_LINE))
def log_partition_entity_all(spark, sf_dir):
    return logs.partition_lines(log_lines(spark, sf_dir), TIME, FORMAT, entity_regex=r"user=(\d+)")


@query(f"""WITH l AS (SELECT event_type || '_log' AS file, event_id * 10 AS byte_offset, string_split({FIRST_LINE}, ' ') AS ts FROM events WHERE event_type <> 'error')
SELECT file, byte_offset, rpad(file[1:8], 8, 'x') || ':' || lpad(byte_offset::VARCHAR, 12, '0') || ' '
  || array_to_string(list_transform(ts, lambda t, i: lpad((i - 1)::VARCHAR, 3, '0') || ':' || t), ' ') AS tokens FROM l""")
def log_tokens(spark, sf_dir):
    """Lines of the files without errors; `log_tokens_all` has every line."""
    lines = log_lines(spark, sf_dir).where("file <> 'error_log'").withColumn("byte_offset", F.col("line_no") * 5)
    return logs.tokenize(lines)


@query(f"""WITH l AS (SELECT event_type || '_log' AS file, event_id * 10 AS byte_offset, string_split({FIRST_LINE}, ' ') AS ts FROM events
  UNION ALL SELECT 'error_log', event_id * 10 + 5, ['', 'caused', 'by', 'event', event_id::VARCHAR] FROM events WHERE event_type = 'error')
SELECT file, byte_offset, rpad(file[1:8], 8, 'x') || ':' || lpad(byte_offset::VARCHAR, 12, '0') || ' '
  || array_to_string(list_transform(ts, lambda t, i: lpad((i - 1)::VARCHAR, 3, '0') || ':' || t), ' ') AS tokens FROM l""")
def log_tokens_all(spark, sf_dir):
    return logs.tokenize(log_lines(spark, sf_dir).withColumn("byte_offset", F.col("line_no") * 5))


RFM = f"""o AS (
  SELECT o_custkey AS id, epoch_ms(o_orderdate) AS ms, o_totalprice AS value, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS back,
    count(*) OVER (PARTITION BY o_custkey) AS n, (ms - lag(ms) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) // 86400000 AS gap FROM orders),
k AS (SELECT *, least(2, greatest(1, floor(n * 0.5)::INT)) AS k FROM o),
rfm AS (
  SELECT id, (sum(gap) // count(gap))::BIGINT AS av_time_gap, ((epoch_ms(TIMESTAMP '{REF_DATE}') - max(ms) FILTER (back = k)) // max(k) // 86400000)::BIGINT AS recency, ((sum(round(value * 10000)::HUGEINT) + 50 * count(*)) // (100 * count(*)) / 100.0)::DOUBLE AS av_value
  FROM k GROUP BY id HAVING count(gap) >= 2),
stats AS (
  SELECT min(av_time_gap) AS min_av_time_gap, max(av_time_gap) AS max_av_time_gap, min(av_value) AS min_av_value, max(av_value) AS max_av_value,
    round(avg(av_time_gap), 3) AS global_av_time_gap, round(stddev_pop(av_time_gap), 3) AS global_std_dev_time_gap FROM rfm)"""


def _rfm(spark, sf_dir):
    return customer.rfm(table(spark, sf_dir, "orders"), F.lit(REF_DATE).cast("timestamp"), "day", 2, 0.5, ORDERS)


@query(f"WITH {RFM} SELECT * FROM rfm")
def rfm(spark, sf_dir):
    return _rfm(spark, sf_dir)


@query("SELECT count(*)::BIGINT AS ids FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) < 3)")
def short_histories(spark, sf_dir):
    return customer.short_histories(table(spark, sf_dir, "orders"), ORDERS)


@query(f"WITH {RFM} SELECT * FROM stats")
def rfm_stats(spark, sf_dir):
    return customer.rfm_stats(_rfm(spark, sf_dir))


@query(f"WITH {RFM} SELECT id, av_time_gap, round(exp(-recency / global_av_time_gap), 3) AS recency, av_value FROM rfm, stats")
def recency_exp(spark, sf_dir):
    scored = _rfm(spark, sf_dir)
    return customer.recency_score(scored, customer.rfm_stats(scored), "exponential")


#: The integral of the error function by Simpson's rule over 1,000 steps, past 6 as good as 1.
_ERF = "2 / sqrt(pi()) * x / 3000 * list_sum(list_transform(range(1001), lambda i: CASE WHEN i IN (0, 1000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(-(x * i / 1000) * (x * i / 1000))))"
NORMAL = f"""{RFM},
z AS (SELECT id, av_time_gap, av_value, (recency - global_av_time_gap) / global_std_dev_time_gap / sqrt(2) AS z FROM rfm, stats),
t AS (SELECT *, least(abs(z), 6) AS x FROM z),
e AS (SELECT *, {_ERF} AS erf FROM t),
scored AS (SELECT id, av_time_gap, round(1 - CASE WHEN z >= 0 THEN (1 + erf) / 2 ELSE (1 - erf) / 2 END, 3) AS recency, av_value FROM e)"""


@query(f"WITH {NORMAL} SELECT * FROM scored")
def recency_normal(spark, sf_dir):
    scored = _rfm(spark, sf_dir)
    return customer.recency_score(scored, customer.rfm_stats(scored), "normal")


def _norm(column: str, inverted: bool = False) -> str:
    part = f"({column} - min({column}) OVER ()) / (max({column}) OVER () - min({column}) OVER ()) * 100"
    return f"round({f'100 - {part}' if inverted else part}, 3) AS {column}"


NORMED = f"""{NORMAL}, normed AS (SELECT id, {_norm("av_time_gap", True)}, {_norm("recency")}, {_norm("av_value")} FROM scored)"""


@query(f"WITH {NORMED} SELECT * FROM normed")
def normalized(spark, sf_dir):
    return customer.normalize(recency_normal(spark, sf_dir), ["av_time_gap", "recency", "av_value"], inverted=("av_time_gap",))


@query(f"WITH {NORMED} SELECT id, floor((av_time_gap * 30.0 + recency * 25.0 + av_value * 45.0) / 100.0)::INT AS score FROM normed")
def clv(spark, sf_dir):
    return pipelines.lifetime_value(table(spark, sf_dir, "orders"), F.lit(REF_DATE).cast("timestamp"), ORDERS)


GAPS = """gaps AS (SELECT * FROM (
  SELECT o_custkey AS id, o_orderdate AS ts, (epoch_ms(o_orderdate) - lag(epoch_ms(o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) AS ms FROM orders) WHERE ms IS NOT NULL)"""


@query(f"WITH {GAPS} SELECT id, ts, (ms // 86400000)::BIGINT AS gap FROM gaps")
def time_gaps(spark, sf_dir):
    return customer.time_gaps(table(spark, sf_dir, "orders"), "day", ORDERS)


@query(f"""WITH {GAPS}, d AS (SELECT ms // 86400000 AS gap FROM gaps)
SELECT count(*)::BIGINT AS count, round(avg(gap), 3) AS mean, round(stddev_pop(gap), 3) AS std_dev, min(gap)::BIGINT AS min, max(gap)::BIGINT AS max FROM d""")
def gap_stats(spark, sf_dir):
    return customer.numeric_stats(customer.time_gaps(table(spark, sf_dir, "orders"), "day", ORDERS), "gap")


RUNS = f"""{GAPS},
g AS (SELECT avg(ms) + 1.0 * stddev_pop(ms) AS min_gap FROM gaps),
cut AS (SELECT o_custkey AS id, epoch_ms(o_orderdate) AS ms, o_orderkey AS tie, min_gap,
  CASE WHEN epoch_ms(o_orderdate) - lag(epoch_ms(o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) > min_gap THEN 1 ELSE 0 END AS cut FROM orders, g),
num AS (SELECT *, sum(cut) OVER (PARTITION BY id ORDER BY ms, tie ROWS UNBOUNDED PRECEDING) AS cluster FROM cut),
h AS (SELECT epoch_ms(TIMESTAMP '{HORIZON[0]}') AS lo, epoch_ms(TIMESTAMP '{HORIZON[1]}') AS hi),
runs AS (
  SELECT id, cluster, min(ms) AS first_ms, max(ms) AS last_ms, min(ms) - any_value(lo) > any_value(min_gap) AS start_found, any_value(hi) - max(ms) > any_value(min_gap) AS end_found,
    cluster = max(cluster) OVER (PARTITION BY id) AS is_last FROM num, h GROUP BY id, cluster),
every AS (SELECT id, CASE WHEN start_found THEN first_ms ELSE lo END AS start_ms, CASE WHEN end_found THEN last_ms ELSE hi END AS end_ms FROM runs, h),
complete AS (SELECT id, first_ms AS start_ms, last_ms AS end_ms FROM runs WHERE start_found AND end_found)"""


def _cycles(spark, sf_dir, mode):
    return pipelines.lifecycles(table(spark, sf_dir, "orders"), *(F.lit(h).cast("timestamp") for h in HORIZON), mode, z=1.0, columns=ORDERS)


@query(f"WITH {RUNS} SELECT * FROM every")
def lifecycle_all(spark, sf_dir):
    return _cycles(spark, sf_dir, "all")


@query(f"WITH {RUNS} SELECT * FROM complete")
def lifecycle_complete(spark, sf_dir):
    return _cycles(spark, sf_dir, "complete")


@query(f"WITH {RUNS} SELECT id, first_ms AS start_ms, hi AS end_ms FROM runs, h WHERE is_last AND NOT end_found")
def lifecycle_current(spark, sf_dir):
    return _cycles(spark, sf_dir, "current")


@query(f"WITH {RUNS} SELECT id, ((end_ms - start_ms) // 86400000)::BIGINT AS length FROM complete")
def lifecycle_length(spark, sf_dir):
    return customer.lifecycle_length(_cycles(spark, sf_dir, "complete"), "day")


@query(f"""WITH {RUNS}, l AS (SELECT (end_ms - start_ms) // 86400000 AS length FROM complete)
SELECT count(*)::BIGINT AS count, round(avg(length), 3) AS mean, round(stddev_pop(length), 3) AS std_dev, min(length)::BIGINT AS min, max(length)::BIGINT AS max FROM l""")
def lifecycle_stats(spark, sf_dir):
    return customer.numeric_stats(lifecycle_length(spark, sf_dir), "length")


def _retention_sql(parts: list[str]) -> str:
    named = {"year": "year(t)::INT AS year", "month": "(month(t) - 1)::INT AS month", "day": "day(t)::INT AS day"}
    return f"""WITH {RUNS}, u AS (SELECT 0 AS kind, make_timestamp(start_ms * 1000) AS t FROM complete UNION ALL SELECT 1, make_timestamp(end_ms * 1000) FROM complete)
SELECT {", ".join(named[p] for p in parts)}, count(*) FILTER (kind = 0)::BIGINT AS acquired, count(*) FILTER (kind = 1)::BIGINT AS lost,
  (count(*) FILTER (kind = 0) - count(*) FILTER (kind = 1))::BIGINT AS net FROM u GROUP BY ALL"""


@query(_retention_sql(["year"]))
def retention_year(spark, sf_dir):
    return customer.retention(_cycles(spark, sf_dir, "complete"), "year")


@query(_retention_sql(["year", "month"]))
def retention_month(spark, sf_dir):
    return customer.retention(_cycles(spark, sf_dir, "complete"), "month")


@query(_retention_sql(["year", "month", "day"]))
def retention_day(spark, sf_dir):
    return customer.retention(_cycles(spark, sf_dir, "complete"), "day")


def _labelled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", S.int_div(F.col("n_chars"), 1000).alias("value"))
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("class")), "doc_id")


COUNTS = """counts AS (
  SELECT quality AS class, n_chars // 1000 AS value, count(*)::BIGINT AS count FROM documents JOIN labels USING (doc_id)
  GROUP BY GROUPING SETS ((quality, n_chars // 1000), (quality)))"""


@query(f"WITH {COUNTS} SELECT * FROM counts")
def class_counts(spark, sf_dir):
    return classify.class_counts(_labelled(spark, sf_dir))


@query(f"""WITH {COUNTS},
t AS (SELECT sum(count) FILTER (class <> 1) AS t0, sum(count) FILTER (class = 1) AS t1 FROM counts WHERE value IS NULL),
v AS (SELECT unnest(range(min(value), max(value) + 1)) AS value FROM counts),
n AS (SELECT v.value, coalesce(sum(count) FILTER (class <> 1), 0)::BIGINT AS n0, coalesce(sum(count) FILTER (class = 1), 0)::BIGINT AS n1 FROM v LEFT JOIN counts c ON c.value = v.value GROUP BY v.value)
SELECT value, n0, n1, (n1 / t1 * (t1 / (t0 + t1))) / nullif(n0 / t0 * (t0 / (t0 + t1)) + n1 / t1 * (t1 / (t0 + t1)), 0) AS posterior FROM n, t""")
def class_posterior(spark, sf_dir):
    return classify.class_posterior(classify.class_counts(_labelled(spark, sf_dir)))


@query("""WITH RECURSIVE x AS (SELECT value / 100 AS x, (event_type IN ('purchase', 'signup'))::INT AS y FROM events WHERE value IS NOT NULL),
fit(i, a, b) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL SELECT i + 1, a + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), b + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
  FROM (SELECT i, a, b, sum(y - p) AS g0, sum((y - p) * x) AS g1, sum(p * (1 - p)) AS h00, sum(p * (1 - p) * x) AS h01, sum(p * (1 - p) * x * x) AS h11
    FROM (SELECT i, a, b, x, y, 1 / (1 + exp(-(a + b * x))) AS p FROM fit, x WHERE i < 12) GROUP BY i, a, b))
SELECT unnest(['(intercept)', 'x']) AS term, round(unnest([a, b]), 8) AS weight FROM fit WHERE i = 12""")
def logit_weights(spark, sf_dir):
    """A logistic model of whether an event is a purchase or a signup, by its value."""
    rows = table(spark, sf_dir, "events").select((F.col("value") / 100).alias("x"), F.col("event_type").isin("purchase", "signup").cast("int").alias("class"))
    return classify.logit_fit(rows, ["x"]).select("term", F.round("weight", 8).alias("weight"))


def _ranked(spark, sf_dir, regularizer):
    scores = table(spark, sf_dir, "documents").select(F.col("source").alias("query_id"), "doc_id", F.col("n_chars").cast("double").alias("score"))
    known = scores.join(table(spark, sf_dir, "labels"), "doc_id").select("query_id", "doc_id", (F.col("quality") * 3 + F.col("toxic")).alias("relevance"))
    return search.ndcg(scores, search.relevance(known), regularizer)


def _ndcg_sql(rel: str) -> str:
    return f"""WITH s AS (
  SELECT source AS q, d.doc_id, n_chars AS score, coalesce(quality * 3 + toxic, 0)::DOUBLE AS raw FROM documents d LEFT JOIN labels USING (doc_id)),
g AS (SELECT *, {rel} AS rel FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS a, row_number() OVER (PARTITION BY q ORDER BY rel DESC, doc_id) AS b FROM g)
SELECT q AS query_id, round(sum((pow(2, rel) - 1) / log2(a + 1)) / nullif(sum((pow(2, rel) - 1) / log2(b + 1)), 0), 3) AS ndcg FROM r GROUP BY q"""


@query(_ndcg_sql("raw"))
def ndcg(spark, sf_dir):
    return _ranked(spark, sf_dir, "none")


@query(_ndcg_sql("CASE WHEN raw > 1 THEN ln(raw) ELSE 0 END"))
def ndcg_log(spark, sf_dir):
    return _ranked(spark, sf_dir, "logNatural")


@query(_ndcg_sql("CASE WHEN raw > 1 THEN log10(raw) ELSE 0 END"))
def ndcg_log10(spark, sf_dir):
    return _ranked(spark, sf_dir, "logTen")


COOKIE_SQL = """SELECT event_id, 's' || (user_id * 7 + event_id % 3) AS session_id, 'u' || user_id AS user_id FROM events"""


@query(COOKIE_SQL)
def cookie_parse(spark, sf_dir):
    user, event = F.col("user_id"), F.col("event_id")
    cookie = F.concat(F.lit("lang=en;+_USR="), F.lit("u"), user.cast("string"), F.lit(";+_SES="), F.lit("s"), (user * 7 + event % 3).cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", cookie.alias("cookie"))
    return sessions.sessions_from_cookie(rows, "_SES", "_USR").select("event_id", "session_id", "user_id")


W3C_FIELDS = ["dateTime", "dateTimeEpoch", "cIp", "url", "status", "scNumBytes", "referrer", "sessionId", "userId"]


W3C_SQL = """SELECT date_trunc('second', ts) AS "dateTime", epoch_ms(date_trunc('second', ts)) AS "dateTimeEpoch", '10.0.0.' || user_id % 250 AS "cIp", '/' || event_type AS url, '200' AS status,
  event_id::INT AS "scNumBytes", 'ref' || user_id AS referrer, 's' || user_id AS "sessionId", 'u' || user_id AS "userId" FROM events WHERE event_type <> 'error'"""


def w3c_lines(spark, sf_dir):
    """An extended log line for each event; errors have no session."""
    u, e = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    cookie = F.when(F.col("event_type") == "error", F.lit("x=1")).otherwise(F.concat(F.lit("a=1;sid=s"), u, F.lit(";uid=u"), u))
    line = F.concat_ws(
        " ", F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss"), F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")), F.lit("-"), F.lit("10.1.1.1"), F.lit("GET"),
        F.concat(F.lit("/"), "event_type"), F.lit("q=1"), F.lit("200"), e, F.lit("17"), F.lit("5"), F.lit("HTTP/1.1"), F.lit("agent"), cookie, F.concat(F.lit("ref"), u),
    )
    return table(spark, sf_dir, "events").select(line.alias("value"))


@query(W3C_SQL)
def w3c_parse(spark, sf_dir):
    return L.parse_log(w3c_lines(spark, sf_dir), L.W3C, W3C_FIELDS, "sid", "uid")


@query(W3C_SQL)
def w3c_parse_sql(spark, sf_dir):
    """The same by the table function of SQL."""
    sql.register(spark)
    return spark.sql(f"SELECT {', '.join(W3C_FIELDS)} FROM {{lines}} AS l, LATERAL w3c_log(l.value, 'sid', 'uid')", lines=w3c_lines(spark, sf_dir))


NCSA_SQL = """SELECT date_trunc('second', ts) AS "dateTime", '10.0.0.' || user_id % 250 AS "cIp", 'GET' AS method, '/' || event_type AS url, '404' AS status, event_id::INT AS "csNumBytes",
  'Mozilla 5.0 (X11; a b)' AS "userAgent", 's' || user_id AS "sessionId" FROM events"""
NCSA_FIELDS = ["dateTime", "cIp", "method", "url", "status", "csNumBytes", "userAgent", "sessionId"]


def ncsa_lines(spark, sf_dir):
    """A combined log line for each event."""
    u, e = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    line = F.concat(
        F.lit("10.0.0."), (F.col("user_id") % 250).cast("string"), F.lit(" - me ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET /'), F.col("event_type"), F.lit(' HTTP/1.1" 404 '), e,
        F.lit(' "http://x/" "Mozilla 5.0 (X11; a b)" "a=1;sid=s'), u, F.lit('"'),
    )
    return table(spark, sf_dir, "events").select(line.alias("value"))


@query(NCSA_SQL)
def ncsa_parse(spark, sf_dir):
    return L.parse_log(ncsa_lines(spark, sf_dir), L.NCSA, NCSA_FIELDS, "sid")


@query(NCSA_SQL)
def ncsa_parse_sql(spark, sf_dir):
    """The same by the table function of SQL."""
    sql.register(spark)
    return spark.sql(f"SELECT {', '.join(NCSA_FIELDS)} FROM {{lines}} AS l, LATERAL ncsa_log(l.value, 'sid', NULL)", lines=ncsa_lines(spark, sf_dir))


@query("""SELECT event_id, 's' || user_id AS session_id, epoch_ms(ts) // 3600000 AS hour, round(1 - exp(-event_id / 1000), 9) AS p FROM events""")
def sql_functions(spark, sf_dir):
    """Scalar functions of SQL over every event."""
    sql.register(spark)
    return spark.sql(
        """SELECT event_id, cookie_value('x=1;+sid=s' || user_id || ';y', 'sid') AS session_id, to_unit(unix_millis(CAST(ts AS TIMESTAMP)), 'hour') AS hour, round(exponential_cdf(event_id, 1000), 9) AS p
        FROM {events}""",
        events=table(spark, sf_dir, "events"),
    )


@query(r"""SELECT page_id, regexp_extract(url, '^(\w+)://', 1) AS scheme, regexp_extract(url, '^\w+://([^/?]+)', 1) AS host, regexp_extract(url, '^\w+://[^/?]+([^?]*)', 1) AS path,
  CASE WHEN regexp_matches(url, '[?&]utm_source=([^&]*)') THEN regexp_extract(url, '[?&]utm_source=([^&]*)', 1) END AS utm_source FROM pages""")
def url_parse(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract(url, r"^(\w+)://", 1).alias("scheme"), F.regexp_extract(url, r"^\w+://([^/?]+)", 1).alias("host"),
        F.regexp_extract(url, r"^\w+://[^/?]+([^?]*)", 1).alias("path"), S.group(url, "[?&]utm_source=([^&]*)").alias("utm_source"),
    )


def _visits(spark, sf_dir):
    return pipelines.batch_visits(clicks(spark, sf_dir), page_regex="^/(view|click|signup)", logout="purchase", timeout_s=86_400)


VISITS = f"""{CLICKS},
s AS (SELECT *, CASE WHEN lag(ms) OVER w IS NULL OR ms - lag(ms) OVER w > 86400000 OR lag(url) OVER w LIKE '%purchase%' THEN 1 ELSE 0 END AS opens FROM clicks WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS visit, nullif(regexp_extract(url, '^/(view|click|signup)', 1), '') AS page FROM s),
visits AS (SELECT session_id, visit::INT AS visit, arg_max(page, (ms, event_id)) FILTER (page IS NOT NULL) AS page_id, count(*)::BIGINT AS depth, max(ms) AS end_ms, max(event_id) AS tie FROM n GROUP BY session_id, visit),
known AS (SELECT * FROM visits WHERE page_id IS NOT NULL),
recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY end_ms DESC, session_id DESC, visit DESC) AS r FROM known) WHERE r <= 200),
enough AS (SELECT * FROM recent WHERE page_id IN (SELECT page_id FROM recent GROUP BY page_id HAVING count(*) >= 150))"""


@query(f"WITH {VISITS} SELECT session_id, visit, page_id, depth, end_ms FROM known")
def visits(spark, sf_dir):
    return _visits(spark, sf_dir)


@query(f"WITH {VISITS} SELECT page_id, (count(*) FILTER (depth = 1) * 100 // count(*))::BIGINT AS bounce_rate FROM enough GROUP BY page_id")
def visits_bounce(spark, sf_dir):
    return pipelines.depth_stats(_visits(spark, sf_dir), 200, 150).select("page_id", "bounce_rate")


@query(f"""WITH {VISITS}, c AS (SELECT page_id, depth, count(*) AS n FROM enough GROUP BY page_id, depth)
SELECT page_id, string_agg(depth || ':' || n, ',' ORDER BY depth) AS depth_distr FROM c GROUP BY page_id""")
def depth_distr(spark, sf_dir):
    return pipelines.depth_stats(_visits(spark, sf_dir), 200, 150).select("page_id", "depth_distr")


@query(f"WITH {VISITS} SELECT page_id, floor(avg(depth) + 0.5)::BIGINT AS av_depth FROM enough GROUP BY page_id")
def av_depth(spark, sf_dir):
    return pipelines.depth_stats(_visits(spark, sf_dir), 200, 150).select("page_id", "av_depth")


@query(f"""WITH {VISITS}, k AS (SELECT page_id, arg_max(depth, (end_ms, session_id::VARCHAR, depth)) AS depth FROM known
  GROUP BY page_id, ('0x' || substr(md5(session_id || '|' || end_ms), 1, 15))::BIGINT % 100),
c AS (SELECT page_id, depth, count(*) AS n FROM k GROUP BY page_id, depth)
SELECT page_id, ((coalesce(sum(n) FILTER (depth = 1), 0) * 100) // sum(n))::BIGINT AS bounce_rate, string_agg(depth || ':' || n, ',' ORDER BY depth) AS depth_distr,
  floor(sum(depth * n) / sum(n) + 0.5)::BIGINT AS av_depth FROM c GROUP BY page_id HAVING sum(n) >= 75""")
def visits_biased(spark, sf_dir):
    """Depth statistics of a recency-biased sample of 100 slots for each page."""
    return pipelines.biased_depth_stats(_visits(spark, sf_dir), 100)


@query()
def unique_users(spark, sf_dir):
    return pipelines.unique_counts(table(spark, sf_dir, "events"), "event_type", "user_id", 12, 20)


@query("""WITH p AS (SELECT event_type AS part, count(DISTINCT user_id) AS n FROM events GROUP BY event_type HAVING count(*) > 20)
SELECT part, n::BIGINT AS users FROM p""")
def unique_users_exact(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("part")).agg(F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("n"))
    return rows.where("n > 20").select("part", "users")


@query("""SELECT event_id, event_type || '/' || user_id AS joined, [event_type, user_id::VARCHAR] AS parts, lpad(event_id::VARCHAR, 12, '0') AS padded, round(value, 3) AS fixed,
  epoch_us(ts) // 1000 // 3600000 AS hour, event_type || ':1,x:2' AS mapped FROM events""")
def scalar_helpers(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = F.concat_ws(" / ", "event_type", F.col("user_id").cast("string"))
    return e.select(
        "event_id", S.join_tokens(S.split_tokens(text, "/"), "/").alias("joined"), S.split_tokens(text, "/").alias("parts"), S.pad_number(F.col("event_id"), 12).alias("padded"),
        S.fixed(F.col("value"), 3).alias("fixed"), S.to_unit(S.epoch_ms(F.col("ts")), "hour").alias("hour"),
        S.map_str(S.str_map(F.concat("event_type", F.lit(":1,x:2")))).alias("mapped"),
    )


from trailforge.plans import file_catalog  # noqa: E402, F401  its queries join these
