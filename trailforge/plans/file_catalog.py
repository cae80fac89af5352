"""Queries that write the driver's tables as log files and read them back, in batches and as streams, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailforge.functions import scalars as S
from trailforge.functions.scratch import scratch_path
from trailforge.operators import customer, events, logs
from trailforge.plans.catalog import FIRST_LINE, FORMAT, RFM, TIME, _rfm, log_lines, query, table
from trailforge.sources import logs as L
from trailforge.streaming import visitors, visits


#: Line numbers of one log file; even, so that an event's lines stay together.
CHUNK = 200_000


def written_logs(spark: SparkSession, sf_dir: str) -> str:
    """A folder with log files of each event type, of CHUNK lines at most and so of bounded tasks, in folders with their names."""
    path = scratch_path(spark, "logs")
    lines = log_lines(spark, sf_dir).withColumn("file", F.concat("file", F.lit("."), F.floor(F.col("line_no") / CHUNK).cast("string")))
    lines.repartition("file").sortWithinPartitions("file", "line_no").select("file", "value").write.partitionBy("file").text(path)
    return path


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, byte_offset, value of the lines of `written_logs`, with the names that the folders have."""
    found = L.read_lines_with_offsets(spark, path)
    return found.withColumn("file", F.regexp_extract("path", "file=([^/]+)", 1)).drop("path")


LINES = f"""lines AS (
  SELECT event_type || '_log.' || (2 * event_id // {CHUNK}) AS file, event_id, 0 AS i, {FIRST_LINE} AS value FROM events
  UNION ALL SELECT 'error_log.' || (2 * event_id // {CHUNK}), event_id, 1, '  caused by event ' || event_id FROM events WHERE event_type = 'error'),
files AS (
  SELECT file, row_number() OVER w - 1 AS line_no, coalesce(sum(strlen(value) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS byte_offset, value
  FROM lines WINDOW w AS (PARTITION BY file ORDER BY event_id, i))"""


@query(f"WITH {LINES} SELECT * FROM files")
def file_lines(spark, sf_dir):
    """Every line of the files with its number and byte offset."""
    return read_back(spark, written_logs(spark, sf_dir))


@query(f"""WITH {LINES}, t AS (SELECT *, string_split_regex(value, '\\s+') AS ts FROM files)
SELECT file, byte_offset, rpad(file[1:8], 8, 'x') || ':' || lpad(byte_offset::VARCHAR, 12, '0') || ' '
  || array_to_string(list_transform(ts, lambda t, i: lpad((i - 1)::VARCHAR, 3, '0') || ':' || t), ' ') AS tokens FROM t""")
def file_tokens(spark, sf_dir):
    """Tokens of every line behind its real byte offset."""
    return logs.tokenize(read_back(spark, written_logs(spark, sf_dir)))


@query(f"""WITH {LINES}, m AS (
  SELECT *, count(*) FILTER (value NOT LIKE ' %') OVER (PARTITION BY file ORDER BY line_no) AS r FROM files),
r AS (SELECT file, min(line_no) AS line_no, string_agg(value, '\\n' ORDER BY line_no) AS record FROM m GROUP BY file, r),
o AS (SELECT split_part(file, '_', 1) AS source, line_no, record, regexp_extract(record, '\\d{{4}}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d') AS ts FROM r)
SELECT row_number() OVER (ORDER BY ts, source, line_no) AS position, source, line_no, source || ' ' || replace(record, '\\n', '\\n' || source || ' ') AS record FROM o""")
def file_merge_order(spark, sf_dir):
    """The records of all files with their place in the order of time."""
    path = scratch_path(spark, "merged")
    # Written in order, so that numbers that grow with the place are counted without a sort of the whole log in one task.
    logs.merge_logs(read_back(spark, written_logs(spark, sf_dir))).withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    return events.dense_positions(spark.read.parquet(path), "at").select("position", "source", "line_no", "record")


@query(f"""WITH {LINES}, m AS (SELECT *, count(*) FILTER (value NOT LIKE ' %') OVER (PARTITION BY file ORDER BY line_no) AS r FROM files)
SELECT file, min(line_no) AS line_no, string_agg(value, '|' ORDER BY line_no) AS record FROM m GROUP BY file, r""")
def file_continuations(spark, sf_dir):
    """Records to which every line belongs that begins with white space."""
    return L.multi_line(read_back(spark, written_logs(spark, sf_dir)), r"^\s", starts=False, sep="|", width=1000)


@query(f"""SELECT lpad((epoch_us(ts) // 1000 // 86400000)::VARCHAR, 12, '0') AS partition,
  row_number() OVER (PARTITION BY epoch_us(ts) // 1000 // 86400000 ORDER BY date_trunc('second', ts), {FIRST_LINE}) AS position, {FIRST_LINE} AS line FROM events""")
def file_partitions(spark, sf_dir):
    """The lines of the folder of each day in the order in which they stand there."""
    path = scratch_path(spark, "days")
    logs.write_partitions(logs.partition_lines(log_lines(spark, sf_dir), TIME, FORMAT, unit="day"), path)
    found = L.read_lines_with_offsets(spark, path).withColumn("partition", F.regexp_extract("path", "partition=([^/]+)", 1))
    place = Window.partitionBy("partition").orderBy("path", "line_no")
    return found.select("partition", F.row_number().over(place).cast("long").alias("position"), F.col("value").alias("line"))


@query(f"WITH {RFM} SELECT global_av_time_gap, global_std_dev_time_gap FROM stats")
def file_stats(spark, sf_dir):
    """Two statistics, written as lines k=v and read back."""
    path = scratch_path(spark, "stats")
    L.write_stats(customer.rfm_stats(_rfm(spark, sf_dir)), path)
    return L.read_stats(spark, path, customer.GAP_STATS["normal"])


@query("SELECT event_id, event_type, user_id::INT AS user_id, round(value * 100)::BIGINT AS cents FROM events")
def file_delimited(spark, sf_dir):
    """Events written as separated text in three files, and typed columns read back from positions."""
    path, cents = scratch_path(spark, "delimited"), F.round(F.col("value") * 100).cast("long")
    L.write_lines(table(spark, sf_dir, "events").select("user_id", "event_id", F.lit("x"), "event_type", cents.alias("cents")), path, " ; ", 3)
    return L.read_delimited(spark, path, {"event_id": (1, "long"), "event_type": (3, "string"), "user_id": (0, "int"), "cents": (4, "long")}, ";")


def session_lines(spark: SparkSession, sf_dir: str) -> str:
    """A folder of log lines with cookies; an error goes on in a second line."""
    path, week = scratch_path(spark, "clicks"), F.date_format(F.date_trunc("week", "ts"), "yyyyMMdd")
    cookie = F.concat(F.lit("SES=u"), F.col("user_id").cast("string"), F.lit("w"), week, F.lit(";+USR=u"), F.col("user_id").cast("string"))
    line = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), cookie, F.concat(F.lit("/"), "event_type"), F.lit("-"))
    more = F.when(F.col("event_type") == "error", F.concat(F.lit("\n  caused by event "), F.col("event_id").cast("string"))).otherwise(F.lit(""))
    table(spark, sf_dir, "events").select(F.concat(line, more).alias("value")).write.text(path)
    return path


LOG_CONFIG = {
    f"{prefix}.{key}": value for prefix in ("see", "sed") for key, value in {
        "field.meta": "date:0,time:1,cookie:2,url:3,referrer:4", "session.id.name": "SES", "user.id.name": "USR", "date.format.str": "yyyy-MM-dd HH:mm:ss.SSSSSS"}.items()
}
CLICKED = """c AS (SELECT 'u' || user_id || 'w' || strftime(date_trunc('week', ts), '%Y%m%d') AS session_id, 'u' || user_id AS user_id, ts, epoch_us(ts) // 1000 AS ms, '/' || event_type AS url, event_id, event_type FROM events)"""


@query(f"""WITH {CLICKED} SELECT session_id || ',' || user_id || ',' || min(ms) OVER (PARTITION BY session_id) || ',' || strftime(ts, '%H:%M:%S') || ',' || url || ','
  || coalesce((lead(ms) OVER (PARTITION BY session_id ORDER BY ts) - ms) // 1000, 0) AS value FROM c""")
def job_sessions(spark, sf_dir):
    """The lines that the session job writes, in four files, from a configuration."""
    from trailforge.plans import jobs

    out = scratch_path(spark, "sessions")
    jobs.run(spark, "session_extractor", jobs.Config(LOG_CONFIG | {"see.num.reducer": "4"}), [session_lines(spark, sf_dir)], out)
    return L.read_lines(spark, out).select("value")


@query(f"""WITH {CLICKED},
r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts) AS n, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || ' SES=' || session_id || ';+USR=' || user_id || ' ' || url || ' -'
  || CASE WHEN event_type = 'error' THEN '\\n  caused by event ' || event_id ELSE '' END AS line FROM c),
m AS (SELECT session_id, n, 'failed' AS event FROM r WHERE event_type = 'error' AND event_id % 10 = 7 UNION ALL SELECT session_id, n, 'bought' FROM r WHERE event_type = 'purchase')
SELECT session_id, event, m.n::INT AS match_no, (r.n - m.n)::INT AS context_offset, line FROM m JOIN r USING (session_id) WHERE r.n BETWEEN m.n - 2 AND m.n + 1""")
def job_event_context(spark, sf_dir):
    """Events of a configured list of patterns, found in records of several lines, with the records around them."""
    from trailforge.plans import jobs

    conf = {"sed.before.match.context.size": "2", "sed.after.match.context.size": "1", "event.pattern.1.name": "failed", "event.pattern.1.regex": r"caused by event \d*7$"}
    conf |= {"event.pattern.2.name": "bought", "event.pattern.2.regex": "/purchase "}
    return jobs.event_detector(spark, jobs.Config(LOG_CONFIG | conf), [session_lines(spark, sf_dir)])


@query("""WITH t AS (SELECT event_id, [event_type, user_id::VARCHAR, 'c', event_id::VARCHAR] AS ts FROM events)
SELECT event_id, ts[2:3] AS inner_part, []::VARCHAR[] AS past_end, [ts[3], ts[1]] AS picked, event_id AS number, NULL::BIGINT AS no_number FROM t""")
def token_lists(spark, sf_dir):
    """Ranges and places of split tokens, and typed fields of them."""
    tokens = S.split_tokens(F.concat_ws(" , ", "event_type", F.col("user_id").cast("string"), F.lit(" c "), F.col("event_id").cast("string")), ",")
    rows = table(spark, sf_dir, "events").select("event_id", tokens.alias("t"))
    return rows.select("event_id", S.sublist(F.col("t"), 1, 3).alias("inner_part"), S.sublist(F.col("t"), 2, 9).alias("past_end"), S.pick(F.col("t"), [2, 0]).alias("picked"), F.get("t", 3).try_cast("long").alias("number"), F.get("t", 0).try_cast("long").alias("no_number"))


# --- streams over files, run until all is read


def visit_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of visit lines, and of one line long after them, which moves the watermark past all visits."""
    path = scratch_path(spark, "pages")
    week = F.date_format(F.date_trunc("week", "ts"), "yyyyMMdd")
    url = F.concat(F.lit("/"), "event_type", F.lit("?sessionid=u"), F.col("user_id").cast("string"), F.lit("w"), week)
    lines = table(spark, sf_dir, "events").select(F.concat_ws(" ", F.date_format("ts", FORMAT), F.lit("10.0.0.1 GET"), url).alias("value"))
    lines.union(spark.sql("SELECT '2099-01-01 00:00:00 10.0.0.1 GET /view?sessionid=last'")).write.text(path)
    return path


def ended_visits(spark: SparkSession, sf_dir: str) -> str:
    """The folder into which a stream has written the visits that ended."""
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    visits.use_rocks_db(spark)
    try:
        pages = visits.visit_pages(visits.read_lines(spark, visit_files(spark, sf_dir)), r".*?sessionid=(\w+).*")
        ended = visits.visits(pages, "^/(view|click|signup)", "purchase", 86_400)
        out = scratch_path(spark, "visits")
        ended.writeStream.option("checkpointLocation", scratch_path(spark, "stream")).trigger(availableNow=True).start(out, format="parquet").awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    return out


STREAMED = """p AS (
  SELECT 'u' || user_id || 'w' || strftime(date_trunc('week', ts), '%Y%m%d') AS session_id, epoch_ms(date_trunc('second', ts)) AS ms, '/' || event_type AS url FROM events),
s AS (SELECT *, CASE WHEN lag(ms) OVER w IS NULL OR ms - lag(ms) OVER w > 86400000 OR lag(url) OVER w LIKE '%purchase%' THEN 1 ELSE 0 END AS opens FROM p WINDOW w AS (PARTITION BY session_id ORDER BY ms, url)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY ms, url ROWS UNBOUNDED PRECEDING) AS visit, nullif(regexp_extract(url, '^/(view|click|signup)', 1), '') AS page FROM s),
v AS (SELECT session_id, visit, arg_max(page, (ms, url)) FILTER (page IS NOT NULL) AS page_id, count(*)::INT AS depth, max(ms) AS end_ms FROM n GROUP BY session_id, visit)"""


@query(f"WITH {STREAMED} SELECT session_id, page_id, depth FROM v WHERE page_id IS NOT NULL")
def stream_visits(spark, sf_dir):
    """The visits that a stream over files ends."""
    return spark.read.schema("session_id string, page_id string, depth int").parquet(ended_visits(spark, sf_dir))


def _depths_sql(rows: str, least: int) -> str:
    return f"""WITH {STREAMED}, k AS ({rows}), c AS (SELECT page_id, depth, count(*) AS n FROM k GROUP BY page_id, depth)
SELECT page_id, ((coalesce(sum(n) FILTER (depth = 1), 0) * 100) // sum(n))::BIGINT AS bounce_rate, string_agg(depth || ':' || n, ',' ORDER BY depth) AS depth_distr,
  floor(sum(depth * n) / sum(n) + 0.5)::BIGINT AS av_depth FROM c GROUP BY page_id HAVING sum(n) >= {least}"""


def streamed_depths(spark: SparkSession, sf_dir: str, window: int, least: int) -> DataFrame:
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    folder = ended_visits(spark, sf_dir)
    out = scratch_path(spark, "depths")
    visits.use_rocks_db(spark)
    try:
        depths = spark.readStream.schema(visits.VISIT).parquet(folder)
        stats = visits.depth_stats(depths, window, least)
        visits.start(stats, None, scratch_path(spark, "stream"), "update", None, lambda df, n: df.write.mode("append").parquet(out)).awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    return spark.read.schema("page_id string, bounce_rate long, depth_distr string, av_depth long").parquet(out)


#: Slots of a sample that no two visits share.
ALL = 1 << 50


@query(_depths_sql("SELECT page_id, depth FROM v WHERE page_id IS NOT NULL", 1))
def stream_depths(spark, sf_dir):
    """Depth statistics that a second stream keeps of the first one's visits; the sample is so large that it holds them all."""
    return streamed_depths(spark, sf_dir, ALL, 1)


def _sampled(visits_: str, window: int) -> str:
    slot = f"('0x' || substr(md5(session_id || '|' || end_ms), 1, 15))::BIGINT % {window}"
    return f"SELECT page_id, arg_max(depth, (end_ms, session_id, depth)) AS depth FROM {visits_} WHERE page_id IS NOT NULL GROUP BY page_id, {slot}"


@query(_depths_sql(_sampled("v", 50), 30))
def stream_depths_biased(spark, sf_dir):
    """The same from a recency-biased sample of 50 slots for each page."""
    return streamed_depths(spark, sf_dir, 50, 30)


NEAR_SQL = "SELECT event_type AS part, true AS near FROM events GROUP BY event_type HAVING count(*) > 20"


@query(f"{NEAR_SQL} UNION ALL SELECT unnest(['all', 'union']), true")
def unique_users_near(spark, sf_dir):
    """Whether each estimate of `unique_counts`, the sum of all and the estimate of the union are within 5 % of the exact counts."""
    from trailforge.plans.catalog import QUERIES

    found = QUERIES["unique_users"](spark, sf_dir)
    total = found.where("part = 'all'").select(F.lit("union").alias("part"), F.col("union_users").alias("users"))
    return _near(found.select("part", "users").union(total), spark, sf_dir)


@query(NEAR_SQL)
def stream_users_near(spark, sf_dir):
    """Whether each estimate of a stream of application lines is within 5 % of the exact count."""
    path, out = scratch_path(spark, "app"), scratch_path(spark, "users")
    table(spark, sf_dir, "events").select(F.concat_ws(" ", F.date_format("ts", FORMAT), F.lit("open"), "event_type", F.col("user_id").cast("string")).alias("value")).write.text(path)
    counted = visitors.counts(visitors.app_events(visits.read_lines(spark, path), 3, 4), 12, 20).drop("sketch")
    visits.start(counted, None, scratch_path(spark, "stream"), "complete", None, lambda df, n: df.write.mode("overwrite").parquet(out)).awaitTermination()
    return _near(spark.read.schema("part string, users long").parquet(out), spark, sf_dir)


@query("SELECT 'users' AS total, true AS near UNION ALL SELECT 'union_users', true")
def stream_total_near(spark, sf_dir):
    """Whether the totals of the visitor job, with parts that can be reset, are within 5 % of the exact counts."""
    from trailforge.plans import jobs

    path, commands, out = scratch_path(spark, "app"), scratch_path(spark, "commands"), scratch_path(spark, "totals")
    table(spark, sf_dir, "events").select(F.concat_ws(" ", F.date_format("ts", FORMAT), F.lit("open"), "event_type", F.col("user_id").cast("string")).alias("value")).write.text(path)
    spark.createDataFrame([("view, reset",), ("no command",)], "value string").write.text(commands)
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        conf = jobs.Config({"command.store": commands, "min.total.count": "20"})
        jobs.visitor_stream(spark, conf, path, scratch_path(spark, "stream"), lambda df, n: df.write.mode("overwrite").parquet(out)).awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    found = spark.read.schema("ms long, users long, union_users long").parquet(out)
    events_ = table(spark, sf_dir, "events")
    parts = events_.groupBy("event_type").agg(F.countDistinct("user_id").alias("n")).agg(F.sum("n").alias("users_n"))
    exact = parts.crossJoin(events_.agg(F.countDistinct("user_id").alias("union_users_n")))
    near = lambda c: (F.abs(F.col(c) - F.col(f"{c}_n")) <= F.col(f"{c}_n") * 0.05 + 1).alias("near")
    pairs = [F.struct(F.lit(c).alias("total"), near(c)) for c in ("users", "union_users")]
    return found.crossJoin(F.broadcast(exact)).select(F.inline(F.array(*pairs)))


def _near(estimates: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    exact = events.groupBy(F.col("event_type").alias("part")).agg(F.countDistinct("user_id").alias("n"), F.count(F.lit(1)).alias("events")).where("events > 20")
    parts = F.broadcast(exact.select("part"))
    union = events.join(parts, events["event_type"] == parts["part"]).agg(F.lit("union").alias("part"), F.countDistinct("user_id").alias("n"))
    exact = exact.select("part", "n").union(exact.agg(F.lit("all"), F.sum("n"))).union(union)
    return estimates.join(exact, "part").select("part", (F.abs(F.col("users") - F.col("n")) <= F.col("n") * 0.05 + 1).alias("near"))
