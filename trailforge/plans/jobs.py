"""Jobs by name over delimited text, run from a properties file or a section of a HOCON file.

    python -m trailforge.plans.jobs JOB CONFIG INPUT[,INPUT...] OUTPUT

A job names its columns from positions in the configuration, calls one operator, and writes
delimited text. Keys, their order in the input and their defaults are fixed formats.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailforge.functions import scalars as S
from trailforge.operators import classify, customer, engagement, events, logs, search, sessions
from trailforge.operators.stretches import neighbours
from trailforge.plans import pipelines
from trailforge.plans.counters import Counters
from trailforge.sources import logs as L, queue as Q
from trailforge.streaming import visitors, visits


#: Fixed value: the date format that stands for milliseconds.
EPOCH = "epochTime"


class Config(dict):
    """Keys and values as text, with typed reading, and the counters of the job that they are for."""

    def __init__(self, *pairs: object, **more: str) -> None:
        super().__init__(*pairs, **more)
        self.counters = Counters()

    def need(self, key: str) -> str:
        if key not in self:
            raise KeyError(f"the configuration has no {key}")
        return self[key]

    def text(self, key: str, default: str | None = None) -> str | None:
        return self.get(key, default)

    def number(self, key: str, default: float) -> float:
        return float(self.get(key, default))

    def whole(self, key: str, default: int) -> int:
        return int(self.get(key, default))

    def flag(self, key: str, default: bool = False) -> bool:
        return str(self.get(key, default)).lower() == "true"

    def ordinals(self, key: str) -> list[int]:
        return [int(x) for x in self.need(key).split(",")]

    def places(self, key: str) -> dict[str, int]:
        """name:position pairs."""
        return {name: int(at) for name, at in (pair.split(":") for pair in self.need(key).split(","))}


def load_config(path: str, section: str | None = None) -> Config:
    """k=v lines, with \\\\ for a backslash; of a file with `name {` ... `}` sections, the one named."""
    found, inside = Config(), None
    for line in Path(path).read_text().splitlines():
        line = line.strip()
        if not line or line[0] in "#!" or line.startswith("//"):
            continue
        if m := re.match(r"([\w.]+)\s*\{$", line):
            inside = m[1]
        elif line == "}":
            inside = None
        elif (m := re.match(r"([^=:\s]+)\s*[=:]\s*(.*)$", line)) and (section is None or inside in (None, section)):
            found[m[1]] = m[2].strip().strip('"').replace("\\\\", "\\")
    return found


def _parts(lines: DataFrame, regex: str) -> Callable[[int], Column]:
    return lambda at: F.get(F.split("value", regex), at)


def _time(date: Column, time: Column, form: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(form))


def _lines(spark: SparkSession, inputs: list[str]) -> DataFrame:
    return spark.read.text(inputs)


def _clicks(spark: SparkSession, c: Config, inputs: list[str], prefix: str = "see", multi_line: bool = False) -> DataFrame:
    """The visits of log lines; with `multi_line`, lines whose time can't be read belong to the record before them."""
    lines = _lines(spark, inputs).withColumn("event_id", F.monotonically_increasing_id())
    part, at = _parts(lines, c.text("field.delim.regex", r"\s+")), c.places(f"{prefix}.field.meta")
    col = lambda name: part(at[name]) if name in at else F.lit(None).cast("string")
    ts = _time(col("date"), col("time"), c.text(f"{prefix}.date.format.str", "yyyy-MM-dd HH:mm:ss"))
    if multi_line:
        numbered = L.read_lines_with_offsets(spark, *inputs)
        lines = L.multi_line(numbered, ts.isNotNull()).select(F.col("record").alias("value"), F.struct("file", "line_no").alias("event_id"))
    rows = lines.select(
        col("cookie").alias("cookie"), ts.alias("ts"), col("url").alias("url"), col("referrer").alias("referrer"), "event_id", F.col("value").alias("record")
    )
    rows = c.counters.watch(rows, records=F.count(F.lit(1)), records_without_time=F.count_if(F.col("ts").isNull()))
    found = sessions.sessions_from_cookie(rows, c.need(f"{prefix}.session.id.name"), c.need(f"{prefix}.user.id.name"), "cookie", c.text(f"{prefix}.cookie.separator", r";\+"))
    return c.counters.watch(found, records_with_session=F.count(F.lit(1)))


def session_extractor(spark, c, inputs):
    return sessions.session_pages(_clicks(spark, c, inputs)).select("session_id", "user_id", "session_start", "visit_time", "url", "time_on_page")


def session_summarizer(spark, c, inputs):
    return sessions.session_summary(_clicks(spark, c, inputs), c.need("ses.flow.sequence").split(","))


def user_session_summary(spark, c, inputs):
    lines = _lines(spark, inputs)
    part = _parts(lines, c.text("uss.field.delim.regex", ","))
    names = ["session_id", "user_id", "num_pages", "time_start", "time_spent", "last_page", "flow_stat", "referrer"]
    kinds = dict(num_pages="long", time_start="long", time_spent="long", flow_stat="int")
    return sessions.user_session_summary(lines.select(*[part(i).try_cast(kinds.get(n, "string")).alias(n) for i, n in enumerate(names)]))


def engagement_events(spark, c, inputs):
    """Over raw log lines as see.field.meta has them, or, with eeg.session.id.ord, over lines of which eeg.*.ord give positions, such as `session_extractor` writes.

    Over raw lines eeg.*.ord are the places of a hit's user, URL and time among these three, by default 0, 1 and 2.
    """
    found = engagement.patterns(c.need("eeg.engagement.events"))
    if c.text("eeg.session.id.ord"):
        lines = _lines(spark, inputs)
        part = _parts(lines, c.text("eeg.field.delim.regex", ","))
        place = lambda name, default: part(c.whole(f"eeg.{name}.ord", default))
        clicks = lines.select(
            place("session.id", 0).alias("session_id"), place("user.id", 1).alias("user_id"), F.timestamp_millis(place("time.stamp", 3).try_cast("long")).alias("ts"),
            place("url", 4).alias("url"), F.lit(None).cast("string").alias("referrer"), F.monotonically_increasing_id().alias("event_id"),
        )
    else:
        places = [c.whole(f"eeg.{name}.ord", i) for i, name in enumerate(("user.id", "url", "time.stamp"))]
        if places != [0, 1, 2]:
            raise ValueError(f"eeg.*.ord are {places}, but a hit of a raw line has its user, URL and time at 0, 1 and 2")
        clicks = _clicks(spark, c, inputs)
    return engagement.engagement_events(clicks, found).select("user_id", "item_id", "event_id", "value")


def rating_estimator(spark, c, inputs):
    kinds = {"user_id": (0, "string"), "item_id": (1, "string"), "event_id": (2, "int"), "value": (3, "long")}
    rows = L.read_delimited(spark, inputs, kinds, c.text("res.field.delim.regex", ","))
    return engagement.ratings(rows, engagement.time_mapping(c.need("res.time.spent.mapping")), item_first=c.whole("res.out.format", 1) == 2)


def event_detector(spark, c, inputs):
    found = events.pattern_list(c) or events.pattern_list(c, "sed.event.pattern")
    before, after = c.whole("sed.before.match.context.size", 3), c.whole("sed.after.match.context.size", 2)
    if c.flag("with.session", True):
        rows = _clicks(spark, c, inputs, "sed", multi_line=True).where(events.between(F.col("ts"), c.text("sed.min.date.time"), c.text("sed.max.date.time")))
        return events.session_event_context(rows, found, before, after)
    rows = _lines(spark, inputs).select(F.monotonically_increasing_id().alias("n"), F.col("value").alias("record"))
    return events.stream_event_context(events.dense_positions(rows, "n"), found, before, after)


def log_merger(spark, c, inputs):
    lines = L.read_lines_with_offsets(spark, *inputs)
    return logs.merge_logs(
        lines, c.text("clm.date.time.regex", r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d"), c.text("clm.date.format.str", "yyyy-MM-dd HH:mm:ss"), c.text("clm.file.source.id.sep", "_")
    ).select("record")


def log_partitioner(spark, c, inputs):
    by_time = c.flag("lop.part.by.date.time")
    return logs.partition_lines(
        _lines(spark, inputs), c.need("lop.date.time.pattern"), c.need("lop.date.format.str"), c.text("lop.date.time.part.unit", "hour") if by_time else None,
        None if by_time else c.need("lop.part.entity.pattern"), c.text("lop.min.date.time"), c.text("lop.max.date.time"),
    ).select("partition", "line")


def log_tokenizer(spark, c, inputs):
    return logs.tokenize(
        L.read_lines_with_offsets(spark, *inputs), c.text("lot.field.delim.regex", r"\s+"), c.text("lot.field.delim.out", " "), c.whole("lot.file.name.prefix.length", 8),
        c.whole("lot.byte.offset.format.size", 12), c.whole("lot.token.prefix.format.size", 3),
    ).select("tokens")


def _transactions(spark, c, inputs, prefix: str, regex: str = ",") -> DataFrame:
    """id (all id fields joined), ts, value, tie; the time is field tgs.time.stamp.field.ordinal."""
    lines = _lines(spark, inputs)
    part = _parts(lines, regex)
    at, raw = c.whole("tgs.time.stamp.field.ordinal", 2), c.flag("tgs.is.epoch.time")
    ts = F.timestamp_millis(part(at).try_cast("long")) if raw else F.try_to_timestamp(part(at), F.lit(c.text("tgs.date.format.str", "yyyy-MM-dd HH:mm:ss")))
    value = c.text(f"{prefix}.quant.attr.list")
    ids = F.concat_ws(",", *[part(i) for i in c.ordinals(f"{prefix}.id.field.ordinals")])
    return lines.select(
        ids.alias("cust_id"), ts.alias("ts"), (part(int(value.split(",")[0])) if value else F.lit(None).cast("string")).try_cast("double").alias("value"),
        F.monotonically_increasing_id().alias("xaction_id"),
    )


def time_gap_sequence(spark, c, inputs):
    return customer.time_gaps(_transactions(spark, c, inputs, "tgs"), c.text("tgs.time.gap.unit", "day")).select("id", "gap")


def frequency_recency_value(spark, c, inputs):
    when, fmt = c.text("trf.recency.ref.date"), c.text("trf.recency.ref.date.format.str", "yyyy-MM-dd HH:mm:ss")
    reference = F.to_timestamp(F.lit(when), fmt) if when else F.current_timestamp()
    found = customer.rfm(_transactions(spark, c, inputs, "trf"), reference, c.need("trf.time.gap.unit"), c.whole("trf.recency.count", 1), c.number("trf.recency.upper.bound.fraction", 0.5), watch=c.counters.watch)
    if c.text("trf.xaction.stats.file.path"):
        L.write_stats(customer.rfm_stats(found), c["trf.xaction.stats.file.path"])
    return found


def recency_score(spark, c, inputs):
    kinds = {"id": (0, "string"), "av_time_gap": (1, "long"), "recency": (2, "long"), "av_value": (3, "double")}
    rows = L.read_delimited(spark, inputs, kinds, c.text("trs.field.delim.regex", ","))
    law = c.text("trs.trans.gap.prob.distr", "normal")
    stats = L.read_stats(spark, c.need("trs.xaction.stats.file.path"), customer.GAP_STATS.get(law, []))
    return customer.recency_score(rows, stats, law)


def lifetime_value(spark, c, inputs):
    when = c.text("trf.recency.ref.date")
    reference = F.to_timestamp(F.lit(when), c.text("trf.recency.ref.date.format.str", "yyyy-MM-dd HH:mm:ss")) if when else F.current_timestamp()
    rows = _transactions(spark, c, inputs, "trf")
    return pipelines.lifetime_value(rows, reference, unit=c.need("trf.time.gap.unit"), recency_count=c.whole("trf.recency.count", 1), distribution=c.text("trs.trans.gap.prob.distr", "normal")).orderBy(F.desc("score"))


def life_cycle(spark, c, inputs):
    fmt, z = c.text("lcf.time.horizon.date.format.str", "yyyy-MM-dd HH:mm:ss"), float(c.get("clf.max.zscore", c.get("lcf.max.zscore", 3.0)))
    start, end = (F.to_timestamp(F.lit(c.need(f"lcf.time.horizon.{x}")), fmt) for x in ("start", "end"))
    visits_ = _transactions(spark, c, inputs, "lcf")
    cycles = pipelines.lifecycles(visits_, start, end, c.text("lcf.life.cycle.output.type", "current"), z, use_horizon=c.flag("lcf.use.time.horizon.for.cluster", True))
    return customer.lifecycle_length(cycles, c.text("lcf.time.gap.unit", "day")) if c.flag("lcf.output.life.cycle.length") else cycles


def retention_rate(spark, c, inputs):
    ids = len(c.ordinals("rer.id.field.ordinals"))
    rows = L.read_delimited(spark, inputs, {"start_ms": (ids, "long"), "end_ms": (ids + 1, "long")}, c.text("rer.field.delim.regex", ","))
    return customer.retention(rows, c.text("rer.rate.time.unit", "month"))


def class_histogram(spark, c, inputs):
    return classify.class_counts(L.read_delimited(spark, inputs, {"value": (0, "int"), "class": (2, "int")}, c.text("bs.field.delim.regex", ",")))


def class_boundary(spark, c, inputs):
    """From rows of `class_histogram`: class,value,count and class,,count."""
    counts = L.read_delimited(spark, inputs, {"class": (0, "int"), "value": (1, "int"), "count": (2, "long")})
    return classify.class_posterior(counts, c.whole("bp.predict.class", 1)).select("value", "posterior")


def search_gain(spark, c, inputs):
    """NDCG from click files (query, document, relevance) and the score file that the configuration names."""
    delim = c.text("field.delimIn", ",")
    clicks = L.read_delimited(spark, inputs, {"query_id": (0, "string"), "doc_id": (1, "string"), "relevance": (2, "double")}, delim)
    places = {"query_id": (c.whole("score.queryIdOrd", 0), "string"), "doc_id": (c.whole("score.docIdOrd", 1), "string"), "score": (c.whole("score.valueOrd", 2), "double")}
    rel = search.relevance(clicks)
    if c.flag("output.relAggr"):
        L.write_lines(rel, c.need("rel.aggrOutPath"))
    return search.ndcg(L.read_delimited(spark, c.need("score.filePath"), places, delim), rel, c.text("rel.regularizer", "none"), c.whole("output.precision", 3))


def parsed_sessions(spark, c, inputs):
    """Chosen fields of a standard log, and with comp.elapasedTime the milliseconds to the session's next page."""
    fields = c.need("log.fieldList").split(",")
    wanted = list(dict.fromkeys([*fields, "sessionId", "dateTimeEpoch"]))
    rows = L.parse_log(_lines(spark, inputs), c.text("log.formatStd", L.NCSA), wanted, c.need("session.idName"), c.text("user.idName"))
    if "dateTime" in fields and c.text("date.format"):
        form = c["date.format"]
        rows = rows.withColumn("dateTime", F.col("dateTimeEpoch") if form == EPOCH else F.date_format("dateTime", form))
    if not c.flag("comp.elapasedTime"):
        return rows.select(*fields)
    met = neighbours(rows, "sessionId", ["dateTimeEpoch"], "dateTimeEpoch", lead={"next_ms": "dateTimeEpoch"})
    return met.select(*fields, F.coalesce(F.col("next_ms") - F.col("dateTimeEpoch"), F.lit(0)).alias("timeOnPage"))


def parsed_session_summary(spark, c, inputs):
    """Over rows that `parsed_sessions` wrote, whose fields log.fieldList has: each session's first row with the total time on its pages, their number and the mean time between them."""
    fields = c.need("log.fieldList").split(",")
    rows = L.typed(L.read_delimited(spark, inputs, {f: (i, "string") for i, f in enumerate(fields)}, c.text("field.delimIn", ",")))
    rows = rows.where("sessionId is not null and dateTimeEpoch is not null")
    total, pages = F.sum("timeOnPage"), F.count(F.lit(1))
    first = rows.groupBy("sessionId").agg(F.min(F.struct("dateTimeEpoch", *[f for f in fields if f not in ("dateTimeEpoch", "timeOnPage")])).alias("first"), total.alias("timeOnPage"), pages.alias("pages"))
    told = [F.col(f) if f == "timeOnPage" else F.col(f"first.{f}").alias(f) for f in fields]
    return first.select(*told, "pages", S.int_div(F.col("timeOnPage"), F.col("pages") - 1).alias("meanTime"))


def parsed_session_average(spark, c, inputs):
    """Pages, total and mean time of each session of a standard log."""
    rows = L.parse_log(_lines(spark, inputs), c.text("log.formatStd", L.NCSA), ["sessionId", "dateTimeEpoch", "url"], c.need("session.idName"), c.text("user.idName"))
    clicks = rows.select(
        F.col("sessionId").alias("session_id"), F.lit(None).cast("string").alias("user_id"), F.timestamp_millis("dateTimeEpoch").alias("ts"), "url",
        F.lit(None).cast("string").alias("referrer"), F.monotonically_increasing_id().alias("event_id"),
    )
    return sessions.session_average(sessions.session_elapsed(clicks))


def _tick(c: Config, key: str) -> str | None:
    """The trigger of a stream: every so many seconds, or once for all there is."""
    return f"{c[key]} seconds" if c.text(key) else None


def _server(c: Config) -> dict[str, object]:
    return {"host": c.text("redis.server.host", "localhost"), "port": c.whole("redis.server.port", 6379)}


def _stream(spark: SparkSession, c: Config, key: str, folder: str) -> DataFrame:
    """Lines from the list that `key` names if there is a messaging.provider, else from a folder."""
    if c.text("messaging.provider"):
        return Q.read_queue(spark, c.need(key), partitions=c.whole("spout.threads", 1), **_server(c))
    return visits.read_lines(spark, folder)


@contextmanager
def _threads(spark: SparkSession, c: Config, key: str) -> Iterator[None]:
    """A query that is started in here deals its state into as many parts as `key` says; a checkpoint keeps the number it began with."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if c.text(key):
        spark.conf.set("spark.sql.shuffle.partitions", c[key])
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _queue(c: Config, key: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """The sink of lines into the list that `key` names; batches are counted for each checkpoint."""
    return Q.queue_sink(c.need(key), id=checkpoint, **_server(c))


def _handed(rows: DataFrame, folder: str, checkpoint: str, tick: str | None):
    """A query that writes a stream to a folder, whence a second one reads; without ticks it has ended on return."""
    writer = rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    query = (writer.trigger(processingTime=tick) if tick else writer.trigger(availableNow=True)).start()
    if not tick:
        query.awaitTermination()
    return query


def visit_stream(spark: SparkSession, c: Config, source: str, checkpoint: str, sink=None, event_time: bool = True, tick: str | None = None):
    """Visits and their depth statistics: two queries, joined by the folder that `source`.visits names.

    Lines come from the folder `source`, or with a messaging.provider from the list redis.log.queue. The
    visits' query has ticks of visit.session.tick.freq.sec, the statistics' query of
    visit.depth.tick.freq.sec, at each of which all pages report. `sink` gets result lines; by default
    they go to the list visit.depth.stat.queue.
    """
    visits.use_rocks_db(spark)
    lines = _stream(spark, c, "redis.log.queue", source)
    pages = visits.visit_pages(lines, c.need("session.regex"), c.whole("date.ordinal", 0), c.whole("time.ordinal", 1), c.whole("url.ordinal", 4))
    ended = visits.visits(pages, c.need("page.id.pattern"), c.need("logOut.pattern"), c.whole("session.timeOut", 30), event_time=event_time)
    handed = f"{source.rstrip('/')}.visits"
    with _threads(spark, c, "visit.session.bolt.threads"):
        first = _handed(ended, handed, f"{checkpoint}/visits", tick or _tick(c, "visit.session.tick.freq.sec"))
    window, every = c.whole("window.size", 20), c.whole("visit.depth.tick.freq.sec", 0)
    stats = visits.depth_stats(spark.readStream.schema(visits.VISIT).parquet(handed), window, c.whole("min.window.size.for.stat", window * 3 // 4), every or None)
    sink = sink or _queue(c, "visit.depth.stat.queue", f"{checkpoint}/depths")
    tell = lambda df, n: sink(visits.result_lines(df, c.text("result.type", "bounceRate")), n)
    with _threads(spark, c, "visit.depth.bolt.threads"):
        second = visits.start(stats, "depths", f"{checkpoint}/depths", "update", tick or (f"{every} seconds" if every else _tick(c, "visit.session.tick.freq.sec")), tell)
    return first, second


def visitor_stream(spark: SparkSession, c: Config, source: str, checkpoint: str, sink=None, tick: str | None = None):
    """Totals of unique visitors over all parts at each tick of unique.user.tick.freq.sec.

    Lines come from the folder `source`, or with a messaging.provider from the list input.log.queue.
    With command.store, a folder (or list) of lines `part,reset`, parts can be reset: a first query
    numbers the times between resets and hands events on in the folder that `source`.epochs names.
    `sink` gets a table of the totals; by default lines `<ms>  <total>` go to the list output.count.queue.
    """
    every, bits, least = c.whole("unique.user.tick.freq.sec", 0), c.whole("bucket.bit.count", 12), c.whole("min.total.count", 0)
    tick = tick or _tick(c, "unique.user.tick.freq.sec")
    found = visitors.app_events(_stream(spark, c, "input.log.queue", source), c.whole("partition.ordinal", 3), c.whole("user.id.ordinal", 4))
    if not sink:
        push = _queue(c, "output.count.queue", checkpoint)
        sink = lambda df, n: push(visitors.total_lines(df), n)
    if c.text("command.store"):
        visits.use_rocks_db(spark)
        handed = f"{source.rstrip('/')}.epochs"
        commands = visitors.command_lines(_stream(spark, c, "command.store", c["command.store"]))
        _handed(visitors.epochs(found, commands), handed, f"{checkpoint}/epochs", tick)
        numbered = spark.readStream.schema(visitors.EPOCHS).parquet(handed)
        counted = visitors.epoch_counts(visitors.with_ticks(numbered, every) if every else numbered, bits)
        with _threads(spark, c, "unique.count.bolt.threads"):
            return visits.start(counted, "visitors", f"{checkpoint}/counts", "complete", tick, visitors.epoch_totals_sink(sink, least))
    counted = visitors.counts(visitors.with_ticks(found, every) if every else found, bits, least)
    with _threads(spark, c, "unique.count.bolt.threads"):
        return visits.start(counted, "visitors", checkpoint, "complete", tick, visitors.totals_sink(sink))


JOBS: dict[str, Callable[[SparkSession, Config, list[str]], DataFrame]] = {
    f.__name__: f
    for f in (
        session_extractor, session_summarizer, user_session_summary, engagement_events, rating_estimator, event_detector, log_merger, log_partitioner, log_tokenizer,
        time_gap_sequence, frequency_recency_value, recency_score, lifetime_value, life_cycle, retention_rate, class_histogram, class_boundary, search_gain,
        parsed_sessions, parsed_session_summary, parsed_session_average,
    )
}


#: The prefix of each job's own number of output files.
FILE_PREFIX = {
    "session_extractor": "see", "session_summarizer": "ses", "user_session_summary": "uss", "engagement_events": "eeg", "rating_estimator": "res", "event_detector": "sed", "log_merger": "clm",
    "log_partitioner": "lop", "log_tokenizer": "lot", "time_gap_sequence": "tgs", "frequency_recency_value": "trf", "recency_score": "trs", "life_cycle": "lcf", "retention_rate": "rer",
    "class_histogram": "bs", "class_boundary": "bp",
}


def run(spark: SparkSession, job: str, config: Config, inputs: list[str], output: str) -> dict[str, int]:
    """Runs a job, writes its rows as text, and returns its counters, which are taken in the same pass.

    num.reducer, or the job's own form of it, is the number of files; save.output=false writes
    none (and counts nothing), and debug.on shows the first rows. field.delimOut and field.delim.out part the fields.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    config.counters = Counters()
    rows = JOBS[job](spark, config, inputs)
    told: dict[str, int] = {}
    if config.flag("save.output", True):
        files = config.whole(f"{FILE_PREFIX.get(job, job)}.num.reducer", config.whole("num.reducer", 0))
        with config.counters.counting(spark):
            L.write_lines(rows, output, config.text("field.delimOut", config.text("field.delim.out", ",")), files if files > 0 else None)
        told = config.counters.read()
    if config.flag("debug.on"):
        rows.show(20, False)
    return told


if __name__ == "__main__":
    name, conf, sources, target = sys.argv[1:5]
    for counter, value in run(SparkSession.builder.appName(name).getOrCreate(), name, load_config(conf, name), sources.split(","), target).items():
        print(f"{counter}={value}", file=sys.stderr)
