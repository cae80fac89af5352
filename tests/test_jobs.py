"""Jobs over text files, from configuration to text."""

import pytest

from trailforge.plans import jobs
from trailforge.plans.jobs import Config

WEB = {
    "see.field.meta": "cookie:2,date:0,time:1,url:3,referrer:4", "see.user.id.name": "USR", "see.session.id.name": "SES", "ses.flow.sequence": "/cart,/order",
    "eeg.engagement.events": "/product/(\\w+):1,/cart:2:8", "res.time.spent.mapping": "10:1,20:2",
}


def put(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return [str(path)]


def run(spark, job, config, inputs, tmp_path):
    jobs.run(spark, job, Config(config), inputs, str(tmp_path / job))
    return sorted(r[0] for r in spark.read.text(str(tmp_path / job)).collect())


def test_config_files(tmp_path):
    (tmp_path / "a.properties").write_text("# note\nfield.delim.regex=\\\\s+\nx = 1\n")
    assert jobs.load_config(str(tmp_path / "a.properties")) == {"field.delim.regex": "\\s+", "x": "1"}
    (tmp_path / "a.conf").write_text('one {\n  k = "v"\n}\ntwo {\n  k = w\n}\n')
    assert jobs.load_config(str(tmp_path / "a.conf"), "two") == {"k": "w"}
    with pytest.raises(KeyError, match="no such"):
        Config().need("such")


def test_web_jobs(spark, tmp_path):
    cookie = "USR=u1;+SES=s1"
    rows = [("10:00:00", "/product/A"), ("10:00:15", "/cart"), ("10:00:40", "/order")]
    log = put(tmp_path / "log", [f"2015-05-15  {t}  {cookie}  {u}  http://r" for t, u in rows])
    pages = run(spark, "session_extractor", WEB, log, tmp_path)
    assert pages[0] == "s1,u1,1431684000000,10:00:00,/product/A,15" and len(pages) == 3
    assert run(spark, "session_summarizer", WEB, log, tmp_path) == ["s1,u1,3,1431684000000,40,/order,2,http://r"]
    assert run(spark, "user_session_summary", WEB, [str(tmp_path / "session_summarizer")], tmp_path) == ["u1,http://r,1,3,40,1,1,0"]
    assert run(spark, "engagement_events", WEB, log, tmp_path) == ["u1,A,2,8"]
    assert run(spark, "rating_estimator", WEB | {"res.out.format": "2"}, [str(tmp_path / "engagement_events")], tmp_path) == ["A,u1,8"]
    detect = {k.replace("see.", "sed."): v for k, v in WEB.items()} | {"event.pattern.1.name": "c", "event.pattern.1.regex": "/cart", "sed.before.match.context.size": "1"}
    assert len(run(spark, "event_detector", detect, log, tmp_path)) == 3
    assert len(run(spark, "event_detector", detect | {"with.session": "false", "event.pattern.1.regex": ".*cart.*", "sed.after.match.context.size": "1"}, log, tmp_path / "x")) == 3


def test_log_jobs(spark, tmp_path):
    log = put(tmp_path / "b_x.log", ["2020-01-01 00:00:01 u=7 a", "2020-01-01 05:00:00 u=8 b"])
    assert run(spark, "log_merger", {}, log, tmp_path)[0] == "b 2020-01-01 00:00:01 u=7 a"
    part = {"lop.date.time.pattern": r"^(\S+ \S+)", "lop.date.format.str": "yyyy-MM-dd HH:mm:ss"}
    assert [x[:12] for x in run(spark, "log_partitioner", part | {"lop.part.by.date.time": "true"}, log, tmp_path)] == ["000000438288", "000000438293"]
    assert [x[:2] for x in run(spark, "log_partitioner", part | {"lop.part.entity.pattern": r"u=(\d+)"}, log, tmp_path / "e")] == ["7,", "8,"]
    assert run(spark, "log_tokenizer", {}, log, tmp_path)[1].startswith("b_x.logx:000000000026 000:2020-01-01")


def test_customer_jobs(spark, tmp_path):
    days = [("a", 1), ("a", 3), ("a", 5), ("a", 9), ("b", 1), ("b", 2), ("b", 8)]
    data = put(tmp_path / "t", [f"x{i},{c},2020-01-{d:02d} 00:00:00,{10 * d}" for i, (c, d) in enumerate(days)])
    conf = {
        "trf.time.gap.unit": "day", "trf.id.field.ordinals": "1", "trf.quant.attr.list": "3", "trf.recency.ref.date": "2020-01-20 00:00:00",
        "trf.xaction.stats.file.path": str(tmp_path / "stats"), "trs.xaction.stats.file.path": str(tmp_path / "stats"), "tgs.id.field.ordinals": "1",
        "lcf.id.field.ordinals": "1", "lcf.time.horizon.start": "2019-01-01 00:00:00", "lcf.time.horizon.end": "2021-01-01 00:00:00", "lcf.life.cycle.output.type": "all",
        "rer.id.field.ordinals": "0",
    }
    assert run(spark, "frequency_recency_value", conf, data, tmp_path) == ["a,2,11,45.0", "b,3,12,36.67"]
    assert len(run(spark, "recency_score", conf, [str(tmp_path / "frequency_recency_value")], tmp_path)) == 2
    assert len(run(spark, "lifetime_value", conf, data, tmp_path)) == 2
    assert run(spark, "time_gap_sequence", conf, data, tmp_path) == ["a,2", "a,2", "a,4", "b,1", "b,6"]
    cycles = run(spark, "life_cycle", conf, data, tmp_path)
    assert [x.split(",")[0] for x in cycles] == ["a", "b"]
    assert run(spark, "retention_rate", conf, [str(tmp_path / "life_cycle")], tmp_path) == ["2020,0,2,2,0"]
    assert all(x.split(",")[1].isdigit() for x in run(spark, "life_cycle", conf | {"lcf.output.life.cycle.length": "true"}, data, tmp_path / "l"))


def test_classifier_search_and_standard_logs(spark, tmp_path):
    rows = put(tmp_path / "c", ["1,x,0", "1,x,0", "1,x,1", "2,x,1"])
    run(spark, "class_histogram", {}, rows, tmp_path)
    assert run(spark, "class_boundary", {}, [str(tmp_path / "class_histogram")], tmp_path)[1] == "2,1.0"
    put(tmp_path / "s", ["q,a,3.0", "q,b,2.0"])
    clicks = put(tmp_path / "k", ["q,b,1"])
    assert run(spark, "search_gain", {"score.filePath": str(tmp_path / "s")}, clicks, tmp_path) == ["q,0.631"]
    log = put(tmp_path / "n", [f'1.1.1.1 - - [01/Jan/2020:00:00:{s:02d} +0000] "GET /p{s} H" 200 5 "r" "a" "sid=x"' for s in (1, 4)])
    conf = {"log.fieldList": "sessionId,url", "session.idName": "sid", "comp.elapasedTime": "true"}
    assert run(spark, "parsed_sessions", conf, log, tmp_path) == ["x,/p1,3000", "x,/p4,0"]
    assert run(spark, "parsed_session_average", conf, log, tmp_path) == ["x,1577836801000,/p1,3000,2,3000"]


def test_streams_from_configuration(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in" / "a", [f"2020-01-01 00:00:{i:02d} ip GET /{p}?sessionid=s{i // 2} 200" for i, p in enumerate(["home1", "logout"] * 4)])
    conf = Config({"session.regex": r".*?sessionid=(\w+).*", "page.id.pattern": r"/(home\S).*", "logOut.pattern": "logout", "window.size": "4", "min.window.size.for.stat": "2"})
    got = []
    first, second = jobs.visit_stream(spark, conf, str(tmp_path / "in"), str(tmp_path / "ck"), lambda df, n: got.extend(r[0] for r in df.collect()))
    assert second.awaitTermination(120) and got == ["home1:0"]
    (tmp_path / "app").mkdir()
    put(tmp_path / "app" / "a", [f"d t s p{i % 2} u{i}" for i in range(50)])
    seen = []
    query = jobs.visitor_stream(spark, Config({"min.total.count": "5"}), str(tmp_path / "app"), str(tmp_path / "ck2"), lambda df, n: seen.extend(df.collect()))
    assert query.awaitTermination(120) and seen[-1]["users"] == 50


def test_continuation_lines_stay_with_their_record(spark, tmp_path):
    log = put(tmp_path / "log", ["lost", "2015-05-15 10:00:00 USR=u1;+SES=s1 /a r", "2015-05-15 10:00:05 USR=u1;+SES=s1 /b r", "  at boom.one", "  at boom.two", "2015-05-15 10:00:09 USR=u1;+SES=s1 /c r"])
    conf = {"sed.field.meta": "cookie:2,date:0,time:1,url:3,referrer:4", "sed.user.id.name": "USR", "sed.session.id.name": "SES", "sed.before.match.context.size": "1", "sed.after.match.context.size": "1"}
    conf |= {"event.pattern.1.name": "crash", "event.pattern.1.regex": r"boom\.two"}
    found = run(spark, "event_detector", conf, log, tmp_path)
    assert len(found) == 3 and any(r"/b r\n  at boom.one\n  at boom.two" in x for x in found)
    slashed = put(tmp_path / "slashed", ["15/05/2015 10:00:00 USR=u1;+SES=s1 /a boom.two"])
    assert len(run(spark, "event_detector", conf | {"sed.date.format.str": "dd/MM/yyyy HH:mm:ss"}, slashed, tmp_path / "s")) == 1


def test_engagement_over_session_pages(spark, tmp_path):
    pages = put(tmp_path / "pages", ["s1,u1,x,1431684000000,/product/A", "s1,u1,x,1431684015000,/cart"])
    conf = {"eeg.engagement.events": "/product/(\\w+):1,/cart:2:8", "eeg.session.id.ord": "0", "eeg.user.id.ord": "1", "eeg.url.ord": "4", "eeg.time.stamp.ord": "3"}
    assert run(spark, "engagement_events", conf, pages, tmp_path) == ["u1,A,2,8"]
    del conf["eeg.user.id.ord"], conf["eeg.url.ord"], conf["eeg.time.stamp.ord"]
    assert run(spark, "engagement_events", conf, pages, tmp_path) == ["u1,A,2,8"]


@pytest.mark.parametrize("written", [{}, {"eeg.user.id.ord": "0", "eeg.url.ord": "1", "eeg.time.stamp.ord": "2"}])
def test_engagement_over_raw_lines_with_default_ordinals(spark, tmp_path, written):
    log = put(tmp_path / "log", ["2015-05-15 10:00:00 USR=u1;+SES=s1 /product/A r", "2015-05-15 10:00:15 USR=u1;+SES=s1 /product/B r", "2015-05-15 10:00:20 USR=u1;+SES=s1 /cart r"])
    conf = {"see.field.meta": "cookie:2,date:0,time:1,url:3,referrer:4", "see.user.id.name": "USR", "see.session.id.name": "SES", "eeg.engagement.events": "/product/(\\w+):1,/buy:2:8"}
    assert sorted(run(spark, "engagement_events", conf | written, log, tmp_path)) == ["u1,A,1,15", "u1,B,1,5"]
    with pytest.raises(ValueError, match="ord"):
        run(spark, "engagement_events", conf | {"eeg.url.ord": "0"}, log, tmp_path / "x")


def test_output_switches(spark, tmp_path, capfd):
    rows = put(tmp_path / "c", [f"{i},x,{i % 2}" for i in range(40)])
    run(spark, "class_histogram", {"num.reducer": "3", "bs.num.reducer": "1", "field.delimOut": ";", "debug.on": "true"}, rows, tmp_path)
    files = list((tmp_path / "class_histogram").glob("part-*"))
    assert len(files) == 1 and ";" in files[0].read_text() and "+--" in capfd.readouterr().out
    jobs.run(spark, "class_histogram", Config({"save.output": "false"}), rows, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_exponential_law_needs_the_mean_alone(spark, tmp_path):
    put(tmp_path / "stats", ["global_av_time_gap=4.0"])
    rows = put(tmp_path / "r", ["a,4,8,10.0"])
    conf = {"trs.xaction.stats.file.path": str(tmp_path / "stats"), "trs.trans.gap.prob.distr": "exponential"}
    assert run(spark, "recency_score", conf, rows, tmp_path) == ["a,4,0.135,10.0"]


def test_visitor_stream_takes_commands_and_keeps_totals_over_restarts(spark, tmp_path):
    (tmp_path / "app").mkdir()
    (tmp_path / "commands").mkdir()
    conf = Config({"command.store": str(tmp_path / "commands"), "bucket.bit.count": "12"})

    def once(name, lines, commands):
        put(tmp_path / "app" / name, lines)
        put(tmp_path / "commands" / name, commands)
        seen = []
        assert jobs.visitor_stream(spark, conf, str(tmp_path / "app"), str(tmp_path / "ck"), lambda df, n: seen.extend(df.collect())).awaitTermination(120)
        return seen[-1]

    both = lambda letter, n: [f"d t s p{i % 2} {letter}{i}" for i in range(n)]
    first = once("a", both("u", 400), ["no command"])
    assert abs(first["users"] - 400) < 20 and abs(first["union_users"] - 400) < 20
    # A new query from the checkpoint, in which one part alone has events.
    second = once("b", [f"d t s p1 v{i}" for i in range(100)] + [f"d t s p1 u{i}" for i in range(50)], ["none"])
    assert abs(second["users"] - 525) < 25 and abs(second["union_users"] - 500) < 25
    third = once("c", ["d t s p0 u0"], ["p1,reset"])
    assert abs(third["users"] - 200) < 10 and abs(third["union_users"] - 200) < 10
    again = once("d", both("w", 60), ["p0,reset", "p1,reset"])
    assert abs(again["users"] - 60) < 3 and abs(again["union_users"] - 60) < 3


def test_counters_of_a_pass(spark, tmp_path):
    log = put(tmp_path / "log", ["2015-05-15 10:00:00 USR=u1;+SES=s1 /a r", "2015-05-15 10:00:05 USR=u1 /b r", "no time USR=u1;+SES=s1 /c r", "2015-05-15 10:00:09 USR=u1;+SES=s2 /c r"])
    for job in ("session_extractor", "session_summarizer", "engagement_events"):
        assert jobs.run(spark, job, Config(WEB), log, str(tmp_path / job)) == {"records": 4, "records_without_time": 1, "records_with_session": 3}, job
    rows = put(tmp_path / "x", [f"x,{who},2015-05-{day:02d} 10:00:00,5.0" for who, days in (("a", (1, 3, 8)), ("b", (1, 2)), ("c", (4,)), ("d", (1, 2, 3, 4))) for day in days])
    conf = {"trf.id.field.ordinals": "1", "trf.quant.attr.list": "3", "trf.time.gap.unit": "day", "trf.recency.ref.date": "2015-06-01 00:00:00", "debug.on": "true"}
    assert jobs.run(spark, "frequency_recency_value", Config(conf), rows, str(tmp_path / "rfm")) == {"ids": 4, "short_histories": 2}
    assert jobs.run(spark, "frequency_recency_value", Config(conf | {"save.output": "false"}), rows, str(tmp_path / "none")) == {}


def test_standard_sessions_are_summed_up_from_what_was_written(spark, tmp_path):
    line = lambda s, sid, url: f'1.1.1.1 - me [01/Jan/2024:10:00:{s:02d} +0000] "GET {url} HTTP/1.1" 200 1 "r" "a" "sid={sid}"'
    log = put(tmp_path / "log", [line(5, "s1", "/b"), line(0, "s1", "/a"), line(20, "s1", "/c"), line(7, "s2", "/z")])
    conf = {"session.idName": "sid", "log.fieldList": "sessionId,dateTimeEpoch,url,dateTime", "comp.elapasedTime": "true", "field.delimOut": ";", "date.format": "HH:mm:ss"}
    got = run(spark, "parsed_sessions", conf, log, tmp_path)
    ms = 1_704_103_200_000
    assert got == [f"s1;{ms};/a;10:00:00;5000", f"s1;{ms + 5000};/b;10:00:05;15000", f"s1;{ms + 20000};/c;10:00:20;0", f"s2;{ms + 7000};/z;10:00:07;0"]
    summary = {"log.fieldList": "sessionId,dateTimeEpoch,url,userId,timeOnPage", "field.delimIn": ";"}
    found = run(spark, "parsed_session_summary", summary, [str(tmp_path / "parsed_sessions")], tmp_path)
    assert found == [f"s1,{ms},/a,10:00:00,20000,3,10000", f"s2,{ms + 7000},/z,10:00:07,0,1,"]
    assert run(spark, "parsed_sessions", conf | {"date.format": "epochTime", "comp.elapasedTime": "false"}, log, tmp_path / "x")[0] == f"s1;{ms};/a;{ms}"
