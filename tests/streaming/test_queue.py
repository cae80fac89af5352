import pytest
from pyspark.errors import StreamingQueryException

from tests.streaming.queue_server import Server
from trailforge.plans import jobs
from trailforge.plans.jobs import Config
from trailforge.sources import queue as Q


@pytest.fixture
def server():
    with Server() as found:
        yield found
        found.shutdown()


def copy(spark, server, checkpoint, **options):
    """Reads the list `in` to its end and writes it to the list `out`."""
    lines = Q.read_queue(spark, "in", port=server.port, partitions=3)
    writer = lines.writeStream.format(Q.FORMAT).option("key", "out").option("port", server.port).option("id", "copy")
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return query.awaitTermination(120)


def test_lines_go_through_once_over_restarts(spark, server, tmp_path):
    want = []
    for n in (2500, 0, 1, 40):
        lines = [f"line {len(want) + i} é" for i in range(n)]
        server.push("in", *lines)
        want += lines
        assert copy(spark, server, str(tmp_path / "ck"))
        assert sorted(server.lines("out")) == sorted(want)
    # What was committed is trimmed at the latest when the next batch begins.
    assert len(server.lines("in")) <= 40


def test_a_killed_stream_loses_and_doubles_nothing(spark, server, tmp_path):
    server.push("in", *[f"a{i}" for i in range(30)])
    # The commit of the batch fails after its tasks have staged their lines.
    server.store.refuse.add("RPOPLPUSH")
    with pytest.raises(StreamingQueryException):
        copy(spark, server, str(tmp_path / "ck"))
    server.store.refuse.clear()
    assert server.lines("out") == [] and len(server.lines("in")) == 30
    server.push("in", *[f"b{i}" for i in range(5)])
    assert copy(spark, server, str(tmp_path / "ck"))
    assert copy(spark, server, str(tmp_path / "ck"))
    assert sorted(server.lines("out")) == sorted([f"a{i}" for i in range(30)] + [f"b{i}" for i in range(5)])
    assert not [k for k in server.store.lists if b"staged" in k]


def test_a_batch_that_is_written_again_changes_nothing(spark, server):
    df = spark.createDataFrame([("p:1",), ("p:2",), (None,)], "line string")
    sink = Q.queue_sink("out", port=server.port, id="again")
    for n in (0, 0, 1, 1, 0):
        sink(df, n)
    assert sorted(server.lines("out")) == sorted(["p:1", "p:2", ""] * 2)


def test_reader_counts_from_the_oldest(server):
    reader = Q.QueueReader({"key": "in", "port": str(server.port), "partitions": "2", "maxLines": "7"})
    assert reader.initialOffset() == {"line": 0} == reader.latestOffset()
    server.push("in", *map(str, range(10)))
    assert reader.latestOffset() == {"line": 7}
    parts = reader.partitions({"line": 0}, {"line": 7})
    assert [[x for (x,) in reader.read(p)] for p in parts] == [["0", "1", "2", "3"], ["4", "5", "6"]]
    server.push("in", "10")
    reader.commit({"line": 7})
    reader.commit({"line": 7})
    assert server.lines("in") == ["7", "8", "9", "10"] and reader.latestOffset() == {"line": 11}
    assert [x for p in reader.partitions({"line": 7}, {"line": 11}) for (x,) in reader.read(p)] == ["7", "8", "9", "10"]
    # Another reader begins where lines are left, and lines that something else took are an error.
    assert Q.QueueReader({"key": "in", "port": str(server.port)}).initialOffset() == {"line": 7}
    server.store.rpop(b"in")
    with pytest.raises(RuntimeError, match="gone"):
        list(reader.read(Q._Lines(7, 11)))


def test_connection_raises_what_the_server_says(server):
    with Q.Connection("localhost", server.port) as link:
        assert link.call("PING") == "PONG" and link.call("GET", "no") is None
        with pytest.raises(RuntimeError, match="ERR"):
            link.call("NOSUCH")
    with pytest.raises(ValueError, match="key"):
        Q.QueueReader({})


def test_jobs_read_and_write_queues(spark, server, tmp_path):
    line = lambda s, session, page: f"2024-01-01 10:00:{s:02d} 10.0.0.1 GET /{page}?sessionid={session} 200"
    server.push("logQueue", *[line(i, "abc", p) for i, p in enumerate(["home1", "cart", "logout"])], line(30, "late", "cart"))
    conf = {"messaging.provider": "redis", "redis.server.host": "localhost", "redis.server.port": str(server.port)}
    visit = Config(conf | {
        "redis.log.queue": "logQueue", "session.regex": r".*?sessionid=(\w+).*", "page.id.pattern": r"/(home\d)", "logOut.pattern": "logout", "window.size": "4",
        "min.window.size.for.stat": "1", "result.type": "avDepth", "visit.depth.stat.queue": "visitStatQueue", "spout.threads": "2",
    })
    _, second = jobs.visit_stream(spark, visit, str(tmp_path / "handed"), str(tmp_path / "ck"))
    assert second.awaitTermination(120) and server.lines("visitStatQueue") == ["home1:3"]
    server.push("appLogQueue", *[f"2024-01-01 10:00:00 s a{i % 2} u{i}" for i in range(60)])
    app = Config(conf | {"input.log.queue": "appLogQueue", "output.count.queue": "counts", "min.total.count": "20"})
    assert jobs.visitor_stream(spark, app, str(tmp_path / "handed2"), str(tmp_path / "ck2")).awaitTermination(120)
    ((ms, users),) = [x.split("  ") for x in server.lines("counts")]
    assert users == "60" and int(ms) > 1_600_000_000_000
