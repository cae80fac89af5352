"""A list queue behind a socket as a source and a sink of streams, in the wire protocol that list stores share (RESP).

Producers push lines to the head of a list (LPUSH). The source numbers them from the tail, where
the oldest line is: line p, counted from the first that ever was in the list, stands at index
-(p - removed + 1), and `removed` is kept beside the list under the name KEY:removed. A batch
reads lines by their numbers and takes none away, so it can be read again after a failure, by
any executor. Only when a batch has been committed are its lines trimmed, in one transaction with the
new `removed`. No line is lost or read twice as long as nothing else takes from the list.

The sink has every task push its lines to a list of its own; the commit moves all of them to
the queue in one transaction with the number of the batch, so a batch that is written again
changes nothing. The name under which batches are numbered (option `id`) belongs to one
checkpoint.

Options: host (localhost), port (6379), key; for the source `partitions` (tasks a trigger, 1) and
`maxLines` (lines a trigger; not for runs that end when all is read).
"""

from __future__ import annotations

import socket
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage

from trailforge.functions.ship import ship

FORMAT = "listqueue"
#: Lines that one request reads or pushes, and seconds after which the list of a task that was lost goes.
PAGE, STAGED_S = 1000, 86_400


class Connection:
    """Commands and their replies over one socket; an error reply raises."""

    def __init__(self, host: str, port: int, timeout: float = 30.0) -> None:
        self.socket = socket.create_connection((host, port), timeout)
        self.replies = self.socket.makefile("rb")

    def __enter__(self) -> Connection:
        return self

    def __exit__(self, *_: object) -> None:
        self.replies.close()
        self.socket.close()

    def call(self, *words: object) -> object:
        return self.all([words])[0]

    def all(self, commands: list[tuple]) -> list:
        """The replies to commands that are sent at once."""
        self.socket.sendall(b"".join(_encoded(words) for words in commands))
        return [self._reply() for _ in commands]

    def atomic(self, commands: list[tuple]) -> list:
        """The replies to commands that are carried out as one."""
        return self.all([("MULTI",), *commands, ("EXEC",)])[-1]

    def _reply(self) -> object:
        line = self.replies.readline()
        if not line.endswith(b"\r\n"):
            raise ConnectionError("the queue's server closed the connection")
        kind, rest = line[:1], line[1:-2]
        if kind == b"+":
            return rest.decode()
        if kind == b":":
            return int(rest)
        if kind == b"$":
            return None if rest == b"-1" else self.replies.read(int(rest) + 2)[:-2]
        if kind == b"*":
            return None if rest == b"-1" else [self._reply() for _ in range(int(rest))]
        raise RuntimeError(f"the queue's server says {rest.decode(errors='replace')}")


def _encoded(words: tuple) -> bytes:
    parts = [w if isinstance(w, bytes) else str(w).encode() for w in words]
    return b"*%d\r\n" % len(parts) + b"".join(b"$%d\r\n%s\r\n" % (len(p), p) for p in parts)


class _At:
    """Where the queue is; connections are opened for each call, since this is sent to executors."""

    def __init__(self, options: dict[str, str]) -> None:
        if not options.get("key"):
            raise ValueError("a queue needs the option key")
        self.host, self.port, self.key = options.get("host", "localhost"), int(options.get("port", 6379)), options["key"]

    def connect(self) -> Connection:
        return Connection(self.host, self.port)

    def removed(self, link: Connection) -> int:
        return int(link.call("GET", f"{self.key}:removed") or 0)


class _Lines(InputPartition):
    def __init__(self, start: int, end: int) -> None:
        self.start, self.end = start, end


class QueueReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.at, self.tasks = _At(options), int(options.get("partitions", 1))
        self.most = int(options["maxLines"]) if options.get("maxLines") else None
        self.given: int | None = None

    def initialOffset(self) -> dict:
        with self.at.connect() as link:
            self.given = self.at.removed(link)
        return {"line": self.given}

    def latestOffset(self) -> dict:
        with self.at.connect() as link:
            removed, size = link.atomic([("GET", f"{self.at.key}:removed"), ("LLEN", self.at.key)])
        removed = int(removed or 0)
        end = removed + size
        if self.most:
            end = min(end, max(self.given or 0, removed) + self.most)
        # Never behind what was given: a list that was cleared by hand has no new lines.
        self.given = max(end, self.given or 0)
        return {"line": self.given}

    def partitions(self, start: dict, end: dict) -> list[_Lines]:
        first, last = start["line"], end["line"]
        self.given = max(self.given or 0, last)
        size = max(-(-(last - first) // self.tasks), 1)
        return [_Lines(at, min(at + size, last)) for at in range(first, last, size)]

    def read(self, partition: _Lines) -> Iterator[tuple]:
        with self.at.connect() as link:
            at = partition.start
            while at < partition.end:
                end = min(at + PAGE, partition.end)
                removed = self.at.removed(link)
                before, lines = link.atomic([("GET", f"{self.at.key}:removed"), ("LRANGE", self.at.key, removed - end, removed - at - 1)])
                if int(before or 0) != removed:
                    continue
                if removed > at or len(lines) != end - at:
                    raise RuntimeError(f"lines {at} to {end} of the queue {self.at.key} are gone: something else takes from it")
                for line in reversed(lines):
                    yield (line.decode("utf-8", "replace"),)
                at = end

    def commit(self, end: dict) -> None:
        with self.at.connect() as link:
            done = end["line"] - self.at.removed(link)
            if done > 0:
                link.atomic([("LTRIM", self.at.key, 0, -(done + 1)), ("SET", f"{self.at.key}:removed", end["line"])])


class _Staged(WriterCommitMessage):
    def __init__(self, name: str, size: int) -> None:
        self.name, self.size = name, size


class _Sink:
    def __init__(self, options: dict[str, str]) -> None:
        self.at, self.id, self.batch = _At(options), options.get("id", "stream"), options.get("batch")

    def stage(self, rows: Iterator) -> _Staged:
        name, size, page = f"{self.at.key}:staged:{uuid.uuid4().hex}", 0, []
        with self.at.connect() as link:

            def push() -> None:
                if page:
                    link.all([("LPUSH", name, *page), ("EXPIRE", name, STAGED_S)])
                    page.clear()

            for row in rows:
                page.append(row[0] if row[0] is not None else "")
                size += 1
                if len(page) == PAGE:
                    push()
            push()
        return _Staged(name, size)

    def publish(self, messages: list[_Staged | None], batch: int | None) -> None:
        staged, mark = [m for m in messages if m and m.size], f"{self.at.key}:batch:{self.id}"
        with self.at.connect() as link:
            if batch is not None and int(link.call("GET", mark) or -1) >= batch:
                self._drop(link, staged)
                return
            moves = [("RPOPLPUSH", m.name, self.at.key) for m in staged for _ in range(m.size)]
            if moves or batch is not None:
                link.atomic(moves + ([("SET", mark, batch)] if batch is not None else []))

    def discard(self, messages: list[_Staged | None]) -> None:
        with self.at.connect() as link:
            self._drop(link, [m for m in messages if m])

    @staticmethod
    def _drop(link: Connection, staged: list[_Staged]) -> None:
        if staged:
            link.call("DEL", *[m.name for m in staged])


class QueueStreamWriter(_Sink, DataSourceStreamWriter):
    def write(self, iterator: Iterator) -> WriterCommitMessage:
        return self.stage(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        self.publish(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self.discard(messages)


class QueueWriter(_Sink, DataSourceWriter):
    """The writer of one table; with the option `batch`, a number that only grows, it can be written again."""

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        return self.stage(iterator)

    def commit(self, messages: list) -> None:
        self.publish(messages, int(self.batch) if self.batch else None)

    def abort(self, messages: list) -> None:
        self.discard(messages)


class QueueSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> QueueReader:
        return QueueReader(self.options)

    def streamWriter(self, schema, overwrite: bool) -> QueueStreamWriter:
        return QueueStreamWriter(self.options)

    def writer(self, schema, overwrite: bool) -> QueueWriter:
        return QueueWriter(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format `listqueue` known to the session."""
    ship(spark)
    spark.dataSource.register(QueueSource)


def read_queue(spark: SparkSession, key: str, host: str = "localhost", port: int = 6379, partitions: int = 1, max_lines: int | None = None) -> DataFrame:
    """A stream of the lines (value) that are pushed to a list."""
    register(spark)
    reader = spark.readStream.format(FORMAT).option("key", key).option("host", host).option("port", port).option("partitions", partitions)
    return (reader.option("maxLines", max_lines) if max_lines else reader).load()


def queue_sink(key: str, host: str = "localhost", port: int = 6379, id: str = "stream"):
    """A foreachBatch function that pushes the first column of each batch to a list, once for each batch number."""

    def sink(batch: DataFrame, number: int) -> None:
        register(batch.sparkSession)
        lines = batch.select(F.col(batch.columns[0]).cast("string").alias("value"))
        lines.write.format(FORMAT).mode("append").option("key", key).option("host", host).option("port", port).option("id", id).option("batch", number).save()

    return sink
