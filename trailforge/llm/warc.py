"""WARC archives in which equal payloads are stored once.

`resolve` shuffles headers alone (digest, length, page_id) to find, for each payload that
occurs more than once, the page that keeps it. `write` gives every page a record with fresh
headers: a response with the payload, or a revisit that names the response. Archives are
written by Spark's text writer, whose commit survives lost executors and reaches any
Hadoop file system; a record ends in CR LF CR LF, so records back to back are the file.
`read` parses archives by Content-Length and `restore` joins revisits to their responses. Pages
meet the list of revisits by page_id and digest; Spark broadcasts it where it measures it as
small, and else each page is shuffled once.

Defined cases: a null payload is empty; payloads under `least` bytes are never revisits;
a null page_id is read back as null and is never referred to; rows that repeat the page_id
of the page that keeps a payload are responses too; line breaks in a URL are percent-encoded,
a null URL has no header; a revisit whose response is not in the archives stays, with null
payload_bytes and payload_digest; other columns are ignored; an empty table gives no records.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailforge.llm import common

LEAST = 100
#: Bytes of payload that an archive is meant to hold.
ARCHIVE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"


def _with_digest(pages: DataFrame, page: str, url: str, html: str) -> DataFrame:
    body = F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        F.col(page).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        body.alias("body"),
        F.sha2(body.cast("binary"), 256).alias("digest"),
        F.octet_length(body).cast("long").alias("bytes"),
    )


def originals(headers: DataFrame, least: int = LEAST) -> DataFrame:
    """digest, bytes, original (smallest page_id), copies of each payload that more than one row has."""
    return (
        headers.where(F.col("bytes") >= least)
        .groupBy("digest", "bytes")
        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and original is not null")
    )


def resolve(pages: DataFrame, least: int = LEAST, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, body, digest, bytes, original, record_type of every row of `pages`.

    Headers find the rows that are revisits, whose list (page_id, digest, original) is what rows
    are joined to. The joined list has one row for each page_id and digest, so no key of it is hot.
    """
    rows = _with_digest(pages, page, url, html)
    headers = common.stored(rows.select("page_id", "digest", "bytes"), "headers")
    kept = common.weighed(originals(headers, least), "originals", "copies")
    again = common.hot_join(headers, kept, ["digest", "bytes"], "copies").where("not original <=> page_id")
    again = common.stored(again.select("page_id", "digest", "original").distinct(), "revisits")
    common.forget(headers, kept[0])
    met = rows.join(again, rows["page_id"].eqNullSafe(again["page_id"]) & (rows["digest"] == again["digest"]), "left")
    return met.select(
        rows["page_id"], "url", "body", rows["digest"], "bytes", "original",
        F.when(F.col("original").isNotNull(), F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
    )


def record() -> Column:
    """The text of a record from the columns of `resolve`, but for its last line feed."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_END))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}"), line("Content-Length", F.col("bytes").cast("string")), F.lit(_END)
    )
    block = F.concat(http, F.when(F.col("record_type") == "response", F.col("body")).otherwise(F.lit("")))
    fields = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn("page_id")),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        F.lit(f"WARC-Date: {DATE}{_END}"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(F.col("record_type") == "revisit", F.concat(line("WARC-Refers-To", urn("original")), F.lit(f"WARC-Profile: {PROFILE}{_END}"))).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{_END}"),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(fields, F.lit(_END), block, F.lit(f"{_END}\r"))


def write(pages: DataFrame, path: str, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES, **columns: str) -> None:
    """Writes gzip-compressed archives of about `archive_bytes` of payload to the folder `path`, none with over 32 times as much but for one record's sake.

    Payloads of over a thirty-second of that go to archives of their own, so that a run of long ones stays bounded too.
    """
    rows = resolve(pages, least, **columns)
    long_bytes = max(1, archive_bytes // 32)
    size = F.octet_length(columns.get("html", "html")).cast("long")
    short, long_ = (F.when(F.coalesce(size, F.lit(0)) <= long_bytes, 1), F.when(size > long_bytes, size))
    n, total, most = pages.agg(F.count(short), F.sum(F.when(size <= long_bytes, size)), F.max(long_)).first()
    each = min(1024, max(1, int(archive_bytes / ((total or 0) / max(n, 1) + 400))))
    _archives(rows.where(F.col("bytes") <= long_bytes), path, each, "error")
    if most:
        _archives(rows.where(F.col("bytes") > long_bytes), path, max(1, archive_bytes // most), "append")


def _archives(rows: DataFrame, path: str, each: int, mode: str) -> None:
    rows.select(record().alias("value")).write.mode(mode).option("maxRecordsPerFile", each).option("lineSep", "\n").option("compression", "gzip").text(path)


def _unpacked(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of an archive, compressed or not, a piece at a time."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content:
        one = zlib.decompressobj(31)
        rest = content
        while rest and not one.eof:
            yield one.decompress(rest, step)
            rest = one.unconsumed_tail
        content = one.unused_data


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload (without the HTTP head) of each record of an archive, compressed or not; a record is all that is held."""
    pieces, held = _unpacked(content), bytearray()

    def until(there) -> bool:
        while not there():
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while until(lambda: held):
        if not until(lambda: b"\r\n\r\n" in held):
            raise ValueError("an archive ends inside a record's head")
        head_end = held.index(b"\r\n\r\n")
        version, *fields = held[:head_end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("no record where one should begin")
        headers = dict(f.split(": ", 1) for f in fields)
        begin = head_end + 4
        end = begin + int(headers["Content-Length"])
        if not until(lambda: len(held) >= end + 4):
            raise ValueError("an archive ends inside a record")
        body = held.index(b"\r\n\r\n", begin, end) + 4
        yield headers, bytes(held[body:end])
        del held[: end + 4]


_READ = "record_type string, page_id long, url string, digest string, refers_to long, payload binary"


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in _READ.split(", ")]
    for batch in batches:
        for archive in batch.column(0):
            rows, held = [], 0
            for h, payload in parse(archive.as_py()):
                digest = h.get("WARC-Payload-Digest", "").removeprefix("sha256:")
                rows.append((h["WARC-Type"], _page(h["WARC-Record-ID"]), h.get("WARC-Target-URI"), digest, _page(h.get("WARC-Refers-To")), payload))
                held += len(payload)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """record_type, page_id, url, digest, refers_to, payload of every record of the archives in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_records, _READ)


def restore(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record.

    Digest and length are computed from the payload that was read; a revisit has those of the
    response that it refers to, and its own header must name the same digest.
    """
    seen = common.stored(
        records.select(
            "record_type", "page_id", "refers_to", F.col("digest").alias("named"),
            F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        ),
        "records",
    )
    responses = seen.where("record_type = 'response'")
    revisits = seen.where("record_type = 'revisit'").select("record_type", "page_id", "refers_to", "named")
    asked = revisits.groupBy("refers_to", "named").agg(F.count(F.lit(1)).alias("n"))
    held = responses.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("named"), "payload_bytes", "payload_digest")
    found = common.weighed(asked.join(held.dropDuplicates(["refers_to", "named"]), ["refers_to", "named"]), "found", "n")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionByName(common.hot_join(revisits, found, ["refers_to", "named"], "n", "left").select(*columns))


def deduplicate(pages: DataFrame, path: str, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives of `pages` to `path` and gives `restore` of what they hold."""
    write(pages, path, least, archive_bytes)
    return restore(read(pages.sparkSession, path))
