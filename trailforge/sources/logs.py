"""Text sources and sinks: lines with file, offset and number; web log parsers; multi-line records; statistics files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailforge.functions import scalars as S

NCSA, W3C = "NCSA", "W3C"
#: Names of files whose size is not that of their text.
PACKED = r"\.(gz|bz2|zst|zstd|lz4|snappy|deflate)$"

#: The fields of a parsed log line and their types.
FIELD_TYPES = {
    "dateTime": "timestamp", "dateTimeEpoch": "long", "cIp": "string", "sIp": "string", "clientId": "string", "userName": "string", "method": "string",
    "url": "string", "urlQuery": "string", "httpVersion": "string", "status": "string", "scNumBytes": "int", "csNumBytes": "int", "timeTaken": "int",
    "userAgent": "string", "referrer": "string", "sessionId": "string", "userId": "string", "timeOnPage": "int",
}


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """file, value of every line of text files, globs or folders."""
    return spark.read.text(list(paths)).select(F.col("_metadata.file_name").alias("file"), "value")


def read_lines_with_offsets(spark: SparkSession, *paths: str) -> DataFrame:
    """file, path, line_no (from 0), byte_offset, value of every line of text files, globs or folders.

    Files are split as Spark splits them. Lines are counted and measured inside their split, and
    a split begins where the earlier ones of its file end. A carriage return before a line feed
    counts as a byte and is not part of the value; so do the three bytes of a mark at a file's begin.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_size").alias("size"), "value",
    )
    size = F.octet_length("value").cast("long") + 1
    here = Window.partitionBy("path", "block").orderBy("at")
    local = lines.withColumns({"n": F.row_number().over(here) - 1, "offset": F.coalesce(F.sum(size).over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    blocks = lines.groupBy("path", "block").agg(F.count(F.lit(1)).alias("lines"), F.sum(size).alias("bytes"), F.max("size").alias("size"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The reader swallows a byte order mark, which then is what a file has more than its lines (whose last may lack its line feed).
    lacking = F.col("size") - F.sum("bytes").over(Window.partitionBy("path"))
    mark = F.when(lacking.isin(2, 3) & ~F.col("path").rlike(PACKED), 3).otherwise(0)
    begins = blocks.select("path", "block", mark.alias("mark"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("lines", "bytes")])
    met = local.join(begins, ["path", "block"]).withColumn("line_no", F.col("lines_before") + F.col("n"))
    offset = F.when(F.col("line_no") > 0, F.col("bytes_before") + F.col("offset") + F.col("mark")).otherwise(F.lit(0)).cast("long")
    return met.select("file", "path", "line_no", offset.alias("byte_offset"), F.regexp_replace("value", r"\r\z", "").alias("value"))


def source_prefix(file: Column, sep: str = "_") -> Column:
    """The source id of a file: its name up to the first separator."""
    return F.substring_index(file, sep, 1)


def fixed_prefix(file: Column, width: int = 8) -> Column:
    """The first characters of the name, filled with x."""
    return F.rpad(F.substring(file, 1, width), width, "x")


def write_lines(df: DataFrame, path: str, sep: str = ",", files: int | None = None) -> None:
    """Writes the columns of `df` as separated text, in `files` files if a number is given."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
    lines = df.select(line.alias("value"))
    (lines.coalesce(files) if files else lines).write.mode("overwrite").text(path)


def read_delimited(spark: SparkSession, path: str, columns: dict[str, tuple[int, str]], regex: str = ",") -> DataFrame:
    """Named, typed columns from positions: columns maps a name to (0-based position, type)."""
    parts = F.split("value", regex)
    return spark.read.text(path).select(*[F.trim(F.get(parts, at)).try_cast(kind).alias(name) for name, (at, kind) in columns.items()])


def write_stats(stats: DataFrame, path: str) -> None:
    """A one-row table as k=v lines."""
    pairs = F.array(*[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in stats.columns])
    stats.select(F.explode(pairs).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_stats(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """One row with the named statistics (double) of a file of k=v lines; all names must be there."""
    pair = F.split("value", "=")
    found = spark.read.text(path).select(F.trim(F.get(pair, 0)).alias("k"), F.trim(F.get(pair, 1)).try_cast("double").alias("v"))
    row = found.agg(*[F.max(F.when(F.col("k") == n, F.col("v"))).alias(n) for n in names])
    return row.select(*[F.when(F.col(n).isNull(), F.raise_error(F.lit(f"no statistic {n}")).cast("double")).otherwise(F.col(n)).alias(n) for n in names])


def parse_ncsa(line: Column, session_name: str, user_name: str | None = None) -> Column:
    """A struct of the fields of an NCSA combined line: ip id user [time] "request" status bytes "referrer" "agent" "cookie"."""
    f = lambda i: F.get(S.quoted_fields(line, 10), i)
    request = lambda i: F.get(F.split(f(4), " "), i)
    when = F.try_to_timestamp(f(3), F.lit("dd/MMM/yyyy:HH:mm:ss Z"))
    return F.struct(
        f(0).alias("cIp"), f(1).alias("clientId"), f(2).alias("userName"), when.alias("dateTime"), F.unix_millis(when).alias("dateTimeEpoch"),
        request(0).alias("method"), request(1).alias("url"), request(2).alias("httpVersion"),
        f(5).alias("status"), f(6).try_cast("int").alias("csNumBytes"), f(7).alias("referrer"), f(8).alias("userAgent"),
        _cookie(f(9), session_name).alias("sessionId"), _cookie(f(9), user_name).alias("userId"),
    )


def parse_w3c(line: Column, session_name: str, user_name: str | None = None) -> Column:
    """A struct of the fields of an extended log line: date time c-ip user s-ip method url query status sc-bytes cs-bytes time-taken version agent cookie referrer."""
    f = lambda i: F.get(F.split(line, r"\s+"), i)
    when = F.try_to_timestamp(F.concat_ws(" ", f(0), f(1)), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.struct(
        when.alias("dateTime"), F.unix_millis(when).alias("dateTimeEpoch"), f(2).alias("cIp"), f(3).alias("userName"), f(4).alias("sIp"), f(5).alias("method"),
        f(6).alias("url"), f(7).alias("urlQuery"), f(8).alias("status"), f(9).try_cast("int").alias("scNumBytes"), f(10).try_cast("int").alias("csNumBytes"),
        f(11).try_cast("int").alias("timeTaken"), f(12).alias("httpVersion"), f(13).alias("userAgent"),
        _cookie(f(14), session_name).alias("sessionId"), _cookie(f(14), user_name).alias("userId"), f(15).alias("referrer"),
    )


def typed(rows: DataFrame) -> DataFrame:
    """Columns named like log fields, cast from text to the types that the fields have; others stay text."""
    return rows.select(*[F.col(c).try_cast(FIELD_TYPES.get(c, "string")).alias(c) for c in rows.columns])


def _cookie(cookie: Column, name: str | None) -> Column:
    """The value of the cookie of exactly this name; names are split off at the first =."""
    if name is None:
        return F.lit(None).cast("string")
    pairs = F.filter(F.split(cookie, r";\+?\s*"), lambda p: F.substring_index(p, "=", 1) == name)
    last = F.get(pairs, F.size(pairs) - 1)
    return F.when(F.locate("=", last) > 0, F.substr(last, F.locate("=", last) + 1))


Parser = Callable[[Column, str, str | None], Column]
PARSERS: dict[str, Parser] = {NCSA: parse_ncsa, W3C: parse_w3c}


def parse_log(lines: DataFrame, fmt: str | Parser, fields: list[str], session_name: str, user_name: str | None = None, value: str = "value") -> DataFrame:
    """The chosen fields of each line that has a session id and a time; the format is known by name, or a parser of one's own."""
    parser = fmt if callable(fmt) else PARSERS.get(fmt)
    if parser is None:
        raise ValueError(f"log format {fmt!r} is none of {sorted(PARSERS)}")
    parsed = lines.select(parser(F.col(value), session_name, user_name).alias("r"))
    return parsed.where("r.sessionId is not null and r.dateTimeEpoch is not null").select(*[F.col(f"r.{f}").alias(f) for f in fields])


def multi_line(lines: DataFrame, regex: str | Column, starts: bool = True, file: str = "file", order: str = "line_no", value: str = "value", sep: str = "\\n", width: int = 100_000) -> DataFrame:
    """file, line_no of the first line, and record: lines joined to records.

    With `starts`, a line in which the regex is found (or for which a condition holds) begins a
    record; without, a line in which it is not does. Lines before the first record of a file are
    left out, and the last record of a file is complete at its end. `order` is a whole number; a
    file is taken in stretches of `width` of it, each of which is told the record that is open at its begin.
    """
    found = F.col(value).rlike(regex) if isinstance(regex, str) else F.coalesce(regex, F.lit(False))
    begin = F.when(found if starts else ~found, F.col(order))
    marked = lines.select(F.col(file), F.col(order), F.col(value), begin.alias("__begin"), F.floor(F.col(order) / width).cast("long").alias("__stretch"))
    here = Window.partitionBy(file, "__stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(file).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    open_ = marked.groupBy(file, "__stretch").agg(F.max("__begin").alias("last")).select(file, "__stretch", F.max("last").over(earlier).alias("__open"))
    placed = marked.withColumn("__own", F.max("__begin").over(here)).join(open_, [file, "__stretch"]).withColumn("__record", F.coalesce("__own", "__open"))
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return placed.where("__record is not null").groupBy(file, F.col("__record").alias(order)).agg(parts.alias("p")).select(
        file, order, F.array_join(F.transform("p", lambda p: p["v"]), sep).alias("record")
    )
