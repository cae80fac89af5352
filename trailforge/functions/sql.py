"""The parsers and scalar functions as functions of SQL, defined in SQL over built-in expressions: no Python worker runs them.

`register` makes them temporary functions of a session. `w3c_log` and `ncsa_log` return a table of one row for a
line with a session and a time, and of none for another: `FROM lines, LATERAL w3c_log(lines.value, 'sid', 'uid')`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from trailforge.functions.scalars import ERF_TERMS, SERIES_END, UNIT_MS

_COOKIE = """try_element_at(filter(split(cookie, ';\\\\+?\\\\s*'), p -> substring_index(p, '=', 1) = name), -1)"""
_SERIES = f"""aggregate(sequence(1, {ERF_TERMS}), named_struct('term', a, 'sum', a), (s, n) -> named_struct('term', s.term * (a * a * 2.0D) / (n * 2 + 1), 'sum', s.sum + s.term * (a * a * 2.0D) / (n * 2 + 1)), s -> s.sum)"""
_FRACTION = f"aggregate(sequence({ERF_TERMS}, 1, -1), a, (f, k) -> a + k / 2.0D / f)"
_UNITS = " ".join(f"WHEN '{unit}' THEN {ms}" for unit, ms in UNIT_MS.items())

_W3C = {
    "dateTime": ("TIMESTAMP", "try_to_timestamp(f[0] || ' ' || f[1], 'yyyy-MM-dd HH:mm:ss')"), "cIp": ("STRING", "get(f, 2)"), "userName": ("STRING", "get(f, 3)"), "sIp": ("STRING", "get(f, 4)"),
    "method": ("STRING", "get(f, 5)"), "url": ("STRING", "get(f, 6)"), "urlQuery": ("STRING", "get(f, 7)"), "status": ("STRING", "get(f, 8)"), "scNumBytes": ("INT", "try_cast(get(f, 9) AS INT)"),
    "csNumBytes": ("INT", "try_cast(get(f, 10) AS INT)"), "timeTaken": ("INT", "try_cast(get(f, 11) AS INT)"), "httpVersion": ("STRING", "get(f, 12)"), "userAgent": ("STRING", "get(f, 13)"),
    "cookie": ("STRING", "get(f, 14)"), "referrer": ("STRING", "get(f, 15)"),
}
_NCSA = {
    "cIp": ("STRING", "get(f, 0)"), "clientId": ("STRING", "get(f, 1)"), "userName": ("STRING", "get(f, 2)"), "dateTime": ("TIMESTAMP", "try_to_timestamp(get(f, 3), 'dd/MMM/yyyy:HH:mm:ss Z')"),
    "method": ("STRING", "get(split(get(f, 4), ' '), 0)"), "url": ("STRING", "get(split(get(f, 4), ' '), 1)"), "httpVersion": ("STRING", "get(split(get(f, 4), ' '), 2)"),
    "status": ("STRING", "get(f, 5)"), "csNumBytes": ("INT", "try_cast(get(f, 6) AS INT)"), "referrer": ("STRING", "get(f, 7)"), "userAgent": ("STRING", "get(f, 8)"), "cookie": ("STRING", "get(f, 9)"),
}


def _table(name: str, fields: dict[str, tuple[str, str]], split: str) -> str:
    made = fields | {"dateTimeEpoch": ("BIGINT", "unix_millis(dateTime)"), "sessionId": ("STRING", "cookie_value(cookie, session_name)"), "userId": ("STRING", "cookie_value(cookie, user_name)")}
    told = ", ".join(f"{n} {kind}" for n, (kind, _) in made.items() if n != "cookie")
    parts = ", ".join(f"{how.replace('f[', 'get(f, ').replace(']', ')')} AS {n}" for n, (_, how) in fields.items())
    own = ", ".join(f"{how} AS {n}" for n, (_, how) in made.items() if n not in fields)
    names = ", ".join(n for n in made if n != "cookie")
    return f"""{name}(line STRING, session_name STRING, user_name STRING) RETURNS TABLE({told}) RETURN
  SELECT {names} FROM (SELECT *, {own} FROM (SELECT {parts} FROM (SELECT {split} AS f))) WHERE sessionId IS NOT NULL AND dateTimeEpoch IS NOT NULL"""


#: Definitions in the order in which they use one another.
FUNCTIONS = [
    f"cookie_value(cookie STRING, name STRING) RETURNS STRING RETURN CASE WHEN locate('=', {_COOKIE}) > 0 THEN substr({_COOKIE}, locate('=', {_COOKIE}) + 1) END",
    "quoted_fields(line STRING) RETURNS ARRAY<STRING> RETURN transform(regexp_extract_all(line, '\"([^\"]*)\"|\\\\[([^\\\\]]*)\\\\]|(\\\\S+)', 0), f -> regexp_replace(f, '^[\"\\\\[]|[\"\\\\]]$', ''))",
    f"to_unit(ms BIGINT, unit STRING) RETURNS BIGINT RETURN ms div CASE unit {_UNITS} END",
    "whole_group(text STRING, pattern STRING) RETURNS STRING RETURN CASE WHEN text RLIKE ('^(?:' || pattern || ')$') THEN regexp_extract(text, '^(?:' || pattern || ')$', 1) END",
    "exponential_cdf(x DOUBLE, mean DOUBLE) RETURNS DOUBLE RETURN 1D - exp(-x / nullif(mean, 0D))",
    f"erf_part(a DOUBLE) RETURNS DOUBLE RETURN exp(-a * a) / sqrt(pi()) * CASE WHEN a < {SERIES_END}D THEN {_SERIES} ELSE 0.5D / {_FRACTION} END",
    f"""standard_cdf(z DOUBLE, part DOUBLE) RETURNS DOUBLE RETURN CASE WHEN abs(z) < {SERIES_END}D THEN 0.5D + signum(z) * part WHEN z > 0 THEN 1D - part ELSE part END""",
    "normal_cdf(x DOUBLE, mean DOUBLE, std DOUBLE) RETURNS DOUBLE RETURN standard_cdf((x - mean) / nullif(std, 0D) / sqrt(2D), erf_part(abs((x - mean) / nullif(std, 0D) / sqrt(2D))))",
    _table("w3c_log", _W3C, "split(line, '\\\\s+')"),
    _table("ncsa_log", _NCSA, "quoted_fields(line)"),
]


def register(spark: SparkSession) -> list[str]:
    """Defines the functions in the session, and tells their names."""
    for definition in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")
    return [definition.partition("(")[0] for definition in FUNCTIONS]
