"""Scalar helpers over columns; all of them are built-in expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Milliseconds of each unit.
UNIT_MS = {"ms": 1, "sec": 1_000, "min": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}
#: Fixed values of an older release, kept for parity runs: an hour there was 60 * 1000 * 1000 ms.
LEGACY_UNIT_MS = UNIT_MS | {"hour": 60_000_000, "day": 1_440_000_000}


def unit_ms(unit: str, legacy: bool = False) -> int:
    known = LEGACY_UNIT_MS if legacy else UNIT_MS
    if unit not in known:
        raise ValueError(f"unknown unit {unit!r}; one of {sorted(known)}")
    return known[unit]


def int_div(a: Column, b: Column | int) -> Column:
    """Integer division that truncates toward zero; null where the divisor is 0 or null."""
    b = b if isinstance(b, Column) else F.lit(b)
    a, b = a.cast("long"), F.nullif(b.cast("long"), F.lit(0).cast("long"))
    return F.call_function("div", a, b)


def to_unit(ms: Column, unit: str, legacy: bool = False) -> Column:
    return int_div(ms, unit_ms(unit, legacy))


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def split_tokens(text: Column, regex: str) -> Column:
    """Parts between matches, trimmed."""
    return F.transform(F.split(text, regex), lambda t: F.trim(t))


def join_tokens(tokens: Column, sep: str) -> Column:
    return F.array_join(tokens, sep)


def sublist(tokens: Column, begin: int, end: int) -> Column:
    """Items begin (0-based) up to but without end; empty where that range does not exist."""
    good = (F.lit(begin) >= 0) & (F.lit(end) <= F.size(tokens)) & F.lit(begin < end)
    return F.when(good, F.slice(tokens, max(begin, 0) + 1, max(end - begin, 0))).otherwise(F.slice(tokens, 1, 0))


def pick(tokens: Column, places: Sequence[int]) -> Column:
    """Items at the given 0-based places; an error where one is missing."""
    return F.array(*[F.element_at(tokens, p + 1) for p in places])


def group(text: Column, regex: str, n: int = 1) -> Column:
    """Group n of the first match, null without a match."""
    return F.when(text.rlike(regex), F.regexp_extract(text, regex, n))


def whole(text: Column, regex: str) -> Column:
    """Whether the whole text matches."""
    return text.rlike(f"^(?:{regex})$")


def pad_number(value: Column, width: int) -> Column:
    """Zero-padded on the left; longer numbers are not cut."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def fixed(value: Column, precision: int) -> Column:
    return F.round(value, precision)


def cookie_value(cookie: Column, name: str, separator: str = r";\+") -> Column:
    """Text after the first = of the last item whose name starts with `name`; null if there is none."""
    items = F.filter(F.split(cookie, separator), lambda item: item.startswith(name))
    last = F.get(items, F.size(items) - 1)
    return F.when(F.locate("=", last) > 0, F.substr(last, F.locate("=", last) + 1))


def str_map(text: Column, pair_sep: str = ",", value_sep: str = ":") -> Column:
    return F.str_to_map(text, F.lit(pair_sep), F.lit(value_sep))


def map_str(value: Column, pair_sep: str = ",", value_sep: str = ":") -> Column:
    """k:v pairs in the order of keys."""
    entries = F.array_sort(F.map_entries(value))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"].cast("string"), F.lit(value_sep), e["value"].cast("string"))), pair_sep)


def quoted_fields(text: Column, n: int) -> Column:
    """The first n fields between blanks, where "..." and [...] hold blanks; without their quotes, null past the end."""
    raw = F.regexp_extract_all(text, F.lit(r'"([^"]*)"|\[([^\]]*)\]|(\S+)'), F.lit(0))
    bare = F.transform(raw, lambda f: F.regexp_replace(f, r'^["\[]|["\]]$', ""))
    return F.array(*[F.get(bare, i) for i in range(n)])


def year_month0_day(ts: Column) -> tuple[Column, Column, Column]:
    """Year, month from 0, day of the month."""
    return F.year(ts), F.month(ts) - 1, F.dayofmonth(ts)


def sample_slot(size: int, *parts: str) -> Column:
    """The slot of 0 to size - 1 that a row takes in a sample, by a hash of its parts."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(p).cast("string") for p in parts])), 1, 15), 16, 10).cast("long"), F.lit(size).cast("long"))


def exponential_cdf(x: Column, mean: Column | float) -> Column:
    mean = mean if isinstance(mean, Column) else F.lit(float(mean))
    return F.lit(1.0) - F.exp(-x.cast("double") / F.nullif(mean.cast("double"), F.lit(0.0)))


#: Terms of the error function's series, and of the continued fraction that takes its place from SERIES_END on.
ERF_TERMS, SERIES_END = 70, 2.5


def normal_cdf(x: Column, mean: Column | float, std: Column | float) -> Column:
    """The normal distribution function in built-in expressions, to double precision (1e-14).

    Near the mean by the series of positive terms x * (2 x^2)^n / (1 * 3 * ... * (2n + 1)), in the tails by
    the continued fraction of the complementary error function.
    """
    mean, std = (c if isinstance(c, Column) else F.lit(float(c)) for c in (mean, std))
    z = (x.cast("double") - mean) / F.nullif(std.cast("double"), F.lit(0.0)) / math.sqrt(2)
    a = F.abs(z)
    terms = F.sequence(F.lit(1), F.lit(ERF_TERMS))

    def add(s: Column, n: Column) -> Column:
        term = s["term"] * (a * a * 2.0) / (n * 2 + 1)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    series = F.aggregate(terms, F.struct(a.alias("term"), a.alias("sum")), add, lambda s: s["sum"])
    fraction = F.aggregate(F.reverse(terms), a, lambda f, k: a + k / 2.0 / f)
    shape = F.exp(-a * a) / math.sqrt(math.pi)
    inside = shape * series
    outside = shape / fraction / 2
    return F.when(a < SERIES_END, F.when(z >= 0, F.lit(0.5) + inside).otherwise(F.lit(0.5) - inside)).when(z > 0, F.lit(1.0) - outside).otherwise(outside)
