"""Many patterns over many texts: a text is tried on the patterns alone whose literal it holds.

Every match of a regex holds its longest literal run. Each pattern is filed under one piece of GRAM
characters of that run, the one that fewest patterns have; a text's pieces are joined to the
files, which are broadcast (they are as many as there are patterns), and only then is the regex tried.
Patterns without such a run, and those that cannot be read, are tried on every text. No row is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from re import _constants as K, _parser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a piece, and patterns up to which each is tried on every text.
GRAM, FEW = 4, 16


def required(regex: str) -> str:
    """The longest run of characters that every match of a regex holds; empty where none is sure."""
    try:
        parsed = _parser.parse(regex)
    except (re.error, OverflowError, RecursionError):
        return ""
    if parsed.state.flags & (re.IGNORECASE | re.VERBOSE):
        return ""
    runs = [""]

    def walk(items) -> None:
        for kind, what in items:
            if kind is K.LITERAL:
                runs[-1] += chr(what)
            elif kind is K.SUBPATTERN and not what[1] and not what[2]:
                walk(what[3])
            elif kind in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT) and what[0] > 0:
                # What is repeated occurs once at least, but what follows need not stand beside it.
                runs.append("")
                walk(what[2])
                runs.append("")
            elif kind is not K.AT:
                runs.append("")

    walk(parsed)
    return max(runs, key=len)


def filed(regexes: list[str]) -> list[str]:
    """The piece that each regex is filed under; empty for those that every text is tried on."""
    pieces = [[run[i : i + GRAM] for i in range(len(run) - GRAM + 1)] for run in map(required, regexes)]
    often = Counter(p for own in pieces for p in set(own))
    return [min(reversed(own), key=lambda p: often[p], default="") for own in pieces]


def matches(texts: DataFrame, text: str, patterns: list[dict[str, object]], whole: bool = False, few: int = FEW) -> DataFrame:
    """A row for each text and each of `patterns` that is found in it (as a whole with `whole`): the columns of `texts` and the fields of the pattern.

    Every pattern has the field `regex` and the same other fields, which are numbers (long) or text.
    """
    sought = lambda regex: f"^(?:{regex})$" if whole else regex
    kinds = {n: "bigint" if isinstance(v, int) else "string" for n, v in patterns[0].items()}
    if len(patterns) <= few:
        each = [F.when(F.col(text).rlike(sought(str(p["regex"]))), F.struct(*[F.lit(v).cast(kinds[n]).alias(n) for n, v in p.items()])) for p in patterns]
        return texts.select("*", F.inline(F.array_compact(F.array(*each))))
    rows = [(piece, sought(str(p["regex"])), *p.values()) for piece, p in zip(filed([str(p["regex"]) for p in patterns]), patterns)]
    files = texts.sparkSession.createDataFrame(rows, f"__piece string, __regex string, {', '.join(f'{n} {k}' for n, k in kinds.items())}")
    last = F.char_length(text) - GRAM + 1
    cut = F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(F.col(text), i, F.lit(GRAM)))).otherwise(F.array())
    pieces = F.array_distinct(F.concat(F.array(F.lit("")), cut))
    tried = texts.where(F.col(text).isNotNull()).select("*", F.explode(pieces).alias("__piece")).join(F.broadcast(files), "__piece")
    return tried.where(F.regexp_like(text, F.col("__regex"))).drop("__piece", "__regex")
