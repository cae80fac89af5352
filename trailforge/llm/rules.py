"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger keeps the measurements and one
bit for each rule that failed; a policy is a versioned mask of the bits that reject. A
verdict, and what a policy would do without one of its rules, are then bit operations on
the ledger, and no text is read again.

Defined cases: a null text is empty; an empty text has no words and fails the rule on
length; repeated rows get a row each; other columns stay out of the measuring and of the
result; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.llm import kernel

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rule:
    """Fails a document where `failed`, a SQL condition on the measurements, holds."""

    bit: int
    name: str
    failed: str


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 25 * n_words"),
    Rule(6, "some_symbols", "100 * n_symbols > n_words"),
)
BASE = Policy("base", ("few_words", "repeated_windows"))
STANDARD = Policy("standard-1", ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words"))
STRICT = Policy("strict-1", tuple(r.name for r in RULES))


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[name] for name in set(policy.rules))


def measure_batch(column: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of each text of a batch."""
    parts = []
    for _, _, data, offsets in kernel.texts(column):
        n = len(offsets) - 1
        begin, end, word_at = kernel.words(data, offsets)
        wordy = ~kernel.SPACE[data]
        hashes = kernel.span_hashes(data, begin, end)
        grams, of, at = kernel.windows(hashes, word_at, 3)
        repeated = at[_again(grams, of)]
        covered = np.zeros(len(begin), bool)
        for k in range(3):
            covered[repeated + k] = True
        line_begin, line_end, line_at = kernel.lines(data, offsets)
        full = np.searchsorted(begin, line_end) > np.searchsorted(begin, line_begin)
        line_of = np.repeat(np.arange(n), np.diff(line_at))[full]
        line_keys = kernel.mix(kernel.span_hashes(data, line_begin[full], line_end[full]) + kernel.stream(line_of, 5))
        _, where = np.unique(line_keys, return_index=True)
        parts.append(
            (
                np.diff(word_at),
                kernel.sums(wordy & ((data & 0xC0) != 0x80), offsets),
                kernel.sums(_SYMBOL[data], offsets),
                kernel.counts(line_of, n) - kernel.counts(line_of[where], n),
                kernel.sums(covered, word_at),
                kernel.counts(line_of, n),
            )
        )
    return {name: np.concatenate([p[i] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64) for i, name in enumerate(MEASURES)}


def _again(grams: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which windows occur twice or more in their text."""
    if not len(grams):
        return np.zeros(0, bool)
    _, back, count = np.unique(kernel.mix(grams + kernel.stream(of, 3)), return_inverse=True, return_counts=True)
    return count[back] > 1


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = measure_batch(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(found[m]) for m in MEASURES]], names=["id", *MEASURES])


def ledger(df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key, the measurements and `fail_bits` of every row. One narrow stage; texts are never moved."""
    kind = df.schema[key].dataType.simpleString()
    found = df.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _measure, f"id {kind}, " + ", ".join(f"{m} long" for m in MEASURES)
    )
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.failed), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return found.select(F.col("id").alias(key), *MEASURES).withColumn("fail_bits", bits)


def kept(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """The verdict of a policy on a row of the ledger."""
    return F.col("fail_bits").bitwiseAND(mask(policy, rules)) == 0


def apply_policy(entries: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    return entries.withColumn("policy", F.lit(policy.version)).withColumn("kept", kept(policy, rules))


def ablations(entries: DataFrame, policies: tuple[Policy, ...] = (BASE, STANDARD, STRICT), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each policy and each of its rules: documents, kept, kept without the rule, and rejected by the rule alone.

    The ledger is first counted by its bits (2**rules rows at most); all the rest is arithmetic on that.
    """
    by_bits = entries.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    bit = {r.name: 1 << r.bit for r in rules}
    cases = [
        F.struct(F.lit(p.version).alias("policy"), F.lit(name).alias("rule"), F.lit(mask(p, rules)).cast("long").alias("mask"), F.lit(bit[name]).cast("long").alias("bit"))
        for p in policies
        for name in p.rules
    ]
    return (
        by_bits.select("fail_bits", "n", F.explode(F.array(*cases)).alias("c"))
        .groupBy("c.policy", "c.rule")
        .agg(
            F.sum("n").alias("documents"),
            F.sum(F.expr("if(fail_bits & c.mask = 0, n, 0)")).alias("kept"),
            F.sum(F.expr("if(fail_bits & c.mask & ~c.bit = 0, n, 0)")).alias("kept_without"),
            F.sum(F.expr("if(fail_bits & c.mask = c.bit, n, 0)")).alias("only_by_rule"),
        )
    )
