"""Mixing sources by temperature, realised as budgeted block permutations.

The weight of a source is its token share to the power alpha, normalised. Alpha is bisected
between 0 (all sources alike) and 1 (as they are): the least alpha that keeps repetition
under a limit, or the greatest whose weights reach a target entropy. Each source then gets
its weight of the token budget: whole passes over its documents, and a last pass that stops
where the budget ends. A pass visits the source's blocks in an order drawn for that pass, and
the documents of a block likewise; the block in which the budget ends is cut at a document.

Without a budget, the least one is taken that gives every source a whole pass, so mixing
repeats documents and leaves none out. With a smaller budget documents are left out: that is
what it is for.

A document's passes are decided by its own hashes and one row for its source, so texts stay
where they are. Tokens are words of non-white-space.

Defined cases: a null source is the source ''; a null or empty text has no tokens, takes no
budget, and goes once with each whole pass; sources without a token go once; rows that repeat
a doc_id are visited together; a null doc_id hashes as ''; other columns pass through, but
those named like a result column give way to it; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailforge.llm import common

BLOCKS = 256
#: Parts of a block's order that are summed apart before rows are.
RANGES = 4096
REPEATS = 2.0
STEPS = 50
SEED = "mix"
#: A table of sources up to this size is broadcast and its token counts are held by the driver; a larger one is joined and summed by Spark.
SOURCES = 100_000
_HASH_RANGE = float(16**15)


def hash60(*parts: Column | str) -> Column:
    """The first 60 bits of the MD5 of the parts, joined by bars."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


class Shares:
    """Sums over sources of functions of their token counts: in the driver for a bounded number of sources, else by Spark."""

    def __init__(self, sizes: DataFrame) -> None:
        self.sizes = sizes.where("tokens > 0")
        self.many = self.sizes.limit(SOURCES + 1).count() > SOURCES
        self.tokens = [] if self.many else sorted(r[0] for r in self.sizes.select("tokens").collect())
        top = self.sizes.agg(F.sum("tokens"), F.max("tokens"), F.min("tokens")).first()
        self.total, self.most, self.least = (x or 0 for x in top)

    def powers(self, alpha: float) -> tuple[float, float]:
        """Sum of p**alpha and of p**alpha * ln p over the shares p."""
        if self.many:
            p = F.col("tokens") / F.lit(float(self.total))
            # Decimals, so that the sum does not hang on the order of rows.
            exact = lambda x: F.sum(x.cast("decimal(38,24)"))
            return tuple(map(float, self.sizes.agg(exact(F.pow(p, F.lit(alpha))), exact(F.pow(p, F.lit(alpha)) * F.log(p))).first()))
        shares = [t / self.total for t in self.tokens]
        return math.fsum(p**alpha for p in shares), math.fsum(p**alpha * math.log(p) for p in shares)

    def entropy(self, alpha: float) -> float:
        z, zl = self.powers(alpha)
        return math.log(z) - alpha * zl / z

    def repeats(self, alpha: float, budget: int | None) -> float:
        """Passes over the source that is repeated most."""
        if budget is None:
            return (self.least / self.most) ** (alpha - 1)
        z, _ = self.powers(alpha)
        return max((t / self.total) ** (alpha - 1) / z * budget / self.total for t in (self.least, self.most))


def exponent(shares: Shares, repeats: float | None = REPEATS, entropy: float | None = None, budget: int | None = None) -> float:
    """The alpha in [0, 1] nearest to 0 whose repetition stays within `repeats`, or nearest to 1 whose entropy reaches `entropy` (nats)."""
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        mid = (low + high) / 2
        if entropy is not None:
            low, high = (mid, high) if shares.entropy(mid) >= entropy else (low, mid)
        else:
            low, high = (low, mid) if shares.repeats(mid, budget) <= repeats else (mid, high)
    return low if entropy is not None else high


def _named(df: DataFrame, key: str, source: str, text: str) -> DataFrame:
    return df.withColumns(
        {"__source": F.coalesce(F.col(source).cast("string"), F.lit("")), "__id": F.coalesce(F.col(key).cast("string"), F.lit("")), "__tokens": n_tokens(F.col(text))}
    )


def _block() -> Column:
    return F.pmod(hash60(SEED, "block", F.col("__id")), F.lit(BLOCKS)).cast("int")


def _block_order(epoch: Column, block: Column) -> Column:
    return hash60(SEED, F.col("__source"), epoch, block)


def _doc_order(epoch: Column) -> Column:
    return hash60(SEED, "doc", epoch, F.col("__id"))


def plan(named: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """One row for each source: tokens, documents, weight, budget, whole passes, and where the last pass ends.

    `edge` is the order of the block in which the last pass ends, `cut` the order of its last document there.
    """
    rows = common.stored(named.select("__source", "__id", "__tokens").withColumn("block", _block()), "mix")
    per_block = common.stored(rows.groupBy("__source", "block").agg(F.sum("__tokens").alias("tokens"), F.count(F.lit(1)).alias("documents")), "blocks")
    sizes = common.stored(per_block.groupBy("__source").agg(F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents")), "sources")
    shares = Shares(sizes)
    if not shares.total:
        alpha, z, total = 1.0, 1.0, 0
    else:
        alpha = exponent(shares, repeats, entropy, budget)
        z = shares.powers(alpha)[0]
        total = budget if budget is not None else math.ceil(shares.most / ((shares.most / shares.total) ** alpha / z))
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(shares.total or 1)), F.lit(alpha)) / F.lit(z)).otherwise(0.0)
    per_source = sizes.withColumn("weight", weight).withColumn("budget", F.floor(F.col("weight") * F.lit(float(total)) + 0.5).cast("long"))
    # The weights' rounding must not cost the largest source a token of its whole pass.
    least = F.when(F.lit(budget is None), F.greatest("budget", "tokens")).otherwise(F.col("budget"))
    per_source = (
        per_source.withColumn("budget", least)
        .withColumn("passes", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(1).cast("long"))
        .withColumn("rest", F.col("budget") - F.col("passes") * F.col("tokens"))
    )
    per_source = common.stored(per_source, "plan")
    before = Window.partitionBy("__source").orderBy("order", "block").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        _met(per_block.drop("documents"), per_source.where("rest > 0").select("__source", "passes", "rest"))
        .withColumn("order", _block_order(F.col("passes"), F.col("block")))
        .withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
        .where("before <= rest and rest < before + tokens")
        .select("__source", "block", "passes", F.col("order").alias("edge"), (F.col("rest") - F.col("before")).alias("left"))
    )
    edges = common.stored(edges, "edges")
    # The cut block in RANGES of the order: whole ranges by their sums, and rows of the one in which the pass ends.
    inside = _met(rows, edges, ["__source", "block"]).withColumn("doc_order", _doc_order(F.col("passes")))
    inside = inside.select("__source", "__tokens", "left", "doc_order", F.floor(F.col("doc_order") / (1 << 60) * RANGES).cast("int").alias("range"))
    ranged = inside.groupBy("__source", "range").agg(F.sum("__tokens").alias("tokens"), F.max("doc_order").alias("top"), F.first("left").alias("left"))
    earlier = Window.partitionBy("__source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranged = common.stored(ranged.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))), "ranges")
    last = ranged.where("before <= left and left < before + tokens").select("__source", "range", "before")
    so_far = Window.partitionBy("__source").orderBy("doc_order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    partial = _met(inside, last, ["__source", "range"]).withColumn("used", F.col("before") + F.sum("__tokens").over(so_far)).where("used <= left")
    cuts = partial.select("__source", F.col("doc_order").alias("top")).union(ranged.where("before + tokens <= left").select("__source", "top")).groupBy("__source").agg(F.max("top").alias("cut"))
    return common.stored(
        per_source.join(edges.select("__source", "edge"), "__source", "left")
        .join(cuts, "__source", "left")
        .withColumns({"edge": F.coalesce("edge", F.lit(-1)), "cut": F.coalesce("cut", F.lit(-1)), "alpha": F.lit(alpha)}),
        "plan",
    )


def _met(left: DataFrame, sources: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """`left` with the row of its source: broadcast after a count, or joined with the heaviest sources apart."""
    keys = keys or ["__source"]
    if sources.limit(SOURCES + 1).count() <= SOURCES:
        return left.join(F.broadcast(sources), keys)
    weights = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return common.hot_join(left, common.weighed(sources.join(weights, keys), "weights", "__n"), keys, "__n").drop("__n")


def mix(
    df: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, budget: int | None = None, key: str = "doc_id", source: str = "source", text: str = "text", prefix: str = ""
) -> DataFrame:
    """The rows of `df`, each as often as it is visited, with tokens, epoch, block, doc_order and progress, their names after `prefix`.

    Rows in the order of progress, epoch, block and doc_order are the mixture: progress is the
    share of its source's budget that was used before the row's block.
    """
    # Columns of `df` go by number on the way, so that none is taken for one of the steps below.
    named = _named(df.select(*[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(df.columns)]), *[f"__{df.columns.index(c)}" for c in (key, source, text)])
    chosen = plan(named, repeats, entropy, budget).select(
        "__source", *[F.col(c).alias(f"__{c}") for c in ("passes", "edge", "cut", "budget")], F.col("tokens").alias("__all")
    )
    last = F.col("__passes")
    order = _block_order(last, _block())
    more = (order < F.col("__edge")) | ((order == F.col("__edge")) & (_doc_order(last) <= F.col("__cut")))
    visits = last + F.when((F.col("__edge") >= 0) & (F.col("__tokens") > 0) & more, 1).otherwise(0)
    passes = F.when(F.col("__all") > 0, F.col("__budget") / F.col("__all")).otherwise(1.0)
    none = F.array().cast("array<bigint>")
    drawn = _met(named, chosen).withColumn("__epoch", F.explode(F.when(visits > 0, F.sequence(F.lit(0).cast("long"), visits - 1)).otherwise(none)))
    epoch = F.col("__epoch")
    made = {
        "tokens": F.col("__tokens"),
        "epoch": epoch,
        "block": _block(),
        "doc_order": _doc_order(epoch),
        "progress": (epoch + _block_order(epoch, _block()) / F.lit(_HASH_RANGE)) / passes,
    }
    made = {prefix + name: value for name, value in made.items()}
    kept = [F.col(f"__{i}").alias(c) for i, c in enumerate(df.columns) if c.lower() not in made]
    return drawn.select(*kept, *[value.alias(name) for name, value in made.items()])
