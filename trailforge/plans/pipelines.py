"""Operators composed into the usual jobs; each is one lazy DataFrame with no files in between."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailforge.functions import scalars as S
from trailforge.operators import classify, customer, engagement, search, sessions
from trailforge.operators.customer import TRANSACTIONS, Transactions
from trailforge.operators.sessions import CLICKS, Clicks

#: Percent of gap, recency and value in the lifetime value.
VALUE_WEIGHTS = {"av_time_gap": 30, "recency": 25, "av_value": 45}


def web_analytics(clicks: DataFrame, flow: list[str], c: Clicks = CLICKS) -> DataFrame:
    """Users over their sessions, from clicks."""
    return sessions.user_session_summary(sessions.session_summary(clicks, flow, c))


def implicit_ratings(clicks: DataFrame, found: list[engagement.Pattern], mapping: list[tuple[int, int]], c: Clicks = CLICKS) -> DataFrame:
    """Ratings of items by users, from clicks."""
    return engagement.ratings(engagement.engagement_events(clicks, found, c), mapping)


def lifetime_value(transactions: DataFrame, reference: Column, columns: Transactions = TRANSACTIONS, unit: str = "day", recency_count: int = 2, distribution: str = "normal") -> DataFrame:
    """id and score: recency, frequency and value, the recency scored, all put on 0 to 100 and averaged by weight."""
    if distribution not in customer.GAP_STATS:
        raise ValueError("the distribution is normal or exponential")
    scored = customer.rfm(transactions, reference, unit, recency_count, c=columns)
    # All statistics in one pass: the longest recency has the least probability of a longer gap, and the shortest the greatest.
    stats = customer.rfm_stats(scored, F.min("recency").alias("min_recency"), F.max("recency").alias("max_recency"))
    longer = lambda c: customer.longer_gap(F.col(c), distribution)
    bounds = {"av_time_gap": ("min_av_time_gap", "max_av_time_gap"), "av_value": ("min_av_value", "max_av_value")}
    known = stats.select(
        *customer.GAP_STATS[distribution], longer("max_recency").alias("__lo_recency"), longer("min_recency").alias("__hi_recency"),
        *[F.col(x).cast("double").alias(f"__{n}_{c}") for c, pair in bounds.items() for n, x in zip(("lo", "hi"), pair)],
    )
    likely = scored.crossJoin(F.broadcast(known)).withColumn("recency", longer("recency"))
    return customer.weighted_average(customer.scaled(likely, list(VALUE_WEIGHTS), inverted=("av_time_gap",)), VALUE_WEIGHTS)


def lifecycles(visits: DataFrame, start: Column, end: Column, mode: str = "complete", z: float = 3.0, columns: Transactions = TRANSACTIONS, use_horizon: bool = True) -> DataFrame:
    """Lifecycles of ids from their visits; visits further apart than the mean gap plus z deviations part them."""
    runs = customer.clusters(visits, customer.min_gap(visits, z, columns), start, end, columns)
    return customer.lifecycles(runs, mode, start, end, use_horizon)


def retention_rate(visits: DataFrame, start: Column, end: Column, unit: str = "month", z: float = 3.0, columns: Transactions = TRANSACTIONS) -> DataFrame:
    return customer.retention(lifecycles(visits, start, end, "complete", z, columns), unit)


def conversion_classifier(rows: DataFrame, cls: str = "class", value: str = "value") -> DataFrame:
    return classify.class_posterior(classify.class_counts(rows, cls, value))


def search_quality(scores: DataFrame, clicks: DataFrame, regularizer: str = "none", precision: int = 3) -> DataFrame:
    return search.ndcg(scores, search.relevance(clicks), regularizer, precision)


def batch_visits(clicks: DataFrame, page_regex: str, logout: str, timeout_s: int, c: Clicks = CLICKS) -> DataFrame:
    """session_id, visit, page_id, depth, end_ms: the batch twin of the streaming visit operator.

    A visit ends with a page whose URL holds `logout`, or when the next page comes more than the
    timeout later; its page is the latest that matches; visits without one are left out.
    """
    w = Window.partitionBy(c.session).orderBy(*c.order)
    ms, url = S.epoch_ms(F.col(c.ts)), F.col(c.url)
    opens = F.lag(ms).over(w).isNull() | (ms - F.lag(ms).over(w) > timeout_s * 1000) | F.lag(url).over(w).contains(logout)
    page = S.group(url, page_regex)
    numbered = c.known(clicks).select(
        F.col(c.session).alias("session_id"), ms.alias("ms"), F.col(c.tie).alias("tie"), page.alias("page"), F.when(opens, 1).otherwise(0).alias("opens")
    )
    so_far = Window.partitionBy("session_id").orderBy("ms", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        numbered.withColumn("visit", F.sum("opens").over(so_far).cast("int"))
        .groupBy("session_id", "visit")
        .agg(F.max_by("page", F.when(F.col("page").isNotNull(), F.struct("ms", "tie"))).alias("page_id"), F.count(F.lit(1)).alias("depth"), F.max("ms").alias("end_ms"))
        .where("page_id is not null")
    )


def depth_stats(visits: DataFrame, window: int, least: int | None = None) -> DataFrame:
    """page_id, bounce_rate, depth_distr, av_depth over the latest `window` visits of each page that has at least `least` of them.

    The batch twin of the streaming reservoir keeps the latest visits instead of a biased sample.
    """
    least = window * 3 // 4 if least is None else least
    latest = Window.partitionBy("page_id").orderBy(F.desc("end_ms"), F.desc("session_id"), F.desc("visit"))
    kept = visits.withColumn("__r", F.row_number().over(latest)).where(F.col("__r") <= window)
    # At most `window` depths for each page are collected.
    depths = kept.groupBy("page_id").agg(F.collect_list("depth").alias("d")).where(F.size("d") >= least)
    return depths.select("page_id", *[f.alias(n) for n, f in depth_columns(F.col("d")).items()])


def biased_depth_stats(visits: DataFrame, window: int, least: int | None = None) -> DataFrame:
    """page_id, bounce_rate, depth_distr, av_depth over the biased sample that the stream keeps: each visit takes one of `window` slots by hash, the latest stays.

    A latest row is a maximum, so partial samples merge and no page's visits meet in one task.
    """
    least = window * 3 // 4 if least is None else least
    order = F.struct("end_ms", F.col("session_id").cast("string"), "depth")
    slots = visits.groupBy("page_id", S.sample_slot(window, "session_id", "end_ms").alias("slot")).agg(F.max_by("depth", order).alias("depth"))
    depths = slots.groupBy("page_id").agg(F.collect_list("depth").alias("d")).where(F.size("d") >= least)
    return depths.select("page_id", *[f.alias(n) for n, f in depth_columns(F.col("d")).items()])


def depth_columns(d: Column) -> dict[str, Column]:
    """The three statistics of an array of depths."""
    n = F.size(d)
    distinct = F.array_sort(F.array_distinct(d))
    return {
        "bounce_rate": S.int_div(F.size(F.filter(d, lambda x: x == 1)) * 100, n),
        "depth_distr": F.array_join(F.transform(distinct, lambda k: F.concat(k.cast("string"), F.lit(":"), F.size(F.filter(d, lambda x: x == k)).cast("string"))), ","),
        "av_depth": F.floor(F.aggregate(d, F.lit(0).cast("long"), lambda a, x: a + x) / n + 0.5),
    }


def unique_counts(df: DataFrame, part: str, user: str, bits: int = 12, least: int = 0) -> DataFrame:
    """For each part with more than `least` rows the estimated users; in the row 'all' the sum of them and, beside it, the estimate of the union."""
    sketched = df.groupBy(F.col(part).cast("string").alias("part")).agg(F.hll_sketch_agg(user, F.lit(bits)).alias("s"), F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    each = sketched.select("part", F.hll_sketch_estimate("s").alias("users"), F.lit(None).cast("long").alias("union_users"))
    total = sketched.agg(F.sum(F.hll_sketch_estimate("s")).alias("users"), F.hll_sketch_estimate(F.hll_union_agg("s")).alias("union_users"))
    return each.unionByName(total.select(F.lit("all").alias("part"), "users", "union_users"))
