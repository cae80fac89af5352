"""Histograms of a value by class, the class that a value speaks for, and a logistic model of it."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values of a range that one row lists.
STRETCH = 10_000


def class_counts(df: DataFrame, cls: str = "class", value: str = "value") -> DataFrame:
    """class, value, count, and the totals of classes as rows without a value: one pass, one shuffle."""
    known = df.where(F.col(cls).isNotNull() & F.col(value).isNotNull()).select(F.col(cls).alias("class"), F.col(value).alias("value"))
    return known.groupingSets([["class", "value"], ["class"]], "class", "value").agg(F.count(F.lit(1)).alias("count"))


def class_posterior(counts: DataFrame, positive: int = 1) -> DataFrame:
    """value, n0, n1, posterior: how likely class `positive` is for each whole value between the least and the greatest.

    By Bayes' rule from class-conditional shares and class totals; a value missing from a class has count 0 there,
    and one that is in neither has no posterior.
    """
    detail = counts.where("value is not null")
    hit = F.col("class") == positive
    totals = counts.where("value is null").agg(F.sum(F.when(~hit, F.col("count"))).alias("t0"), F.sum(F.when(hit, F.col("count"))).alias("t1"))
    per_value = detail.groupBy("value").agg(F.coalesce(F.sum(F.when(~hit, F.col("count"))), F.lit(0)).alias("n0"), F.coalesce(F.sum(F.when(hit, F.col("count"))), F.lit(0)).alias("n1"))
    span = per_value.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).where("lo is not null")
    # In two steps, so that no row holds a whole range however wide it is.
    kind = counts.schema["value"].dataType
    begins = span.select("hi", F.explode(F.sequence(F.col("lo").cast("long"), F.col("hi").cast("long"), F.lit(STRETCH))).alias("begin")).repartition("begin")
    every = begins.select(F.explode(F.sequence("begin", F.least(F.col("begin") + (STRETCH - 1), F.col("hi").cast("long")))).alias("value")).select(F.col("value").cast(kind))
    filled = every.join(per_value, "value", "left").crossJoin(F.broadcast(totals))
    n0, n1 = F.coalesce("n0", F.lit(0)), F.coalesce("n1", F.lit(0))
    all_ = F.col("t0") + F.col("t1")
    h0 = F.coalesce(F.try_divide(n0, F.col("t0")) * F.try_divide(F.col("t0"), all_), F.lit(0.0))
    h1 = F.coalesce(F.try_divide(n1, F.col("t1")) * F.try_divide(F.col("t1"), all_), F.lit(0.0))
    return filled.select("value", n0.alias("n0"), n1.alias("n1"), F.try_divide(h1, h0 + h1).alias("posterior"))


def _score(weights: list[float], features: list[str]) -> Column:
    """The linear score of a row."""
    return sum((F.lit(w) * F.col(f).cast("double") for w, f in zip(weights[1:], features)), F.lit(float(weights[0])))


def logit_fit(rows: DataFrame, features: list[str], label: str = "class", ridge: float = 0.0, steps: int = 50, tolerance: float = 1e-12) -> DataFrame:
    """term, weight of a logistic regression of `label` (0 or 1): the intercept and each feature.

    Newton steps: the gradient and the Gram matrix of a step are sums over all rows, one aggregate
    without a shuffle of rows; (features + 1)^2 numbers reach the driver. A step is halved until the likelihood does not
    fall. Rows with a null label or feature are left out. Classes that the features part have no finite
    fit without a ridge; steps then end after `steps`.
    """
    known = rows.select(*[F.col(c).cast("double").alias(c) for c in (*features, label)]).dropna()
    terms, y = [F.lit(1.0), *map(F.col, features)], F.col(label)
    size = len(terms)

    def sums(weights: list[float]) -> tuple[float, np.ndarray, np.ndarray]:
        score = _score(weights, features)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
        # log(1 + exp(s)) without overflow.
        loss = F.greatest(score, F.lit(0.0)) + F.log1p(F.exp(-F.abs(score))) - y * score
        scored = known.select("*", p.alias("__p"), loss.alias("__loss"))
        slope = F.col("__p") * (F.lit(1.0) - F.col("__p"))
        asked = [F.sum("__loss"), *[F.sum((y - F.col("__p")) * t) for t in terms], *[F.sum(slope * terms[i] * terms[j]) for i in range(size) for j in range(i, size)]]
        found = [v or 0.0 for v in scored.agg(*[a.alias(f"s{k}") for k, a in enumerate(asked)]).first()]
        weight = np.array(weights)
        held = np.diag([0.0, *[ridge] * (size - 1)])
        gram = np.zeros((size, size))
        gram[np.triu_indices(size)] = found[1 + size :]
        gram = gram + np.triu(gram, 1).T + held
        return found[0] + weight @ held @ weight / 2, np.array(found[1 : 1 + size]) - held @ weight, gram

    weights = [0.0] * size
    loss, gradient, gram = sums(weights)
    for _ in range(steps):
        step = np.linalg.lstsq(gram, gradient, rcond=None)[0]
        for halved in range(30):
            moved = [w + float(d) / 2**halved for w, d in zip(weights, step)]
            then = sums(moved)
            if math.isfinite(then[0]) and then[0] <= loss + 1e-12 * abs(loss):
                break
        weights, (loss, gradient, gram) = moved, then
        if max(map(abs, step)) <= tolerance * max(1.0, *map(abs, weights)):
            break
    return rows.sparkSession.createDataFrame(list(zip(["(intercept)", *features], map(float, weights))), "term string, weight double")


def logit_score(rows: DataFrame, fitted: DataFrame, features: list[str], name: str = "probability") -> DataFrame:
    """`rows` with the probability of class 1 under the weights of `logit_fit`; null where a feature is."""
    weights = dict(map(tuple, fitted.collect()))
    return rows.withColumn(name, F.lit(1.0) / (F.lit(1.0) + F.exp(-_score([weights["(intercept)"], *[weights[f] for f in features]], features))))
