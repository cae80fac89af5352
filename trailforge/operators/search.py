"""Search quality: relevance from clicks, and normalised discounted cumulative gain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REGULARIZERS = ("none", "logNatural", "logTen")


def relevance(clicks: DataFrame, query: str = "query_id", doc: str = "doc_id", value: str = "relevance") -> DataFrame:
    """query_id, doc_id and their summed relevance."""
    return clicks.groupBy(F.col(query).alias("query_id"), F.col(doc).alias("doc_id")).agg(F.sum(value).cast("double").alias("relevance"))


def regularized(rel: Column, how: str) -> Column:
    """Relevance, or its logarithm (0 up to relevance 1)."""
    if how not in REGULARIZERS:
        raise ValueError(f"the regularizer is one of {REGULARIZERS}")
    if how == "none":
        return rel
    log = F.log(rel) if how == "logNatural" else F.log10(rel)
    return F.when(rel > 1, log).otherwise(0.0)


def ndcg(scores: DataFrame, rel: DataFrame, regularizer: str = "none", precision: int | None = 3) -> DataFrame:
    """query_id, ndcg: the gain of documents in the order of score over that in the order of relevance; null where no document is relevant.

    Documents without relevance have 0, equal scores go by doc_id, and a document with several scores
    counts once, with its highest.
    """
    best = scores.where("query_id is not null and doc_id is not null").groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    met = best.join(rel, ["query_id", "doc_id"], "left").withColumn("rel", regularized(F.coalesce("relevance", F.lit(0.0)), regularizer))
    by_score = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    by_rel = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("rel"), "doc_id"))
    gain = F.pow(F.lit(2.0), F.col("rel")) - 1
    at = lambda place: gain / F.log2(place + 1)
    sums = met.withColumns({"__s": by_score, "__r": by_rel}).groupBy("query_id").agg(F.sum(at(F.col("__s"))).alias("dcg"), F.sum(at(F.col("__r"))).alias("ideal"))
    value = F.col("dcg") / F.nullif(F.col("ideal"), F.lit(0.0))
    return sums.select("query_id", (F.round(value, precision) if precision is not None else value).alias("ndcg"))
