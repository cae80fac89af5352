"""A corpus pipeline: reject low quality, drop repeated lines, keep one of each near-duplicate, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read back
as the next stage's docs; all but the last keep the columns of documents.

Defined cases, in every stage: a null text counts as empty and stays null, texts are taken
whole however long they are, rows that repeat a doc_id and text are scored alike and count as
copies of each other, ties go to the least doc_id (null first), columns that a stage does not
know stay as they are whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailforge.functions.ship import shipped
from trailforge.llm import bpe, common, linededup, mixing, neardup, quality


@shipped
def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels that are not held out, scores at 0.3 or more."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.scored(model, F.col("text")) >= quality.KEEP)


@shipped
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stay elsewhere; those left without a word go. n_chars follows the text."""
    (lost,) = common.free(docs, "lines_lost")
    left = linededup.deduplicate(docs, drop_emptied=True, radius=None, count=lost)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col(lost) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.drop(lost)


@shipped
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each class."""
    return neardup.deduplicate(docs)


@shipped
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or twice, so that no source is repeated more than twice and sources are as even as that allows."""
    prefix = "visit_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return mixing.mix(docs, prefix=prefix).select(*[f"`{c}`" for c in docs.columns])


@shipped
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and of their text."""
    return bpe.digests(docs)


STAGES = [
    ("quality", reject_low_quality),
    ("lines", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("encode", encode),
]
#: SimHash, consistent samples and a trained model are beyond SQL; tests/llm checks each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
