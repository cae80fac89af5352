"""What the corpus operators share: shared storage, row keys, skew-proof joins and components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trailforge.functions.scratch import scratch_path

#: The most rows of the side table that `hot_join` broadcasts, and rows that no key is hot with.
HOT_KEYS, HOT_ROWS = 10_000, 200

_LEAST_LONG = -(2**63)


def stored(df: DataFrame, what: str) -> DataFrame:
    """`df` written once to the shared folder and read back: lineage is cut, and lost executors cost no more than the reads."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, what: str, **measures: Column) -> tuple[DataFrame, dict]:
    """`stored`, and aggregates of the rows that are taken while they are written."""
    seen = Observation()
    kept = stored(df.observe(seen, *[value.alias(name) for name, value in measures.items()]), what)
    return kept, seen.get


def weighed(df: DataFrame, what: str, weight: str) -> tuple[DataFrame, int]:
    """`stored`, and the weight from which a key is hot: over a HOT_KEYS-th of all, which HOT_KEYS keys at most can have. None is hot if it is 0."""
    kept, seen = measured(df, what, total=F.sum(weight), most=F.max(weight))
    limit = max((seen["total"] or 0) // HOT_KEYS, HOT_ROWS)
    return kept, limit if (seen["most"] or 0) > limit else 0


def forget(*tables: DataFrame) -> None:
    """Deletes what `stored` wrote for tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for path in {p.rpartition("/")[0] for p in df.inputFiles()}:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two longs that tell rows apart even if a doc_id is missing or repeats with another text."""
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(_LEAST_LONG)).alias("key_id"), F.xxhash64(text).alias("key_text")]


def hot_join(left: DataFrame, right: tuple[DataFrame, int], keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """`left` joined to `right` of `weighed`, which has one row a key; its `weight` says how many rows of `left` have the key.

    Hot keys, HOT_KEYS of them at most, are broadcast, so that no key in the shuffle join has
    more rows than one of HOT_KEYS equal partitions. `left` is read again for them: pass a stored table.
    """
    table, limit = right
    if not limit:
        return left.join(table, keys, how)
    hot = table.where(F.col(weight) > limit)
    met = left.join(F.broadcast(hot), keys, "inner")
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(table.where(F.col(weight) <= limit), keys, how)
    return met.unionByName(rest)


def per_run(df: DataFrame, keys: list[str], each: Callable[[tuple, dict[str, list]], list[tuple[int, ...]]], out: tuple[str, ...] = ("u", "v")) -> DataFrame:
    """The longs `out` from `each` (key, columns as lists) over the rows of every key: a group is all that is held.

    Groups are runs of sorted Arrow batches, which costs far less for many small groups than a data
    frame for each. The number of partitions is the session's, since work does not follow bytes.
    """
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _runs(batches, names, keys):
            if found := each(key, rows):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=list(out))

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(run, ", ".join(f"{name} long" for name in out))


def _runs(batches: Iterator[pa.RecordBatch], names: list[str], keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    key, held = None, None
    for batch in batches:
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(names)}
        found = list(zip(*(columns[k] for k in keys)))
        at = 0
        while at < len(found):
            end = at + 1
            while end < len(found) and found[end] == found[at]:
                end += 1
            part = {name: values[at:end] for name, values in columns.items()}
            if held is not None and key == found[at]:
                for name in names:
                    held[name] += part[name]
            else:
                if held is not None:
                    yield key, held
                key, held = found[at], part
            at = end
    if held is not None:
        yield key, held


def components(edges: DataFrame) -> DataFrame:
    """Connected components of `edges` (u long, v long): one row (node, root) for each node of an edge, root the least node.

    Large-star and small-star steps in turn, each a partial minimum and a join whose skewed
    partitions Spark splits, until the edges stand still; nothing but two checksums reaches the driver.
    """
    checks = {"n": F.count(F.lit(1)), "sum": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    now, mark = measured(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", **checks)
    while mark["n"]:
        both = now.union(now.select("v", "u"))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = stored(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        linked = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        # The least neighbour's own row, v = m, stands for the node itself.
        after, then = measured(linked.select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v")).distinct(), "edges", **checks)
        forget(now, least, large)
        now, mark, before = after, then, mark
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
