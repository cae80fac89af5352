"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in Spark expressions only.

Each key walks the published generator: multiply a 64-bit state, add one, and jump to a
later bucket until the jump passes the last one. No ring table exists, and a shard more
takes its rows from all others and moves nothing else.

Defined cases: a null key counts as key 0; keys that are not integers are hashed first; a
null text counts as empty; repeated rows each get a slot of their own; an empty table
gives an empty result; further columns of the input are ignored by `shards`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW = 0xFFFFFFFF
#: Fixed values of the published generator: the multiplier in 32-bit halves.
_MULTIPLIER_HIGH = 0x27BB2EE6
_MULTIPLIER_LOW = 0x87B0B0FD
#: Buckets (three hexadecimal digits) of a shard whose rows are numbered together; 8 shards times this is the bound of the broadcast table.
BUCKETS = 4096
#: Jumps that every key is given before it is asked whether it needs more.
JUMPS = 48


def _product_low(x: Column, by: int) -> Column:
    """The low 32 bits of x * by, both under 2**32, without passing 2**63."""
    return (x * (by & 0xFFFF) + F.shiftleft((x * (by >> 16)).bitwiseAND(0xFFFF), 16)).bitwiseAND(_LOW)


def _step(state: Column) -> tuple[Column, Column]:
    """Halves of state * multiplier + 1 modulo 2**64."""
    low, high = state["low"], state["high"]
    p0, p1 = low * (_MULTIPLIER_LOW & 0xFFFF), low * (_MULTIPLIER_LOW >> 16)
    bottom = p0.bitwiseAND(_LOW) + F.shiftleft(p1.bitwiseAND(0xFFFF), 16) + 1
    top = (
        F.shiftrightunsigned(p0, 32)
        + F.shiftrightunsigned(p1, 16)
        + F.shiftrightunsigned(bottom, 32)
        + _product_low(high, _MULTIPLIER_LOW)
        + _product_low(low, _MULTIPLIER_HIGH)
    )
    return bottom.bitwiseAND(_LOW), top.bitwiseAND(_LOW)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard of a long key among `shards`; null counts as 0."""
    if shards < 1:
        raise ValueError("at least one shard")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    begin = F.struct(
        key.bitwiseAND(_LOW).alias("low"),
        F.shiftrightunsigned(key, 32).alias("high"),
        F.lit(0).cast("long").alias("at"),
        F.lit(0).cast("long").alias("next"),
    )

    def go(state: Column, _: Column) -> Column:
        on = state["next"] < shards
        low, high = _step(state)
        jump = ((state["next"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(high, 1) + 1).cast("double"))).cast("long")
        return F.struct(
            F.when(on, low).otherwise(state["low"]).alias("low"),
            F.when(on, high).otherwise(state["high"]).alias("high"),
            F.when(on, state["next"]).otherwise(state["at"]).alias("at"),
            F.when(on, jump).otherwise(state["next"]).alias("next"),
        )

    # A key takes about ln(shards) jumps; the few that need more than JUMPS walk on.
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, JUMPS))), begin, go)
    if shards > JUMPS:
        walked = F.aggregate(
            F.array(walked), begin, lambda _, state: F.when(state["next"] >= shards, state).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(shards - JUMPS)), state, go))
        )
    return walked["at"].cast("int")


def stable_key(df: DataFrame, column: str) -> Column:
    """Integer keys as they are, others by a 64-bit hash."""
    kind = df.schema[column].dataType.typeName()
    return F.col(column).cast("long") if kind in ("byte", "short", "integer", "long") else F.when(F.col(column).isNotNull(), F.xxhash64(column))


def _bucket(key: Column) -> Column:
    """One of BUCKETS by the first bits of an MD5, which other engines have too."""
    said = F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), F.col("size").cast("string"), F.col("text_crc32").cast("string"))
    return F.conv(F.substring(F.md5(said), 1, 3), 16, 10).cast("int")


def shards(df: DataFrame, n: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `df`: key, size, text_crc32, law, shard, slot, grown_shard.

    Slots run from 0 in each shard without a gap. Rows are numbered inside hashed buckets of a
    shard, after equal rows have been counted together, and each bucket starts where the
    earlier ones end; no task numbers a whole shard.
    """
    number = stable_key(df, key)
    rows = df.select(
        F.col(key),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        jump_hash(number, n).alias("shard"),
        jump_hash(number, n + 1).alias("grown_shard"),
    ).withColumn("bucket", _bucket(F.col(key)))
    kinds = rows.groupBy("shard", "bucket", key, "size", "text_crc32", "grown_shard").agg(F.count(F.lit(1)).alias("copies"))
    filled = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("filled"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = filled.select("shard", "bucket", F.coalesce(F.sum("filled").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy(key, "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    numbered = kinds.withColumn("before", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    return (
        numbered.join(F.broadcast(starts) if n * BUCKETS <= 1_000_000 else starts, ["shard", "bucket"])
        .withColumn("slot", F.explode(F.sequence(F.col("start") + F.col("before"), F.col("start") + F.col("before") + F.col("copies") - 1)))
        .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
    )
