"""Sharding by jump consistent hashing.

A key's shard depends on the key and the number of shards only, needs no table,
and when shards are appended a key either stays or moves to a new shard; about
1/(n+1) of the keys move when the n+1st is added.

The hash walks the key's own pseudorandom sequence: from shard b it jumps to
floor((b + 1) / r) for the next random r in (0, 1]; the last jump below the
number of shards is the answer. The sequence is a linear congruence modulo
2^64, kept in decimals because a signed product would overflow, and started at 60 bits
of the key's md5, so keys that differ little start far apart. The walk is a fold over the at most n jumps.

Slots number a shard's rows from 0 without gaps. A window over a whole shard
would be one task per shard; instead rows are numbered inside (shard, bucket),
and a table of bucket sizes (shards x buckets rows) gives each bucket's first slot.
Buckets come from a hash of the whole row and equal rows are counted before they
are numbered, so neither a hot key nor a third of all rows being equal makes a
large bucket.

Defined cases: a null key is a key of its own; repeated rows each get a slot; an
empty table stays empty; clashing column names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordstar.llm.common import md5_long, without
from ordstar.session import materialize

#: The multiplier and modulus of the published hash.
MULTIPLIER = 2862933555777941757
MODULUS = 1 << 64

#: Number groups per shard.
BUCKETS = 512

_D = "decimal(38,0)"


def jump_hash(key: Column, shards: int) -> Column:
    """Shard (0 to ``shards`` - 1) of a non-negative long key."""
    def step(walk: Column, _: Column) -> Column:
        seed = ((walk["seed"] * F.lit(str(MULTIPLIER)).cast("decimal(19,0)") + F.lit(1)).cast(_D) % F.lit(str(MODULUS)).cast(_D)).cast("decimal(20,0)")
        top = F.floor(seed / F.lit(1 << 33).cast("decimal(20,0)")).cast("bigint") + F.lit(1)
        jump = F.floor(((walk["next"] + 1) * F.lit(1 << 31)).cast("double") / top.cast("double")).cast("bigint")
        moved = F.struct(seed.alias("seed"), walk["next"].alias("at"), jump.alias("next"))
        return F.when(walk["next"] < shards, moved).otherwise(walk)

    start = F.struct(key.cast("decimal(20,0)").alias("seed"), F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("next"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), start, step, lambda w: w["at"].cast("int"))


def shard_key(column: Column) -> Column:
    """60 bits of the key's text; a null key differs from every text."""
    return F.coalesce(md5_long(column), F.lit(0).cast("bigint"))


def assign_shards(df: DataFrame, key: str, shards: int, grown: int | None = None) -> DataFrame:
    """``df`` with ``shard`` and, for ``grown`` shards, ``grown_shard``."""
    k = shard_key(F.col(f"`{key}`"))
    out = without(df.withColumn("__key", k), ["shard", "grown_shard"])
    out = out.withColumn("shard", jump_hash(F.col("__key"), shards))
    if grown is not None:
        out = out.withColumn("grown_shard", jump_hash(F.col("__key"), grown))
    return out.drop("__key")


def number_slots(df: DataFrame, group: str = "shard", buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``slot``: 0, 1, ... inside each ``group``, no gaps, in the order
    of a hash of the whole row and then its columns from left to right, nulls
    first. Keep ``df`` narrow: its distinct rows are written once.
    """
    base = without(df, ["slot"])
    names = [F.col(f"`{c}`") for c in base.columns]
    written = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("~")) for c in names])
    counted = materialize(base.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")), "slots")
    placed = counted.withColumn("__bucket", (md5_long(written) % buckets).cast("int"))
    sizes = placed.groupBy(group, "__bucket").agg(F.sum("__n").alias("__n"))
    firsts = sizes.select(F.col(group).alias("__g"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__n").over(
        Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(group, "__bucket").orderBy(*[c.asc_nulls_first() for c in names]).rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    joined = numbered.join(firsts, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__bucket") == F.col("__b")))
    # Equal rows are spread out again in two steps, so no array grows with their number.
    run = 4096
    low = F.col("__first") + F.col("__inside")
    runs = joined.select(*names, (low + F.col("__n")).alias("__end"), F.explode(F.sequence(low, low + F.col("__n") - 1, F.lit(run).cast("bigint"))).alias("__low"))
    return runs.select(*names, F.explode(F.sequence(F.col("__low"), F.least(F.col("__low") + run, F.col("__end")) - 1)).alias("slot"))
