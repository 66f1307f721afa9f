"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordstar.session import materialize


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the node's smallest neighbour (or
    the node itself). Minima are combined before the shuffle and joined back, so a node with
    very many neighbours is no single task."""
    both = pairs.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))).select("col.*")
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    lowest = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return pairs.join(lowest, "u").select(F.explode(moved)).select("col.*").filter("u <> v").distinct()


def _settled(pairs: DataFrame) -> bool:
    """Whether the pairs are stars: each u has one v, and no v is a u."""
    ends = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up"))))).select("col.*")
    return ends.groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).filter("ups > 1 OR (ups = 1 AND least = 0)").isEmpty()


def components(pairs: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(``node``, ``root``) for every node of the pairs (``u``, ``v``), ``root`` the
    smallest node of its component. Each round is written to the shared folder."""
    now = materialize(pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "pairs")
    for _ in range(most_rounds):
        if _settled(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        now = materialize(_small_star(_large_star(now)), "pairs")
    raise RuntimeError("components did not settle")
