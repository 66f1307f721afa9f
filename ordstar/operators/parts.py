"""Wide rows that stay where they are written, while narrow rows move to them.

A lookup by a large table moves the rows to it: with several such lookups a wide row moves
several times. Here the rows are written once, with the number of the task that
wrote them (their part), as a table bucketed by part. What a part asks for, its distinct keys,
needs no exchange; keys move to the large table and their answers to the part, and the
rows meet the answers where they stand.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordstar.functions.text import col, cols
from ordstar.operators.numbering import _order_cols, dense_number
from ordstar.session import freed_shuffles, scratch_path

PART, MID = "__part", "__row"
#: Runs of rows (a file in a part) that ``number_in_place`` gathers at most.
MOST_RUNS = 100_000


#: Runtime setting of Spark: whether rows dealt by some keys of a join are dealt again by all.
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def in_place(spark: SparkSession):
    """Joins planned inside leave pinned rows where they are (a join on the part and a key
    is content with rows dealt by part). What is made of pinned rows has to be written
    inside: planned outside, the same join deals the rows again, with the same result.
    Shuffle files go as each write ends."""
    old = spark.conf.get(_ALL_KEYS)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        with freed_shuffles(spark):
            yield
    finally:
        spark.conf.set(_ALL_KEYS, old)


def staying(spark: SparkSession) -> bool:
    """Whether this runs inside ``in_place``."""
    return spark.conf.get(_ALL_KEYS) == "false"


def part_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@lru_cache
def _part_numbers(spark: SparkSession, n: int) -> list[int]:
    """One number for every bucket, so that parts spread evenly over the buckets."""
    spread = spark.range(64 * n).select(F.col("id").cast("int").alias("i")).groupBy(F.pmod(F.hash("i"), F.lit(n)).alias("b"))
    return sorted(r["i"] for r in spread.agg(F.min("i").alias("i")).collect())


def pin_parts(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder, with ``__part`` and ``__row`` (a number of the row,
    rising in the order that the task's rows have)."""
    spark = df.sparkSession
    n, path, table = part_count(spark), scratch_path(spark, name), f"ordstar_parts_{uuid.uuid4().hex}"
    numbers = _part_numbers(spark, n)
    part = F.element_at(F.lit(numbers), F.pmod(F.spark_partition_id(), F.lit(len(numbers))) + 1)
    names = [c for c in df.columns if c not in (PART, MID)]
    plain = df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(names)], F.monotonically_increasing_id().alias(MID))
    plain.withColumn(PART, part).write.format("parquet").bucketBy(n, PART).option("path", path).saveAsTable(table)
    try:
        written = spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
    return written.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], PART, MID)


def answers(pinned: DataFrame, keys: dict[str, Column], found: DataFrame) -> DataFrame:
    """``(__part, keys, the other columns of found)`` for what each part asks for: ``keys`` are
    expressions over the rows, by their names in ``found``, which has each key once.
    For a left join of the rows on ``__part`` and the keys."""
    asked = pinned.select(PART, *[c.alias(k) for k, c in keys.items()]).dropna(subset=list(keys)).distinct()
    return asked.join(found, list(keys)).repartition(part_count(pinned.sparkSession), PART).hint("shuffle_hash")


def number_rows(pinned: DataFrame, order: Sequence[str], id_col: str) -> DataFrame:
    """Add the dense number of every row in ``order``: order keys move, and the numbers back."""
    numbers = dense_number(pinned.select(*cols(order), PART, MID), list(order), id_col=id_col, drop=list(order))
    back = numbers.repartition(part_count(pinned.sparkSession), PART).hint("shuffle_hash")
    return pinned.join(back, [PART, MID], "left")


def number_in_place(df: DataFrame, order: Sequence[str | Column], run: Sequence[str], id_col: str, name: str) -> DataFrame:
    """Pinned rows with ``id_col`` = 1, 2, ... in ``order``, and no row moves, where each task holds
    whole stretches of the order: ``run`` names its first columns; rows of one task that
    share the first of them (a file) are a stretch, and no two stretches overlap. Where
    that does not hold, the rows are numbered as ``dense_number`` does."""
    spark = df.sparkSession
    pinned = pin_parts(df.sortWithinPartitions(*_order_cols(order, True)), name)
    task, place = F.shiftright(MID, 33), F.col(MID).bitwiseAND(F.lit((1 << 33) - 1))
    key = F.struct(*cols(run))
    runs = (pinned.groupBy(task.alias("t"), col(run[0]).alias("r")).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p"), F.min(key).alias("a"), F.max(key).alias("z"),
                                                                        F.count(F.when(reduce(lambda x, y: x | y, [c.isNull() for c in cols(run)]), 1)).alias("nulls"))
                  .limit(MOST_RUNS + 1).collect())
    whole = len(runs) <= MOST_RUNS and not any(r["nulls"] for r in runs)
    if whole:
        runs.sort(key=lambda r: tuple(r["a"]))
        whole = all(tuple(x["z"]) < tuple(y["a"]) for x, y in zip(runs, runs[1:]))
    if not whole:
        return pin_parts(dense_number(pinned.drop(PART, MID), list(order), id_col=id_col), name)
    begins, total = [], 0
    for r in runs:
        begins.append((r["t"], r["r"], total - r["p"] + 1))
        total += r["n"]
    first = F.broadcast(spark.createDataFrame(begins, f"__t long, __r {dict(pinned.dtypes)[run[0]]}, __begin long"))
    x = pinned.join(first, (task == F.col("__t")) & (col(run[0]) == F.col("__r")), "left")
    return x.withColumn(id_col, F.col("__begin") + place).drop("__t", "__r", "__begin")
