"""Document fingerprints: quartile bucket digests, and each row's next row.

A digest counts hashed byte triplets (three shapes of triplet at every place)
in 256 buckets and keeps for each bucket only the quartile its count falls in, two bits, behind a
header of length class, quartile ratios and a check byte. Like texts have like
bucket profiles whatever their order; the difference of two digests adds the
bucket codes' distances (the widest doubled) and the header's, and is bounded by the
difference of unrelated digests, so ``likeness`` runs from 0 (nothing in common) to 1 (equal).

``with_next`` gives every row the next row's values in the order of a numeric key
(ties by a hash of the text; after the last row the first follows). No global sort: rows
go to buckets of a key range (cut at approximate quantiles, so a bucket's bytes are
bounded) and each bucket also gets a copy of the first row of the bucket behind it. A bucket that holds
one key only, and too many of it, is split by the tie-break hash. The driver sees one
small row per bucket.

Defined cases: null text counts as empty; texts under three bytes have the
empty profile and differ in the header only; equal texts have equal digests; a null
key sorts first; a single row is its own next row; rows equal in key and text
follow each other in any order; an empty table stays empty; clashing column
names are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordstar.llm.common import without
from ordstar.session import ship_package

BUCKETS = 256
#: Triplets: the two steps from a place to its other bytes.
SHAPES = ((1, 2), (2, 5), (3, 7))
#: Bytes of text in a key range, about, and the fewest ranges.
RANGE_CHARS, FEWEST_RANGES, MOST_RANGES = 4_000_000, 64, 8_192

_HEX = [format(i, "02x") for i in range(256)]


def _tables() -> np.ndarray:
    """For each shape and place in the triplet a fixed pseudorandom byte table."""
    out = np.zeros((len(SHAPES), 3, 256), np.uint8)
    for s in range(len(SHAPES)):
        for p in range(3):
            out[s, p] = np.random.RandomState(97 + 3 * s + p).permutation(256)
    return out


_TABLES = _tables()


def bucket_counts(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for (i, j), (t0, t1, t2) in zip(SHAPES, _TABLES, strict=True):
        if len(b) > j:
            n = len(b) - j
            counts += np.bincount(t0[b[:n]] ^ t1[b[i:i + n]] ^ t2[b[j:]], minlength=BUCKETS)
    return counts


def digest(data: bytes) -> str:
    """Header (check byte, length class, quartile ratios: 4 bytes) and bucket codes, in hex."""
    counts = bucket_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = codes[0::4] << 6 | codes[1::4] << 4 | codes[2::4] << 2 | codes[3::4]
    length = min(255, int(8 * np.log2(len(data) + 1)))
    ratio = (int(15 * q1 / q3) << 4 | int(15 * q2 / q3)) if q3 else 0
    return bytes([zlib.crc32(data) & 255, length, ratio, 0]).hex() + packed.astype(np.uint8).tobytes().hex()


def _codes(digests: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(len(digests), 4 + BUCKETS // 4)
    body = raw[:, 4:]
    return raw[:, :4].astype(np.int64), np.stack([body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3], axis=2).reshape(len(digests), BUCKETS).astype(np.int64)


def likeness(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Likeness (0 to 1) of digests pairwise."""
    if not len(a):
        return np.zeros(0)
    (ha, ca), (hb, cb) = _codes(a), _codes(b)
    gap = np.abs(ca - cb)
    gap[gap == 3] = 6
    # Unrelated digests differ by 1.625 a bucket on average.
    body = gap.sum(axis=1) / (1.625 * BUCKETS)
    length = np.minimum(np.abs(ha[:, 1] - hb[:, 1]), 64) / 640
    ratio = (np.abs((ha[:, 2] >> 4) - (hb[:, 2] >> 4)) + np.abs((ha[:, 2] & 15) - (hb[:, 2] & 15))) / 600
    check = (ha[:, 0] != hb[:, 0]) / 1000
    return 1 - np.minimum(1.0, body + length + ratio + check)


def fingerprint_column(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([digest((t or "").encode("utf-8", "surrogatepass")) for t in batch], dtype=object)

    return run(text)


def likeness_column(a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(likeness(x.tolist(), y.tolist()))

    return run(a, b)


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the digest of column ``text``."""
    ship_package(df.sparkSession)
    named = df.withColumn("__digest", fingerprint_column(F.col(f"`{text}`")))
    return named.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()], F.col("__digest").alias(out))


def _range_of(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are at most ``value`` (binary search); -1 for null."""
    if not cuts:
        return F.when(value.isNull(), -1).otherwise(0)
    table = F.array(*[F.lit(c).cast("bigint") for c in cuts])
    start = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        over = F.element_at(table, F.least(middle + 1, F.lit(len(cuts)))) <= value
        return F.when(s["low"] >= s["high"], s).when(over, F.struct((middle + 1).alias("low"), s["high"].alias("high"))).otherwise(
            F.struct(s["low"].alias("low"), middle.alias("high")))

    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1))
    return F.when(value.isNull(), -1).otherwise(F.aggregate(steps, start, halve, lambda s: s["low"]))


def with_next(df: DataFrame, key: str, text: str, take: Sequence[str], prefix: str = "next_") -> DataFrame:
    """``df`` with the columns ``take`` of the next row as ``next_...``."""
    base = without(df, [prefix + c for c in take])
    k, tie = F.col(f"`{key}`").cast("bigint"), F.xxhash64(F.col(f"`{text}`"))
    size = base.agg(F.sum(F.length(F.col(f"`{text}`"))).alias("chars"), F.count(F.lit(1)).alias("rows")).first()
    ranges = int(min(MOST_RANGES, max(FEWEST_RANGES, (size["chars"] or 0) // RANGE_CHARS)))
    quantiles = base.agg(F.percentile_approx(k, [i / ranges for i in range(1, ranges)], 20 * ranges).alias("q")).first()["q"]
    cuts = sorted(set(quantiles or []))
    spot = _range_of(k, cuts)
    found = base.select(spot.alias("r"), k.alias("k")).groupBy("r").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).collect()
    fair = max(1, (size["rows"] or 0) // ranges)
    parts = [1] * (len(cuts) + 2)  # shares of each range, the nulls' range first
    for r in found:
        if r["low"] == r["high"] and r["n"] > 2 * fair:
            parts[r["r"] + 1] = min(4096, -(-r["n"] // fair))
    starts = [sum(parts[:i]) for i in range(len(parts))]
    lookup = lambda values, kind, at: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), at)
    placed = base.withColumn("__r", spot + 2).withColumns({"__k": k, "__tie": tie})
    placed = placed.withColumn("__parts", lookup(parts, "int", F.col("__r")))
    share = F.least(F.col("__parts") - 1, F.floor((F.col("__tie").cast("double") / 2.0**64 + 0.5) * F.col("__parts"))).cast("int")
    placed = placed.withColumn("__bucket", lookup(starts, "int", F.col("__r")) + share + 1).drop("__r", "__parts")
    firsts = {r["__bucket"]: r["f"] for r in placed.groupBy("__bucket").agg(F.min(F.struct(F.col("__k"), F.col("__tie"))).alias("f")).collect()}
    order = sorted(firsts)
    if not order:
        return base.select("*", *[F.col(f"`{c}`").alias(prefix + c) for c in take])
    ahead = dict(zip(order, [order[-1], *order[:-1]], strict=True))
    slots = range(1, order[-1] + 1)
    into = lookup([ahead.get(b) for b in slots], "int", F.col("__bucket"))
    head_k = lookup([firsts[b]["__k"] if b in firsts else None for b in slots], "bigint", F.col("__bucket"))
    head_tie = lookup([firsts[b]["__tie"] if b in firsts else None for b in slots], "bigint", F.col("__bucket"))
    copied = F.struct(*[F.col(f"`{c}`").alias(c) for c in take])
    none = [F.lit(None).cast(base.schema[c].dataType).alias(c) for c in base.columns if c not in take]
    peeks = (placed.filter(F.col("__k").eqNullSafe(head_k) & (F.col("__tie") == head_tie))
             .groupBy("__bucket").agg(F.first(copied).alias("c"))
             .select(into.alias("__bucket"), F.lit(None).cast("bigint").alias("__k"), F.lit(None).cast("bigint").alias("__tie"), F.lit(True).alias("__peek"),
                     *none, *[F.col("c")[c].alias(c) for c in take]))
    rows = placed.withColumn("__peek", F.lit(False)).unionByName(peeks)
    line = Window.partitionBy("__bucket").orderBy("__peek", F.col("__k").asc_nulls_first(), "__tie")
    led = rows.select("*", *[F.lead(F.col(f"`{c}`")).over(line).alias(prefix + c) for c in take])
    return led.filter(~F.col("__peek")).select(*[F.col(f"`{c}`") for c in base.columns], *[F.col(f"`{prefix}{c}`") for c in take])
