"""Small helpers shared by the operators of this subpackage.

Conventions of every operator here: result columns replace input columns of
the same name (names compare without case, as Spark does); all other input
columns pass through; a null text counts as an empty one unless the operator
says otherwise; an empty table gives an empty result of the same schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns an operator is about to add."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of an id written as text (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).cast("binary"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def md5_long(key: Column) -> Column:
    """60 pseudorandom bits of a key's text as a non-negative long; any SQL
    engine with md5 computes the same."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("bigint")


def words(text: str) -> list[bytes]:
    """Words of a text, ASCII letters lower-cased (``bytes.split`` splits on
    exactly the six white-space bytes, ``bytes.lower`` maps exactly A-Z)."""
    return text.encode("utf-8", "surrogatepass").lower().split()
