"""Byte-level BPE encoding and decoding with a local rank file.

``encode`` gives each text's token ids as the tiktoken library gives them for
the rank file's bytes and the split pattern, without special tokens. Ids are
packed little-endian, four bytes each: the layout training shards use. ``decode``
gives the bytes behind packed ids.

Long texts are cut before a space or line feed that follows a visible
character. No match of the split pattern crosses such a place (a match is an
optional space and visible characters, or white space only), and the one
lookahead of the pattern stands inside white space, so the parts' ids joined
are the whole text's ids.

Defined cases: null text -> empty ids; empty text -> empty ids; null ids ->
empty bytes; a text without any cut place is encoded in one piece; repeated
rows are encoded each; clashing column names are replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordstar.llm.common import without
from ordstar.session import ship_package

#: Texts longer than this many characters are encoded in parts.
PART_CHARS = 32_768

#: Rows of one result batch of ``encode_and_decode``.
BATCH_ROWS = 256

_CUT = re.compile(r"(?<=[!-~\w])(?=[ \n])")
_ENCODINGS: dict = {}


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read on the driver and sent with the job (the
    executors need no copy of it; a vocabulary has a fixed size)."""
    with open(path, "rb") as f:
        return f.read()


def encoding(ranks: bytes, pattern: str):
    """The library's encoder, built once for each Python worker."""
    import tiktoken

    key = (hash(ranks), len(ranks), pattern)
    if key not in _ENCODINGS:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        _ENCODINGS[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _ENCODINGS[key]


def parts(text: str, size: int = PART_CHARS) -> list[str]:
    """``text`` in parts of about ``size`` characters, cut at safe places only."""
    out, start = [], 0
    while len(text) - start > size:
        m = _CUT.search(text, start + size)
        if not m:
            break
        out.append(text[start:m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def encode_text(enc, text: str, size: int = PART_CHARS) -> bytes:
    import numpy as np

    ids: list[int] = []
    for part in parts(text, size):
        ids += enc.encode_ordinary(part)
    return np.asarray(ids, dtype="<u4").tobytes()


def encode(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", ids: str = "ids",
           part_chars: int = PART_CHARS) -> DataFrame:
    """``df`` with the packed token ids of column ``text`` in column ``ids``."""
    ship_package(df.sparkSession)

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            yield pd.Series([encode_text(enc, t or "", part_chars) for t in batch], dtype=object)

    value = run(F.col(f"`{text}`"))
    return without(df, [ids]).select("*", value.alias(ids)) if text.lower() != ids.lower() else df.withColumn(ids, value)


def decode(df: DataFrame, ranks: bytes, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the raw bytes behind the packed ids of column ``ids``."""
    ship_package(df.sparkSession)

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        enc = encoding(ranks, pattern)
        for batch in batches:
            yield pd.Series([enc.decode_bytes(np.frombuffer(b or b"", dtype="<u4").tolist()) for b in batch], dtype=object)

    value = run(F.col(f"`{ids}`"))
    return without(df, [out]).select("*", value.alias(out)) if ids.lower() != out.lower() else df.withColumn(out, value)


def encode_and_decode(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded",
                      part_chars: int = PART_CHARS) -> DataFrame:
    """``decode(encode(df))`` by one Python worker a task instead of two; it holds the ids and bytes
    of ``BATCH_ROWS`` texts at a time."""
    ship_package(df.sparkSession)
    given = without(df.withColumn("__text", F.col(f"`{text}`").cast("string")), [ids, out])
    kept = given.columns[:-1]
    schema = T.StructType([*given.schema.fields[:-1], T.StructField(ids, T.BinaryType()), T.StructField(out, T.BinaryType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        enc = encoding(ranks, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                rows = batch.slice(start, BATCH_ROWS)
                coded = [encode_text(enc, t.as_py() or "", part_chars) for t in rows.column(len(kept))]
                decoded = [enc.decode_bytes(np.frombuffer(b, dtype="<u4").tolist()) for b in coded]
                yield pa.RecordBatch.from_arrays([*rows.columns[:len(kept)], pa.array(coded, pa.binary()), pa.array(decoded, pa.binary())], names=[*kept, ids, out])

    return given.mapInArrow(run, schema)
