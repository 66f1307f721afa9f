import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_rows():
    """Null, empty, repeated, very long and special texts; null ids, languages and sources."""
    text = "Repeated rows stay rows. " * 4
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    texts = [None, "", " \t\r\n\x0b\x0c ", "one", "one two", "A b C", text, text, long, "a" * 5_000, "x<|endoftext|>y <|endoftext|>",
             "été ça va\xa0là  日本語 😀 ẞ", "tab\tand\nlines\n\n  odd   spaces \n", "12 34 !!", "Don't we'll I'd 'tis"]
    rows = [(1_000 + i, t, "en" if i % 3 else None, None if i % 4 == 0 else f"s{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return [*rows, rows[6], (None, "a row without an id", "en", "s1", 19), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark):
    """sf0.001 documents and the odd rows."""
    return spark.read.parquet(f"{SMALL}/documents.parquet").unionByName(spark.createDataFrame(odd_rows(), DOC_SCHEMA)).cache()


@pytest.fixture(scope="session")
def data(docs):
    return [r.asDict() for r in docs.collect()]


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
