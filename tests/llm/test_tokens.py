"""Token counts (op5) and byte-level BPE (op10) against the libraries."""
import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordstar.llm import bpe, token_counts

SPEC = open(P.path("byte_bpe_50k.json"), "rb").read()
LIBRARY = Tokenizer.from_str(SPEC.decode())
COUNTER = token_counts.PrefixCounter(SPEC)
RANKS = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                             mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())})


def count(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\r\x0b\xa0  ab'sltreé日😀Z1.,!|<>endofxt", max_size=40))
def test_every_prefix_counts_as_the_library_says(text):
    assert COUNTER.total(text) == count(text)
    assert COUNTER.prefix_counts(text) == [count(text[:i]) for i in range(1, len(text) + 1)]


def test_fit_is_the_longest_prefix_within_the_budget():
    r = random.Random(3)
    for _ in range(300):
        text = "".join(r.choice(" \n\tab'sltre1 .,!é日 Z") for _ in range(r.randint(0, 40)))
        counts = COUNTER.prefix_counts(text)
        for budget in (0, 1, 5, 30):
            assert COUNTER.fit(text, budget) == max([0, *(i for i, c in enumerate(counts, 1) if c <= budget)])


def test_long_piece_bottom_up_equals_top_down():
    for piece in ("a" * 3_000, "thinganed" * 300, "Ġ" * 900):
        assert COUNTER.piece_counts(piece)[-1] == COUNTER.piece_total(piece)
    assert COUNTER.total("thinganed" * 30) == count("thinganed" * 30)


def test_counts_over_a_table(docs, data, nothing):
    out = token_counts.token_counts(docs.withColumn("N_TOKENS", F.lit("old")), SPEC, budgets=[50])
    assert [c for c in out.columns if c.lower() == "n_tokens"] == ["n_tokens"]
    assert sorted((r["n_tokens"], r["fit_50"]) for r in out.collect()) == sorted(
        (count(d["text"] or ""), COUNTER.fit(d["text"] or "", 50)) for d in data)
    assert token_counts.token_counts(nothing, SPEC).count() == 0
    few = docs.filter("doc_id >= 1000 AND length(text) < 200").withColumn("n", F.length("text"))
    for r in token_counts.token_counts(few, SPEC, prefixes=True).collect():
        assert len(r["prefix_tokens"]) == r["n"] and (not r["n"] or r["prefix_tokens"][-1] == r["n_tokens"])


def test_bpe_equals_the_library_and_decodes(docs, data, nothing):
    coded = bpe.decode(bpe.encode(docs.withColumn("IDS", F.lit(1)), RANKS, P.PATTERN), RANKS, P.PATTERN)
    got = sorted((hashlib.sha256(r["ids"]).hexdigest(), bytes(r["decoded"])) for r in coded.collect())
    want = sorted((hashlib.sha256(np.array(TIKTOKEN.encode_ordinary(d["text"] or ""), "<u4").tobytes()).hexdigest(), (d["text"] or "").encode()) for d in data)
    assert got == want
    assert bpe.encode(nothing, RANKS, P.PATTERN).count() == 0


def test_bpe_in_one_pass_equals_two_and_needs_one_worker(docs, nothing):
    docs = docs.withColumn("IDS", F.lit(1))
    one = bpe.encode_and_decode(docs, RANKS, P.PATTERN)
    two = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert one.columns == two.columns and [f.dataType for f in one.schema] == [f.dataType for f in two.schema]
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    assert one._jdf.queryExecution().executedPlan().toString().count("Python") == 0
    assert one._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert bpe.encode_and_decode(nothing, RANKS, P.PATTERN).count() == 0
    small = bpe.encode_and_decode(docs.select(F.lit(" a b").alias("t")), RANKS, P.PATTERN, "t", "I", "d")
    assert {bytes(r["d"]) for r in small.collect()} == {b" a b"} and small.columns == ["t", "I", "d"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\t\r\xa0  ab'sé日😀1.,!", max_size=60), st.integers(1, 7))
def test_cut_places_are_safe(text, size):
    assert "".join(bpe.parts(text, size)) == text
    assert bpe.encode_text(TIKTOKEN, text, size) == np.array(TIKTOKEN.encode_ordinary(text), "<u4").tobytes()
