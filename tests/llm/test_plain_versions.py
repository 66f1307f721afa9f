"""Operators and registered queries against plain versions written again here."""
import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from ordstar.llm import fingerprints, jaccard_join, lang_id, token_counts
from ordstar.llm.oracles import ORACLES
from ordstar.llm.queries import QUERIES, language_training

SMALL = "/root/testdata/sf0.001"


# --- op5, op10: the registered queries against the libraries -------------------------------------

def test_token_count_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    for r in QUERIES["op5_token_counts"](spark, SMALL).collect():
        text = docs.pop(r["doc_id"])
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)
        assert r["fit_chars"] == len(text) if n <= 1024 else r["fit_chars"] < len(text)
    assert not docs


def test_byte_bpe_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    with open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("plain", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in QUERIES["op10_byte_bpe"](spark, SMALL).collect():
        text = docs.pop(r["doc_id"])
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert not docs


@pytest.fixture(scope="module")
def counter():
    with open(public.path("byte_bpe_50k.json"), "rb") as f:
        return token_counts.PrefixCounter(f.read())


@pytest.mark.parametrize("text", ["Été ça va\xa0! Où est-il\xa0? don't\xa0: we'll  see.\n\n", "日本語テキスト", "abcdefghij", "\xa0", "a　b c", "x" * 31 + " "])
def test_truncation_of_texts_with_one_chunk(counter, text):
    text = (text * 400)[:2_500]
    counts = counter.prefix_counts(text)
    for i in {1, 2, 3, 17, min(255, len(text)), min(1_999, len(text)), len(text)}:
        assert counts[i - 1] == len(counter.library.encode(text[:i], add_special_tokens=False).ids)
    for budget in (0, 1, 10, 100, counts[-1]):
        assert counter.fit(text, budget) == max((i for i, n in enumerate(counts, 1) if n <= budget), default=0)


def test_truncation_time_goes_with_length(counter):
    for text in ("Été ça va\xa0! Où\xa0? " * 10_000, "日本語テキスト" * 20_000, "\xa0" * 100_000):
        assert 0 < counter.fit(text, 1_024) < len(text)  # seconds; the square of the length would be hours
    assert all(len(c) <= token_counts.REMEMBERED_CHARS for half in (counter.chunks.young, counter.chunks.old) for c in half)


# --- op6 where the learned rules fire ---------------------------------------------------------------

def test_quality_query_where_learned_rules_reject(spark):
    sf = "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(ORACLES["op6_quality"])
    names = [d[0] for d in res.description]
    want = {r[names.index("doc_id")]: dict(zip(names, r)) for r in res.fetchall()}
    got = QUERIES["op6_quality"](spark, sf).collect()
    assert len(got) == len(want) and sum(bool(r["rejected_by"]) for r in got) > 100
    assert all(r.asDict() == want[r["doc_id"]] for r in got)


# --- op7: interpolated Kneser-Ney in dictionaries ----------------------------------------------------

def plain_symbols(text):
    out = []
    for c in text + " ":
        s = c.lower() if c.isalpha() and len(c.lower()) == 1 and ord(c.lower()) < 0x10000 else (c if c.isalpha() and ord(c) < 0x10000 else "\1" if c.isalpha() else "\0")
        if s != "\0" or (out and out[-1] != "\0"):
            out.append(s)
    return out if any(s != "\0" for s in out) else []


def plain_model(texts, alphabet):
    counts = {4: Counter()}
    for t in texts:
        s = ["\0"] * 3 + plain_symbols(t)
        counts[4].update(tuple(s[i - 3:i + 1]) for i in range(3, len(s)))
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])  # how many different symbols precede
    discount, total, kinds = {}, defaultdict(float), Counter()
    for n, table in counts.items():
        once, twice = (sum(c == k for c in table.values()) for k in (1, 2))
        discount[n] = min(0.95, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5
        for g, c in table.items():
            total[n, g[:-1]] += c
            kinds[n, g[:-1]] += 1

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / alphabet
        head = gram[:-1]
        if (n, head) not in kinds:
            return p(gram[1:])
        own = max(counts[n][gram] - discount[n], 0) / total[n, head] if gram in counts[n] else 0
        return own + discount[n] * kinds[n, head] / total[n, head] * p(gram[1:])

    return p


def test_language_probabilities_against_dictionaries():
    learned = {"aa": ["the cat sat on the mat", "a cat, the rat! and THE hat", "that is that"], "bb": ["le chat est là", "été où çà le la les", "un chat noir et un rat"]}
    counted = {}
    for lang, texts in learned.items():
        grams, n = np.unique(np.concatenate([lang_id.keys_of(lang_id.symbols(t)) for t in texts]), return_counts=True)
        counted[lang] = (grams, n)
    model = lang_id.fit(sorted(learned), counted, 64)
    for text in ("the chat", "Été the zebra!", "ça", "日本 the", "xyz qqq", "a", "…the… rat…"):
        s = ["\0"] * 3 + plain_symbols(text)
        want = [-sum(math.log2(plain_model(learned[lang], 64)(tuple(s[i - 3:i + 1]))) for i in range(3, len(s))) for lang in sorted(learned)]
        bits, n = model.entropies(text)
        assert n == len(s) - 3 and np.allclose(bits, want, atol=1e-3)


def test_language_ties_and_repeated_rows(spark):
    rows = [(i, "aa", "hello there my good friend") for i in range(400)] + [(1_000 + i, "aa", f"words of number {chr(97 + i)} and more") for i in range(20)]
    rows += [(2_000, "bb", "long text of its own kind " * 2_000)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    sample = lang_id._sample(df.selectExpr("doc_id AS key", "lang", "text"), 300).collect()
    assert sum(r["lang"] == "aa" for r in sample) == 21 and all(len(r["text"]) <= lang_id.MOST_CHARS for r in sample)
    assert [len(r["text"]) for r in sample if r["lang"] == "bb"] == [lang_id.MOST_CHARS]
    same = {lang: (np.array([5], np.uint64), np.array([1])) for lang in ("bb", "aa")}
    model = lang_id.calibrate(lang_id.fit(["aa", "bb"], same, 64), [])
    assert lang_id.decide(model, np.array([7.0, 7.0]), 3)[:2] == ("aa", 0.5)


# --- op9: the digest, byte by byte -----------------------------------------------------------------

def plain_digest(data):
    tables = [[np.random.RandomState(97 + 3 * s + p).permutation(256) for p in range(3)] for s in range(3)]
    counts = [0] * 256
    for (i, j), (a, b, c) in zip(((1, 2), (2, 5), (3, 7)), tables):
        for at in range(len(data) - j):
            counts[int(a[data[at]]) ^ int(b[data[at + i]]) ^ int(c[data[at + j]])] += 1
    q1, q2, q3 = (sorted(counts)[k] for k in (63, 127, 191))
    codes = [(n > q1) + (n > q2) + (n > q3) for n in counts]
    body = bytes(codes[k] << 6 | codes[k + 1] << 4 | codes[k + 2] << 2 | codes[k + 3] for k in range(0, 256, 4))
    ratio = (15 * q1 // q3 << 4 | 15 * q2 // q3) if q3 else 0
    return (bytes([zlib.crc32(data) & 255, min(255, int(8 * math.log2(len(data) + 1))), ratio, 0]) + body).hex()


def test_digest_byte_by_byte(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(25).collect()] + ["", "ab", "abc", "é" * 50]
    for t in texts:
        assert fingerprints.digest(t.encode()) == plain_digest(t.encode())
    found = spark.createDataFrame([(t, "old") for t in texts], "text string, Fingerprint string")
    got = fingerprints.fingerprint(found).collect()
    assert [r["fingerprint"] for r in got] == [plain_digest(t.encode()) for t in texts] and len(got[0]) == 2


# --- pipeline: what each filtering stage keeps -------------------------------------------------------

def test_filtering_stages_keep_input_columns_and_the_right_rows(spark):
    own = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = ["kept", "accepted", "n_words", "lang_pred", "rejected_by", "score"]
    docs = own.selectExpr("*", *[f"concat('{n}', doc_id) AS {n}" for n in names])
    foreign = [(900_000 + i, "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία και άλλα πολλά λόγια " * 8, "el", "s", 0, *names) for i in range(3)]
    docs = docs.unionByName(spark.createDataFrame(foreign, docs.schema))
    judged = {r["doc_id"]: r["kept"] for r in QUERIES["op6_quality"](spark, SMALL).collect()}
    first = corpus_pipeline.quality_rules(spark, docs, SMALL)
    assert first.columns == docs.columns
    rows = first.collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] < 900_000) == sorted(i for i, kept in judged.items() if kept)
    assert all(r[n] == f"{n}{r['doc_id']}" for r in rows if r["doc_id"] < 900_000 for n in names)
    # Language ID learns Spanish, French, ... here, not Greek (null labels are not learned).
    kept = spark.createDataFrame([(*r[:2], None if r["lang"] == "el" else r["lang"], *r[3:]) for r in rows], docs.schema)
    second = corpus_pipeline.language(spark, kept, SMALL)
    assert second.columns == docs.columns
    ids = {r["doc_id"] for r in second.collect()}
    model = lang_id.learn(language_training(kept))
    assert ids == {r["doc_id"] for r in rows if lang_id.decide(model, *model.entropies(r["text"]))[2]}
    assert not ids & {900_000, 900_001, 900_002} and len(ids) >= 0.99 * sum(r["doc_id"] < 900_000 for r in rows)


def test_narrow_region_keys_hold_every_linked_pair():
    r = np.random.RandomState(4)
    for bits in (12, 20, 40):
        for _ in range(400):
            n = int(r.randint(1, 200))
            pool = np.unique(r.randint(0, 2**63, n + 20).astype(np.uint64))
            x, y = pool[:n], np.delete(pool[:n + int(r.randint(0, 3))], r.randint(0, n, int(r.randint(0, 2))) if n > 1 else [])
            both = len(np.intersect1d(x, y))
            if 100 * both < 80 * (len(x) + len(y) - both):
                continue
            sides = []
            for s in (np.sort(x), np.sort(y)):
                keys, spares = jaccard_join.narrowed(*jaccard_join.regions_of(s, 80), np.uint64(64 - bits))
                kept = set()
                for kind in np.unique(spares // jaccard_join.SPARE):
                    own = spares // jaccard_join.SPARE == kind
                    ranked = sorted(set(keys[own].tolist()), key=lambda k: (k * 2654435761 % 97, k))
                    kept |= set(ranked[int(spares[own][0]) % jaccard_join.SPARE:])
                sides.append(kept)
            assert sides[0] & sides[1]
