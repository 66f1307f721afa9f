"""LM scoring (op3), language ID (op7), Jaccard join (op8), fingerprints (op9), pipeline."""
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ordstar.llm import fingerprints, jaccard_join, lang_id, lm_scoring
from ordstar.llm.common import words
from ordstar.llm.components import components
from ordstar.llm.queries import QUERIES, language_training

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    return [*words(text or ""), lm_scoring.END]


# --- op3 ---

def held(doc_id):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 7 == 2


SIZES = {"head": 60, "tails": 12, "most_known": 100}


def test_scores_against_plain_counts(docs, data, nothing):
    own = docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2)
    training = own.filter("NOT held_out")
    got = lm_scoring.score(own.withColumn("Score", F.lit("old")), training, steps=60, **SIZES).collect()
    c = Counter(t for d in data if not held(d["doc_id"]) for t in tokens(d["text"]))
    n, v = sum(c.values()), len(c)
    want = sorted((str(d["doc_id"]), len(tokens(d["text"])), sum(t in c for t in tokens(d["text"])),
                   round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(d["text"])), 5)) for d in data)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 5)) for r in got) == want
    assert all(r["train_tokens"] == n for r in got)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert lm_scoring.score(nothing, training, steps=2, **SIZES).count() == 0
    alone = lm_scoring.score(docs.limit(3), nothing).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in alone] == [(0, 0)] * 3


def test_probabilities_sum_to_one(docs):
    counts = lm_scoring.count_words(docs, "text")
    v = lm_scoring.vocabulary(counts, **SIZES)
    table = lm_scoring.train(lm_scoring.count_pairs(docs, "text", v))
    assert np.allclose((10.0 ** table[:, :]).sum(axis=1), 1, atol=1e-4)
    classes = lm_scoring.Classes(v)
    shares = Counter()
    for r in counts.collect():
        k = classes[bytes(r["word"])]
        if k >= v.head:
            shares[k - v.head] += 10 ** v.share(k - v.head, r["c"])
    for t in range(len(v.endings) + 1):
        if v.mass[t]:
            assert math.isclose(shares[t] + 10 ** v.share(t, 0), 1, rel_tol=1e-6)


def test_model_learns_what_follows():
    pairs = np.full((6, 6), 1.0)
    for i in range(6):
        pairs[i, (i + 1) % 6] = 500
    table = 10.0 ** lm_scoring.train(pairs, steps=300)
    assert all(table[i].argmax() == (i + 1) % 6 and table[i].max() > 0.8 for i in range(6))


# --- op7 ---

def test_language_accuracy_on_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r["doc_id"]: r for r in QUERIES["op7_language"](spark, "/root/testdata/sf0.01").collect()}
    truth = {r["doc_id"]: r["lang"] for r in df.select("doc_id", "lang").collect()}
    assert len(found) == len(truth)
    out = [r for r in found.values() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) >= 0.98 * len(out)
    assert sum(r["accepted"] for r in found.values()) >= 0.995 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_defined_cases(docs, data, nothing):
    model = lang_id.learn(language_training(docs))
    got = lang_id.predict(docs.withColumn("LANG_PRED", F.lit("old")), model).collect()
    for r in got:
        no_letter = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == no_letter and (r["score"] == 0) == no_letter
        assert not (no_letter and r["accepted"])
    assert len(got) == len(data)
    assert lang_id.predict(nothing, model).count() == 0
    assert lang_id.learn(language_training(nothing)) is None
    assert {r["lang_pred"] for r in lang_id.predict(docs, None).collect()} == {"und"}


def test_kneser_ney_sums_to_one_and_slices_agree(monkeypatch):
    texts = {"a": ["abab abba baab " * 30], "b": ["cdcd ddcc cab " * 30]}
    counted = {k: np.unique(np.concatenate([lang_id.keys_of(lang_id.symbols(t)) for t in v]), return_counts=True) for k, v in texts.items()}
    alphabet = 16
    model = lang_id.fit(["a", "b"], counted, alphabet)
    seen = sorted({0, *map(ord, "abcd")})
    for context in ("aba", "xyz", "ccc", "b\0a"):
        x = np.array([(ord(context[0]) << 48) + (ord(context[1]) << 32) + (ord(context[2]) << 16) + s for s in [*seen, 999]], np.uint64)
        x &= ~np.uint64(0) if context[1] != "\0" else np.uint64(0xFFFF0000FFFFFFFF)
        p = 2.0 ** model.symbol_logs(x)
        assert np.allclose(p[:-1].sum(axis=0) + (alphabet - len(seen)) * p[-1], 1, atol=1e-4)
    text = "abab cdcd, Abba! " * 50
    whole = model.entropies(text)
    monkeypatch.setattr(lang_id, "STRETCH", 51)  # cut at a separator
    parts = model.entropies(text)
    assert abs(parts[1] - whole[1]) <= 20 and np.allclose(parts[0] / parts[1], whole[0] / whole[1], rtol=0.1)


# --- op8 ---

def plain_set(text):
    w = words(text or "")
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())


def plain_components(rows, percent=90):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    lowest = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        if k is not None:
            lowest[top(i)].append(k)
    return sorted((str(k), len(sets[i]), str(min(lowest[top(i)], default=None))) for i, (k, _) in enumerate(rows))


def near_families(seed=5):
    """Chains and clusters of edited copies of all lengths around the threshold."""
    r = random.Random(seed)
    rows, k = [], 10_000
    for size in (1, 2, 3, 4, 9, 10, 11, 12, 13, 20, 21, 25, 40, 60, 100, 250):
        base = [f"w{r.randint(0, 10**6)}" for _ in range(size)]
        for _ in range(14):
            text = list(base)
            for _ in range(r.randint(0, 1 + size // 30)):
                text[r.randrange(len(text))] = f"e{r.randint(0, 10**6)}"
            if r.random() < 0.3:
                text += [f"t{r.randint(0, 10**6)}" for _ in range(r.randint(1, 1 + size // 12))]
            rows.append((k, " ".join(text)))
            k += 1
            if r.random() < 0.4:
                base = text  # a chain: the ends need not be linked directly
    shared = " ".join(f"p{i}" for i in range(60))
    rows += [(k + i, shared + " " + " ".join(f"q{r.randint(0, 10**6)}" for _ in range(10 + i))) for i in range(20)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [1_500, 6])
def test_components_against_all_pairs(spark, docs, data, monkeypatch, most):
    monkeypatch.setattr(jaccard_join, "MOST", most)
    monkeypatch.setattr(jaccard_join, "LEAF", 4 if most == 6 else 192)
    rows = near_families() + [(d["doc_id"], d["text"]) for d in data]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("COMPONENT_ID", F.lit("old"))
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jaccard_join.jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect())
    assert got == plain_components(rows)


def test_regions_hold_every_linked_pair():
    r = random.Random(1)
    for _ in range(3_000):
        n = r.choice([1, 2, 5, 9, 10, 11, 14, 19, 20, 21, 30, 44, 45, 100, 300])
        pool = np.unique(np.array([r.getrandbits(64) for _ in range(n + 40)], np.uint64))
        x, y = pool[:n], pool[r.randint(0, n // 10):n + r.randint(0, n // 9)]
        both = len(np.intersect1d(x, y))
        if 100 * both >= 90 * (len(x) + len(y) - both):
            assert len(np.intersect1d(jaccard_join.region_keys(x, 90), jaccard_join.region_keys(y, 90))), (len(x), len(y))


def test_keep_one_of_each_group(spark, docs, data, nothing):
    rows = near_families() + [(d["doc_id"], d["text"]) for d in data]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = jaccard_join.keep_one(df).collect()
    groups = {g for k, n, g in plain_components(rows) if n}
    empty = sum(not plain_set(t) for _, t in rows)
    assert len(kept) == len(groups) + empty
    assert {str(r["doc_id"]) for r in kept if plain_set(r["text"])} == groups
    assert jaccard_join.keep_one(nothing).count() == 0


def stays_at_five_words(rows):
    """Ids of each component at five words and 0.8, by all pairs: the lowest stays."""
    sets = []
    for _, t in rows:
        w = words(t or "")
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    return sorted(min(rows[i][0] for i in range(len(rows)) if group[i] == g) for g in set(group))


def crowded_rows():
    """Families of copies with up to a tenth cut or edited, most with a phrase that all share."""
    r, rows = random.Random(8), []
    phrase = [f"common{i}" for i in range(12)]
    for size in (4, 6, 20, 45, 46, 90, 91, 150, 300):
        for _ in range(6):
            base = [f"w{r.randint(0, 10**6)}" for _ in range(size)]
            for _ in range(5):
                text = base[:len(base) - r.randint(0, size // 7)] + [f"t{r.randint(0, 10**6)}" for _ in range(r.randint(0, size // 16))]
                if r.random() < 0.4:
                    text[r.randrange(len(text))] = "edited"
                rows.append((len(rows), " ".join((phrase if r.random() < 0.7 else []) + text)))
    return rows


def test_near_copies_stage_against_all_pairs_at_five_words(spark):
    rows = crowded_rows() + [(k + 10_000, t) for k, t in near_families()] + [(90_000, None), (90_001, " ")]
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    stays = stays_at_five_words(rows)
    assert len(stays) < jaccard_join.keep_one(df).count()
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_copies(spark, df, SMALL).select("doc_id").collect()) == stays


def test_regions_at_80_hold_every_linked_pair_when_popular_ones_are_left():
    r, n_linked, left = random.Random(2), 0, 0
    for _ in range(3_000):
        n = r.choice([1, 2, 4, 5, 6, 9, 10, 14, 20, 30, 44, 45, 100, 300])
        pool = np.unique(np.array([r.getrandbits(64) for _ in range(n + 80)], np.uint64))
        x, y = pool[:n], pool[r.randint(0, n // 9):n + r.randint(0, n // 6)]
        x, y = r.sample(list(x), len(x)), list(y)
        x, y = np.sort(np.array(x[:len(x) - r.randint(0, n // 12)], np.uint64)), np.array(y, np.uint64)
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        n_linked += 1
        assert len(np.intersect1d(jaccard_join.region_keys(x, 80), jaccard_join.region_keys(y, 80)))
        popular, kept = defaultdict(lambda: r.randint(2, 9)), []
        for s in (x, y):
            kinds = defaultdict(list)
            for k, spare in zip(*jaccard_join.regions_of(s, 80), strict=True):
                kinds[int(spare)].append((-popular[int(k)], int(k)))
            kept.append({k for spare, found in kinds.items() for _, k in sorted(found)[spare % jaccard_join.SPARE:]})
            left += sum(spare % jaccard_join.SPARE for spare in kinds)
        assert kept[0] & kept[1], (len(x), len(y))
    assert n_linked > 500 and left


def test_star_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# --- op9 ---

def test_next_rows_and_digests(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_CHARS", 2_000)
    base = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    found = {r["doc_id"]: r for r in QUERIES["op9_fingerprints"](spark, SMALL).collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in base.collect())
    assert len(found) == len(rows)
    for i, (k, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        r = found[k]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (fingerprints.digest(x.encode()) for x in (t, edited, nxt))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a, b)
        assert math.isclose(r["near_edited"], fingerprints.likeness([a], [b])[0]) and math.isclose(r["near_next"], fingerprints.likeness([a], [c])[0])
    ahead = sum(r["near_edited"] > r["near_next"] for r in found.values())
    assert ahead >= 0.9 * len(rows)


def test_next_row_odd_cases(spark, docs, data, nothing):
    out = fingerprints.with_next(docs.select("doc_id", "text", F.lit(1).alias("next_text")), "doc_id", "text", ["doc_id", "text"]).collect()
    assert len(out) == len(data)
    ids = sorted((d["doc_id"] for d in data), key=lambda k: (k is not None, k or 0))
    steps = Counter((r["doc_id"], r["next_doc_id"]) for r in out)
    assert steps == Counter(zip(ids, [*ids[1:], ids[0]], strict=True))
    hot = spark.createDataFrame([(5, f"t{i}") for i in range(500)] + [(1, "a"), (9, "z")], "doc_id bigint, text string")
    out = fingerprints.with_next(hot, "doc_id", "text", ["doc_id", "text"]).collect()
    assert Counter(r["next_text"] for r in out) == Counter([*(f"t{i}" for i in range(500)), "a", "z"])
    assert fingerprints.with_next(nothing, "doc_id", "text", ["text"]).count() == 0
    one = fingerprints.with_next(hot.limit(1), "doc_id", "text", ["text"]).first()
    assert one["next_text"] == one["text"]


def test_likeness_is_bounded_and_one_for_equal_texts():
    digests = [fingerprints.digest(t.encode()) for t in ("", "a", "ab", "abc" * 400, "the quick brown fox " * 50, "x" * 9_000)]
    for a in digests:
        assert fingerprints.likeness([a], [a])[0] == 1
        assert all(0 <= fingerprints.likeness([a], [b])[0] <= 1 for b in digests)


# --- pipeline ---

def test_pipeline_stages(spark, docs, data):
    now, columns = docs, docs.columns
    counts = [len(data)]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SMALL)
        if name != "encode":
            assert out.columns == columns
        now = spark.createDataFrame(out.collect(), out.schema)
        counts.append(now.count())
    rows = now.collect()
    assert rows and all(r["round_trip"] and 4 * r["n_tokens"] == len(r["ids"]) for r in rows)
    assert counts[1] < counts[0] and counts[2] >= 0.99 * counts[1] and counts[3] < counts[2]
    empty = corpus_pipeline.STAGES[0][1](spark, docs.limit(0), SMALL)
    for _, stage in corpus_pipeline.STAGES[1:]:
        empty = stage(spark, empty, SMALL)
    assert empty.count() == 0
