"""URL filters (op1), mixing (op2), sharding (op4) and quality rules (op6)."""
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ordstar.llm import mixing, quality, sharding, url_filter
from ordstar.llm.common import words


def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def plain_verdict(host, path, rules):
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else (None, "allow")


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/a", "block"), ("example.net", "/en/a/b", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"), ("a.example.net", "/e", "block"), ("x.org", "", "block"), ("x.org", "", "allow"), ("a.b", "/q", "allow"), ("", "/only", "block")]
URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/a/b/c", "http://example.net/en/ab", "http://example.net/en/x?y#z", "http://example.net", "http://net/", "x://net//",
        "http://badexample.net/en/a", "http://q.example.com/de/1", "http://example.com/d", "http://x.org?/fr/", "http://y.x.org/fr/1", "a://b://c/d", "http://k/only/1", "http://a..net/x",
        "http://example.net./en/", "http://a.b/q\n/z?", "http://a.example.net/e", "http://a.example.net/en/", "http://é.net/"]


@pytest.mark.parametrize("sweep", [1, 3, 50_000])
def test_url_rules_against_all_pairs(spark, sweep):
    urls = [*URLS, *URLS[:8], *[f"http://s{i % 7}.example.net/en/{'ab/'[i % 3]}{i}" for i in range(60)]]
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id int, url string, Host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, url_filter.rule_table(spark, RULES), sweep_rows=sweep).collect()}
    for i, u in enumerate(urls):
        host, path = plain_host_path(u)
        assert got[i] == (host, path, *plain_verdict(host, path, RULES)), u
    assert len(got) == len(urls)


def test_url_rules_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    none = url_filter.rule_table(spark, [])
    assert [r["verdict"] for r in url_filter.filter_urls(pages, none).collect()] == ["allow"]
    assert url_filter.filter_urls(pages.limit(0), url_filter.rule_table(spark, RULES)).count() == 0


def plain_targets(sizes, weights, budget, most):
    left, targets, open_ = budget, {}, set(sizes)
    while open_:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > most * sizes[s] + 1e-9}
        if not over:
            return targets | {s: left * weights[s] / total for s in open_}
        for s in over:
            targets[s] = most * sizes[s]
            left -= most * sizes[s]
        open_ -= over
    return targets


def test_mix_meets_targets_and_never_passes_twice(docs, data):
    got = mixing.mix_report(docs, (5, 2, 1), block_words=16).collect()
    assert len(got) == len(data)
    sizes = Counter()
    for d in data:
        sizes[d["source"]] += len((d["text"] or "").encode().split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want = plain_targets(sizes, weights, 1.5 * sum(sizes.values()), 2)
    source = {(d["doc_id"], len((d["text"] or "").encode().split())): d["source"] for d in data}
    taken = Counter()
    for r in got:
        s = source[(r["doc_id"], r["size"])]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[s]
        assert math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        taken[s] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 32
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_report(docs.repartition(7), (5, 2, 1), block_words=16).collect()))


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100, 1009):
        rows = spark.range(n).selectExpr("id", f"{n}L AS n").withColumn("p", F.expr(mixing.permuted("id", "n", "5L"))).collect()
        assert sorted(r["p"] for r in rows) == list(range(n))
    far = sum(abs(r["p"] - r["id"]) for r in rows) / 1009
    assert 1009 / 4 < far < 1009 / 2  # a third for a random order


def test_shard_counts_scatter_as_the_conditioned_draw(spark):
    """Segments of documents of one block each: a source's slots in a shard have the
    hypergeometric standard deviation, no more and no less."""
    rows = spark.range(60_000).selectExpr("CASE WHEN id % 4 = 0 THEN 'a' ELSE 'b' END AS source", "id AS key", "4L AS size")
    mix = mixing.plan_mix(rows, (1, 3), (1, 1), 2, block_words=4, shard_blocks=1_000)
    counts = defaultdict(Counter)
    for r in mix.segments.groupBy("shard", "rank").count().collect():
        counts[r["rank"]][r["shard"]] = r["count"]
    n = sum(sum(c.values()) for c in counts.values())
    assert n == 60_000 and sum(counts[0].values()) == 15_000
    for rank, share in ((0, 0.25), (1, 0.75)):
        want = 1_000 * share * (1 - share) * (n - 1_000) / (n - 1)
        found = sum((counts[rank][s] - 1_000 * share) ** 2 for s in range(60)) / 60
        assert 0.55 < found / want < 1.6, (found, want)


def test_slots_are_dealt_by_a_permutation(spark):
    for n in (1, 2, 7, 1009, 100_003):
        row = spark.range(n).withColumn("place", F.expr(mixing.dealt_place("id", n))).agg(F.countDistinct("place").alias("n"), F.min("place").alias("a"), F.max("place").alias("b")).first()
        assert tuple(row) == (n, 0, n - 1)
    for n in (40 * 4_096, 100 * 4_096 + 17):
        counted = (spark.range(n).withColumn("place", F.expr(mixing.dealt_place("id", n))).filter(F.col("id") < n // 4_096 * 4_096)
                   .groupBy(F.expr("id div 4096").alias("shard")).agg(*[F.sum((F.expr(f"place * 4 div {n}") == q).cast("int")).alias(f"q{q}") for q in range(4)]).collect())
        for q in range(4):
            mean = sum(r[f"q{q}"] for r in counted) / len(counted)
            found = math.sqrt(sum((r[f"q{q}"] - mean) ** 2 for r in counted) / len(counted))
            assert 18 < found < 38, (n, q, found)  # about 27.5 wanted


def test_mixed_documents_hold_the_taken_words(docs, data, nothing):
    mixed = mixing.mixed_documents(docs, (5, 2, 1), block_words=16)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    n_taken = Counter()
    for r in rows:
        n_taken[r["doc_id"]] += len(r["text"].encode().split())
        assert r["n_chars"] == len(r["text"])
    want = Counter()
    for r in mixing.mix_report(docs, (5, 2, 1), block_words=16).collect():
        want[r["doc_id"]] += r["taken"]
    assert abs(sum(n_taken.values()) - sum(want.values())) <= 64 * 24
    by_id = defaultdict(set)
    for d in data:
        by_id[d["doc_id"]] |= set((d["text"] or "").encode().split())
    assert all(set(r["text"].encode().split()) <= by_id[r["doc_id"]] for r in rows)
    assert mixing.mixed_documents(nothing, (5, 2, 1)).count() == 0 and mixing.mix_report(nothing, (5, 2, 1)).count() == 0


def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * sharding.MULTIPLIER + 1) % 2**64
        j = int(float((b + 1) * (1 << 31)) / float((key >> 33) + 1))
    return b


def test_jump_hash_moves_rows_to_the_new_shard_only(spark):
    keys = spark.range(3_000).withColumn("h", sharding.shard_key(F.col("id")))
    rows = keys.select("h", sharding.jump_hash(F.col("h"), 24).alias("a"), sharding.jump_hash(F.col("h"), 25).alias("b"), sharding.jump_hash(F.col("h"), 1).alias("c")).collect()
    assert all(r["a"] == plain_jump(r["h"], 24) and r["c"] == 0 for r in rows)
    moved = [r for r in rows if r["a"] != r["b"]]
    assert all(r["b"] == 24 for r in moved) and 60 < len(moved) < 190
    assert max(Counter(r["a"] for r in rows).values()) < 190


def test_slots_have_no_gaps(docs, nothing):
    slim = docs.select("doc_id", F.length("text").alias("size"), F.lit("x").alias("SLOT"))
    slim = slim.unionByName(slim.limit(1).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(9_000)))).drop("k"))
    rows = sharding.number_slots(sharding.assign_shards(slim, "doc_id", 5, 6), "shard", buckets=4).collect()
    assert len(rows) == slim.count()
    for s in range(5):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 5) for r in rows)
    assert sharding.number_slots(sharding.assign_shards(nothing.select("doc_id"), "doc_id", 5), "shard").count() == 0


def plain_measures(text):
    w = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(8)}
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_measures_against_plain_python(spark, docs, data):
    extra = ["a b c d e f g h " * 5, "x " * 200, "l1 a b c d e f g h i j\nl1 a b c d e f g h i j\n" * 3, "q " * 8, "q " * 9, "# $ | <\n\n\n \n# $"]
    table = docs.unionByName(spark.createDataFrame([(5_000 + i, t, "en", "s", 0) for i, t in enumerate(extra)], docs.schema))
    got = sorted((str(r["doc_id"]), *[r[c] for c in quality.BASE]) for r in quality.measure(table.withColumn("N_words", F.lit(0))).collect())
    assert got == sorted((str(i), *plain_measures(t)) for i, t in [*((d["doc_id"], d["text"]) for d in data), *((5_000 + i, t) for i, t in enumerate(extra))])


def test_most_rejections_is_the_exact_binomial_bound(spark):
    for n, p, miss in [(0, .1, .05), (20, .1, .05), (300, .02, .01), (1_000, .05, .002), (5_000, .0083, .002)]:
        got = spark.range(1).select(quality.most_rejections(F.lit(n).cast("bigint"), F.lit(p), F.lit(miss)).alias("k")).first()["k"]
        tail, want = 0.0, -1
        for k in range(n + 1):
            tail += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log(1 - p))
            if tail > miss:
                break
            want = k
        assert got == want


def test_learned_cutoffs_catch_and_keep(spark):
    good = " ".join(f"word{i}" for i in range(30))
    junk = good + " " + " ".join(f"#{i}#" for i in range(20))
    rows = [(i, good + f" tail{i}" + (" ##" * 3 if i % 50 == 0 else ""), "en" if i % 2 else None) for i in range(4_000)]
    rows += [(10_000 + i, junk + f" x{i}", "en" if i % 2 else None) for i in range(400)]
    rows += [(20_000, junk, "xx")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[0] < 10_000)) for r in rows if r[2] != "xx"] + [(7, None), (None, 1)], "doc_id bigint, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_filter(df, labels).collect()}
    assert all(kept[i] for i in range(4_000)) and not any(kept[10_000 + i] for i in range(400))
    assert kept[20_000]  # no labels in its stratum
    few = labels.filter("doc_id < 60 OR doc_id BETWEEN 10000 AND 10020")
    assert all(r["kept"] for r in quality.quality_filter(df, few).collect())  # too few labels to prove anything
    assert all(r["kept"] for r in quality.quality_filter(df, labels.limit(0)).collect())
    assert quality.quality_filter(df.limit(0), labels).count() == 0
    bad = {r["w"]: r["n_words"] for r in quality.quality_filter(spark.createDataFrame([(None, None, None)], "doc_id bigint, text string, lang string").withColumn("w", F.lit(1)), labels).collect()}
    assert bad == {1: 0}
    assert words("A b") == [b"a", b"b"]
