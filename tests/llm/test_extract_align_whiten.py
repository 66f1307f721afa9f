"""Alignment, main text and whitening against plain versions of each."""
import collections
import hashlib
import html
import math
import re

import numpy as np
import public_tokenizers as public
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ordstar.llm import alignment, html_extract, whitening
from ordstar.llm.queries import QUERIES

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- op11: two tokenizers' tokens over the same bytes -----------------------------------------

FIELDS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
ODD = [None, "", " ", "  a  b ", "a▁b c", "x▁", "né  l’ été ! ok \n\n z", "日本語 テキスト 日本", "<|endoftext|> <s> </s> <0x0A>",
       "a" * 3000, " lead", "trail ", "\t\n x", "don't we'll 123 4567 !!! ...", "emoji 😀😀 x ́ y", "a   b 　c", "same text here",
       "same text here", "x\x00y z", "été\xa0! ça\xa0va"]


@pytest.fixture(scope="module")
def files():
    with open(public.path("byte_bpe_50k.json"), "rb") as a, open(public.path("piece_bpe_32k.model"), "rb") as b:
        return a.read(), b.read()


def plain_alignment(files, texts):
    """Whole texts, one after the other, without stretches, memory or merge_asof."""
    a_side = Tokenizer.from_str(files[0].decode())
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain}
    byte |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    a_bytes = {i: bytes(byte[c] for c in t) for t, i in a_side.get_vocab(with_added_tokens=False).items() if all(c in byte for c in t)}

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    docs, count = [], collections.Counter()
    for t in texts:
        a = a_side.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_side.encode(t) if t else []
        spelled = [a_bytes[i] for i in a], [b_bytes(i) for i in b]
        groups, links = [], []
        if t and b"".join(spelled[0]) == b"".join(spelled[1]) == (" " + t).encode():
            ends = [np.cumsum([len(x) for x in side]).tolist() for side in spelled]
            at = [0, 0]
            for end in sorted(set(ends[0]) & set(ends[1])):
                group = []
                for side, ids in enumerate((a, b)):
                    first = at[side]
                    while at[side] < len(ids) and ends[side][at[side]] <= end:
                        at[side] += 1
                    group.append(ids[first:at[side]])
                groups.append("|".join(",".join(map(str, g)) for g in group))
                links.append((group[0][-1], group[1][-1]))
        else:
            a, b = [], []
        docs.append((len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "", links))
        count.update(links)
    best = collections.defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(*d[:5], sum(count[x] == best[x[1]] for x in d[5]), sum(count[x] for x in d[5])) for d in docs]


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 3, 0])
def test_alignment_equals_plain_version(spark, files, heavy):
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(ODD)], "doc_id long, text string, N_A string")
    got = alignment.align_corpus(df, *files, heavy=heavy).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in FIELDS) for r in got] == plain_alignment(files, ODD)
    assert [r["text"] for r in got] == ODD and "N_A" not in got[0].asDict()
    assert alignment.align_corpus(df.limit(0), *files).collect() == []


def test_alignment_query(spark, files):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = QUERIES["op11_alignment"](spark, SMALL).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in FIELDS) for r in got] == plain_alignment(files, [d["text"] for d in docs])


def test_parts_of_long_texts_change_nothing(files):
    al = alignment.Aligner(*files)
    text = " ".join(f"word{i % 7} né\n{i}  x" for i in range(200))
    whole, cut = (list(alignment.align_texts(al, [text, None, text[:90]], details=True, size=n)) for n in (1 << 30, 64))
    for x, y in zip(whole, cut, strict=True):
        assert alignment._slim(x) == alignment._slim(y) and ";".join(x.groups) == ";".join(y.groups)
        assert [o.tolist() for o in [np.concatenate(x.overlaps)] if x.overlaps] == [o.tolist() for o in [np.concatenate(y.overlaps)] if y.overlaps] if x.overlaps else not y.overlaps


def test_overlaps_and_groups_of_a_text(spark, files):
    df = spark.createDataFrame([(1, "a  b né!", 5)], "doc_id long, text string, overlaps int")
    row = alignment.align(df, *files).collect()[0]
    a = Tokenizer.from_str(files[0].decode()).encode(" a  b né!").tokens
    b = sentencepiece.SentencePieceProcessor(model_proto=files[1]).encode("a  b né!", out_type=str)
    assert (row["n_a"], row["n_b"]) == (len(a), len(b))
    ends = [np.cumsum([len(t.encode()) if side else len(t) for t in tokens]) for side, tokens in enumerate((a, [t.replace("▁", " ") for t in b]))]
    spans = [[(int(e) - len(t.encode()) if side else int(e) - len(t), int(e)) for t, e in zip(tokens, ends[side])]
             for side, tokens in enumerate((a, [t.replace("▁", " ") for t in b]))]
    want = [(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]
    assert [(o["a"], o["b"]) for o in row["overlaps"]] == want
    assert row["groups"].count(";") + 1 == row["n_groups"]


# --- op12: main text of pages -----------------------------------------------------------------

def plain_main_text(page):
    """For pages of the given tables only: the article's blocks by their tags."""
    article = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    found = [" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", article)]
    return "\n".join(b for b in found if b)


def test_html_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op12_html_extract"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == plain_main_text(pages[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


TREE = html_extract.grow(*html_extract.labelled_figures(html_extract.LABELLED))
LONG = "One sentence of the story with a good number of plain words that go on for a while. "

#: Pages the tree has not seen: (page, main text).
HELD_OUT = [
    ("<body><header><a href=/>Site</a> News of the day</header><div id='cookie-notice'>" + LONG + "</div><ul class=menu><li><a>Home</a><li><a>News</a></ul>"
     "<div class='post-content'><h1>A title</h1><p>" + LONG + "<p>Short.<div class='advert'>" + LONG + "</div><p>Last <a href=x>words</a> here</div>"
     "<div class=sidebar><p>" + LONG + "</div><section id='comments'><h3>Comments</h3><p>" + LONG + "</section></body>",
     f"A title\n{LONG.strip()}\nShort.\nLast words here"),
    ("<main><form action=/s><input name=q> Search this site</form><h2>Head &amp; tail</h2><p>" + LONG + "<br>next line</p><aside>" + LONG + "</aside>"
     "<ul><li>one<li>two &lt;b&gt;</ul></main><footer>&copy; us</footer>", f"Head & tail\n{LONG.strip()} next line\none\ntwo <b>"),
    ("<form id=page><nav><a>x</a></nav><article><header><h1>T</h1></header><p>" + LONG + "</p><div class='share'>Share me</div></article></form>", f"T\n{LONG.strip()}"),
    ("<article><p>" + LONG + "</p></article><section class=comments><article class=comment><p>" + LONG + LONG + "</p></article></section>", LONG.strip()),
    ("<table><tr><td><a>a</a> <a>b</a><td><p>" + LONG * 3 + "<p>" + LONG * 2 + "<p>" + LONG * 2 + "<td><a>c</a></table>",
     "\n".join([(LONG * 3).strip(), (LONG * 2).strip(), (LONG * 2).strip()])),
    ("<nav><ul><li><a href=/>open link<li>x</ul></nav><article><p>" + LONG + "<p><a href=/more>a linked paragraph</a></article>", f"{LONG.strip()}\na linked paragraph"),
]


@pytest.mark.parametrize("page,want", HELD_OUT)
def test_held_out_pages(page, want):
    assert html_extract.main_text(page, TREE) == want


def test_broken_markup():
    def of(page):
        return html_extract.main_text(f"<article><p>{page}</article>", TREE)

    assert of("a<!-- b --><b>c</b> d<script>if (a < b) '</p>'</script>e") == "ac d\ne"
    assert of("AT&amp;T &am; &amp &copy; &#233;&#xe9; &nope; 1 < 2 &lt;p&gt;") == "AT&T &am; & © éé &nope; 1 < 2 <p>"
    assert of("x &am<b>p;</b> y") == "x &amp; y"
    assert of("a</div></span></zz>b <a title=\"x>y\" href='q'>c</a>") == "a\nb c"
    assert of("end <b class=") == "end"
    assert of("tail <style>p{}") == "tail"
    assert html_extract.main_text("", TREE) == "" and html_extract.main_text("<nav><a>x</a></nav>", TREE) == ""


@pytest.mark.parametrize("piece", ["<div>", "<a \"", "<b title=\"", "</p>", "<li>", "<!--", "<script>", "<", "<p a='", "<noscript>", "&amp", "x "])
def test_time_goes_with_length(piece):
    html_extract.main_text(piece * 100_000, TREE)  # ends in seconds, whatever is left open


def test_html_cases(spark):
    df = spark.createDataFrame([(1, None, "old"), (2, "", "old"), (3, "<article><p>hé</article>", "old"), (3, "<article><p>hé</article>", "old")],
                               "page_id long, html string, Text string")
    got = html_extract.extract(df).orderBy("page_id").collect()
    assert [(r["text"], r["n_chars"]) for r in got] == [("", 0), ("", 0), ("hé", 2), ("hé", 2)]
    assert html_extract.extract(df).columns == ["page_id", "html", "text", "n_chars"]
    assert html_extract.extract(df.limit(0)).collect() == []


def test_labelled_table_is_learned():
    x, y = html_extract.labelled_figures(html_extract.LABELLED)
    assert sum(html_extract.answer(TREE, tuple(b)) == w for b, w in zip(x, y)) >= 0.97 * len(y)
    with pytest.raises(ValueError):
        html_extract.labelled_figures(["+q3"])


# --- op13: whitening ----------------------------------------------------------------------------

def plain_whitening(vectors, components=4):
    """Per vector: deviation, whitened rows up to sign, explained; by numpy's own eigenvalues."""
    x = np.array([[math.floor(256 * c) for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    order = np.argsort(-values)[:components]
    white = (x - s / n) @ axes[:, order] / np.sqrt(values[order])
    return n, ((n * x - s) ** 2).sum(axis=1), white, values[order] / values.sum()


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, white, explained = plain_whitening([r["embedding"] for r in rows])
    got = QUERIES["op13_whitening"](spark, SF).orderBy("vec_id", "component").collect()
    assert [(r["vec_id"], r["component"]) for r in got] == [(r["vec_id"], k) for r in rows for k in (1, 2, 3, 4)]
    mine = np.array([r["whitened"] for r in got]).reshape(-1, 4)
    mine *= np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white).max() < 1e-8
    assert [r["deviation"] for r in got[::4]] == deviation.tolist() and {r["n"] for r in got} == {n}
    assert np.allclose([r["explained"] for r in got[:4]], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_cases(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [[1.0, 2.0, 0.0], [1.0, 2.0, 0.0], [0.5, -2.0, 1.0], [3.0, 0.25, -1.0], [0.0, 0.001, 2.0], [-1.0, -1.0, -1.0],
               None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [inf, 0.0, 0.0], [1.0, 2.0], [-0.001, 0.0, 0.0]]
    df = spark.createDataFrame([(i, v, "old") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, Whitened string")
    good = [i for i, v in enumerate(vectors) if v and len(v) == 3 and None not in v and all(map(math.isfinite, v))]
    n, deviation, white, _ = plain_whitening([vectors[i] for i in good])
    out = whitening.whiten(df)
    got = out.orderBy("vec_id", "component").collect()
    assert out.columns == ["vec_id", "embedding", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [(r["vec_id"], r["component"]) for r in got] == [(i, k) for i in good for k in (1, 2, 3)]
    mine = np.array([r["whitened"] for r in got]).reshape(-1, 3)
    mine *= np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white).max() < 1e-9 and [int(r["deviation"]) for r in got[::3]] == deviation.tolist()
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.filter("vec_id in (6, 7)")).collect() == []


def test_whitening_without_spread(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in whitening.whiten(df).collect()] == [(None, None, None, 0)] * 4
    line = spark.createDataFrame([(1, [1.0, 5.0]), (2, [3.0, 5.0])], "vec_id long, embedding array<float>")
    got = {(r["vec_id"], r["component"]): r["whitened"] for r in whitening.whiten(line).collect()}
    assert abs(got[1, 1]) == pytest.approx(1) and got[1, 1] == pytest.approx(-got[2, 1]) and got[1, 2] is None


def test_exact_sums_of_any_size():
    rng = np.random.default_rng(3)
    for top in (5, 1 << 19, 1 << 40, 1 << 62):
        x = rng.integers(-top, top, (40, 3))
        y = np.concatenate([np.ones((40, 1), dtype=object), x.astype(object)], axis=1)
        assert (whitening.outer_sums(x) == y.T @ y).all()
        values = [int(v) for v in (y.T @ y).ravel()]
        assert [whitening.joined_parts(whitening.split_parts(v)) for v in values] == values


def test_characteristic_polynomial_and_roots():
    rng = np.random.default_rng(5)
    for d, rank in ((1, 1), (4, 4), (6, 3), (9, 9)):
        x = rng.integers(-50, 50, (rank, d)).astype(object)
        c = x.T @ x
        poly = whitening.characteristic_polynomial(c)
        # The polynomial is 0 at C itself (Cayley and Hamilton), exactly.
        total, power = np.zeros((d, d), dtype=object), np.eye(d, dtype=int).astype(object)
        for v in poly:
            total, power = total + v * power, power @ c
        assert poly[d] == 1 and poly[d - 1] == -np.trace(c) and not total.any()
        want = sorted(np.linalg.eigvalsh(c.astype(float)), reverse=True)
        got = [m / 2 ** s for m, s in whitening.largest_roots(poly, d)]
        assert np.allclose(got[:rank], want[:rank], rtol=1e-9) and got[rank:] == [0.0] * (d - rank)


def test_equal_and_close_eigenvalues():
    # The square's corners: every direction of the plane is a component.
    square = whitening.outer_sums(np.array([[1, 1, 0], [1, -1, 0], [-1, 1, 0], [-1, -1, 0]]))
    _, _, values, axes, explained = whitening.principal_components(square, 3)
    assert values == [1.0, 1.0, 0.0] and explained[:2] == [0.5, 0.5]
    assert np.allclose(axes[:2] @ axes[:2].T, np.eye(2), atol=1e-15)
    # Two eigenvalues that agree in their first twelve digits.
    near = whitening.outer_sums(np.array([[10**6, 0], [-10**6, 0], [0, 10**6 + 1], [0, -10**6 - 1]]))
    _, _, values, axes, _ = whitening.principal_components(near, 2)
    assert values[0] > values[1] and np.allclose(np.abs(axes), [[0, 1], [1, 0]], atol=1e-15)
