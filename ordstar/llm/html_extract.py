"""Main text of web pages from flat text blocks and a decision tree.

A page is read once, from left to right, into flat text blocks: the text between
two block-level tags, white space turned into single spaces. Each block has its
word count and link density (share of its words inside links), those of the block
before and after it, whether it is a heading, whether it stands in a boilerplate
container (navigation, side bar, advert, form, reader comments, ...: told by
element, role, class or id), and where it stands to the page's main region (an
article, else a main or content element; many pages have none). A decision tree
over these figures, grown on the driver from a small labelled table (``LABELLED``,
a parameter), says which blocks are main text; they are joined by line feeds in
page order. Nothing is dropped or cut but blocks the tree rejects.

Reading follows what browsers do with broken markup: comments, scripts, styles
and other raw elements are skipped to their end tag; a paragraph ends where the
next block starts; an end tag without a start is ignored; an unfinished tag ends
the page. Character references are decoded as in HTML 5 (also without the
semicolon, where that is allowed); what is no reference stays as it is. Time and
memory go with the page's length, whatever is nested or left open.

Defined cases: null or empty html, and pages without main text -> empty text,
0 characters; a page's text is taken whole however long; repeated rows are
extracted each; ``text`` and ``n_chars`` replace columns of those names; an empty
table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordstar.llm.common import without
from ordstar.session import ship_package

# --- fixed values: element and name lists ------------------------------------------------

#: Elements that do not end a block of text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q "
                   "rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template iframe noembed noframes textarea title select svg math object audio video canvas".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a start tag of the same set closes.
SIBLINGS = ({"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}, {"option"}, {"thead", "tbody", "tfoot"})
#: Elements inside which such a sibling is another list's or table's.
LISTS = frozenset("ul ol menu dl table".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements and roles of boilerplate.
BOILER_ELEMENTS = frozenset("nav aside footer form menu dialog button fieldset".split())
BOILER_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar".split())
#: Words of class and id names that mark boilerplate.
BOILER_NAMES = frozenset("""
    ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner
    menu nav navbar navigation breadcrumb breadcrumbs pager pagination skip toc toolbar topbar
    sidebar aside rail widget widgets related recommended recommendations trending popular teaser teasers
    footer masthead copyright legal disclaimer
    notice notices notification cookie cookies consent gdpr alert popup modal overlay paywall
    newsletter subscribe subscription signup login search share sharing social follow form poll
    comment comments commentlist disqus reply replies respond discussion reactions
    hidden print""".split())
#: Of these, names that count on an article or main element too.
BOILER_ARTICLES = frozenset("ad ads advert advertisement sponsored promo comment comments reply related teaser widget".split())
#: Words of class and id names that mark the main text where no element does.
CONTENT_NAMES = frozenset("article articlebody content entry post story maincontent main".split())

#: The labelled table: one line a page, its blocks in order. A block is its label
#: (+ main text, - boilerplate), its place (a inside the main region, o outside the
#: page's main region, n on a page without one; b instead: in a boilerplate
#: container), h for a heading, its word count, and l with the words in links.
LABELLED = (
    "-b1l1 -b1l1 -b2l2 -b14 +ah8 +a60 +a1 +a24l3 +a110 -b9",
    "-o2l1 -b8l8 -b3l3 +ah5 +a3 +a35 +ah2 +a75l6 +a4l4 -b30 -b12l2",
    "-b40 -o6 +ah11 +a18 +a5 +a2 +a9 -b65 -b80 -b7l1",
    "-o12 -o3l3 +a150 +a1 +a1 +a88l9 -o45 -o4l4 -o20l20",
    "-o1 -o30 +ah4 +a10l10 +a42 -b22 +a51 -bh2 -b16l16 -b55 -o8",
    "-b3 -b25l25 +ah7 +a6 -b18 +a33 +a700 -b2l2 -b10 -oh3 -o70",
    "-o5l5 -o5l5 +a90 +a12 +a3 +a45l20 -b4 -b120l2",
    "-n1l1 -n2l2 -n1l1 -n3l3 +nh7 +n60 +n45l2 +n80 -n2l2 -n4l4 -n6",
    "-n4l4 -n5l5 +nh9 +n38 +n25 +n9 +n120l4 +n33 -n3l3 -n8l8 -n7l1",
    "-n2l2 -n9l9 -n1 +n200 +n75l5 +n18 +n64 -n5l5 -n3 -n2l2",
    "-n6l6 -n2 -n3l2 +nh6 +n28 +n41 -n12l12 +n55 +n90 -n4l3 -n9l7",
    "-b5l5 +nh5 +n31 +n4 +n46 -b20 +n58 +n7 +n22 -b60 -b35l1",
    "-n3l3 -n10l10 -n15l14 -n8l8 -n20l18 -n2l2 -n5l5",
    "-b4l4 -n3 -b70 -n2l2 -b15",
    "+n55 +n30 +n12 +n70",
    "-n2l2 -n2l2 +n35 +n3 +n85 +n40 -n10l10 -n4",
)

# --- reading a page into blocks ----------------------------------------------------------

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']*)))?")
_WORDS = re.compile(r"[A-Za-z][a-z]*|[0-9]+")
_CLOSERS = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def tokens(page: str) -> Iterator[tuple[str, str, dict]]:
    """("text", text, {}), ("start", element, attributes) and ("end", element, {})
    in page order; raw elements are left out with their content."""
    at, n, unclosed = 0, len(page), set()
    while at < n:
        low = page.find("<", at)
        if low < 0:
            yield "text", page[at:], {}
            return
        if low > at:
            yield "text", page[at:low], {}
        if page.startswith("<!--", low):
            end = page.find("-->", low + 2)
            at = n if end < 0 else end + 3
            continue
        close = page.startswith("/", low + 1)
        name = _NAME.match(page, low + 1 + close)
        if name is None:
            if page[low + 1:low + 2] in ("!", "?", "/"):
                end = page.find(">", low)
                at = n if end < 0 else end + 1
            else:  # a bare sign
                yield "text", "<", {}
                at = low + 1
            continue
        attributes, at = {}, name.end()
        while at < n and page[at] != ">":
            a = _ATTRIBUTE.match(page, at)
            if a is None or a.end() == at:
                at += 1
                continue
            at = a.end()
            key, value = a.group(1).lower(), next((g for g in a.groups()[1:] if g is not None), "")
            if at < n and page[at] in "\"'" and not value and page[a.end() - 1] != page[at]:
                # A quote that nothing closes: the value ends with the tag.
                at += 1
            attributes.setdefault(key, value)
        at += 1
        element = name.group().lower()
        if close:
            yield "end", element, {}
        else:
            yield "start", element, attributes
            if element in RAW and element not in unclosed:
                end = _CLOSERS[element].search(page, at)
                if end is None:
                    if element in ("script", "style", "title", "textarea"):
                        return  # the rest of the page is inside it
                    unclosed.add(element)
                else:
                    at = page.find(">", end.end())
                    at = n if at < 0 else at + 1
                    yield "end", element, {}


def name_words(attributes: dict) -> list[str]:
    return [w.lower() for key in ("class", "id") for w in _WORDS.findall(attributes.get(key, ""))]


def place_of(element: str, attributes: dict, in_article: bool) -> tuple[bool, int]:
    """(boilerplate container, rank as main region: 2 article, 1 main or content)."""
    names, role = name_words(attributes), attributes.get("role", "").lower()
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True, 0
    if element in ("article", "main"):
        boiler = any(w in BOILER_ARTICLES for w in names)
        return boiler, 0 if boiler else 2 if element == "article" else 1
    if element in ("html", "body"):
        return False, 0
    if element in BOILER_ELEMENTS or role in BOILER_ROLES or any(w in BOILER_NAMES for w in names):
        return True, 0
    if (element == "header" or "header" in names) and not in_article:
        return True, 0
    if role == "article" or attributes.get("itemprop", "").lower() == "articlebody":
        return False, 2
    return False, int(role == "main" or any(w in CONTENT_NAMES for w in names))


#: Inside a form only (some pages stand in one as a whole, so an article in it
#: counts), or inside any other boilerplate container.
FORM, CONTAINER = 1, 2


class Block:
    __slots__ = ("text", "words", "linked", "heading", "boiler", "rank")

    def __init__(self, text: str, words: int, linked: int, heading: bool, boiler: bool, rank: int):
        self.text, self.words, self.linked, self.heading, self.boiler, self.rank = text, words, linked, heading, boiler, rank


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    pieces: list[str] = []
    linked: list[str] = []
    # Open block-level elements: name, inside boilerplate, rank of the main region, inside a heading.
    stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
    opened: dict[str, int] = {}
    link = 0  # how many elements were open when the open link began

    def flush() -> None:
        words = "".join(pieces).split()
        if words:
            _, boiler, rank, heading = stack[-1]
            in_links = len("".join(linked).split())
            out.append(Block(" ".join(words), len(words), min(in_links, len(words)), heading, boiler > 0, rank))
        pieces.clear()
        linked.clear()

    def pop() -> None:
        nonlocal link
        opened[stack.pop()[0]] -= 1
        if len(stack) < link:  # the element that holds an open link has ended
            link = 0

    for kind, value, attributes in tokens(page):
        if kind == "text":
            value = html.unescape(value)
            pieces.append(value)
            if link:
                linked.append(value)
        elif value in INLINE:
            if value == "a":
                link = len(stack) if kind == "start" else 0
                linked.append(" ")
            elif value == "br":
                pieces.append(" ")
                linked.append(" ")
        elif value in VOID:
            if value == "hr":
                flush()
        elif kind == "start":
            flush()
            while stack[-1][0] == "p" or (stack[-1][0] in HEADINGS and value in HEADINGS):
                pop()
            for group in SIBLINGS:
                if value in group:
                    # The nearest open list or table bounds the search.
                    depth = len(stack) - 1
                    while depth > 0 and stack[depth][0] not in group and stack[depth][0] not in LISTS and len(stack) - depth < 32:
                        depth -= 1
                    if stack[depth][0] in group:
                        while len(stack) > depth:
                            pop()
            if value not in RAW:
                _, boiler, rank, heading = stack[-1]
                here, level = place_of(value, attributes, rank == 2)
                if boiler == FORM and level == 2:
                    boiler = 0
                boiler = max(boiler, FORM if here and value == "form" else CONTAINER if here else 0)
                stack.append((value, boiler, 0 if boiler else max(rank, level), heading or value in HEADINGS))
                opened[value] = opened.get(value, 0) + 1
        else:
            flush()
            if opened.get(value, 0) > 0:
                while stack[-1][0] != value:
                    pop()
                pop()
    flush()
    return out


#: The figures a tree may ask about, in order.
FIGURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "heading", "boiler", "region")


def figures(page: Sequence[tuple[int, int, bool, bool, int]]) -> list[tuple]:
    """Per block of (words, words in links, heading, boilerplate, region): its figures
    with those of its neighbours (0 beyond the page's ends)."""
    shallow = [(0, 0.0), *[(w, l / w) for w, l, *_ in page], (0, 0.0)]
    return [(*shallow[i + 1], *shallow[i], *shallow[i + 2], int(b[2]), int(b[3]), b[4]) for i, b in enumerate(page)]


def regions(page: Sequence[Block]) -> list[int]:
    """2 inside the page's main region, 0 outside it, 1 on a page without one."""
    best = max((b.rank for b in page), default=0)
    return [1 if not best else 2 if b.rank == best else 0 for b in page]


# --- the decision tree ---------------------------------------------------------------------

_LABEL = re.compile(r"([+-])([aonb])(h?)(\d+)(?:l(\d+))?")


def labelled_figures(table: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Figures and labels of a labelled table's blocks."""
    x, y = [], []
    for line in table:
        found = [_LABEL.fullmatch(w) for w in line.split()]
        if not all(found):
            raise ValueError(f"not a line of labelled blocks: {line!r}")
        places = {m.group(2) for m in found}
        known = bool(places & {"a", "o"})
        region = {"a": 2, "o": 0, "n": 1, "b": 0 if known else 1}
        x += figures([(int(m.group(4)), int(m.group(5) or 0), bool(m.group(3)), m.group(2) == "b", region[m.group(2)]) for m in found])
        y += [m.group(1) == "+" for m in found]
    return np.array(x, dtype=float), np.array(y)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2):
    """A decision tree by Gini gain: (figure, threshold, low branch, high branch) or
    a leaf's answer. Ties go to the earlier figure and the lower threshold."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return bool(share >= 0.5)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            if min(low.sum(), (~low).sum()) < least:
                continue
            impurity = sum(part.sum() * y[part].mean() * (1 - y[part].mean()) for part in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut), low)
    if best is None or best[0] >= len(y) * share * (1 - share) - 1e-12:
        return bool(share >= 0.5)
    _, f, cut, low = best
    return f, cut, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def answer(tree, block: tuple) -> bool:
    while not isinstance(tree, bool):
        f, cut, low, high = tree
        tree = low if block[f] <= cut else high
    return tree


def main_text(page: str, tree) -> str:
    found = blocks(page)
    judged = figures([(b.words, b.linked, b.heading, b.boiler, r) for b, r in zip(found, regions(found))])
    return "\n".join(b.text for b, seen in zip(found, judged) if answer(tree, seen))


def extract(df: DataFrame, html_column: str = "html", table: Sequence[str] = LABELLED) -> DataFrame:
    """``df`` with ``text`` (main text of the page) and ``n_chars`` (its code points)."""
    tree = grow(*labelled_figures(table))
    ship_package(df.sparkSession)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p, tree) if p else "" for p in batch], dtype=object)

    out = df.withColumn("__text", run(F.col(f"`{html_column}`")))
    out = without(out, ["text", "n_chars"]).withColumnRenamed("__text", "text")
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
