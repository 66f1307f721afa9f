"""Exact token counts of text prefixes under a byte-level BPE tokenizer.

The pre-tokenizer cuts a text into pieces; merges never cross a piece. Inside
a piece the encoding of every prefix is found by dynamic programming: the
prefix of length i ends in the one token t for which the encoding of the
prefix of length i - len(t) ends in a token p such that the pair (p, t) encodes to
itself; its count is that shorter prefix's count plus one. One pass over a piece
therefore stores the exact count of each of its prefixes, and a text's counts are
the pieces' totals added up.

A text is first cut into chunks of white space followed by visible characters.
No piece crosses such a cut and no lookahead reaches over it, so a chunk's total
does not depend on its neighbours and is remembered for each distinct chunk (a
table of bounded size in each Python worker). Truncation (the longest prefix
within a budget) walks the stored totals and asks the tables of one chunk only.

A prefix that ends inside a chunk is counted as the library counts that prefix
on its own. A white-space run and a cut contraction split differently at a text's
end, so the one or two pieces at the prefix's end are cut anew; a piece that ends
two characters earlier stays as it is, and a long piece's prefixes come from its table.
Truncation adds up piece totals to where the budget is crossed and looks at the
prefixes of the pieces there, so its time goes with the text's length whatever
white space the text has.

Defined cases: null text counts as empty (0 tokens); special-token strings
inside a text are one token, as the library does by default; repeated rows are
counted each; clashing result names replace input columns.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordstar.llm.common import without
from ordstar.session import ship_package

#: Distinct chunks, pieces or token pairs that each half of a memory holds.
REMEMBERED = 250_000

#: Chunks with more characters than this are not remembered.
REMEMBERED_CHARS = 64

#: Pieces with more characters than this have their prefixes looked up in one table.
SHORT_PIECE = 16

#: Pieces with more byte symbols than this are counted bottom up, not remembered.
LONG_PIECE = 200

#: Fixed value: the split pattern of this family of tokenizers.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The printable symbol that stands for each byte in the vocabulary: printable
#: Latin-1 bytes stand for themselves, the others take code points from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SYMBOL = {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}

_CHUNK = re.compile("[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
#: Characters that some definition of white space holds beyond the four above.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏    　﻿]")
_COUNTERS: dict = {}


class Memory:
    """A memory of bounded size: when the young half is full the old half is
    forgotten, so what keeps being asked for stays."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.young, self.old = most, {}, {}

    def find(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.keep(key, value)
        return value

    def keep(self, key, value):
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value
        return value


class PrefixCounter:
    """Counts for one tokenizer file (the library's JSON format)."""

    def __init__(self, spec: bytes):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec.decode("utf-8"))
        spec_json = json.loads(spec)
        self.cut = self.library.pre_tokenizer.pre_tokenize_str
        self.pattern = regex.compile(PIECES)
        vocab = spec_json["model"]["vocab"]
        self.vocab: dict[str, int] = vocab
        self.rank = {}
        for i, m in enumerate(spec_json["model"]["merges"]):
            self.rank[tuple(m.split(" ")) if isinstance(m, str) else tuple(m)] = i
        special = sorted((t["content"] for t in spec_json["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.halves = {l + r: (l, r, i) for (l, r), i in reversed(self.rank.items())}
        self.edges: dict[tuple[str, bool], list[tuple[str, float]]] = {}
        self.heads = {t[:i] for t in vocab for i in range(1, len(t) + 1)}
        self.stays, self.endings, self.chunks = Memory(), Memory(), Memory()
        self.last_piece: tuple[str, list[int]] = ("", [])

    def edge(self, token: str, right: bool) -> list[tuple[str, float]]:
        """The symbols that stand at a token's right (or left) edge while it is
        merged, first byte symbol to whole token, each with the rank of the merge
        that uses it up."""
        key = (token, right)
        out = self.edges.get(key)
        if out is None:
            out, part, ends = [], token, float("inf")
            while True:
                out.append((part, ends))
                if part not in self.halves:
                    break
                left_half, right_half, ends = self.halves[part]
                part = right_half if right else left_half
            out.reverse()
            self.edges[key] = out
        return out

    def pair_stays(self, left: str, right: str) -> bool:
        """Whether the two tokens next to each other encode to themselves: no
        merge over their border comes before the merges on either side of it.
        Merges go by rank, equal ranks from the left."""
        key = (left, right)
        known = self.stays.find(key)
        if known is None:
            a, b, i, j, known = self.edge(left, True), self.edge(right, False), 0, 0, True
            while True:
                (x, x_ends), (y, y_ends) = a[i], b[j]
                over = self.rank.get((x, y))
                if over is not None and over < x_ends and over <= y_ends:
                    known = False
                    break
                if i + 1 == len(a) and j + 1 == len(b):
                    break
                if x_ends <= y_ends:
                    i += 1
                else:
                    j += 1
            self.stays.keep(key, known)
        return known

    def ending(self, prefix: str) -> tuple[str, int]:
        """Last token and count of a prefix's encoding, remembered for every
        prefix that any piece has asked for."""
        known = self.endings.find(prefix)
        if known is None:
            vocab = self.vocab
            for start in range(len(prefix)):
                token = prefix[start:]
                if token in vocab:
                    last, count = self.ending(prefix[:start]) if start else ("", 0)
                    if not last or self.pair_stays(last, token):
                        known = (token, count + 1)
                        break
            else:  # a byte outside the vocabulary: the library gives it no token
                known = ("", self.ending(prefix[:-1])[1] if len(prefix) > 1 else 0)
            self.endings.keep(prefix, known)
        return known

    def piece_total(self, piece: str) -> int:
        return self.ending(piece)[1] if len(piece) <= LONG_PIECE else self.piece_counts(piece)[-1]

    def piece_counts(self, piece: str) -> list[int]:
        """Counts of the piece's prefixes of 1, 2, ... byte symbols, bottom up;
        time and memory go with the piece's length. The last long piece's stay."""
        if self.last_piece[0] != piece:
            self.last_piece = (piece, self._piece_counts(piece))
        return self.last_piece[1]

    def _piece_counts(self, piece: str) -> list[int]:
        vocab, heads, stays = self.vocab, self.heads, self.pair_stays
        last: list[str] = [""]
        found = [0]
        open_starts: list[int] = []  # from here to the end so far a token may begin
        for end in range(1, len(piece) + 1):
            open_starts.append(end - 1)
            open_starts = [s for s in open_starts if piece[s:end] in heads]
            for start in open_starts:
                token = piece[start:end]
                if token in vocab and (not last[start] or stays(last[start], token)):
                    last.append(token)
                    found.append(found[start] + 1)
                    break
            else:
                last.append("")
                found.append(found[-1])
        return found[1:]

    def pieces_of(self, text: str) -> list[str]:
        """The pre-tokenizer's pieces in the vocabulary's byte symbols. Up to
        U+024F letters and digits are the same in every Unicode version, so the
        pattern is applied here; any other text is cut by the library itself."""
        if text.isascii() and text[:1] == " " and text[1:].isalpha():
            return [_SYMBOL[32] + text[1:]]
        if text and max(text) < "\u0250":
            return [p.encode("utf-8").decode("latin-1").translate(_SYMBOL) for p in self.pattern.findall(text)]
        return [p for p, _ in self.cut(text)]

    def spans_of(self, text: str) -> list[tuple[int, int, str]]:
        """``pieces_of`` with the characters from and to which each piece goes."""
        if text and max(text) < "\u0250":
            return [(m.start(), m.end(), m.group().encode("utf-8").decode("latin-1").translate(_SYMBOL)) for m in self.pattern.finditer(text)]
        return [(start, end, p) for p, (start, end) in self.cut(text)]

    def chunk_total(self, chunk: str) -> int:
        total = self.chunks.find(chunk)
        if total is None:
            total = sum(self.piece_total(p) for p in self.pieces_of(chunk))
            if len(chunk) <= REMEMBERED_CHARS:
                self.chunks.keep(chunk, total)
        return total

    def sections(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text's stretches; True for a special token's string."""
        at = 0
        if self.special is not None:
            for m in self.special.finditer(text):
                if m.start() > at:
                    yield text[at:m.start()], False
                yield m.group(), True
                at = m.end()
        if at < len(text):
            yield text[at:], False

    def chunks_of(self, text: str) -> list[str]:
        """Independent chunks; a text with rarer white space stays whole."""
        return [text] if _ODD_SPACE.search(text) else _CHUNK.findall(text)

    def ordinary(self, text: str) -> int:
        n = 0
        for c in self.chunks_of(text):
            t = self.chunks.young.get(c)
            n += self.chunk_total(c) if t is None else t
        return n

    def total(self, text: str) -> int:
        return sum(1 if special else self.ordinary(part) for part, special in self.sections(text))

    def totals_before(self, spans: list[tuple[int, int, str]]) -> list[int]:
        """Tokens of the pieces before each piece, and of all of them."""
        return [0, *accumulate(self.piece_total(p) for *_, p in spans)]

    def prefixes_to(self, chunk: str, spans: list[tuple[int, int, str]], before: list[int], k: int) -> list[int]:
        """Counts of the chunk's prefixes that end inside or with piece ``k``."""
        def anew(first: int, end: int) -> int:
            # Pieces before ``first`` end two characters or more before the prefix does.
            return before[first] + sum(self.piece_total(p) for p in self.pieces_of(chunk[spans[first][0]:end]))

        start, end, piece = spans[k]
        out = [anew(max(k - 1, 0), start + 1)]
        if end - start <= SHORT_PIECE:
            return out + [anew(k, i) for i in range(start + 2, end + 1)]
        # A prefix of a long piece is one piece, whose count stands in the table.
        counts, symbols = self.piece_counts(piece), 0
        for i in range(start, end):
            symbols += len(chunk[i].encode("utf-8"))
            if i > start:
                out.append(before[k] + counts[symbols - 1])
        return out

    def prefix_in_chunk(self, chunk: str) -> list[int]:
        """Counts of the chunk's prefixes of 1, 2, ... characters."""
        spans = self.spans_of(chunk)
        before = self.totals_before(spans)
        return [n for k in range(len(spans)) for n in self.prefixes_to(chunk, spans, before, k)]

    def fit_in_chunk(self, chunk: str, budget: int) -> int:
        """Characters of the chunk's longest prefix within the budget. No prefix has
        less tokens than the pieces that end two characters before it, so the
        search goes down from the last piece that this leaves open."""
        spans = self.spans_of(chunk)
        before = self.totals_before(spans)
        for k in range(min(bisect_right(before, budget), len(spans) - 1), -1, -1):
            counts = self.prefixes_to(chunk, spans, before, k)
            for i in range(len(counts) - 1, -1, -1):
                if counts[i] <= budget:
                    return spans[k][0] + i + 1
        return 0

    def prefix_counts(self, text: str) -> list[int]:
        """The token count of every prefix of 1, 2, ... characters. A special
        token's string counts one from its last character on; before that its
        characters count as ordinary text."""
        out, base, before = [], 0, ""
        for part, special in self.sections(text):
            if special:
                start = base - self.ordinary(before)
                out += [start + self.ordinary(before + part[:i]) for i in range(1, len(part))] + [base + 1]
                before = ""
            else:
                out += [base + x for x in self._chunk_prefixes(part)]
                before = part
            base = out[-1]
        return out

    def _chunk_prefixes(self, part: str) -> list[int]:
        out, base = [], 0
        for c in self.chunks_of(part):
            out += [base + x for x in self.prefix_in_chunk(c)]
            base += self.chunk_total(c)
        return out

    def fit(self, text: str, budget: int) -> int:
        """Characters of the longest prefix that takes at most ``budget`` tokens
        (a special token's string is taken whole or not at all)."""
        done, best, used = 0, 0, 0
        for part, special in self.sections(text):
            chunks = [part] if special else self.chunks_of(part)
            for c in chunks:
                t = 1 if special else self.chunk_total(c)
                # A cut chunk can cost more than the whole one (a split word), never
                # fewer tokens than none: look inside only near the budget.
                if used + t <= budget:
                    best = done + len(c)
                elif used <= budget:
                    best = max(best, done + (0 if special else self.fit_in_chunk(c, budget - used)))
                if used > budget:
                    return best
                used += t
                done += len(c)
        return best


def counter(spec: bytes) -> PrefixCounter:
    key = (hash(spec), len(spec))
    if key not in _COUNTERS:
        _COUNTERS[key] = PrefixCounter(spec)
    return _COUNTERS[key]


def token_counts(df: DataFrame, spec: bytes, text: str = "text", budgets: Sequence[int] = (),
                 prefixes: bool = False) -> DataFrame:
    """``df`` with ``n_tokens`` and, for each budget B, ``fit_B``: how many
    characters the longest prefix within B tokens has. With ``prefixes`` also
    ``prefix_tokens``, the token count of every prefix by its number of characters;
    ``F.element_at`` and ``F.filter`` on it answer any later budget question
    without the tokenizer.
    """
    ship_package(df.sparkSession)
    fields = [T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField(f"fit_{b}", T.LongType()) for b in budgets]
    fields += [T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))] * prefixes

    @F.pandas_udf(T.StructType(fields))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = counter(spec)
        for batch in batches:
            texts = [t or "" for t in batch]
            totals = [c.total(t) for t in texts]
            out = {"n_tokens": totals}
            for b in budgets:
                out[f"fit_{b}"] = [len(t) if n <= b else c.fit(t, b) for t, n in zip(texts, totals, strict=True)]
            if prefixes:
                out["prefix_tokens"] = [c.prefix_counts(t) for t in texts]
            yield pd.DataFrame(out, columns=[f.name for f in fields])

    names = [f.name for f in fields]
    counted = df.withColumn("__counts", run(F.col(f"`{text}`")))
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in {n.lower() for n in names}]
    return counted.select(*kept, *[F.col(f"__counts.{n}").alias(n) for n in names])
