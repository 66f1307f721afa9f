"""Alignment of two tokenizers' tokens over the same text, and its corpus counts.

Tokenizer A is a byte-level BPE file of the tokenizers library and reads a space
before the text; B is a sentencepiece BPE model, which adds that space itself.
Both token sequences then spell the same bytes. Their byte ranges are aligned with
``pandas.merge_asof``, keyed by the stretch of text: each token's start finds the
other side's token that covers it, and the union of both directions is every
overlapping pair. Overlapping tokens that end at the same byte are linked, and the
equal ends cut the text into groups.

A text is cut before a single space between visible characters. No token of
either side crosses such a place (A's split pattern starts a piece there, and no
piece of B has its space mark inside), so both sides end there and the stretches
are aligned one by one: equal stretches once for each worker memory (bounded, by
number and length). Long texts are worked off in parts of bounded size; only a
stretch without any such place is taken whole.

Corpus counts (``align_corpus``): how many links of the whole corpus hold an (A id,
B id) pair, and for each link whether its pair is its B id's most frequent one.
Each document's links are written once, as packed ids. They are counted in the
tasks, combined, and added up by Spark. The most frequent pairs (at most ``HEAVY`` of
them, cut at a count by a histogram) go with the pass over the written links as one
sorted table of that bounded size, which answers nearly all links where they
stand; the links of all other pairs meet their counts in a join, in which no pair
is frequent any more.

Defined cases. Null and empty texts, and texts whose A or B bytes are not the
space and the text (a text with U+2581, which B reads as a space), have no tokens:
zeros and an empty ``groups_sha256``. Repeated rows and equal ids count as rows
each. Columns named like a result are replaced, all others pass through; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import namedtuple
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordstar.llm.common import without
from ordstar.llm.token_counts import _SYMBOL, PIECES, Memory
from ordstar.session import materialize, ship_package

#: Distinct stretches that each half of a worker's memory holds, and their longest length.
REMEMBERED = 150_000
REMEMBERED_CHARS = 64
#: Characters worked off at once.
PART_CHARS = 500_000
#: Pairs whose counts go with the job (17 bytes each).
HEAVY = 1 << 17

#: Before a single space between visible characters.
_CUT = re.compile(r"(?<=[!-~\w])(?= [!-~\w])")
#: A stretch that such a place may both precede and follow.
_JOINS = re.compile(r" [!-~\w](?:.*[!-~\w])?\Z", re.DOTALL).match
#: Characters of stretches encoded in one call of the libraries.
JOINED_CHARS = 4_096
_ALIGNERS: dict = {}


#: One stretch's alignment: its groups as text, its numbers of tokens, its links (A id
#: and B id packed into a long), its pairs of overlapping token positions, and
#: False where a side's bytes are not the stretch.
Stretch = namedtuple("Stretch", "groups n_a n_b links overlaps right")


class Aligner:
    def __init__(self, spec: bytes, model: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte_of = {s: bytes([v]) for v, s in _SYMBOL.items()}
        model_a = json.loads(spec)["model"]
        vocab = model_a["vocab"]
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = b"".join(byte_of.get(c, c.encode("latin-1", "replace")) for c in token)
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.written = np.array([str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))], dtype=object)
        self.ranked = self._ranked(model_a)
        #: A pair travels as A id times the number of B ids plus B id.
        self.packing = "<u4" if len(self.a_bytes) * len(self.b_bytes) < 1 << 32 else "<i8"
        self.memory = Memory(REMEMBERED)

    def _ranked(self, model: dict):
        """The rank encoder of A's vocabulary, where merges go in the order of the ids they
        make (they are ranks then); else None. It gives the same ids, sooner."""
        import tiktoken

        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        made = [model["vocab"][left + right] for left, right in pairs]
        if made != sorted(set(made)):
            return None
        ranks = {token: i for i, token in enumerate(self.a_bytes) if token}
        return tiktoken.Encoding("a", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Up to U+024F letters and digits are the same in every Unicode version, so the
        rank encoder may split such texts; all others are the library's."""
        slow = texts if self.ranked is None else [t for t in texts if max(t, default="") >= "\u0250"]
        ids = iter([e.ids for e in self.a.encode_batch(slow, add_special_tokens=False)] if slow else [])
        if self.ranked is None:
            return list(ids)
        return [next(ids) if max(t, default="") >= "\u0250" else self.ranked.encode_ordinary(t) for t in texts]

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("\u2581", " ").encode("utf-8")

    def stretches(self, texts: list[str]) -> dict[str, Stretch]:
        """The alignment of every distinct stretch of ``texts``."""
        known, new = {}, []
        for t in set(texts):
            s = self.memory.find(t)
            if s is None:
                new.append(t)
            else:
                known[t] = s
        for t, s in zip(new, self.align(new)):
            known[t] = s
            if len(t) <= REMEMBERED_CHARS:
                self.memory.keep(t, s)
        return known

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Both sides' ids of texts that start with the space which both read, and
        whether both spell the text (no ids where not)."""
        a = self.encode_a(texts)
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        right = []
        for i, t in enumerate(texts):
            spelled = t.encode("utf-8")
            right.append(b"".join(map(self.a_bytes.__getitem__, a[i])) == spelled == b"".join(map(self.b_bytes.__getitem__, b[i])))
            if not right[-1]:
                a[i], b[i] = [], []
        return a, b, right

    def align(self, texts: list[str]) -> list[Stretch]:
        """Each text starts with the space that both sides read."""
        if not texts:
            return []
        # Stretches that may stand next to each other in a text are encoded as one text.
        rows, members = [], []
        for i, t in enumerate(texts):
            joins = _JOINS(t) is not None
            if joins and members and members[-1][1] and len(rows[-1]) < JOINED_CHARS:
                rows[-1] += t
                members[-1][0].append(i)
            else:
                rows.append(t)
                members.append(([i], joins))
        a_rows, b_rows, right = self.encode(rows)
        for r in [r for r, ok in enumerate(right) if not ok and len(members[r][0]) > 1]:
            alone = self.encode([texts[i] for i in members[r][0]])
            a_rows[r], b_rows[r], right[r] = [k for ids in alone[0] for k in ids], [k for ids in alone[1] for k in ids], alone[2]
        order, spelled = [], []
        for (own, _), ok in zip(members, right):
            order += own
            spelled += ok if isinstance(ok, list) else [ok] * len(own)
        # Texts lie one behind the other, so starts rise over all of them.
        ends = np.cumsum([len(texts[i].encode("utf-8")) if ok else 0 for i, ok in zip(order, spelled)])
        a, b = self._frame(a_rows, self.a_bytes, ends, "a"), self._frame(b_rows, self.b_bytes, ends, "b")
        found = pd.merge_asof(a, b[["key", "start", "at_b"]], on="start", by="key")[["at_a", "at_b"]]
        other = pd.merge_asof(b, a[["key", "start", "at_a"]], on="start", by="key")[["at_a", "at_b"]]
        both = pd.concat([found, other]).to_numpy(dtype=np.int64)
        pairs = np.unique(both[:, 0] << 32 | both[:, 1])
        at_a, at_b = pairs >> 32, pairs & 0xFFFFFFFF
        equal = a["end"].to_numpy()[at_a] == b["end"].to_numpy()[at_b]
        a_last, b_last = at_a[equal], at_b[equal]
        packed = (a["id"].to_numpy()[a_last] * len(self.b_bytes) + b["id"].to_numpy()[b_last]).tobytes()
        groups = self._groups(a, b, a["end"].to_numpy()[a_last], len(order))

        places = np.arange(len(order) + 1)
        a_first, b_first = np.searchsorted(a["key"], places), np.searchsorted(b["key"], places)
        first = (np.searchsorted(a["key"].to_numpy()[a_last], places) * 8).tolist()
        pair_first = np.searchsorted(a["key"].to_numpy()[at_a], places).tolist()
        local = np.stack([at_a - a_first[a["key"].to_numpy()[at_a]], at_b - b_first[b["key"].to_numpy()[at_b]]], axis=1).astype(np.int32).tobytes()
        n_a, n_b = np.diff(a_first).tolist(), np.diff(b_first).tolist()
        out: list[Stretch] = [None] * len(texts)  # type: ignore[list-item]
        for k, i in enumerate(order):
            out[i] = Stretch(groups[k], n_a[k], n_b[k], packed[first[k]:first[k + 1]], local[8 * pair_first[k]:8 * pair_first[k + 1]], spelled[k])
        return out

    def _frame(self, ids: list[list[int]], token_bytes: list[bytes], text_ends: np.ndarray, side: str) -> pd.DataFrame:
        flat = np.array(list(chain.from_iterable(ids)), dtype=np.int64)
        lens = np.array(list(map(len, map(token_bytes.__getitem__, flat.tolist()))), dtype=np.int64)
        end = np.cumsum(lens)
        return pd.DataFrame({"key": np.searchsorted(text_ends, end), "id": flat, "start": end - lens, "end": end, f"at_{side}": np.arange(len(flat))})

    def _groups(self, a: pd.DataFrame, b: pd.DataFrame, ends: np.ndarray, count: int) -> list[str]:
        """Every text's groups: ids with commas, a bar between the sides, semicolons."""
        group = np.concatenate([np.searchsorted(ends, a["start"], side="right"), np.searchsorted(ends, b["start"], side="right")])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        key = np.concatenate([a["key"], b["key"]])[order]
        group, side = group[order], side[order]
        signs = np.full(len(order), ",", dtype=object)
        signs[:-1][side[1:] != side[:-1]] = "|"
        signs[:-1][group[1:] != group[:-1]] = ";"
        signs[:-1][key[1:] != key[:-1]] = "\n"
        pieces = np.empty(2 * len(order), dtype=object)
        pieces[0::2], pieces[1::2] = self.written[np.concatenate([a["id"], b["id"]])[order]], signs
        lines = iter("".join(pieces[:-1].tolist()).split("\n"))
        has = np.zeros(count, dtype=bool)
        has[key] = True
        return [next(lines) if h else "" for h in has.tolist()]


def aligner(spec: bytes, model: bytes) -> Aligner:
    key = (hash(spec), hash(model))
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(spec, model)
    return _ALIGNERS[key]


class Aligned:
    """A document's alignment as its parts come in."""

    __slots__ = ("sha", "n_a", "n_b", "links", "right", "groups", "overlaps", "any")

    def __init__(self):
        self.sha, self.n_a, self.n_b, self.right, self.any = hashlib.sha256(), 0, 0, True, False
        self.links: list[np.ndarray] = []
        self.groups: list[str] = []
        self.overlaps: list[np.ndarray] = []

    def link_ids(self) -> np.ndarray:
        return np.concatenate(self.links) if self.links and self.right else np.zeros(0, dtype=np.int64)


def parts(text: str, size: int) -> Iterator[str]:
    """The space and the text in parts of about ``size`` characters, cut at safe places."""
    text, start = " " + text, 0
    while len(text) - start > size:
        m = _CUT.search(text, start + size)
        if not m:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:]


def align_texts(al: Aligner, texts: list[str | None], details: bool = False, size: int = PART_CHARS) -> Iterator[Aligned]:
    """Each text's alignment, in order; ``details`` keeps groups and overlaps."""
    def solve(waiting: list[tuple[Aligned, str]]) -> None:
        cut = [(doc, _CUT.split(part)) for doc, part in waiting]
        known = al.stretches([t for _, ts in cut for t in ts])
        for doc, ts in cut:
            texts_groups, n_a, n_b, links, overlaps, right = zip(*map(known.__getitem__, ts))
            groups = ";".join(texts_groups)
            doc.sha.update((";" if doc.any else "").encode() + groups.encode("ascii"))
            doc.any = True
            doc.right = doc.right and all(right)
            doc.links.append(np.frombuffer(b"".join(links), dtype=np.int64))
            if details:
                doc.groups.append(groups)
                first_a, first_b = doc.n_a, doc.n_b
                for pairs, a, b in zip(overlaps, n_a, n_b):
                    doc.overlaps.append(np.frombuffer(pairs, dtype=np.int32).reshape(-1, 2) + [first_a, first_b])
                    first_a, first_b = first_a + a, first_b + b
            doc.n_a, doc.n_b = doc.n_a + sum(n_a), doc.n_b + sum(n_b)

    done: list[Aligned] = []
    waiting: list[tuple[Aligned, str]] = []
    chars = 0
    for text in texts:
        doc = Aligned()
        for part in parts(text, size) if text else ():
            waiting.append((doc, part))
            chars += len(part)
            if chars >= size:
                solve(waiting)
                waiting, chars = [], 0
        done.append(doc)
        if not waiting:
            yield from done
            done = []
    solve(waiting)
    yield from done


_SLIM = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _slim(doc: Aligned) -> tuple:
    if not doc.right or not doc.any:
        return 0, 0, 0, 0, ""
    n = sum(map(len, doc.links))
    return doc.n_a, doc.n_b, n, n, doc.sha.hexdigest()


def align(df: DataFrame, spec: bytes, model: bytes, text: str = "text") -> DataFrame:
    """``df`` with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``groups``
    (text: A ids, a bar, B ids; semicolons between groups) and ``overlaps`` (every
    pair of overlapping tokens by their positions from 0)."""
    ship_package(df.sparkSession)
    result = T._parse_datatype_string(f"{_SLIM}, groups string, overlaps array<struct<a: int, b: int>>")

    @F.pandas_udf(result)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        al = aligner(spec, model)
        for batch in batches:
            rows = []
            for doc in align_texts(al, batch.tolist(), details=True):
                pairs = np.concatenate(doc.overlaps) if doc.right and doc.overlaps else []
                rows.append((*_slim(doc), ";".join(doc.groups) if doc.right else "", [{"a": int(i), "b": int(j)} for i, j in pairs]))
            yield pd.DataFrame(rows, columns=result.names)

    out = without(df.withColumn("__aligned", run(F.col(f"`{text}`"))), result.names)
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c != "__aligned"], *[F.col(f"__aligned.{n}").alias(n) for n in result.names])


# --- corpus counts --------------------------------------------------------------------------

def linked_rows(df: DataFrame, spec: bytes, model: bytes, text: str, keep_text: bool, names: list[str]) -> DataFrame:
    """``df`` without ``names`` (and ``text``, unless kept), with each document's figures
    and its links, packed ids of four bytes or eight, sorted."""
    import pyarrow as pa

    ship_package(df.sparkSession)
    base = without(df, [n for n in names if n != text.lower()])
    kept = [F.col(f"`{c}`") for c in base.columns if c.lower() not in names and (keep_text or c != text)]
    source = base.select(*kept, F.col(f"`{text}`").cast("string").alias("__text"))  # the text last
    fields = T.StructType([*base.select(*kept).schema.fields, *T._parse_datatype_string(f"{_SLIM}, __links binary").fields])

    def run(batches: Iterator) -> Iterator:
        al = aligner(spec, model)
        for batch in batches:
            rows = [(*_slim(doc), np.sort(doc.link_ids()).astype(al.packing).tobytes()) for doc in align_texts(al, batch.column(batch.num_columns - 1).to_pylist())]
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            values = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns - 1)], *values], names=fields.names)

    return source.mapInArrow(run, fields)


def pair_counts(rows: DataFrame, packing: str) -> DataFrame:
    """``(pair, n)``: the links of all rows by packed pair, combined in the tasks."""
    import pyarrow as pa

    def table(links: list[np.ndarray]):
        pair, n = np.unique(np.concatenate(links) if links else np.zeros(0, dtype=packing), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])

    def run(batches: Iterator) -> Iterator:
        links, held = [], 0
        for batch in batches:
            for b in batch.column(0):
                links.append(np.frombuffer(b.as_py(), dtype=packing))
                held += len(links[-1])
                if held >= 1 << 22:
                    yield table(links)
                    links, held = [], 0
        yield table(links)

    return rows.select("__links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def heavy_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs, sorted, with count and whether best: those above a
    count that at most ``most`` pairs reach, found by a histogram of at most 512
    eighths of powers of two."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    room, lowest = most, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs")).collect(), reverse=True):
        if r["pairs"] > room:
            break
        room, lowest = room - r["pairs"], r["step"]
    rows = counts.filter(step >= lowest).toPandas().sort_values("pair") if lowest is not None else pd.DataFrame({"pair": [], "n": [], "best": []})
    return rows["pair"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), rows["best"].to_numpy(bool)


def align_corpus(df: DataFrame, spec: bytes, model: bytes, text: str = "text", keep_text: bool = True, heavy: int = HEAVY) -> DataFrame:
    """``df`` with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``n_best``
    (links whose pair's corpus count is the highest of its B id, ties included) and
    ``count_sum`` (the pair counts of all links added up)."""
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    packing, b_ids = aligner(spec, model).packing, len(aligner(spec, model).b_bytes)
    rows = materialize(linked_rows(df, spec, model, text, keep_text, names), "alignment-links")
    counts = materialize(pair_counts(rows, packing), "alignment-counts")
    # At most one row for each id of B, a fixed vocabulary.
    side = F.col("pair") % b_ids
    best = counts.groupBy(side.alias("__b")).agg(F.max("n").alias("__best"))
    counts = materialize(counts.join(best, side == F.col("__b")).select("pair", "n", (F.col("n") == F.col("__best")).alias("best")), "alignment-pairs")

    coded = materialize(_looked_up(rows, packing, heavy_pairs(counts, heavy)).withColumn("__row", F.monotonically_increasing_id()), "alignment-rows")
    # The few links of rare pairs meet their counts by a join; the rows of one
    # document are added up again before they go back to it.
    rare = coded.select("__row", F.explode("__pairs").alias("p")).select("__row", "p.pair", F.col("p.n").alias("__times"))
    added = rare.join(counts, "pair").groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("__times")).otherwise(0)).alias("__best"), F.sum(F.col("__times") * F.col("n")).alias("__sum"))
    out = coded.join(added, "__row", "left")
    rest = {"n_best": "__best", "count_sum": "__sum"}
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in names and c != "__links"]
    return out.select(*kept, *[(F.col(n) + F.coalesce(F.col(rest[n]), F.lit(0))).alias(n) if n in rest else F.col(n) for n in names])


def _looked_up(rows: DataFrame, packing: str, top: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """``rows`` with ``n_best`` and ``count_sum`` over the links of the pairs in ``top``, and
    ``__pairs``, the other links counted by pair, instead of ``__links``."""
    import pyarrow as pa

    pair, times, best = top
    slim = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != "__links"], "__links")
    fields = T.StructType([*slim.schema.fields[:-1], *T._parse_datatype_string("n_best long, count_sum long, __pairs array<struct<pair: long, n: long>>").fields])

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            sums, bests, rest, sizes = [], [], [], [0]
            for b in batch.column(batch.num_columns - 1):
                own, n = np.unique(np.frombuffer(b.as_py(), dtype=packing), return_counts=True)
                own = own.astype(np.int64)
                at = np.searchsorted(pair, own)
                hit = at < len(pair)
                hit[hit] = pair[at[hit]] == own[hit]
                at = at[hit]
                bests.append(int(n[hit][best[at]].sum()))
                sums.append(int((n[hit] * times[at]).sum()))
                rest.append((own[~hit], n[~hit]))
                sizes.append(sizes[-1] + int((~hit).sum()))
            flat = [np.concatenate([r[k] for r in rest]) if rest else np.zeros(0, dtype=np.int64) for k in (0, 1)]
            pairs = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in flat], names=["pair", "n"])
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pairs)
            columns = [*[batch.column(i) for i in range(batch.num_columns - 1)], pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=fields.names)

    return slim.mapInArrow(run, fields)
