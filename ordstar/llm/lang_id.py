"""Language identification by character language models.

Each language has an interpolated Kneser-Ney model over lower-cased letters
(everything else is one separator symbol). A text's language is the one whose
model gives it the lowest cross-entropy per symbol.

Models. Four symbols of 16 bits make one 64-bit key. Counts of four-symbol keys
in a language's sample give all orders: the highest from the counts, lower ones
from continuation counts (how many different symbols precede), with one discount
per order, down to a uniform floor. The n-grams of all languages are kept in one sorted key array per order,
beside a matrix of log probabilities with a column per language, so one binary search
per symbol serves every language. A key no language has seen falls back to the
context's backoff weight and the next shorter key.

Fit. A bounded sample of labelled texts: per language the ``PER_LANGUAGE`` distinct texts (fewer when there
are very many languages: ``MOST_ROWS`` in all) with the lowest hash; copies count once,
whatever their ids. A text of more than ``MOST_CHARS`` characters gives that many
of them, from a place its hash chooses, so a language of long texts is learned as well. Four fifths are
counted, one task per language; the rest calibrate. Prediction covers all rows and whole texts.

Calibration. ``score`` is the posterior under equal priors with cross-entropies
scaled by one factor, chosen on the calibration rows. ``accepted`` is false where the
cross-entropy lies further above the language's mean than its spread over calibration
rows and the symbol noise of a text this long allow (at least ``SIGMAS`` deviations, more if a
calibration row needed more, and ``MARGIN`` bits), so texts like those learned from stay.

Defined cases: null text or one without a letter: ``und``, score 0, not accepted;
no labelled row at all: every text is ``und``; null languages are not learned;
repeated rows count once in the sample and are predicted each; equal cross-entropies take the first
language by name; clashing column names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordstar.llm.common import without
from ordstar.session import materialize, ship_package

UNKNOWN = "und"
PER_LANGUAGE, MOST_ROWS, MOST_CHARS = 300, 4_800, 20_000
ORDER = 4
SIGMAS = 8.0
#: Bits per symbol above a language's mean that are never rejected: texts with
#: passages of another learned language stay below, other languages and noise lie above.
MARGIN = 1.5
#: Symbols handled at once.
STRETCH = 1 << 20

_FOLD: list = []


def fold_table() -> np.ndarray:
    """Code point -> symbol: a letter's lower-case code point, 1 for letters beyond
    16 bits, 0 for everything else."""
    if not _FOLD:
        table = np.zeros(0x110000, dtype=np.uint16)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 and ord(low) < 0x10000 else (cp if cp < 0x10000 else 1)
        _FOLD.append(table)
    return _FOLD[0]


def symbols(text: str) -> np.ndarray:
    """The text's symbols: letters, and one 0 for each run of anything else; a 0
    closes the text, a leading one is dropped (the start is a separator anyway)."""
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ids = np.append(fold_table()[cps], np.uint16(0))
    keep = ids != 0
    keep[1:] |= ids[:-1] != 0
    return ids[keep]


def keys_of(ids: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """The four-symbol key that ends at each symbol; ``before``: the three symbols
    in front (separators at a text's start)."""
    x = np.concatenate([np.zeros(3, np.uint64) if before is None else before, ids.astype(np.uint64)])
    return x[:-3] << np.uint64(48) | x[1:-2] << np.uint64(32) | x[2:-1] << np.uint64(16) | x[3:]


@dataclass
class Model:
    """``keys[n]``, ``logs[n]``: sorted n-symbol keys and log2 probabilities, a column per
    language; ``contexts[n]``, ``backs[n]``: sorted contexts of n symbols and log2 backoff weights."""

    languages: list[str]
    keys: dict[int, np.ndarray]
    logs: dict[int, np.ndarray]
    contexts: dict[int, np.ndarray]
    backs: dict[int, np.ndarray]
    floor: np.ndarray
    factor: float = 8.0
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    noise: np.ndarray | None = None
    sigmas: np.ndarray | None = None

    def symbol_logs(self, keys: np.ndarray) -> np.ndarray:
        """log2 probability of each key's last symbol after the others, per language."""
        out = np.zeros((len(keys), len(self.languages)))
        todo = np.arange(len(keys))
        part = keys
        for n in range(ORDER, 0, -1):
            part = part & np.uint64((1 << 16 * n) - 1) if n < ORDER else part
            at, found = _find(self.keys[n], part)
            out[todo[found]] += self.logs[n][at[found]]
            todo, part = todo[~found], part[~found]
            if not len(todo):
                return out
            if n > 1:
                at, seen = _find(self.contexts[n - 1], part >> np.uint64(16))
                out[todo[seen]] += self.backs[n - 1][at[seen]]
        out[todo] += self.floor
        return out

    def entropies(self, text: str) -> tuple[np.ndarray, int]:
        """Total -log2 probability per language and the number of symbols."""
        total, n, before = np.zeros(len(self.languages)), 0, None
        for at in range(0, max(len(text), 1), STRETCH):
            ids = symbols(text[at:at + STRETCH])
            if not ids.any():
                continue
            total -= self.symbol_logs(keys_of(ids, before)).sum(axis=0)
            n += len(ids)
            before = np.concatenate([np.zeros(3, np.uint64), ids[-3:].astype(np.uint64)])[-3:]
        return total, n


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def fit(languages: list[str], counted: dict[str, tuple[np.ndarray, np.ndarray]], alphabet: int) -> Model:
    """The models of all languages from their four-symbol keys and counts."""
    keys = {n: np.unique(np.concatenate([counted[lang][0] & np.uint64((1 << 16 * n) - 1) for lang in languages])) for n in range(1, ORDER + 1)}
    contexts = {n: np.unique(np.concatenate([keys[n + 1] >> np.uint64(16)])) for n in range(1, ORDER)}
    logs = {n: np.zeros((len(keys[n]), len(languages)), np.float32) for n in keys}
    backs = {n: np.zeros((len(contexts[n]), len(languages)), np.float32) for n in contexts}
    floor = np.zeros(len(languages))
    for j, lang in enumerate(languages):
        grams, counts = counted[lang][0], counted[lang][1].astype(np.float64)
        tables = {ORDER: (grams, counts)}
        for n in range(ORDER - 1, 0, -1):  # continuation counts
            tables[n] = tuple(a.astype(t) for a, t in zip(np.unique(tables[n + 1][0] & np.uint64((1 << 16 * n) - 1), return_counts=True), (np.uint64, np.float64), strict=True))
        lower = np.full(len(keys[1]), 1.0 / alphabet)
        for n in range(1, ORDER + 1):
            grams, counts = tables[n]
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5
            heads, where = np.unique(grams >> np.uint64(16), return_inverse=True)
            total = np.bincount(where, weights=counts)
            left = np.bincount(where) * discount / total
            at, seen = _find(grams, keys[n])
            here, known = _find(heads, keys[n] >> np.uint64(16))
            weight = np.where(known, left[here], 1.0)
            own = np.where(seen, np.maximum(counts[at] - discount, 0) / total[here], 0.0)
            if n > 1:
                before, _ = _find(keys[n - 1], keys[n] & np.uint64((1 << 16 * (n - 1)) - 1))
                base = lower[before]
                at, seen = _find(heads, contexts[n - 1])
                backs[n - 1][:, j] = np.log2(np.where(seen, left[at], 1.0))
            else:
                base = lower
                floor[j] = np.log2(left[0] / alphabet)
            lower = own + weight * base
            logs[n][:, j] = np.log2(lower)
    return Model(languages, keys, logs, contexts, backs, floor)


def _sample(train: DataFrame, per_language: int) -> DataFrame:
    """(lang, text, fold) of a language's distinct texts with the lowest hash, written to
    the shared folder. Equal texts meet before they are ranked; the window ranks narrow
    rows and Spark cuts its groups before the shuffle."""
    tagged = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("text").alias("h"))
    spare = F.length("text") - MOST_CHARS
    piece = F.when(spare > 0, F.col("text").substr((F.pmod(F.xxhash64("h"), F.greatest(spare, F.lit(1))) + 1).cast("int"), F.lit(MOST_CHARS))).otherwise(F.col("text"))
    tagged = tagged.withColumn("text", piece)
    order = Window.partitionBy("lang").orderBy("h")
    distinct = tagged.select("lang", "h").distinct()
    picked = materialize(distinct.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_language), "lang-picked")
    found = tagged.join(picked, ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"), F.min("nth").alias("nth"))
    return materialize(found.select("lang", "text", (F.col("nth") % 5).alias("fold")), "lang-sample")


def learn(train: DataFrame) -> Model | None:
    """A calibrated model of the labelled rows ``train`` (``key``, ``lang``, ``text``);
    None without any. What reaches the driver is bounded by the sample."""
    ship_package(train.sparkSession)
    languages = [r["lang"] for r in train.select("lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).distinct().collect()]
    if not languages:
        return None
    sample = _sample(train, max(5, min(PER_LANGUAGE, MOST_ROWS // len(languages))))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        grams, counts = np.unique(np.concatenate([keys_of(symbols(t)) for t in pdf["text"]]), return_counts=True)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "grams": [grams.astype("<u8").tobytes()], "counts": [counts.astype("<i8").tobytes()]})

    rows = sample.filter("fold > 0").groupBy("lang").applyInPandas(count, "lang string, grams binary, counts binary").collect()
    counted = {r["lang"]: (np.frombuffer(r["grams"], "<u8").astype(np.uint64), np.frombuffer(r["counts"], "<i8")) for r in rows if r["grams"]}
    if not counted:
        return None
    languages = sorted(counted)
    letters = np.unique(np.concatenate([g & np.uint64(0xFFFF) for g, _ in counted.values()]))
    model = fit(languages, counted, max(64, 2 * len(letters)))
    held = sample.filter("fold = 0").select("lang", _entropy_column(model, F.col("text")).alias("e")).select("lang", "e.*").collect()
    return calibrate(model, [(r["lang"], np.array(r["bits"]), r["n"]) for r in held if r["n"]])


def calibrate(model: Model, held: list[tuple[str, np.ndarray, int]]) -> Model:
    size = len(model.languages)
    own = [[(bits[j] / n, n) for lang, bits, n in held if lang == name] for j, name in enumerate(model.languages)]
    every = [x for rows in own for x in rows] or [(4.0, 1)]
    model.mean, model.spread, model.noise, model.sigmas = (np.zeros(size) for _ in range(4))
    for j, rows in enumerate(own):
        rows = rows if len(rows) >= 5 else every
        h, n = np.array([x[0] for x in rows]), np.array([x[1] for x in rows])
        model.mean[j] = np.average(h, weights=n)
        model.noise[j] = 3.0  # bits: a symbol's own deviation, above what letters of any language show
        model.spread[j] = max(0.05, float(h.std()))
        far = (h - model.mean[j]) / np.sqrt(model.spread[j] ** 2 + model.noise[j] ** 2 / n)
        model.sigmas[j] = max(SIGMAS, 1.5 * float(far.max()))
    best = -np.inf
    for factor in (1, 2, 4, 8, 16, 32, 64):
        total = 0.0
        for lang, bits, n in held:
            if lang in model.languages:
                x = -factor * bits / n
                total += x[model.languages.index(lang)] - (x.max() + np.log(np.exp(x - x.max()).sum()))
        if total > best:
            best, model.factor = total, float(factor)
    return model


def _entropy_column(model: Model, text: Column) -> Column:
    @F.pandas_udf("bits array<double>, n bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [model.entropies(t or "") for t in batch]
            yield pd.DataFrame({"bits": [b for b, _ in found], "n": [n for _, n in found]})

    return run(text)


def decide(model: Model, bits: np.ndarray, n: int) -> tuple[str, float, bool, float]:
    """Language, score, accepted and cross-entropy of a text."""
    if not n:
        return UNKNOWN, 0.0, False, 0.0
    h = bits / n
    j = int(h.argmin())
    score = 1.0 / float(np.exp(np.minimum(700.0, -model.factor * (h - h[j]))).sum())
    limit = model.mean[j] + max(MARGIN, model.sigmas[j] * np.sqrt(model.spread[j] ** 2 + model.noise[j] ** 2 / n))
    return model.languages[j], min(1.0, max(0.0, score)), bool(h[j] <= limit), float(h[j])


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score``, ``accepted`` and ``bits_per_symbol``."""
    names = ["lang_pred", "score", "accepted", "bits_per_symbol"]
    if model is None:
        return without(df, names).select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"), F.lit(0.0).alias("bits_per_symbol"))
    ship_package(df.sparkSession)

    @F.pandas_udf("lang_pred string, score double, accepted boolean, bits_per_symbol double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([decide(model, *model.entropies(t or "")) for t in batch], columns=names)

    judged = df.withColumn("__judged", run(F.col(f"`{text}`")))
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    return judged.select(*kept, *[F.col(f"__judged.{n}").alias(n) for n in names])
