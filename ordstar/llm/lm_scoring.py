"""Language-model scoring with a log-bilinear neural model.

Outcomes are the training corpus's words, the end of a text, and "unknown". The
neural model runs over classes: each of the ``HEAD`` most frequent tokens is a class of its own, all
other words belong to a class by their last two characters (the ``TAILS`` - 1
commonest endings, and the rest). A word's probability is its class's probability
after the previous token's class, times its share in the class: absolute
discounting over the class's words, what the discount frees going to
the class's unknown words. Everything sums to one, so scores are log probabilities.

Log-bilinear model: s(w | h) = c_h . q_w + b_w over class vectors. For this
context the corpus enters training only through the counts of class pairs,
which Spark gathers over all training documents (classes^2 numbers at most).
Noise-contrastive estimation tells observed pairs from ``NOISE`` times as many noise pairs with
the classes' own frequencies; with the counts at hand its expected loss and gradient are
exact dense matrix products in numpy, so training takes a fixed number of steps of fixed cost
whatever the corpus's size, and reruns agree. Batched matrix products over all
contexts then give the normalised log probabilities that scoring looks up.

Scoring is one pass. Counts of the ``KNOWN`` most frequent words go with the
job (a fixed bound); for rarer words each document sends its distinct ones to be
joined with the corpus's count table, and a document's parts are summed up again. Hot words
never enter the shuffle, rare ones spread evenly.

Defined cases: null text counts as empty (one token, its end); documents are
scored each, repeated or not; without training documents every token is unknown
and has the one outcome's probability of 1; clashing column names are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordstar.llm.common import without, words
from ordstar.session import materialize, ship_package

HEAD, TAILS, KNOWN = 768, 128, 1 << 17
SIZE, STEPS, NOISE, RATE = 24, 160, 8, 0.06
#: Distinct words a task holds before it passes its counts on.
HELD = 300_000

#: Stands for the end of a text; no word holds a line feed.
END = b"\n"


@dataclass
class Vocabulary:
    """Corpus statistics that go with a job; all sizes are bounded by parameters."""

    head: int
    total: int
    distinct: int
    known: list[bytes]        # most frequent tokens, most frequent first
    counts: np.ndarray        # their counts
    endings: list[str]        # the tail classes' endings; the last tail class has none
    mass: np.ndarray          # per tail class: tokens outside the head
    discount: np.ndarray
    words: np.ndarray         # per tail class: distinct words outside the head

    @property
    def classes(self) -> int:
        return self.head + len(self.endings) + 1

    def share(self, tail: int, count: int) -> float:
        """log10 of a word's share in its tail class; count 0: unknown."""
        if not self.mass[tail]:
            return 0.0
        part = count - self.discount[tail] if count else self.discount[tail] * self.words[tail]
        return float(np.log10(part / self.mass[tail]))


def ending(word: bytes) -> str:
    return word.decode("utf-8", "replace")[-2:]


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(``word``, ``c``) over all rows, written to the shared folder."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def passed(held):
            keys = list(held)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([held[k] for k in keys], pa.int64()),
                                               pa.array([ending(k) for k in keys], pa.string())], ["word", "n", "ending"])

        held: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.update(words(t or ""))
                held[END] += 1
                if len(held) > HELD:
                    yield passed(held)
                    held = Counter()
        if held:
            yield passed(held)

    found = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "word binary, n bigint, ending string")
    return materialize(found.groupBy("word").agg(F.sum("n").alias("c"), F.first("ending").alias("ending")), "word-counts")


def vocabulary(counts: DataFrame, head: int = HEAD, tails: int = TAILS, most_known: int = KNOWN) -> Vocabulary:
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    known = most_frequent(counts, most_known).toPandas().sort_values(["c", "word"], ascending=[False, True])
    names, numbers = [bytes(w) for w in known["word"]], known["c"].to_numpy(np.int64)
    if END in names:  # the end of a text is always a class of its own
        at = names.index(END)
        names.insert(0, names.pop(at))
        numbers = np.r_[numbers[at], np.delete(numbers, at)]
    heads = [bytearray(w) for w in names[:head]]
    tail = counts.filter(~F.col("word").isin(heads)) if heads else counts
    top = tail.groupBy("ending").agg(F.sum("c").alias("c")).orderBy(F.col("c").desc(), "ending").limit(tails - 1).collect()
    endings = sorted(r["ending"] for r in top)
    number = F.coalesce(F.array_position(F.array(*[F.lit(e) for e in endings]), F.col("ending")) - 1, F.lit(-1)) if endings else F.lit(-1)
    rows = (tail.groupBy(number.alias("t")).agg(F.sum("c").alias("mass"), F.count(F.lit(1)).alias("words"),
                                                F.sum((F.col("c") == 1).cast("bigint")).alias("once"), F.sum((F.col("c") == 2).cast("bigint")).alias("twice")).collect())
    size = len(endings) + 1
    mass, distinct, discount = np.zeros(size), np.zeros(size), np.full(size, 0.5)
    for r in rows:
        t = r["t"] if r["t"] >= 0 else size - 1
        mass[t], distinct[t] = r["mass"], r["words"]
        if r["once"] + r["twice"]:
            discount[t] = min(0.95, max(0.1, r["once"] / (r["once"] + 2 * r["twice"])))
    return Vocabulary(head, whole["n"], whole["v"], names, numbers, endings, mass, discount, distinct)


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """(``word``, ``c``) of the most frequent words, ``most`` of them or a few less: all
    above a count, found by a histogram of at most 512 eighths of powers of two. No
    task or driver sees more rows than that, whatever the number of partitions. Words of a
    corpus without so many stay all."""
    step = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    room, lowest = most, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        if r["words"] > room:
            break
        room, lowest = room - r["words"], r["step"]
    return counts.filter(step >= lowest if lowest is not None else F.lit(False)).select("word", "c")


class Classes(dict):
    """Token -> class, remembered for a bounded number of words."""

    def __init__(self, v: Vocabulary):
        super().__init__({w: i for i, w in enumerate(v.known[:v.head])})
        self.tails = {e: v.head + i for i, e in enumerate(v.endings)}
        self.other = v.head + len(v.endings)
        self.own = len(self)

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD:
            for w in list(self)[self.own:]:
                del self[w]
        value = self[word] = self.tails.get(ending(word), self.other)
        return value


def count_pairs(docs: DataFrame, text: str, v: Vocabulary) -> np.ndarray:
    """Counts of class pairs (previous, next) over all rows; a text starts after an end."""
    size = v.classes

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        classes, total = Classes(v), np.zeros(size * size, np.int64)
        start = classes[END]
        for batch in batches:
            for t in batch.column(0).to_pylist():
                w = words(t or "")
                ids = np.fromiter(map(classes.__getitem__, w), np.int64, len(w))
                np.add.at(total, np.r_[start, ids] * size + np.r_[ids, start], 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    found = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(size * size)
    rows = found.toPandas()
    out[rows["pair"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return out.reshape(size, size)


def train(pairs: np.ndarray, size: int = SIZE, steps: int = STEPS, noise: float = NOISE, rate: float = RATE, seed: int = 7) -> np.ndarray:
    """log10 probability of each next class after each class: the log-bilinear
    model's, trained by noise-contrastive estimation (Adam on the expected loss)."""
    n = len(pairs)
    everything = max(pairs.sum(), 1.0)
    seen = (pairs / everything).astype(np.float32)
    unigram = (pairs.sum(axis=0) + 0.5) / (everything + 0.5 * n)
    before = seen.sum(axis=1, keepdims=True)
    random = np.random.RandomState(seed)
    p = {"c": random.normal(0, 0.1, (n, size)).astype(np.float32), "q": random.normal(0, 0.1, (n, size)).astype(np.float32),
         "b": np.log(unigram).astype(np.float32)}
    log_noise = np.log(noise * unigram).astype(np.float32)
    fakes = (noise * before * unigram).astype(np.float32)
    m = {k: np.zeros_like(x) for k, x in p.items()}
    u = {k: np.zeros_like(x) for k, x in p.items()}
    # Rare contexts move as far as common ones: gradients are taken per context and word frequency.
    scale_c, scale_q = 1 / (before + 1e-6), 1 / (unigram[:, None].astype(np.float32) + 1e-6)
    for step in range(1, steps + 1):
        real = 1 / (1 + np.exp(np.clip(log_noise - (p["c"] @ p["q"].T + p["b"]), -30, 30)))
        gap = fakes * real - seen * (1 - real)
        grads = {"c": gap @ p["q"] * scale_c, "q": gap.T @ p["c"] * scale_q, "b": gap.sum(axis=0) * scale_q[:, 0]}
        for k, g in grads.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            u[k] = 0.99 * u[k] + 0.01 * g * g
            p[k] -= rate * (1 - step / (steps + 1)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(u[k] / (1 - 0.99**step)) + 1e-6)
    scores = (p["c"] @ p["q"].T + p["b"]).astype(np.float64)
    scores -= scores.max(axis=1, keepdims=True)
    return ((scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))) / np.log(10)).astype(np.float32)


def score(docs: DataFrame, training: DataFrame, text: str = "text", head: int = HEAD, tails: int = TAILS,
          most_known: int = KNOWN, steps: int = STEPS) -> DataFrame:
    """``docs`` (all columns but the text, which is not carried along) with ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` (add-one unigram) and ``score`` (the
    model's), learning from the rows of ``training``."""
    spark = docs.sparkSession
    ship_package(spark)
    counts = count_words(training, text)
    v = vocabulary(counts, head, tails, most_known)
    table = train(count_pairs(training, text, v), steps=steps) if v.total else np.zeros((v.classes, v.classes), np.float32)
    results = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept = without(docs, [*results, text]).columns
    base_of = float(np.log10(v.total + v.distinct + 1))
    shares = {w: float(np.log10(c + 1)) for w, c in zip(v.known, v.counts.tolist(), strict=True)}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        classes = Classes(v)
        start = classes[END]
        tail_of = {w: v.share(classes[w] - v.head, c) for w, c in zip(v.known[v.head:], v.counts[v.head:].tolist(), strict=True)}
        for batch in batches:
            own, number, known, base, model, rare_word, rare_tail, rare_n, ends = [], [], [], [], [], [], [], [], [0]
            for t in batch.column(0).to_pylist():
                w = words(t or "")
                ids = np.fromiter(map(classes.__getitem__, w), np.int64, len(w))
                b = m = 0.0
                k = 0
                for x, n in Counter([*w, END]).items():
                    a = shares.get(x)
                    if a is None:
                        rare_word.append(x)
                        rare_n.append(n)
                        rare_tail.append(classes[x] - v.head)
                    else:
                        k += n
                        b += n * a
                        m += n * tail_of.get(x, 0.0)
                number.append(len(w) + 1)
                known.append(k)
                base.append(b)
                model.append(m + float(table[np.r_[start, ids], np.r_[ids, start]].sum(dtype=np.float64)))
                ends.append(len(rare_word))
            rare = pa.StructArray.from_arrays([pa.array(rare_word, pa.binary()), pa.array(rare_tail, pa.int32()), pa.array(rare_n, pa.int64())], ["word", "tail", "n"])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(number, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                                              pa.array(model, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare)],
                                             ["__row", "n_tokens", "known", "base", "model", "rare"])

    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    row_type = docs.select(row.alias("r")).schema["r"].dataType.simpleString()
    parts = docs.select(F.col(f"`{text}`").cast("string").alias("t"), row.alias("r")).mapInArrow(
        run, f"__row {row_type}, n_tokens bigint, known bigint, base double, model double, rare array<struct<word:binary,tail:int,n:bigint>>")
    # One row per document for what is settled, one for each rare word; a row number ties them together.
    parts = parts.withColumn("at", F.monotonically_increasing_id())
    none = F.struct(F.lit(None).cast("binary").alias("word"), F.lit(0).alias("tail"), F.lit(0).cast("bigint").alias("n"))
    long = parts.withColumn("x", F.explode(F.concat(F.array(none), "rare"))).select(
        "at", F.coalesce("x.word", F.concat(F.lit(END), F.col("at").cast("string").cast("binary"))).alias("word"), F.col("x.tail").alias("tail"), F.col("x.n").alias("n"),
        F.when(F.col("x.word").isNull(), F.struct("__row", "n_tokens", "known", "base", "model")).alias("d"))
    joined = long.join(counts.select("word", "c"), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    literal = lambda values: F.array(*[F.lit(float(x)) for x in values])
    at = F.col("tail") + 1
    mass, gone, kinds = (F.element_at(literal(x), at) for x in (v.mass, v.discount, v.words))
    part = F.when(F.col("n") == 0, 0.0).when(mass == 0, 0.0).otherwise(F.col("n") * F.log10(F.greatest(F.when(F.col("c") > 0, F.col("c") - gone).otherwise(gone * kinds), F.lit(1e-12)) / F.greatest(mass, F.lit(1e-12))))
    summed = joined.groupBy("at").agg(
        F.first("d", ignorenulls=True).alias("d"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("k"),
        F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("b"), F.sum(part).alias("m"))
    return summed.select(*[F.col(f"d.__row.`{c}`") for c in kept], F.col("d.n_tokens").alias("n_tokens"), (F.col("d.known") + F.col("k")).alias("n_known"),
                         F.lit(v.total).cast("bigint").alias("train_tokens"), (F.col("d.base") + F.col("b") - F.col("d.n_tokens") * base_of).alias("base_score"),
                         (F.col("d.model") + F.col("m")).alias("score"))
