"""Quality rules with risk-controlled cutoffs.

Every document gets a few measures; a base rule rejects what is too short or
repeats itself, and a set of learned rules rejects a document when one measure is
above the cutoff of its stratum (its language, say).

Cutoffs come from labelled documents that the base rule keeps, and carry a
guarantee: with probability 1 - ``miss``, in every stratum at once, the rules
together reject at most a share ``risk`` of the good documents. Each of R rules may spend
risk / R. For one stratum and rule, cutoffs are tested from the mildest to the
strictest: "this cutoff rejects more than risk / R of the good documents" is refuted by the
exact binomial tail P(Bin(n, risk / R) <= k) of its k rejections among n good
documents. Testing in this fixed order needs no correction along the cutoffs;
the miss probability is divided by the number of strata times rules (Bonferroni).
Of the cutoffs that pass, the one with the best balance of bad documents caught
and good ones lost is used, of equal ones the mildest; if none
catches more than it costs, or there are too few labels to pass any test, the rule stays
silent in that stratum.

All of it is aggregation: labelled documents become counts per (stratum, rule,
bin), at most strata x rules x bins rows; tails are folds over those.

The measures of a document are found inside its row. Repeated 8-word
windows are equal 64-bit hashes of eight word hashes; only rows that have an equal pair
sort their windows.

Defined cases: null text: no words, so the base rule rejects it; a null stratum
is a stratum of its own; strata without labels reject nothing; labels that are null are
ignored, contradicting labels of one document count as bad; repeated rows are judged each;
empty tables give empty results; clashing column names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordstar.llm.common import SPACE, text_or_empty, without
from ordstar.session import materialize

#: Base measures, then those the learned rules use besides.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
RULES = ("symbols", "shouts", "capitals", "repeats", "dup_lines", "word_length")

#: Highest bin of a rule's measure.
BINS = 400
WINDOW = 8
#: Largest share of good documents that all rules together may reject, and the
#: probability with which that may fail.
RISK, MISS = 0.05, 0.05
#: A good document lost weighs as much as this many times its share of bad ones caught.
LOSS_WEIGHT = 20


def _repeat_words() -> Column:
    """Words in a window found twice, from ``__h``, the hashes of the windows."""
    places = F.expr(f"""
        transform(array(sort_array(transform(__h, (h, i) -> struct(h, i)))), s ->
          sort_array(transform(filter(sequence(0, size(s) - 1), j ->
              (j > 0 AND s[j].h = s[greatest(j - 1, 0)].h) OR (j < size(s) - 1 AND s[j].h = s[least(j + 1, size(s) - 1)].h)),
            j -> s[j].i)))[0]""")
    covered = F.aggregate(places, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last")),
                          lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
                          lambda a: a["n"])
    # A window's own words end WINDOW later than it starts; gaps between starts are cut to that.
    return F.when(F.size(F.array_distinct("__h")) < F.size("__h"), covered).otherwise(F.lit(0).cast("bigint"))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base measures, ``base_failed`` and ``bins`` (one bin per learned rule)."""
    kept = without(df, [*BASE, "bins"]).columns
    out = df.withColumn("__t", text_or_empty(text))
    out = out.withColumn("__w", F.array_remove(F.split("__t", SPACE), ""))
    out = out.withColumn("__x", F.transform("__w", lambda w: F.xxhash64(w)))
    eight = ", ".join(f"__x[i + {k}]" for k in range(WINDOW))
    out = out.withColumn("__h", F.expr(f"if(size(__x) < {WINDOW}, cast(array() AS array<bigint>), transform(sequence(0, size(__x) - {WINDOW}), i -> xxhash64({eight})))"))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("__lines", lines)
    count = lambda pattern: F.regexp_count("__t", F.lit(pattern)).cast("bigint")
    out = out.select(
        *[F.col(f"`{c}`") for c in kept],
        F.size("__w").cast("bigint").alias("n_words"), F.length(F.array_join("__w", "")).cast("bigint").alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"), (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words().alias("n_repeat_words"), F.size("__lines").alias("__n_lines"), count("[!?]").alias("__shouts"), count(r"\p{Lu}").alias("__capitals"))
    share = lambda part, whole: F.least(F.lit(BINS), F.ceil(100 * part / F.greatest(whole, F.lit(1)))).cast("int")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    bins = F.array(share(F.col("n_symbols"), F.col("n_words")), share(F.col("__shouts"), F.col("n_words")), share(F.col("__capitals"), F.col("word_chars")),
                   share(F.col("n_repeat_words"), F.col("n_words")), share(F.col("n_dup_lines"), F.col("__n_lines")),
                   F.least(F.lit(BINS), F.ceil(10 * F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)))).cast("int"))
    return out.select(*[F.col(f"`{c}`") for c in kept], *BASE[:5], failed.alias("base_failed"), bins.alias("bins"))


def most_rejections(n: Column, share: Column, miss: Column) -> Column:
    """The largest k with P(Bin(n, share) <= k) <= miss; -1 if there is none. The
    tail is summed term by term in logarithms."""
    odds = F.log(share / (1 - share))

    def step(a: Column, k: Column) -> Column:
        term = F.when(k == 0, n * F.log(1 - share)).otherwise(a["term"] + F.log((n - k + 1) / F.greatest(k, F.lit(1))) + odds)
        top = F.greatest(a["sum"], term)
        total = top + F.log(F.exp(a["sum"] - top) + F.exp(term - top))
        return F.struct(term.alias("term"), total.alias("sum"), (a["passed"] + (total <= F.log(miss)).cast("int")).alias("passed"))

    start = F.struct(F.lit(0.0).alias("term"), F.lit(-1e300).alias("sum"), F.lit(-1).alias("passed"))
    return F.aggregate(F.sequence(F.lit(0), F.ceil(n * share).cast("int")), start, step, lambda a: a["passed"])


def fit_cutoffs(measured: DataFrame, labels: DataFrame, key: str, stratum: str, risk: float = RISK, miss: float = MISS) -> DataFrame:
    """Cutoffs per stratum: ``__stratum`` and ``cutoffs``, one per rule (``BINS``: silent).
    Written once; it has one row per stratum."""
    marks = (labels.filter(F.col("quality").isNotNull() & F.col(key).isNotNull())
             .groupBy(F.col(key).alias("__id")).agg(F.min("quality").alias("good")))
    rows = measured.filter(~F.col("base_failed")).select(F.col(f"`{key}`").alias("__id"), F.col(f"`{stratum}`").cast("string").alias("__stratum"), "bins")
    counts = (rows.join(marks, "__id").select("__stratum", "good", F.posexplode("bins").alias("rule", "bin"))
              .groupBy("__stratum", "rule", "bin")
              .agg(F.sum((F.col("good") == 1).cast("bigint")).alias("good"), F.sum((F.col("good") != 1).cast("bigint")).alias("bad")))
    counts = materialize(counts, "cutoff-counts")
    strata = counts.select("__stratum").distinct().count()
    group = Window.partitionBy("__stratum", "rule")
    above = group.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cuts = (counts.withColumns({"n": F.sum("good").over(group), "m": F.sum("bad").over(group),
                                "lost": F.coalesce(F.sum("good").over(above), F.lit(0)), "caught": F.coalesce(F.sum("bad").over(above), F.lit(0))}))
    share, chance = F.lit(risk / len(RULES)), F.lit(miss / (len(RULES) * max(strata, 1)))
    limits = cuts.select("n").distinct().select("n", most_rejections(F.col("n"), share, chance).alias("most"))
    cuts = cuts.join(limits, "n")
    gain = F.col("caught") / F.greatest(F.col("m"), F.lit(1)) - LOSS_WEIGHT * F.col("lost") / F.greatest(F.col("n"), F.lit(1))
    best = (cuts.withColumn("gain", gain).filter((F.col("lost") <= F.col("most")) & (F.col("gain") > 0))
            .groupBy("__stratum", "rule").agg(F.max(F.struct("gain", "bin"))["bin"].alias("cut")))
    table = best.groupBy("__stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("cut"))
    silent = F.lit(BINS)
    return materialize(table.select("__stratum", F.array(*[F.coalesce(F.element_at("cut", F.lit(r)), silent) for r in range(len(RULES))]).alias("cutoffs")), "cutoffs")


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """``measured`` with ``rejected_by`` (rules above their cutoff) and ``kept``."""
    rows = without(measured, ["rejected_by", "kept"])
    cut = cutoffs.withColumnRenamed("__stratum", "__cut_stratum")
    joined = rows.join(cut, F.col(f"`{stratum}`").cast("string").eqNullSafe(F.col("__cut_stratum")), "left")
    names = F.array(*[F.lit(r) for r in RULES])
    fired = F.when(F.col("cutoffs").isNull(), F.array().cast("array<string>")).otherwise(
        F.filter(names, lambda name, i: F.element_at("bins", i + 1) > F.element_at("cutoffs", i + 1)))
    return (joined.withColumn("rejected_by", fired).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
            .drop("__cut_stratum", "cutoffs"))


def quality_filter(df: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", text: str = "text",
                   keep_text: bool = True, risk: float = RISK, miss: float = MISS) -> DataFrame:
    """Measures, ``rejected_by`` and ``kept`` of every row. The measures are written once
    and read for both the cutoffs and the verdicts; with ``keep_text`` they are taken
    again for the verdicts, so that no second copy of the texts is written."""
    measured = materialize(measure(df, text).drop(text), "measured")
    cutoffs = fit_cutoffs(measured, labels, key, stratum, risk, miss)
    if not keep_text:
        return judge(measured, cutoffs, stratum)
    # A condition on the verdict would be carried down into the measures and take them
    # once for every place that names one; it does not pass a row number.
    again = judge(measure(df, text).withColumn("__at", F.monotonically_increasing_id()), cutoffs, stratum)
    return again.withColumn("kept", F.col("kept") & (F.col("__at") >= 0)).drop("__at")
