"""URL filters: allow and block rules by host suffix and path prefix.

A rule (host, path) fits a url whose host is the rule's host or ends in a dot
and the rule's host, and whose path starts with the rule's path. The longest
fitting rule (characters of host and path together) gives the verdict; among
equally long ones the longer host, then ``block``. Without one the verdict is the default.

Sort-merge range join. A url is asked once for each of its host suffixes; such
a probe's canonical key is the suffix with its labels reversed, then the path.
Under canonical keys a rule is one interval: from its own key up to the first
key that does not start with it. Intervals of this kind nest or are apart, so one
sweep over the sorted keys with a stack is enough: a rule's start pushes it, its
end pops it, and a probe belongs to the rule on top. The sweep is a running
window over rule borders and probes together. Each border row carries the top of the stack behind it:
at a rule's start the rule, at its end the innermost rule that still holds (found
by equality on the proper prefixes of the rule's own path).

A sweep covers one canonical host and one salt, so it holds a bounded number of probes:
a host's number of salts follows its number of probes, and its borders are repeated for each salt.
Probes are distinct (host, path) pairs, counted before any join, and only
suffixes that some rule names are kept.

Defined cases: null url, or no ``://`` in it -> empty host and path (which only
a rule with an empty host can fit; it fits every host); duplicate rules count
once, equal rules with both verdicts block; null verdicts, hosts or paths in the rules are read as
block, empty, empty; repeated url rows each get their row; an empty rule table
leaves the default everywhere; clashing column names are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordstar.llm.common import lower_ascii, without

RESULT = ("host", "path", "rule", "verdict")

#: Probes in one sweep, about.
SWEEP_ROWS = 50_000

#: Sorts after every character a key can hold.
_AFTER = "\U0010ffff"


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A rule table from (host, path, verdict) literals."""
    if not rules:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("host", "path", "verdict")])
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.inline(rows))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _prefixes(path: Column, proper: bool) -> Column:
    """All prefixes of ``path``, the empty one first."""
    last = F.length(path) - (1 if proper else 0)
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda n: F.substring(path, F.lit(1), n))).otherwise(F.array().cast("array<string>"))


def borders(rules: DataFrame) -> DataFrame:
    """Interval borders: canonical host, key at which it stands, side (0: a rule
    ends, 1: one starts; ends come first), and the rule on top of the stack after it."""
    clean = (rules.select(lower_ascii(F.coalesce(F.col("host"), F.lit(""))).alias("host"),
                          F.coalesce(F.col("path"), F.lit("")).alias("rpath"),
                          F.when(F.col("verdict") == "allow", "allow").otherwise("block").alias("verdict"))
             .groupBy("host", "rpath").agg(F.max("verdict").alias("verdict")))
    clean = clean.withColumn("rev", reversed_host(F.col("host")))
    outer = clean.select("rev", F.col("rpath").alias("around"), F.struct("host", "rpath", "verdict").alias("outer"))
    parents = (clean.select("rev", "rpath", F.explode(_prefixes(F.col("rpath"), True)).alias("around"))
               .join(outer, ["rev", "around"])
               .groupBy("rev", "rpath").agg(F.max_by("outer", F.length("around")).alias("outer")))
    starts = clean.select("rev", F.col("rpath").alias("key"), F.lit(1).alias("side"),
                          F.length("rpath").alias("depth"), F.struct("host", "rpath", "verdict").alias("top"))
    ends = (clean.select("rev", "rpath").join(parents, ["rev", "rpath"], "left")
            .select("rev", F.concat("rpath", F.lit(_AFTER)).alias("key"), F.lit(0).alias("side"),
                    (-F.length("rpath")).alias("depth"), F.col("outer").alias("top")))
    return starts.unionByName(ends)


def match_rules(probes: DataFrame, rules: DataFrame, sweep_rows: int = SWEEP_ROWS) -> DataFrame:
    """The longest fitting rule of each distinct (host, path); pairs that no rule
    fits are left out."""
    marks = borders(rules)
    labels = F.split("host", r"\.")
    size = F.size(labels)
    tails = F.when(F.col("host") == "", F.array(F.lit(""))).otherwise(F.array_union(
        F.array(F.lit("")), F.transform(F.sequence(F.lit(1), size), lambda n: F.array_join(F.reverse(F.slice(labels, size - n + 1, n)), "."))))
    asked = probes.select("host", "path", F.explode(tails).alias("rev"))
    named = marks.select("rev").distinct()
    asked = asked.join(named, "rev")
    salts = asked.groupBy("rev").agg(F.ceil(F.count(F.lit(1)) / F.lit(sweep_rows)).cast("int").alias("salts"))
    spread = F.pmod(F.xxhash64("host", "path"), F.col("salts")).cast("int")
    asked = asked.join(salts, "rev").select(
        "rev", spread.alias("salt"), F.col("path").alias("key"), F.lit(2).alias("side"), F.lit(0).alias("depth"),
        F.lit(None).cast("struct<host:string,rpath:string,verdict:string>").alias("top"), "host", "path")
    none = F.lit(None).cast("string")
    swept = asked.unionByName(
        marks.join(salts, "rev").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .select("rev", "salt", "key", "side", "depth", F.coalesce("top", F.struct(none.alias("host"), none.alias("rpath"), none.alias("verdict"))).alias("top"),
                none.alias("host"), none.alias("path")))
    # Dealt by host and salt, whatever dealt the rows before: all salts of a host that
    # ends most names must not be one task.
    swept = swept.repartition("rev", "salt")
    sweep = Window.partitionBy("rev", "salt").orderBy("key", "side", "depth").rowsBetween(Window.unboundedPreceding, 0)
    found = (swept.withColumn("top", F.last("top", ignorenulls=True).over(sweep))
             .filter((F.col("side") == 2) & F.col("top.host").isNotNull()))
    rank = F.struct(F.length(F.concat("top.host", "top.rpath")), F.length("top.host"), (F.col("top.verdict") == "block"))
    return found.groupBy("host", "path").agg(F.max_by("top", rank).alias("__rule"))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
                sweep_rows: int = SWEEP_ROWS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule that
    decided, else null) and ``verdict``."""
    source = F.col(f"`{url}`").cast("string")
    parsed = without(pages.withColumns({"__host": host_of(source), "__path": path_of(source)}), RESULT)
    parsed = parsed.withColumnsRenamed({"__host": "host", "__path": "path"})
    distinct = pages.select(host_of(source).alias("host"), path_of(source).alias("path")).distinct()
    best = match_rules(distinct, rules, sweep_rows)
    return (parsed.join(best, ["host", "path"], "left")
            .select(*[F.col(f"`{c}`") for c in parsed.columns],
                    F.concat("__rule.host", "__rule.rpath").alias("rule"),
                    F.coalesce("__rule.verdict", F.lit(default)).alias("verdict")))
