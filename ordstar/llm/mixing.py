"""Mixing sources to target weights.

Every source's words are packed end to end into blocks of fixed length, in one
fixed order of its rows. Sources share a budget of words by weight; none is
taken more than ``most`` times over, what a full source cannot use is shared
among the others again (the level at which it settles has a closed form over the
sources sorted by capacity per weight). A target becomes a number of blocks.

Output slots are dealt to sources by one pseudorandom permutation of all slots:
slot -> place, and each source owns a run of places as long as its number of
blocks. The counts of an output shard (a run of slots) are therefore a multinomial draw
with those probabilities, made under the condition that the totals are met exactly:
free draws would pass ``most`` times a source's size by chance. Inside its
source a place is pass * blocks + index; every pass has its own pseudorandom permutation of
the index, so a source is gone through in a new order each time and no block is
taken again before all others were. Blocks and slots meet by (source, index).

The permutation is a swap-or-not shuffle: each round reflects x to k - x modulo
N or not, by one pseudorandom bit of the larger of the two. It works for any N, row by row, with no state,
and in integer arithmetic that any SQL engine repeats. Slots are dealt with bits of a
quadratic hash (``dealt_place``): shard counts scatter as the conditioned draw does. The order of a source's blocks
in a pass (``permuted``) has bits of a hash that is affine in the place: still a permutation, but
which blocks a part of a pass takes scatters up to a fifth more than a free choice would.

Places of rows in their source come from two-level sums: rows are summed in
buckets of a source (by md5 of the row's key), the buckets' sums are added up over a table of
sources x buckets rows, and only rows of one bucket are sorted together. No step
gathers a source, so a source with a third of all rows is like any other.

Defined cases: null text or no word: size 0, never taken; a null source is a
source of its own, last; repeated rows are packed each; equal keys are ordered
by size; an empty table stays empty; clashing column names are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordstar.llm.common import SPACE, md5_long, text_or_empty, word_count
from ordstar.session import materialize

#: Words in a block.
BLOCK_WORDS = 64
#: Blocks in an output shard.
SHARD_BLOCKS = 4096
#: Number groups of a source's rows.
BUCKETS = 512
#: Places in a run, the unit in which places look for their source.
RUN = 1 << 16
#: Rounds of the permutation.
ROUNDS = 16

#: Two primes, the factors of the bits, and those of the round keys.
PRIME, SECOND_PRIME = 2_147_483_647, 1_000_000_007
MIX_A, MIX_B = 1_103_515_245, 69_069
FACTORS = [(7 + 48_271 * (r + 1) ** 3 % 2_000_003, 11 + 69_621 * (r + 2) ** 2 % 1_999_993) for r in range(ROUNDS)]


def round_keys(n: str, seed: str) -> list[str]:
    """SQL for the key of each round of the permutation that ``seed`` and ``n`` pick."""
    return [f"((({seed}) % 1000003 * 1009 + {n} % 1000003) * {a} + {b}) % {PRIME}" for a, b in FACTORS]


def permuted(x: str, n: str, seed: str) -> str:
    """SQL for the place of ``x`` (0 to n - 1) under the permutation of 0 to n - 1
    that ``seed`` picks: a fold over the round keys, each a reflection and a bit
    (products modulo two primes) that says whether to take it."""
    mirror = f"(k % {n} - v + {n}) % {n}"
    take = f"(greatest(v, {mirror}) % {PRIME} + k) * {MIX_A} % {PRIME} * {MIX_B} % {SECOND_PRIME} div 512 % 2 = 1"
    keys = ", ".join(f"cast({k} AS bigint)" for k in round_keys(n, seed))
    return f"aggregate(array({keys}), {x}, (v, k) -> if({take}, {mirror}, v))"


def dealt_place(x: str, n: int) -> str:
    """SQL for the place of slot ``x`` (0 to n - 1): rounds as in ``permuted``, but a
    round's bit comes of a square (of the larger place plus the round's key, modulo two primes)."""
    keys = [int(hashlib.md5(f"{n}:{r}".encode()).hexdigest()[:15], 16) for r in range(ROUNDS)]
    rounds = ", ".join(f"named_struct('m', {k % max(n, 1) + n}L, 'h', {k // 2_147_483_648 % SECOND_PRIME}L)" for k in keys)
    mirror = f"(k.m - v) % {max(n, 1)}L"
    t = f"(greatest(v, {mirror}) % {SECOND_PRIME} + k.h)"
    take = f"{t} * {t} % {PRIME} * {MIX_B} % {SECOND_PRIME} div 512 % 2 = 1"
    return f"aggregate(array({rounds}), {x}, (v, k) -> if({take}, {mirror}, v))"


def targets(sizes: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """Source table (``source``, ``source_size``) with ``rank`` (by code point, null
    last), ``weight`` and ``target``. ``share`` is the budget as a fraction of all
    sizes. The table has one row per source and is sorted in one task."""
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("bigint") - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("bigint"))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    # Filled in order of capacity per weight, sources are full up to one place; the level of the rest follows.
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("rank").asc())
    filled = (ranked.withColumn("nth", F.row_number().over(order))
              .withColumn("full", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("total", F.sum("source_size").over(everything)))
    filled = filled.withColumns({"up": F.col("total") * share[0] - F.col("full") * share[1], "down": F.col("left") * share[1]})
    wide = "decimal(38,0)"
    fits = F.col("up").cast(wide) * F.col("weight") <= F.col("cap").cast(wide) * F.col("down")
    level = F.min(F.when(fits, F.struct("nth", "up", "down"))).over(everything)
    filled = filled.withColumn("level", level)
    settled = F.col("level").isNotNull() & (F.col("nth") >= F.col("level.nth"))
    target = F.when(settled, (F.col("weight") * F.col("level.up")).cast("double") / F.col("level.down").cast("double")).otherwise(F.col("cap").cast("double"))
    return filled.select("source", "source_size", "rank", "weight", target.alias("target"))


def pack(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows with words (``rank``, ``key``, ``size``) with ``start``, the place of
    their first word in their source."""
    placed = rows.withColumn("bucket", F.pmod(F.coalesce(md5_long(F.col("key")), F.lit(0)), F.lit(buckets)).cast("int"))
    sums = placed.groupBy("rank", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select("rank", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("rank", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return within.join(firsts, ["rank", "bucket"]).select("rank", "key", "size", (F.col("first") + F.col("inside")).alias("start"))


@dataclass
class Mix:
    """``sources``: one row per source (``source``, ``source_size``, ``rank``,
    ``weight``, ``target``). ``rows``: every row (``rank``, ``key``, ``size``).
    ``packed``: the rows with words and their ``start`` in the source. ``segments``: one row per
    output slot and row that it takes words of (``shard``, ``slot``, ``pass``, ``rank``,
    ``key``, ``start``, ``from``, ``words``)."""

    sources: DataFrame
    rows: DataFrame
    packed: DataFrame
    segments: DataFrame


def plan_mix(rows: DataFrame, weights: tuple[int, ...], share: tuple[int, int] = (3, 2), most: int = 2,
             block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, buckets: int = BUCKETS) -> Mix:
    """The mix of ``rows`` (``source``, ``key``, ``size``): no text is needed, or moved."""
    spark = rows.sparkSession
    rows = materialize(rows.select("source", "key", F.col("size").cast("bigint").alias("size")), "mix-rows")
    sources = materialize(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-sources")
    blocks = F.ceil(F.col("source_size") / block_words).cast("bigint")
    take = F.least(F.round(blocks * F.col("target") / F.col("source_size")).cast("bigint"), blocks * most)
    earlier = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    quota = (sources.filter("source_size > 0").select("rank", blocks.alias("blocks"), take.alias("take"))
             .withColumn("first_place", F.coalesce(F.sum("take").over(earlier), F.lit(0))).filter("take > 0"))
    total = quota.agg(F.coalesce(F.sum("take"), F.lit(0)).alias("n")).first()["n"]
    # Places meet their source by equality on runs of places of bounded length.
    runs = quota.withColumn("run", F.explode(F.expr(f"sequence(first_place div {RUN}, (first_place + take - 1) div {RUN})")))
    slots = spark.range(0, total, 1, max(8, total // 50_000)).select(F.col("id").alias("slot"))
    dealt = (slots.withColumn("place", F.expr(dealt_place("slot", total))).withColumn("run", F.expr(f"place div {RUN}")).join(runs, "run")
             .filter("place >= first_place AND place < first_place + take")
             .selectExpr("slot", "rank", "blocks", "(place - first_place) div blocks AS pass", "(place - first_place) % blocks AS turn",
                         "rank * 4099 + (place - first_place) div blocks * 31 + 7 AS seed"))
    dealt = dealt.select("slot", "rank", "pass", F.expr(permuted("turn", "blocks", "seed")).alias("block"))
    ranks = sources.select(F.col("source").alias("s"), "rank")
    ranked = rows.join(ranks, F.col("source").eqNullSafe(F.col("s"))).select("rank", "key", "size")
    packed = pack(ranked.filter("size > 0"), buckets)
    held = packed.withColumn("block", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    segments = (held.join(dealt, ["rank", "block"])
                .select(F.expr(f"slot div {shard_blocks}").alias("shard"), "slot", "pass", "rank", "key", "start",
                        (low - F.col("start")).alias("from"), (high - low).alias("words")))
    return Mix(sources, ranked, packed, segments)


def mix_report(docs: DataFrame, weights: tuple[int, ...], key: str = "doc_id", source: str = "source", text: str = "text", **settings) -> DataFrame:
    """One row per document: ``key``, ``size``, ``source_size``, ``target``, ``taken``
    (the words the mix takes of it, repeats counted), ``first_shard`` and ``n_shards``: the
    first output shard that words of it are dealt to (null for none) and how many there are."""
    rows = docs.select(F.col(f"`{source}`").cast("string").alias("source"), F.col(f"`{key}`").alias("key"),
                       word_count(F.col(f"`{text}`").cast("string")).alias("size"))
    mix = plan_mix(rows, weights, **settings)
    dealt = mix.segments.groupBy("rank", "start", "shard").agg(F.sum("words").alias("words"))
    taken = dealt.groupBy("rank", "start").agg(F.sum("words").alias("taken"), F.min("shard").alias("first_shard"), F.count(F.lit(1)).alias("n_shards"))
    zero = F.lit(0).cast("bigint")
    listed = (mix.packed.join(taken, ["rank", "start"], "left")
              .select("rank", "key", "size", F.coalesce("taken", zero).alias("taken"), "first_shard", F.coalesce("n_shards", zero).alias("n_shards"))
              .unionByName(mix.rows.filter("size = 0").withColumns({"taken": zero, "first_shard": F.lit(None).cast("bigint"), "n_shards": zero})))
    return (listed.join(mix.sources.select("rank", "source_size", "target"), "rank")
            .select(F.col("key").alias(key), "size", "source_size", "target", "taken", "first_shard", "n_shards"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...], key: str = "doc_id", source: str = "source", text: str = "text",
                    n_chars: str | None = "n_chars", **settings) -> DataFrame:
    """The mix as documents: for each pass that takes words of a document one row
    with the document's columns, whose text is the words taken, in order and
    joined by spaces; ``n_chars``, where given and present, is that text's length.

    Rows that are equal in every column share a key; each of their places in the
    source makes rows of its own.
    """
    columns = docs.columns
    whole = F.concat_ws(":", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("~")),
                        F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in columns])), F.hex(F.crc32(text_or_empty(text).cast("binary"))))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), whole.alias("key"))
    rows = docs.select(F.col(f"`{source}`").cast("string").alias("source"), whole.alias("key"), word_count(F.col(f"`{text}`").cast("string")).alias("size"))
    mix = plan_mix(rows, weights, **settings)
    taken = (mix.segments.groupBy("key", "start", "pass").agg(F.sort_array(F.collect_list(F.struct("from", "words"))).alias("parts")))
    distinct = keyed.groupBy("key").agg(F.first("row").alias("row"))
    out = taken.join(distinct, "key")
    # A text's words are split once: the one-element array binds them for all parts.
    words = F.split(F.trim(F.regexp_replace(F.col(f"row.`{text}`").cast("string"), SPACE, " ")), " ")
    mixed = F.transform(F.array(words), lambda w: F.array_join(F.flatten(F.transform(
        F.col("parts"), lambda p: F.slice(w, (p["from"] + 1).cast("int"), p["words"].cast("int")))), " "))[0]
    out = out.withColumn("mixed", mixed)
    replaced = {text.lower(): F.col("mixed")} | ({n_chars.lower(): F.length("mixed").cast("bigint")} if n_chars else {})
    return out.select(*[replaced.get(c.lower(), F.col(f"row.`{c}`")).alias(c) for c in columns])
