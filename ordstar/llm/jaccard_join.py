"""Exact Jaccard self-join of word n-gram sets, as connected components.

Jaccard distance is a metric, so pivots and the triangle inequality can bound
where a linked partner may be. Unrelated texts, however, are all at distance
close to 1 from each other: Voronoi cells of whole documents would be replicated everywhere. So
the first level of regions lives in parts of the shingle universe, and
documents as pivots come in once only related ones are left:

1. Sets. Every text becomes its set of n-word shingle hashes; rows with equal sets
   are one node from here on (combined before the shuffle).
2. Regions. Linked sets x, y of similarity t or more differ in at most
   H = (|x| + |y|)(1 - t) / (1 + t) shingles. The universe is cut by hash into more than H
   parts; a linked pair agrees on one non-empty part entirely. Each part's subset is a
   pivot of that part, at distance 0 from its members and at a positive distance from all others;
   a node lies in one region per part. Boundaries are those of size: sets are put into size classes and a set
   near its class's lower bound is replicated into the class below, because of
   |y| <= |x| / t. A set with so many empty parts that the count argument fails also
   enters the regions of its first shingles (enough that two such sets must share one).
   Below ``CROWDED`` percent parts hold few shingles, and a phrase that many texts share
   alone in a part would chain unrelated sets. There are a quarter more parts there, and each
   set leaves its most popular regions: of q non-empty parts linked sets agree on q - H or more,
   so each may leave q - H - 1, and the least popular one they agree on is left by neither.
3. Candidates. Regions with two nodes or more give star pairs (member, smallest
   member), never all pairs; their components contain every linked pair. Related sets only are fetched
   again, by component.
4. Joins. A component of at most ``MOST`` nodes is joined in one task: pivots split it
   into Voronoi halves, recursively; pairs over a border are compared inside the window of two
   thresholds around it; leaves are compared exactly, skipping pairs already connected. A larger component is
   dealt to groups of ``MOST``; each group first compares with common pivots,
   which settles all but a rest of nodes, then the rest, in blocks, meets every group.
5. A task's own components are final; the links of a dealt component are star pairs
   again, whose components are.

All links are verified on whole sets with integer arithmetic.

Defined cases: null or empty text and text without words: empty set, its own
component; fewer words than n: the whole sequence is the one shingle; repeated rows
share a component; null ids take part, the component id is the smallest non-null id (null if
there is none); an empty table stays empty; clashing column names are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordstar.llm.common import word_count, words
from ordstar.llm.components import components
from ordstar.session import materialize, ship_package

#: Nodes of a component that one task joins.
MOST = 1_500
#: Pivots of a larger component.
PIVOTS = 24
#: Nodes of a region that are compared directly.
LEAF = 192
#: Texts whose sets a worker holds at a time.
SLICE = 500
#: Growth of size classes.
CLASS_GROWTH = 1.5
#: Percent of similarity below which sets leave their most popular regions.
CROWDED = 90
#: Values of ``spares`` are a class times this and the number of regions to leave.
SPARE = 1 << 24

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (wrapping arithmetic on unsigned integers)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = WordHashes()


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    w = words(text or "")
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, w), np.uint64, len(w))
    width = min(n, len(w))
    x = np.full(len(w) - width + 1, width, np.uint64)
    for k in range(width):
        x = mix(x * np.uint64(3) + h[k:len(w) - width + 1 + k])
    return np.unique(x)


def set_key(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.astype("<u8").tobytes(), digest_size=16).digest()


def size_class(size: int) -> tuple[int, int, int]:
    """(class number, its lowest size, the next class's lowest size)."""
    low, number = 1, 0
    while True:
        high = max(low + 1, int(low * CLASS_GROWTH))
        if size < high:
            return number, low, high
        low, number = high, number + 1


def class_parts(high: int, percent: int) -> tuple[int, int]:
    """For a class whose smaller sets are below ``high``: the largest number of
    shingles in which linked sets differ, and the number of parts."""
    smaller = high - 1
    larger = smaller * 100 // percent
    differ = (smaller + larger) * (100 - percent) // (100 + percent)
    return differ, differ + 1 + (differ // (40 if percent >= CROWDED else 4) + 1 if differ else 0)


def region_keys(x: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the regions that a set lies in."""
    return regions_of(x, percent)[0]


def regions_of(x: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the regions that a set lies in, and for each its kind (class, and
    whether of parts or of first shingles) with how many regions of that kind the set may leave."""
    if not len(x):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    number, low, high = size_class(len(x))
    classes = [(number, high)]
    # The partner may be as small as percent of this size: every class down to that.
    at, least = low, -(-len(x) * percent // 100)
    while at > least:
        lower_number, lower_low, lower_high = size_class(at - 1)
        classes.append((lower_number, lower_high))
        at = lower_low
    out, spares = [], []
    spread = mix(x)
    for number, high in classes:
        differ, parts = class_parts(high, percent)
        part = ((x >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sums = np.add.reduceat(spread, first)
        tag = np.uint64((number * 2 + 1) * 1_000_003)
        out.append(mix(sums ^ mix(part[first] + tag)))
        leave = min(max(0, len(first) - differ - 1), SPARE - 1)
        spares.append(np.full(len(first), 2 * number * SPARE + leave, np.int32))
        if len(first) <= differ:
            prefix = len(x) - (-(-len(x) * percent // 100)) + 1
            out.append(mix(spread[:prefix] ^ np.uint64(number * 2 * 1_000_003 + 7)))
            spares.append(np.full(len(out[-1]), (2 * number + 1) * SPARE, np.int32))
    return np.concatenate(out), np.concatenate(spares)


def slices(batches: Iterator, rows: int = SLICE) -> Iterator:
    """Batches in slices, so that a worker holds the sets of few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def key_bits(rows: int) -> int:
    """Bits of a region's key. With 256 regions a row, about one row in 256 has a region
    whose key meets another's. Candidates are verified, so that costs no result; but
    components chain what meets, so far fewer than one meeting a row is needed."""
    return min(64, max(rows, 1).bit_length() + 24)


def narrowed(keys: np.ndarray, spares: np.ndarray, drop: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Keys without their lowest bits. Where two keys of one set meet, the set may leave
    that many regions less."""
    keys = keys >> drop
    met = len(keys) - len(np.unique(keys))
    return keys, spares - np.minimum(spares % SPARE, met).astype(np.int32) if met else spares


def sketch(df: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """(``id``, ``mark``, ``n_shingles``, ``node``, ``regions``) of every row, below
    ``CROWDED`` percent also ``spares``. A set that a task has had before has its regions
    in the first row only."""
    crowded = percent < CROWDED
    drop = np.uint64(64 - key_bits(df.count()))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: set[bytes | None] = set()
        for batch in slices(batches):
            sets = [shingle_set(t, n) for t in batch.column(2).to_pylist()]
            names = [set_key(x) if len(x) else None for x in sets]
            found = []
            for x, name in zip(sets, names):
                found.append(narrowed(*regions_of(x[:0] if name in seen else x, percent), drop))
                seen.add(name)
            flat = np.concatenate([*[k for k, _ in found], np.zeros(0, np.uint64)]).view(np.int64)
            spares = np.concatenate([*[s for _, s in found], np.zeros(0, np.int32)])
            ends = pa.array(np.cumsum([0, *[len(k) for k, _ in found]]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(a)) for a in ([flat, spares] if crowded else [flat])]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(x) for x in sets], pa.int64()),
                pa.array(names, pa.binary()),
                *lists], ["id", "mark", "n_shingles", "node", "regions", "spares"][:4 + len(lists)])

    kind = df.schema[key].dataType.simpleString()
    t = F.col(f"`{text}`").cast("string")
    return df.select(F.col(f"`{key}`"), F.xxhash64(t).alias("mark"), t.alias("text")).mapInArrow(run, f"id {kind}, mark bigint, n_shingles bigint, node binary, regions array<bigint>" + (", spares array<int>" if crowded else ""))


def fetch_sets(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(``node``, ``shingles``) of every row."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            sets = [shingle_set(t, n) for t in batch.column(0).to_pylist()]
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([set_key(x) for x in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["node", "shingles"])

    return df.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "node binary, shingles array<bigint>")


class Region:
    """Sets of one task, as one array of shingle numbers."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = np.array([len(x) for x in sets], np.int64)
        flat = np.concatenate([*sets, np.zeros(0, np.int64)])
        self.shingles = np.unique(flat, return_inverse=True)[1] if len(flat) else flat
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.marked = np.zeros(int(self.shingles.max()) + 1 if len(flat) else 1, bool)
        self.root = np.arange(len(sets))
        self.links = np.zeros(len(sets), np.int64)

    def common(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """Shingles that each member shares with the pivot."""
        own = self.shingles[self.starts[pivot]:self.starts[pivot + 1]]
        self.marked[own] = True
        sizes = self.sizes[members]
        begins = np.cumsum(sizes) - sizes
        places = np.repeat(self.starts[members] - begins, sizes) + np.arange(sizes.sum())
        out = np.add.reduceat(self.marked[self.shingles[places]].astype(np.int64), begins)
        self.marked[own] = False
        return out

    def distances(self, pivot: int, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Jaccard distances from the pivot, and whether each member is linked to it."""
        both = self.common(pivot, members)
        either = self.sizes[members] + self.sizes[pivot] - both
        return 1 - both / either, 100 * both >= self.percent * either

    def top(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def union(self, i: int, others: np.ndarray) -> None:
        for j in others:
            a, b = self.top(i), self.top(int(j))
            if a != b:
                self.root[max(a, b)] = min(a, b)

    def tops(self, members: np.ndarray) -> np.ndarray:
        r = self.root
        while True:
            up = r[r]
            if (up == r).all():
                break
            r = up
        self.root = r
        return r[members]

    def join(self, members: np.ndarray) -> None:
        """Connect all linked pairs among ``members``."""
        todo = [members]
        while todo:
            region = todo.pop()
            tops = self.tops(region)
            if len(region) < 2 or (tops == tops[0]).all():
                continue
            if len(region) <= LEAF:
                self.leaf(region)
                continue
            p = int(region[0])
            to_p, linked = self.distances(p, region)
            self.union(p, region[linked])
            q = int(region[to_p.argmax()])
            to_q, linked = self.distances(q, region)
            self.union(q, region[linked])
            reach = 1 - self.percent / 100 + 1e-9
            near_p = to_p <= to_q
            window = np.abs(to_p - to_q) <= 2 * reach
            if 2 * window.sum() > len(region) or near_p.all() or not near_p.any():
                self.leaf(region)
                continue
            # Pairs over the border have both ends in the window.
            self.cross(region[near_p & window], region[~near_p & window])
            todo += [region[near_p], region[~near_p]]

    def leaf(self, region: np.ndarray) -> None:
        """Compare exactly, each pivot with the members behind it that are not
        connected to it yet."""
        for k, p in enumerate(region[:-1]):
            rest = region[k + 1:]
            tops = self.tops(rest)
            rest = rest[tops != self.top(int(p))]
            if not len(rest):
                if k == 0 or (self.tops(region) == self.top(int(p))).all():
                    break
                continue
            low, high = self.sizes[p] * self.percent, self.sizes[p] * 100
            rest = rest[(self.sizes[rest] * 100 >= low) & (self.sizes[rest] * self.percent <= high)]
            if len(rest):
                _, linked = self.distances(int(p), rest)
                self.union(int(p), rest[linked])

    def cross(self, left: np.ndarray, right: np.ndarray) -> None:
        """Connect linked pairs between ``left`` and ``right``."""
        for p in left:
            rest = right[self.tops(right) != self.top(int(p))]
            if len(rest):
                _, linked = self.distances(int(p), rest)
                self.union(int(p), rest[linked])


_PAIRS = "u binary, v binary"


def _pairs(region: Region, nodes: list[bytes]) -> pd.DataFrame:
    tops = region.tops(np.arange(len(nodes)))
    found = [(nodes[i], nodes[t]) for i, t in enumerate(tops) if i != t]
    return pd.DataFrame(found, columns=["u", "v"])


def join_group(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Each node of a whole candidate component with its final component's first
    node; nodes without a link are left out."""
    region = Region(list(pdf["shingles"]), percent)
    region.join(np.arange(len(pdf)))
    tops = region.tops(np.arange(len(pdf)))
    linked = np.bincount(tops, minlength=len(tops))[tops] > 1
    nodes = list(pdf["node"])
    return pd.DataFrame([(nodes[i], nodes[tops[i]]) for i in np.flatnonzero(linked)], columns=["u", "v"])


def join_pivots(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of a group's nodes to the pivots that came along (and of pivots to each other)."""
    region = Region(list(pdf["shingles"]), percent)
    pivot = pdf["pivot"].to_numpy(bool)
    region.cross(np.flatnonzero(pivot), np.arange(len(pdf)))
    return _pairs(region, list(pdf["node"]))


def join_rest(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of a block of the rest with a group of nodes; what is connected
    already (``seen``: the same component so far) is not compared."""
    pdf = pdf.drop_duplicates(["node", "rest"])
    region = Region(list(pdf["shingles"]), percent)
    seen = pdf["seen"].to_numpy()
    first = {}
    for i, s in enumerate(seen):
        region.union(first.setdefault(s, i), np.array([i]))
    rest = pdf["rest"].to_numpy(bool)
    region.cross(np.flatnonzero(rest), np.arange(len(pdf)))
    return _pairs(region, list(pdf["node"]))


def jaccard_components(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90) -> DataFrame:
    """One row per row of ``df``: ``key``, ``mark`` (a hash of its text), ``n_shingles``,
    ``component_id`` (the smallest id reachable by links of ``percent`` similarity or
    more) and ``component``, the component's own key (null for an empty set)."""
    spark = df.sparkSession
    ship_package(spark)
    rows = materialize(sketch(df, key, text, n, percent), "shingle-rows")
    named = rows.filter("node IS NOT NULL")
    nodes = named.groupBy("node").agg(F.min("id").alias("id"))
    short = F.conv(F.substring(F.hex("node"), 1, 15), 16, 10).cast("bigint")
    # Equal sets of different tasks name the same node twice, which changes nothing below.
    if percent < CROWDED:
        members = _rare_regions(named.select(short.alias("short"), F.inline(F.arrays_zip("regions", "spares"))))
    else:
        members = named.select(short.alias("short"), F.explode("regions").alias("region"))
    shared = members.groupBy("region").agg(F.min("short").alias("v"), F.max("short").alias("other")).filter("v < other").drop("other")
    related = members.join(shared, "region").filter("short <> v").select(F.col("short").alias("u"), "v").distinct()
    groups = components(related)
    candidates = (nodes.select("node", "id", short.alias("short")).join(groups.withColumnRenamed("node", "g"), F.col("short") == F.col("g"))
                  .select("node", "id", "root"))
    candidates = materialize(candidates, "candidates")
    found = materialize(_roots(df, key, text, n, percent, candidates), "component-roots")
    # A node's component id is the smallest id of all rows of all its nodes.
    sets = named.groupBy("node").agg(F.min("id").alias("id"))
    linked = sets.join(found, "node").groupBy("root").agg(F.min("id").alias("component_id"))
    label = materialize(found.join(linked, "root").select("node", "component_id", F.col("root").alias("component")), "component-ids")
    each = sets.join(label, "node", "left").select("node", F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
                                                   F.coalesce("component", "node").alias("component"))
    full = named.select("id", "mark", "n_shingles", "node").join(each, "node").select("id", "mark", "n_shingles", "component_id", "component")
    empty = rows.filter("node IS NULL").select("id", "mark", "n_shingles", F.col("id").alias("component_id"), F.lit(None).cast("binary").alias("component"))
    return full.unionByName(empty).withColumnRenamed("id", key)


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``df`` without their near copies: of each component the row with
    the smallest id stays (ties by a hash of the text), rows without a word all stay."""
    joined = jaccard_components(df, key, text, n, percent).filter("component IS NOT NULL").withColumnRenamed(key, "id")
    copies = joined.groupBy("component", "id", "mark").agg(F.count(F.lit(1)).alias("copies"))
    stays = copies.groupBy("component").agg(F.min_by(F.struct("id", "mark", "copies"), F.struct(F.col("id").isNull(), F.col("id"), F.col("mark"))).alias("s"))
    stays = materialize(stays.select("s.*").withColumnsRenamed({"id": "__id", "mark": "__m", "copies": "__copies"}), "stays")
    marked = df.withColumn("__mark", F.xxhash64(F.col(f"`{text}`").cast("string")))
    held = marked.join(stays, F.col(f"`{key}`").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__m")))
    single = held.filter("__copies = 1").select(*[F.col(f"`{c}`") for c in df.columns])
    several = held.filter("__copies > 1").dropDuplicates(["__id", "__mark"]).select(*[F.col(f"`{c}`") for c in df.columns])
    empty = df.filter(word_count(F.col(f"`{text}`").cast("string")) == 0)
    return single.unionByName(several).unionByName(empty)


def _rare_regions(members: DataFrame) -> DataFrame:
    """(``short``, ``region``) without the regions of one row and without each node's
    most popular regions, as many as it may leave of a kind. Equal counts are ordered by region,
    the same for all nodes (a node that stands here several times counts several
    times, for all alike)."""
    members = members.withColumnRenamed("regions", "region")
    popular = members.groupBy("region").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    order = Window.partitionBy("short", "spares").orderBy(F.col("n").desc(), "region")
    ranked = members.join(popular, "region").withColumn("nth", F.dense_rank().over(order))
    return materialize(ranked.filter(F.col("nth") > F.col("spares") % SPARE).select("short", "region"), "rare-regions")


def _roots(df: DataFrame, key: str, text: str, n: int, percent: int, candidates: DataFrame) -> DataFrame:
    """(``node``, ``root``) of the nodes that are linked with another."""
    ids = candidates.select(F.col("id").alias("wanted")).distinct()
    again = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).join(ids, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")
    sets = (fetch_sets(again, "id", "text", n).join(candidates.select("node", "root"), "node")
            .groupBy("node", "root").agg(F.first("shingles").alias("shingles")))
    sets = materialize(sets, "candidate-sets")
    sizes = materialize(sets.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "candidate-sizes")
    sized = sets.join(sizes, "root")
    small = sized.filter(F.col("n") <= MOST).groupBy("root").applyInPandas(lambda pdf: join_group(pdf, percent), _PAIRS)
    small = small.select(F.col("u").alias("node"), F.col("v").alias("root"))
    large = sizes.filter(F.col("n") > MOST).select("root", F.ceil(F.col("n") / MOST).cast("int").alias("groups"))
    if large.isEmpty():
        return small
    return small.unionByName(components(_large_links(sets.join(large, "root"), percent)))


def _large_links(sets: DataFrame, percent: int) -> DataFrame:
    dealt = materialize(sets.withColumn("group", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int")), "large-sets")
    order = F.struct(F.xxhash64(F.lit(1), "node"), F.col("node"))
    lowest = dealt.groupBy("root", "groups", F.pmod(F.xxhash64(F.lit(2), "node"), F.lit(PIVOTS)).alias("turn")).agg(F.min_by(F.struct("node", "shingles"), order).alias("p"))
    pivots = lowest.select("root", F.col("p.node").alias("node"), F.col("p.shingles").alias("shingles"), "groups")
    spread = pivots.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select("root", "group", "node", "shingles", F.lit(True).alias("pivot"))
    first = dealt.select("root", "group", "node", "shingles", F.lit(False).alias("pivot")).unionByName(spread)
    first = materialize(first.groupBy("root", "group").applyInPandas(lambda pdf: join_pivots(pdf.drop_duplicates("node", keep="last"), percent), _PAIRS), "links")
    so_far = components(first)
    seen = dealt.join(so_far.select("node", F.col("root").alias("seen")), "node", "left").withColumn("seen", F.coalesce("seen", "node"))
    seen = materialize(seen, "large-seen")
    main = seen.groupBy("root", "seen").agg(F.count(F.lit(1)).alias("n")).groupBy("root").agg(F.max_by("seen", F.struct("n", "seen")).alias("main"))
    rest = seen.join(main, "root").filter("seen <> main")
    counts = rest.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / MOST).cast("int").alias("blocks"))
    rest = rest.join(counts, "root").withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int"))
    left = (rest.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
            .select("root", "group", "block", "node", "shingles", "seen", F.lit(True).alias("rest")))
    right = (seen.join(counts, "root").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("root", "group", "block", "node", "shingles", "seen", F.lit(False).alias("rest")))
    second = left.unionByName(right).groupBy("root", "group", "block").applyInPandas(lambda pdf: join_rest(pdf, percent), _PAIRS)
    return first.unionByName(second)
