"""Star schema: dimensions with surrogate keys, and the fact load.

* ``build_dimension``: distinct attribute rows (hash aggregate with map-side
  partial aggregation, so hot values are combined before the shuffle), then a
  dense surrogate key ordered by all attributes, nulls first.
* ``fact_full_key``: each staging row joined to each dimension on *all*
  attributes with null-safe equality: exactly one fact row per staging row.
* ``fact_partial_key``: the parity load: each dimension joined on its single
  ``join_key`` with ``=``; a key shared by several dimension rows multiplies
  the staging row. Null keys never match; they join on a per-row key so they
  do not all hash to one shuffle partition.

Dimension joins are left to the planner: a dimension below the broadcast
threshold (measured by AQE at runtime) is broadcast, a large one is
sort-merged, and AQE splits a skewed staging partition. Inside ``parts.in_place``
``build_star`` moves no staging row for a large dimension, but hashes of attributes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordstar.functions.text import col, cols
from ordstar.operators import parts
from ordstar.operators.numbering import dense_number
from ordstar.session import broadcast_limit, materialize
from ordstar.sources.adapter import LINE_KEY
from ordstar.specs import DimSpec, StarSpec


def build_dimension(staging: DataFrame, dim: DimSpec) -> DataFrame:
    d = staging
    for a in dim.not_null:
        d = d.where(col(a).isNotNull())
    d = d.select(*cols(dim.attributes)).distinct()
    d = dense_number(d, list(dim.attributes), id_col=dim.key, nulls_first=True)
    return d.select(F.col(dim.key).cast("bigint").alias(dim.key), *cols(dim.attributes))


def build_dimensions(staging: DataFrame, spec: StarSpec) -> dict[str, DataFrame]:
    """All dimensions in one scan, one distinct and one numbering pass.

    Each staging row yields one ``(dimension, attribute array)`` entry per
    dimension; the distinct is a single hash aggregate (partial aggregation
    runs before the shuffle) and the keys come from one grouped dense
    numbering. Array order is element-wise with nulls first, which is the
    attributes' ``ASC NULLS FIRST`` order.
    """
    return _dimensions(_numbered_dimensions(staging, spec), spec)


def _numbered_dimensions(staging: DataFrame, spec: StarSpec) -> DataFrame:
    return dense_number(distinct_dimension_rows(staging, spec), ["attrs"], id_col="__key", groups=["dim"], nulls_first=True)


def _dimensions(numbered: DataFrame, spec: StarSpec) -> dict[str, DataFrame]:
    out = {}
    for i, d in enumerate(spec.dims):
        out[d.name] = numbered.where(F.col("dim") == i).select(
            F.col("__key").cast("bigint").alias(d.key),
            *[F.col("attrs")[j].alias(a) for j, a in enumerate(d.attributes)])
    return out


def small_dimensions(numbered: DataFrame, spec: StarSpec) -> set[str]:
    """Dimensions whose rows take no more than the broadcast threshold. They share one written
    table, whose file size would hide that most of them are small."""
    cells = F.aggregate("attrs", F.lit(0).cast("bigint"), lambda n, a: n + ATTRIBUTE_BYTES + F.coalesce(F.octet_length(a), F.lit(0)))
    sizes = numbered.groupBy("dim").agg(F.sum(cells).alias("n")).collect()  # one number per dimension
    limit, found = broadcast_limit(numbered.sparkSession), {r["dim"]: r["n"] for r in sizes}
    return {d.name for i, d in enumerate(spec.dims) if found.get(i, 0) <= limit}


#: Rough bytes of an attribute of a broadcast row beside its text.
ATTRIBUTE_BYTES = 24


def distinct_dimension_rows(staging: DataFrame, spec: StarSpec) -> DataFrame:
    """``(dim, attrs)``: the distinct attribute rows of every dimension, from
    one scan (one explode, one hash aggregate with map-side combine)."""
    entries = []
    for i, d in enumerate(spec.dims):
        ok = F.lit(True)
        for a in d.not_null:
            ok = ok & col(a).isNotNull()
        entry = F.struct(F.lit(i).alias("dim"),
                         F.array(*[col(a).cast("string") for a in d.attributes]).alias("attrs"))
        entries.append(F.when(ok, entry))
    return (staging.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
                   .select("e.dim", "e.attrs").distinct())


def _prefixed(dim_df: DataFrame, dim: DimSpec, attrs) -> DataFrame:
    return dim_df.select(F.col(dim.key), *[col(a).cast("string").alias(f"__d_{i}") for i, a in enumerate(attrs)])


def _same(left: DataFrame, right: DataFrame, d: DimSpec) -> list:
    return [left[f"`{a}`"].cast("string").eqNullSafe(right[f"__d_{i}"]) for i, a in enumerate(d.attributes)]


def _tuple_hash(values: Sequence) -> Column:
    """One hash of a whole row of attributes; which of them are null counts too."""
    return F.xxhash64(*values, *[v.isNull() for v in values])


def _joined(x: DataFrame, right: DataFrame, d: DimSpec) -> DataFrame:
    # One hash of the whole tuple is the shuffle key; the null-safe recheck
    # makes the match exact.
    right = right.withColumn("__dh", F.xxhash64(*[F.col(f"__d_{i}") for i in range(len(d.attributes))]))
    left = x.withColumn("__sh", F.xxhash64(*[col(a).cast("string") for a in d.attributes]))
    cond = [left["__sh"] == right["__dh"], *_same(left, right, d)]
    return left.join(right, reduce(lambda p, q: p & q, cond), "left").drop("__sh", "__dh", *[f"__d_{i}" for i in range(len(d.attributes))])


def fact_full_key(staging: DataFrame, dims: dict[str, DataFrame], spec: StarSpec,
                  order_key=LINE_KEY, numbered: bool = True, seq_col: str | None = None, small=frozenset(), pinned: DataFrame | None = None) -> DataFrame:
    """One fact row per staging row; foreign keys by null-safe full match.

    Dimensions named in ``small`` are broadcast, and joined first: their attributes
    are gone when rows move to the large ones.

    ``pinned`` are the staging rows as ``parts.pin_parts`` wrote them (``staging`` is made
    of them), and ``dims`` were built from all of them: then hashes move to a large
    dimension instead of rows, unless two of its rows share one.

    The fact key follows the staging order. When staging already carries a
    dense sequence (``seq_col``), that is the key; otherwise the fact is
    numbered with the distributed dense numbering.
    """
    x = staging
    for d in sorted(spec.dims, key=lambda d: d.name not in small):
        right = _prefixed(dims[d.name], d, d.attributes)
        if d.name in small:
            x = _joined(x, F.broadcast(right), d)
            continue
        hashed = right.select(d.key, _tuple_hash([F.col(f"__d_{i}") for i in range(len(d.attributes))]).alias("__h"))
        if pinned is None or not hashed.groupBy("__h").count().where("count > 1").isEmpty():
            x = _joined(x, right, d)
            continue
        # Every row of the dimension has a hash of its own, and every staging row that has the
        # attributes a dimension row needs is in it: equal hashes are equal attributes.
        own = _tuple_hash([col(a).cast("string") for a in d.attributes])
        if d.not_null:
            own = F.when(reduce(lambda p, q: p & q, [col(a).isNotNull() for a in d.not_null]), own)
        x = x.withColumn("__h", own).join(parts.answers(pinned, {"__h": own}, hashed), [parts.PART, "__h"], "left").drop("__h")
    if numbered and seq_col is not None:
        fk = [d.key for d in spec.dims]
        return x.select(F.col(seq_col).cast("bigint").alias(spec.fact_key), *cols(spec.fact_text),
                        *[F.col(k) for k in fk], *[col(m).cast("double").alias(m) for m in spec.measures])
    return _fact_columns(x, spec, order_key, numbered)


def fact_partial_key(staging: DataFrame, dims: dict[str, DataFrame], spec: StarSpec,
                     dim_names=None, order_key=LINE_KEY, numbered: bool = False) -> DataFrame:
    """Parity load: LEFT JOIN each dimension on its single join key (``=``).

    A null key never matches. Such rows join on a per-row key instead (with a
    condition that keeps them from matching), so a column that is a third
    null spreads over all partitions rather than one.
    """
    chosen = [d for d in spec.dims if dim_names is None or d.name in dim_names]
    x = staging.withColumn("__row", F.monotonically_increasing_id().cast("string"))
    for d in chosen:
        right = (dims[d.name].where(col(d.join_key).isNotNull())
                             .select(F.col(d.key), col(d.join_key).alias("__jk")))
        has_key = col(d.join_key).isNotNull()
        x = (x.withColumn("__has", has_key)
              .withColumn("__k", F.when(F.col("__has"), col(d.join_key).cast("string")).otherwise(F.col("__row")))
              .join(right, (F.col("__k") == F.col("__jk")) & F.col("__has"), "left")
              .drop("__has", "__k", "__jk"))
    fk = [d.key for d in chosen]
    return _fact_columns(x, spec, order_key, numbered, fk=fk)


def _fact_columns(x: DataFrame, spec: StarSpec, order_key, numbered: bool, fk=None) -> DataFrame:
    fk = fk if fk is not None else [d.key for d in spec.dims]
    out = [*cols(spec.fact_text), *[F.col(k) for k in fk], *[col(m).cast("double").alias(m) for m in spec.measures]]
    if not numbered:
        return x.select(*out)
    keyed = x.select(*out, *[F.col(k) for k in order_key])
    num = dense_number(keyed, list(order_key), id_col=spec.fact_key)
    return num.select(F.col(spec.fact_key).cast("bigint").alias(spec.fact_key), *cols([*spec.fact_text, *fk, *spec.measures]))


def build_star(staging: DataFrame, spec: StarSpec, pin_staging: bool = True,
               number_fact: bool = True, order_key=LINE_KEY, dims: Sequence[str] | None = None, seq_col: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Dimensions and full-key fact; with ``dims`` only the named dimensions and
    their foreign keys (staging then needs their columns only).

    Staging feeds every dimension and the fact, so it is written once to the
    scratch folder (the staging table). When the fact needs its key, staging
    is written in key order with its dense sequence — one sort serves both.

    Inside ``parts.in_place`` the written rows stay: what moves for the fact's key are the
    order keys, for a large dimension hashes. The fact has to be written inside, too. ``seq_col``
    is a dense sequence in ``order_key`` that pinned staging already has.
    """
    if dims is not None:
        spec = replace(spec, dims=tuple(d for d in spec.dims if d.name in dims), measures=tuple(m for m in spec.measures if m in staging.columns),
                       fact_text=tuple(t for t in spec.fact_text if t in staging.columns))
    if pin_staging and parts.staying(staging.sparkSession):
        return _star_in_place(staging, spec, number_fact, order_key, seq_col)
    seq = None
    if pin_staging and number_fact:
        seq = "__seq"
        staging = dense_number(staging, list(order_key), id_col=seq)
    elif pin_staging:
        staging = materialize(staging, "staging")
    numbered = _numbered_dimensions(staging, spec)
    tables, small = _dimensions(numbered, spec), small_dimensions(numbered, spec)
    return tables, fact_full_key(staging, tables, spec, order_key=order_key, numbered=number_fact, seq_col=seq, small=small)


def _star_in_place(staging: DataFrame, spec: StarSpec, number_fact: bool, order_key, seq_col) -> tuple[dict[str, DataFrame], DataFrame]:
    pinned = staging if parts.PART in staging.columns else parts.pin_parts(staging, "staging")
    numbered = _numbered_dimensions(pinned, spec)
    tables, small = _dimensions(numbered, spec), small_dimensions(numbered, spec)
    rows = pinned
    if number_fact and seq_col is None:
        seq_col = "__seq"
        rows = parts.number_rows(pinned, order_key, seq_col)
    return tables, fact_full_key(rows, tables, spec, order_key=order_key, numbered=number_fact, seq_col=seq_col, small=small, pinned=pinned)


def partial_key_summary(staging: DataFrame, dims: dict[str, DataFrame], spec: StarSpec, dim_name: str,
                        measures, dtype: str = "decimal(38,10)") -> DataFrame:
    """Per foreign key of a parity (partial-key) load with one dimension: fact
    rows and exact measure sums, without materialising the fan-out.

    Each staging row is repeated once per dimension row sharing its join key,
    so a dimension row's totals are its key's staging totals: staging is
    aggregated per join key first (map-side combine), joined to the small
    ``(key, join key)`` list, and rows with no match (null or unknown key)
    form the null-key group.
    """
    d = spec.dim(dim_name)
    k = col(d.join_key).cast("string")
    sums = [F.sum(col(m).cast(dtype)).alias(f"__s{i}") for i, m in enumerate(measures)]
    per_key = staging.groupBy(k.alias("__jk")).agg(F.count(F.lit(1)).alias("__n"), *sums)
    right = dims[dim_name].where(col(d.join_key).isNotNull()).select(
        F.col(d.key), col(d.join_key).cast("string").alias("__dk"))
    matched = per_key.join(right, F.col("__jk") == F.col("__dk"), "inner").drop("__dk", "__jk")
    unmatched = (per_key.join(right, F.col("__jk") == F.col("__dk"), "left_anti").drop("__jk")
                        .withColumn(d.key, F.lit(None).cast("bigint")))
    both = matched.unionByName(unmatched)
    return both.groupBy(d.key).agg(F.sum("__n").alias("n_rows"), *[
        F.sum(f"__s{i}").cast("double").alias(f"__t{i}") for i in range(len(measures))])
