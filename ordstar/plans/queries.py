"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the whole input tables. Output columns use dot-free names (``safe_name``)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ordstar.functions import text as fn
from ordstar.functions.text import cols
from ordstar.operators import clean, factorised, kpi, nested, parts, pseudonym, quality, sample, star
from ordstar.operators.numbering import dense_number
from ordstar.plans import etl, publish
from ordstar.session import freed_shuffles, materialize, materialize_only, scratch_path
from ordstar.sources.keyed_store import KeyedStore
from ordstar.sources.mapping_store import MappingStore
from ordstar.streaming import incremental
from ordstar.sources import json_docs
from ordstar.sources.adapter import LINE_KEY, flat_columns, full_order_documents, id_lines, masked_staging, order_documents, staging, staging_text
from ordstar.sources.tables import table
from ordstar.sources.text import export_mapping_csv, load_mapping_csv, read_delimited, replace_table, write_delimited
from ordstar.specs import (ID_BLANK_TOKENS, ID_COLUMNS, NAME_COLUMNS, NUMERIC_COLUMNS, ORDER_STAR,
                           SAMPLE_ROWS, TRACEABILITY_MEASURES, VOLUME_MEASURE, safe_name)

Query = Callable[[SparkSession, str], DataFrame]


def safe(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(safe_name(c)) for c in df.columns])


def _star(spark: SparkSession, sf_dir: str, number_fact: bool = True, dims: tuple[str, ...] | None = None, extra: tuple[str, ...] = ()):
    """Star with the dimensions ``dims`` (all by default); staging then holds
    their attributes and the ``extra`` columns only."""
    if dims is None:
        st = staging(spark, sf_dir)
    else:
        st = staging(spark, sf_dir, list(dict.fromkeys([*extra, *[a for d in dims for a in ORDER_STAR.dim(d).attributes]])))
    return st, *star.build_star(st, ORDER_STAR, number_fact=number_fact, dims=dims)


def q_dim(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = ORDER_STAR.dim(name)
        return safe(star.build_dimension(staging(spark, sf_dir, d.attributes), d))
    return run


def q_fact_full_key(spark, sf_dir):
    with parts.in_place(spark):
        return safe(materialize_only(lambda: _star(spark, sf_dir)[2], "fact"))


def q_fact_key(spark, sf_dir):
    st = staging(spark, sf_dir, ["rowId", "type"])
    return dense_number(st, list(LINE_KEY), id_col="id_fact").select("id_fact", "rowId", "type")


def q_fact_partial_key(spark, sf_dir, dim_name: str = "dim_product"):
    """Parity load with the product dimension (the largest fan-out), summed
    per foreign key by eager aggregation (the row-level load is
    ``star.fact_partial_key``)."""
    d = ORDER_STAR.dim(dim_name)
    st = staging(spark, sf_dir, [*d.attributes, "produits.nodes.value", "feedstock.nodes.quantity"])
    dims = {dim_name: star.build_dimension(st, d)}
    out = star.partial_key_summary(st, dims, ORDER_STAR, dim_name, ["produits.nodes.value", "feedstock.nodes.quantity"])
    return out.select(d.key, F.col("n_rows").cast("bigint").alias("n_rows"), F.col("__t0").alias("total_value"),
                      F.col("__t1").alias("total_quantity"))


VOLUMES = ("type", "produits.nodes.value", "feedstock.nodes.quantity", "attributes.volumeContact")


def q_kpi_volume(spark, sf_dir):
    # A fact row's product and trader are its staging row's own: no dimension is needed
    # (``kpi.kpi_volume`` reads them from a star; a test holds both equal).
    st = staging(spark, sf_dir, [*VOLUMES, "produits.nodes.asset.descriptionShort", "attributes.trader"])
    return kpi.volume_report(st.withColumnsRenamed({"produits.nodes.asset.descriptionShort": "product", "attributes.trader": "trader"}))


def q_volume_by_buyer(spark, sf_dir):
    _, dims, fact = _star(spark, sf_dir, False, ("dim_buyer",), VOLUMES[1:3])
    return kpi.volume_by_buyer(fact, dims)


def q_kpi_traceability(spark, sf_dir):
    # Rates and volume are measures of the staging row; no dimension is needed.
    return kpi.kpi_traceability(staging(spark, sf_dir, [*TRACEABILITY_MEASURES, VOLUME_MEASURE]))


def q_kpi_buyers(spark, sf_dir):
    _, dims, fact = _star(spark, sf_dir, False, ("dim_buyer",), ("type",))
    return kpi.kpi_buyers(fact, dims)


def q_fanout_audit(spark, sf_dir):
    st = staging(spark, sf_dir)
    return quality.fanout_audit(st, ORDER_STAR)


def q_integrity_audit(spark, sf_dir):
    # The audit is written inside, so that the fact's rows stay where they are.
    with parts.in_place(spark):
        return materialize_only(lambda: quality.integrity_audit(*_star(spark, sf_dir, number_fact=False)[:0:-1], ORDER_STAR), "audit")


def q_dense_number(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    return dense_number(li, list(LINE_KEY), id_col="id").select("id", *LINE_KEY)


QUERIES: dict[str, Query] = {
    "dim_buyer": q_dim("dim_buyer"),
    "dim_product": q_dim("dim_product"),
    "dim_feedstock": q_dim("dim_feedstock"),
    "dim_certification": q_dim("dim_certification"),
    "dim_trader": q_dim("dim_trader"),
    "dim_poc": q_dim("dim_point_of_contact"),
    "dim_manufacturer": q_dim("dim_manufacturer"),
    "fact_full_key": q_fact_full_key,
    "fact_key": q_fact_key,
    "fact_partial_key": q_fact_partial_key,
    "fanout_audit": q_fanout_audit,
    "integrity_audit": q_integrity_audit,
    "dense_number": q_dense_number,
    "kpi_volume": q_kpi_volume,
    "kpi_traceability": q_kpi_traceability,
    "kpi_buyers": q_kpi_buyers,
    "volume_by_buyer": q_volume_by_buyer,
}


# --- cleaning, sampling, delimited text, scalar functions -------------------

HASH_SAMPLE_ROWS = 10_000
HASH_SEED = "42"
HASH_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def q_coerce_numeric(spark, sf_dir):
    t = staging_text(spark, sf_dir, ["rowId", *NUMERIC_COLUMNS])
    out = clean.coerce_numeric(t.select("rowId", "l_orderkey", "l_linenumber", *cols(NUMERIC_COLUMNS)))
    return safe(out)


def q_coerce_report(spark, sf_dir):
    return clean.coerce_report(staging_text(spark, sf_dir, NUMERIC_COLUMNS))


def q_sample_head(spark, sf_dir):
    # The order key is the line's own and every join is many-to-one: the rows
    # are chosen on the narrow line table, and only those are joined.
    first = materialize(sample.sample_head(table(spark, sf_dir, "lineitem").select(*LINE_KEY), LINE_KEY, SAMPLE_ROWS), "first-lines")
    return safe(staging(spark, sf_dir, lines=first))


def q_sample_hash(spark, sf_dir):
    st = staging(spark, sf_dir, ["rowId"])
    return safe(sample.sample_hash(st, HASH_COLUMNS, LINE_KEY, HASH_SAMPLE_ROWS, HASH_SEED))


def q_csv_roundtrip(spark, sf_dir):
    st = staging(spark, sf_dir)
    flat = flat_columns(st)
    path = scratch_path(spark, "flat-orders-csv")
    write_delimited(st.select(*cols(flat)), path, compression="gzip")
    back = read_delimited(spark, path, flat)
    return safe(clean.coerce_numeric(back))


def q_scalar_parity(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    padded = F.concat(F.lit("\t "), F.col("c_name"), F.lit(" \n"))
    maybe_blank = F.when(F.col("c_acctbal") < 0, F.lit(" \t")).otherwise(F.col("c_name"))
    token = F.concat(F.lit("FAKE_GTIN_"), fn.zfill(F.col("c_custkey"), 6))
    return c.select(
        "c_custkey",
        fn.py_strip(padded).alias("stripped"),
        fn.is_blank(maybe_blank).alias("is_blank"),
        fn.zfill(F.col("c_custkey"), 6).alias("zfill6"),
        fn.zfill(F.col("c_custkey") * 1000, 6).alias("zfill6_wide"),
        fn.capitalize(F.col("c_mktsegment")).alias("capitalized"),
        token.alias("token"),
        fn.last_number(token).alias("token_number"),
        fn.last_number(F.col("c_name")).alias("name_number"),
        fn.py_strip(maybe_blank).isin(*ID_BLANK_TOKENS).alias("is_null_token"),
        F.lower(F.col("c_mktsegment")).contains("build").alias("contains_build"),
        fn.try_number(F.col("c_acctbal").cast("string")).alias("acctbal_number"),
    ).where(F.col("c_acctbal").isNotNull())


QUERIES.update({
    "coerce_numeric": q_coerce_numeric,
    "coerce_report": q_coerce_report,
    "sample_head": q_sample_head,
    "sample_hash": q_sample_hash,
    "csv_roundtrip": q_csv_roundtrip,
    "scalar_parity": q_scalar_parity,
})


# --- pseudonymisation -------------------------------------------------------------

# The queries' salt; a real run brings its own secret.
SALT = "registered-queries"
RESUME_CUTOFF = "1998-01-01"
FALLBACK_COLUMNS = ("rowId", "supplierRef")
CONTACT_COLUMNS = ("attributes.buyerNameContact", "attributes.traderContact", "attributes.manufacturerContact")


def _masked_rows(spark, sf_dir, columns):
    return lambda masked, mask, keep_input=False: masked_staging(spark, sf_dir, columns, masked, mask, keep_input)


def _names(spark, sf_dir, keep_input=False):
    columns = ["rowId", *NAME_COLUMNS, *(CONTACT_COLUMNS if keep_input else ())]
    return pseudonym.pseudonymize(staging(spark, sf_dir, columns), LINE_KEY, name_columns=NAME_COLUMNS, salt=SALT, keep_input=keep_input,
                                  masked_rows=_masked_rows(spark, sf_dir, columns))


def q_pseudo_generate(spark, sf_dir):
    st = staging(spark, sf_dir, NAME_COLUMNS)
    return pseudonym.pseudonymize(st, LINE_KEY, name_columns=NAME_COLUMNS, salt=SALT)[1]


def q_pseudo_names(spark, sf_dir):
    masked = _names(spark, sf_dir)[0]
    return safe(masked.select("rowId", *cols(NAME_COLUMNS), *LINE_KEY))


def q_leak_check(spark, sf_dir):
    def report():
        masked = _names(spark, sf_dir, keep_input=True)[0]
        for c in CONTACT_COLUMNS:
            masked = masked.withColumn(f"__in_{c}", F.col(f"`{c}`"))
        return pseudonym.leak_report(masked, [*NAME_COLUMNS, *CONTACT_COLUMNS], NAME_COLUMNS)

    # The tables that the names are masked in are large; the report is not.
    with freed_shuffles(spark):
        return materialize_only(report, "leaks")


def q_tokenize_ids(spark, sf_dir):
    ids = id_lines(spark, sf_dir)
    return pseudonym.pseudonymize(ids, LINE_KEY, id_columns=ID_COLUMNS, salt=SALT)[2]


def _resume(spark, sf_dir):
    ids = id_lines(spark, sf_dir)
    early = ids.where(F.col("l_shipdate") < F.lit(RESUME_CUTOFF).cast("timestamp_ntz"))
    first = pseudonym.pseudonymize(early, LINE_KEY, id_columns=ID_COLUMNS, salt=SALT)[2]
    return first.unionByName(pseudonym.pseudonymize(ids, LINE_KEY, id_columns=ID_COLUMNS, salt=SALT, id_map=first)[2])


def q_tokenize_resume(spark, sf_dir):
    return _resume(spark, sf_dir)


def q_token_fallback(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    ids = li.select(F.concat(F.lit("PO-"), F.col("l_orderkey").cast("string")).alias("rowId"),
                    F.col("l_suppkey").cast("string").alias("supplierRef"), *LINE_KEY)
    return pseudonym.pseudonymize(ids, LINE_KEY, id_columns=FALLBACK_COLUMNS, salt=SALT)[2]


QUERIES.update({
    "pseudo_generate": q_pseudo_generate,
    "pseudo_names": q_pseudo_names,
    "leak_check": q_leak_check,
    "tokenize_ids": q_tokenize_ids,
    "tokenize_resume": q_tokenize_resume,
    "token_fallback": q_token_fallback,
})


# --- nested documents -----------------------------------------------------------------

NODE_ORDER = ["file", "doc", "pos"]
NODES_PER_DOC = 500


def _nodes(spark, sf_dir):
    """Order documents written as JSON responses, then scanned back."""
    path = scratch_path(spark, "responses")
    json_docs.write_responses(order_documents(spark, sf_dir), ["o_orderkey"], path, NODES_PER_DOC,
                              unique_int_key=True)
    return json_docs.read_responses(spark, path)


# The layout of ``order_documents``, declared: no discovery pass over the texts.
DOC_SCHEMA = (
    "rowId string, type string, tags array<string>, flags struct<partial: boolean>, "
    "buyer struct<nodes: array<struct<name: string, parentCompany: struct<nodes: array<struct<name: string>>>>>>, "
    "point_of_contact struct<nodes: array<struct<name: string>>>, "
    "produits struct<nodes: array<struct<value: double, asset: struct<descriptionShort: string>>>>")
DOC_PATHS = ["rowId", "type", "flags", "flags.partial", "buyer.nodes.name", "buyer.nodes.parentCompany.nodes.name",
             "point_of_contact.nodes.name", "produits.nodes.value", "produits.nodes.asset.descriptionShort"]


def _flat(spark, sf_dir, aligned=False):
    parsed = nested.parse_nodes(_nodes(spark, sf_dir), "node", DOC_SCHEMA, keep=NODE_ORDER)
    make = nested.explode_aligned if aligned else nested.flatten
    return make(parsed, "node", DOC_PATHS, keep=NODE_ORDER), DOC_PATHS


def _as_text(df, columns):
    out = []
    for c in columns:
        dt = df.schema[c].dataType
        if isinstance(dt, ArrayType):
            out.append(F.array_join(F.transform(F.col(f"`{c}`"), lambda x: x.cast("string")), "|").alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def q_json_scan(spark, sf_dir):
    return _nodes(spark, sf_dir).select("pos", "node")


def q_json_paths(spark, sf_dir):
    return nested.discover_paths(_nodes(spark, sf_dir), "node", NODE_ORDER)


def q_json_extract(spark, sf_dir):
    parsed = nested.parse_nodes(_nodes(spark, sf_dir), "node", DOC_SCHEMA)
    schema = parsed.schema["node"].dataType
    root = F.col("node")
    names = nested.path_values(root, schema, "produits.nodes.asset.descriptionShort")
    values = nested.path_values(root, schema, "produits.nodes.value")
    total = F.aggregate(values, F.lit(0).cast("decimal(38,10)"),
                        lambda a, x: (a + x.cast("decimal(38,10)")).cast("decimal(38,10)"))
    return parsed.select(
        F.element_at(nested.path_values(root, schema, "rowId"), 1).alias("rowId"),
        F.element_at(nested.path_values(root, schema, "buyer.nodes.name"), 1).alias("buyer"),
        F.element_at(nested.path_values(root, schema, "buyer.nodes.parentCompany.nodes.name"), 1).alias("parent"),
        F.array_join(names, "|").alias("product_names"),
        F.coalesce(F.size(names), F.lit(0)).alias("n_products"),
        total.cast("double").alias("total_value"))


def q_json_flatten(spark, sf_dir):
    flat, paths = _flat(spark, sf_dir)
    return safe(_as_text(flat, paths))


def _exploded_summary(df):
    return (df.groupBy(F.col("rowId"), F.col("`produits.nodes.asset.descriptionShort`").alias("product"))
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   kpi.exact_sum(F.col("`produits.nodes.value`")).alias("total_value")))


def q_explode_cross(spark, sf_dir):
    flat, paths = _flat(spark, sf_dir)
    multi = [p for p in paths if p in nested.array_columns(flat)]
    out = nested.cross_summary(flat, ["rowId"], "produits.nodes.asset.descriptionShort", "produits.nodes.value", multi)
    return out.withColumnRenamed("__by", "product")


def q_explode_aligned(spark, sf_dir):
    rows, _ = _flat(spark, sf_dir, aligned=True)
    return _exploded_summary(rows)


QUERIES.update({
    "json_scan": q_json_scan,
    "json_paths": q_json_paths,
    "json_extract": q_json_extract,
    "json_flatten": q_json_flatten,
    "explode_cross": q_explode_cross,
    "explode_aligned": q_explode_aligned,
})


# --- mapping state, streaming, publish ------------------------------------------------


def q_mapping_state(spark, sf_dir):
    """Two runs through the versioned store: early lines, then all lines."""
    store = MappingStore(spark, scratch_path(spark, "mapping-store"))
    ids = id_lines(spark, sf_dir)
    runs = [ids.where(F.col("l_shipdate") < F.lit(RESUME_CUTOFF).cast("timestamp_ntz")), ids]
    for rows in runs:
        batch = store.next_batch("id_map")
        prev = store.load("id_map")
        new = pseudonym.pseudonymize(rows, LINE_KEY, id_columns=ID_COLUMNS, salt=SALT, id_map=prev)[2]
        store.write_batch("id_map", new, batch)
    return store.load("id_map", with_batch=True)


def q_mapping_state_names(spark, sf_dir):
    """The name mapping over two runs (early lines, then all), carried from one to
    the other as the ``,`` CSV file."""
    st = staging(spark, sf_dir, NAME_COLUMNS)
    early = st.where(F.col("l_shipdate") < F.lit(RESUME_CUTOFF).cast("timestamp_ntz"))
    saved = scratch_path(spark, "name-map-csv")
    first = pseudonym.pseudonymize(early, LINE_KEY, name_columns=NAME_COLUMNS, salt=SALT)[1]
    export_mapping_csv(first, saved, "name_map")
    back = load_mapping_csv(spark, saved, "name_map")
    new = pseudonym.pseudonymize(st, LINE_KEY, name_columns=NAME_COLUMNS, salt=SALT, name_map=back)[1]
    return back.select("original", "anonymized", F.lit(0).alias("run")).unionByName(new.select("original", "anonymized", F.lit(1).alias("run")))


def q_pseudo_incremental(spark, sf_dir):
    """Lines arrive one ship year at a time; each arrival is one run of an
    ``availableNow`` stream, so each year is one micro-batch."""
    root = scratch_path(spark, "incremental")
    ids = id_lines(spark, sf_dir)
    year = F.year("l_shipdate")
    # The arrival schedule: one entry per ship year (a handful of values).
    years = sorted(r[0] for r in ids.select(year.alias("y")).distinct().collect())
    store = MappingStore(spark, f"{root}/mappings")
    for y in years:
        ids.where(year == y).write.mode("append").parquet(f"{root}/source")
        q = incremental.start_masking_stream(
            spark, f"{root}/source", ids.schema, store, f"{root}/masked", f"{root}/checkpoint",
            LINE_KEY, salt=SALT, id_columns=ID_COLUMNS)
        q.awaitTermination()
    return store.load("id_map", with_batch=True)


STAR_TABLES = (*[d.name for d in ORDER_STAR.dims], "fact_orders")


def q_star_publish(spark, sf_dir):
    root = scratch_path(spark, "star")
    run = publish.publish_star(staging(spark, sf_dir), ORDER_STAR, root)
    parts = [publish.read_published(spark, root, t, run).agg(F.count(F.lit(1)).alias("n_rows"))
                    .select(F.lit(t).alias("table_name"), "n_rows") for t in STAR_TABLES]
    return reduce(DataFrame.unionByName, parts)


QUERIES.update({
    "mapping_state": q_mapping_state,
    "mapping_state_names": q_mapping_state_names,
    "pseudo_incremental": q_pseudo_incremental,
    "star_publish": q_star_publish,
})


def _etl(spark, sf_dir):
    """The source pipeline end to end over documents derived from the tables
    (responses → flat → masked → star): reader of the published tables."""
    responses = scratch_path(spark, "etl-responses")
    with freed_shuffles(spark):
        json_docs.write_responses(full_order_documents(spark, sf_dir), ["o_orderkey"], responses, NODES_PER_DOC, unique_int_key=True)
    out = scratch_path(spark, "etl-out")
    run = etl.order_etl(spark, responses, out, scratch_path(spark, "etl-maps"), salt=SALT, compression="gzip")
    return lambda t: publish.read_published(spark, f"{out}/star", t, run)


def q_order_etl(spark, sf_dir):
    """Row counts of the tables that the whole ETL publishes."""
    read = _etl(spark, sf_dir)
    parts = [read(t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in STAR_TABLES]
    return reduce(DataFrame.unionByName, parts)


def q_etl_dim_buyer(spark, sf_dir):
    return _etl(spark, sf_dir)("dim_buyer")


def q_etl_fact(spark, sf_dir):
    """Every fact row with its masked order id, the keys of the dimensions that
    carry no numbered token, and two measures."""
    return _etl(spark, sf_dir)("fact_orders").select("rowId", "type", "id_buyer", "id_poc", "id_trader", "produits_nodes_value", "feedstock_nodes_quantity")


QUERIES.update({"order_etl": q_order_etl, "etl_dim_buyer": q_etl_dim_buyer, "etl_fact": q_etl_fact})


# --- boundaries and tolerance ------------------------------------------------------------


def q_json_scan_pretty(spark, sf_dir):
    """Responses printed over several lines, one per file."""
    path = scratch_path(spark, "responses-pretty")
    json_docs.write_responses(order_documents(spark, sf_dir), ["o_orderkey"], path, NODES_PER_DOC, unique_int_key=True, pretty=True)
    return json_docs.read_responses(spark, path, multi_line=True).select("pos", "node")


def q_multi_valued(spark, sf_dir):
    return safe(nested.multi_valued(_flat(spark, sf_dir)[0]))


PRESENT_NAMES = tuple(c for c in NAME_COLUMNS if c != "attributes.trader")


def q_pseudo_missing_column(spark, sf_dir):
    """Masking a table that lacks one of the listed columns."""
    st = staging(spark, sf_dir, PRESENT_NAMES)
    return pseudonym.pseudonymize(st, LINE_KEY, name_columns=NAME_COLUMNS, salt=SALT)[1]


def q_replace_table(spark, sf_dir):
    """A table directory written, replaced by other rows, and read back."""
    path = scratch_path(spark, "replaced")
    replace_table(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), path)
    replace_table(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), path)
    return spark.read.parquet(path)


def q_fact_partial_rows(spark, sf_dir):
    """Row-level parity load with the one dimension whose join key is unique, so
    that no row multiplies."""
    d = ORDER_STAR.dim("dim_point_of_contact")
    st = staging(spark, sf_dir, [*ORDER_STAR.fact_text, *ORDER_STAR.measures, *d.attributes])
    return safe(star.fact_partial_key(st, {d.name: star.build_dimension(st, d)}, ORDER_STAR, [d.name]))


QUERIES.update({
    "json_scan_pretty": q_json_scan_pretty,
    "multi_valued": q_multi_valued,
    "pseudo_missing_column": q_pseudo_missing_column,
    "replace_table": q_replace_table,
    "fact_partial_rows": q_fact_partial_rows,
})


# --- rows that multiply ------------------------------------------------------------------

#: Four of the seven dimensions: a line becomes six fact rows (all seven make 29,000 of it).
MULTIPLIED_DIMS = ("dim_buyer", "dim_trader", "dim_point_of_contact", "dim_manufacturer")


def q_fact_multiplied(spark, sf_dir):
    """Row-level parity load whose rows multiply: factorised, then counted out in
    tasks of equal size."""
    chosen = [ORDER_STAR.dim(n) for n in MULTIPLIED_DIMS]
    st = staging(spark, sf_dir, [*ORDER_STAR.fact_text, *ORDER_STAR.measures, *[a for d in chosen for a in d.attributes]])
    st = materialize(st, "staging")
    dims = {d.name: star.build_dimension(st, d) for d in chosen}
    return safe(factorised.expand(factorised.factorise(st, dims, ORDER_STAR, MULTIPLIED_DIMS)))


def q_explode_cross_rows(spark, sf_dir):
    """The cross explode row by row: every value of an order with every product name
    of it (the square of its lines), null where a list is empty."""
    flat, paths = _flat(spark, sf_dir)
    rows = nested.explode_cross(flat, [p for p in paths if p in nested.array_columns(flat)])
    return safe(rows.select("rowId", *cols(["buyer.nodes.name", "buyer.nodes.parentCompany.nodes.name", "point_of_contact.nodes.name",
                                            "produits.nodes.value", "produits.nodes.asset.descriptionShort"])))


QUERIES.update({"fact_multiplied": q_fact_multiplied, "explode_cross_rows": q_explode_cross_rows})


# --- keyed storage, state that merges, originals inside values ------------------------------------


def q_mapping_keyed(spark, sf_dir):
    """Two runs through keyed storage (early lines, then all), merged after each."""
    store = KeyedStore(spark, scratch_path(spark, "keyed-store"), buckets=8, fanout=2)
    ids = id_lines(spark, sf_dir)
    for rows in (ids.where(F.col("l_shipdate") < F.lit(RESUME_CUTOFF).cast("timestamp_ntz")), ids):
        state = store.load("id_map")
        new = pseudonym.pseudonymize(rows, LINE_KEY, id_columns=ID_COLUMNS, salt=SALT, id_map=state)[2]
        store.write_batch("id_map", new, store.next_batch("id_map"), state)
    return store.load("id_map").entries()


def q_pseudo_incremental_both(spark, sf_dir):
    """Names and identifiers masked by one stream over keyed storage: lines arrive in
    two files' worth (before and after the cutoff); both mappings at the end."""
    root = scratch_path(spark, "incremental-both")
    st = staging(spark, sf_dir, [*NAME_COLUMNS, *ID_COLUMNS])
    early = F.col("l_shipdate") < F.lit(RESUME_CUTOFF).cast("timestamp_ntz")
    store = KeyedStore(spark, f"{root}/mappings", buckets=8)
    for part in (st.where(early), st.where(~F.coalesce(early, F.lit(False)))):
        with freed_shuffles(spark):
            part.write.mode("append").parquet(f"{root}/source")
        q = incremental.start_masking_stream(spark, f"{root}/source", st.schema, store, f"{root}/masked", f"{root}/checkpoint",
                                             LINE_KEY, salt=SALT, name_columns=NAME_COLUMNS, id_columns=ID_COLUMNS)
        q.awaitTermination()
    found = store.load("name_map").entries().select(F.lit("name").alias("kind"), "original", F.col("anonymized").alias("masked"))
    return found.unionByName(store.load("id_map").entries().select(F.lit("id").alias("kind"), "original", F.col("fake").alias("masked")))


def q_pseudo_contacts(spark, sf_dir):
    """Names and the contact columns masked in one namespace: the rows with every
    masked value, so that nothing of the contacts is left."""
    listed = [*NAME_COLUMNS, *CONTACT_COLUMNS]
    masked = pseudonym.pseudonymize(staging(spark, sf_dir, ["rowId", *listed]), LINE_KEY, name_columns=listed, salt=SALT,
                                    masked_rows=_masked_rows(spark, sf_dir, ["rowId", *listed]))[0]
    return safe(masked.select("rowId", *cols(listed), *LINE_KEY))


KPI_KEYS, KPI_MEASURES = ["type"], ["produits.nodes.value", "feedstock.nodes.quantity"]


def q_kpi_merged(spark, sf_dir):
    """KPIs of two loads, kept as state per load and merged; the estimate of buyers
    is compared with the exact number, three standard errors allowed."""
    st = staging(spark, sf_dir, ["type", *KPI_MEASURES, "buyer.nodes.name"])
    early = F.coalesce(F.col("l_shipdate") < F.lit(RESUME_CUTOFF).cast("timestamp_ntz"), F.lit(False))
    root = scratch_path(spark, "kpi-states")
    for load, rows in enumerate((st.where(early), st.where(~early))):
        kpi.kpi_state(rows, KPI_KEYS, KPI_MEASURES, "buyer.nodes.name").write.parquet(f"{root}/load={load}")
    merged = kpi.merge_states(spark.read.parquet(root), KPI_KEYS, len(KPI_MEASURES))
    state = kpi.read_state(merged, KPI_KEYS, ["total_value", "total_quantity"])
    exact = st.groupBy("type").agg(F.countDistinct(F.col("`buyer.nodes.name`")).alias("__exact"))
    near = F.abs(F.col("n_buyers") - F.col("__exact")) <= F.greatest(F.lit(1.0), 3 * kpi.SKETCH_ERROR * F.col("__exact"))
    joined = state.join(exact, state["type"].eqNullSafe(exact["type"]))
    return joined.select(state["type"], "n_lines", "total_value", "total_quantity", near.alias("buyers_within_error"))


def q_leak_inside(spark, sf_dir):
    """Originals inside longer output values: a note that names the buyer and the
    trader was left unmasked, another column names nobody."""
    st = staging(spark, sf_dir, ["buyer.nodes.name", "attributes.trader", "attributes.feedstock"])
    st = st.withColumn("note", F.concat(F.lit("Sold to "), F.coalesce(F.col("`buyer.nodes.name`"), F.lit("nobody")), F.lit(", by "), F.col("`attributes.trader`")))
    st = st.withColumn("remark", F.concat(F.lit("Kind: "), F.col("`attributes.feedstock`")))
    originals = st.select(F.explode(F.array(F.col("`buyer.nodes.name`"), F.col("`attributes.trader`"))).alias("original")).where(F.col("original").isNotNull()).distinct()
    return pseudonym.embedded_leaks(st, ["note", "remark", "attributes.trader"], originals)


QUERIES.update({
    "mapping_keyed": q_mapping_keyed,
    "pseudo_incremental_both": q_pseudo_incremental_both,
    "kpi_merged": q_kpi_merged,
    "leak_inside": q_leak_inside,
    "pseudo_contacts": q_pseudo_contacts,
})
