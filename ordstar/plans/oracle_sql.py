"""Reference SQL (DuckDB dialect) for every registered query.

Each string runs against the input tables registered as views and must give
the same rows, column names and values as the Spark query of the same name.
The SQL is generated from the same specs the Spark code uses, so a column
list is written once.
"""

from __future__ import annotations

import re

from ordstar.sources.adapter import LINE_KEY, NO_BUYER_PRIORITY, NO_CONTACT_REGION
from ordstar.specs import ORDER_STAR, TRACEABILITY_MEASURES, VOLUME_MEASURE, DimSpec, safe_name


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def sq(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def alias(expr: str, name: str) -> str:
    return f"{expr} AS {q(safe_name(name))}"


LINE_ORDER = ", ".join(f"{k} ASC NULLS FIRST" for k in LINE_KEY)

STAGING_CTES = f"""
cust AS (
  SELECT c_custkey, c_name, c_mktsegment, n_name, r_name
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
),
supp AS (
  SELECT s_suppkey, s_name, n_name AS s_nation
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
),
oc AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, c_name, c_mktsegment, n_name, r_name
  FROM orders LEFT JOIN cust ON o_custkey = c_custkey
),
staging AS (
  SELECT
    'PO-' || CAST(l_orderkey AS VARCHAR) AS "rowId",
    o_orderstatus AS "type",
    c_mktsegment AS "attributes.buyerNameContact",
    p_type AS "attributes.feedstock",
    s_name AS "attributes.trader",
    s_nation AS "attributes.traderContact",
    p_brand || '-F' AS "attributes.sellingManufacturerFacilityName",
    p_brand AS "attributes.manufacturer",
    p_type AS "attributes.manufacturerContact",
    l_discount AS "attributes.millsTracabilityPo",
    l_tax AS "attributes.millsTracabilityPko",
    CAST(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END AS DOUBLE) AS "attributes.plantationsTracabilityPo",
    CAST(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax END AS DOUBLE) AS "attributes.plantationsTracabilityPko",
    p_retailprice AS "attributes.volumeContact",
    CASE WHEN o_orderpriority = {sq(NO_BUYER_PRIORITY)} THEN NULL ELSE c_name END AS "buyer.nodes.name",
    n_name AS "buyer.nodes.parentCompany.nodes.name",
    CASE WHEN r_name = {sq(NO_CONTACT_REGION)} THEN NULL ELSE r_name END AS "point_of_contact.nodes.name",
    l_quantity AS "produits.nodes.value",
    'KG' AS "produits.nodes.unit",
    p_name AS "produits.nodes.asset.descriptionShort",
    CAST(p_partkey AS VARCHAR) AS "produits.nodes.asset.attributes.gtin",
    p_brand AS "produits.nodes.asset.attributes.hsCode",
    CAST(NULL AS VARCHAR) AS "produits.nodes.asset.attributes.descriptionShort",
    CAST(p_size AS VARCHAR) AS "produits.nodes.asset.attributes.regulatedProductName",
    p_type AS "produits.nodes.asset.attributes.category",
    'false' AS "produits.nodes.asset.attributes.isComponent",
    CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'CORE' END AS "produits.nodes.asset.attributes.productLine",
    CAST(NULL AS VARCHAR) AS "produits.nodes.asset.attributes.countryOfOrigin",
    l_extendedprice AS "feedstock.nodes.quantity",
    'KG' AS "feedstock.nodes.unit",
    p_brand AS "feedstock.nodes.asset.descriptionShort",
    p_type AS "feedstock.nodes.rawMaterial.name",
    l_returnflag AS "transactionExpectedCertificateNomenclatures.nodes.type",
    l_linestatus AS "transactionExpectedCertificateNomenclatures.nodes.level",
    o_orderpriority AS "transactionExpectedCertificateNomenclatures.nodes.tradeItem.descriptionShort",
    {", ".join(LINE_KEY)}
  FROM lineitem
  LEFT JOIN oc ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supp ON l_suppkey = s_suppkey
)"""


def dim_cte(d: DimSpec) -> str:
    attrs = ", ".join(q(a) for a in d.attributes)
    order = ", ".join(f"{q(a)} ASC NULLS FIRST" for a in d.attributes)
    where = " AND ".join(f"{q(a)} IS NOT NULL" for a in d.not_null)
    where = f" WHERE {where}" if where else ""
    return (f"{d.name} AS (SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS {d.key}, {attrs} "
            f"FROM (SELECT DISTINCT {attrs} FROM staging{where}) t)")


DIM_CTES = ",\n".join(dim_cte(d) for d in ORDER_STAR.dims)


def _fact_cte() -> str:
    joins = []
    for i, d in enumerate(ORDER_STAR.dims):
        cond = " AND ".join(f"s.{q(a)} IS NOT DISTINCT FROM d{i}.{q(a)}" for a in d.attributes)
        joins.append(f"LEFT JOIN {d.name} d{i} ON {cond}")
    fks = ", ".join(f"d{i}.{d.key}" for i, d in enumerate(ORDER_STAR.dims))
    meas = ", ".join(f"CAST(s.{q(m)} AS DOUBLE) AS {q(m)}" for m in ORDER_STAR.measures)
    text = ", ".join(f"s.{q(t)}" for t in ORDER_STAR.fact_text)
    order = ", ".join(f"s.{k} ASC NULLS FIRST" for k in LINE_KEY)
    return (f"fact AS (SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS id_fact, "
            f"{text}, {fks}, {meas} FROM staging s {' '.join(joins)})")


FACT_CTE = _fact_cte()


def with_star(body: str) -> str:
    return f"WITH {STAGING_CTES},\n{DIM_CTES},\n{FACT_CTE}\n{body}"


def with_staging(body: str, extra: str = "") -> str:
    extra = f",\n{extra}" if extra else ""
    return f"WITH {STAGING_CTES}{extra}\n{body}"


def dim_query(d: DimSpec) -> str:
    cols = ", ".join([d.key, *[alias(q(a), a) for a in d.attributes]])
    return with_staging(f"SELECT {cols} FROM {d.name}", dim_cte(d))


def fact_full_key_query() -> str:
    d = ORDER_STAR
    cols = ["id_fact", *[alias(q(t), t) for t in d.fact_text], *[x.key for x in d.dims],
            *[alias(q(m), m) for m in d.measures]]
    return with_star(f"SELECT {', '.join(cols)} FROM fact")


def fact_key_query() -> str:
    return with_star('SELECT id_fact, "rowId" AS "rowId", "type" AS "type" FROM fact')


def _money_sum(c: str, dtype: str = "DECIMAL(38,10)") -> str:
    return f"CAST(SUM(CAST({c} AS {dtype})) AS DOUBLE)"


def fact_partial_key_query(dim_name: str = "dim_product") -> str:
    d = ORDER_STAR.dim(dim_name)
    body = f"""
SELECT d.{d.key} AS {d.key}, COUNT(*) AS n_rows,
       {_money_sum('s."produits.nodes.value"')} AS total_value,
       {_money_sum('s."feedstock.nodes.quantity"')} AS total_quantity
FROM staging s LEFT JOIN {d.name} d ON s.{q(d.join_key)} = d.{q(d.join_key)}
GROUP BY d.{d.key}"""
    return with_staging(body, dim_cte(d))


def kpi_volume_query() -> str:
    body = f"""
, x AS (
  SELECT f.*, p."produits.nodes.asset.descriptionShort" AS product, t."attributes.trader" AS trader
  FROM fact f LEFT JOIN dim_product p USING (id_product) LEFT JOIN dim_trader t USING (id_trader)
)
SELECT CASE WHEN GROUPING(type, product, trader) = 3 THEN 'type'
            WHEN GROUPING(type, product, trader) = 5 THEN 'product' ELSE 'trader' END AS level,
       CASE WHEN GROUPING(type, product, trader) = 3 THEN type
            WHEN GROUPING(type, product, trader) = 5 THEN product ELSE trader END AS key,
       COUNT(*) AS n_lines,
       {_money_sum('"produits.nodes.value"')} AS total_value,
       {_money_sum('"feedstock.nodes.quantity"')} AS total_quantity,
       {_money_sum('"attributes.volumeContact"')} AS total_volume_contact
FROM x GROUP BY GROUPING SETS ((type), (product), (trader))"""
    return with_star(body)


def volume_by_buyer_query() -> str:
    body = f"""
SELECT b."buyer.nodes.name" AS buyer, COUNT(*) AS n_lines,
       {_money_sum('f."produits.nodes.value"')} AS total_value,
       {_money_sum('f."feedstock.nodes.quantity"')} AS total_quantity
FROM fact f LEFT JOIN dim_buyer b USING (id_buyer)
GROUP BY b."buyer.nodes.name\""""
    return with_star(body)


def kpi_traceability_query() -> str:
    parts = []
    v = q(VOLUME_MEASURE)
    for m in TRACEABILITY_MEASURES:
        r = q(m)
        vr = f"CASE WHEN {r} IS NOT NULL THEN {v} END"
        parts.append(f"""SELECT {sq(m)} AS measure,
  {_money_sum(r)} / COUNT({r}) AS avg_rate,
  {_money_sum(f'{vr} * {r}')} / {_money_sum(vr)} AS weighted_rate,
  CAST(COUNT({r}) AS DOUBLE) / COUNT(*) AS coverage,
  COUNT({r}) AS n_values
FROM fact""")
    return with_star("\n" + "\nUNION ALL\n".join(parts))


def kpi_buyers_query() -> str:
    body = """
SELECT CASE WHEN GROUPING(type) = 1 THEN 'ALL' ELSE 'type' END AS level, type,
       COUNT(DISTINCT b."buyer.nodes.name") AS n_buyers
FROM fact f LEFT JOIN dim_buyer b USING (id_buyer)
GROUP BY ROLLUP (type)"""
    return with_star(body)


def fanout_audit_query() -> str:
    per_dim = []
    joins = []
    mults = []
    for i, d in enumerate(ORDER_STAR.dims):
        per_dim.append(f"""k{i} AS (SELECT {q(d.join_key)} AS k, COUNT(*) AS m FROM {d.name} GROUP BY 1)""")
        joins.append(f"LEFT JOIN k{i} ON s.{q(d.join_key)} = k{i}.k")
        mults.append(f"COALESCE(k{i}.m, 1)")
    sums = ", ".join(f"CAST(SUM({m}) AS DECIMAL(38,0)) AS f{i}" for i, m in enumerate(mults))
    stats = "\nUNION ALL\n".join(
        f"SELECT {sq(d.name)} AS dimension, CAST(SUM(m) AS BIGINT) AS dim_rows, COUNT(k) AS join_keys, "
        f"COUNT(CASE WHEN m > 1 THEN 1 END) AS dup_keys, MAX(m) AS max_fanout, "
        f"(SELECT f{i} FROM sums) AS fact_rows, (SELECT staging_rows FROM sums) AS staging_rows FROM k{i}"
        for i, d in enumerate(ORDER_STAR.dims))
    body = f""",
{", ".join(per_dim)},
sums AS (SELECT {sums}, CAST(SUM({' * '.join(f'{m}::HUGEINT' for m in mults)}) AS DECIMAL(38,0)) AS fall, COUNT(*) AS staging_rows
         FROM staging s {' '.join(joins)})
{stats}
UNION ALL
SELECT 'ALL', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
       fall, staging_rows FROM sums"""
    return with_star(body)


def integrity_audit_query() -> str:
    parts = []
    for d in ORDER_STAR.dims:
        attrs = ", ".join(q(a) for a in d.attributes)
        parts.append(f"""SELECT {sq(d.name)} AS dimension,
  (SELECT COUNT(*) FROM (SELECT {d.key} FROM {d.name} GROUP BY 1 HAVING COUNT(*) > 1) t) AS duplicate_keys,
  (SELECT COUNT(*) FROM (SELECT {attrs} FROM {d.name} GROUP BY ALL HAVING COUNT(*) > 1) t) AS duplicate_rows,
  (SELECT COUNT(*) FROM fact f WHERE f.{d.key} IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM {d.name} x WHERE x.{d.key} = f.{d.key})) AS orphan_fks,
  (SELECT COUNT(*) FROM fact f WHERE f.{d.key} IS NULL) AS null_fks""")
    return with_star("\n" + "\nUNION ALL\n".join(parts))


def dense_number_query() -> str:
    return f"SELECT CAST(row_number() OVER (ORDER BY {LINE_ORDER}) AS BIGINT) AS id, {', '.join(LINE_KEY)} FROM lineitem"


# --- cleaning, sampling, delimited text, scalar functions -------------------

_WS = r"'^\s+|\s+$'"
_NUM = r"'[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?'"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {_WS}, '', 'g')"


def sql_try_number(x: str) -> str:
    s = sql_strip(f"CAST({x} AS VARCHAR)")
    return (f"CASE WHEN regexp_full_match({s}, {_NUM}) THEN TRY_CAST({s} AS DOUBLE) "
            f"WHEN lower({s}) IN ('inf', '+inf', 'infinity', '+infinity') THEN CAST('inf' AS DOUBLE) "
            f"WHEN lower({s}) IN ('-inf', '-infinity') THEN CAST('-inf' AS DOUBLE) END")


def sql_zfill(x: str, width: int) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return f"CASE WHEN length({s}) < {width} THEN lpad({s}, {width}, '0') ELSE {s} END"


def _stext_cte() -> str:
    from ordstar.specs import NUMERIC_COLUMNS

    v = q("produits.nodes.value")
    repl = [f"""CASE l_linenumber % 7 WHEN 0 THEN 'n/a' WHEN 3 THEN '1,5'
         WHEN 5 THEN ' ' || CAST({v} AS VARCHAR) || ' ' ELSE CAST({v} AS VARCHAR) END AS {v}"""]
    repl += [f"CAST({q(m)} AS VARCHAR) AS {q(m)}" for m in NUMERIC_COLUMNS if m != "produits.nodes.value"]
    return f"stext AS (SELECT * REPLACE ({', '.join(repl)}) FROM staging)"


def coerce_numeric_query() -> str:
    from ordstar.specs import NUMERIC_COLUMNS

    cols = ['"rowId" AS "rowId"', "l_orderkey", "l_linenumber",
            *[alias(sql_try_number(q(m)), m) for m in NUMERIC_COLUMNS]]
    return with_staging(f"SELECT {', '.join(cols)} FROM stext", _stext_cte())


def coerce_report_query() -> str:
    from ordstar.specs import NUMERIC_COLUMNS

    parts = [f"SELECT {sq(m)} AS \"column\", COUNT({q(m)}) AS n_text, COUNT({sql_try_number(q(m))}) AS n_numbers, "
             f"COUNT({q(m)}) - COUNT({sql_try_number(q(m))}) AS n_coerced_null FROM stext"
             for m in NUMERIC_COLUMNS]
    return with_staging("\n" + "\nUNION ALL\n".join(parts), _stext_cte())


FLAT_STAGING = [
    "rowId", "type", "attributes.buyerNameContact", "attributes.feedstock", "attributes.trader",
    "attributes.traderContact", "attributes.sellingManufacturerFacilityName", "attributes.manufacturer",
    "attributes.manufacturerContact", "attributes.millsTracabilityPo", "attributes.millsTracabilityPko",
    "attributes.plantationsTracabilityPo", "attributes.plantationsTracabilityPko", "attributes.volumeContact",
    "buyer.nodes.name", "buyer.nodes.parentCompany.nodes.name", "point_of_contact.nodes.name",
    "produits.nodes.value", "produits.nodes.unit", "produits.nodes.asset.descriptionShort",
    "produits.nodes.asset.attributes.gtin", "produits.nodes.asset.attributes.hsCode",
    "produits.nodes.asset.attributes.descriptionShort", "produits.nodes.asset.attributes.regulatedProductName",
    "produits.nodes.asset.attributes.category", "produits.nodes.asset.attributes.isComponent",
    "produits.nodes.asset.attributes.productLine", "produits.nodes.asset.attributes.countryOfOrigin",
    "feedstock.nodes.quantity", "feedstock.nodes.unit", "feedstock.nodes.asset.descriptionShort",
    "feedstock.nodes.rawMaterial.name", "transactionExpectedCertificateNomenclatures.nodes.type",
    "transactionExpectedCertificateNomenclatures.nodes.level",
    "transactionExpectedCertificateNomenclatures.nodes.tradeItem.descriptionShort",
]


def sample_head_query(n: int) -> str:
    cols = [alias(q(c), c) for c in FLAT_STAGING] + list(LINE_KEY)
    return with_staging(f"SELECT {', '.join(cols)} FROM staging ORDER BY {LINE_ORDER} LIMIT {n}")


def sample_hash_query(n: int, seed: str, hash_cols) -> str:
    h = "sha256(concat_ws('|', " + ", ".join([sq(seed), *[f"CAST({c} AS VARCHAR)" for c in hash_cols]]) + "))"
    cols = ['"rowId" AS "rowId"', *LINE_KEY]
    return with_staging(f"SELECT {', '.join(cols)} FROM staging ORDER BY {h}, {LINE_ORDER} LIMIT {n}")


def csv_roundtrip_query() -> str:
    from ordstar.specs import CSV_NA_TOKENS, NUMERIC_COLUMNS

    tokens = ", ".join(sq(t) for t in CSV_NA_TOKENS)
    out = []
    for c in FLAT_STAGING:
        if c in NUMERIC_COLUMNS:
            out.append(alias(f"CAST({q(c)} AS DOUBLE)", c))
        else:
            out.append(alias(f"CASE WHEN {q(c)} IN ({tokens}) THEN NULL ELSE {q(c)} END", c))
    return with_staging(f"SELECT {', '.join(out)} FROM staging")


def scalar_parity_query() -> str:
    from ordstar.specs import ID_BLANK_TOKENS

    token = f"('FAKE_GTIN_' || {sql_zfill('c_custkey', 6)})"
    blanks = ", ".join(sq(t) for t in ID_BLANK_TOKENS)
    return f"""
SELECT c_custkey,
  {sql_strip("chr(9) || ' ' || c_name || ' ' || chr(10)")} AS stripped,
  (mb IS NULL OR {sql_strip('mb')} = '') AS is_blank,
  {sql_zfill('c_custkey', 6)} AS zfill6,
  {sql_zfill('c_custkey * 1000', 6)} AS zfill6_wide,
  upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS capitalized,
  {token} AS token,
  TRY_CAST(string_split({token}, '_')[-1] AS BIGINT) AS token_number,
  TRY_CAST(string_split(c_name, '_')[-1] AS BIGINT) AS name_number,
  {sql_strip('mb')} IN ({blanks}) AS is_null_token,
  contains(lower(c_mktsegment), 'build') AS contains_build,
  {sql_try_number('CAST(c_acctbal AS VARCHAR)')} AS acctbal_number
FROM (SELECT *, CASE WHEN c_acctbal < 0 THEN ' ' || chr(9) ELSE c_name END AS mb FROM customer) c
WHERE c_acctbal IS NOT NULL"""


# --- pseudonymisation ------------------------------------------------------------

# Expected category and identifier type of every masked column, stated here on
# their own so that a wrong dispatch in the code under test cannot pass.
NAME_CATEGORY = {
    "attributes.manufacturer": "manufacturing",
    "buyer.nodes.name": "company",
    "buyer.nodes.parentCompany.nodes.name": "company",
    "point_of_contact.nodes.name": "person",
    "attributes.sellingManufacturerFacilityName": "manufacturing",
    "attributes.trader": "company",
}
CONTACT_CATEGORY = {
    "attributes.buyerNameContact": "company", "attributes.traderContact": "company", "attributes.manufacturerContact": "manufacturing",
}
ID_KIND = {
    "rowId": "PO",
    "produits.nodes.asset.attributes.gtin": "GTIN",
    "produits.nodes.asset.attributes.hsCode": "HS",
    "supplierRef": "OTHER",
}

_SEQ_SPAN = 1_000_000_000  # rows per run stay below this in the encoded first-seen key


def sql_list(values) -> str:
    return "[" + ", ".join(sq(v) for v in values) + "]"


def _pick_sql(words, h: str, slot: int) -> str:
    return f"{sql_list(words)}[(CAST('0x' || substr({h}, {1 + 8 * slot}, 8) AS BIGINT) % {len(words)}) + 1]"


def sql_blank(x: str) -> str:
    return f"({x} IS NULL OR {sql_strip(x)} = '')"


def sql_id_blank(x: str) -> str:
    from ordstar.specs import ID_BLANK_TOKENS

    return f"({x} IS NULL OR {sql_strip(x)} IN ({', '.join(sq(t) for t in ID_BLANK_TOKENS)}))"


def name_map_ctes(src: str, columns, salt: str) -> str:
    """CTEs ``nrows``, ``nocc``, ``nfirst``, ``namemap`` over relation ``src``."""
    from ordstar.operators import pseudonym as p

    occ = "\nUNION ALL\n".join(
        f"SELECT {j} AS j, {q(c)} AS v, seq FROM nrows WHERE NOT {sql_blank(q(c))}" for j, c in enumerate(columns))
    cats = " ".join(f"WHEN {j} THEN {sq((NAME_CATEGORY | CONTACT_CATEGORY)[c])}" for j, c in enumerate(columns))
    h = "h"
    company = (f"{_pick_sql(p.SURNAMES, h, 0)} || ' ' || {_pick_sql(p.SURNAMES, h, 2)} || ' ' || "
               f"{_pick_sql(p.COMPANY_SUFFIXES, h, 1)}")
    person = (f"{_pick_sql(p.FIRST_NAMES, h, 0)} || ' ' || {_pick_sql(p.INITIALS, h, 2)} || '. ' || "
              f"{_pick_sql(p.SURNAMES, h, 1)}")
    word = _pick_sql(p.WORDS, h, 0)
    base = (f"CASE category WHEN 'company' THEN {company} "
            f"WHEN 'manufacturing' THEN {company} || {sq(p.MANUFACTURING_SUFFIX)} "
            f"WHEN 'person' THEN {person} "
            f"ELSE upper(substr({word}, 1, 1)) || lower(substr({word}, 2)) END")
    return f"""nrows AS (SELECT *, row_number() OVER (ORDER BY {LINE_ORDER}) - 1 AS seq FROM {src}),
nocc AS ({occ}),
nfirst AS (SELECT v AS original, min(j) AS k FROM nocc GROUP BY v),
ncat AS (SELECT original, CASE k {cats} END AS category,
                sha256({sq(salt)} || chr(31) || original) AS h FROM nfirst),
nbase AS (SELECT original, category, h, {base} AS base FROM ncat),
namemap AS (SELECT original,
   CASE WHEN row_number() OVER (PARTITION BY base ORDER BY h, original) = 1 THEN base
        ELSE base || ' ' || CAST(row_number() OVER (PARTITION BY base ORDER BY h, original) AS VARCHAR) END AS anonymized,
   category FROM nbase)"""


def _id_type_case(columns, jexpr: str) -> str:
    return "CASE " + jexpr + " " + " ".join(f"WHEN {j} THEN {sq(ID_KIND[c])}" for j, c in enumerate(columns)) + " END"


def _prefix_case(t: str) -> str:
    from ordstar.specs import ID_PREFIX

    return "CASE " + t + " " + " ".join(f"WHEN {sq(k)} THEN {sq(v)}" for k, v in ID_PREFIX.items()) + " END"


def id_map_ctes(tag: str, src: str, columns, salt: str, prior: str | None = None, width: int = 6,
                arrival: str = "0") -> str:
    """CTEs ending in ``{tag}map`` (original, fake, id_type) over relation ``src``;
    with ``prior`` (an id map relation) only new values are added after it.
    ``arrival`` numbers the arrivals of a stream; inside one, column then row."""
    occ = "\nUNION ALL\n".join(
        f"SELECT {j} AS j, {sql_strip(q(c))} AS v, seq, arrival FROM {tag}rows WHERE NOT {sql_id_blank(q(c))}"
        for j, c in enumerate(columns))
    key = f"(arrival * 10 + j) * {_SEQ_SPAN} + seq"
    anti = f" WHERE v NOT IN (SELECT original FROM {prior})" if prior else ""
    counters = (f"SELECT id_type, max(TRY_CAST(string_split(fake, '_')[-1] AS BIGINT)) AS c FROM {prior} GROUP BY id_type"
                if prior else "SELECT CAST(NULL AS VARCHAR) AS id_type, CAST(NULL AS BIGINT) AS c WHERE false")
    n = f"row_number() OVER (PARTITION BY t.id_type ORDER BY t.k) + COALESCE(cn.c, 0)"
    fake = (f"CASE WHEN t.id_type = 'OTHER' THEN 'FAKE_' || substr(sha256({sq(salt)} || chr(31) || t.original), 1, 24) "
            f"ELSE {_prefix_case('t.id_type')} || {sql_zfill(n, width)} END")
    prior_rows = f"SELECT original, fake, id_type FROM {prior} UNION ALL " if prior else ""
    return f"""{tag}rows AS (SELECT *, row_number() OVER (ORDER BY {LINE_ORDER}) - 1 AS seq,
    {arrival} AS arrival FROM {src}),
{tag}occ AS ({occ}),
{tag}first AS (SELECT v AS original, min({key}) AS k FROM {tag}occ{anti} GROUP BY v),
{tag}typed AS (SELECT original, k, {_id_type_case(columns, f"(k // {_SEQ_SPAN}) % 10")} AS id_type FROM {tag}first),
{tag}cnt AS ({counters}),
{tag}new AS (SELECT t.original, {fake} AS fake, t.id_type FROM {tag}typed t LEFT JOIN {tag}cnt cn ON t.id_type = cn.id_type),
{tag}map AS ({prior_rows}SELECT original, fake, id_type FROM {tag}new)"""


ID_VIEW = f"""idview AS (SELECT 'PO-' || CAST(l_orderkey AS VARCHAR) AS "rowId",
  CAST(l_partkey AS VARCHAR) AS "produits.nodes.asset.attributes.gtin",
  CAST(l_suppkey + 1950 AS VARCHAR) AS "produits.nodes.asset.attributes.hsCode",
  {", ".join(LINE_KEY)} FROM lineitem)"""


def pseudo_generate_query(columns, salt) -> str:
    return with_staging("SELECT original, anonymized, category FROM namemap",
                        name_map_ctes("staging", columns, salt))


def _masked_names_body(columns) -> tuple[str, list[str]]:
    joins = " ".join(f"LEFT JOIN namemap m{j} ON s.{q(c)} = m{j}.original" for j, c in enumerate(columns))
    outs = [f"CASE WHEN {sql_blank('s.' + q(c))} THEN '' ELSE m{j}.anonymized END" for j, c in enumerate(columns)]
    return joins, outs


def pseudo_names_query(columns, salt) -> str:
    joins, outs = _masked_names_body(columns)
    sel = ['s."rowId" AS "rowId"', *[alias(o, c) for o, c in zip(outs, columns)], *[f"s.{k}" for k in LINE_KEY]]
    return with_staging(f"SELECT {', '.join(sel)} FROM staging s {joins}",
                        name_map_ctes("staging", columns, salt))


def leak_check_query(columns, contacts, salt) -> str:
    joins, outs = _masked_names_body(columns)
    pairs = [f"{o} AS o{j}, s.{q(c)} AS i{j}" for j, (o, c) in enumerate(zip(outs, columns))]
    pairs += [f"s.{q(c)} AS o{len(columns) + j}, s.{q(c)} AS i{len(columns) + j}" for j, c in enumerate(contacts)]
    inputs = " UNION ".join(f"SELECT i{j} AS v FROM pairs WHERE i{j} IS NOT NULL" for j in range(len(columns)))
    parts = [f"""SELECT {sq(c)} AS "column", COUNT(*) AS n_rows,
  COUNT(CASE WHEN o{j} = i{j} THEN 1 END) AS n_unchanged,
  COUNT(CASE WHEN o{j} IN (SELECT v FROM inputs) THEN 1 END) AS n_exposed FROM pairs"""
             for j, c in enumerate([*columns, *contacts])]
    ctes = name_map_ctes("staging", columns, salt)
    ctes += f",\npairs AS (SELECT {', '.join(pairs)} FROM staging s {joins}),\ninputs AS ({inputs})"
    return with_staging("\n" + "\nUNION ALL\n".join(parts), ctes)


def tokenize_ids_query(columns, salt) -> str:
    return with_staging("SELECT original, fake, id_type FROM amap",
                        ID_VIEW + ",\n" + id_map_ctes("a", "idview", columns, salt))


def tokenize_resume_query(columns, salt, cutoff: str) -> str:
    early = f"early AS (SELECT * FROM idview WHERE l_shipdate < TIMESTAMP {sq(cutoff)})"
    ctes = ",\n".join([ID_VIEW, early, id_map_ctes("a", "early", columns, salt),
                       id_map_ctes("b", "idview", columns, salt, prior="amap")])
    return with_staging("SELECT original, fake, id_type FROM bmap", ctes)


def token_fallback_query(columns, salt) -> str:
    view = f"""fview AS (SELECT 'PO-' || CAST(l_orderkey AS VARCHAR) AS "rowId",
  CAST(l_suppkey AS VARCHAR) AS "supplierRef", {", ".join(LINE_KEY)} FROM lineitem)"""
    return with_staging("SELECT original, fake, id_type FROM amap",
                        view + ",\n" + id_map_ctes("a", "fview", columns, salt))


# --- nested documents ---------------------------------------------------------------


def _doc_order(prefix: str = "") -> str:
    from ordstar.sources.adapter import LINE_DOC_ORDER

    return ", ".join(prefix + k for k in LINE_DOC_ORDER)


def _docs_cte() -> str:
    return f"""lines AS (
  SELECT l_orderkey, COUNT(p_name) AS n,
         string_agg(p_name, '|' ORDER BY {_doc_order()}) AS names,
         string_agg(CAST(l_quantity AS VARCHAR), '|' ORDER BY {_doc_order()}) AS vals,
         CAST(SUM(CAST(l_quantity AS DECIMAL(38,10))) AS DOUBLE) AS tv
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
docs AS (
  SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS r, o_orderkey, o_orderstatus, o_orderpriority,
         c_name, n_name, r_name, lines.n, lines.names, lines.vals, lines.tv
  FROM orders LEFT JOIN cust ON o_custkey = c_custkey LEFT JOIN lines ON l_orderkey = o_orderkey)"""


def json_paths_query() -> str:
    from ordstar.sources.adapter import PARTIAL_STATUS

    poc = f"r_name IS NOT NULL AND r_name <> {sq(NO_CONTACT_REGION)}"
    specs = [("rowId", 0, "TRUE"), ("type", 1, "TRUE"),
             ("flags", 2, f"o_orderstatus IS DISTINCT FROM {sq(PARTIAL_STATUS)}"),
             ("flags.partial", 2, f"o_orderstatus = {sq(PARTIAL_STATUS)}"),
             ("buyer.nodes.name", 3, "TRUE"), ("buyer.nodes.parentCompany.nodes.name", 4, "TRUE"),
             ("point_of_contact.nodes.name", 5, poc),
             ("produits.nodes.value", 6, "n > 0"), ("produits.nodes.asset.descriptionShort", 7, "n > 0")]
    union = "\nUNION ALL\n".join(f"SELECT {sq(p)} AS path, {pos} AS pos, min(r) AS fr FROM docs WHERE {cond}"
                                 for p, pos, cond in specs)
    return with_staging(f"""
SELECT CAST(row_number() OVER (ORDER BY fr, pos, path) AS INTEGER) AS ordinal, path
FROM ({union}) p WHERE fr IS NOT NULL""", _docs_cte())


def _buyer_sql() -> str:
    return f"CASE WHEN o_orderpriority = {sq(NO_BUYER_PRIORITY)} THEN NULL ELSE c_name END"


def json_extract_query() -> str:
    return with_staging(f"""
SELECT 'PO-' || CAST(o_orderkey AS VARCHAR) AS "rowId", {_buyer_sql()} AS buyer, n_name AS parent,
       names AS product_names, CAST(COALESCE(n, 0) AS INTEGER) AS n_products, tv AS total_value
FROM docs""", _docs_cte())


def json_flatten_query() -> str:
    from ordstar.sources.adapter import PARTIAL_STATUS

    return with_staging(f"""
SELECT 'PO-' || CAST(o_orderkey AS VARCHAR) AS "rowId", o_orderstatus AS "type",
       CASE WHEN o_orderstatus = {sq(PARTIAL_STATUS)} THEN TRUE END AS flags_partial,
       {_buyer_sql()} AS buyer_nodes_name, n_name AS buyer_nodes_parentCompany_nodes_name,
       CASE WHEN r_name = {sq(NO_CONTACT_REGION)} THEN NULL ELSE r_name END AS point_of_contact_nodes_name,
       vals AS produits_nodes_value, names AS produits_nodes_asset_descriptionShort,
       CAST(NULL AS VARCHAR) AS flags
FROM docs""", _docs_cte())


_LN = "ln AS (SELECT l_orderkey, l_quantity, p_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"


def explode_cross_query() -> str:
    return with_staging("""
SELECT 'PO-' || CAST(o.o_orderkey AS VARCHAR) AS "rowId", b.p_name AS product, COUNT(*) AS n_rows,
       CAST(SUM(CAST(a.l_quantity AS DECIMAL(38,10))) AS DOUBLE) AS total_value
FROM orders o LEFT JOIN ln a ON a.l_orderkey = o.o_orderkey LEFT JOIN ln b ON b.l_orderkey = o.o_orderkey
GROUP BY 1, 2""", _LN)


def explode_aligned_query() -> str:
    return with_staging("""
SELECT 'PO-' || CAST(o.o_orderkey AS VARCHAR) AS "rowId", a.p_name AS product, COUNT(*) AS n_rows,
       CAST(SUM(CAST(a.l_quantity AS DECIMAL(38,10))) AS DOUBLE) AS total_value
FROM orders o LEFT JOIN ln a ON a.l_orderkey = o.o_orderkey
GROUP BY 1, 2""", _LN)


def mapping_state_query(columns, salt, cutoff: str) -> str:
    early = f"early AS (SELECT * FROM idview WHERE l_shipdate < TIMESTAMP {sq(cutoff)})"
    ctes = ",\n".join([ID_VIEW, early, id_map_ctes("a", "early", columns, salt),
                       id_map_ctes("b", "idview", columns, salt, prior="amap")])
    return with_staging("""SELECT original, fake, id_type,
  CAST(CASE WHEN original IN (SELECT original FROM amap) THEN 0 ELSE 1 END AS BIGINT) AS batch FROM bmap""", ctes)


def pseudo_incremental_query(columns, salt) -> str:
    """One arrival per ship year (in year order); inside it, column then row."""
    arrival = "dense_rank() OVER (ORDER BY year(l_shipdate)) - 1"
    ctes = ",\n".join([ID_VIEW, id_map_ctes("a", "idview", columns, salt, arrival=arrival)])
    return with_staging(f"""SELECT original, fake, id_type, CAST((k // {_SEQ_SPAN}) // 10 AS BIGINT) AS batch
FROM afirst JOIN amap USING (original)""", ctes)


def star_publish_query(tables) -> str:
    parts = [f"SELECT {sq(t)} AS table_name, COUNT(*) AS n_rows FROM {t if t != 'fact_orders' else 'fact'}"
             for t in tables]
    return with_star("\n" + "\nUNION ALL\n".join(parts))


def _js(x: str) -> str:
    """JSON string literal of a text value (quotes and backslashes escaped)."""
    return f"""('"' || replace(replace({x}, '\\', '\\\\'), '"', '\\"') || '"')"""


def json_scan_query(nodes_per_doc: int) -> str:
    from ordstar.sources.adapter import PARTIAL_STATUS

    line = (f"""'{{"value":' || CAST(l_quantity AS VARCHAR) || ',"asset":{{"descriptionShort":' || """
            f"""COALESCE({_js('p_name')}, 'null') || '}}}}'""")
    lines = f"""jl AS (SELECT l_orderkey, string_agg({line}, ',' ORDER BY {_doc_order()}) AS nodes
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)"""
    buyer = f"CASE WHEN o_orderpriority = {sq(NO_BUYER_PRIORITY)} THEN NULL ELSE c_name END"
    poc = (f"CASE WHEN r_name IS NULL OR r_name = {sq(NO_CONTACT_REGION)} THEN '' "
           f"""ELSE '{{"name":' || {_js('r_name')} || '}}' END""")
    node = (f"""'{{"rowId":' || {_js("'PO-' || CAST(o_orderkey AS VARCHAR)")} || ',"type":' || {_js('o_orderstatus')} """
            f"""|| ',"tags":[' || {_js('o_orderpriority')} || '],"flags":' """
            f"""|| CASE WHEN o_orderstatus = {sq(PARTIAL_STATUS)} THEN '{{"partial":true}}' ELSE 'null' END """
            f"""|| ',"buyer":{{"nodes":[{{"name":' || COALESCE({_js(buyer)}, 'null') """
            f"""|| ',"parentCompany":{{"nodes":[{{"name":' || COALESCE({_js('n_name')}, 'null') || '}}]}}}}]}}' """
            f"""|| ',"point_of_contact":{{"nodes":[' || {poc} || ']}}' """
            f"""|| ',"produits":{{"nodes":[' || COALESCE(jl.nodes, '') || ']}}}}'""")
    return with_staging(f"""
SELECT CAST(row_number() OVER (PARTITION BY o_orderkey // {nodes_per_doc} ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
       {node} AS node
FROM orders LEFT JOIN cust ON o_custkey = c_custkey LEFT JOIN jl ON jl.l_orderkey = o_orderkey""", lines)


def mapping_state_names_query(columns, salt, cutoff: str) -> str:
    """Names seen in early lines keep their fakes; new ones are named after them:
    the suffix of a new fake counts on from the fakes its base already has."""
    early = f"early AS (SELECT * FROM staging WHERE l_shipdate < TIMESTAMP {sq(cutoff)})"
    first = name_map_ctes("early", columns, salt)
    names = ("nrows", "nocc", "nfirst", "ncat", "nbase", "namemap")
    both = name_map_ctes("staging", columns, salt)
    for n in names:
        both = re.sub(rf"\b{n}\b", "b" + n, both)
    return with_staging("""SELECT original, anonymized, 0 AS run FROM namemap
UNION ALL
SELECT original, CASE WHEN n = 1 THEN base ELSE base || ' ' || CAST(n AS VARCHAR) END, 1
FROM (SELECT original, base, row_number() OVER (PARTITION BY base ORDER BY h, original) + COALESCE(used, 0) AS n
      FROM bnbase LEFT JOIN (SELECT base, COUNT(*) AS used FROM nbase GROUP BY base) u USING (base)
      WHERE original NOT IN (SELECT original FROM namemap)) x""", ",\n".join([early, first, both]))


def _etl_ctes(salt: str) -> str:
    """The star of the whole ETL, from its rules: one row per order line (or per
    order without lines), masked names, blanks and NA tokens null. An order's own
    attributes come from its first line."""
    first = f"""fl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_doc_order()}) AS nth FROM lineitem) t WHERE nth = 1)"""
    rows = f"""er AS (SELECT o.o_orderkey, o_orderstatus AS "type", c_mktsegment AS contact, ln.l_quantity AS value,
    CASE WHEN fl.l_orderkey IS NOT NULL THEN fl.l_extendedprice END AS quantity,
    CASE WHEN o_orderpriority = {sq(NO_BUYER_PRIORITY)} THEN NULL ELSE c_name END AS "buyer.nodes.name",
    n_name AS "buyer.nodes.parentCompany.nodes.name",
    CASE WHEN r_name = {sq(NO_CONTACT_REGION)} THEN NULL ELSE r_name END AS "point_of_contact.nodes.name",
    fp.p_brand AS "attributes.manufacturer", fp.p_brand || '-F' AS "attributes.sellingManufacturerFacilityName",
    s_name AS "attributes.trader", s_nation, fp.p_type AS ftype, fp.p_brand AS fbrand, o_orderpriority, fl.l_returnflag AS rf, fl.l_linestatus AS ls,
    p.p_name AS pn, p.p_partkey AS pk, p.p_brand AS pb, CASE WHEN p.p_size % 7 = 0 THEN NULL ELSE p.p_size END AS ps, p.p_type AS pt,
    p.p_size % 5 = 0 AS core, {", ".join("ln." + k for k in LINE_KEY)}
  FROM orders o LEFT JOIN cust ON o.o_custkey = c_custkey LEFT JOIN fl ON fl.l_orderkey = o.o_orderkey
  LEFT JOIN part fp ON fl.l_partkey = fp.p_partkey LEFT JOIN supp ON fl.l_suppkey = s_suppkey
  LEFT JOIN lineitem ln ON ln.l_orderkey = o.o_orderkey LEFT JOIN part p ON ln.l_partkey = p.p_partkey)"""
    columns = list(NAME_CATEGORY)
    outs = ", ".join(f"m{j}.anonymized AS n{j}" for j in range(len(columns)))
    joins = " ".join(f"LEFT JOIN namemap m{j} ON e.{q(c)} = m{j}.original" for j, c in enumerate(columns))
    masked = f"em AS (SELECT e.*, {outs} FROM er e {joins})"
    at = {c: f"n{j}" for j, c in enumerate(columns)}
    buyer, parent, poc, trader = (at[c] for c in ("buyer.nodes.name", "buyer.nodes.parentCompany.nodes.name", "point_of_contact.nodes.name", "attributes.trader"))
    tables = [("eb", "id_buyer", [buyer, parent, "contact"], f"WHERE {buyer} IS NOT NULL"), ("ep", "id_poc", [poc], ""), ("et", "id_trader", [trader, "s_nation"], "")]
    dims = []
    for name, key, attrs, where in tables:
        dims.append(f"{name} AS (SELECT row_number() OVER (ORDER BY {', '.join(a + ' ASC NULLS FIRST' for a in attrs)}) AS {key}, * "
                    f"FROM (SELECT DISTINCT {', '.join(attrs)} FROM em {where}) t)")
    return ",\n".join([first, rows, name_map_ctes("er", columns, salt), masked, *dims])


def etl_dim_buyer_query(salt: str) -> str:
    at = {c: f"n{j}" for j, c in enumerate(NAME_CATEGORY)}
    return with_staging(f"""SELECT id_buyer, {at["buyer.nodes.name"]} AS buyer_nodes_name,
  {at["buyer.nodes.parentCompany.nodes.name"]} AS buyer_nodes_parentCompany_nodes_name, contact AS "attributes_buyerNameContact" FROM eb""", _etl_ctes(salt))


def etl_fact_query(salt: str) -> str:
    at = {c: f"n{j}" for j, c in enumerate(NAME_CATEGORY)}
    b, p, c, t = (at[x] for x in ("buyer.nodes.name", "buyer.nodes.parentCompany.nodes.name", "point_of_contact.nodes.name", "attributes.trader"))
    return with_staging(f"""SELECT 'PO_' || {sql_zfill('dense_rank() OVER (ORDER BY o_orderkey)', 6)} AS "rowId", "type", id_buyer, id_poc, id_trader,
  value AS produits_nodes_value, quantity AS feedstock_nodes_quantity
FROM em LEFT JOIN eb ON em.{b} = eb.{b} AND em.{p} IS NOT DISTINCT FROM eb.{p} AND em.contact IS NOT DISTINCT FROM eb.contact
LEFT JOIN ep ON em.{c} IS NOT DISTINCT FROM ep.{c}
LEFT JOIN et ON em.{t} IS NOT DISTINCT FROM et.{t} AND em.s_nation IS NOT DISTINCT FROM et.s_nation""", _etl_ctes(salt))


def order_etl_query(salt: str) -> str:
    """Row counts of the published star; id tokens and fakes are one-to-one with
    the originals, so distinct originals count the product rows."""
    def count(what: str) -> str:
        return f"(SELECT COUNT(*) FROM (SELECT DISTINCT {what} FROM em) t)"

    return with_staging(f"""
SELECT 'dim_buyer' AS table_name, (SELECT COUNT(*) FROM eb) AS n_rows
UNION ALL SELECT 'dim_product', {count("pn, pk, pb, ps, pt, core")}
UNION ALL SELECT 'dim_feedstock', {count("ftype, fbrand")}
UNION ALL SELECT 'dim_certification', {count("CASE WHEN rf IS NOT NULL THEN o_orderpriority END, rf, ls")}
UNION ALL SELECT 'dim_trader', (SELECT COUNT(*) FROM et)
UNION ALL SELECT 'dim_point_of_contact', (SELECT COUNT(*) FROM ep)
UNION ALL SELECT 'dim_manufacturer', {count('fbrand, ftype')}
UNION ALL SELECT 'fact_orders', (SELECT COUNT(*) FROM em)""", _etl_ctes(salt))


def multi_valued_query() -> str:
    return with_staging("""SELECT CAST(1 AS INTEGER) AS buyer_nodes_name, CAST(1 AS INTEGER) AS buyer_nodes_parentCompany_nodes_name,
  CAST(1 AS INTEGER) AS point_of_contact_nodes_name, CAST(max(n) AS INTEGER) AS produits_nodes_value,
  CAST(max(n) AS INTEGER) AS produits_nodes_asset_descriptionShort FROM docs""", _docs_cte())


REPLACE_TABLE_SQL = "SELECT c_custkey AS id, c_name AS name FROM customer"


def fact_partial_rows_query() -> str:
    d = ORDER_STAR.dim("dim_point_of_contact")
    cols = [*[f"s.{q(t)} AS {q(safe_name(t))}" for t in ORDER_STAR.fact_text], f"d.{d.key} AS {d.key}",
            *[f"CAST(s.{q(m)} AS DOUBLE) AS {q(safe_name(m))}" for m in ORDER_STAR.measures]]
    return with_staging(f"SELECT {', '.join(cols)} FROM staging s LEFT JOIN {d.name} d ON s.{q(d.join_key)} = d.{q(d.join_key)}", dim_cte(d))


def fact_multiplied_query(dim_names) -> str:
    dims = [ORDER_STAR.dim(n) for n in dim_names]
    joins = " ".join(f"LEFT JOIN {d.name} d{i} ON s.{q(d.join_key)} = d{i}.{q(d.join_key)}" for i, d in enumerate(dims))
    order = ", ".join([*[f"s.{c}" for c in LINE_KEY], *[f"d{i}.{d.key}" for i, d in enumerate(dims)]])
    cols = [f"row_number() OVER (ORDER BY {order}) AS id_fact", *[f"s.{q(t)} AS {q(safe_name(t))}" for t in ORDER_STAR.fact_text],
            *[f"d{i}.{d.key} AS {d.key}" for i, d in enumerate(dims)], *[f"CAST(s.{q(m)} AS DOUBLE) AS {q(safe_name(m))}" for m in ORDER_STAR.measures]]
    return with_staging(f"SELECT {', '.join(cols)} FROM staging s {joins}", ",\n".join(dim_cte(d) for d in dims))


def explode_cross_rows_query() -> str:
    return with_staging(f"""
SELECT 'PO-' || CAST(o_orderkey AS VARCHAR) AS "rowId", {_buyer_sql()} AS buyer_nodes_name, n_name AS buyer_nodes_parentCompany_nodes_name,
       CASE WHEN r_name = {sq(NO_CONTACT_REGION)} THEN NULL ELSE r_name END AS point_of_contact_nodes_name,
       a.l_quantity AS produits_nodes_value, b.p_name AS produits_nodes_asset_descriptionShort
FROM docs LEFT JOIN ln a ON a.l_orderkey = o_orderkey LEFT JOIN ln b ON b.l_orderkey = o_orderkey""", f"{_docs_cte()},\n{_LN}")


def pseudo_incremental_both_query(names, ids, salt, cutoff: str) -> str:
    """Both mappings after two arrivals: early lines, then the others."""
    body = mapping_state_names_query(names, salt, cutoff)
    head, tail = body.rsplit("\nSELECT original, anonymized, 0 AS run", 1)
    tail = tail.replace("1\nFROM (SELECT original, base", "'name'\nFROM (SELECT original, base").replace(" FROM namemap\nUNION", " FROM namemap\nUNION", 1)
    id_ctes = ",\n".join([id_map_ctes("a", "early", ids, salt), id_map_ctes("b", "staging", ids, salt, prior="amap")])
    named = "SELECT original, anonymized AS masked, 'name' AS kind" + tail
    return f"{head},\n{id_ctes}\n{named}\nUNION ALL\nSELECT original, fake, 'id' FROM bmap"


def kpi_merged_query() -> str:
    return with_staging(f"""
SELECT "type" AS "type", COUNT(*) AS n_lines, {_money_sum(q("produits.nodes.value"))} AS total_value,
       {_money_sum(q("feedstock.nodes.quantity"))} AS total_quantity, TRUE AS buyers_within_error
FROM staging GROUP BY 1""")


def leak_inside_query() -> str:
    """By comparing every distinct value with every original, words between spaces."""
    words = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    columns = {"note": "'Sold to ' || COALESCE(\"buyer.nodes.name\", 'nobody') || ', by ' || \"attributes.trader\"",
               "remark": "'Kind: ' || \"attributes.feedstock\"", "attributes.trader": "\"attributes.trader\""}
    cells = "\nUNION ALL\n".join(f"SELECT {sq(c)} AS \"column\", {words.format(e)} AS v FROM staging" for c, e in columns.items())
    return with_staging("""
SELECT c."column" AS "column", CAST(SUM(n) AS BIGINT) AS n_rows, CAST(SUM(CASE WHEN whole THEN n ELSE 0 END) AS BIGINT) AS n_whole,
       CAST(SUM(CASE WHEN inside AND NOT whole THEN n ELSE 0 END) AS BIGINT) AS n_inside
FROM (SELECT c."column", c.v, c.n,
             EXISTS (SELECT 1 FROM originals o WHERE o.v = c.v) AS whole,
             EXISTS (SELECT 1 FROM originals o WHERE contains(' ' || c.v || ' ', ' ' || o.v || ' ')) AS inside
      FROM (SELECT "column", v, COUNT(*) AS n FROM cells GROUP BY ALL) c) c
GROUP BY 1""", f"""cells AS ({cells}),
originals AS (SELECT DISTINCT {words.format('x')} AS v FROM (
  SELECT "buyer.nodes.name" AS x FROM staging UNION SELECT "attributes.trader" FROM staging) t WHERE x IS NOT NULL)""")
