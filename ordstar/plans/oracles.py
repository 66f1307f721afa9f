"""Oracle SQL per registered query name (see ``oracle_sql``)."""

from __future__ import annotations

from ordstar.plans import oracle_sql as o
from ordstar.specs import ORDER_STAR

ORACLES: dict[str, str] = {
    "dim_buyer": o.dim_query(ORDER_STAR.dim("dim_buyer")),
    "dim_product": o.dim_query(ORDER_STAR.dim("dim_product")),
    "dim_feedstock": o.dim_query(ORDER_STAR.dim("dim_feedstock")),
    "dim_certification": o.dim_query(ORDER_STAR.dim("dim_certification")),
    "dim_trader": o.dim_query(ORDER_STAR.dim("dim_trader")),
    "dim_poc": o.dim_query(ORDER_STAR.dim("dim_point_of_contact")),
    "dim_manufacturer": o.dim_query(ORDER_STAR.dim("dim_manufacturer")),
    "fact_full_key": o.fact_full_key_query(),
    "fact_key": o.fact_key_query(),
    "fact_partial_key": o.fact_partial_key_query("dim_product"),
    "fanout_audit": o.fanout_audit_query(),
    "integrity_audit": o.integrity_audit_query(),
    "dense_number": o.dense_number_query(),
    "kpi_volume": o.kpi_volume_query(),
    "kpi_traceability": o.kpi_traceability_query(),
    "kpi_buyers": o.kpi_buyers_query(),
    "volume_by_buyer": o.volume_by_buyer_query(),
}

from ordstar.plans import queries as _q  # noqa: E402
from ordstar.specs import SAMPLE_ROWS  # noqa: E402

ORACLES.update({
    "coerce_numeric": o.coerce_numeric_query(),
    "coerce_report": o.coerce_report_query(),
    "sample_head": o.sample_head_query(SAMPLE_ROWS),
    "sample_hash": o.sample_hash_query(_q.HASH_SAMPLE_ROWS, _q.HASH_SEED, _q.HASH_COLUMNS),
    "csv_roundtrip": o.csv_roundtrip_query(),
    "scalar_parity": o.scalar_parity_query(),
})

from ordstar.plans.queries import SALT  # noqa: E402
from ordstar.specs import ID_COLUMNS, NAME_COLUMNS  # noqa: E402

ORACLES.update({
    "pseudo_generate": o.pseudo_generate_query(NAME_COLUMNS, SALT),
    "pseudo_names": o.pseudo_names_query(NAME_COLUMNS, SALT),
    "leak_check": o.leak_check_query(NAME_COLUMNS, _q.CONTACT_COLUMNS, SALT),
    "tokenize_ids": o.tokenize_ids_query(ID_COLUMNS, SALT),
    "tokenize_resume": o.tokenize_resume_query(ID_COLUMNS, SALT, _q.RESUME_CUTOFF),
    "token_fallback": o.token_fallback_query(_q.FALLBACK_COLUMNS, SALT),
})

ORACLES.update({
    "json_paths": o.json_paths_query(),
    "json_extract": o.json_extract_query(),
    "json_flatten": o.json_flatten_query(),
    "explode_cross": o.explode_cross_query(),
    "explode_aligned": o.explode_aligned_query(),
})

ORACLES.update({
    "mapping_state": o.mapping_state_query(ID_COLUMNS, SALT, _q.RESUME_CUTOFF),
    "pseudo_incremental": o.pseudo_incremental_query(ID_COLUMNS, SALT),
    "star_publish": o.star_publish_query(_q.STAR_TABLES),
})

ORACLES.update({
    "json_scan": o.json_scan_query(_q.NODES_PER_DOC),
})

ORACLES.update({
    "order_etl": o.order_etl_query(SALT),
    "etl_dim_buyer": o.etl_dim_buyer_query(SALT),
    "etl_fact": o.etl_fact_query(SALT),
    "mapping_state_names": o.mapping_state_names_query(NAME_COLUMNS, SALT, _q.RESUME_CUTOFF),
})

ORACLES.update({
    "json_scan_pretty": o.json_scan_query(_q.NODES_PER_DOC),
    "multi_valued": o.multi_valued_query(),
    "pseudo_missing_column": o.pseudo_generate_query(_q.PRESENT_NAMES, SALT),
    "replace_table": o.REPLACE_TABLE_SQL,
    "fact_partial_rows": o.fact_partial_rows_query(),
})

ORACLES.update({
    "fact_multiplied": o.fact_multiplied_query(_q.MULTIPLIED_DIMS),
    "explode_cross_rows": o.explode_cross_rows_query(),
})

ORACLES.update({
    "mapping_keyed": o.tokenize_resume_query(ID_COLUMNS, SALT, _q.RESUME_CUTOFF),
    "pseudo_incremental_both": o.pseudo_incremental_both_query(NAME_COLUMNS, ID_COLUMNS, SALT, _q.RESUME_CUTOFF),
    "kpi_merged": o.kpi_merged_query(),
    "leak_inside": o.leak_inside_query(),
    "pseudo_contacts": o.pseudo_names_query((*NAME_COLUMNS, *_q.CONTACT_COLUMNS), SALT),
})
