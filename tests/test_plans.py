"""Plan checks: Python only in path discovery; scans pruned and filtered."""

import re

from ordstar.operators import kpi, pseudonym, quality, star
from ordstar.plans.queries import QUERIES
from ordstar.sources.adapter import LINE_KEY, id_lines, staging
from ordstar.specs import ID_COLUMNS, NAME_COLUMNS, ORDER_STAR

from conftest import SMALL

PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pseudonymisation_star_and_kpis_run_without_python(spark):
    st = staging(spark, SMALL)
    masked, names, ids = pseudonym.pseudonymize(st, LINE_KEY, name_columns=NAME_COLUMNS,
                                                id_columns=ID_COLUMNS, salt="test")
    dims, fact = star.build_star(masked, ORDER_STAR)
    for df in (masked, names, ids, fact, kpi.kpi_volume(fact, dims), kpi.kpi_buyers(fact, dims)):
        p = plan(df)
        assert not any(n in p for n in PYTHON_NODES), p


def test_scan_prunes_columns_and_pushes_filters(spark):
    ids = id_lines(spark, SMALL).where("l_quantity > 10").select("rowId")
    p = ids._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_staging_joins_only_the_tables_of_its_columns(spark):
    def n(*columns):
        return joins(staging(spark, SMALL, columns))

    assert joins(staging(spark, SMALL)) == 7
    assert n("rowId", "produits.nodes.value") == 0
    assert n("type") == 1 and n("attributes.feedstock") == 1 and n("attributes.volumeContact") == 1
    assert n(*ORDER_STAR.dim("dim_trader").attributes) == 2
    assert n(*ORDER_STAR.dim("dim_buyer").attributes) == 3
    assert n(*ORDER_STAR.dim("dim_point_of_contact").attributes) == 4
    assert n(*ORDER_STAR.dim("dim_certification").attributes) == 1


def test_masking_looks_values_up_without_a_sort(spark):
    st = staging(spark, SMALL, NAME_COLUMNS)
    _, names, _ = pseudonym.pseudonymize(st, LINE_KEY, name_columns=NAME_COLUMNS, salt="test")
    first = pseudonym.first_seen(st, LINE_KEY, NAME_COLUMNS, strip=False)
    assert "rangepartitioning" not in plan(first) and names.count() > 0


def test_audits_count_cells_before_joining(spark):
    st = staging(spark, SMALL)
    dims, fact = star.build_star(st, ORDER_STAR, number_fact=False)
    p = quality.integrity_audit(fact, dims, ORDER_STAR)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[[^\n]*fk[^\n]*count\(1\)", p), p


def test_declared_layout_needs_no_python(spark):
    for name in ("json_extract", "json_flatten", "explode_cross", "explode_aligned"):
        p = plan(QUERIES[name](spark, SMALL))
        assert not any(n in p for n in PYTHON_NODES), name
