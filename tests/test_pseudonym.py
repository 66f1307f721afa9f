from functools import partial

import pytest
from pyspark.sql import functions as F

from ordstar.operators import pseudonym

pseudonymize = partial(pseudonym.pseudonymize, salt="test")

GTIN = "produits.nodes.asset.attributes.gtin"
HS = "produits.nodes.asset.attributes.hsCode"


def id_rows(spark, data):
    return spark.createDataFrame(data, f"r long, `{GTIN}` string, `{HS}` string")


def mapping(df):
    return {r.original: r.fake for r in df.collect()}


def test_shared_id_namespace_first_column_wins(spark):
    df = id_rows(spark, [(0, "A", "B"), (1, "B", "C")])
    _, _, ids = pseudonymize(df, ["r"], id_columns=[GTIN, HS])
    assert mapping(ids) == {"A": "FAKE_GTIN_000001", "B": "FAKE_GTIN_000002", "C": "FAKE_HS_000001"}


def test_first_seen_does_not_depend_on_size(spark):
    # One rule at every size: a value's first column decides, however late its row.
    rows = [(i, f"G{i}", f"H{i}") for i in range(2_000)] + [(2_000, "H5", None)]
    _, _, ids = pseudonymize(id_rows(spark, rows), ["r"], id_columns=[GTIN, HS])
    m = mapping(ids)
    assert m["H5"] == "FAKE_GTIN_002001" and m["G7"] == "FAKE_GTIN_000008" and m["H6"] == "FAKE_HS_000006"


def test_resume_continues_counter(spark):
    saved = spark.createDataFrame([("A", "FAKE_GTIN_000007", "GTIN"), ("X", "FAKE_GTIN_bad", "GTIN")],
                                  "original string, fake string, id_type string")
    df = id_rows(spark, [(0, "A", None), (1, "D", None)])
    masked, _, ids = pseudonymize(df, ["r"], id_columns=[GTIN, HS], id_map=saved)
    assert mapping(ids) == {"D": "FAKE_GTIN_000008"}  # only what is new
    assert sorted(r[GTIN] for r in masked.collect()) == ["FAKE_GTIN_000007", "FAKE_GTIN_000008"]


def test_blank_ids_become_empty(spark):
    df = id_rows(spark, [(0, " ", "x"), (1, "nan", "y"), (2, "None", "z"), (3, None, "w")])
    masked, _, ids = pseudonymize(df, ["r"], id_columns=[GTIN, HS])
    assert [r[GTIN] for r in masked.orderBy("r").collect()] == ["", "", "", ""]
    assert set(mapping(ids)) == {"x", "y", "z", "w"}


def test_ids_are_stripped(spark):
    df = id_rows(spark, [(0, " A ", None), (1, "A", None)])
    masked, _, ids = pseudonymize(df, ["r"], id_columns=[GTIN, HS])
    assert mapping(ids) == {"A": "FAKE_GTIN_000001"}
    assert {r[GTIN] for r in masked.collect()} == {"FAKE_GTIN_000001"}


def test_fallback_token_for_unknown_id_column(spark):
    df = spark.createDataFrame([(0, "q")], "r long, supplierRef string")
    _, _, ids = pseudonymize(df, ["r"], id_columns=["supplierRef"])
    row = ids.first()
    assert row.id_type == "OTHER" and row.fake.startswith("FAKE_") and len(row.fake) == 29
    many = spark.range(20_000).selectExpr("id AS r", "cast(id AS string) AS supplierRef")
    assert pseudonymize(many, ["r"], id_columns=["supplierRef"])[2].select("fake").distinct().count() == 20_000


def names_df(spark, n):
    data = [(i, f"Company {i}", f"Person {i % 7}") for i in range(n)]
    return spark.createDataFrame(data, "r long, `buyer.nodes.name` string, `point_of_contact.nodes.name` string")


def test_name_mapping_is_injective_and_categorised(spark):
    df = names_df(spark, 3000)
    masked, names, _ = pseudonymize(df, ["r"], name_columns=["buyer.nodes.name", "point_of_contact.nodes.name"])
    m = names.collect()
    assert len(m) == 3007
    assert len({r.anonymized for r in m}) == len(m)  # injective despite base collisions
    cats = {r.original: r.category for r in m}
    assert cats["Company 1"] == "company" and cats["Person 1"] == "person"
    leaks = masked.join(df.select(F.col("`buyer.nodes.name`").alias("o")), F.col("`buyer.nodes.name`") == F.col("o"))
    assert leaks.count() == 0


def test_rerun_with_saved_mapping_changes_nothing(spark):
    df = names_df(spark, 200)
    cols = ["buyer.nodes.name", "point_of_contact.nodes.name"]
    m1, names1, _ = pseudonymize(df, ["r"], name_columns=cols)
    m2, names2, _ = pseudonymize(df, ["r"], name_columns=cols, name_map=names1)
    assert names1.count() == 207 and names2.count() == 0
    assert sorted(m1.collect()) == sorted(m2.collect())


def test_new_names_after_resume_do_not_collide(spark):
    df = names_df(spark, 400)
    cols = ["buyer.nodes.name"]
    _, first, _ = pseudonymize(df.where("r < 200"), ["r"], name_columns=cols)
    _, new, _ = pseudonymize(df, ["r"], name_columns=cols, name_map=first)
    rows = first.collect() + new.collect()
    assert len(rows) == 400 and len({r.anonymized for r in rows}) == 400


def test_blank_names_become_empty(spark):
    df = spark.createDataFrame([(0, "  "), (1, None), (2, "x")], "r long, `attributes.trader` string")
    masked, names, _ = pseudonymize(df, ["r"], name_columns=["attributes.trader"])
    got = [r["attributes.trader"] for r in masked.orderBy("r").collect()]
    assert got[:2] == ["", ""] and got[2] not in ("", "x")
    assert [r.original for r in names.collect()] == ["x"]


def test_unpivot_and_broadcast_lookups_agree(spark):
    df = spark.createDataFrame(
        [(i, f"N{i % 11}" if i % 5 else "  ", f"N{(i * 3) % 7}", f" G{i % 4} " if i % 6 else None) for i in range(300)],
        f"r long, `buyer.nodes.name` string, `attributes.trader` string, `{GTIN}` string")
    cols = dict(name_columns=["buyer.nodes.name", "attributes.trader"], id_columns=[GTIN])
    a = pseudonymize(df, ["r"], strategy="broadcast", **cols)[0]
    b = pseudonymize(df, ["r"], strategy="unpivot", **cols)[0]
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(r[GTIN] for r in a.collect())[:1] == [""]


def test_missing_columns_are_skipped_with_a_warning(spark):
    import warnings

    df = spark.createDataFrame([(0, "A")], f"r long, `{GTIN}` string")
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        masked, _, ids = pseudonymize(df, ["r"], id_columns=[GTIN, HS])
    assert any(HS in str(x.message) for x in w)
    assert masked.columns == ["r", GTIN] and mapping(ids) == {"A": "FAKE_GTIN_000001"}


def test_mapping_independent_of_input_partitioning(spark):
    data = [(i, f"G{(i * 13) % 97}", f"H{(i * 7) % 31}") for i in range(2000)]
    base = id_rows(spark, data)
    results = []
    for n in (1, 3, 17):
        _, _, ids = pseudonymize(base.repartition(n), ["r"], id_columns=[GTIN, HS])
        results.append(sorted(tuple(r) for r in ids.collect()))
    assert results[0] == results[1] == results[2]


def test_hot_value_holding_a_third_of_rows(spark):
    from ordstar.operators import star
    from ordstar.specs import DimSpec, StarSpec

    n = 3000
    data = [(i, "HOT" if i % 3 == 0 else f"B{i % 50}", "G0" if i % 3 == 0 else f"G{i % 40}",
             None if i % 7 == 0 else f"T{i % 5}") for i in range(n)]
    df = spark.createDataFrame(data, f"r long, `buyer.nodes.name` string, `{GTIN}` string, `attributes.trader` string")
    outs = []
    for strategy in ("broadcast", "unpivot"):
        masked, names, ids = pseudonymize(df, ["r"], name_columns=["buyer.nodes.name", "attributes.trader"],
                                                    id_columns=[GTIN], strategy=strategy)
        rows = masked.collect()
        assert len(rows) == n  # whole result, no row dropped
        hot = {r.original: r.anonymized for r in names.collect()}["HOT"]
        assert sum(r["buyer.nodes.name"] == hot for r in rows) == n // 3
        assert sum(r["attributes.trader"] == "" for r in rows) == len([i for i in range(n) if i % 7 == 0])
        outs.append(sorted(map(tuple, rows)))
    assert outs[0] == outs[1]
    spec = StarSpec(dims=(DimSpec("d", "id_d", ("buyer.nodes.name",), join_key="buyer.nodes.name"),),
                    fact_text=("r",), measures=())
    dims, fact = star.build_star(masked, spec, order_key=("r",))
    assert fact.count() == n and dims["d"].count() == 51


def test_originals_inside_longer_values(spark):
    out = spark.createDataFrame([("Sold to Ann-Marie O'Neil, today", "ann  marie o neil"), ("Annmarie Oneil", "x Acme"), (None, "ACME"), ("Acmes", "Acme Corp of Acme Corp"), ("Sold to Ann-Marie O'Neil, today", None)],
                                "note string, `a.name` string")
    originals = spark.createDataFrame([("Ann-Marie O'Neil",), ("Acme",), ("Acme Corp",), ("",), ("--",), (None,)], "original string")
    got = {r["column"]: (r["n_rows"], r["n_whole"], r["n_inside"]) for r in pseudonym.embedded_leaks(out, ["note", "a.name"], originals).collect()}
    assert got == {"note": (5, 0, 2), "a.name": (5, 2, 2)}
    none = pseudonym.embedded_leaks(out, ["note"], originals.where("original = '--'")).collect()
    assert [tuple(r) for r in none] == [("note", 5, 0, 0)]


def test_first_occurrences_are_a_hash_aggregate_and_lookups_move_rows_once(spark):
    df = spark.range(400).selectExpr("id AS r", "concat('B', id % 90) AS `buyer.nodes.name`", "if(id % 3 = 0, null, concat('T', id % 4)) AS `attributes.trader`",
                                     f"concat(' G', id % 50) AS `{GTIN}`")
    plan = pseudonym.first_seen(df, ["r"], [GTIN], strip=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    names = ["buyer.nodes.name", "attributes.trader"]
    whole = sorted(map(tuple, pseudonymize(df, ["r"], name_columns=names, strategy="broadcast")[0].collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")  # the traders' entries fit, the buyers' do not
        masked = pseudonymize(df, ["r"], name_columns=names)[0]
        plan = masked._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan and plan.count("rightHint=(strategy=shuffle_hash)") == 1
        assert sorted(map(tuple, masked.collect())) == whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _tables(spark, root):
    """Small input tables: null and repeated keys, lines without order, part or supplier, blank names."""
    made = {
        "region": ("r_regionkey int, r_name string", [(0, "EUROPE"), (1, "MIDDLE EAST")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "FRANCE", 0), (1, "IRAN", 1), (2, None, None)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
                     [(1, "Ann", 0, "AUTO"), (2, " ", 1, None), (3, "Bob", 2, "AUTO"), (3, "Bobby", None, "TOYS"), (None, "Nil", 0, "X")]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(1, "Ann", 0), (2, None, 1), (None, "S", 0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(1, "x", "B1", "T", 5, 1.0), (2, "y", None, "U", None, 2.0), (2, "z", "B1", "Ann", 3, None)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string",
                   [(1, 1, "F", "1-URGENT"), (2, 3, "O", "5-LOW"), (3, 2, "P", None), (4, None, None, "1-URGENT"), (4, 3, "F", "1-URGENT"), (9, 1, "F", "unused")]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,"
                     " l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(o, p, s, 1, 1.0, 2.0, None, 0.1, "R", "O", None) for o in (1, 2, 3, 4, 7, None) for p in (1, 2, 5, None) for s in (1, 2, 8, None)]),
    }
    for name, (schema, data) in made.items():
        spark.createDataFrame(data, schema).write.parquet(f"{root}/{name}.parquet")


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_names_are_masked_in_the_tables_they_come_from(spark, tmp_path, threshold):
    from ordstar.plans import queries

    _tables(spark, tmp_path)
    listed = [*queries.NAME_COLUMNS, *queries.CONTACT_COLUMNS]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = queries.q_pseudo_contacts(spark, str(tmp_path))
        rows = queries.staging(spark, str(tmp_path), ["rowId", *listed])
        want = pseudonym.pseudonymize(rows, queries.LINE_KEY, name_columns=listed, salt=queries.SALT)[0]
        want = queries.safe(want.select("rowId", *queries.cols(listed), *queries.LINE_KEY))
        assert got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() > 96
        # No line moves for a lookup.
        assert "hashpartitioning(__k" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_are_numbered_without_their_order_key(spark):
    rows = spark.createDataFrame([(i, "x", f"v{i % 3}") for i in range(20)], "k long, other string, v string")
    first = pseudonym.first_seen(rows, ["k", "other"], ["v"], strip=True)
    scan = [line for line in first._jdf.queryExecution().optimizedPlan().toString().splitlines() if "parquet" in line]
    assert sorted((r["original"], r["__rk"]) for r in first.collect()) == [("v0", 0), ("v1", 1), ("v2", 2)]
    path = first.inputFiles()[0].rsplit("/", 1)[0]
    assert scan and spark.read.parquet(path).columns == ["v", "__mid"]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_inputs_are_kept_beside_names_masked_in_their_tables(spark, tmp_path, threshold):
    from ordstar.plans import queries

    _tables(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = queries._names(spark, str(tmp_path), keep_input=True)[0]
        rows = queries.staging(spark, str(tmp_path), ["rowId", *queries.NAME_COLUMNS, *queries.CONTACT_COLUMNS])
        want = pseudonym.pseudonymize(rows, queries.LINE_KEY, name_columns=queries.NAME_COLUMNS, salt=queries.SALT, keep_input=True)[0]
        assert got.dtypes == want.dtypes and "__in_buyer.nodes.name" in got.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() > 96
        # No line moves for a lookup.
        assert "hashpartitioning(__k" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_leak_report_reads_the_rows_once(spark):
    data = [("x", "X1", "q", "q"), ("y", "y", "x", "x"), (None, "", None, None), ("y", "x", "q", "x"), ("x", "X1", None, "")]
    masked = spark.createDataFrame(data, "`__in_a.n` string, `a.n` string, __in_c string, c string")
    report = pseudonym.leak_report(masked, ["a.n", "c"], ["a.n"])
    assert sorted(map(tuple, report.collect())) == [("a.n", 5, 1, 2), ("c", 5, 2, 2)]
    # It reads what was counted, not the rows again.
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "__in_" not in plan and "leak" in "".join(report.inputFiles())
    none = pseudonym.leak_report(masked.limit(0), ["a.n", "c"], ["a.n"])
    assert sorted(map(tuple, none.collect())) == [("a.n", 0, 0, 0), ("c", 0, 0, 0)] and none.dtypes == report.dtypes
