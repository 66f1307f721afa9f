from pyspark.sql import functions as F

from ordstar.operators import star
from ordstar.operators.numbering import dense_number
from ordstar.specs import DimSpec, StarSpec

SPEC = StarSpec(dims=(DimSpec("d", "id_d", ("k", "p"), join_key="k"),), fact_text=("t",), measures=("v",))


def staging(spark, data):
    return spark.createDataFrame(data, "t string, k string, p string, v double, o long")


def test_null_key_dimension_row_kept_and_fact_row_kept(spark):
    st = staging(spark, [("a", None, "r", 1.0, 0), ("b", "A", "p", 2.0, 1)])
    dims = star.build_dimensions(st, SPEC)
    d = sorted(dims["d"].collect(), key=lambda r: r.id_d)
    assert [(r.k, r.p) for r in d] == [(None, "r"), ("A", "p")]  # nulls first, then values
    part = star.fact_partial_key(st, dims, SPEC).collect()
    assert len(part) == 2 and {r.t: r.id_d for r in part}["a"] is None
    full = star.fact_full_key(st, dims, SPEC, order_key=("o",)).collect()
    assert {r.t: r.id_d for r in full} == {"a": 1, "b": 2}


def test_partial_key_fans_out_full_key_does_not(spark):
    st = staging(spark, [("x", "A", "p", 1.0, 0), ("y", "A", "q", 1.0, 1)])
    dims = star.build_dimensions(st, SPEC)
    assert star.fact_partial_key(st, dims, SPEC).count() == 4  # each row matches (A,p) and (A,q)
    assert star.fact_full_key(st, dims, SPEC, order_key=("o",)).count() == 2


def test_dense_number_is_independent_of_partitioning(spark):
    base = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    expect = [(k, k + 1) for k in range(5000)]
    for n in (1, 3, 17):
        got = dense_number(base.repartition(n), ["k"], id_col="n", num_partitions=n)
        assert sorted((r.k, r.n) for r in got.collect()) == expect


def test_dense_number_per_group_and_hot_duplicates(spark):
    # One value holds a third of the rows: identical sort keys still spread
    # over range partitions (per-row tie) and get distinct numbers.
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                     (F.col("id") % 2).alias("g"))
    got = dense_number(df, ["k"], id_col="n", groups=["g"], num_partitions=6).collect()
    for g in (0, 1):
        ns = sorted(r.n for r in got if r.g == g)
        assert ns == list(range(1, len(ns) + 1))


def test_dense_number_plan_has_no_global_window(spark):
    df = spark.range(0, 100).select(F.col("id").alias("k"))
    plan = dense_number(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_full_key_fact_joins_broadcast_small_dimensions(spark):
    st = staging(spark, [("x", "A", "p", 1.0, 0), ("y", "B", "q", 1.0, 1)])
    dims = star.build_dimensions(st, SPEC)
    fact = star.fact_full_key(st, dims, SPEC, numbered=False)
    fact.collect()
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_partial_key_rows_equal_sum_of_products(spark):
    from ordstar.sources.adapter import staging as staging_of
    from ordstar.specs import ORDER_STAR

    from conftest import SMALL

    st = staging_of(spark, SMALL)
    names = ["dim_buyer", "dim_product", "dim_certification"]
    dims = star.build_dimensions(st, ORDER_STAR)
    got = star.fact_partial_key(st, dims, ORDER_STAR, dim_names=names).count()
    pdf = st.toPandas()
    expect = 0
    mult = {}
    for n in names:
        d = ORDER_STAR.dim(n)
        mult[n] = dims[n].toPandas()[d.join_key].value_counts(dropna=True).to_dict()
    for _, row in pdf.iterrows():
        p = 1
        for n in names:
            k = row[ORDER_STAR.dim(n).join_key]
            p *= mult[n].get(k, 1) if k is not None else 1
        expect += p
    assert got == expect


def test_partial_key_summary_equals_row_level_load(spark):
    from ordstar.operators import kpi
    from ordstar.sources.adapter import staging as staging_of
    from ordstar.specs import ORDER_STAR

    from conftest import SMALL

    st = staging_of(spark, SMALL)
    d = ORDER_STAR.dim("dim_product")
    dims = {d.name: star.build_dimension(st, d)}
    rows = star.fact_partial_key(st, dims, ORDER_STAR, dim_names=[d.name])
    brute = rows.groupBy(d.key).agg(F.count(F.lit(1)).alias("n"), kpi.exact_sum(F.col("`produits.nodes.value`")).alias("v"))
    fast = star.partial_key_summary(st, dims, ORDER_STAR, d.name, ["produits.nodes.value"])
    assert sorted(map(tuple, brute.collect()), key=str) == sorted(map(tuple, fast.collect()), key=str)


def test_small_dimensions_are_broadcast_and_joined_first(spark):
    df = spark.createDataFrame([(i, f"B{i}", f"T{i % 3}" if i % 5 else None) for i in range(300)], "r long, b string, t string")
    spec = StarSpec(dims=(DimSpec("big", "id_b", ("b",), join_key="b"), DimSpec("small", "id_t", ("t",), join_key="t")), fact_text=("r",), measures=())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000")  # 300 rows of 28 bytes are more, 4 rows are less
        fact = star.build_star(df, spec, order_key=("r",))[1]
        plan = fact._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("rightHint=(strategy=broadcast)") == 1 and plan.index("strategy=broadcast") > plan.index("Join LeftOuter")
        assert fact.where("id_b IS NULL OR id_t IS NULL").count() == 0 and fact.count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
