"""KPIs over the star, over staging, and as state of several loads."""

from ordstar.operators import kpi, star
from ordstar.sources.adapter import staging
from ordstar.specs import ORDER_STAR

from conftest import SMALL


def test_volumes_of_the_star_equal_those_of_staging(spark):
    st = staging(spark, SMALL)
    dims, fact = star.build_star(st, ORDER_STAR, number_fact=False, dims=("dim_product", "dim_trader"))
    plain = st.withColumnsRenamed({"produits.nodes.asset.descriptionShort": "product", "attributes.trader": "trader"})
    assert sorted(map(str, kpi.kpi_volume(fact, dims).collect())) == sorted(map(str, kpi.volume_report(plain).collect()))


def test_states_merge_to_the_state_of_all_rows(spark):
    inf = float("inf")
    rows = [("a", 0.1, 1.0, "x"), ("a", 0.2, None, "y"), ("b", inf, 2e27, "x"), ("b", 1.0, 1.0, None), (None, None, None, "z"), ("a", 0.3, 4.0, "x")]
    df = spark.createDataFrame(rows, "k string, m double, n double, buyer string")
    whole = kpi.kpi_state(df, ["k"], ["m", "n"], "buyer")
    loads = [kpi.kpi_state(spark.createDataFrame(part, df.schema), ["k"], ["m", "n"], "buyer") for part in (rows[:2], rows[2:3], rows[3:])]
    merged = kpi.merge_states(loads[0].unionByName(loads[1]).unionByName(loads[2]), ["k"], 2)

    def read(state):
        return sorted(map(tuple, kpi.read_state(state, ["k"], ["m", "n"]).collect()), key=str)

    assert read(merged) == read(whole) == sorted([("a", 3, 0.6, 5.0, 2), ("b", 2, inf, 2e27, 1), (None, 1, None, None, 1)], key=str)
