"""Dashboard indicators over the star: volumes, traceability rates, buyers.

Sums go through ``decimal`` so the result does not depend on the order in
which partial sums are combined (double addition is not associative); the
exact total is then returned as a double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordstar.functions.text import col
from ordstar.specs import ORDER_STAR, TRACEABILITY_MEASURES, VOLUME_MEASURE, StarSpec

EXACT = "decimal(38,10)"


def exact_sum(c: Column) -> Column:
    """Sum that does not depend on the order of its parts; measures keep ten
    decimals. A group with an infinite value (or NaN) sums as doubles do."""
    x = c.cast("double")
    finite = F.when(F.abs(x) < F.lit(1e27), x)
    odd = F.count(F.when(~(F.abs(x) < F.lit(1e27)), True)) > 0
    return F.when(odd, F.sum(x)).otherwise(F.sum(finite.cast(EXACT)).cast("double"))


VOLUME_COLUMNS = ("produits.nodes.value", "feedstock.nodes.quantity", "attributes.volumeContact")


def kpi_volume(fact: DataFrame, dims: dict[str, DataFrame], spec: StarSpec = ORDER_STAR) -> DataFrame:
    """Volumes by order type, by product and by trader, over the star."""
    prod = dims["dim_product"].select(
        "id_product", col("produits.nodes.asset.descriptionShort").alias("product"))
    trad = dims["dim_trader"].select("id_trader", col("attributes.trader").alias("trader"))
    return volume_report(fact.join(prod, "id_product", "left").join(trad, "id_trader", "left"))


def volume_report(rows: DataFrame) -> DataFrame:
    """The same over rows that hold ``type``, ``product``, ``trader`` and the measures (a
    full-key fact row has its staging row's own names, so staging does as well). Rows
    are added up once per combination; the three groupings add up those."""
    names = ["type", "product", "trader"]
    fine = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n_lines"), *_sums(VOLUME_COLUMNS))
    g = fine.groupingSets([[n] for n in names], *names).agg(
        F.grouping_id(*names).alias("gid"), F.sum("n_lines").alias("n_lines"),
        *[F.sum(f"{c}{i}").alias(f"{c}{i}") for i in range(len(VOLUME_COLUMNS)) for c in "dxo"])
    level = F.when(F.col("gid") == 3, "type").when(F.col("gid") == 5, "product").otherwise("trader")
    key = F.when(F.col("gid") == 3, F.col("type")).when(F.col("gid") == 5, F.col("product")).otherwise(F.col("trader"))
    return g.select(level.alias("level"), key.alias("key"), "n_lines",
                    *[_total(i).alias(n) for i, n in enumerate(("total_value", "total_quantity", "total_volume_contact"))])


def _sums(measures: Sequence[str]) -> list[Column]:
    """Per measure ``i`` the exact sum ``d<i>`` of its finite values (ten decimals), and the
    sum ``x<i>`` and number ``o<i>`` of all others. All three add up over groups."""
    out = []
    for i, m in enumerate(measures):
        x = col(m).cast("double")
        finite = F.abs(x) < F.lit(1e27)
        out += [F.sum(F.when(finite, x).cast(EXACT)).alias(f"d{i}"), F.sum(F.when(~finite, x)).alias(f"x{i}"), F.count(F.when(~finite, True)).alias(f"o{i}")]
    return out


def _total(i: int) -> Column:
    exact = F.col(f"d{i}").cast("double")
    return F.when(F.col(f"o{i}") > 0, F.col(f"x{i}") + F.coalesce(exact, F.lit(0.0))).otherwise(exact)


def volume_by_buyer(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    buyer = dims["dim_buyer"].select("id_buyer", col("buyer.nodes.name").alias("buyer"))
    return (fact.join(buyer, "id_buyer", "left").groupBy("buyer")
                .agg(F.count(F.lit(1)).alias("n_lines"),
                     exact_sum(col("produits.nodes.value")).alias("total_value"),
                     exact_sum(col("feedstock.nodes.quantity")).alias("total_quantity")))


def kpi_traceability(fact: DataFrame, measures=TRACEABILITY_MEASURES, volume: str = VOLUME_MEASURE) -> DataFrame:
    """Per rate: plain average, volume-weighted average, coverage."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, m in enumerate(measures):
        r = col(m)
        v = F.when(r.isNotNull(), col(volume))
        aggs += [
            exact_sum(r).alias(f"s{i}"),
            F.count(r).alias(f"c{i}"),
            exact_sum(v * r).alias(f"vr{i}"),
            exact_sum(v).alias(f"v{i}"),
        ]
    one = fact.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"),
                 (F.col(f"s{i}") / F.col(f"c{i}")).alias("avg_rate"),
                 (F.col(f"vr{i}") / F.col(f"v{i}")).alias("weighted_rate"),
                 (F.col(f"c{i}") / F.col("n_rows")).alias("coverage"),
                 F.col(f"c{i}").alias("n_values"))
        for i, m in enumerate(measures)]))
    return one.select(rows.alias("r")).select("r.*")


def kpi_buyers(fact: DataFrame, dims: dict[str, DataFrame], approx: bool = False) -> DataFrame:
    """Distinct buyers per order type and overall (rollup)."""
    buyer = dims["dim_buyer"].select("id_buyer", col("buyer.nodes.name").alias("buyer"))
    x = fact.join(buyer, "id_buyer", "left")
    n = F.approx_count_distinct("buyer") if approx else F.countDistinct("buyer")
    return (x.rollup("type").agg(F.grouping_id("type").alias("gid"), n.alias("n_buyers"))
             .select(F.when(F.col("gid") == 1, "ALL").otherwise("type").alias("level"),
                     "type", "n_buyers"))


# --- KPIs as state that merges ---------------------------------------------------------------
#
# One load's rows become one small row per group: exact sums, counts, and a sketch of
# the distinct buyers. States of several loads are added up without reading a
# fact row again, in any order and grouping.

#: log2 of the sketch's registers; its relative standard error is 1.04 / sqrt(2 ** SKETCH).
SKETCH = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH / 2)


def kpi_state(rows: DataFrame, keys: list[str], measures: list[str], buyer: str) -> DataFrame:
    """Per group of ``keys``: ``n_lines``, the sums of ``_sums``, and ``buyers``, a sketch of
    the distinct non-null buyers."""
    return rows.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_lines"), *_sums(measures), F.hll_sketch_agg(col(buyer), F.lit(SKETCH)).alias("buyers"))


def merge_states(states: DataFrame, keys: list[str], n_measures: int) -> DataFrame:
    """The state of all loads together, from the states of each (a union of them)."""
    aggs = [F.sum("n_lines").alias("n_lines")]
    for i in range(n_measures):
        aggs += [F.sum(f"{c}{i}").alias(f"{c}{i}") for c in "dxo"]
    return states.groupBy(*[col(k) for k in keys]).agg(*aggs, F.hll_union_agg("buyers").alias("buyers"))


def read_state(state: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """KPIs of a state: ``n_lines``, a total per measure under ``names``, ``n_buyers`` (estimate)."""
    totals = [_total(i).alias(n) for i, n in enumerate(names)]
    return state.select(*[col(k) for k in keys], "n_lines", *totals, F.hll_sketch_estimate("buyers").alias("n_buyers"))
