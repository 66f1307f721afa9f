import pytest
from pyspark.sql import functions as F

from ordstar import session
from ordstar.operators import parts, pseudonym, star
from ordstar.operators.numbering import dense_number
from ordstar.plans.queries import QUERIES
from ordstar.specs import DimSpec, StarSpec

from conftest import SMALL

SPEC = StarSpec(dims=(DimSpec("big", "id_b", ("b", "c"), join_key="b", not_null=("b",)), DimSpec("other", "id_o", ("c", "d.e"), join_key="c")),
                fact_text=("t",), measures=("v",))


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(spark):
    # Nulls that make tuples look alike, repeated rows, null order keys.
    data = [(f"t{i % 7}", [None, "x", "y"][i % 3], [None, "x", "z", "y"][i % 4], [None, "x"][i % 2], float(i % 5), None if i % 11 == 0 else i % 90, i % 13) for i in range(400)]
    return spark.createDataFrame(data, "t string, b string, c string, `d.e` string, v double, o1 long, o2 long").repartition(5)


def in_place(spark, st, order):
    with parts.in_place(spark):
        dims, fact = star.build_star(st, SPEC, order_key=order)
        assert "ShuffledHashJoin" in plan(fact)
        return dims, plan(fact), session.materialize(fact, "t-fact")


def as_before(st, dims, fact):
    keys = ["t", "id_b", "id_o", "v"]
    plain = star.fact_full_key(st, dims, SPEC, numbered=False)
    return sorted(map(repr, fact.select(*keys).collect())) == sorted(map(repr, plain.select(*keys).collect()))


def test_star_rows_stay_while_hashes_move(spark, no_broadcast):
    st = rows_of(spark)
    dims, p, fact = in_place(spark, st, ("o1", "o2"))
    assert as_before(st, dims, fact)
    assert fact.where("id_b IS NULL").count() == st.where("b IS NULL").count() > 0 and fact.where("id_o IS NULL").count() == 0
    assert sorted(r[0] for r in fact.select("id_fact").collect()) == list(range(1, 401))
    # What is dealt by part are answers and numbers, as asked; the rows are never dealt by a join.
    assert not any("Exchange hashpartitioning(__part" in line and "ENSURE" in line for line in p.splitlines())


def test_fact_key_follows_the_order_on_pinned_rows(spark):
    st = rows_of(spark).select("t", "b", "c", F.col("`d.e`"), F.monotonically_increasing_id().cast("double").alias("v"), F.monotonically_increasing_id().alias("o1"))
    st = session.materialize(st, "t-rows")
    fact = in_place(spark, st, ("o1",))[2]
    assert [r.v for r in fact.orderBy("id_fact").collect()] == sorted(r.v for r in st.collect())


def test_hashes_that_meet_are_matched_by_attributes(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(star, "_tuple_hash", lambda values: F.lit(7).cast("bigint"))
    st = rows_of(spark)
    dims, _, fact = in_place(spark, st, ("o1", "o2"))
    assert as_before(st, dims, fact)


def test_audit_and_fact_leave_only_what_they_return(spark):
    for name, kept in (("fact_full_key", ["fact"]), ("integrity_audit", ["audit"])):
        before = set(session._MADE)
        df = QUERIES[name](spark, SMALL)
        assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in session._MADE if p not in before] == kept
        assert df.count() > 0


def test_shuffle_files_go_with_their_write(spark, tmp_path):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toString()
        return found.count("shuffle_")

    df = spark.range(1000).repartition(4, "id")
    before = files()
    with session.freed_shuffles(spark):
        df.write.parquet(f"{tmp_path}/a")
    assert files() <= before
    assert spark.conf.get(session._FREE) == "false"


def test_numbers_in_place_where_tasks_hold_whole_stretches(spark):
    df = spark.createDataFrame([(f"f{i // 100}", i, j, f"v{-j}") for i in range(300) for j in range(i % 3 + 1)], "file string, doc long, pos int, v string")
    dealt = df.repartitionByRange(4, "file", "doc").sortWithinPartitions("doc")
    want = sorted(map(tuple, dense_number(df, ["file", "doc", "pos", "v"], id_col="n").collect()))
    got = parts.number_in_place(dealt, ["file", "doc", "pos", "v"], ["file", "doc"], "n", "t-numbered")
    assert "rangepartitioning" not in plan(got)
    assert sorted(map(tuple, got.select("file", "doc", "pos", "v", "n").collect())) == want
    # Stretches that overlap, or a null among the keys: numbered as usual.
    mixed = parts.number_in_place(df.repartition(4), ["file", "doc", "pos", "v"], ["file", "doc"], "n", "t-numbered")
    assert sorted(map(tuple, mixed.select("file", "doc", "pos", "v", "n").collect())) == want
    nulls = df.withColumn("file", F.when(F.col("doc") > 50, F.col("file"))).repartitionByRange(4, "file", "doc")
    got = parts.number_in_place(nulls, ["file", "doc", "pos", "v"], ["file", "doc"], "n", "t-numbered")
    assert sorted(r.n for r in got.collect()) == list(range(1, df.count() + 1)) and got.where("file IS NULL").agg(F.min("n")).first()[0] == 1


def test_masked_rows_stay_and_agree(spark):
    names, ids = ["buyer.nodes.name", "attributes.trader"], ["rowId", "produits.nodes.asset.attributes.gtin"]
    data = [(i, f"N{i % 90}" if i % 5 else "  ", f"N{(i * 3) % 70}" if i % 4 else None, f" P{i // 3}", f"G{i % 80} " if i % 6 else None) for i in range(400)]
    df = spark.createDataFrame(data, "r long, " + ", ".join(f"`{c}` string" for c in [*names, *ids]))
    def mask(**more):
        return pseudonym.pseudonymize(df, ["r"], name_columns=names, id_columns=ids, salt="t", **more)

    want = [sorted(map(tuple, x.collect())) for x in mask(strategy="broadcast")]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        with parts.in_place(spark):
            got = mask()
            p = plan(got[0])
            got = [sorted(map(tuple, session.materialize(x, "t-masked").collect())) for x in got]
        # Outside, the same rows are dealt to the lookups.
        plain = [sorted(map(tuple, x.collect())) for x in mask()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == want == plain
    assert p.count("ShuffledHashJoin") == 4 and not any("Exchange hashpartitioning(__part" in line and "ENSURE" in line for line in p.splitlines())


def test_numbered_rows_are_not_numbered_again(spark):
    df = spark.createDataFrame([(5, "b"), (9, "a"), (7, "b")], "n long, v string")
    first = pseudonym.first_seen(df, ["n"], ["v"], strip=True, numbered=True)
    assert "rangepartitioning" not in plan(first) and "parquet" not in plan(first)
    assert sorted((r["original"], r["__rk"]) for r in first.collect()) == [("a", 9), ("b", 5)]
