import math

from pyspark.sql import functions as F

from ordstar.functions import text as fn
from ordstar.operators.clean import coerce_numeric, coerce_report
from ordstar.sources.text import read_delimited, write_delimited
from ordstar.session import scratch_path


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_strip_removes_all_whitespace(spark):
    assert one(spark, "\t  a b\n", fn.py_strip) == "a b"


def test_zfill_pads_but_never_truncates(spark):
    assert one(spark, "1", lambda c: fn.zfill(c, 6)) == "000001"
    assert one(spark, "1234567", lambda c: fn.zfill(c, 6)) == "1234567"


def test_capitalize_is_first_upper_rest_lower(spark):
    assert one(spark, "hELLO wORLD", fn.capitalize) == "Hello world"


def test_last_number(spark):
    assert one(spark, "FAKE_GTIN_000007", fn.last_number) == 7
    assert one(spark, "FAKE_GTIN_x", fn.last_number) is None


def test_is_blank(spark):
    assert one(spark, " \t", fn.is_blank) is True
    assert one(spark, None, fn.is_blank) is True
    assert one(spark, " a", fn.is_blank) is False


def test_coerce_matches_lenient_number_reader(spark):
    inputs = [" 12 ", "1e3", "1,5", "1d", "inf", "nan", "abc", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    out = dict(coerce_numeric(df, ["v"]).select("i", "v").collect())
    assert out[0] == 12.0 and out[1] == 1000.0
    assert out[2] is None and out[3] is None
    assert math.isinf(out[4]) and out[4] > 0
    assert out[5] is None and out[6] is None and out[7] is None


def test_coerce_skips_missing_columns_and_reports(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert coerce_numeric(df, ["a", "missing"]).columns == ["a"]
    rep = coerce_report(df, ["a", "missing"]).collect()
    assert [(r["column"], r["n_text"], r["n_numbers"], r["n_coerced_null"]) for r in rep] == [("a", 2, 1, 1)]


def test_csv_na_tokens_are_exact_and_untrimmed(spark):
    df = spark.createDataFrame([("NA", "x"), (" NA ", "y;z"), ('q"uote', "multi\nline")], "a string, b string")
    path = scratch_path(spark, "t-csv")
    write_delimited(df, path)
    back = read_delimited(spark, path, ["a", "b"]).collect()
    got = sorted([(r["a"], r["b"]) for r in back], key=str)
    assert (None, "x") in got
    assert (" NA ", "y;z") in got
    assert ('q"uote', "multi\nline") in got


def test_mapping_csv_roundtrip_and_absent_file(spark, tmp_path):
    from ordstar.operators.pseudonym import id_counters
    from ordstar.sources.text import export_mapping_csv, load_mapping_csv

    assert load_mapping_csv(spark, str(tmp_path / "none.csv"), "id_map").count() == 0
    m = spark.createDataFrame([("A", "FAKE_GTIN_000007", "GTIN"), ("B", "PO_000003", "PO"), ("C", "FAKE_HS_x", "HS")],
                              "original string, fake string, id_type string")
    export_mapping_csv(m, str(tmp_path / "ids"), "id_map")
    back = load_mapping_csv(spark, str(tmp_path / "ids"), "id_map")
    assert sorted(back.collect()) == sorted(m.collect())
    counters = {r.id_type: r["__counter"] for r in id_counters(back).collect()}
    assert counters == {"GTIN": 7, "PO": 3, "HS": None}
