"""Semantic traps T1–T18."""

import pytest
from pyspark.sql import functions as F

from stockline.functions import (clean_text, collapse_ws, concat_blank, phone_digits, split_part, title_case,
                                 two_decimals)


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("s", ["jv-man d'agua", "ÁGUA viva", "2nd place", "o'neil mc-donald", "  two  blanks"])
def test_t8_title_case_matches_python(spark, s):
    assert one(spark, title_case, s) == s.title()


def test_t8_title_case_null(spark):
    assert one(spark, title_case, None) is None


def test_t2_concat_null_as_blank(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    r = df.select(concat_blank("a", F.lit("-"), "b").alias("c"), F.concat("a", F.lit("-"), "b").alias("d")).first()
    assert r["c"] == "a-" and r["d"] is None


def test_t9_split_part_missing_is_null(spark):
    assert one(spark, lambda c: split_part(c, " - ", 1), "Loja") is None
    assert one(spark, lambda c: split_part(c, " - ", 1), "Made to order - Gold") == "Gold"


def test_t10_try_divide_zero(spark):
    df = spark.createDataFrame([(10, 0)], "a int, b int")
    assert df.select(F.try_divide("a", "b").alias("r")).first()["r"] is None


def test_t5_group_drops_null_keys_after_dropna(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "k string, v int")
    g = df.dropna(subset=["k"]).groupBy("k").agg(F.sum("v").alias("s")).collect()
    assert [(r.k, r.s) for r in g] == [("a", 4)]


def test_t6_null_keys_never_match(spark):
    a = spark.createDataFrame([(None, 1)], "k string, v int")
    b = spark.createDataFrame([(None, 2)], "k string, w int")
    assert a.join(b, "k", "inner").count() == 0


def test_t13_missing_text_equals_blank(spark):
    df = spark.createDataFrame([(None, "")], "a string, b string")
    r = df.select((F.coalesce(collapse_ws("a"), F.lit("")) == F.coalesce(collapse_ws("b"), F.lit(""))).alias("eq")).first()
    assert r["eq"] is True


def test_x1_collapse_ws(spark):
    assert one(spark, collapse_ws, "  a \t\n b   c ") == "a b c"


def test_x9_phone_truncates_like_int_float(spark):
    assert one(spark, phone_digits, "5511900000007.0") == "+5511900000007"
    assert one(spark, phone_digits, None) is None


def test_x26_clean_text(spark):
    assert one(spark, clean_text, " nan ") == ""
    assert one(spark, clean_text, None) == ""
    assert one(spark, clean_text, " ok ") == "ok"


def test_x24_two_decimals_no_commas(spark):
    assert one(spark, two_decimals, 12345.5, "double") == "12345.50"


def test_t18_cast_truncates(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,)], "x double")
    assert [r.y for r in df.select(F.col("x").cast("bigint").alias("y")).collect()] == [2, -2]


def test_t16_csv_multiline_bom_duplicate_header(spark, tmp_path):
    from pyspark.sql import types as T
    from stockline.sources import read_delimited
    p = tmp_path / "f.csv"
    p.write_bytes("﻿id;title;title\n1;\"a\nb\";x\n2;c;y\n".encode("utf-8"))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
                           T.StructField("title_1", T.StringType())])
    rows = read_delimited(spark, str(p), schema, multi_line=True).orderBy("id").collect()
    assert len(rows) == 2 and rows[0]["title"] == "a\nb" and rows[0]["id"] == "1" and rows[1]["title_1"] == "y"


def test_t14_missing_store_price_is_kept(spark):
    from stockline.plans.prices import price_delta
    v = spark.createDataFrame([("v1", "A", "p1", None, None), ("v2", "B", "p2", 10.0, None), ("v3", "C", "p3", 5.0, None)],
                              "variant_id string, sku_2 string, product_id string, price double, compare_at_price double")
    it = spark.createDataFrame([("A", 7.0), ("B", 10.0), ("C", 6.0)], "code string, price double")
    got = {r.variant_id: r.delta for r in price_delta(v, it).collect()}
    assert got == {"v1": None, "v3": 1.0}


def test_t1_blank_filter_drops_missing(spark):
    """pandas keeps NaN under ``x != ''``; our intent is "drop blanks", and
    Spark's three-valued logic drops NULL too."""
    df = spark.createDataFrame([("a",), ("",), (None,)], "x string")
    assert [r.x for r in df.filter(F.col("x") != "").collect()] == ["a"]


def test_t3_rtrim_at_ingestion(spark):
    df = spark.createDataFrame([("ADTO ENCOMENDA ",)], "x string")
    assert df.filter(F.col("x") == "ADTO ENCOMENDA").count() == 0
    assert df.filter(F.rtrim("x") == "ADTO ENCOMENDA").count() == 1


def test_t4_not_in_with_null_is_unknown(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    assert df.filter(~F.col("x").isin("b")).count() == 1
    # pandas ``~isin`` keeps the missing row: coalesce to true to reproduce it
    assert df.filter(F.coalesce(~F.col("x").isin("b"), F.lit(True))).count() == 2


def test_t11_boolean_text_parses(spark, tmp_path):
    from pyspark.sql import types as T
    from stockline.sources import read_delimited
    p = tmp_path / "b.csv"
    p.write_text("sku;flag\na;True\nb;false\n")
    schema = T.StructType([T.StructField("sku", T.StringType()), T.StructField("flag", T.BooleanType())])
    assert [r.flag for r in read_delimited(spark, str(p), schema).orderBy("sku").collect()] == [True, False]


def test_t12_unlimited_literal_and_intended(spark, sf001):
    from stockline.plans.stock import stock_by_site
    lit = stock_by_site(spark, sf001, literal_unlimited=True)
    assert lit.filter("unlimited_quantity").count() == 0
    intended = stock_by_site(spark, sf001)
    bad = intended.filter("unlimited_quantity AND total_quantity > 0").count()
    assert bad == 0


def test_t17_dotted_names_need_backticks(spark):
    df = spark.createDataFrame([("x",)], "`variant.sku` string")
    assert df.select(F.col("`variant.sku`").alias("variant_sku")).first()["variant_sku"] == "x"


def test_s5_csv_with_bom_round_trip(spark, tmp_path):
    import glob
    from pyspark.sql import types as T
    from stockline.sources import read_delimited, write_delimited
    df = spark.createDataFrame([("a", 1.5), ("b;c", None)], "id string, price double")
    out = str(tmp_path / "out")
    write_delimited(df.coalesce(1), out, bom=True)
    part = [p for p in glob.glob(out + "/part-*") if p.endswith(".csv")][0]
    assert open(part, "rb").read(3) == b"\xef\xbb\xbf"
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("price", T.DoubleType())])
    back = sorted((r.id, r.price) for r in read_delimited(spark, out, schema).collect())
    assert back == [("a", 1.5), ("b;c", None)]


def test_whitespace_and_padding(spark):
    """Collapse, then strip every kind of whitespace; padding never cuts."""
    from stockline.functions import zero_pad
    assert one(spark, collapse_ws, "\n a \t b\n") == "a b"
    assert one(spark, clean_text, "\n\tok\t\n") == "ok" and one(spark, clean_text, "\nnan\n") == ""
    assert one(spark, lambda c: zero_pad(c, 6), "1000001") == "1000001" and one(spark, lambda c: zero_pad(c, 6), "42") == "000042"
