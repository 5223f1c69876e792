"""Registered queries: expected counts of SURVEY §7.2 at sf0.001 and the
DuckDB oracle for every query that has one."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stockline.oracle import SQL
from stockline.registry import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf001):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    return c


def n(spark, d, name):
    return QUERIES[name](spark, d).count()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 699


def test_stock_counts(spark, sf001):
    from stockline.plans import bindings as B
    from stockline.plans import stock as S
    assert S.erp_stock(spark, sf001).count() == 1177
    lv = B.channel_levels(spark, sf001).filter(~F.col("location_name").contains(B.ORDERABLE_MARKER))
    assert lv.count() == 1053
    assert n(spark, sf001, "stock_delta") == 699
    assert n(spark, sf001, "stock_zero_out") == 109


def test_price_and_text_counts(spark, sf001):
    pdl = QUERIES["price_delta"](spark, sf001)
    assert pdl.count() == 104 and pdl.filter("price IS NULL").count() == 4
    assert n(spark, sf001, "price_sides") == 752
    assert n(spark, sf001, "text_diff") == 57


def test_snapshot_counts(spark, sf001):
    d = QUERIES["cycle_diff"](spark, sf001)
    assert d.filter("change = 'enter'").count() == 150 and d.filter("change = 'leave'").count() == 150
    assert n(spark, sf001, "row_diff") == 321


def test_customer_classes(spark, sf001):
    got = {r["class"]: r["count"] for r in QUERIES["customer_class"](spark, sf001).groupBy("class").count().collect()}
    assert got == {"no_phone_no_address": 17, "no_phone": 59, "no_address": 16, "complete": 58}


def test_sales_branches(spark, sf001):
    got = {r.operation: r["count"] for r in QUERIES["sales_fact"](spark, sf001).groupBy("operation").count().collect()}
    assert got == {"SETTLED": 1093, "SETTLED_NO_BARCODE": 1571, "OPEN_ORDER": 913, "TODAY_STORE": 558, "TODAY_WEB": 173}
    # 114 house-account lines in all of lineitem; 78 of them fall in branches a–e
    li = spark.read.parquet(f"{sf001}/lineitem.parquet")
    o = spark.read.parquet(f"{sf001}/orders.parquet")
    assert li.join(o, li.l_orderkey == o.o_orderkey).filter(F.col("o_custkey") % 50 == 0).count() == 114
    house = QUERIES["sales_fact"](spark, sf001).filter(~F.col("customer_id").startswith("C")).count()
    assert house == 78


def test_ratio_split_count(spark, sf001):
    s = QUERIES["campaign_split"](spark, sf001)
    assert s.count() == 181 and s.filter("NOT tagged").count() == 36


def test_campaign_rule_items(spark, sf001):
    from stockline.plans import bindings as B
    assert B.items(spark, sf001).filter(F.col("model").isin("Brand#1", "Brand#2", "Brand#3")).count() == 19


def test_change_set_applies(spark, sf001):
    """Applying the physical change set to the store gives the ERP quantity
    on shared keys and 0 on store-only keys."""
    from stockline.plans import bindings as B
    from stockline.plans import stock as S
    lv = B.channel_levels(spark, sf001).filter(~F.col("location_name").contains(B.ORDERABLE_MARKER))
    erp = S.erp_stock(spark, sf001)
    cs = QUERIES["stock_change_set"](spark, sf001).filter("phase IN (3, 4)")
    after = (lv.join(cs.select("variant_sku", "location_id", "delta"), ["variant_sku", "location_id"], "left")
             .select("variant_sku", "location_id", (F.col("qty") + F.coalesce("delta", F.lit(0))).alias("q")))
    chk = after.join(erp.select(F.col("ref").alias("variant_sku"), F.col("warehouse_id").alias("location_id"),
                                "total_quantity"), ["variant_sku", "location_id"], "left")
    bad = chk.filter(F.col("q") != F.coalesce("total_quantity", F.lit(0))).count()
    assert bad == 0
    # made-to-order phases: store level + delta = 5 where the ERP lists the ref, else 0
    o = B.channel_levels(spark, sf001).filter(F.col("location_name").contains(B.ORDERABLE_MARKER))
    ocs = QUERIES["stock_change_set"](spark, sf001).filter("phase IN (1, 2)")
    erp_o = S.orderable_sizes(spark, sf001).select(F.col("ref").alias("variant_sku"),
                                                   F.col("warehouse_id").alias("location_id"), "total_quantity")
    after = (o.join(ocs.select("variant_sku", "location_id", "delta"), ["variant_sku", "location_id"], "left")
             .select("variant_sku", "location_id", (F.col("qty") + F.coalesce("delta", F.lit(0))).alias("q"))
             .join(erp_o, ["variant_sku", "location_id"], "left"))
    assert after.filter(F.col("q") != F.coalesce("total_quantity", F.lit(0))).count() == 0


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k in SQL))
def test_oracle(spark, sf001, con, name):
    df = QUERIES[name](spark, sf001)
    cols = sorted(df.columns)
    r = con.sql(SQL[name])
    assert sorted(r.columns) == cols
    from tools.check import type_diffs
    assert type_diffs(df, r) == {}

    def norm(v):
        return round(v, 6) if isinstance(v, float) else v
    got = sorted((tuple(norm(x[c]) for c in cols) for x in df.collect()), key=repr)
    exp = sorted((tuple(norm(x[r.columns.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
    assert got == exp


def test_every_query_has_oracle():
    assert sorted(set(QUERIES) - set(SQL)) == []


def test_every_arm_occurs(spark, sf001):
    """Queries whose rules have several arms return rows of each."""
    def values(name, column):
        return {r[0] for r in QUERIES[name](spark, sf001).select(column).distinct().collect()}

    assert values("badge_removal", "reason") == {"not orderable", "no stock", "ratio"}
    assert values("campaign_split", "tagged") == {True, False}
    assert values("lookup_sizes", "found") == {True, False}
    diff = QUERIES["text_diff"](spark, sf001)
    assert all(diff.filter(f"{c}_diff").count() for c in ("title", "description", "composition"))
    assert n(spark, sf001, "lookup_sizes_unseen") < n(spark, sf001, "lookup_sizes")
    assert n(spark, sf001, "page_limit") < n(spark, sf001, "json_pages")
