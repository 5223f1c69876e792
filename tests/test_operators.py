"""Operators and synthetic copies of the reference's golden pairs."""

import pandas as pd
from pyspark.sql import functions as F

from stockline.operators import ffill_by_key, first_per_key, key_changes, row_diff, row_diff_both, union_priority


def test_first_per_key_hot_key(spark):
    rows = [("hot", i, f"v{i}") for i in range(3000, 0, -1)] + [("cold", 5, "c5"), ("cold", 2, "c2")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(8)
    got = {r.k: (r.o, r.v) for r in first_per_key(df, ["k"], ["o"]).collect()}
    assert got == {"hot": (1, "v1"), "cold": (2, "c2")}
    got = {r.k: r.o for r in first_per_key(df, ["k"], ["o"], descending=True).collect()}
    assert got == {"hot": 3000, "cold": 5}


def test_row_diff_null_safe_and_multiset(spark):
    today = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("c", 2)], "k string, v int")
    base = spark.createDataFrame([("a", None), ("c", 3)], "k string, v int")
    assert sorted((r.k, r.v) for r in row_diff(today, base).collect()) == [("b", 1), ("c", 2)]
    # second run against the new base is empty
    assert row_diff(today, today).count() == 0


def _ids(n0, n1):
    return [(f"id{i}",) for i in range(n0, n1)]


def test_golden_two_way_diff_303_vs_306(spark):
    today = spark.createDataFrame(_ids(0, 303), "id string")
    base = spark.createDataFrame(_ids(0, 306), "id string")
    d = row_diff_both(today, base)
    assert d.filter("is_active").count() == 0
    assert d.filter("NOT is_active").count() == 3


def test_golden_key_cycle_149_equal(spark):
    a = spark.createDataFrame(_ids(0, 149), "id string")
    ch = key_changes(a, a, ["id"])
    assert ch.filter("change <> 'keep'").count() == 0


def test_key_cycle_algebra(spark):
    today = spark.createDataFrame([(i, f"t{i}") for i in range(0, 100) if i % 10], "k int, v string")
    base = spark.createDataFrame([(i, f"b{i}") for i in range(0, 100) if i % 10 != 1], "k int, v string")
    ch = key_changes(today, base, ["k"]).cache()
    enter = ch.filter("change = 'enter'")
    kept = ch.filter("change = 'keep'")
    nxt = ch.filter("change <> 'leave'")
    assert enter.count() + kept.count() == today.count()
    assert sorted(r.k for r in nxt.collect()) == sorted(r.k for r in today.collect())
    # a kept key keeps its base row; only an entering key brings today's
    assert {r.k: r.v for r in nxt.collect()} == {r.k: f"t{r.k}" if r.k % 10 == 1 else f"b{r.k}" for r in today.collect()}


def test_union_priority(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "k string, v int")
    assert sorted((r.k, r.v) for r in union_priority([a, b], ["k"]).collect()) == [("x", 1), ("y", 3)]


def test_ffill_matches_pandas_across_buckets(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 3), i, (float(i) if rnd.random() < 0.2 else None)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, seq long, x double")
    got = {r.seq: r.x for r in ffill_by_key(df, "k", "seq", ["x"], partitions=9).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "seq", "x"]).sort_values("seq")
    pdf["x"] = pdf.groupby("k")["x"].ffill()
    exp = {int(s): (None if pd.isna(x) else float(x)) for s, x in zip(pdf.seq, pdf.x)}
    assert got == exp


def test_golden_ratio_split_86(spark):
    from stockline.plans.campaign import campaign_split
    rows = [(i, 5 * 3, 3) for i in range(24)] + [(100 + i, 7 + i % 3, 3) for i in range(61)] + [(999, 0, 4)]
    stats = spark.createDataFrame(rows, "item_key long, total_inventory long, total_variants long")
    s = campaign_split(stats)
    assert s.count() == 85
    assert s.filter("tagged").count() == 61 and s.filter("NOT tagged").count() == 24


def test_golden_zero_out_one_row(spark):
    from stockline.plans.stock import stock_zero_out
    lv = spark.createDataFrame([("lvl-1", "AN000001-12", "var-x", "inv-x", "loc-1001", "North", 1)],
                               "level_id string, variant_sku string, variant_id string, inventory_item_id string, "
                               "location_id string, location_name string, qty long")
    erp = spark.createDataFrame([("PX000002", "loc-1001", 3, "North")],
                                "ref string, warehouse_id string, total_quantity long, warehouse_name string")
    r = stock_zero_out(lv, erp).collect()
    assert len(r) == 1 and r[0].delta == -1 and r[0].erp_qty == 0


def test_golden_campaign_rule_match(spark):
    from stockline.plans.campaign import campaign_price
    cand = spark.createDataFrame([(f"S{i}", f"v{i}", f"p{i}", 100.0, 200.0, f"S{i}") for i in range(4)],
                                 "sku string, variant_id string, product_id string, price double, "
                                 "compare_at_price double, sku_2 string")
    items = spark.createDataFrame([("S0", "Brand#1", "x"), ("S1", "Brand#2", "y"), ("S2", "Brand#9", "z"),
                                   ("S3", "Brand#1", "an anvil")], "code string, model string, description string")
    got = {r.sku: r.campaign_price for r in campaign_price(spark, cand, items).collect()}
    assert got == {"S0": 160.0, "S1": 140.0, "S2": 180.0}
    nolist = cand.limit(1).withColumn("compare_at_price", F.lit(None).cast("double"))
    assert campaign_price(spark, nolist, items).first().campaign_price is None


def test_base_code(spark):
    from stockline.functions import base_code
    df = spark.createDataFrame([("AN000001-12",), ("PX000003",)], "s string")
    assert [r.b for r in df.select(base_code(F.col("s")).alias("b")).collect()] == ["AN000001", "PX000003"]


def test_key_changes_duplicate_keys_do_not_pair(spark):
    """A hot key with many copies on both sides must not emit n × m rows."""
    today = spark.createDataFrame([(1, f"t{i}") for i in range(300)] + [(2, "x")], "k int, v string")
    base = spark.createDataFrame([(1, f"b{i}") for i in range(200)] + [(3, "y")], "k int, v string")
    ch = key_changes(today, base, ["k"])
    got = {r.change: r["count"] for r in ch.groupBy("change").count().collect()}
    assert got == {"keep": 200, "enter": 1, "leave": 1}  # the base rows are kept


def test_cycles_hold_a_bounded_number_of_rows_in_a_task(spark):
    from stockline.plans.cycles import cycle_diff, cycle_next_base
    today = spark.createDataFrame([(i, f"t{i}") for i in range(0, 4000) if i % 10], "k int, v string").repartition(4)
    base = spark.createDataFrame([(i, f"b{i}") for i in range(0, 4000) if i % 10 != 1], "k int, v string").repartition(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for cycle, least in ((cycle_diff, 30), (cycle_next_base, 30)):
            small, plain = cycle(today, base, ["k"], rows_a_task=200), cycle(today, base, ["k"])
            assert sorted(map(tuple, small.collect())) == sorted(map(tuple, plain.collect()))
            tasks = small.groupBy(F.spark_partition_id().alias("p")).count().collect()
            assert len(tasks) >= least and max(r["count"] for r in tasks) < 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_row_diff_hot_copies(spark):
    today = spark.createDataFrame([("hot", 1)] * 500 + [("new", 2)] * 3, "k string, v int")
    base = spark.createDataFrame([("hot", 1)] * 400, "k string, v int")
    assert sorted((r.k, r.v) for r in row_diff(today, base).collect()) == [("new", 2)] * 3


def test_golden_orderable_flag(spark):
    from stockline.plans.flags import flag_orderable
    from stockline.plans import bindings as B
    g, s = B.ORDERABLE_LOCATION["GOLD"], B.ORDERABLE_LOCATION["SILVER"]
    rows = [("a", "va", g[0], g[1], 1), ("a", "va", s[0], s[1], 0), ("b", "vb", g[0], g[1], 0),
            ("b", "vb", s[0], s[1], 0), ("c", "vc", s[0], s[1], 5), ("d", "vd", "loc-1000", "Center", 9)]
    lv = spark.createDataFrame(rows, "variant_sku string, variant_id string, location_id string, "
                                     "location_name string, qty long")
    got = {r.variant_sku: (r.orderable_gold, r.orderable_silver, r.is_orderable) for r in flag_orderable(lv).collect()}
    assert got == {"a": (1, 0, True), "b": (0, 0, False), "c": (0, 5, True)}


def test_golden_metafield_ids_distinct(spark):
    from stockline.plans.campaign import metafield_cleanup
    rows = [(f"mf{i % 580}", f"p{i}", "k") for i in range(811)] + [("", "px", "k"), (None, "py", "k")]
    m = spark.createDataFrame(rows, "metafield_id string, product_id string, key string")
    out = metafield_cleanup(m)
    assert out.count() == 580
    assert out.filter("metafield_id = 'mf0'").first().product_id == "p0"


def test_ring_price_feed_forms_agree(spark, sf001):
    from stockline.plans import bindings as B
    from stockline.plans.prices import ring_price_feed
    v, it, lv = B.channel_variants(spark, sf001), B.items(spark, sf001), B.channel_levels(spark, sf001)
    a = sorted(tuple(r) for r in ring_price_feed(v, it, lv, by="base").collect())
    b = sorted(tuple(r) for r in ring_price_feed(v, it, lv, by="product").collect())
    assert a == b and len(a) == 75
