"""Role-playing joins, rule tables and the extracts that use them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from stockline.operators import Rule, join_roles, keep, predicate, rules_of
from stockline.plans import bindings as B
from stockline.plans import catalog as C
from stockline.plans import sales as SA
from stockline.plans import stock as S


def plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


# ---- roles -----------------------------------------------------------------

def role_frames(spark):
    fact = spark.createDataFrame([(i, f"P{i % 3}", f"P{i % 7}" if i % 5 else None, "hot") for i in range(40)],
                                 "id int, buyer string, seller string, owner string")
    dim = spark.createDataFrame([(f"P{i}", f"name {i}", i) for i in range(5)] + [("hot", "Hot", 9)], "id string, name string, rank int")
    return fact, dim


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_roles_give_each_role_its_row(spark, broadcast_rows):
    fact, dim = role_frames(spark)
    got = join_roles(fact, dim, "id", {"buyer": "buyer", "seller": "seller", "owner": "owner"}, ["name", "rank"], broadcast_rows)
    assert got.columns == [*fact.columns, "buyer_name", "buyer_rank", "seller_name", "seller_rank", "owner_name", "owner_rank"]
    names = {f"P{i}": (f"name {i}", i) for i in range(5)} | {"hot": ("Hot", 9)}
    none = (None, None)
    want = [(r.id, r.buyer, r.seller, r.owner, *names.get(r.buyer, none), *names.get(r.seller, none), *names.get(r.owner, none))
            for r in fact.collect()]
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_roles_exchange_the_dimension_once(spark):
    fact, dim = role_frames(spark)
    roles = {"buyer": "buyer", "seller": "seller", "owner": "owner"}
    small = join_roles(fact, dim, "id", roles, ["name"], 100)
    small.collect()
    final = plan(small).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 2 and final.count("BroadcastExchange") - final.count("ReusedExchange") == 1
    large = join_roles(fact, dim, "id", roles, ["name"], 0)
    text = large._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD [id#") == 3  # the fact twice, the dimension once


def test_roles_that_ask_for_few_rows_of_a_large_dimension_are_broadcast(spark):
    """``seller`` has four keys of fifty, ``buyer`` has all: the first does not go through the exchange of the second."""
    fact = spark.createDataFrame([(i, f"P{i % 50}", f"P{i % 5}" if i % 4 else None) for i in range(200)], "id int, buyer string, seller string")
    dim = spark.createDataFrame([(f"P{i}", f"name {i}") for i in range(1, 50)], "party string, name string")
    both = join_roles(fact, dim, "party", {"seller": "seller", "buyer": "buyer"}, ["name"], 10)
    assert both.columns == [*fact.columns, "seller_name", "buyer_name"]
    name = {f"P{i}": f"name {i}" for i in range(1, 50)}
    assert Counter(map(tuple, both.collect())) == Counter((*r, name.get(r.seller), name.get(r.buyer)) for r in fact.collect())
    few = join_roles(fact, dim, "party", {"seller": "seller"}, ["name"], 10, asked=fact.select("seller"))
    text = few._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD [id#") == 2 and "strategy=broadcast" in text  # the rows, and the keys of the broadcast side
    assert Counter(map(tuple, few.collect())) == Counter((*r, name.get(r.seller)) for r in fact.collect())
    twice = join_roles(fact, dim.union(dim), "party", {"seller": "seller"}, ["name"], 10)
    assert Counter(map(tuple, twice.collect())) == Counter((*r, name.get(r.seller)) for r in fact.collect())


def test_roles_without_rows(spark):
    fact, dim = role_frames(spark)
    for rows in (0, 10):
        got = join_roles(fact, dim.limit(0), "id", {"buyer": "buyer"}, ["name"], rows)
        assert got.count() == 40 and got.filter("buyer_name is not null").count() == 0
        assert join_roles(fact.limit(0), dim, "id", {"buyer": "buyer"}, ["name"], rows).count() == 0


# ---- rules -----------------------------------------------------------------

ROWS = [("NY", 1, 5.0, "SALE"), ("S1", 91, 5.0, "SALE"), ("S1", 1, 0.0, "SALE"), ("S1", 1, 2.5, "SWAP"), (None, 1, 2.5, "SALE"),
        ("S1", 1, 2.5, "SALE"), ("S2", 2, 9.0, " ")]
RULES = [("x", "site", "ne", "NY"), ("x", "kind", "not_in", "91"), ("x", "kind", "not_in", "92"), ("x", "value", "ne", "0"),
         ("x", "name", "not_like", "SW%"), ("x", "name", "filled", None), ("y", "kind", "in", "91"), ("y", "kind", "in", "2"),
         ("z", "value", "ge", "5"), ("z", "value", "lt", "9"), ("z", "site", "eq", "NY")]


def test_rules_from_a_table(spark):
    df = spark.createDataFrame(ROWS, "site string, kind int, value double, name string")
    rules = rules_of(spark.createDataFrame(RULES, "branch string, column string, op string, value string"))
    assert sorted(rules) == sorted(Rule(*r) for r in RULES) or len(rules) == len(RULES)
    assert [tuple(r) for r in keep(df, rules, "x").collect()] == [ROWS[5]]
    assert {tuple(r) for r in keep(df, rules, "y").collect()} == {ROWS[1], ROWS[6]}
    assert [tuple(r) for r in keep(df, rules, "z").collect()] == [ROWS[0]]
    assert keep(df, rules, "none").count() == len(ROWS)
    with pytest.raises(ValueError, match="more than 3"):
        rules_of(spark.createDataFrame(RULES, "branch string, column string, op string, value string"), 3)
    with pytest.raises(ValueError, match="unknown"):
        predicate([Rule("x", "site", "near", "NY")], "x", df.schema)


def test_rules_reach_the_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, "site string, kind int, value double, name string").write.parquet(str(tmp_path / "t"))
    text = plan(keep(spark.read.parquet(str(tmp_path / "t")), [Rule(*r) for r in RULES], "x"))
    pushed = text[text.index("PushedFilters"):]
    for part in ("Not(EqualTo(site,NY))", "Not(In(kind, [91,92]))", "Not(EqualTo(value,0.0))"):
        assert part in pushed.replace("Not(In(kind, [91, 92]))", "Not(In(kind, [91,92]))"), (part, pushed[:400])


# ---- extracts --------------------------------------------------------------

def test_sales_rules_each_leave_out_a_line(spark, sf001):
    """Without any one of the exclusions more lines are taken, on the tables or,
    for the branches of today, on lines made for it."""
    lines = SA.sales_lines(spark, sf001)
    today = lines.filter("relation = 'orders' and l_shipdate >= '2001-01-01'").limit(1)
    made = None
    for name in ["SWAP", "STAFF SALE", "ORDER SALE", "WEB ORDER SALE", "RETURN"]:
        for site in ("S0", "S1"):
            row = today.withColumn("operation_name", F.lit(name)).withColumn("site", F.lit(site))
            made = row if made is None else made.unionByName(row)
    made = made.unionByName(today.withColumn("site", F.lit("NY"))).unionByName(
        today.withColumn("l_extendedprice", F.lit(0.0)).withColumn("site", F.lit("S1")))
    for price in (0.0,):
        made = made.unionByName(lines.filter("operation_name = 'SALE' and operation_type = 1 and site <> 'NY' and relation = 'settled'")
                                .limit(20).withColumn("l_extendedprice", F.lit(price)))
        made = made.unionByName(lines.filter("relation = 'orders' and l_shipdate < '2001-01-01' and operation_name = 'ADVANCE'")
                                .limit(5).withColumn("l_extendedprice", F.lit(price)))
    made = made.unionByName(lines.filter("relation = 'orders' and l_shipdate < '2001-01-01' and operation_name = 'ADVANCE'")
                            .limit(2).withColumn("site", F.lit("NY")))
    every = lines.unionByName(made).cache()
    rules = SA.sales_rules("2001-01-01")
    base = SA.with_branch(every, rules)
    taken = {r.branch: r["count"] for r in base.groupBy("branch").count().collect()}
    # a rule that another rule of its branch already implies (a list of allowed
    # operations) can't take out a line of its own
    implied = {(b, n) for b in "cde" for n in SA.NOT_SALES}
    for rule in rules:
        if rule.op in ("ne", "not_in") and rule.column != "barcode_no" and (rule.branch, rule.value) not in implied:
            without = every.filter(predicate([r for r in rules if r != rule], rule.branch, every.schema)).count()
            assert without > taken[rule.branch], rule
    every.unpersist()


def test_sales_rules_reach_the_scan(spark, sf001):
    text = plan(SA.with_branch(SA.sales_lines(spark, sf001), SA.sales_rules("2001-01-01")))
    pushed = text[text.index("PushedFilters"):]
    assert "relation" in pushed and "operation_name" in pushed and "l_extendedprice" in pushed


def test_sales_roles_of_house_accounts(spark, sf001):
    fact = SA.sales_fact(spark, sf001)
    house = fact.filter("customer_id not like 'C%'")
    kinds = {r[0] for r in house.select(F.substring("customer_id", 1, 1)).distinct().collect()}
    assert kinds == {"S", "N"}
    parties = {r.party_id: r.name for r in B.parties(spark, sf001).collect()}
    for r in house.select("customer_id", "customer_name").distinct().collect():
        assert parties[r.customer_id] == r.customer_name


def test_sales_as_of_moves_lines_between_open_and_today(spark, sf001):
    early = {r.operation for r in SA.sales_fact(spark, sf001, as_of="1990-01-01").select("operation").distinct().collect()}
    assert "OPEN_ORDER" not in early and "TODAY_STORE" in early


@pytest.fixture(scope="module")
def odd_tables(spark, sf001, tmp_path_factory):
    """The tables with stock of raw materials."""
    d = tmp_path_factory.mktemp("raw")
    for name in ("part", "supplier", "lineitem", "orders", "nation", "customer", "documents"):
        df = spark.read.parquet(f"{sf001}/{name}.parquet")
        if name == "lineitem":
            df = df.unionByName(df.filter("l_suppkey > 0").limit(50).withColumn("l_partkey", -F.col("l_suppkey")))
        df.write.parquet(str(d / f"{name}.parquet"))
    return str(d)


def test_finished_goods_only(spark, sf001, odd_tables):
    everything = B.erp_items(spark, sf001)
    assert everything.filter("goods_group <> 'PA'").count() == spark.read.parquet(f"{sf001}/supplier.parquet").count()
    assert {r[0] for r in everything.select("goods_group").distinct().collect()} >= {"PA", "MP"}
    for extract in (C.item_master, C.item_export_full, C.item_texts, C.item_seo, C.price_list, S.stock_by_site, S.erp_stock,
                    S.inactive_with_stock, S.orderable_sizes, C.shop_stock):
        df = extract(spark, odd_tables)
        assert df.filter("code like 'MP%'").count() == 0, extract
        assert df.count() == extract(spark, sf001).count(), extract


def test_item_dimensions(spark, sf001):
    master = C.item_master(spark, sf001)
    assert len(master.columns) == 17
    assert master.filter("colour_desc is null").count() and master.filter("subgroup_desc is null").count()
    full = C.item_export_full(spark, sf001)
    assert 0 < full.count() < master.count() and full.filter("colour_desc is null or subgroup_desc is null").count() == 0
    texts = C.item_texts(spark, sf001).filter("description_text is not null and description_text_2 is not null")
    assert texts.filter("description_text <> description_text_2").count()


def test_erp_price_is_whole_and_above_one(spark):
    from stockline.plans import prices as P
    items = spark.createDataFrame([("A", 10.9), ("B", 1.0), ("C", 0.5), ("", 7.0), ("D", 1.5)], "code string, price double")
    assert {tuple(r) for r in P.erp_prices(items).collect()} == {("A", 10.0), ("D", 1.0)}


# ---- arms that the given tables do not reach ---------------------------------

@pytest.fixture(scope="module")
def sparse_tables(spark, sf001, tmp_path_factory):
    """The tables with items without stock lines and lines without quantity."""
    d = tmp_path_factory.mktemp("sparse")
    for name in ("part", "supplier", "lineitem", "orders", "nation", "customer", "documents"):
        df = spark.read.parquet(f"{sf001}/{name}.parquet")
        if name == "lineitem":
            df = df.filter("l_partkey % 7 <> 0").withColumn(
                "l_quantity", F.when(F.col("l_partkey") % 5 == 0, F.lit(0.0)).otherwise(F.col("l_quantity")))
        df.write.parquet(str(d / f"{name}.parquet"))
    return str(d)


def test_arms_of_items_without_stock(spark, sparse_tables):
    assert C.items_inactive(spark, sparse_tables).count() > 0
    assert {r[0] for r in C.item_master(spark, sparse_tables).select("final_status").distinct().collect()} == {"ATIVO", "INATIVO"}
    stock = S.stock_by_site(spark, sparse_tables)
    assert {r[0] for r in stock.select("unlimited_quantity").distinct().collect()} == {True, False}
    assert stock.filter("unlimited_quantity AND total_quantity > 0").count() == 0
    assert S.stock_by_site(spark, sparse_tables, literal_unlimited=True).filter("unlimited_quantity").count() == 0
    split = S.variant_stock_split(B.channel_levels(spark, sparse_tables))
    assert {r[0] for r in split.select("zero_stock").distinct().collect()} == {True, False}


def test_sorted_sales_fact(spark, sf001):
    """The reference's order, newest first."""
    dates = [r[0] for r in SA.sales_fact(spark, sf001, sort=True).select("sale_date").collect()]
    assert dates == sorted(dates, reverse=True) and len(set(dates)) > 10


def test_ring_prices_evaluate_the_changes_once(spark, sf001):
    from stockline.plans import prices as P
    df = P.ring_price_feed(B.channel_variants(spark, sf001), B.items(spark, sf001), B.channel_levels(spark, sf001))
    assert plan(df).count("p_retailprice") and plan(df).split("== Initial Plan ==")[0].count("/part.parquet") == 1
