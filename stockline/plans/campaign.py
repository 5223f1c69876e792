"""Campaigns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import two_decimals
from ..operators import first_per_key
from ..sources import read_table
from . import bindings as B

# ---- fixed values of the binding ------------------------------------------
MEMBER_LISTS = [["Brand#1"], ["Brand#2"], ["Brand#3"], ["Brand#4"], ["Brand#5"]]
EXCLUDED_PRODUCT_MOD = 13
CAMPAIGN_RULES = [("Brand#1", 20, "Sim"), ("Brand#2", 30, "Nao"), ("Brand#3", 50, "Sim")]
DEFAULT_RATE = 10
EXCLUDED_TITLE_WORD = "anvil"
TARGET_RATIO = 5
# ---------------------------------------------------------------------------


def _product_id(key) -> F.Column:
    return F.concat(F.lit("prod-"), key.cast("string"))


def campaign_members(spark: SparkSession, d: str) -> DataFrame:
    """Campaign membership (C4, U2, F5): union of the member lists of five
    collections, distinct by product, minus an exclusion list."""
    it = B.items(spark, d)
    # the lists are selections of one table: one scan with all of them
    u = (it.filter(F.col("model").isin([m for models in MEMBER_LISTS for m in models]))
         .select(_product_id(F.col("item_key")).alias("product_id")))
    excl = it.filter(F.col("item_key") % EXCLUDED_PRODUCT_MOD == 0).select(_product_id(F.col("item_key")).alias("product_id"))
    return u.distinct().join(excl, "product_id", "left_anti")


def campaign_candidates(members: DataFrame, variants: DataFrame) -> DataFrame:
    """Variants of member products, first per product by sku."""
    v = variants.join(members, "product_id", "left_semi")
    return first_per_key(v, ["product_id"], ["sku"])


def item_stock_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Inventory and variant count per item from all its lines (binding of
    totalInventory / totalVariants): five units a variant where
    key % 5 = 0, none where key % 11 = 0, else the lines' quantity."""
    li = read_table(spark, d, "lineitem")
    k, n = F.col("item_key"), F.col("total_variants")
    return (li.groupBy(F.col("l_partkey").alias("item_key"))
            .agg(F.sum("l_quantity").cast("bigint").alias("_qty"), F.count(F.lit(1)).alias("total_variants"))
            .select("item_key", F.when(k % 11 == 0, F.lit(0)).when(k % 5 == 0, n * TARGET_RATIO)
                    .otherwise(F.col("_qty")).cast("bigint").alias("total_inventory"), "total_variants"))


def _ratio_five(ratio: F.Column) -> F.Column:
    # a NULL ratio (no variants) counts as "not 5" (T10)
    return F.coalesce(ratio == TARGET_RATIO, F.lit(False))


def campaign_split(stats: DataFrame) -> DataFrame:
    """Ratio split (C6): inventory 0 dropped; inventory / variants ≠ 5 →
    tagged, = 5 → untagged. ``try_divide`` keeps a zero count from
    raising under ANSI."""
    s = stats.filter(F.col("total_inventory") != 0)
    ratio = F.try_divide(F.col("total_inventory").cast("double"), F.col("total_variants").cast("double"))
    return s.select("item_key", "total_inventory", "total_variants", F.round(ratio, 4).alias("ratio"),
                    (~_ratio_five(ratio)).alias("tagged"))


def badge_removal(stats: DataFrame, items: DataFrame) -> DataFrame:
    """Badge removal set (C9): items not orderable all go; orderable items
    go when their ratio is 5 or their inventory is 0."""
    j = stats.join(items.select("item_key", "orderable"), "item_key", "inner")
    ratio = F.try_divide(F.col("total_inventory").cast("double"), F.col("total_variants").cast("double"))
    reason = (F.when(~F.col("orderable"), "not orderable").when(F.col("total_inventory") == 0, "no stock")
              .when(_ratio_five(ratio), "ratio"))
    return j.select("item_key", "orderable", reason.alias("reason")).filter(F.col("reason").isNotNull())


def campaign_rules(items: DataFrame) -> DataFrame:
    """The rule table of the campaign (binding): sku_2, rate and on_order of
    every item of the models in ``CAMPAIGN_RULES``."""
    listed = [F.when(F.col("model") == m, F.struct(F.lit(r).alias("rate"), F.lit(o).alias("on_order"))) for m, r, o in CAMPAIGN_RULES]
    return (items.filter(F.col("model").isin([m for m, _, _ in CAMPAIGN_RULES]))
            .select(F.col("code").alias("sku_2"), F.coalesce(*listed).alias("r")).select("sku_2", "r.rate", "r.on_order"))


def campaign_price(spark: SparkSession, candidates: DataFrame, items: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Campaign pricing (C8): a title keyword excludes; skus in the rule table
    get their rate, others the default 10 % off the list price. The rule table
    may be as long as the item list, so it is joined by key without a hint."""
    rules = campaign_rules(items) if rules is None else rules
    c = candidates.join(items.select(F.col("code").alias("sku_2"), "description"), "sku_2", "inner")
    c = c.filter(~F.coalesce(F.col("description").contains(EXCLUDED_TITLE_WORD), F.lit(False)))
    j = c.join(rules, "sku_2", "left")
    rate = F.coalesce(F.col("rate"), F.lit(DEFAULT_RATE)).cast("bigint")
    # the rule prices off the list price only; a missing list price stays missing
    lst = F.col("compare_at_price")
    # exact decimal: list × (100 − rate) × 0.01, rounded half-up to cents
    factor = (F.lit(100) - rate).cast("decimal(5,0)") * F.lit(0.01).cast("decimal(3,2)")
    price = F.round(lst.cast("decimal(18,2)") * factor, 2).cast("double")
    return j.select("sku", "variant_id", "product_id", lst.alias("list_price"), rate.alias("rate"),
                    F.coalesce(F.col("on_order"), F.lit("Nao")).alias("on_order"), price.alias("campaign_price"))


def feed_campaign_price(prices: DataFrame) -> DataFrame:
    """Campaign price and restore payloads (P4), one row per mode, from one
    pass over the prices."""
    p = prices.filter(F.col("list_price").isNotNull())
    modes = F.explode(F.array(F.struct(F.lit("apply").alias("mode"), two_decimals(F.col("campaign_price")).alias("price")),
                              F.struct(F.lit("restore").alias("mode"), two_decimals(F.col("list_price")).alias("price"))))
    p = p.select("variant_id", modes.alias("m")).select("variant_id", "m.mode", "m.price")
    return p.select("variant_id", "mode", F.to_json(F.struct(
        F.struct(F.col("variant_id").alias("id"), "price").alias("input"))).alias("payload"))


def metafield_cleanup(metafields: DataFrame) -> DataFrame:
    """Metafields to delete (C10): blank ids dropped, first per id."""
    m = metafields.filter(F.col("metafield_id").isNotNull() & (F.col("metafield_id") != ""))
    return first_per_key(m.select("metafield_id", "product_id", "key"), ["metafield_id"], ["product_id"])


TEMPLATE_SUFFIX = "product-custom"
BADGE = "Entregamos antes do Natal"
TAG = "Ouro_Branco_Diamantes"
LINE_TEXT, LIST_TEXT = "single_line_text_field", "list.single_line_text_field"
#: Keys whose payload is an update of the product that owns the field.
OWNER_UPDATES = ["badges", "sale", "categoria"]


def _flag(owner: F.Column, key: str, kind: str, value: F.Column) -> F.Column:
    return F.struct(owner.alias("owner_id"), F.lit("custom").alias("namespace"), F.lit(key).alias("key"), F.lit(kind).alias("type"),
                    value.cast("string").alias("value"))


def _flags(df: DataFrame, *flags: F.Column) -> DataFrame:
    """The flags of every row of ``df``, in one pass over it."""
    return df.select(F.explode(F.array(*flags)).alias("f")).select("f.*")


def _truth(c: str) -> F.Column:
    return F.when(F.col(c), "true").otherwise("false")


def feed_flags(orderable: DataFrame, in_stock: DataFrame, ready: DataFrame, items: DataFrame,
               badges: DataFrame | None = None, metafields: DataFrame | None = None,
               tagged: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """One parametrised flag feed (P6–P8): (owner, namespace, key, type,
    value) rows for orderable, in-stock and ready-to-ship flags and the sale
    flag of products that join (``members``) or leave a campaign (P6), badges
    set (``tagged``) and cleared and metafields deleted (P7), composition,
    metal, template, category and tags (P8), each with its payload."""
    variant, product = F.col("variant_id"), _product_id(F.col("item_key"))
    parts = [
        _flags(orderable, _flag(variant, "orderable", "boolean", _truth("is_orderable"))),
        _flags(in_stock, _flag(variant, "in_stock", "boolean", _truth("in_stock"))),
        _flags(ready, _flag(F.col("product_id"), "ready_to_ship", "boolean", F.lit("true"))),
        _flags(items, _flag(product, "composition", LINE_TEXT, F.col("type")),
               _flag(product, "metal", LINE_TEXT, F.initcap("metal")),
               _flag(product, "template_suffix", LINE_TEXT, F.lit(TEMPLATE_SUFFIX)),
               _flag(product, "categoria", LINE_TEXT, F.col("group_name")), _flag(product, "tags", "tags", F.lit(TAG))),
    ]
    if badges is not None:
        parts.append(_flags(badges, _flag(product, "badges", LIST_TEXT, F.lit('[""]'))))
    if tagged is not None:
        parts.append(_flags(tagged, _flag(product, "badges", LIST_TEXT, F.lit(f'["{BADGE}"]'))))
    if members is not None:
        parts.append(_flags(members, _flag(F.col("product_id"), "sale", "boolean", _truth("joins"))))
    if metafields is not None:
        parts.append(_flags(metafields, _flag(F.col("metafield_id"), "metafield_delete", "delete", F.col("product_id"))))
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    field = F.struct("namespace", "key", "type", "value")
    payload = (F.when(F.col("key").isin(OWNER_UPDATES), F.to_json(F.struct(F.struct(
        F.array(field).alias("metafields"), F.col("owner_id").alias("id")).alias("input"))))
        .when(F.col("key") == "tags", F.to_json(F.struct(F.struct(F.col("owner_id").alias("id"), F.col("value").alias("tags")).alias("input"))))
        .otherwise(F.to_json(F.struct(F.col("owner_id").alias("ownerId"), "namespace", "key", "type", "value"))))
    return u.withColumn("payload", payload)


def sale_changes(members: DataFrame, stats: DataFrame) -> DataFrame:
    """Products of which the sale flag is set (campaign members) or removed
    (products with stock statistics that are no members)."""
    products = stats.select(_product_id(F.col("item_key")).alias("product_id")).distinct()
    joins = members.select("product_id").distinct()
    leaves = products.join(joins, "product_id", "left_anti")
    return joins.withColumn("joins", F.lit(True)).unionByName(leaves.withColumn("joins", F.lit(False)))


def feed_metafield_lookup(badges: DataFrame) -> DataFrame:
    """Lookups of the metafields that a clean-up needs the id of."""
    keys = F.explode(F.array(F.lit("badges"), F.lit("sale")))
    p = badges.select(_product_id(F.col("item_key")).alias("product_id"), keys.alias("key"))
    return p.select("product_id", "key", F.to_json(F.struct(
        F.col("product_id").alias("id"), "key", F.lit("custom").alias("name"))).alias("payload"))
