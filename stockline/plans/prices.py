"""Price reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import two_decimals
from ..operators import first_per_key, union_priority
from . import bindings as B

RING_PREFIXES = ["AN", "AL"]


def price_sides(variants: DataFrame) -> DataFrame:
    """Store side of the price comparison (F1): subset and rename, base
    code as ``sku``; rows without a product id are dropped."""
    v = variants.filter(F.col("product_id").isNotNull() & (F.col("product_id") != ""))
    return v.select(F.col("sku_2").alias("sku"), "variant_id", "product_id", "price", "compare_at_price")


def erp_prices(items: DataFrame) -> DataFrame:
    """ERP side: the price as the item extract has it, a whole number above 1."""
    whole = F.col("price").cast("bigint").cast("double")
    return (items.filter((F.col("code") != "") & (F.col("price") > 1))
            .select(F.col("code").alias("sku"), whole.alias("erp_price")))


def price_delta(variants: DataFrame, items: DataFrame) -> DataFrame:
    """Price delta (R6, T14): store ⟕ ERP on base code; delta = round(erp −
    store, 2); kept when non-zero or the store price is missing, and only
    when the ERP has a price."""
    j = price_sides(variants).join(erp_prices(items), "sku", "left")
    delta = F.round(F.col("erp_price") - F.col("price"), 2)
    out = j.select("sku", "variant_id", "product_id", "price", "erp_price", delta.alias("delta"))
    return out.filter(((F.col("delta") != 0) | F.col("price").isNull()) & F.col("erp_price").isNotNull())


def compare_price_delta(variants: DataFrame, items: DataFrame) -> DataFrame:
    """List-price replacement (R7): rows whose list price differs from the
    ERP price (a missing list price counts as different); the new list
    price is the ERP price; zero deltas are kept."""
    j = price_sides(variants).join(erp_prices(items), "sku", "left")
    j = j.filter(F.col("erp_price").isNotNull()
                 & (F.col("compare_at_price").isNull() | (F.col("compare_at_price") != F.col("erp_price"))))
    return j.select("sku", "variant_id", "product_id", F.col("erp_price").alias("compare_at_price"), "erp_price",
                    F.round(F.col("erp_price") - F.col("price"), 2).alias("delta"))


def is_ring(sku) -> F.Column:
    """Sized family by prefix (F6): substring test, no regex needed."""
    return F.substring(sku, 1, 2).isin(RING_PREFIXES)


def split_ring_items(variants: DataFrame) -> DataFrame:
    """Ring / non-ring split (F6) shown with the three predicate forms the
    reference uses: prefix set, regex alternation and LIKE."""
    return variants.select("sku", is_ring(F.col("sku")).alias("is_ring"),
                           F.col("sku").rlike("^(AN|AL)").alias("is_ring_rx"),
                           (F.col("sku").like("AN%") | F.col("sku").like("AL%")).alias("is_ring_like"))


def first_per_base(variants: DataFrame) -> DataFrame:
    """One variant per base code (A11, N3, product_Sku): the smallest sku."""
    return first_per_key(variants, ["sku_2"], ["sku"])


def ring_price_feed(variants: DataFrame, items: DataFrame, levels: DataFrame, by: str = "base") -> DataFrame:
    """Price change per sized variant (R8). Ring rows of R6 are reduced to
    one per base code (``by="base"``) or per product (``by="product"``,
    the reference's second form), then fanned out to every store variant of
    that base / product (from the levels, first per sku); non-ring rows pass
    through; union with priority to the fan-out, first per sku (U3).
    Reducing before the fan-out keeps it one row per variant instead of all
    pairs within a product."""
    ring = is_ring(F.col("sku"))
    key = {"base": "sku", "product": "product_id"}[by]
    # one evaluation of the price changes, routed by a column: rings are reduced
    # to one row per key and fan out below, other rows pass through the join
    changes = price_delta(variants, items).withColumn("_ring", ring)
    route = F.when(F.col("_ring"), F.col(key)).otherwise(F.col("sku"))
    changes = first_per_key(changes.withColumn("_route", route), ["_ring", "_route"], ["variant_id"])
    inv = first_per_key(levels.filter(F.col("variant_sku").isNotNull() & is_ring(F.col("variant_sku")))
                        .select("variant_sku", "variant_id", "level_id"), ["variant_sku"], ["level_id"])
    if by == "base":
        inv = inv.withColumn("_key", F.substring_index("variant_sku", "-", 1))
    else:
        # the levels carry no product id; take it from the store variants
        inv = inv.join(variants.select("variant_id", F.col("product_id").alias("_key")), "variant_id", "inner")
    inv = inv.select("_key", "variant_sku", F.col("variant_id").alias("_variant"))
    fan = changes.join(inv, F.col("_ring") & (F.col("_route") == F.col("_key")), "left")
    fan = fan.filter(~F.col("_ring") | F.col("variant_sku").isNotNull())
    out = fan.select(F.coalesce("variant_sku", "sku").alias("sku"), F.coalesce("_variant", "variant_id").alias("variant_id"),
                     "product_id", "price", "erp_price", "delta", (~F.col("_ring")).alias("_late"))
    return first_per_key(out, ["sku"], ["_late", "variant_id"]).drop("_late")


def price_change_priority(variants: DataFrame, items: DataFrame) -> DataFrame:
    """Union with priority (U3): per variant, a price change wins over a
    list-price change."""
    a = price_delta(variants, items).select("variant_id", "sku", "erp_price", F.lit("price").alias("change"))
    b = compare_price_delta(variants, items).select("variant_id", "sku", "erp_price",
                                                    F.lit("compare_at_price").alias("change"))
    return union_priority([a, b], ["variant_id"])


def feed_price(changes: DataFrame) -> DataFrame:
    """Variant price payload (P3): price as fixed two-decimal text."""
    variant = F.struct(F.col("variant_id").alias("id"), two_decimals(F.col("erp_price")).alias("price"))
    payload = F.to_json(F.struct(F.col("product_id").alias("productId"), F.array(variant).alias("variants")))
    return changes.select("sku", "variant_id", payload.alias("payload"))


def price_views(spark: SparkSession, d: str):
    return B.channel_variants(spark, d), B.items(spark, d)
