"""Availability flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import first_per_key
from . import bindings as B


def flag_orderable(levels: DataFrame, gold_location: str = B.ORDERABLE_LOCATION["GOLD"][1],
                   silver_location: str = B.ORDERABLE_LOCATION["SILVER"][1],
                   location_ids=(B.ORDERABLE_LOCATION["GOLD"][0], B.ORDERABLE_LOCATION["SILVER"][0])) -> DataFrame:
    """Orderable flag per variant (R10, A6): conditional sums of the two
    made-to-order locations; true when their total is positive. NULL
    keys are dropped before grouping (T5)."""
    lv = levels.filter(F.col("variant_sku").isNotNull() & (F.col("variant_sku") != "")
                       & F.col("location_id").isin(list(location_ids)))
    lv = lv.dropna(subset=["variant_sku", "variant_id"])
    g = lv.groupBy("variant_sku", "variant_id").agg(
        F.sum(F.when(F.col("location_name") == gold_location, F.col("qty")).otherwise(0)).cast("bigint").alias("orderable_gold"),
        F.sum(F.when(F.col("location_name") == silver_location, F.col("qty")).otherwise(0)).cast("bigint").alias("orderable_silver"))
    return g.withColumn("is_orderable", (F.col("orderable_gold") + F.col("orderable_silver")) > 0)


def flag_in_stock(variants: DataFrame, orderable: DataFrame, made_to_order_qty: int = B.ORDERABLE_QTY) -> DataFrame:
    """In-stock flag (R11): false when not orderable with no stock, or
    orderable with exactly the made-to-order quantity; variants without
    an orderable row are dropped (so the join is inner)."""
    j = variants.join(orderable.select("variant_id", "is_orderable"), "variant_id", "inner")
    q = F.col("inventory_quantity")
    off = ((~F.col("is_orderable")) & (q == 0)) | (F.col("is_orderable") & (q == made_to_order_qty))
    return j.select("variant_id", "sku", "product_id", "inventory_quantity", "is_orderable",
                    F.when(off, False).otherwise(True).alias("in_stock"))


def ready_list(erp_codes: DataFrame, variants: DataFrame) -> DataFrame:
    """Ready-to-ship list (R12): distinct ERP codes ⋈ first variant per base
    code, then first per product."""
    codes = erp_codes.select("code").distinct()
    first = first_per_key(variants.select("sku_2", "sku", "product_id"), ["sku_2"], ["sku"])
    j = codes.join(first, codes.code == first.sku_2, "inner").select("code", "sku_2", "product_id")
    return first_per_key(j, ["product_id"], ["code"])
