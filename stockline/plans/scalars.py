"""Scalar-function queries over the item and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean_text, collapse_ws, concat_blank, split_part, title_case, two_decimals, zero_pad
from ..sources import read_table
from . import bindings as B


def scalar_strings(spark: SparkSession, d: str) -> DataFrame:
    """X1–X8, X23, X26 on part names."""
    p = read_table(spark, d, "part")
    k = F.col("p_partkey")
    name = F.col("p_name")
    maybe_null = F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand"))
    return p.select(
        k.alias("item_key"),
        F.rtrim(F.concat(name, F.lit("   "))).alias("rtrimmed"),
        F.trim(F.concat(F.lit("  "), name, F.lit("  "))).alias("trimmed"),
        collapse_ws(F.replace(name, F.lit(" "), F.lit("   "))).alias("collapsed"),
        concat_blank(name, F.lit("/"), maybe_null).alias("concat_blank"),
        F.concat(name, F.lit("/"), maybe_null).alias("concat_plus"),
        F.replace(name, F.lit("rod"), F.lit("bar")).alias("replaced"),
        F.regexp_replace(name, "(?i)RING", "band").alias("replaced_ci"),
        split_part(name, " ", 0).alias("word1"), split_part(name, " ", 2).alias("word3"),
        F.size(F.split(name, " ")).cast("bigint").alias("n_words"),
        F.upper(name).alias("upper"), title_case(F.concat(name, F.lit(" d'agua-x2"))).alias("title"),
        F.length(name).cast("bigint").alias("length"),
        F.when(name.contains("gear"), "GEAR").otherwise("").alias("keyword"),
        clean_text(F.when(k % 5 == 0, F.lit(" nan ")).when(k % 5 == 1, F.lit(None)).otherwise(name)).alias("cleaned"),
    )


def scalar_bands(spark: SparkSession, d: str) -> DataFrame:
    """Lookup map, price band, precedence status, flag text, floor."""
    from .catalog import PRICE_BANDS, TAXONOMY, TAXONOMY_DEFAULT, shop_stock
    from ..functions import case_map, floor_zero, price_band
    it = B.items(spark, d).join(shop_stock(spark, d), "code", "left")
    adj = F.col("stock_qty") - F.lit(100)
    return it.select(
        "code", case_map(F.col("group_name"), TAXONOMY, TAXONOMY_DEFAULT).alias("taxonomy_code"),
        price_band(F.col("price"), F.col("metal"), PRICE_BANDS).alias("price_band"),
        F.when(F.col("orderable") | (adj > 0), "ATIVO").otherwise("INATIVO").alias("final_status"),
        F.when(F.col("active"), "Ativo").otherwise("Inativo").alias("status_text"),
        floor_zero(adj).cast("bigint").alias("stock_floor"))


def scalar_casts(spark: SparkSession, d: str, as_of: str = "2001-01-01") -> DataFrame:
    """IIF / ISNULL / coalesce date, nested CASE, signed
    amount, casts, date text, arithmetic, safe ratio, two-decimal text."""
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    maybe_date = F.when(k % 3 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("o_orderdate"))
    return o.select(
        k.alias("order_key"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("iif"),
        F.coalesce(F.when(k % 2 == 0, price), F.lit(0.0)).alias("isnull_price"),
        F.coalesce(F.to_date(maybe_date), F.lit(as_of).cast("date")).alias("date_or_asof"),
        F.when(F.col("o_custkey") % 50 == 0,
               F.when(F.col("o_orderstatus") == "F", "origin").otherwise("destination"))
        .otherwise("customer").alias("party"),
        F.when(F.col("o_orderstatus") == "F", price).otherwise(-price).alias("signed"),
        price.cast("decimal(15,2)").cast("decimal(10,0)").cast("bigint").alias("price_dec0"),
        zero_pad(k, 8).alias("char8"),
        F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("date_text"),
        (F.to_date("o_orderdate") < F.lit(as_of).cast("date")).alias("before_as_of"),
        F.round(price.cast("decimal(15,2)") * F.lit(0.9).cast("decimal(15,2)"), 2).cast("double").alias("discounted"),
        F.round(F.try_divide(price, (k % 4).cast("double")), 4).alias("ratio"),
        two_decimals(price.cast("decimal(15,2)")).alias("price_text"),
    )
