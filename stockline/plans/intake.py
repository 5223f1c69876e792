"""Intake, customers and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import phone_digits, split_part, title_case, zero_pad
from ..sources import read_table
from ..functions import case_map
from . import bindings as B
from .catalog import TAXONOMY, TAXONOMY_DEFAULT

# ---- fixed values of the binding ------------------------------------------
ACTIVATION_LOCATIONS = ["loc-1001", "loc-1002", "loc-1003", "loc-2001", "loc-2002"]  # main loc-1000 not listed
SALES_CHANNELS = ["online-store", "point-of-sale", "shop-app", "marketplace", "social"]
SHORT_PHONE_MAX = 13
CUSTOMER_CLASSES = ("no_phone_no_address", "no_phone", "no_address", "complete")
# names that keep their own casing: (as title case gives it, as it is written)
BRAND_CASING = [("Large Gear", "LARGE GEAR"), ("Old Anvil", "OLD ANVIL")]
LISTED_SIZES = ["S", "M", "L"]
COUNTRY = "BR"
# ---------------------------------------------------------------------------


def customers(spark: SparkSession, d: str) -> DataFrame:
    """Customer intake (binding): address missing for nation % 5 = 0; phone
    missing for key % 4 = 0, short ('119' + key) for 1, else a full number,
    both as spreadsheet floats ('….0')."""
    c = read_table(spark, d, "customer")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    phone = (F.when(k % 4 == 0, F.lit(None).cast("string"))
             .when(k % 4 == 1, F.concat(F.lit("119"), k.cast("string"), F.lit(".0")))
             .otherwise(F.concat((F.lit(5511900000000) + k).cast("string"), F.lit(".0"))))
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(k.alias("cust_key"), "c_name", phone.alias("phone_raw"),
                    F.when(F.col("c_nationkey") % 5 == 0, F.lit(None).cast("string"))
                    .otherwise(F.concat(F.lit("Street "), k.cast("string"))).alias("address"),
                    F.col("n_name").alias("city"), F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("province_code"),
                    F.lit(COUNTRY).alias("country_code"), zero_pad(k, 8).alias("zip"))


def customer_class(cust: DataFrame) -> DataFrame:
    """Customer preparation (C16, X7–X9): '+digits' phone, title-cased
    names, phone length and the four-way class; a phone of 1–13
    characters counts as none."""
    phone = phone_digits(F.col("phone_raw"))
    plen = F.coalesce(F.length(phone), F.lit(0))
    has_phone = plen > SHORT_PHONE_MAX
    has_addr = F.col("address").isNotNull()
    cls = (F.when(~has_phone & ~has_addr, CUSTOMER_CLASSES[0]).when(~has_phone, CUSTOMER_CLASSES[1])
           .when(~has_addr, CUSTOMER_CLASSES[2]).otherwise(CUSTOMER_CLASSES[3]))
    first = title_case(split_part(F.col("c_name"), "#", 0))
    return cust.select(
        F.concat(F.lit("C"), F.col("cust_key").cast("string")).alias("customer_id"),
        first.alias("first_name"), title_case(split_part(F.col("c_name"), "#", 1)).alias("last_name"),
        F.concat(F.lower(first), F.col("cust_key").cast("string"), F.lit("@example.com")).alias("email"),
        phone.alias("phone"), plen.cast("bigint").alias("phone_len"), "address",
        title_case(F.col("city")).alias("city"), "province_code", "country_code", "zip", cls.alias("class"))


def intake(spark: SparkSession, d: str) -> DataFrame:
    """New-product intake rows (binding): every item."""
    return B.items(spark, d)


def own_casing(x: F.Column) -> F.Column:
    """Title-cased text with the names of ``BRAND_CASING`` as they are written."""
    for found, written in BRAND_CASING:
        x = F.regexp_replace(x, f"(?i){found}", written)
    return x


def intake_prepare(spark: SparkSession, d: str) -> DataFrame:
    """Intake preparation (C14): eight columns in title case, brand names in
    their own casing, collection joined by title, stone list split and counted.
   """
    it = intake(spark, d)
    coll = B.collections(spark, d).select(F.col("model").alias("collection_title"),
                                           F.concat(F.lit("col-"), F.split("model", "#").getItem(1)).alias("collection_id"))
    k = F.col("item_key")
    stones_txt = (F.when(k % 3 == 0, F.lit(None).cast("string")).when(k % 3 == 1, F.lit("ruby"))
                  .when(k % 20 < 10, F.lit("ruby e pearl")).otherwise(F.lit("ruby e pearl e onyx")))
    j = it.join(coll, title_case(it.model) == coll.collection_title, "left")
    stones = F.split(title_case(stones_txt), " E ")
    plain = ~F.col("family").isin(B.SIZED_FAMILIES)
    handle = F.concat(F.replace(F.col("description"), F.lit(" "), F.lit("-")), F.lit("-"), F.col("code"))
    listed = F.when(k % 13 < 2, (F.lit(2) + k % 13).cast("int")).otherwise(0)
    return j.select("code", own_casing(title_case(F.col("description"))).alias("title"),
                    own_casing(title_case(F.col("model"))).alias("collection"), "collection_id",
                    title_case(F.col("group_name")).alias("category"), title_case(F.col("type")).alias("product_type"),
                    F.to_json(F.coalesce(stones, F.array().cast("array<string>"))).alias("stones"),
                    F.coalesce(F.size(stones), F.lit(0)).cast("bigint").alias("stone_count"),
                    title_case(F.when(k % 5 == 0, "gold bath").otherwise("none")).alias("coating"),
                    title_case(F.col("metal")).alias("metal_title"), title_case(handle).alias("handle"),
                    case_map(F.col("group_name"), TAXONOMY, TAXONOMY_DEFAULT).alias("category_id"),
                    F.concat(F.lit("<p>"), F.col("description"), F.lit("</p>")).alias("description_html"),
                    F.col("price").cast("bigint").cast("string").alias("price_text"),
                    F.when(plain & (k % 11 == 5), F.col("size").cast("string")).otherwise("").alias("size_label"),
                    listed.alias("n_listed"), "family", "item_key")


def intake_new(spark: SparkSession, d: str) -> DataFrame:
    """To-create set (C15): intake ∖ codes already in the store ∖ inactive."""
    prep = intake_prepare(spark, d)
    v = B.store_index(spark, d).select("sku_2", "in_products").distinct()
    inactive = B.items(spark, d).filter(~F.col("active")).select("code")
    return (prep.join(v, (F.col("code") == F.col("sku_2")) & F.col("in_products"), "left_anti")
            .join(inactive, "code", "left_anti"))


def activation_plan(variants: DataFrame, locations=ACTIVATION_LOCATIONS) -> DataFrame:
    """Inventory item × activation locations (C12). The fixed list is an
    array literal exploded per row: a bounded fan-out, no join."""
    arr = F.array(*[F.lit(x) for x in locations])
    return variants.select(F.concat(F.lit("inv-"), F.col("sku")).alias("inventory_item_id"), "sku",
                           F.explode(arr).alias("location_id"))


def publication_plan(variants: DataFrame, channels=SALES_CHANNELS) -> DataFrame:
    """Product × sales channels."""
    p = variants.select("product_id").distinct()
    return p.select("product_id", F.explode(F.array(*[F.lit(x) for x in channels])).alias("channel"))
