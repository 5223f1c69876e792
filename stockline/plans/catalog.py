"""Item extracts.

The four item queries of the reference repeat the same sellable-stock
sub-query as text; here it is one function (``shop_stock``) that every
item plan joins, aggregated on ``code`` before the join so the join
input is one row per item whatever the skew of the stock lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import case_map, floor_zero, price_band, title_case
from ..sources import read_table
from . import bindings as B

# ---- fixed values: output labels and bands that must equal the reference --
PRICE_BANDS = {
    "GOLD": [(5000, "08. Ate 5.000"), (10000, "07. De 5.000 a 10.000"), (20000, "06. De 10.000 a 20.000"),
             (50000, "05. De 20.000 a 50.000"), (100000, "04. De 50.000 a 100.000"),
             (200000, "03. De 100.000 a 200.000"), (500000, "02. De 200.000 a 500.000"),
             (None, "01. Acima de 500.000")],
    "SILVER": [(2000, "03. Ate 2.000"), (4000, "02. De 2.000 a 4.000"), (None, "01. De 4.000 a 9.000")],
}
YES, NO = "Sim", "Nao"
ACTIVE_TXT, INACTIVE_TXT = "Ativo", "Inativo"
FINAL_ACTIVE, FINAL_INACTIVE = "ATIVO", "INATIVO"
COLLECTION_WORD = "COLLECTION"
# ---- fixed values of the binding ------------------------------------------
TAXONOMY = {"RING": "340", "BAND": "342", "LARGE": "339", "SMALL": "337", "PROMO": "336"}
TAXONOMY_DEFAULT = "331"
KEYWORD = "gear"
PHOTO_BASE_URL = "https://photos.example/items/"
# Documents that far apart are an item's texts in two languages.
SECOND_TEXT = 100
ACTIVE_EXCLUDED_MODELS = [f"Brand#{n}" for n in range(15, 26)]
INACTIVE_EXCLUDED_MODELS = [f"Brand#{n}" for n in range(19, 26)]
COMPOSITION_EXCLUDED = ["PX000007", "PX000011"]
# ---------------------------------------------------------------------------


def shop_stock(spark: SparkSession, d: str) -> DataFrame:
    """Sellable stock per code outside the other-sites set."""
    sl = B.stock_lines(spark, d)
    sl = sl.filter(~F.col("site").isin(B.OTHER_SITES) & ~F.col("account").isin(B.EXCLUDED_ACCOUNTS))
    return sl.groupBy("code").agg(F.sum("qty").cast("bigint").alias("stock_qty"))


def _item_base(spark: SparkSession, d: str, known_only: bool = False) -> DataFrame:
    """Finished items with their dimensions: collection (inner), colour, group
    and subgroup (left; inner with ``known_only``, J1, J2). The subgroup has a
    composite key, joined as two equalities (J5)."""
    how = "inner" if known_only else "left"
    it = B.items(spark, d).drop("group_name")
    j = (it.join(B.collections(spark, d), "model", "inner").join(B.colours(spark, d), "colour_code", how)
         .join(B.groups(spark, d).withColumnRenamed("group_desc", "group_name"), "group_code", how)
         .join(B.subgroups(spark, d), ["group_code", "subgroup_code"], how)
         .join(shop_stock(spark, d), "code", "left"))
    stock = F.col("stock_qty")
    final = (F.when(F.col("orderable"), FINAL_ACTIVE).when(stock > 0, FINAL_ACTIVE).otherwise(FINAL_INACTIVE))
    return j.select(
        "*",
        F.col("price").cast("bigint").alias("price_int"),
        price_band(F.col("price"), F.col("metal"), PRICE_BANDS).alias("price_band"),
        F.when(F.col("orderable"), YES).otherwise(NO).alias("orderable_text"),
        F.when(F.col("active"), ACTIVE_TXT).otherwise(INACTIVE_TXT).alias("status_text"),
        floor_zero(stock).cast("bigint").alias("stock"),
        final.alias("final_status"),
        F.when(F.col("collection_desc").contains(COLLECTION_WORD),
               F.replace(F.col("collection_desc"), F.lit(COLLECTION_WORD), F.lit("")))
        .otherwise(F.col("collection_desc")).alias("collection"),
    )


MASTER_COLS = ["model", "group_name", "subgroup_desc", "code", "description", "price_int", "price_band", "metal",
               "colour_code", "colour_desc", "price_table", "note_1", "note_2", "orderable_text", "status_text",
               "stock", "final_status"]


def item_master(spark: SparkSession, d: str, sort: bool = True) -> DataFrame:
    """Item master (E2): 17 columns, price > 1, sorted by model, group, code."""
    out = _item_base(spark, d).filter(F.col("price") > 1).select(*MASTER_COLS)
    return out.orderBy("model", "group_name", "code") if sort else out


def item_export_full(spark: SparkSession, d: str) -> DataFrame:
    """Item master, full (E3): every dimension joined inner (J1), with cost,
    markup, codes, photo URL, weight and inclusion date; no price floor."""
    b = _item_base(spark, d, known_only=True)
    return b.select(
        "model", "collection", "group_code", "group_name", "subgroup_code", "subgroup_desc", "code", "description",
        F.round(F.try_divide(F.col("price"), F.col("cost")), 2).alias("markup"),
        F.round(F.col("cost"), 2).alias("cost"),
        F.round(F.col("price"), 0).cast("bigint").alias("price_dec"),
        "price_band", "goods_group", "metal", "colour_code", "colour_desc", "sub_level", "price_table", "size_label",
        F.concat(F.lit(PHOTO_BASE_URL), F.col("code"), F.lit(".JPG")).alias("photo_url"),
        "orderable_text", "status_text", "stock", "final_status",
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("item_key") % 3650).cast("int")).alias("inclusion_date"),
        F.round(F.col("size") * F.lit(0.37), 2).alias("weight"), "class_code", "line_code",
    )


def item_texts(spark: SparkSession, d: str) -> DataFrame:
    """Item texts (E4): E2 + titles and whole descriptions in two languages,
    composition and cluster."""
    b = _item_base(spark, d).filter(F.col("price") > 1)
    docs = read_table(spark, d, "documents")
    first = docs.select(F.col("doc_id").alias("item_key"), F.col("text").alias("description_text"), "lang")
    second = docs.select((F.col("doc_id") - SECOND_TEXT).alias("item_key"), F.col("text").alias("description_text_2"),
                         F.col("lang").alias("lang_2"))
    j = b.join(first, "item_key", "left").join(second, "item_key", "left")
    return j.select(*MASTER_COLS, title_case(F.col("description")).alias("title"),
                    title_case(F.concat_ws(" ", "type", "description")).alias("title_2"),
                    "description_text", "lang", "description_text_2", "lang_2",
                    F.concat_ws(" ", F.col("type"), F.col("metal")).alias("composition"), F.col("sub_level").alias("cluster"))


def item_seo(spark: SparkSession, d: str) -> DataFrame:
    """Search-listing attributes (E5): cleaned collection, taxonomy code
    (X10) and keyword flag (X23)."""
    b = _item_base(spark, d).filter(F.col("price") > 1)
    return b.select(*MASTER_COLS, "collection",
                    case_map(F.col("group_name"), TAXONOMY, TAXONOMY_DEFAULT).alias("taxonomy_code"),
                    F.when(F.col("description").contains(KEYWORD), F.upper(F.lit(KEYWORD)))
                    .otherwise(F.lit("")).alias("keyword"))


def items_active(spark: SparkSession, d: str) -> DataFrame:
    """Active item list (E12, F2, F3): final status active, model not excluded."""
    m = item_master(spark, d, sort=False)
    return m.filter((F.col("final_status") == FINAL_ACTIVE) & ~F.col("model").isin(ACTIVE_EXCLUDED_MODELS))


def items_inactive(spark: SparkSession, d: str) -> DataFrame:
    m = item_master(spark, d, sort=False)
    return m.filter((F.col("final_status") == FINAL_INACTIVE) & ~F.col("model").isin(INACTIVE_EXCLUDED_MODELS))


def price_list(spark: SparkSession, d: str) -> DataFrame:
    """Price by item × size tag (E1): ``code-size``; an item without tags
    gets ``code-`` (CONCAT treats NULL as ''). One row per stock tag: a
    (item, size) with several tags is repeated."""
    tags = B.stock_lines(spark, d).select("code", "size_code")
    it = B.items(spark, d)
    j = it.join(tags, "code", "left")
    return j.select("code", F.concat(F.col("code"), F.lit("-"), F.coalesce(F.col("size_code").cast("string"), F.lit("")))
                    .alias("ref"), F.col("price").cast("bigint").alias("price_int"))


def composition_lines(spark: SparkSession, d: str) -> DataFrame:
    """Composition role (sljcomp2): one line per stock line of an item."""
    li = read_table(spark, d, "lineitem").select("l_partkey", "l_linenumber")
    it = B.items(spark, d).select("item_key", "code", "type")
    j = li.join(it, li.l_partkey == it.item_key)
    return j.select("code", F.when(F.col("l_linenumber") % 2 == 0, "MET").otherwise("STN").alias("comp_group"),
                    F.concat(F.upper(F.col("type")), F.lit(" PLATING")).alias("comp_text"))


def composition_flag(spark: SparkSession, d: str) -> DataFrame:
    """Distinct plated items (A10, J10): metal composition lines whose text
    matches, codes not starting with CO and not excluded."""
    c = composition_lines(spark, d)
    c = c.filter((F.col("comp_group") == "MET") & F.col("comp_text").like("%PROMO%")
                 & ~F.col("code").like("CO%") & ~F.col("code").isin(COMPOSITION_EXCLUDED))
    return c.select("code", F.lit("Plated").alias("formation")).distinct()


def scan_item(spark: SparkSession, d: str) -> DataFrame:
    """Named extract (S1): the item role as the JDBC source would give it."""
    return B.items(spark, d)


def scan_full(spark: SparkSession, d: str) -> DataFrame:
    """Full scan of one relation."""
    return read_table(spark, d, "part")
