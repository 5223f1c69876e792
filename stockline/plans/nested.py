"""Store snapshots as nested JSON Lines.

The store's bulk export interleaves parent lines (a variant) and child
lines (its inventory levels, carrying ``__parentId``). The reference
forward-fills parent fields down the file, which needs one global row
order; here children are joined to parents on ``__parentId``, which
needs none and partitions on the parent id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import base_code
from ..operators import ffill_by_key, first_per_key
from ..session import ensure_checkpoint_dir
from ..sources import parse_json_lines, read_jsonl, read_table
from . import bindings as B

S, L, D, BOOL = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LEVELS_SCHEMA = _st(
    ("id", S), ("sku", S),
    ("product", _st(("id", S), ("title", S), ("totalVariants", L))),
    ("inventoryItem", _st(("id", S), ("variant", _st(("id", S), ("sku", S), ("title", S))))),
    ("location", _st(("id", S), ("name", S))),
    ("quantities", T.ArrayType(_st(("quantity", L), ("name", S), ("updatedAt", S)))),
    ("__parentId", S),
)
VARIANTS_SCHEMA = _st(
    ("id", S), ("sku", S), ("title", S), ("price", D), ("compareAtPrice", D), ("inventoryQuantity", L),
    ("product", _st(("id", S), ("title", S), ("totalInventory", L), ("totalVariants", L),
                    ("mediaCount", _st(("count", L))), ("description", S), ("metafield", _st(("value", S))))),
)
METAFIELDS_SCHEMA = _st(("id", S), ("title", S),
                        ("metafields", T.ArrayType(_st(("id", S), ("key", S), ("value", S)))))
NODE = _st(("id", S), ("title", S), ("handle", S), ("updatedAt", S), ("productsCount", L), ("sortOrder", S))
PRODUCT_PAGE_SCHEMA = _st(("data", _st(("product", _st(
    ("id", S), ("title", S), ("category", _st(("id", S), ("name", S))),
    ("collections", _st(("edges", T.ArrayType(_st(("node", _st(("id", S), ("title", S)))))))))))))
COLLECTION_PAGE_SCHEMA = _st(("data", _st(("collections", _st(("edges", T.ArrayType(_st(("node", NODE)))))))))


# ------------------------------------------------------------ export lines --
def levels_export_lines(variants: DataFrame, levels: DataFrame) -> DataFrame:
    """The store's inventory export as JSON text lines (binding): one parent
    line per variant and one child line per level."""
    parent = variants.select(F.to_json(F.struct(
        F.col("variant_id").alias("id"), F.col("sku"),
        F.struct(F.col("product_id").alias("id"), F.col("product_title").alias("title"),
                 F.col("total_variants").alias("totalVariants")).alias("product"),
        F.struct(F.concat(F.lit("inv-"), F.col("sku")).alias("id"),
                 F.struct(F.col("variant_id").alias("id"), F.col("sku"), F.col("title")).alias("variant"))
        .alias("inventoryItem"))).alias("value"))
    child = levels.select(F.to_json(F.struct(
        F.col("level_id").alias("id"),
        F.struct(F.col("location_id").alias("id"), F.col("location_name").alias("name")).alias("location"),
        F.array(F.struct(F.col("qty").alias("quantity"), F.lit("available").alias("name"),
                         F.lit("2024-01-01T00:00:00Z").alias("updatedAt"))).alias("quantities"),
        F.col("variant_id").alias("__parentId"))).alias("value"))
    return parent.unionByName(child)


def variants_export_lines(spark: SparkSession, d: str, with_text: bool = False) -> DataFrame:
    """Variant export lines (binding); ``with_text`` adds the product
    description (whole document text) and a nullable metafield."""
    v = B.channel_variants(spark, d)
    desc = F.lit(None).cast("string")
    meta = F.lit(None).cast(_st(("value", S)))
    if with_text:
        docs = read_table(spark, d, "documents").select(F.col("doc_id"), "text", "lang")
        v = v.withColumn("doc_id", F.substring_index("product_id", "-", -1).cast("bigint")).join(docs, "doc_id", "left")
        desc = F.col("text")
        meta = F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast(_st(("value", S)))).otherwise(
            F.struct(F.col("lang").alias("value")))
    return v.select(F.to_json(F.struct(
        F.col("variant_id").alias("id"), "sku", "title", "price", F.col("compare_at_price").alias("compareAtPrice"),
        F.col("inventory_quantity").alias("inventoryQuantity"),
        F.struct(F.col("product_id").alias("id"), F.col("product_title").alias("title"),
                 F.col("total_inventory").alias("totalInventory"), F.col("total_variants").alias("totalVariants"),
                 F.struct(F.col("media_count").alias("count")).alias("mediaCount"),
                 desc.alias("description"), meta.alias("metafield")).alias("product"))).alias("value"))


# --------------------------------------------------------------- flattening --
def flatten_levels(raw: DataFrame) -> DataFrame:
    """Parent/child export → variant × location (N1, J17). Children are the
    lines with quantities; parents are lines without ``__parentId``."""
    parents = raw.filter(F.col("__parentId").isNull() & F.col("quantities").isNull()).select(
        F.col("id").alias("_pid"), "sku", F.col("product.id").alias("product_id"),
        F.col("product.title").alias("product_title"), F.col("product.totalVariants").alias("total_variants"),
        F.col("inventoryItem.id").alias("inventory_item_id"), F.col("inventoryItem.variant.id").alias("variant_id"),
        F.col("inventoryItem.variant.sku").alias("variant_sku"),
        F.col("inventoryItem.variant.title").alias("variant_title"))
    children = raw.filter(F.col("quantities").isNotNull() & F.col("__parentId").isNotNull()).select(
        F.col("id").alias("level_id"), F.col("__parentId").alias("_pid"),
        F.col("location.id").alias("location_id"), F.col("location.name").alias("location_name"),
        F.col("quantities").getItem(0).getField("quantity").alias("qty"))
    j = children.join(parents, "_pid", "inner")
    return j.select("level_id", "sku", "product_id", "product_title", "total_variants", "inventory_item_id",
                    "variant_id", "variant_sku", "variant_title", "location_id", "location_name", "qty",
                    base_code(F.col("variant_sku")).alias("sku_2"))


def flatten_variants(raw: DataFrame, with_text: bool = False) -> DataFrame:
    """Variant export → flat variants with base code."""
    cols = [F.col("id").alias("variant_id"), "sku", "title", F.col("price"),
            F.col("compareAtPrice").alias("compare_at_price"), F.col("inventoryQuantity").alias("inventory_quantity"),
            F.col("product.id").alias("product_id"), F.col("product.title").alias("product_title"),
            F.col("product.totalInventory").alias("total_inventory"),
            F.col("product.totalVariants").alias("total_variants"),
            F.col("product.mediaCount.count").alias("media_count"), base_code(F.col("sku")).alias("sku_2")]
    if with_text:
        cols += [F.col("product.description").alias("description"),
                 F.col("product.metafield.value").alias("metafield_value")]
    return raw.select(*cols)


def land_lines(spark: SparkSession, lines: DataFrame, name: str) -> str:
    """Land export lines as a JSON Lines file under the shared checkpoint
    folder (what the store's bulk export delivers) and return its path."""
    import uuid
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/exports/{name}-{uuid.uuid4().hex}"
    lines.write.mode("overwrite").text(path)
    return path


def jsonl_levels(spark: SparkSession, d: str) -> DataFrame:
    """N1 end to end: the export is landed as a file, then read with the
    declared nested schema and flattened. Parents and children are two
    filters of the same scan joined on ``__parentId``."""
    lines = levels_export_lines(B.channel_variants(spark, d), B.channel_levels(spark, d))
    return flatten_levels(read_jsonl(spark, land_lines(spark, lines, "levels"), LEVELS_SCHEMA))


def jsonl_variants(spark: SparkSession, d: str) -> DataFrame:
    return flatten_variants(parse_json_lines(variants_export_lines(spark, d), VARIANTS_SCHEMA))


def jsonl_texts(spark: SparkSession, d: str) -> DataFrame:
    lines = variants_export_lines(spark, d, with_text=True)
    return flatten_variants(parse_json_lines(lines, VARIANTS_SCHEMA), with_text=True)


# ------------------------------------------------------ metafields, pages ----
def metafield_lines(spark: SparkSession, d: str) -> DataFrame:
    """Product metafield export (binding): two metafields per product, none
    for key % 9 = 0."""
    it = B.items(spark, d)
    mf = F.when(F.col("item_key") % 9 == 0, F.array().cast(T.ArrayType(_st(("id", S), ("key", S), ("value", S))))) \
        .otherwise(F.array(
            F.struct(F.concat(F.lit("mf-"), F.col("item_key").cast("string"), F.lit("-c")).alias("id"),
                     F.lit("composition").alias("key"), F.col("type").alias("value")),
            F.struct(F.concat(F.lit("mf-"), F.col("item_key").cast("string"), F.lit("-m")).alias("id"),
                     F.lit("metal").alias("key"), F.col("metal").alias("value"))))
    return it.select(F.to_json(F.struct(F.concat(F.lit("prod-"), F.col("item_key").cast("string")).alias("id"),
                                        F.col("description").alias("title"), mf.alias("metafields"))).alias("value"))


def jsonl_metafields(spark: SparkSession, d: str) -> DataFrame:
    """Product metafields, one row per metafield; products without any keep
    one row with NULLs (N5, ``explode_outer``)."""
    raw = parse_json_lines(metafield_lines(spark, d), METAFIELDS_SCHEMA)
    e = raw.select(F.col("id").alias("product_id"), "title", F.explode_outer("metafields").alias("m"))
    return e.select("product_id", "title", F.col("m.id").alias("metafield_id"), F.col("m.key").alias("key"),
                    F.col("m.value").alias("value"))


def collection_pages(spark: SparkSession, d: str, page_size: int = 10) -> DataFrame:
    """Landed collection pages (binding): collections of ``part`` brands,
    ``page_size`` edges per page at most (page = brand number div size), so
    each collected page is bounded."""
    p = read_table(spark, d, "part")
    c = p.groupBy(F.col("p_brand").alias("model")).agg(F.count(F.lit(1)).alias("n"))
    num = F.split(F.col("model"), "#").getItem(1).cast("int")
    node = F.struct(F.concat(F.lit("col-"), num.cast("string")).alias("id"), F.col("model").alias("title"),
                    F.lower(F.regexp_replace("model", "#", "-")).alias("handle"),
                    F.lit("2024-01-01T00:00:00Z").alias("updatedAt"), F.col("n").alias("productsCount"),
                    F.when(num % 2 == 0, "BEST_SELLING").otherwise("MANUAL").alias("sortOrder"))
    pages = c.groupBy(F.floor(num / page_size).alias("page")).agg(
        F.collect_list(F.struct(node.alias("node"))).alias("edges"))
    return pages.select(F.to_json(F.struct(F.struct(F.struct("edges").alias("collections")).alias("data")))
                        .alias("value"))


def json_pages(spark: SparkSession, d: str) -> DataFrame:
    """Landed API pages → rows (S8): ``from_json`` + ``explode_outer(edges)``
    + ``node.*``."""
    raw = parse_json_lines(collection_pages(spark, d), COLLECTION_PAGE_SCHEMA)
    e = raw.select(F.explode_outer("data.collections.edges").alias("e"))
    return e.select(F.col("e.node.id").alias("id"), F.col("e.node.title").alias("title"),
                    F.col("e.node.handle").alias("handle"), F.col("e.node.updatedAt").alias("updated_at"),
                    F.col("e.node.productsCount").alias("products_count"),
                    F.col("e.node.sortOrder").alias("sort_order"))


def product_pages(spark: SparkSession, d: str) -> DataFrame:
    """Landed product pages (binding): one page per product with its
    category (taxonomy code of the item group) and its collections — the
    item's model, plus a fixed 'New' collection first for even keys."""
    from .catalog import TAXONOMY, TAXONOMY_DEFAULT
    from ..functions import case_map
    it = B.items(spark, d)
    num = F.split(F.col("model"), "#").getItem(1)
    own = F.struct(F.struct(F.concat(F.lit("col-"), num).alias("id"), F.col("model").alias("title")).alias("node"))
    new = F.struct(F.struct(F.lit("col-new").alias("id"), F.lit("New").alias("title")).alias("node"))
    edges = F.when(F.col("item_key") % 2 == 0, F.array(new, own)).otherwise(F.array(own))
    prod = F.struct(F.concat(F.lit("prod-"), F.col("item_key").cast("string")).alias("id"),
                    F.col("description").alias("title"),
                    F.struct(case_map(F.col("group_name"), TAXONOMY, TAXONOMY_DEFAULT).alias("id"),
                             F.col("group_name").alias("name")).alias("category"),
                    F.struct(edges.alias("edges")).alias("collections"))
    return it.select(F.to_json(F.struct(F.struct(prod.alias("product")).alias("data"))).alias("value"))


def product_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """Product taxonomy and first collection (N9): struct access and
    ``edges[0].node``; a product without collections gets NULLs."""
    raw = parse_json_lines(product_pages(spark, d), PRODUCT_PAGE_SCHEMA)
    p = F.col("data.product")
    first = F.get(p.getField("collections").getField("edges"), 0).getField("node")
    return raw.select(p.getField("id").alias("product_id"), p.getField("title").alias("title"),
                      p.getField("category").getField("id").alias("category_id"),
                      p.getField("category").getField("name").alias("category_name"),
                      first.getField("id").alias("first_collection_id"),
                      first.getField("title").alias("first_collection_title"),
                      F.size(p.getField("collections").getField("edges")).cast("bigint").alias("n_collections"))


def page_limit(spark: SparkSession, d: str, first: int) -> DataFrame:
    """Page size ``first: N`` (W6): the first N collection rows by id; the
    limit is the feature and has no default."""
    return json_pages(spark, d).orderBy("id").limit(first)


def lookup_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Codes looked up in earlier runs (binding): items with key % 3 = 0."""
    return B.items(spark, d).filter(F.col("item_key") % 3 == 0).select("code")


# ------------------------------------------------------------------ lookups --
def lookup_items(spark: SparkSession, d: str) -> DataFrame:
    """Product lookup (N6): every ERP item × its store variants with the
    product's first image; items the store's product list lacks get one
    explicit row with status 'not in channel'.

    The variants (many per code) are the streamed side of an inner join
    to the unique items, so a hot code can be split by AQE's skew join;
    items without variants come from an anti join against distinct codes."""
    it = B.items(spark, d).select("item_key", "code")
    v = B.store_index(spark, d)
    prod = v.select(F.col("sku_2").alias("code"), "in_products", "product_id", F.col("variant_id"), F.col("sku").alias("variant_sku"),
                    F.concat(F.lit("https://cdn.example/"), F.col("sku_2"), F.lit("-1.jpg")).alias("image_url"))
    listed = prod.withColumnRenamed("code", "store_code")
    same = (F.col("code") == F.col("store_code")) & F.col("in_products")
    found = (listed.join(it.select("code"), same, "inner").withColumn("status", F.lit("found"))
             .select("code", "product_id", "variant_id", "variant_sku", "image_url", "status"))
    missing = (it.select("code").join(listed.select("store_code", "in_products").distinct(), same, "left_anti")
               .select("code", *[F.lit(None).cast("string").alias(c) for c in
                                 ["product_id", "variant_id", "variant_sku", "image_url"]],
                       F.lit("not in channel").alias("status")))
    return found.unionByName(missing)


def lookup_sizes(spark: SparkSession, d: str, ledger: DataFrame | None = None) -> DataFrame:
    """Variant and inventory-item lookup over generated size codes (N7, N8):
    sized items not yet in the ledger × sizes 10–22, joined to store
    variants on the generated sku (not by position)."""
    it = B.items(spark, d).filter(F.col("family").isin(B.SIZED_FAMILIES)).select("code")
    if ledger is not None:
        it = it.join(ledger.select("code"), "code", "left_anti")
    g = it.select("code", F.explode(F.sequence(F.lit(B.SIZE_FIRST), F.lit(B.SIZE_LAST))).alias("size"))
    g = g.withColumn("sku", F.concat(F.col("code"), F.lit("-"), F.col("size").cast("string")))
    v = B.store_index(spark, d).select(F.col("sku").alias("store_sku"), "variant_id", "in_sizes")
    j = g.join(v, (F.col("sku") == F.col("store_sku")) & F.col("in_sizes"), "left")
    return j.select("code", F.col("size").cast("bigint").alias("size"), "sku", "variant_id",
                    F.when(F.col("variant_id").isNotNull(), F.concat(F.lit("inv-"), F.col("sku"))).alias("inventory_item_id"),
                    F.col("variant_id").isNotNull().alias("found"))


def ffill_events(spark: SparkSession, d: str) -> DataFrame:
    """Forward fill (W1) on ``events``: ``value`` kept only on every third
    event, filled down each user's events in id order."""
    ev = read_table(spark, d, "events").select(
        "user_id", "event_id", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    return ffill_by_key(ev, "user_id", "event_id", ["value"])


def jsonl_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Registered form of the checked reader (S6): the store variants landed as
    JSON Lines of which some are cut short or hold a text for a number; rows
    read per product, and the broken lines set aside."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sources import read_jsonl_checked
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarantine/{uuid.uuid4().hex}"
    line = F.to_json(F.struct("variant_id", "product_id", F.col("inventory_quantity").alias("quantity")))
    q = F.col("inventory_quantity")
    landed = (F.when((q == 3) & (F.col("media_count") == 1), F.substring(line, 1, 20))
              .when((q == 4) & (F.col("media_count") == 2), F.replace(line, F.lit('"quantity":4'), F.lit('"quantity":"four"'))).otherwise(line))
    B.channel_variants(spark, d).select(landed.alias("value")).write.text(f"{root}/lines")
    schema = T.StructType([T.StructField("variant_id", T.StringType()), T.StructField("product_id", T.StringType()),
                           T.StructField("quantity", T.LongType())])
    good = read_jsonl_checked(spark, f"{root}/lines", schema, f"{root}/bad", most_bad=0.5)
    bad = spark.read.parquet(f"{root}/bad").select(F.lit("broken").alias("status"), F.col("line").alias("what"))
    return (good.select(F.lit("read").alias("status"), F.col("product_id").alias("what")).unionByName(bad)
            .groupBy("status", "what").agg(F.count("*").alias("n")))
