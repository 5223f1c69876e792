"""Change feeds (P1, P2, P9–P14): one payload column per row, written to
an outbox table by the caller; the reference posts each row itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bindings as B

# ---- fixed values: letter variant tables and care text -------------------
LETTERS_ALL = [chr(c) for c in range(ord("A"), ord("Z") + 1)]
LETTERS_23 = [x for x in LETTERS_ALL if x not in ("S", "T", "V")]
LETTERS_8A = ["B", "D", "I", "Q", "U", "W", "X", "Y"]
LETTERS_8B = ["F", "I", "Q", "U", "W", "X", "Y", "Z"]
CARE_TEXT = {"GOLD": "Keep away from chemicals; clean with a soft cloth.",
             "SILVER": "Store dry and polish with a silver cloth."}
PRODUCT_STATUS = "DRAFT"
RING_CATEGORIES = ["Ring", "Band"]
FIXED_COLLECTION = "col-new"
CATEGORY_PREFIX = "category/"
GENDER = "unisex"
NAMESPACE = "custom"
LIST_TEXT, LINE_TEXT, LONG_TEXT = "list.single_line_text_field", "single_line_text_field", "multi_line_text_field"
CONSENT = ("SUBSCRIBED", "SINGLE_OPT_IN")
CLIENT_CODE = "codclient"
# Shapes of a new product, first that fits: name, condition, option, variants
# (one per size of the range, one of the item's size, one without an option),
# number of stones named.
SHAPES = [
    ("ring", "category IN ('Ring', 'Band')", "Size", "sizes", "least(2, stone_count)"),
    ("sized", "size_label <> ''", "Size", "label", "CASE WHEN stone_count = 2 THEN 2 ELSE least(1, stone_count) END"),
    ("two stones", "stone_count = 2", None, "plain", "2"),
    ("plain", "true", None, "plain", "least(1, stone_count)"),
]
# ---------------------------------------------------------------------------


def feed_stock(changes: DataFrame) -> DataFrame:
    """Quantity adjustment payload per change."""
    payload = F.to_json(F.struct(
        F.lit("correction").alias("reason"), F.lit("available").alias("name"),
        F.struct(F.col("delta").alias("delta"), F.col("inventory_item_id").alias("inventoryItemId"),
                 F.col("location_id").alias("locationId")).alias("changes")))
    return changes.select("phase", "variant_sku", "location_id", payload.alias("payload"))


def feed_activation(variants: DataFrame, locations: list[str]) -> DataFrame:
    """Tracking on and activation per inventory item (P2): the fixed list of
    locations, sorted for a stable payload, for every item once."""
    listed = F.array(*[F.struct(F.lit(x).alias("locationId"), F.lit(True).alias("activate")) for x in sorted(locations)])
    items = variants.select(F.concat(F.lit("inv-"), F.col("sku")).alias("inventory_item_id")).distinct()
    return items.select("inventory_item_id", F.to_json(F.struct(
        F.col("inventory_item_id").alias("inventoryItemId"), F.lit(True).alias("tracked"), listed.alias("activations"))).alias("payload"))


def _care(metal):
    out = None
    for m, t in CARE_TEXT.items():
        out = F.when(metal == m, F.lit(t)) if out is None else out.when(metal == m, F.lit(t))
    return out.otherwise(F.lit(""))


def _metafield(key: str, kind: str, value: F.Column) -> F.Column:
    return F.struct(F.lit(key).alias("key"), F.lit(NAMESPACE).alias("namespace"), F.lit(kind).alias("type"), value.alias("value"))


def _listed(values: F.Column) -> F.Column:
    """A list as the text that list metafields take."""
    return F.concat(F.lit('["'), F.array_join(values, '", "'), F.lit('"]'))


def _metafields(named: F.Column) -> F.Column:
    """Metafields of a new product; without stones there is no stone field."""
    fields = F.array(
        _metafield("genero", LIST_TEXT, F.lit(f'["{GENDER}"]')),
        _metafield("metal", LINE_TEXT, F.col("metal_title")),
        _metafield("cobertura", LINE_TEXT, F.col("coating")),
        _metafield("pedra", LIST_TEXT, F.when(F.size(named) > 0, _listed(named))),
        _metafield("cuidadospeca", LONG_TEXT, _care(F.upper(F.col("metal_title")))))
    return F.filter(fields, lambda m: (m["key"] != "pedra") | m["value"].isNotNull())


def _product(title: F.Column, option: F.Column, variants: F.Column, metafields: F.Column | None) -> F.Column:
    """Payload of a new product; ``to_json`` omits what is NULL."""
    return F.to_json(F.struct(F.struct(
        title.alias("title"), F.col("description_html").alias("descriptionHtml"),
        F.struct(F.concat(F.lit(CATEGORY_PREFIX), F.col("category_id")).alias("productTaxonomyNodeId")).alias("productCategory"),
        F.col("product_type").alias("productType"), F.lit(PRODUCT_STATUS).alias("status"), "handle",
        F.array(F.lit(FIXED_COLLECTION), F.col("collection_id")).alias("collectionsToJoin"),
        F.struct(title.alias("title")).alias("seo"), option.alias("options"), variants.alias("variants"),
        *([metafields.alias("metafields")] if metafields is not None else [])).alias("input")))


def _variant(sku: F.Column, option: F.Column) -> F.Column:
    return F.struct(sku.alias("sku"), F.col("price_text").alias("price"), option.alias("options"))


def _stones() -> F.Column:
    return F.from_json(F.col("stones"), T.ArrayType(T.StringType()))


def feed_create(new_items: DataFrame, shapes=None) -> DataFrame:
    """Product creation payload (P9, P11): the shape table is one array of rows
    (fits, option, variants, stones), of which the first that fits is filled in."""
    sizes = F.transform(F.sequence(F.lit(B.SIZE_FIRST), F.lit(B.SIZE_LAST)), lambda n: _variant(
        F.concat(F.col("code"), F.lit("-"), n.cast("string")), n.cast("string")))
    variants = {"sizes": sizes, "label": F.array(_variant(F.col("code"), F.col("size_label"))),
                "plain": F.array(_variant(F.col("code"), F.lit(None).cast("string")))}
    rows = F.array(*[F.struct(
        F.expr(fits).alias("fits"), F.lit(name).alias("shape"), F.lit(option).cast("string").alias("option"),
        variants[kind].alias("variants"), F.expr(stones).cast("int").alias("stones"))
        for name, fits, option, kind, stones in shapes or SHAPES])
    chosen = new_items.withColumn("_shape", F.get(F.filter(rows, lambda s: s["fits"]), 0))
    payload = _product(F.col("title"), F.col("_shape.option"), F.col("_shape.variants"),
                       _metafields(F.slice(_stones(), F.lit(1), F.col("_shape.stones"))))
    return chosen.select("code", F.col("_shape.shape").alias("shape"), payload.alias("payload"))


def feed_create_letters(new_items: DataFrame) -> DataFrame:
    """Dormant letter-variant shapes (P10): 26, 23 or 8 letters, same sku
    on every variant; the two 8-letter shapes carry no metafields. The
    shape is chosen by item_key % 4."""
    k = F.col("item_key") % 4
    lit_arr = lambda xs: F.array(*[F.lit(x) for x in xs])
    letters = (F.when(k == 0, lit_arr(LETTERS_ALL)).when(k == 1, lit_arr(LETTERS_23))
               .when(k == 2, lit_arr(LETTERS_8A)).otherwise(lit_arr(LETTERS_8B)))
    variants = F.transform(letters, lambda x: _variant(F.col("code"), x))
    meta = F.when(k <= 1, _metafields(F.slice(_stones(), 1, 1)))
    payload = _product(F.col("title"), F.lit("Style"), variants, meta)
    return new_items.select("code", F.size(letters).cast("bigint").alias("n_variants"), payload.alias("payload"))


def feed_create_listed(new_items: DataFrame, sizes: list[str]) -> DataFrame:
    """Listed variants (P10): two or three variants with skus of their own; the
    title is what stands before ' - '; two stones are named if there are two."""
    title = F.substring_index(F.concat_ws(" - ", "title", "product_type"), " - ", 1)
    listed = F.slice(F.array(*[F.lit(x) for x in sizes]), F.lit(1), F.col("n_listed"))
    variants = F.transform(listed, lambda x: _variant(F.concat(F.col("code"), F.lit("-"), x), x))
    n = F.when(F.col("stone_count") == 2, 2).otherwise(F.least(F.col("stone_count"), F.lit(1))).cast("int")
    payload = _product(title, F.lit("Size"), variants, _metafields(F.slice(_stones(), F.lit(1), n)))
    return new_items.filter("n_listed > 0").select("code", "n_listed", payload.alias("payload"))


def _consent() -> F.Column:
    return F.struct(F.lit(CONSENT[0]).alias("marketingState"), F.lit(CONSENT[1]).alias("marketingOptInLevel"))


def feed_customer(classified: DataFrame) -> DataFrame:
    """Customer creation payload by class (P12): fields the class lacks are
    NULL and ``to_json`` omits them."""
    has_phone = F.col("class").isin("no_address", "complete")
    has_addr = F.col("class").isin("no_phone", "complete")
    address = F.struct(F.col("address").alias("address1"), "city", F.col("province_code").alias("provinceCode"),
                       F.col("country_code").alias("countryCode"), "zip")
    payload = F.to_json(F.struct(F.struct(
        F.col("first_name").alias("firstName"), F.col("last_name").alias("lastName"), F.col("email").alias("email"),
        _consent().alias("emailMarketingConsent"), F.when(has_addr, address).alias("addresses"),
        F.when(has_phone, F.col("phone")).alias("phone"), F.when(has_phone, _consent()).alias("smsMarketingConsent"),
        F.struct(F.lit(CLIENT_CODE).alias("key"), F.lit(LINE_TEXT).alias("type"), F.col("customer_id").alias("value"),
                 F.lit(NAMESPACE).alias("namespace")).alias("metafields")).alias("input")))
    return classified.select("customer_id", "class", payload.alias("payload"))


def _by_id(key: str) -> F.Column:
    return F.to_json(F.struct(F.struct(F.col(key).alias("id")).alias("input"))).alias("payload")


def feed_delete(variants: DataFrame, items: DataFrame) -> DataFrame:
    """Delete list (P13): store products whose item is inactive in the ERP."""
    inactive = items.filter(~F.col("active")).select(F.col("code").alias("sku_2"))
    p = variants.join(inactive, "sku_2", "left_semi").select("product_id").distinct()
    return p.select("product_id", _by_id("product_id"))


def feed_customer_delete(classified: DataFrame) -> DataFrame:
    """Delete list (P13): customers that can be reached neither way."""
    return classified.filter("class = 'no_phone_no_address'").select("customer_id", _by_id("customer_id"))


RESPONSE_SCHEMA = T.StructType([T.StructField("data", T.StructType([T.StructField("adjust", T.StructType([
    T.StructField("userErrors", T.ArrayType(T.StructType([T.StructField("field", T.StringType()),
                                                          T.StructField("message", T.StringType())])))]))]))])


def response_of(rejected: F.Column, message: str = "Quantity below limit") -> F.Column:
    """Response of the store to a change (binding)."""
    errs = F.when(rejected, F.array(F.struct(F.lit("delta").alias("field"), F.lit(message).alias("message")))) \
        .otherwise(F.array().cast("array<struct<field:string,message:string>>"))
    return F.to_json(F.struct(F.struct(F.struct(errs.alias("userErrors")).alias("adjust")).alias("data")))


def first_error(response: F.Column) -> F.Column:
    """First error of a response, NULL if it was applied. A response that is
    no JSON of this form counts as rejected."""
    parsed = F.from_json(response, RESPONSE_SCHEMA).getField("data").getField("adjust")
    errs = parsed.getField("userErrors")
    return (F.when(errs.isNull(), F.lit("unreadable response"))
            .when(F.size(errs) > 0, F.coalesce(F.get(errs, 0).getField("message"), F.lit(""))))


def landed_responses(changes: DataFrame, floor: int = -50) -> DataFrame:
    """Landed responses to the stock feed (binding): a change below
    ``floor`` is rejected with one error."""
    return changes.select("variant_sku", "location_id", response_of(F.col("delta") < floor).alias("response"))


def response_split(responses: DataFrame) -> DataFrame:
    """Response log (P14): applied vs rejected rows and the first error."""
    r = responses.select("variant_sku", "location_id", first_error(F.col("response")).alias("message"))
    return r.select("variant_sku", "location_id",
                    F.when(F.col("message").isNull(), "applied").otherwise("rejected").alias("status"), "message")
