"""Text reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean_text, collapse_ws
from ..session import ensure_checkpoint_dir
from ..sources import read_table


def erp_texts(spark: SparkSession, d: str) -> DataFrame:
    """ERP texts per key: title, whole description, composition."""
    doc = read_table(spark, d, "documents")
    return doc.select(F.col("doc_id").alias("sku"), F.col("source").alias("title"),
                      F.col("text").alias("description"), F.col("lang").alias("composition"))


def store_texts(spark: SparkSession, d: str) -> DataFrame:
    """Store texts (binding): the same texts with every blank doubled and
    line break and tab around, which must not count as a change; a word
    added where key % 7 = 0, another title where key % 11 = 0 and no
    composition where key % 13 = 0, which must."""
    doc = read_table(spark, d, "documents")
    desc = (F.when(F.col("doc_id") % 7 == 0, F.concat(F.col("text"), F.lit(" extra")))
            .otherwise(F.concat(F.lit("\n"), F.replace(F.col("text"), F.lit(" "), F.lit("  ")), F.lit("\t"))))
    key = F.col("doc_id")
    title = F.when(key % 11 == 0, F.concat(F.col("source"), F.lit(" old"))).otherwise(F.col("source"))
    return doc.select(key.alias("sku"), title.alias("title"), desc.alias("description"),
                      F.when(key % 13 != 0, F.col("lang")).alias("composition"))


def _norm(x):
    return F.coalesce(collapse_ws(x), F.lit(""))


COLUMNS = ["title", "description", "composition"]
#: Keys with a difference up to which they are broadcast to the texts (about 150 MB).
BROADCAST_KEYS = 500_000


def _prints(texts: DataFrame, side: str) -> DataFrame:
    """sku, the 128-bit fingerprint of each normalised text and whether there
    is any text: rows of a fixed size, whatever the texts' length."""
    any_text = F.lit(False)
    for c in COLUMNS:
        any_text = any_text | F.col(c).isNotNull()
    return texts.select("sku", *[F.unhex(F.md5(_norm(F.col(c)))).alias(f"{side}_{c}") for c in COLUMNS],
                        any_text.alias(f"{side}_any"))


def text_diff(store: DataFrame, erp: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Text diff (R9): store ⟕ ERP on sku; whitespace-normalised compare
    (T13: a missing text equals ''); keep rows with any difference and at
    least one ERP text. Whole texts are compared, never prefixes.

    The texts' fingerprints are joined first; whole texts are then read only for
    the keys that differ: those keys are broadcast to both sides if their
    checked number allows it, so that equal texts are never shuffled, else
    joined by a shuffle. Fingerprints are part of the key, so repeated rows of a
    sku meet as in the plain join."""
    flags = {c: F.col(f"s_{c}") != F.col(f"e_{c}") for c in COLUMNS}
    met = _prints(store, "s").join(_prints(erp, "e").filter("e_any"), "sku")
    differing = met.filter(flags["title"] | flags["description"] | flags["composition"]).select(
        "sku", *[f"{side}_{c}" for side in "se" for c in COLUMNS]).distinct()
    ensure_checkpoint_dir(store.sparkSession)
    differing = differing.checkpoint()
    if differing.limit(broadcast_keys + 1).count() <= broadcast_keys:
        differing = F.broadcast(differing)

    def whole(texts: DataFrame, side: str) -> DataFrame:
        near = texts.join(differing.select("sku"), "sku", "left_semi")
        return near.select("sku", *COLUMNS, *[F.unhex(F.md5(_norm(F.col(c)))).alias(f"{side}_{c}") for c in COLUMNS])

    new = whole(erp, "e").select("sku", *[F.col(c).alias(f"new_{c}") for c in COLUMNS], *[f"e_{c}" for c in COLUMNS])
    pairs = whole(store, "s").join(differing, ["sku", *[f"s_{c}" for c in COLUMNS]]).join(new, ["sku", *[f"e_{c}" for c in COLUMNS]])
    return pairs.select("sku", *COLUMNS, *[flags[c].alias(f"{c}_diff") for c in COLUMNS], *[f"new_{c}" for c in COLUMNS])


def feed_text(diff: DataFrame) -> DataFrame:
    """Title, description and composition payload (P5) with cleaned text; the
    composition is a metafield of the product."""
    product = F.concat(F.lit("prod-"), F.col("sku").cast("string"))
    payload = F.to_json(F.struct(
        F.struct(product.alias("id"), clean_text(F.col("new_title")).alias("title"),
                 clean_text(F.col("new_description")).alias("descriptionHtml")).alias("input"),
        F.array(F.struct(product.alias("ownerId"), F.lit("custom").alias("namespace"), F.lit("composicao_text").alias("key"),
                         F.lit("multi_line_text_field").alias("type"),
                         clean_text(F.col("new_composition")).alias("value"))).alias("metafields")))
    return diff.select("sku", payload.alias("payload"))
