"""Landed page chains of several shapes.

An export is a chain of pages: each names the cursor of the next one, the last
names none. Pages of customers, collection members and inventory items are one
JSON object a line; they are read as VARIANT, so the shapes need no common
schema, and each kind's rows are taken from its own path. A chain is whole when
every cursor that a page names has a page, only the first page is named by none
and no page is named twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import read_table
from . import bindings as B

#: Where each kind of page holds its rows, and the fields that a row gives.
SHAPES = {
    "customers": ("$.data.customers.edges", {"id": "$.node.id", "label": "$.node.displayName", "extra": "$.node.email"}),
    "members": ("$.data.collection.products.edges", {"id": "$.node.id", "label": "$.node.title", "extra": "$.node.collection"}),
    "inventory": ("$.data.inventoryItems.nodes", {"id": "$.id", "label": "$.sku", "extra": "$.tracked"}),
}
# ---- fixed values of the binding ------------------------------------------
PAGE_ROWS = 250
LOST_PAGE = ("inventory", 1)  # a page that did not land
# ---------------------------------------------------------------------------


def read_pages(lines: DataFrame) -> DataFrame:
    """Lines (value) as pages: kind, cursor, next_cursor and the page as
    VARIANT. A line that is no JSON is kept with the kind NULL."""
    page = F.try_parse_json("value")
    get = lambda path: F.try_variant_get(F.col("page"), path, "string")
    return lines.select(page.alias("page")).select(get("$.kind").alias("kind"), get("$.cursor").alias("cursor"),
                                                   get("$.next").alias("next_cursor"), "page")


def page_rows(pages: DataFrame, kind: str) -> DataFrame:
    """The rows of one kind of page: id, label, extra."""
    path, fields = SHAPES[kind]
    rows = pages.filter(F.col("kind") == kind).select(
        F.explode(F.try_variant_get(F.col("page"), path, "array<variant>")).alias("r"))
    return rows.select(*[F.try_variant_get(F.col("r"), p, "string").alias(c) for c, p in fields.items()])


def chain_report(pages: DataFrame) -> DataFrame:
    """One row per kind: pages, rows, the missing cursors (sorted) and whether
    the chain is whole. Links are joined on the cursor; only cursors of gaps are
    listed."""
    n_rows = F.coalesce(*[F.when(F.col("kind") == k, F.size(F.try_variant_get(F.col("page"), path, "array<variant>")))
                          for k, (path, _) in SHAPES.items()], F.lit(0))
    known = pages.filter("kind IS NOT NULL").select("kind", "cursor", "next_cursor", n_rows.alias("rows"))
    named = known.filter("next_cursor IS NOT NULL").groupBy("kind", F.col("next_cursor").alias("cursor")).agg(F.count("*").alias("times"))
    links = (known.groupBy("kind", "cursor").agg(F.count("*").alias("copies"), F.sum("rows").alias("rows"),
                                                 F.count_if(F.col("next_cursor").isNull()).alias("ends"))
             .join(named, ["kind", "cursor"], "full"))
    found = links.groupBy("kind").agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("pages"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.array_sort(F.collect_list(F.when(F.col("copies").isNull(), F.col("cursor")))).alias("gaps"),
        F.count_if(F.col("times").isNull()).alias("heads"), F.sum(F.coalesce("ends", F.lit(0))).alias("ends"),
        F.max(F.greatest(F.coalesce("copies", F.lit(1)), F.coalesce("times", F.lit(1)))).alias("most"))
    whole = (F.size("gaps") == 0) & (F.col("heads") == 1) & (F.col("ends") == 1) & (F.col("most") == 1)
    return found.select("kind", F.col("pages").cast("bigint").alias("pages"), F.col("rows").cast("bigint").alias("rows"),
                        F.array_join("gaps", ",").alias("missing"), whole.alias("whole"))


# ---- binding ----------------------------------------------------------------

def _page_lines(kind: str, rows: DataFrame, node) -> DataFrame:
    """Pages of PAGE_ROWS rows of ``rows`` (k from 0 on, without gaps)."""
    number = F.floor(F.col("k") / PAGE_ROWS).cast("int")
    last = rows.agg(F.floor(F.max("k") / PAGE_ROWS).cast("int").alias("last"))
    pages = rows.groupBy(number.alias("number")).agg(F.array_sort(F.collect_list(F.struct("k", node.alias("node")))).alias("held"))
    pages = pages.join(F.broadcast(last), F.col("number") <= F.col("last"))  # one row
    cursor = lambda n: F.concat(F.lit(f"{kind}-"), n.cast("string"))
    edges = F.transform("held", lambda x: F.struct(x["node"].alias("node")))
    data = {"customers": F.struct(F.struct(edges.alias("edges")).alias("customers")),
            "members": F.struct(F.struct(F.struct(edges.alias("edges")).alias("products")).alias("collection")),
            "inventory": F.struct(F.struct(F.transform("held", lambda x: x["node"]).alias("nodes")).alias("inventoryItems"))}[kind]
    follow = F.when(F.col("number") < F.col("last"), cursor(F.col("number") + 1))
    return pages.select(F.lit(kind).alias("kind"), "number", F.to_json(F.struct(
        F.lit(kind).alias("kind"), cursor(F.col("number")).alias("cursor"), follow.alias("next"), data.alias("data"))).alias("value"))


def landed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of the three kinds (binding), landed as JSON Lines: customers,
    the items of the campaign's models as members of one collection, and the
    inventory items of the items; one page of the latter is lost."""
    text = lambda prefix, k: F.concat(F.lit(prefix), k.cast("string"))
    low = F.col("_low")
    cust = read_table(spark, d, "customer")
    cust = cust.join(F.broadcast(cust.agg(F.min("c_custkey").alias("_low"))), F.col("c_custkey") >= low)
    it = B.items(spark, d).select("item_key", "code", "description", "model")
    it = it.join(F.broadcast(it.agg(F.min("item_key").alias("_low"))), F.col("item_key") >= low)
    lines = [
        _page_lines("customers", cust.select((F.col("c_custkey") - low).alias("k"), "c_custkey", "c_name"), F.struct(
            text("cust-", F.col("c_custkey")).alias("id"), F.col("c_name").alias("displayName"),
            F.concat(text("c", F.col("c_custkey")), F.lit("@example.com")).alias("email"))),
        _page_lines("members", it.select((F.col("item_key") - low).alias("k"), "item_key", "description", "model"), F.struct(
            text("prod-", F.col("item_key")).alias("id"), F.col("description").alias("title"), F.col("model").alias("collection"))),
        _page_lines("inventory", it.select((F.col("item_key") - low).alias("k"), "code"), F.struct(
            F.concat(F.lit("inv-"), F.col("code")).alias("id"), F.col("code").alias("sku"), F.lit(True).alias("tracked"))),
    ]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pages/{uuid.uuid4().hex}"
    for k, df in enumerate(lines):
        lost = (F.col("kind") == LOST_PAGE[0]) & (F.col("number") == LOST_PAGE[1])
        df.filter(~lost).select("value").write.text(f"{path}/{k}")
    return spark.read.text([f"{path}/{k}" for k in range(len(lines))])


def page_chains(spark: SparkSession, d: str) -> DataFrame:
    """Registered form: the report of the landed chains."""
    return chain_report(read_pages(landed_pages(spark, d)))


def page_members(spark: SparkSession, d: str) -> DataFrame:
    """Registered form: all rows of the landed chains."""
    pages = read_pages(landed_pages(spark, d))
    parts = [page_rows(pages, kind).select(F.lit(kind).alias("kind"), "id", "label", "extra") for kind in SHAPES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
