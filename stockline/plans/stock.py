"""Stock extracts and stock reconciliation.

Shuffle plan. Every reconciliation aggregates each side on exactly the
join key before joining, so (a) a hot key is combined map-side and
reaches the join as one row, and (b) the aggregate's hash partitioning
already satisfies the join's required distribution — the ERP side is not
shuffled a second time. Joins are plain equi-joins on two columns (no
concatenated keys); AQE picks broadcast at runtime only when a side's
measured size is under the threshold, else sort-merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import concat_blank, split_part
from ..operators import first_per_key
from . import bindings as B


def sellable_lines(spark: SparkSession, d: str, excluded_sites=None, excluded_accounts=None,
                   excluded_site_groups=None) -> DataFrame:
    """Stock lines that count as sellable (F3, F4): site and account not
    excluded, and the composite "site - group" not in the exclusion list."""
    sites = B.EXCLUDED_SITES if excluded_sites is None else excluded_sites
    accts = B.EXCLUDED_ACCOUNTS if excluded_accounts is None else excluded_accounts
    groups = B.EXCLUDED_SITE_GROUPS if excluded_site_groups is None else excluded_site_groups
    sl = B.stock_lines(spark, d)
    return sl.filter(~F.col("site").isin(sites) & ~F.col("account").isin(accts)
                     & ~concat_blank(F.col("site"), F.lit(" - "), F.col("stock_group")).isin(groups))


def stock_by_site(spark: SparkSession, d: str, literal_unlimited: bool = False) -> DataFrame:
    """Sellable stock by item × site × size × attributes × account.

    ``unlimited_quantity``: the reference compares two literals there, so
    it is always false (T12); ``literal_unlimited=True`` keeps that, the
    default applies the intended rule: orderable and no stock."""
    s = sellable_lines(spark, d)
    g = s.groupBy("code", "site", "group_name", "size_code", "orderable", "active", "price", "metal",
                  "account").agg(F.sum("qty").alias("_q"))
    qty = F.col("_q").cast("bigint")
    unlimited = F.lit(False) if literal_unlimited else (F.when(qty > 0, False).when(F.col("orderable"), True)
                                                        .otherwise(False))
    sized = F.col("group_name").isin("RING", "BAND")
    return g.select(
        "code", qty.alias("total_quantity"),
        B.site_warehouse_id(F.col("site")).alias("warehouse_id"),
        B.site_warehouse_name(F.col("site")).alias("warehouse_name"),
        F.when(sized, F.concat(F.col("code"), F.lit("-"), F.col("size_code").cast("string")))
        .otherwise(F.col("code")).alias("ref"),
        F.col("active").alias("is_active"), unlimited.alias("unlimited_quantity"),
        F.col("price").cast("bigint").alias("price_int"), "metal", "account")


def stock_rollup(spark: SparkSession, d: str) -> DataFrame:
    """E6 summed to code × warehouse × ref."""
    return (stock_by_site(spark, d).groupBy("code", "warehouse_id", "ref")
            .agg(F.sum("total_quantity").alias("total_quantity")))


def erp_stock(spark: SparkSession, d: str) -> DataFrame:
    """ERP side of the physical reconciliation: sellable stock of mapped
    warehouses, one row per (ref, warehouse_id). Aggregated straight from
    the lines on the join key (equal to E6 then A3, one shuffle fewer)."""
    s = sellable_lines(spark, d).filter(F.col("ref").isNotNull())  # NULL refs never match (T6)
    s = s.withColumn("warehouse_id", B.site_warehouse_id(F.col("site"))).filter(F.col("warehouse_id") != "")
    g = s.groupBy("ref", "warehouse_id").agg(F.sum("qty").cast("bigint").alias("total_quantity"))
    # code and warehouse name follow from the keys: derive them after the
    # aggregate (a string max would force a sort-based aggregate)
    names = F.create_map(*[x for v in B.SITE_WAREHOUSE.values() for x in (F.lit(v[0]), F.lit(v[1]))])
    return g.select("ref", "warehouse_id", "total_quantity", F.substring_index("ref", "-", 1).alias("code"),
                    F.try_element_at(names, F.col("warehouse_id")).alias("warehouse_name"))


def stock_by_item(spark: SparkSession, d: str) -> DataFrame:
    """Sellable stock per item code outside the other-sites set (A1)."""
    from .catalog import shop_stock
    return shop_stock(spark, d)


def _physical(levels: DataFrame, marker: str) -> DataFrame:
    return levels.filter(~F.col("location_name").contains(marker))


def _to_zero(levels: DataFrame, cols: list[str]) -> DataFrame:
    """Changes that take levels to 0; levels at 0 need none."""
    return levels.filter(F.col("qty") != 0).select(*cols, F.col("qty").alias("store_qty"),
                                                   F.lit(0).cast("bigint").alias("erp_qty"), (-F.col("qty")).alias("delta"))


def physical_changes(levels: DataFrame, erp: DataFrame, marker: str = B.ORDERABLE_MARKER) -> DataFrame:
    """Deltas and zero-outs of physical locations from ONE left join of the
    store levels to ERP stock on (sku, location): matched rows carry
    delta = erp − store (R1), unmatched rows go to 0 (R2); zero deltas are
    dropped. Both feeds share the join instead of an inner plus an anti."""
    lv = _physical(levels, marker).filter(F.col("variant_sku").isNotNull())
    e = erp.select(F.col("ref").alias("variant_sku"), F.col("warehouse_id").alias("location_id"),
                   "total_quantity", "warehouse_name", F.lit(True).alias("matched"))
    j = lv.join(e, ["variant_sku", "location_id"], "left")
    erp_qty = F.coalesce(F.col("total_quantity"), F.lit(0).cast("bigint"))
    out = j.select("variant_sku", "inventory_item_id", "location_id", "location_name",
                   F.col("qty").alias("store_qty"), "warehouse_name", erp_qty.alias("erp_qty"),
                   (erp_qty - F.col("qty")).alias("delta"),
                   F.coalesce(F.col("matched"), F.lit(False)).alias("matched"))
    return out.filter(F.col("delta") != 0)


def stock_delta(levels: DataFrame, erp: DataFrame, marker: str = B.ORDERABLE_MARKER) -> DataFrame:
    """Physical stock delta (R1, J11): store levels outside made-to-order
    locations that have an ERP row; delta = erp − store, non-zero only."""
    return physical_changes(levels, erp, marker).filter(F.col("matched")).drop("matched")


def stock_zero_out(levels: DataFrame, erp: DataFrame, marker: str = B.ORDERABLE_MARKER) -> DataFrame:
    """Store levels with no ERP row go to 0 (R2, J13): an anti join on the
    distinct ERP keys. The change set shares one left join instead."""
    lv = _physical(levels, marker).filter(F.col("variant_sku").isNotNull())
    keys = erp.select(F.col("ref").alias("variant_sku"), F.col("warehouse_id").alias("location_id")).distinct()
    return _to_zero(lv.join(keys, ["variant_sku", "location_id"], "left_anti"),
                    ["variant_sku", "inventory_item_id", "location_id", "location_name"])


def orderable_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Made-to-order stock (E8, J9, A5): fixed quantity, location by metal,
    sized families one row per size 10–22. The reference crosses every
    item with the 13-number series and de-duplicates on ref afterwards;
    emitting one row for unsized items gives the same rows without the
    13× fan-out and the de-duplication shuffle."""
    it = B.items(spark, d).filter(F.col("orderable"))
    sized = F.col("family").isin(B.SIZED_FAMILIES)
    e = it.select("code", "family", "metal", F.explode(
        F.when(sized, F.sequence(F.lit(B.SIZE_FIRST), F.lit(B.SIZE_LAST)))
        .otherwise(F.array(F.lit(None).cast("int")))).alias("size_code"))
    loc_id = F.coalesce(*[F.when(F.col("metal") == m, F.lit(v[0])) for m, v in B.ORDERABLE_LOCATION.items()],
                        F.lit(B.ORDERABLE_FALLBACK_LOCATION[0]))
    loc_nm = F.coalesce(*[F.when(F.col("metal") == m, F.lit(v[1])) for m, v in B.ORDERABLE_LOCATION.items()],
                        F.lit(B.ORDERABLE_FALLBACK_LOCATION[1]))
    return e.select("code", F.lit(B.ORDERABLE_QTY).cast("bigint").alias("total_quantity"),
                    loc_id.alias("warehouse_id"), loc_nm.alias("warehouse_name"),
                    B.ref_of(F.col("code"), F.col("family"), F.col("size_code")).alias("ref"), "metal")


def _orderable_store(levels: DataFrame, marker: str) -> DataFrame:
    lv = levels.filter(F.col("location_name").contains(marker))
    lv = lv.withColumn("metal", F.upper(split_part(F.col("location_name"), " - ", 1)))
    lv = lv.filter(F.col("variant_sku").isNotNull() & F.col("metal").isNotNull())
    return first_per_key(lv, ["variant_sku", "location_id", "metal"], ["level_id"])


def _orderable_erp(orderables: DataFrame) -> DataFrame:
    o = orderables.filter(F.col("ref").isNotNull() & (F.col("ref") != ""))
    o = o.select(F.col("ref").alias("variant_sku"), F.col("warehouse_id").alias("location_id"), "metal",
                 "total_quantity", "warehouse_name", "code")
    return first_per_key(o, ["variant_sku", "location_id", "metal"], ["code"])


def orderable_changes(levels: DataFrame, orderables: DataFrame, marker: str = B.ORDERABLE_MARKER) -> DataFrame:
    """Made-to-order deltas and zero-outs (R3, R4) from one left join. The
    key adds the metal read from the location name; both sides are first
    per key on the same key, so the aggregates' partitioning feeds the
    join without another shuffle."""
    erp = _orderable_erp(orderables).select("variant_sku", "location_id", "metal", "total_quantity",
                                            F.lit(True).alias("matched"))
    j = _orderable_store(levels, marker).join(erp, ["variant_sku", "location_id", "metal"], "left")
    erp_qty = F.coalesce(F.col("total_quantity"), F.lit(0).cast("bigint"))
    out = j.select("variant_sku", "inventory_item_id", "location_id", "location_name", "metal",
                   F.col("qty").alias("store_qty"), erp_qty.alias("erp_qty"), (erp_qty - F.col("qty")).alias("delta"),
                   F.coalesce(F.col("matched"), F.lit(False)).alias("matched"))
    return out.filter(F.col("delta") != 0)


def orderable_delta(levels: DataFrame, orderables: DataFrame, marker: str = B.ORDERABLE_MARKER) -> DataFrame:
    """Made-to-order delta."""
    return orderable_changes(levels, orderables, marker).filter(F.col("matched")).drop("matched")


def orderable_zero_out(levels: DataFrame, orderables: DataFrame, marker: str = B.ORDERABLE_MARKER) -> DataFrame:
    """Made-to-order levels with no ERP row go to 0 (R4), as an anti join."""
    keys = ["variant_sku", "location_id", "metal"]
    rest = _orderable_store(levels, marker).join(_orderable_erp(orderables).select(*keys), keys, "left_anti")
    return _to_zero(rest, ["variant_sku", "inventory_item_id", "location_id", "location_name", "metal"])


def stock_change_set(levels: DataFrame, erp: DataFrame, orderables: DataFrame,
                     marker: str = B.ORDERABLE_MARKER) -> DataFrame:
    """All stock changes with their apply phase (R5): made-to-order zero-out
    1, made-to-order 2, physical zero-out 3, physical 4. Two joins in all
    (one per location kind), not four."""
    cols = ["variant_sku", "inventory_item_id", "location_id", "store_qty", "erp_qty", "delta"]
    o = orderable_changes(levels, orderables, marker)
    p = physical_changes(levels, erp, marker)
    o = o.select(F.when(F.col("matched"), F.lit(2)).otherwise(F.lit(1)).cast("bigint").alias("phase"), *cols)
    p = p.select(F.when(F.col("matched"), F.lit(4)).otherwise(F.lit(3)).cast("bigint").alias("phase"), *cols)
    return o.unionByName(p)


def inactive_with_stock(spark: SparkSession, d: str, other_sites: bool = False,
                        site_set=("S4", "S5")) -> DataFrame:
    """Items neither orderable nor active that still hold stock (E9, E10;
    J4 + A4). ``other_sites`` flips the site filter from outside the set
    to inside it."""
    sl = B.stock_lines(spark, d)
    site_ok = F.col("site").isin(list(site_set))
    sl = sl.filter((site_ok if other_sites else ~site_ok) & ~F.col("account").isin(B.EXCLUDED_ACCOUNTS))
    y = sl.groupBy("code").agg(F.sum("qty").cast("bigint").alias("qty"))
    it = B.items(spark, d).filter(~F.col("orderable") & ~F.col("active"))
    j = it.join(y, "code", "inner")
    return j.select("code", F.coalesce(F.col("qty"), F.lit(0)).cast("bigint").alias("total_quantity"),
                    F.concat(F.col("code"), F.lit("-")).alias("ref"),
                    F.col("active").alias("is_active"), F.lit(False).alias("unlimited_quantity"))


def variant_stock_split(levels: DataFrame, marker: str = B.ORDERABLE_MARKER) -> DataFrame:
    """Physical stock per variant and whether it is zero (A7, C7): one
    aggregate instead of the reference's loop over ``head(1)``."""
    lv = _physical(levels, marker).filter(F.col("variant_sku").isNotNull() & (F.col("variant_sku") != ""))
    g = lv.groupBy("variant_id").agg(F.sum("qty").cast("bigint").alias("total_qty"))
    return g.withColumn("zero_stock", F.col("total_qty") == 0)


def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    """Report counts (A8, A9): rows, distinct codes and distinct refs of the
    ERP extract and of the store levels, one row per source. Rows are counted
    per (code, ref) first, so only one row of each is expanded for the two
    distinct counts."""
    def counts(source: str, df: DataFrame, code: F.Column, ref: str) -> DataFrame:
        pairs = df.select(code.alias("code"), F.col(ref).alias("ref")).groupBy("code", "ref").agg(F.count("*").alias("n"))
        return pairs.agg(F.lit(source).alias("source"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                         F.countDistinct("code").alias("n_codes"), F.countDistinct("ref").alias("n_refs"))
    return counts("erp", stock_by_site(spark, d), F.col("code"), "ref").unionByName(
        counts("store", B.channel_levels(spark, d), F.substring_index("variant_sku", "-", 1), "variant_sku"))
