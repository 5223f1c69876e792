"""Query registry: name → callable(spark, table_dir) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import bindings as B
from .plans import campaign as CP
from .plans import catalog as C
from .plans import cycles as CY
from .plans import feeds as FD
from .plans import flags as FL
from .plans import intake as IN
from .plans import nested as N
from .plans import outbox as OB
from .plans import pages as PG
from .plans import prices as P
from .plans import sales as SA
from .plans import scalars as SC
from .plans import texts as TX
from .plans import stock as S
from .streaming import stream_cycle as _stream_cycle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Page size of the registered page query, below the number of its rows.
PAGE_SIZE = 10


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- stock ----
register("stock_by_site")(lambda s, d: S.stock_by_site(s, d))
register("stock_rollup")(lambda s, d: S.stock_rollup(s, d))
register("stock_by_item")(lambda s, d: S.stock_by_item(s, d))
register("stock_delta")(lambda s, d: S.stock_delta(B.channel_levels(s, d), S.erp_stock(s, d)))
register("stock_zero_out")(lambda s, d: S.stock_zero_out(B.channel_levels(s, d), S.erp_stock(s, d)))
register("orderable_sizes")(lambda s, d: S.orderable_sizes(s, d))
register("orderable_delta")(lambda s, d: S.orderable_delta(B.channel_levels(s, d), S.orderable_sizes(s, d)))
register("orderable_zero_out")(lambda s, d: S.orderable_zero_out(B.channel_levels(s, d), S.orderable_sizes(s, d)))
register("stock_change_set")(lambda s, d: S.stock_change_set(B.channel_levels(s, d), S.erp_stock(s, d),
                                                             S.orderable_sizes(s, d)))
register("inactive_with_stock")(lambda s, d: S.inactive_with_stock(s, d))
register("inactive_other_sites")(lambda s, d: S.inactive_with_stock(s, d, other_sites=True))
register("variant_stock_split")(lambda s, d: S.variant_stock_split(B.channel_levels(s, d)))
register("distinct_counts")(lambda s, d: S.distinct_counts(s, d))

# -------------------------------------------------------------- catalog ----
for _n in ["item_master", "item_export_full", "item_texts", "item_seo", "items_active", "items_inactive",
           "price_list", "composition_flag", "scan_item", "scan_full"]:
    register(_n)(getattr(C, _n))

# ---------------------------------------------------- prices, texts, flags ----
_V = B.channel_variants
register("price_sides")(lambda s, d: P.price_sides(_V(s, d)))
register("price_delta")(lambda s, d: P.price_delta(_V(s, d), B.items(s, d)))
register("compare_price_delta")(lambda s, d: P.compare_price_delta(_V(s, d), B.items(s, d)))
register("split_ring_items")(lambda s, d: P.split_ring_items(_V(s, d)))
register("first_per_base")(lambda s, d: P.first_per_base(_V(s, d)))
register("ring_price_feed")(lambda s, d: P.ring_price_feed(_V(s, d), B.items(s, d), B.channel_levels(s, d)))
register("union_priority")(lambda s, d: P.price_change_priority(_V(s, d), B.items(s, d)))
register("feed_price")(lambda s, d: P.feed_price(P.ring_price_feed(_V(s, d), B.items(s, d), B.channel_levels(s, d))))
register("text_diff")(lambda s, d: TX.text_diff(TX.store_texts(s, d), TX.erp_texts(s, d)))
register("feed_text")(lambda s, d: TX.feed_text(TX.text_diff(TX.store_texts(s, d), TX.erp_texts(s, d))))
register("flag_orderable")(lambda s, d: FL.flag_orderable(B.channel_levels(s, d)))
register("flag_in_stock")(lambda s, d: FL.flag_in_stock(_V(s, d), FL.flag_orderable(B.channel_levels(s, d))))
register("ready_list")(lambda s, d: FL.ready_list(S.stock_by_site(s, d), _V(s, d)))

# ------------------------------------------------------------------ nested ----
for _n in ["jsonl_levels", "jsonl_variants", "jsonl_texts", "jsonl_metafields", "json_pages",
           "lookup_items", "lookup_sizes"]:
    register(_n)(getattr(N, _n))
register("lookup_sizes_unseen")(lambda s, d: N.lookup_sizes(s, d, ledger=N.lookup_ledger(s, d)))
register("page_limit")(lambda s, d: N.page_limit(s, d, first=PAGE_SIZE))
register("jsonl_quarantine")(N.jsonl_quarantine)
register("page_chains")(PG.page_chains)
register("page_members")(PG.page_members)
register("product_taxonomy")(N.product_taxonomy)
register("ffill_by_key")(lambda s, d: N.ffill_events(s, d))

# ------------------------------------------------------------------ cycles ----
register("row_diff")(lambda s, d: CY.cycle_row_diff(*CY.snapshots(s, d)))
register("cycle_flags")(lambda s, d: CY.cycle_flags(*CY.snapshots(s, d)))
register("cycle_diff")(lambda s, d: CY.cycle_diff(*CY.snapshots(s, d), rows_a_task=CY.ROWS_A_TASK))
register("cycle_next_base")(lambda s, d: CY.cycle_next_base(*CY.snapshots(s, d), rows_a_task=CY.ROWS_A_TASK))
register("cycle_bucketed")(CY.bucketed_next_base)
register("ledger_todo")(lambda s, d: CY.ledger_todo(*CY.ledger_sets(s, d)))
register("ledger_append")(lambda s, d: CY.ledger_append(
    CY.ledger_sets(s, d)[1], CY.ledger_todo(*CY.ledger_sets(s, d))))
register("audit_log")(lambda s, d: CY.audit_log(
    S.stock_delta(B.channel_levels(s, d), S.erp_stock(s, d)), "2024-01-01T00:00:00"))
register("csv_roundtrip")(CY.csv_roundtrip)

# ---------------------------------------------------------------- campaign ----
register("campaign_members")(CP.campaign_members)
register("campaign_candidates")(lambda s, d: CP.campaign_candidates(CP.campaign_members(s, d), _V(s, d)))
register("campaign_split")(lambda s, d: CP.campaign_split(CP.item_stock_ratio(s, d)))
register("badge_removal")(lambda s, d: CP.badge_removal(CP.item_stock_ratio(s, d), B.items(s, d)))
register("campaign_price")(lambda s, d: CP.campaign_price(
    s, CP.campaign_candidates(CP.campaign_members(s, d), _V(s, d)), B.items(s, d)))
register("feed_campaign_price")(lambda s, d: CP.feed_campaign_price(CP.campaign_price(
    s, CP.campaign_candidates(CP.campaign_members(s, d), _V(s, d)), B.items(s, d))))
register("metafield_cleanup")(lambda s, d: CP.metafield_cleanup(N.jsonl_metafields(s, d)))
register("feed_flags")(lambda s, d: CP.feed_flags(
    FL.flag_orderable(B.channel_levels(s, d)),
    FL.flag_in_stock(_V(s, d), FL.flag_orderable(B.channel_levels(s, d))),
    FL.ready_list(S.stock_by_site(s, d), _V(s, d)), B.items(s, d),
    CP.badge_removal(CP.item_stock_ratio(s, d), B.items(s, d)), CP.metafield_cleanup(N.jsonl_metafields(s, d)),
    CP.campaign_split(CP.item_stock_ratio(s, d)).filter("tagged"),
    CP.sale_changes(CP.campaign_members(s, d), CP.item_stock_ratio(s, d))))
register("feed_metafield_lookup")(lambda s, d: CP.feed_metafield_lookup(CP.badge_removal(CP.item_stock_ratio(s, d), B.items(s, d))))

# ------------------------------------------------------------------- sales ----
register("sales_fact")(lambda s, d: SA.sales_fact(s, d))

# ------------------------------------------------------- intake and feeds ----
_CS = lambda s, d: S.stock_change_set(B.channel_levels(s, d), S.erp_stock(s, d), S.orderable_sizes(s, d))
register("customer_class")(lambda s, d: IN.customer_class(IN.customers(s, d)))
register("intake_prepare")(IN.intake_prepare)
register("intake_new")(IN.intake_new)
register("activation_plan")(lambda s, d: IN.activation_plan(_V(s, d)))
register("publication_plan")(lambda s, d: IN.publication_plan(_V(s, d)))
register("feed_stock")(lambda s, d: FD.feed_stock(_CS(s, d)))
register("feed_activation")(lambda s, d: FD.feed_activation(_V(s, d), IN.ACTIVATION_LOCATIONS))
register("feed_create")(lambda s, d: FD.feed_create(IN.intake_new(s, d)))
register("feed_create_letters")(lambda s, d: FD.feed_create_letters(IN.intake_new(s, d)))
register("feed_create_listed")(lambda s, d: FD.feed_create_listed(IN.intake_new(s, d), IN.LISTED_SIZES))
register("feed_customer_delete")(lambda s, d: FD.feed_customer_delete(IN.customer_class(IN.customers(s, d))))
register("outbox_loop")(lambda s, d: OB.outbox_loop(s, _CS(s, d)))
register("feed_customer")(lambda s, d: FD.feed_customer(IN.customer_class(IN.customers(s, d))))
register("feed_delete")(lambda s, d: FD.feed_delete(_V(s, d), B.items(s, d)))
register("response_split")(lambda s, d: FD.response_split(FD.landed_responses(_CS(s, d))))
register("scalar_strings")(SC.scalar_strings)
register("scalar_bands")(SC.scalar_bands)
register("scalar_casts")(SC.scalar_casts)

# --------------------------------------------------------------- streaming ----
register("stream_cycle")(_stream_cycle)
