"""Oracle SQL (DuckDB dialect) for every registered query.

The same test-table bindings as ``plans.bindings``, written as CTEs, so
the driver can run each Spark plan and its SQL side by side. Constants
come from the bindings module, never retyped. Traps handled here: casts
to integer go through ``trunc`` (DuckDB rounds, Spark truncates, T18);
money is rounded to 2 on both sides.
"""

from __future__ import annotations

from .plans import bindings as B


def _lst(xs) -> str:
    return ", ".join("'" + str(x).replace("'", "''") + "'" for x in xs)


def _case(expr: str, mapping: dict, default: str = "''") -> str:
    arms = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {arms} ELSE {default} END)"


WH_ID = _case("site", {k: v[0] for k, v in B.SITE_WAREHOUSE.items()})
WH_NAME = _case("site", {k: v[1] for k, v in B.SITE_WAREHOUSE.items()})

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


_SIZED = "(p_name LIKE '% ring' OR p_name LIKE '% rod')"
_FAMILY = "(CASE WHEN p_name LIKE '% ring' THEN 'AN' WHEN p_name LIKE '% rod' THEN 'AL' ELSE 'PX' END)"
_CODES = ["group_code", "subgroup_code", "colour_code", "sub_level", "price_table", "size_label", "note_1", "note_2", "class_code",
          "line_code"]


def _pad6(x: str) -> str:
    return f"CASE WHEN length(CAST({x} AS VARCHAR)) >= 6 THEN CAST({x} AS VARCHAR) ELSE lpad(CAST({x} AS VARCHAR), 6, '0') END"


cte("erp_items", [], f"""
SELECT p_partkey AS item_key, {_FAMILY} || {_pad6("p_partkey")} AS code, {_FAMILY} AS family,
  (CASE WHEN p_name LIKE '% ring' THEN 'RING' WHEN p_name LIKE '% rod' THEN 'BAND' ELSE p_type END) AS group_name,
  p_brand AS model, p_name AS description, p_type AS type, CAST(p_size AS BIGINT) AS size,
  (CASE WHEN p_type IN ({_lst(B.SILVER_TYPES)}) THEN 'SILVER' ELSE 'GOLD' END) AS metal,
  (p_size % 3 = 0) AS orderable, (p_size % 5 <> 0) AS active,
  CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * p_size, 2) AS DOUBLE) AS price, p_retailprice AS cost,
  CASE WHEN {_SIZED} THEN {_FAMILY} ELSE p_type END AS group_code,
  'G' || CAST(p_size % {B.SUBGROUPS} AS VARCHAR) AS subgroup_code,
  lpad(CAST(p_partkey % {B.COLOUR_CODES} AS VARCHAR), 2, '0') AS colour_code,
  'N' || CAST(p_partkey % 4 AS VARCHAR) AS sub_level, 'T' || CAST(p_size % 4 AS VARCHAR) AS price_table,
  CASE WHEN {_SIZED} THEN '' ELSE CAST(p_size AS VARCHAR) END AS size_label, 'Ref. ' || p_brand AS note_1,
  CASE WHEN p_partkey % 6 <> 0 THEN 'Lot ' || CAST(p_partkey % 100 AS VARCHAR) END AS note_2,
  'C' || CAST(p_partkey % 3 AS VARCHAR) AS class_code, substr(p_type, 1, 3) AS line_code,
  '{B.FINISHED_GROUP}' AS goods_group
FROM part UNION ALL
SELECT -s_suppkey, 'MP' || {_pad6("s_suppkey")}, 'MP', 'RAW', 'Brand#1', s_name, 'RAW', 0, 'GOLD', true, true, s_acctbal, s_acctbal,
  {", ".join("''" for _ in _CODES)}, CASE WHEN s_acctbal < 0 THEN 'SV' ELSE 'MP' END FROM supplier""")

cte("items", ["erp_items"], f"SELECT * FROM erp_items WHERE goods_group = '{B.FINISHED_GROUP}'")

cte("colours", [], "SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS colour_code, n_name AS colour_desc FROM nation")

cte("subgroups", ["erp_items"], f"""
SELECT DISTINCT group_code AS g, subgroup_code AS sg, group_code || ' / ' || subgroup_code AS subgroup_desc FROM erp_items
WHERE subgroup_code <> 'G{B.SUBGROUPS - 1}'""")

cte("collections", [], """
SELECT DISTINCT p_brand AS model, 'COLLECTION ' || upper(p_brand) AS collection_desc FROM part""")

cte("stock_lines", ["items"], f"""
SELECT i.code, i.family, i.group_name, i.metal, i.orderable, i.active, i.price,
  CAST(10 + l.l_linenumber % 13 AS BIGINT) AS size_code,
  CASE WHEN i.family IN ({_lst(B.SIZED_FAMILIES)}) THEN i.code || '-' || CAST(10 + l.l_linenumber % 13 AS VARCHAR)
       ELSE i.code END AS ref,
  'S' || CAST(l.l_suppkey % 6 AS VARCHAR) AS site, l.l_returnflag AS account, l.l_linestatus AS stock_group,
  l.l_quantity AS qty, l.l_shipdate AS ship_date
FROM lineitem l JOIN items i ON l.l_partkey = i.item_key""")

cte("sellable", ["stock_lines"], f"""
SELECT * FROM stock_lines
WHERE site NOT IN ({_lst(B.EXCLUDED_SITES)}) AND account NOT IN ({_lst(B.EXCLUDED_ACCOUNTS)})
  AND (site || ' - ' || stock_group) NOT IN ({_lst(B.EXCLUDED_SITE_GROUPS)})""")

cte("erp_stock", ["sellable"], f"""
SELECT ref, {WH_ID} AS warehouse_id, CAST(trunc(SUM(qty)) AS BIGINT) AS total_quantity,
  max(code) AS code, max({WH_NAME}) AS warehouse_name
FROM sellable WHERE {WH_ID} <> '' GROUP BY ref, {WH_ID}""")

_GOLD, _SILVER = B.ORDERABLE_LOCATION["GOLD"], B.ORDERABLE_LOCATION["SILVER"]
cte("channel_levels", ["stock_lines", "erp_stock", "items"], f"""
WITH early AS (
  SELECT ref, {WH_ID} AS location_id, CAST(trunc(SUM(qty)) AS BIGINT) AS qty FROM stock_lines
  WHERE site IN ({_lst(B.SITE_WAREHOUSE)}) AND account <> 'A' AND ship_date < TIMESTAMP '{B.CHANNEL_CUTOFF}'
  GROUP BY ref, {WH_ID}),
extra AS (
  SELECT e.ref, e.warehouse_id AS location_id, e.total_quantity AS qty FROM erp_stock e
  WHERE e.total_quantity % 4 = 0
    AND NOT EXISTS (SELECT 1 FROM early x WHERE x.ref = e.ref AND x.location_id = e.warehouse_id)),
phys AS (
  SELECT ref, location_id, {_case("location_id", {v[0]: v[1] for v in B.SITE_WAREHOUSE.values()}, "NULL")} AS location_name, qty
  FROM (SELECT * FROM early UNION ALL SELECT * FROM extra)),
orde AS (
  SELECT CASE WHEN i.family IN ({_lst(B.SIZED_FAMILIES)}) THEN i.code || '-' || CAST(s.size_code AS VARCHAR) ELSE i.code END AS ref,
    CASE WHEN i.metal = 'GOLD' THEN '{_GOLD[0]}' ELSE '{_SILVER[0]}' END AS location_id,
    CASE WHEN i.metal = 'GOLD' THEN '{_GOLD[1]}' ELSE '{_SILVER[1]}' END AS location_name,
    CAST(CASE WHEN i.item_key % 2 = 0 THEN {B.ORDERABLE_QTY} ELSE i.item_key % 5 END AS BIGINT) AS qty
  FROM items i, LATERAL (SELECT unnest(CASE WHEN i.family IN ({_lst(B.SIZED_FAMILIES)})
                                     THEN range({B.SIZE_FIRST}, {B.SIZE_LAST + 1}) ELSE [NULL] END) AS size_code) s
  WHERE i.size % 4 = 0 OR i.orderable)
SELECT 'lvl-' || ref || '@' || location_id AS level_id, ref AS variant_sku, 'var-' || ref AS variant_id,
  'inv-' || ref AS inventory_item_id, location_id, location_name, qty
FROM (SELECT * FROM phys UNION ALL SELECT * FROM orde)""")

cte("channel_variants", ["items"], f"""
SELECT 'var-' || sku AS variant_id, sku, coalesce(CAST(size_code AS VARCHAR), 'Default Title') AS title,
  CASE WHEN item_key % 50 = 0 THEN NULL WHEN item_key % 7 = 0
       THEN CAST(round(CAST(price AS DECIMAL(12,2)) * CAST(1.1 AS DECIMAL(3,1)), 2) AS DOUBLE) ELSE price END AS price,
  CASE WHEN item_key % 11 = 0 THEN NULL WHEN item_key % 3 <> 0 THEN price
       ELSE CAST(round(CAST(price AS DECIMAL(12,2)) * CAST(1.2 AS DECIMAL(3,1)), 2) AS DOUBLE) END AS compare_at_price,
  CAST(item_key % 6 AS BIGINT) AS inventory_quantity, 'prod-' || CAST(item_key AS VARCHAR) AS product_id,
  description AS product_title, CAST(n_var * (item_key % 6) AS BIGINT) AS total_inventory, CAST(n_var AS BIGINT) AS total_variants,
  CAST(item_key % 4 AS BIGINT) AS media_count, code AS sku_2
FROM (SELECT i.* REPLACE (trunc(i.price) AS price), s.size_code,
        CASE WHEN i.family IN ({_lst(B.SIZED_FAMILIES)}) THEN i.code || '-' || CAST(s.size_code AS VARCHAR) ELSE i.code END AS sku,
        CASE WHEN i.family IN ({_lst(B.SIZED_FAMILIES)}) THEN {B.SIZE_LAST - B.SIZE_FIRST + 1} ELSE 1 END AS n_var
      FROM items i, LATERAL (SELECT unnest(CASE WHEN i.family IN ({_lst(B.SIZED_FAMILIES)})
                                   THEN range({B.SIZE_FIRST}, {B.SIZE_LAST + 1}) ELSE [NULL] END) AS size_code) s)""")

cte("orderables", ["items"], f"""
SELECT i.code, CAST({B.ORDERABLE_QTY} AS BIGINT) AS total_quantity,
  CASE i.metal WHEN 'GOLD' THEN '{_GOLD[0]}' WHEN 'SILVER' THEN '{_SILVER[0]}' ELSE '{B.ORDERABLE_FALLBACK_LOCATION[0]}' END AS warehouse_id,
  CASE i.metal WHEN 'GOLD' THEN '{_GOLD[1]}' WHEN 'SILVER' THEN '{_SILVER[1]}' ELSE '{B.ORDERABLE_FALLBACK_LOCATION[1]}' END AS warehouse_name,
  CASE WHEN i.family IN ({_lst(B.SIZED_FAMILIES)}) THEN i.code || '-' || CAST(s.size_code AS VARCHAR) ELSE i.code END AS ref,
  i.metal
FROM items i, LATERAL (SELECT unnest(CASE WHEN i.family IN ({_lst(B.SIZED_FAMILIES)})
                                   THEN range({B.SIZE_FIRST}, {B.SIZE_LAST + 1}) ELSE [NULL] END) AS size_code) s
WHERE i.orderable""")

cte("store_orderable", ["channel_levels"], f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, upper(split_part(location_name, ' - ', 2)) AS metal,
    row_number() OVER (PARTITION BY variant_sku, location_id, upper(split_part(location_name, ' - ', 2)) ORDER BY level_id) AS rn
  FROM channel_levels WHERE location_name LIKE '%{B.ORDERABLE_MARKER}%')
WHERE rn = 1 AND variant_sku IS NOT NULL AND metal IS NOT NULL AND metal <> ''""")

cte("erp_orderable", ["orderables"], """
SELECT ref AS variant_sku, warehouse_id AS location_id, metal, total_quantity, warehouse_name, code
FROM orderables WHERE ref IS NOT NULL AND ref <> ''""")


def with_ctes(sql: str, needs: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return sql
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    if sql[:5].upper() == "WITH ":
        return f"WITH {body},\n{sql[5:]}"
    return f"WITH {body}\n{sql}"


SQL: dict[str, str] = {}


def q(name: str, needs: list[str], sql: str) -> None:
    SQL[name] = with_ctes(sql.strip(), needs)


# ---------------------------------------------------------------- stock ----
cte("stock_by_site", ["sellable"], f"""
SELECT code, CAST(trunc(SUM(qty)) AS BIGINT) AS total_quantity, {WH_ID} AS warehouse_id, {WH_NAME} AS warehouse_name,
  CASE WHEN group_name IN ('RING', 'BAND') THEN code || '-' || CAST(size_code AS VARCHAR) ELSE code END AS ref,
  active AS is_active,
  CASE WHEN CAST(trunc(SUM(qty)) AS BIGINT) > 0 THEN false WHEN orderable THEN true ELSE false END AS unlimited_quantity,
  CAST(trunc(price) AS BIGINT) AS price_int, metal, account
FROM sellable GROUP BY code, site, group_name, size_code, orderable, active, price, metal, account""")

q("stock_by_site", ["stock_by_site"], "SELECT * FROM stock_by_site")
q("stock_rollup", ["stock_by_site"], """
SELECT code, warehouse_id, ref, CAST(SUM(total_quantity) AS BIGINT) AS total_quantity
FROM stock_by_site GROUP BY code, warehouse_id, ref""")
cte("shop_stock", ["stock_lines"], f"""
SELECT code, CAST(trunc(SUM(qty)) AS BIGINT) AS stock_qty FROM stock_lines
WHERE site NOT IN ({_lst(B.OTHER_SITES)}) AND account NOT IN ({_lst(B.EXCLUDED_ACCOUNTS)}) GROUP BY code""")
q("stock_by_item", ["shop_stock"], "SELECT * FROM shop_stock")

_PHYS = f"location_name NOT LIKE '%{B.ORDERABLE_MARKER}%'"
cte("stock_delta", ["channel_levels", "erp_stock"], f"""
SELECT l.variant_sku, l.inventory_item_id, l.location_id, l.location_name, l.qty AS store_qty, e.warehouse_name,
  e.total_quantity AS erp_qty, e.total_quantity - l.qty AS delta
FROM channel_levels l JOIN erp_stock e ON l.variant_sku = e.ref AND l.location_id = e.warehouse_id
WHERE l.{_PHYS} AND l.variant_sku IS NOT NULL AND e.total_quantity - l.qty <> 0""")
cte("stock_zero_out", ["channel_levels", "erp_stock"], f"""
SELECT l.variant_sku, l.inventory_item_id, l.location_id, l.location_name, l.qty AS store_qty,
  CAST(0 AS BIGINT) AS erp_qty, -l.qty AS delta
FROM channel_levels l
WHERE l.{_PHYS} AND l.variant_sku IS NOT NULL AND -l.qty <> 0
  AND NOT EXISTS (SELECT 1 FROM erp_stock e WHERE e.ref = l.variant_sku AND e.warehouse_id = l.location_id)""")
cte("orderable_delta", ["store_orderable", "erp_orderable"], """
SELECT s.variant_sku, s.inventory_item_id, s.location_id, s.location_name, s.metal, s.qty AS store_qty,
  e.total_quantity AS erp_qty, e.total_quantity - s.qty AS delta
FROM store_orderable s JOIN erp_orderable e USING (variant_sku, location_id, metal)
WHERE e.total_quantity - s.qty <> 0""")
cte("orderable_zero_out", ["store_orderable", "erp_orderable"], """
SELECT s.variant_sku, s.inventory_item_id, s.location_id, s.location_name, s.metal, s.qty AS store_qty,
  CAST(0 AS BIGINT) AS erp_qty, -s.qty AS delta
FROM store_orderable s
WHERE -s.qty <> 0 AND NOT EXISTS (SELECT 1 FROM erp_orderable e
  WHERE e.variant_sku = s.variant_sku AND e.location_id = s.location_id AND e.metal = s.metal)""")
for _n in ["stock_delta", "stock_zero_out", "orderable_delta", "orderable_zero_out"]:
    q(_n, [_n], f"SELECT * FROM {_n}")
q("orderable_sizes", ["orderables"], "SELECT * FROM orderables")
_CS = "variant_sku, inventory_item_id, location_id, store_qty, erp_qty, delta"
cte("stock_change_set", ["orderable_zero_out", "orderable_delta", "stock_zero_out", "stock_delta"], f"""
SELECT CAST(1 AS BIGINT) AS phase, {_CS} FROM orderable_zero_out UNION ALL
SELECT CAST(2 AS BIGINT), {_CS} FROM orderable_delta UNION ALL
SELECT CAST(3 AS BIGINT), {_CS} FROM stock_zero_out UNION ALL
SELECT CAST(4 AS BIGINT), {_CS} FROM stock_delta""")
q("stock_change_set", ["stock_change_set"], "SELECT * FROM stock_change_set")


def _inactive(inside: bool) -> str:
    op = "IN" if inside else "NOT IN"
    return f"""
SELECT i.code, CAST(coalesce(y.qty, 0) AS BIGINT) AS total_quantity, i.code || '-' AS ref,
  i.active AS is_active, false AS unlimited_quantity
FROM items i JOIN (SELECT code, CAST(trunc(SUM(qty)) AS BIGINT) AS qty FROM stock_lines
  WHERE site {op} ('S4', 'S5') AND account NOT IN ({_lst(B.EXCLUDED_ACCOUNTS)}) GROUP BY code) y ON i.code = y.code
WHERE NOT i.orderable AND NOT i.active"""


q("inactive_with_stock", ["items", "stock_lines"], _inactive(False))
q("inactive_other_sites", ["items", "stock_lines"], _inactive(True))
q("variant_stock_split", ["channel_levels"], f"""
SELECT variant_id, CAST(SUM(qty) AS BIGINT) AS total_qty, SUM(qty) = 0 AS zero_stock
FROM channel_levels WHERE {_PHYS} AND variant_sku IS NOT NULL AND variant_sku <> '' GROUP BY variant_id""")
q("distinct_counts", ["stock_by_site", "channel_levels"], """
SELECT 'erp' AS source, count(*) AS n_rows, count(DISTINCT code) AS n_codes, count(DISTINCT ref) AS n_refs FROM stock_by_site
UNION ALL
SELECT 'store', count(*), count(DISTINCT split_part(variant_sku, '-', 1)), count(DISTINCT variant_sku) FROM channel_levels""")


# -------------------------------------------------------------- catalog ----
from .plans import catalog as C  # noqa: E402


def _bands() -> str:
    arms = []
    for m, lst in C.PRICE_BANDS.items():
        for bound, label in lst:
            cond = f"metal = '{m}'" if bound is None else f"price <= {bound} AND metal = '{m}'"
            arms.append(f"WHEN {cond} THEN '{label}'")
    return "(CASE " + " ".join(arms) + " ELSE '' END)"


cte("item_base", ["items", "collections", "shop_stock", "colours", "subgroups"], f"""
SELECT i.*, c.collection_desc, s.stock_qty, colours.colour_desc, subgroup_desc,
  CAST(trunc(i.price) AS BIGINT) AS price_int, {_bands()} AS price_band,
  CASE WHEN i.orderable THEN '{C.YES}' ELSE '{C.NO}' END AS orderable_text,
  CASE WHEN i.active THEN '{C.ACTIVE_TXT}' ELSE '{C.INACTIVE_TXT}' END AS status_text,
  CAST(CASE WHEN s.stock_qty > 0 THEN s.stock_qty ELSE 0 END AS BIGINT) AS stock,
  CASE WHEN i.orderable THEN '{C.FINAL_ACTIVE}' WHEN s.stock_qty > 0 THEN '{C.FINAL_ACTIVE}' ELSE '{C.FINAL_INACTIVE}' END AS final_status,
  CASE WHEN c.collection_desc LIKE '%{C.COLLECTION_WORD}%' THEN replace(c.collection_desc, '{C.COLLECTION_WORD}', '')
       ELSE c.collection_desc END AS collection
FROM items i JOIN collections c ON i.model = c.model LEFT JOIN shop_stock s ON i.code = s.code
LEFT JOIN colours ON colours.colour_code = i.colour_code LEFT JOIN subgroups ON g = i.group_code AND sg = i.subgroup_code""")
_MASTER = ", ".join(C.MASTER_COLS)
q("item_master", ["item_base"], f"SELECT {_MASTER} FROM item_base WHERE price > 1 ORDER BY model, group_name, code")
q("item_export_full", ["item_base"], f"""
SELECT model, collection, group_code, group_name, subgroup_code, subgroup_desc, code, description,
  round(CASE WHEN cost = 0 THEN NULL ELSE price / cost END, 2) AS markup, round(cost, 2) AS cost,
  CAST(round(price, 0) AS BIGINT) AS price_dec, price_band, goods_group, metal,
  colour_code, colour_desc, sub_level, price_table, size_label,
  '{C.PHOTO_BASE_URL}' || code || '.JPG' AS photo_url, orderable_text, status_text, stock, final_status,
  CAST(DATE '1995-01-01' + CAST(item_key % 3650 AS INTEGER) AS DATE) AS inclusion_date, round(size * CAST(0.37 AS DOUBLE), 2) AS weight, class_code, line_code
FROM item_base WHERE colour_desc IS NOT NULL AND subgroup_desc IS NOT NULL""")
TITLE = ("array_to_string(list_transform(range(1, length({x}) + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches("
         "substr(lower({x}), i - 1, 1), '\\p{{L}}') THEN upper(substr(lower({x}), i, 1)) ELSE substr(lower({x}), i, 1) END), '')")
q("item_texts", ["item_base"], f"""
SELECT {_MASTER}, {TITLE.format(x='description')} AS title,
  {TITLE.format(x="(type || ' ' || description)")} AS title_2, d.text AS description_text, d.lang,
  e.text AS description_text_2, e.lang AS lang_2, concat_ws(' ', type, metal) AS composition, sub_level AS cluster
FROM item_base b LEFT JOIN documents d ON d.doc_id = b.item_key
LEFT JOIN documents e ON e.doc_id = b.item_key + {C.SECOND_TEXT} WHERE price > 1""")
q("item_seo", ["item_base"], f"""
SELECT {_MASTER}, collection,
  CASE group_name {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.TAXONOMY.items())} ELSE '{C.TAXONOMY_DEFAULT}' END AS taxonomy_code,
  CASE WHEN description LIKE '%{C.KEYWORD}%' THEN '{C.KEYWORD.upper()}' ELSE '' END AS keyword
FROM item_base WHERE price > 1""")
q("items_active", ["item_base"], f"""
SELECT {_MASTER} FROM item_base WHERE price > 1 AND final_status = '{C.FINAL_ACTIVE}'
  AND model NOT IN ({_lst(C.ACTIVE_EXCLUDED_MODELS)})""")
q("items_inactive", ["item_base"], f"""
SELECT {_MASTER} FROM item_base WHERE price > 1 AND final_status = '{C.FINAL_INACTIVE}'
  AND model NOT IN ({_lst(C.INACTIVE_EXCLUDED_MODELS)})""")
q("price_list", ["items", "stock_lines"], """
SELECT i.code, i.code || '-' || coalesce(CAST(t.size_code AS VARCHAR), '') AS ref, CAST(trunc(i.price) AS BIGINT) AS price_int
FROM items i LEFT JOIN stock_lines t ON i.code = t.code""")
q("composition_flag", ["items"], f"""
SELECT DISTINCT i.code, 'Plated' AS formation
FROM lineitem l JOIN items i ON l.l_partkey = i.item_key
WHERE l.l_linenumber % 2 = 0 AND upper(i.type) || ' PLATING' LIKE '%PROMO%'
  AND i.code NOT LIKE 'CO%' AND i.code NOT IN ({_lst(C.COMPOSITION_EXCLUDED)})""")
q("scan_item", ["items"], "SELECT * FROM items")
q("scan_full", [], "SELECT * FROM part")


# ---------------------------------------------------- prices, texts, flags ----
_RING = "substr({x}, 1, 2) IN ('AN', 'AL')"
cte("price_sides", ["channel_variants"], """
SELECT sku_2 AS sku, variant_id, product_id, price, compare_at_price FROM channel_variants
WHERE product_id IS NOT NULL AND product_id <> ''""")
q("price_sides", ["price_sides"], "SELECT * FROM price_sides")
cte("erp_prices", ["items"], "SELECT code, trunc(price) AS price FROM items WHERE price > 1")
cte("price_delta", ["price_sides", "erp_prices"], """
SELECT v.sku, v.variant_id, v.product_id, v.price, i.price AS erp_price, round(i.price - v.price, 2) AS delta
FROM price_sides v LEFT JOIN erp_prices i ON i.code = v.sku
WHERE (round(i.price - v.price, 2) <> 0 OR v.price IS NULL) AND i.price IS NOT NULL""")
q("price_delta", ["price_delta"], "SELECT * FROM price_delta")
cte("compare_price_delta", ["price_sides", "erp_prices"], """
SELECT v.sku, v.variant_id, v.product_id, i.price AS compare_at_price, i.price AS erp_price, round(i.price - v.price, 2) AS delta
FROM price_sides v LEFT JOIN erp_prices i ON i.code = v.sku
WHERE i.price IS NOT NULL AND (v.compare_at_price IS NULL OR v.compare_at_price <> i.price)""")
q("compare_price_delta", ["compare_price_delta"], "SELECT * FROM compare_price_delta")
q("split_ring_items", ["channel_variants"], f"""
SELECT sku, {_RING.format(x='sku')} AS is_ring, regexp_matches(sku, '^(AN|AL)') AS is_ring_rx,
  (sku LIKE 'AN%' OR sku LIKE 'AL%') AS is_ring_like FROM channel_variants""")
q("first_per_base", ["channel_variants"], """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sku_2 ORDER BY sku) AS rn FROM channel_variants) WHERE rn = 1""")
cte("ring_price_feed", ["price_delta", "channel_levels"], f"""
WITH rings AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY variant_id) AS rn
               FROM price_delta WHERE {_RING.format(x='sku')}) WHERE rn = 1),
inv AS (SELECT variant_sku, variant_id, split_part(variant_sku, '-', 1) AS sku_2 FROM (
          SELECT *, row_number() OVER (PARTITION BY variant_sku ORDER BY level_id) AS rn FROM channel_levels
          WHERE variant_sku IS NOT NULL AND variant_sku <> '') WHERE rn = 1),
u AS (SELECT inv.variant_sku AS sku, inv.variant_id, r.product_id, r.price, r.erp_price, r.delta, 0 AS src
      FROM inv JOIN rings r ON r.sku = inv.sku_2
      UNION ALL
      SELECT sku, variant_id, product_id, price, erp_price, delta, 1 AS src FROM price_delta WHERE NOT {_RING.format(x='sku')})
SELECT sku, variant_id, product_id, price, erp_price, delta FROM (
  SELECT *, row_number() OVER (PARTITION BY sku ORDER BY src, variant_id) AS rn FROM u) WHERE rn = 1""")
q("ring_price_feed", ["ring_price_feed"], "SELECT * FROM ring_price_feed")
q("union_priority", ["price_delta", "compare_price_delta"], """
SELECT variant_id, sku, erp_price, change FROM (
  SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY src, sku, erp_price) AS rn FROM (
    SELECT variant_id, sku, erp_price, 'price' AS change, 0 AS src FROM price_delta
    UNION ALL SELECT variant_id, sku, erp_price, 'compare_at_price', 1 FROM compare_price_delta)) WHERE rn = 1""")
q("feed_price", ["ring_price_feed"], """
SELECT sku, variant_id, to_json({'productId': product_id, 'variants': [{'id': variant_id, 'price': printf('%.2f', erp_price)}]})
  AS payload FROM ring_price_feed""")
_NORM = "coalesce(trim(regexp_replace({x}, '\\s+', ' ', 'g')), '')"
q("text_diff", [], f"""
WITH s AS (SELECT doc_id AS sku, CASE WHEN doc_id % 11 = 0 THEN source || ' old' ELSE source END AS title,
             CASE WHEN doc_id % 7 = 0 THEN text || ' extra' ELSE chr(10) || replace(text, ' ', '  ') || chr(9) END AS description,
             CASE WHEN doc_id % 13 = 0 THEN NULL ELSE lang END AS composition FROM documents),
e AS (SELECT doc_id AS sku, source AS title, text AS description, lang AS composition FROM documents),
j AS (SELECT s.sku, s.title, s.description, s.composition,
        {_NORM.format(x='s.title')} <> {_NORM.format(x='e.title')} AS title_diff,
        {_NORM.format(x='s.description')} <> {_NORM.format(x='e.description')} AS description_diff,
        {_NORM.format(x='s.composition')} <> {_NORM.format(x='e.composition')} AS composition_diff,
        e.title AS new_title, e.description AS new_description, e.composition AS new_composition
      FROM s LEFT JOIN e ON s.sku = e.sku)
SELECT * FROM j WHERE (title_diff OR description_diff OR composition_diff)
  AND (new_title IS NOT NULL OR new_description IS NOT NULL OR new_composition IS NOT NULL)""")
_G, _S = B.ORDERABLE_LOCATION["GOLD"], B.ORDERABLE_LOCATION["SILVER"]
cte("flag_orderable", ["channel_levels"], f"""
SELECT variant_sku, variant_id,
  CAST(SUM(CASE WHEN location_name = '{_G[1]}' THEN qty ELSE 0 END) AS BIGINT) AS orderable_gold,
  CAST(SUM(CASE WHEN location_name = '{_S[1]}' THEN qty ELSE 0 END) AS BIGINT) AS orderable_silver,
  SUM(CASE WHEN location_name = '{_G[1]}' THEN qty ELSE 0 END) + SUM(CASE WHEN location_name = '{_S[1]}' THEN qty ELSE 0 END) > 0 AS is_orderable
FROM channel_levels
WHERE variant_sku IS NOT NULL AND variant_sku <> '' AND variant_id IS NOT NULL AND location_id IN ('{_G[0]}', '{_S[0]}')
GROUP BY variant_sku, variant_id""")
q("flag_orderable", ["flag_orderable"], "SELECT * FROM flag_orderable")
q("flag_in_stock", ["channel_variants", "flag_orderable"], f"""
SELECT v.variant_id, v.sku, v.product_id, v.inventory_quantity, f.is_orderable,
  CASE WHEN (NOT f.is_orderable AND v.inventory_quantity = 0) OR (f.is_orderable AND v.inventory_quantity = {B.ORDERABLE_QTY})
       THEN false ELSE true END AS in_stock
FROM channel_variants v JOIN flag_orderable f ON v.variant_id = f.variant_id""")
q("ready_list", ["stock_by_site", "channel_variants"], """
WITH fv AS (SELECT sku_2, sku, product_id FROM (SELECT *, row_number() OVER (PARTITION BY sku_2 ORDER BY sku) AS rn
            FROM channel_variants) WHERE rn = 1),
j AS (SELECT c.code, fv.sku_2, fv.product_id FROM (SELECT DISTINCT code FROM stock_by_site) c JOIN fv ON c.code = fv.sku_2)
SELECT code, sku_2, product_id FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY code) AS rn FROM j) WHERE rn = 1""")


# ------------------------------------------------------------------ nested ----
q("jsonl_levels", ["channel_levels", "channel_variants"], """
SELECT l.level_id, v.sku, v.product_id, v.product_title, v.total_variants, 'inv-' || v.sku AS inventory_item_id,
  v.variant_id, v.sku AS variant_sku, v.title AS variant_title, l.location_id, l.location_name, l.qty,
  split_part(v.sku, '-', 1) AS sku_2
FROM channel_levels l JOIN channel_variants v ON l.variant_id = v.variant_id""")
_VCOLS = ("variant_id, sku, title, price, compare_at_price, inventory_quantity, product_id, product_title, "
          "total_inventory, total_variants, media_count, split_part(sku, '-', 1) AS sku_2")
q("jsonl_variants", ["channel_variants"], f"SELECT {_VCOLS} FROM channel_variants")
q("jsonl_texts", ["channel_variants"], f"""
SELECT {_VCOLS}, d.text AS description, CASE WHEN k % 3 = 0 THEN NULL ELSE d.lang END AS metafield_value
FROM (SELECT *, CAST(split_part(product_id, '-', 2) AS BIGINT) AS k FROM channel_variants) v
LEFT JOIN documents d ON d.doc_id = v.k""")
q("jsonl_metafields", ["items"], """
SELECT 'prod-' || CAST(item_key AS VARCHAR) AS product_id, description AS title,
  'mf-' || CAST(item_key AS VARCHAR) || '-c' AS metafield_id, 'composition' AS key, type AS value FROM items WHERE item_key % 9 <> 0
UNION ALL
SELECT 'prod-' || CAST(item_key AS VARCHAR), description, 'mf-' || CAST(item_key AS VARCHAR) || '-m', 'metal', metal FROM items WHERE item_key % 9 <> 0
UNION ALL
SELECT 'prod-' || CAST(item_key AS VARCHAR), description, NULL, NULL, NULL FROM items WHERE item_key % 9 = 0""")
cte("json_pages", [], """
SELECT 'col-' || CAST(num AS VARCHAR) AS id, model AS title, lower(replace(model, '#', '-')) AS handle,
  '2024-01-01T00:00:00Z' AS updated_at, n AS products_count,
  CASE WHEN num % 2 = 0 THEN 'BEST_SELLING' ELSE 'MANUAL' END AS sort_order
FROM (SELECT p_brand AS model, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS num, count(*) AS n FROM part GROUP BY p_brand)""")
q("json_pages", ["json_pages"], "SELECT * FROM json_pages")
q("page_limit", ["json_pages"], "SELECT * FROM json_pages ORDER BY id LIMIT 10")
q("lookup_items", ["items", "channel_variants"], """
SELECT i.code, v.product_id, v.variant_id, v.sku AS variant_sku,
  CASE WHEN v.sku_2 IS NULL THEN NULL ELSE 'https://cdn.example/' || v.sku_2 || '-1.jpg' END AS image_url,
  CASE WHEN v.product_id IS NULL THEN 'not in channel' ELSE 'found' END AS status
FROM items i LEFT JOIN (SELECT * FROM channel_variants WHERE CAST(split_part(product_id, '-', 2) AS BIGINT) % 10 <> 3) v
  ON i.code = v.sku_2""")
q("lookup_sizes", ["items", "channel_variants"], f"""
SELECT g.code, CAST(g.size AS BIGINT) AS size, g.sku, v.variant_id,
  CASE WHEN v.variant_id IS NOT NULL THEN 'inv-' || g.sku END AS inventory_item_id, v.variant_id IS NOT NULL AS found
FROM (SELECT code, s.size, code || '-' || CAST(s.size AS VARCHAR) AS sku
      FROM items, (SELECT unnest(range({B.SIZE_FIRST}, {B.SIZE_LAST + 1})) AS size) s
      WHERE family IN ({_lst(B.SIZED_FAMILIES)})) g
LEFT JOIN (SELECT * FROM channel_variants WHERE title <> '22') v ON v.sku = g.sku""")
q("lookup_sizes_unseen", ["items", "channel_variants"], f"""
SELECT g.code, CAST(g.size AS BIGINT) AS size, g.sku, v.variant_id,
  CASE WHEN v.variant_id IS NOT NULL THEN 'inv-' || g.sku END AS inventory_item_id, v.variant_id IS NOT NULL AS found
FROM (SELECT code, s.size, code || '-' || CAST(s.size AS VARCHAR) AS sku
      FROM items, (SELECT unnest(range({B.SIZE_FIRST}, {B.SIZE_LAST + 1})) AS size) s
      WHERE family IN ({_lst(B.SIZED_FAMILIES)}) AND item_key % 3 <> 0) g
LEFT JOIN (SELECT * FROM channel_variants WHERE title <> '22') v ON v.sku = g.sku""")
q("ffill_by_key", [], """
SELECT user_id, event_id, last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM events""")


# ------------------------------------------------------------------ cycles ----
cte("snap_today", [], """
SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 10 <> 0""")
cte("snap_base", [], """
SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status,
  o_totalprice AS price FROM orders WHERE o_orderkey % 10 <> 1""")
_NSE = ("{a}.order_key IS NOT DISTINCT FROM {b}.order_key AND {a}.status IS NOT DISTINCT FROM {b}.status "
        "AND {a}.price IS NOT DISTINCT FROM {b}.price")
q("row_diff", ["snap_today", "snap_base"], f"""
SELECT * FROM snap_today t WHERE NOT EXISTS (SELECT 1 FROM snap_base b WHERE {_NSE.format(a='t', b='b')})""")
q("cycle_flags", ["snap_today", "snap_base"], f"""
SELECT *, true AS is_active FROM snap_today t WHERE NOT EXISTS (SELECT 1 FROM snap_base b WHERE {_NSE.format(a='t', b='b')})
UNION ALL
SELECT *, false FROM snap_base b WHERE NOT EXISTS (SELECT 1 FROM snap_today t WHERE {_NSE.format(a='t', b='b')})""")
cte("key_changes", ["snap_today", "snap_base"], """
SELECT coalesce(t.order_key, b.order_key) AS order_key,
  CASE WHEN b.order_key IS NULL THEN t.status ELSE b.status END AS status,
  CASE WHEN b.order_key IS NULL THEN t.price ELSE b.price END AS price,
  CASE WHEN b.order_key IS NULL THEN 'enter' WHEN t.order_key IS NULL THEN 'leave' ELSE 'keep' END AS change
FROM snap_today t FULL JOIN snap_base b ON t.order_key = b.order_key""")
q("cycle_diff", ["key_changes"], "SELECT * FROM key_changes WHERE change <> 'keep'")
q("cycle_next_base", ["key_changes"], "SELECT order_key, status, price FROM key_changes WHERE change <> 'leave'")
q("ledger_todo", ["items"], "SELECT code FROM items WHERE item_key % 4 <> 0 AND item_key % 9 <> 0")
q("ledger_append", ["items"], """
SELECT code FROM items WHERE item_key % 4 = 0 UNION ALL SELECT code FROM items WHERE item_key % 4 <> 0 AND item_key % 9 <> 0""")
q("audit_log", ["stock_delta"], "SELECT *, '2024-01-01T00:00:00' AS run_ts FROM stock_delta")
q("csv_roundtrip", ["channel_variants"], "SELECT * FROM channel_variants")

# ---------------------------------------------------------------- campaign ----
from .plans import campaign as CP  # noqa: E402

_MEMBER_MODELS = [m for lst in CP.MEMBER_LISTS for m in lst]
cte("campaign_members", ["items"], f"""
SELECT DISTINCT 'prod-' || CAST(item_key AS VARCHAR) AS product_id FROM items
WHERE model IN ({_lst(_MEMBER_MODELS)}) AND item_key % {CP.EXCLUDED_PRODUCT_MOD} <> 0""")
q("campaign_members", ["campaign_members"], "SELECT * FROM campaign_members")
cte("campaign_candidates", ["campaign_members", "channel_variants"], """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY sku) AS rn
  FROM channel_variants WHERE product_id IN (SELECT product_id FROM campaign_members)) WHERE rn = 1""")
q("campaign_candidates", ["campaign_candidates"], "SELECT * FROM campaign_candidates")
cte("item_stats", [], """
SELECT l_partkey AS item_key, CAST(CASE WHEN l_partkey % 11 = 0 THEN 0 WHEN l_partkey % 5 = 0 THEN 5 * count(*)
  ELSE trunc(SUM(l_quantity)) END AS BIGINT) AS total_inventory, count(*) AS total_variants
FROM lineitem GROUP BY l_partkey""")
_R = "CAST(total_inventory AS DOUBLE) / CAST(total_variants AS DOUBLE)"
_FIVE = f"coalesce({_R} = {CP.TARGET_RATIO}, false)"
q("campaign_split", ["item_stats"], f"""
SELECT item_key, total_inventory, total_variants, round({_R}, 4) AS ratio, NOT {_FIVE} AS tagged
FROM item_stats WHERE total_inventory <> 0""")
cte("badge_removal", ["item_stats", "items"], f"""
SELECT * FROM (SELECT s.item_key, i.orderable,
  CASE WHEN NOT i.orderable THEN 'not orderable' WHEN s.total_inventory = 0 THEN 'no stock' WHEN {_FIVE} THEN 'ratio' END AS reason
  FROM item_stats s JOIN items i ON s.item_key = i.item_key) WHERE reason IS NOT NULL""")
q("badge_removal", ["badge_removal"], "SELECT * FROM badge_removal")
_RULES = ", ".join(f"('{m}', {r}, '{o}')" for m, r, o in CP.CAMPAIGN_RULES)
cte("campaign_price", ["campaign_candidates", "items"], f"""
SELECT c.sku, c.variant_id, c.product_id, c.compare_at_price AS list_price,
  CAST(coalesce(r.rate, {CP.DEFAULT_RATE}) AS BIGINT) AS rate, coalesce(r.on_order, 'Nao') AS on_order,
  CAST(round(CAST(c.compare_at_price AS DECIMAL(12,2))
             * (CAST(100 - coalesce(r.rate, {CP.DEFAULT_RATE}) AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2))), 2) AS DOUBLE) AS campaign_price
FROM campaign_candidates c JOIN items i ON i.code = c.sku_2
LEFT JOIN (VALUES {_RULES}) r(model, rate, on_order) ON r.model = i.model
WHERE NOT coalesce(i.description LIKE '%{CP.EXCLUDED_TITLE_WORD}%', false)""")
q("campaign_price", ["campaign_price"], "SELECT * FROM campaign_price")
q("feed_campaign_price", ["campaign_price"], """
SELECT variant_id, 'apply' AS mode, to_json({'input': {'id': variant_id, 'price': printf('%.2f', campaign_price)}}) AS payload
FROM campaign_price WHERE list_price IS NOT NULL
UNION ALL
SELECT variant_id, 'restore', to_json({'input': {'id': variant_id, 'price': printf('%.2f', list_price)}})
FROM campaign_price WHERE list_price IS NOT NULL""")
cte("metafield_cleanup", ["items"], """
SELECT 'mf-' || CAST(item_key AS VARCHAR) || '-' || sfx AS metafield_id, 'prod-' || CAST(item_key AS VARCHAR) AS product_id,
  CASE sfx WHEN 'c' THEN 'composition' ELSE 'metal' END AS key
FROM items, (VALUES ('c'), ('m')) k(sfx) WHERE item_key % 9 <> 0""")
q("metafield_cleanup", ["metafield_cleanup"], "SELECT * FROM metafield_cleanup")
cte("campaign_split", ["item_stats"], f"""
SELECT item_key, NOT {_FIVE} AS tagged FROM item_stats WHERE total_inventory <> 0""")
q("feed_flags", ["flag_orderable", "channel_variants", "stock_by_site", "items", "badge_removal", "metafield_cleanup", "campaign_split",
                 "campaign_members", "item_stats"], f"""
WITH fis AS (SELECT v.variant_id, CASE WHEN (NOT f.is_orderable AND v.inventory_quantity = 0)
                OR (f.is_orderable AND v.inventory_quantity = {B.ORDERABLE_QTY}) THEN false ELSE true END AS in_stock
             FROM channel_variants v JOIN flag_orderable f ON v.variant_id = f.variant_id),
fv AS (SELECT sku_2, sku, product_id FROM (SELECT *, row_number() OVER (PARTITION BY sku_2 ORDER BY sku) AS rn
       FROM channel_variants) WHERE rn = 1),
rl AS (SELECT DISTINCT fv.product_id FROM (SELECT DISTINCT code FROM stock_by_site) c JOIN fv ON c.code = fv.sku_2),
ip AS (SELECT *, 'prod-' || CAST(item_key AS VARCHAR) AS pid FROM items),
u AS (SELECT variant_id AS owner_id, 'custom' AS namespace, 'orderable' AS key, 'boolean' AS type,
        CASE WHEN is_orderable THEN 'true' ELSE 'false' END AS value FROM flag_orderable
      UNION ALL SELECT variant_id, 'custom', 'in_stock', 'boolean', CASE WHEN in_stock THEN 'true' ELSE 'false' END FROM fis
      UNION ALL SELECT product_id, 'custom', 'ready_to_ship', 'boolean', 'true' FROM rl
      UNION ALL SELECT pid, 'custom', 'composition', '{CP.LINE_TEXT}', type FROM ip
      UNION ALL SELECT pid, 'custom', 'metal', '{CP.LINE_TEXT}', upper(substr(metal, 1, 1)) || lower(substr(metal, 2)) FROM ip
      UNION ALL SELECT pid, 'custom', 'template_suffix', '{CP.LINE_TEXT}', '{CP.TEMPLATE_SUFFIX}' FROM ip
      UNION ALL SELECT pid, 'custom', 'categoria', '{CP.LINE_TEXT}', group_name FROM ip
      UNION ALL SELECT pid, 'custom', 'tags', 'tags', '{CP.TAG}' FROM ip
      UNION ALL SELECT 'prod-' || CAST(item_key AS VARCHAR), 'custom', 'badges', '{CP.LIST_TEXT}', '[""]' FROM badge_removal
      UNION ALL SELECT 'prod-' || CAST(item_key AS VARCHAR), 'custom', 'badges', '{CP.LIST_TEXT}', '["{CP.BADGE}"]'
                FROM campaign_split WHERE tagged
      UNION ALL SELECT product_id, 'custom', 'sale', 'boolean', 'true' FROM campaign_members
      UNION ALL SELECT DISTINCT 'prod-' || CAST(item_key AS VARCHAR), 'custom', 'sale', 'boolean', 'false' FROM item_stats
                WHERE 'prod-' || CAST(item_key AS VARCHAR) NOT IN (SELECT product_id FROM campaign_members)
      UNION ALL SELECT metafield_id, 'custom', 'metafield_delete', 'delete', product_id FROM metafield_cleanup)
SELECT *, CASE
  WHEN key IN ({_lst(CP.OWNER_UPDATES)}) THEN CAST(to_json({{'input': {{'metafields': [{{'namespace': namespace, 'key': key, 'type': type,
    'value': value}}], 'id': owner_id}}}}) AS VARCHAR)
  WHEN key = 'tags' THEN CAST(to_json({{'input': {{'id': owner_id, 'tags': value}}}}) AS VARCHAR)
  ELSE CAST(to_json({{'ownerId': owner_id, 'namespace': namespace, 'key': key, 'type': type, 'value': value}}) AS VARCHAR) END AS payload
FROM u""")
q("feed_metafield_lookup", ["badge_removal"], """
SELECT product_id, key, to_json({'id': product_id, 'key': key, 'name': 'custom'}) AS payload
FROM (SELECT 'prod-' || CAST(item_key AS VARCHAR) AS product_id, unnest(['badges', 'sale']) AS key FROM badge_removal)""")


# ------------------------------------------------------------------- sales ----
from .plans import sales as SA  # noqa: E402

_SITE = "('S' || CAST(l_suppkey % 6 AS VARCHAR))"


def _arm(values: list) -> str:
    """The value that the order key picks from a list."""
    return f"([{_lst(values) if isinstance(values[0], str) else ', '.join(map(str, values))}])[l_orderkey % {len(values)} + 1]"


_COMPANY = f"coalesce(nullif({_case('l.site', {k: v[1] for k, v in B.SITE_WAREHOUSE.items()})}, ''), 'WEB')"
q("sales_fact", ["items"], f"""
WITH lk AS (SELECT o_orderkey AS lk_key, o_custkey AS lk_cust, o_orderdate AS lk_date, o_orderpriority AS lk_event
            FROM orders WHERE o_orderpriority IN ({_lst(SA.LOOKUP_PRIORITIES)})),
r AS (SELECT l.*, o.o_custkey, o.o_orderstatus, l_shipdate < TIMESTAMP '2001-01-01' AS before,
        l_shipdate < TIMESTAMP '2001-01-01' AND (l_linestatus = 'F' OR o_orderstatus NOT IN ('O', 'P')) AS settled,
        l_shipdate < TIMESTAMP '2001-01-01' AND l_linestatus <> 'F' AND o_orderstatus <> 'O' AS odd
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
t AS (SELECT *, CASE WHEN odd AND NOT settled THEN {_arm(SA.NOT_SALES)} WHEN odd THEN {_arm([k[0] for k in SA.LEFT_OUT])}
                     WHEN settled THEN '{SA.SALE}'
                     WHEN before THEN CASE WHEN l_orderkey % 2 = 0 THEN '{SA.ADVANCE}' ELSE '{SA.WEB_ORDER}' END
                     ELSE {_arm(SA.TODAY_OPERATIONS)} END AS op,
        CASE WHEN odd THEN {_arm([k[1] for k in SA.LEFT_OUT])} ELSE 1 END AS op_type,
        CASE WHEN odd AND {_arm([k[2] or '' for k in SA.LEFT_OUT])} <> '' THEN {_arm([k[2] or '' for k in SA.LEFT_OUT])}
             ELSE {_SITE} END AS site FROM r),
u AS (SELECT *, CASE
        WHEN settled AND l_extendedprice <> 0 AND site <> '{SA.CLOSED_SITE}' AND op NOT IN ({_lst([SA.ADVANCE, *SA.NOT_SALES])})
          AND op_type NOT IN (91, 92) THEN CASE WHEN l_linenumber % 2 = 0 AND l_orderkey <> 0 THEN 'a' ELSE 'b' END
        WHEN settled THEN NULL
        WHEN before AND l_extendedprice <> 0 AND site <> '{SA.CLOSED_SITE}' AND op IN ({_lst(SA.OPEN_OPERATIONS)}) THEN 'c'
        WHEN before OR op NOT IN ({_lst(SA.TODAY_OPERATIONS)}) THEN NULL
        WHEN site = '{SA.WEB_SITE}' THEN 'e'
        WHEN l_extendedprice <> 0 AND site <> '{SA.CLOSED_SITE}' THEN 'd' END AS branch FROM t),
j AS (SELECT l.*, i.code, i.family, i.group_name, i.model, i.cost,
        c.c_name, c.c_nationkey, n.n_name, s.s_name, lk.*,
        CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS sgn,
        l.o_custkey % {SA.HOUSE_ACCOUNT_MOD} = 0 AS house,
        coalesce(CAST(lk.lk_date AS DATE), CAST(l.l_shipdate AS DATE)) AS sdate,
        CAST(l_extendedprice AS DECIMAL(15,2)) AS ext,
        CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))) AS tot,
        CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(15,2)) AS dsc,
        (l.site IN ({_lst(SA.WEB_SELLER_SITES)}) OR s.s_name IS NULL) AS web_seller,
        {_COMPANY} AS company
      FROM u l JOIN items i ON l.l_partkey = i.item_key
      LEFT JOIN customer c ON l.o_custkey = c.c_custkey
      LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
      LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
      LEFT JOIN lk ON l.l_orderkey = lk.lk_key AND l.o_custkey = lk.lk_cust WHERE l.branch IS NOT NULL),
k AS (SELECT *, CASE WHEN branch = 'b' OR l_returnflag = 'R' THEN 'S' || CAST(l_suppkey AS VARCHAR)
                     ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS cpty
      FROM j)
SELECT company,
  CASE branch {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in SA.OPERATION.items())} END AS operation,
  l_orderkey AS op_number, sdate AS sale_date,
  CASE WHEN house THEN cpty ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN house THEN (CASE WHEN cpty LIKE 'S%' THEN s_name ELSE n_name END) ELSE c_name END AS customer_name,
  CASE WHEN web_seller THEN 'WEB' ELSE 'V' || CAST(l_suppkey AS VARCHAR) END AS seller_id,
  CASE WHEN web_seller THEN 'WEB' ELSE s_name END AS seller_name,
  'N' || CAST(c_nationkey AS VARCHAR) AS companion_id, n_name AS companion_name,
  group_name AS big_group, model, code,
  CASE WHEN branch = 'b' THEN NULL ELSE 'B' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS barcode,
  CASE WHEN family IN ({_lst(B.SIZED_FAMILIES)}) THEN CAST(10 + l_linenumber % 13 AS VARCHAR) ELSE '' END AS size,
  CAST(trunc(l_quantity) AS BIGINT) AS qty,
  CAST(round(CASE WHEN branch IN ('c', 'd', 'e') THEN tot + dsc ELSE tot END, 0) AS BIGINT) AS net_total,
  CAST(round(dsc, 0) AS BIGINT) AS discount,
  CAST(CASE WHEN branch IN ('c', 'd', 'e') THEN round(CAST(cost AS DECIMAL(15,2)), 0)
       ELSE round(ext * CAST({SA.COST_RATE} AS DECIMAL(15,2)), 0) END AS BIGINT) AS cost,
  CAST(CASE WHEN branch = 'a' THEN round(ext, 0) * sgn WHEN branch = 'b' THEN round(ext * (1 + CAST(l_tax AS DECIMAL(15,2))), 0)
       ELSE round(ext, 0) END AS BIGINT) AS gross_total,
  CASE WHEN lk_key IS NOT NULL THEN 'NF' || CAST(l_orderkey AS VARCHAR) END AS invoice_no,
  'C' || CAST(o_custkey AS VARCHAR) || '-'
    || strftime(CASE WHEN branch = 'd' THEN CAST(l_shipdate AS DATE) ELSE sdate END, '%Y-%m-%d') AS sale_id,
  'C' || CAST(o_custkey AS VARCHAR) || '-' || coalesce(CASE WHEN lk_key IS NOT NULL THEN 'NF' || CAST(l_orderkey AS VARCHAR) END, '')
    AS order_id,
  CASE WHEN lk_key IS NOT NULL THEN 'W' || CAST(lk_key AS VARCHAR) END AS web_id,
  lk_event AS event
FROM k ORDER BY sale_date DESC""")


# ------------------------------------------------------- intake and feeds ----
from .plans import intake as IN  # noqa: E402

_T = TITLE.format
q("customer_class", [], f"""
WITH c AS (SELECT c.c_custkey AS k, c.c_name, n.n_name,
             CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '119' || CAST(c_custkey AS VARCHAR) || '.0'
                  ELSE CAST(5511900000000 + c_custkey AS VARCHAR) || '.0' END AS phone_raw,
             'P' || CAST(c_nationkey AS VARCHAR) AS province_code, '{IN.COUNTRY}' AS country_code,
             CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 8 THEN CAST(c_custkey AS VARCHAR)
                  ELSE lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS zip,
             CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE 'Street ' || CAST(c_custkey AS VARCHAR) END AS address
           FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
p AS (SELECT *, CASE WHEN phone_raw IS NULL THEN NULL
                     ELSE '+' || CAST(CAST(trunc(TRY_CAST(phone_raw AS DOUBLE)) AS BIGINT) AS VARCHAR) END AS phone,
             split_part(c_name, '#', 1) AS fn FROM c),
r AS (SELECT *, coalesce(length(phone), 0) AS plen FROM p)
SELECT 'C' || CAST(k AS VARCHAR) AS customer_id, {_T(x='fn')} AS first_name, {_T(x="split_part(c_name, '#', 2)")} AS last_name,
  lower({_T(x='fn')}) || CAST(k AS VARCHAR) || '@example.com' AS email, phone, CAST(plen AS BIGINT) AS phone_len, address,
  {_T(x='n_name')} AS city, province_code, country_code, zip,
  CASE WHEN plen <= {IN.SHORT_PHONE_MAX} AND address IS NULL THEN '{IN.CUSTOMER_CLASSES[0]}'
       WHEN plen <= {IN.SHORT_PHONE_MAX} THEN '{IN.CUSTOMER_CLASSES[1]}'
       WHEN address IS NULL THEN '{IN.CUSTOMER_CLASSES[2]}' ELSE '{IN.CUSTOMER_CLASSES[3]}' END AS class
FROM r""")
def _own(x: str) -> str:
    for found, written in IN.BRAND_CASING:
        x = f"regexp_replace({x}, '(?i){found}', '{written}', 'g')"
    return x


_PLAIN = f"i.family NOT IN ({_lst(B.SIZED_FAMILIES)})"
cte("intake_prepare", ["items"], f"""
SELECT code, title, collection, collection_id, category, product_type,
  CAST(to_json(coalesce(string_split(st, ' E '), CAST([] AS VARCHAR[]))) AS VARCHAR) AS stones,
  CAST(coalesce(len(string_split(st, ' E ')), 0) AS BIGINT) AS stone_count, coating, metal_title, handle, category_id,
  description_html, price_text, new_label AS size_label, n_listed, family, item_key
FROM (SELECT i.*, {_own(_T(x='i.description'))} AS title, {_own(_T(x='i.model'))} AS collection, {_T(x='i.metal')} AS metal_title,
        {_T(x='i.group_name')} AS category, {_T(x='i.type')} AS product_type,
        {_T(x="(CASE WHEN i.item_key % 5 = 0 THEN 'gold bath' ELSE 'none' END)")} AS coating,
        {_T(x="(replace(i.description, ' ', '-') || '-' || i.code)")} AS handle,
        CASE i.group_name {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.TAXONOMY.items())} ELSE '{C.TAXONOMY_DEFAULT}' END AS category_id,
        '<p>' || i.description || '</p>' AS description_html, CAST(CAST(trunc(i.price) AS BIGINT) AS VARCHAR) AS price_text,
        CASE WHEN {_PLAIN} AND i.item_key % 11 = 5 THEN CAST(i.size AS VARCHAR) ELSE '' END AS new_label,
        CAST(CASE WHEN i.item_key % 13 < 2 THEN 2 + i.item_key % 13 ELSE 0 END AS INTEGER) AS n_listed,
        CASE WHEN c.model IS NULL THEN NULL ELSE 'col-' || split_part(c.model, '#', 2) END AS collection_id,
        CASE WHEN i.item_key % 3 = 0 THEN NULL WHEN i.item_key % 3 = 1 THEN 'Ruby' WHEN i.item_key % 20 < 10 THEN 'Ruby E Pearl'
             ELSE 'Ruby E Pearl E Onyx' END AS st
      FROM items i LEFT JOIN (SELECT DISTINCT p_brand AS model FROM part) c ON i.model = c.model)""")
q("intake_prepare", ["intake_prepare"], "SELECT * FROM intake_prepare")
q("intake_new", ["intake_prepare", "channel_variants", "items"], f"""
SELECT * FROM intake_prepare WHERE code NOT IN (SELECT sku_2 FROM channel_variants
    WHERE CAST(split_part(product_id, '-', 2) AS BIGINT) % 10 <> {B.MISSING_PRODUCT})
  AND code NOT IN (SELECT code FROM items WHERE NOT active)""")
q("activation_plan", ["channel_variants"], f"""
SELECT 'inv-' || sku AS inventory_item_id, sku, unnest([{_lst(IN.ACTIVATION_LOCATIONS)}]) AS location_id FROM channel_variants""")
q("publication_plan", ["channel_variants"], f"""
SELECT product_id, unnest([{_lst(IN.SALES_CHANNELS)}]) AS channel FROM (SELECT DISTINCT product_id FROM channel_variants)""")
q("feed_stock", ["stock_change_set"], """
SELECT phase, variant_sku, location_id, to_json({'reason': 'correction', 'name': 'available',
  'changes': {'delta': delta, 'inventoryItemId': inventory_item_id, 'locationId': location_id}}) AS payload
FROM stock_change_set""")
q("feed_delete", ["channel_variants", "items"], """
SELECT product_id, to_json({'input': {'id': product_id}}) AS payload FROM (SELECT DISTINCT product_id FROM channel_variants
  WHERE sku_2 IN (SELECT code FROM items WHERE NOT active))""")
q("response_split", ["stock_change_set"], """
SELECT variant_sku, location_id, CASE WHEN delta < -50 THEN 'rejected' ELSE 'applied' END AS status,
  CASE WHEN delta < -50 THEN 'Quantity below limit' END AS message FROM stock_change_set""")

# ------------------------------------------------------------------ scalars ----
q("scalar_strings", [], f"""
SELECT p_partkey AS item_key, rtrim(p_name || '   ') AS rtrimmed, trim('  ' || p_name || '  ') AS trimmed,
  regexp_replace(trim(replace(p_name, ' ', '   ')), '\\s+', ' ', 'g') AS collapsed,
  p_name || '/' || coalesce(CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END, '') AS concat_blank,
  p_name || '/' || (CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END) AS concat_plus,
  replace(p_name, 'rod', 'bar') AS replaced, regexp_replace(p_name, '(?i)RING', 'band', 'g') AS replaced_ci,
  split_part(p_name, ' ', 1) AS word1,
  CASE WHEN len(string_split(p_name, ' ')) >= 3 THEN string_split(p_name, ' ')[3] END AS word3,
  CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_words, upper(p_name) AS upper,
  {_T(x="(p_name || ' d''agua-x2')")} AS title, CAST(length(p_name) AS BIGINT) AS length,
  CASE WHEN p_name LIKE '%gear%' THEN 'GEAR' ELSE '' END AS keyword,
  CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 5 = 1 THEN '' ELSE trim(p_name) END AS cleaned
FROM part""")
q("scalar_bands", ["items", "shop_stock"], f"""
SELECT i.code,
  CASE i.group_name {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.TAXONOMY.items())} ELSE '{C.TAXONOMY_DEFAULT}' END AS taxonomy_code,
  {_bands().replace("price", "i.price").replace("metal", "i.metal")} AS price_band,
  CASE WHEN i.orderable OR s.stock_qty - 100 > 0 THEN 'ATIVO' ELSE 'INATIVO' END AS final_status,
  CASE WHEN i.active THEN 'Ativo' ELSE 'Inativo' END AS status_text,
  CAST(CASE WHEN s.stock_qty - 100 > 0 THEN s.stock_qty - 100 ELSE 0 END AS BIGINT) AS stock_floor
FROM items i LEFT JOIN shop_stock s ON i.code = s.code""")
q("scalar_casts", [], """
SELECT o_orderkey AS order_key, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS iif,
  coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END, 0.0) AS isnull_price,
  coalesce(CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS DATE), DATE '2001-01-01') AS date_or_asof,
  CASE WHEN o_custkey % 50 = 0 THEN (CASE WHEN o_orderstatus = 'F' THEN 'origin' ELSE 'destination' END) ELSE 'customer' END AS party,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END AS signed,
  CAST(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(10,0)) AS BIGINT) AS price_dec0,
  CASE WHEN length(CAST(o_orderkey AS VARCHAR)) >= 8 THEN CAST(o_orderkey AS VARCHAR) ELSE lpad(CAST(o_orderkey AS VARCHAR), 8, '0') END AS char8, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date_text,
  CAST(o_orderdate AS DATE) < DATE '2001-01-01' AS before_as_of,
  CAST(round(CAST(o_totalprice AS DECIMAL(15,2)) * CAST(0.9 AS DECIMAL(15,2)), 2) AS DOUBLE) AS discounted,
  round(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice / CAST(o_orderkey % 4 AS DOUBLE) END, 4) AS ratio,
  printf('%.2f', CAST(o_totalprice AS DECIMAL(15,2))) AS price_text
FROM orders""")

q("product_taxonomy", ["items"], f"""
SELECT 'prod-' || CAST(item_key AS VARCHAR) AS product_id, description AS title,
  CASE group_name {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.TAXONOMY.items())} ELSE '{C.TAXONOMY_DEFAULT}' END AS category_id,
  group_name AS category_name,
  CASE WHEN item_key % 2 = 0 THEN 'col-new' ELSE 'col-' || split_part(model, '#', 2) END AS first_collection_id,
  CASE WHEN item_key % 2 = 0 THEN 'New' ELSE model END AS first_collection_title,
  CAST(CASE WHEN item_key % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_collections
FROM items""")


# ---------------------------------------------------- JSON feeds (P2, P5, P9, P10, P12) ----
from .plans import feeds as FD  # noqa: E402

_STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
_CLEAN = f"CASE WHEN lower({_STRIP}) = 'nan' THEN '' ELSE coalesce({_STRIP}, '') END"
cte("text_diff", [], SQL["text_diff"])
q("feed_text", ["text_diff"], f"""
SELECT sku, to_json({{'input': {{'id': 'prod-' || CAST(sku AS VARCHAR), 'title': {_CLEAN.format(x='new_title')},
  'descriptionHtml': {_CLEAN.format(x='new_description')}}},
  'metafields': [{{'ownerId': 'prod-' || CAST(sku AS VARCHAR), 'namespace': 'custom', 'key': 'composicao_text',
    'type': 'multi_line_text_field', 'value': {_CLEAN.format(x='new_composition')}}}]}}) AS payload
FROM text_diff""")
q("feed_activation", ["channel_variants"], f"""
SELECT inventory_item_id, to_json({{'inventoryItemId': inventory_item_id, 'tracked': true,
  'activations': list_transform(list_sort(locs), lambda x: {{'locationId': x, 'activate': true}})}}) AS payload
FROM (SELECT inventory_item_id, list(location_id) AS locs FROM (
        SELECT DISTINCT 'inv-' || sku AS inventory_item_id, unnest([{_lst(IN.ACTIVATION_LOCATIONS)}]) AS location_id
        FROM channel_variants) GROUP BY inventory_item_id)""")
_CONSENT = f"{{'marketingState': '{FD.CONSENT[0]}', 'marketingOptInLevel': '{FD.CONSENT[1]}'}}"
_BASE = f"'firstName': first_name, 'lastName': last_name, 'email': email, 'emailMarketingConsent': {_CONSENT}"
_ADDR = ("'addresses': {'address1': address, 'city': city, 'provinceCode': province_code, 'countryCode': country_code, 'zip': zip}")
_PHONE = f"'phone': phone, 'smsMarketingConsent': {_CONSENT}"
_CODE = (f"'metafields': {{'key': '{FD.CLIENT_CODE}', 'type': '{FD.LINE_TEXT}', 'value': customer_id, "
         f"'namespace': '{FD.NAMESPACE}'}}")
cte("customer_class", [], SQL["customer_class"])
q("feed_customer", ["customer_class"], f"""
SELECT customer_id, class, CASE
  WHEN class = 'complete' THEN to_json({{'input': {{{_BASE}, {_ADDR}, {_PHONE}, {_CODE}}}}})
  WHEN class = 'no_address' THEN to_json({{'input': {{{_BASE}, {_PHONE}, {_CODE}}}}})
  WHEN class = 'no_phone' THEN to_json({{'input': {{{_BASE}, {_ADDR}, {_CODE}}}}})
  ELSE to_json({{'input': {{{_BASE}, {_CODE}}}}}) END AS payload
FROM customer_class""")
q("feed_customer_delete", ["customer_class"], """
SELECT customer_id, to_json({'input': {'id': customer_id}}) AS payload FROM customer_class WHERE class = 'no_phone_no_address'""")
_CARE = "CASE upper(metal_title) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FD.CARE_TEXT.items()) + " ELSE '' END"

def _meta(pick: str) -> str:
    def field(key, kind, value):
        return f"{{'key': '{key}', 'namespace': '{FD.NAMESPACE}', 'type': '{kind}', 'value': {value}}}"
    stone = field("pedra", FD.LIST_TEXT, f"'[\"' || array_to_string({pick}, '\", \"') || '\"]'")
    first = [field("genero", FD.LIST_TEXT, f"'[\"{FD.GENDER}\"]'"), field("metal", FD.LINE_TEXT, "metal_title"),
             field("cobertura", FD.LINE_TEXT, "coating")]
    care = field("cuidadospeca", FD.LONG_TEXT, _CARE)
    return f"(CASE WHEN len({pick}) > 0 THEN [{', '.join([*first, stone, care])}] ELSE [{', '.join([*first, care])}] END)"


def _product(title: str, option: str | None, variants: str, meta: str | None) -> str:
    return (f"CAST(to_json({{'input': {{'title': {title}, 'descriptionHtml': description_html, 'productCategory': "
            f"{{'productTaxonomyNodeId': '{FD.CATEGORY_PREFIX}' || category_id}}, 'productType': product_type, "
            f"'status': '{FD.PRODUCT_STATUS}', 'handle': handle, 'collectionsToJoin': ['{FD.FIXED_COLLECTION}', collection_id], "
            f"'seo': {{'title': {title}}}, " + (f"'options': {option}, " if option else "") + f"'variants': {variants}"
            + (f", 'metafields': {meta}" if meta else "") + "}}) AS VARCHAR)")


cte("intake_new", ["intake_prepare", "channel_variants", "items"], f"""
SELECT *, from_json(stones, '["VARCHAR"]') AS sl FROM intake_prepare WHERE code NOT IN (SELECT sku_2 FROM channel_variants
    WHERE CAST(split_part(product_id, '-', 2) AS BIGINT) % 10 <> {B.MISSING_PRODUCT})
  AND code NOT IN (SELECT code FROM items WHERE NOT active)""")
_SHAPE_VARIANTS = {
    "sizes": (f"list_transform(range({B.SIZE_FIRST}, {B.SIZE_LAST + 1}), lambda n: {{'sku': code || '-' || CAST(n AS VARCHAR), "
              "'price': price_text, 'options': CAST(n AS VARCHAR)})"),
    "label": "[{'sku': code, 'price': price_text, 'options': size_label}]", "plain": "[{'sku': code, 'price': price_text}]"}
_arms = [(name, fits, _product("title", f"'{option}'" if option else None, _SHAPE_VARIANTS[kind], _meta(f"sl[1:{stones}]")))
         for name, fits, option, kind, stones in FD.SHAPES]
q("feed_create", ["intake_new"], f"""
SELECT code, CASE {" ".join(f"WHEN {fits} THEN '{name}'" for name, fits, _ in _arms)} END AS shape,
  CASE {" ".join(f"WHEN {fits} THEN {body}" for _, fits, body in _arms)} END AS payload
FROM intake_new""")
_L = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_LET = (f"CASE item_key % 4 WHEN 0 THEN {_L(FD.LETTERS_ALL)} WHEN 1 THEN {_L(FD.LETTERS_23)} "
        f"WHEN 2 THEN {_L(FD.LETTERS_8A)} ELSE {_L(FD.LETTERS_8B)} END")
_LETTERED = f"list_transform({_LET}, lambda x: {{'sku': code, 'price': price_text, 'options': x}})"
q("feed_create_letters", ["intake_new"], f"""
SELECT code, CAST(len({_LET}) AS BIGINT) AS n_variants, CASE
  WHEN item_key % 4 <= 1 THEN {_product("title", "'Style'", _LETTERED, _meta("sl[1:1]"))}
  ELSE {_product("title", "'Style'", _LETTERED, None)} END AS payload
FROM intake_new""")
_LISTING = (f"list_transform(list_slice({_L(IN.LISTED_SIZES)}, 1, n_listed), "
            "lambda x: {'sku': code || '-' || x, 'price': price_text, 'options': x})")
q("feed_create_listed", ["intake_new"], f"""
SELECT code, n_listed, {_product("split_part(title || ' - ' || product_type, ' - ', 1)", "'Size'", _LISTING,
                                 _meta("sl[1:CASE WHEN stone_count = 2 THEN 2 ELSE least(1, stone_count) END]"))} AS payload
FROM intake_new WHERE n_listed > 0""")

from .plans import pages as PG  # noqa: E402

_CHAIN = f"""
WITH k AS (SELECT 'customers' AS kind, c_custkey - (SELECT min(c_custkey) FROM customer) AS k FROM customer
           UNION ALL SELECT 'members', item_key - (SELECT min(item_key) FROM items) FROM items
           UNION ALL SELECT 'inventory', item_key - (SELECT min(item_key) FROM items) FROM items),
p AS (SELECT kind, k // {PG.PAGE_ROWS} AS number, count(*) AS n FROM k GROUP BY 1, 2),
l AS (SELECT *, kind = '{PG.LOST_PAGE[0]}' AND number = {PG.LOST_PAGE[1]} AS lost, max(number) OVER (PARTITION BY kind) AS last FROM p)"""
q("page_chains", ["items"], _CHAIN + """
SELECT kind, CAST(count(*) FILTER (NOT lost) AS BIGINT) AS pages, CAST(sum(n) FILTER (NOT lost) AS BIGINT) AS rows,
  coalesce(string_agg(kind || '-' || CAST(number AS VARCHAR), ',' ORDER BY number) FILTER (lost), '') AS missing,
  count(*) FILTER (lost) = 0 AS whole
FROM l GROUP BY kind""")
_LOST = f"(item_key - (SELECT min(item_key) FROM items)) // {PG.PAGE_ROWS} = {PG.LOST_PAGE[1]}"
q("page_members", ["items"], f"""
SELECT 'customers' AS kind, 'cust-' || CAST(c_custkey AS VARCHAR) AS id, c_name AS label,
  'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS extra FROM customer
UNION ALL SELECT 'members', 'prod-' || CAST(item_key AS VARCHAR), description, model FROM items
UNION ALL SELECT 'inventory', 'inv-' || code, code, 'true' FROM items WHERE NOT ({_LOST})""")
q("jsonl_quarantine", ["channel_variants"], """
WITH l AS (SELECT product_id, inventory_quantity AS q, media_count AS m,
  CAST(to_json({'variant_id': variant_id, 'product_id': product_id, 'quantity': inventory_quantity}) AS VARCHAR) AS line FROM channel_variants),
b AS (SELECT product_id, CASE WHEN q = 3 AND m = 1 THEN substr(line, 1, 20)
                              WHEN q = 4 AND m = 2 THEN replace(line, '"quantity":4', '"quantity":"four"') END AS bad FROM l)
SELECT CASE WHEN bad IS NULL THEN 'read' ELSE 'broken' END AS status, coalesce(bad, product_id) AS what, count(*) AS n
FROM b GROUP BY 1, 2""")
q("cycle_bucketed", ["key_changes"], "SELECT order_key, status, price FROM key_changes WHERE change <> 'leave'")
q("outbox_loop", ["stock_change_set"], """
SELECT variant_sku || '@' || location_id AS key,
  CAST(CASE WHEN delta < -50 THEN 3 WHEN delta % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS attempts,
  CASE WHEN delta < -50 THEN 'dead' ELSE 'done' END AS state,
  CASE WHEN delta < -50 OR delta % 3 = 0 THEN 'Quantity below limit' END AS message
FROM (SELECT DISTINCT variant_sku, location_id, inventory_item_id, delta FROM stock_change_set)""")
q("stream_cycle", ["key_changes"], "SELECT order_key, status, price FROM key_changes WHERE change <> 'leave'")


# DuckDB types to_json results as its JSON logical type; Spark returns text.
for _n in [k for k in SQL if k.startswith("feed_")]:
    SQL[_n] = f"SELECT * REPLACE (CAST(payload AS VARCHAR) AS payload) FROM ({SQL[_n]})"
