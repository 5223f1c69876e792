"""Sales fact (E11; U1, J5–J8, F8, F9, X15–X19, W4).

The reference unions five branches, each re-reading and re-joining the
same sales lines, the order lookup and the party tables. The branches
are disjoint by their predicates, so here the inputs are joined once and
a ``branch`` column picks, per row, which branch's expressions apply:
one scan and one set of join shuffles instead of five, with the same
rows as the UNION ALL. What a branch takes and leaves out is a rule table
(``SALES_RULES``); the party table is joined once for the roles
of the orders and once for those of the lines.
Dimension tables join by key; AQE broadcasts them only when their measured
size is small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import concat_blank
from ..operators import Rule, join_roles, predicate
from ..sources import read_table
from . import bindings as B

# ---- fixed values of the binding ------------------------------------------
HOUSE_ACCOUNT_MOD = 50
LOOKUP_PRIORITIES = ["1-URGENT", "2-HIGH"]
WEB_SELLER_SITES = ["S4", "S5"]
OPERATION = {"a": "SETTLED", "b": "SETTLED_NO_BARCODE", "c": "OPEN_ORDER", "d": "TODAY_STORE", "e": "TODAY_WEB"}
CLOSED_SITE, WEB_SITE = "NY", "S0"
ADVANCE, WEB_ORDER, SALE = "ADVANCE", "WEB ORDER", "SALE"
# operations that no branch counts
NOT_SALES = ["SWAP", "STAFF SALE", "ORDER SALE", "WEB ORDER SALE"]
OPEN_OPERATIONS = [ADVANCE, WEB_ORDER]
TODAY_OPERATIONS = [ADVANCE, WEB_ORDER, SALE, "WEB SALE", "FRANCHISE SALE", "CONSIGNMENT SALE", "EXCHANGE"]
EXCLUDED_TYPES = ["91", "92"]
# kinds of settled and open lines that count for nothing: (name, type, site or none)
LEFT_OUT = [(ADVANCE, 1, None), *[(name, 1, None) for name in NOT_SALES], (SALE, 91, None), (SALE, 92, None), (SALE, 1, CLOSED_SITE)]
COST_RATE = 0.6
FIRST_DAY = "2001-01-01"
# ---------------------------------------------------------------------------
# Wide enough for any amount of the ERP: a narrower type would end the job
# under ANSI on the first larger line.
MONEY, RATE = "decimal(18,2)", "decimal(4,2)"


def sales_rules(as_of: str) -> list[Rule]:
    """What each branch takes (branch, column, op, value); ``as_of`` is the
    start of today (F9)."""
    out = [Rule(branch, "relation", "eq", "settled" if branch in "ab" else "orders") for branch in OPERATION]
    for branch in "ab":
        out += [Rule(branch, "barcode_no", "ne" if branch == "a" else "eq", "0"), Rule(branch, "operation_name", "ne", ADVANCE),
                *[Rule(branch, "operation_type", "not_in", t) for t in EXCLUDED_TYPES]]
    out += [Rule(branch, "l_extendedprice", "ne", "0") for branch in "abcd"]
    out += [Rule(branch, "site", "ne", CLOSED_SITE) for branch in "abcd"]
    out += [Rule("c", "operation_name", "in", o) for o in OPEN_OPERATIONS]
    out += [Rule(branch, "operation_name", "in", o) for branch in "de" for o in TODAY_OPERATIONS]
    out += [Rule("d", "site", "ne", WEB_SITE), Rule("e", "site", "eq", WEB_SITE)]
    out += [Rule("c", "l_shipdate", "lt", as_of), Rule("d", "l_shipdate", "ge", as_of), Rule("e", "l_shipdate", "ge", as_of)]
    return out + [Rule(branch, "operation_name", "ne", name) for branch in OPERATION for name in NOT_SALES]


COLUMNS = ["company", "operation", "op_number", "sale_date", "customer_id", "customer_name", "seller_id",
           "seller_name", "companion_id", "companion_name", "big_group", "model", "code", "barcode", "size",
           "qty", "net_total", "discount", "cost", "gross_total", "invoice_no", "sale_id", "order_id", "web_id",
           "event"]


def order_headers(spark: SparkSession, d: str) -> DataFrame:
    """Order headers (sljeest) with the keys of the parties in their roles and
    the invoice lookup (J5, J6) by its composite business key."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    cu = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    lk = (read_table(spark, d, "orders").filter(F.col("o_orderpriority").isin(LOOKUP_PRIORITIES))
          .select(F.col("o_orderkey").alias("lk_key"), F.col("o_custkey").alias("lk_cust"),
                  F.to_date("o_orderdate").alias("lk_date"), F.col("o_orderpriority").alias("lk_event")))
    nation = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    return (o.join(lk, (o.o_orderkey == lk.lk_key) & (o.o_custkey == lk.lk_cust), "left")
            .join(cu, o.o_custkey == cu.c_custkey, "left")
            .select("o_orderkey", "o_custkey", "lk_key", "lk_date", "lk_event",
                    F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("account"),
                    nation.alias("companion_id"), nation.alias("origin_id")))


@B.landed
def sales_lines(spark: SparkSession, d: str) -> DataFrame:
    """Sales lines (sljgdmi and sljeesti) as the ERP keeps them, landed once.
    Lines of before ``FIRST_DAY`` are settled if their status is F or their
    order is neither open (O) nor in progress (P); all others are lines of
    orders. Lines that no branch counts have one of the kinds of ``LEFT_OUT``
    (settled) or ``NOT_SALES`` (orders in progress)."""
    c = F.col
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    before = c("l_shipdate") < F.lit(FIRST_DAY).cast("timestamp")
    odd = before & (c("l_linestatus") != "F") & (c("o_orderstatus") != "O")

    def pick(values: list) -> F.Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (c("l_orderkey") % len(values)).cast("int") + 1)

    j = li.join(o, c("l_orderkey") == c("o_orderkey")).withColumns({
        "settled": before & ((c("l_linestatus") == "F") | ~c("o_orderstatus").isin("O", "P")), "odd": odd, "before": before})
    left_out = c("odd") & c("settled")
    return j.select(
        *li.columns, F.when(c("settled"), "settled").otherwise("orders").alias("relation"),
        F.when(left_out, pick([k[0] for k in LEFT_OUT])).when(c("settled"), SALE).when(c("odd"), pick(NOT_SALES))
        .when(c("before"), pick(OPEN_OPERATIONS)).otherwise(pick(TODAY_OPERATIONS)).alias("operation_name"),
        F.when(left_out, pick([k[1] for k in LEFT_OUT])).otherwise(1).alias("operation_type"),
        F.coalesce(F.when(left_out, pick([k[2] for k in LEFT_OUT])),
                   F.concat(F.lit("S"), (c("l_suppkey") % 6).cast("string"))).alias("site"),
        F.when(c("l_linenumber") % 2 == 0, c("l_orderkey")).otherwise(0).cast("bigint").alias("barcode_no"))


def with_branch(lines: DataFrame, rules: list[Rule]) -> DataFrame:
    """Lines that a branch takes, with its letter (F8); the rules make branches
    disjoint and reach the scan as one pushed filter."""
    tests = {b: predicate(rules, b, lines.schema) for b in OPERATION}
    taken = lines.filter(reduce(lambda a, b: a | b, tests.values()))
    return taken.withColumn("branch", F.coalesce(*[F.when(test, F.lit(b)) for b, test in tests.items()]))


def sales_fact(spark: SparkSession, d: str, as_of: str = "2001-01-01", sort: bool = False) -> DataFrame:
    """The 25-column sales fact. ``sort=True`` adds the reference's final
    ORDER BY date DESC (W4); it is off by default because a global sort
    costs a sampling pass over the whole join plus a range shuffle, and
    the fact is consumed as a set."""
    it = B.items(spark, d).select("item_key", "code", "family", "group_name", "model", "cost")
    c = F.col
    # the order side is enriched, with the parties in its roles too, before the
    # much larger lines join it; the keys of the lines' roles are in their scan
    parties = B.parties(spark, d)
    headers = join_roles(order_headers(spark, d), parties, "party_id", {
        "customer": "account", "companion": "companion_id", "origin": "origin_id"}, ["name"])
    lines = with_branch(sales_lines(spark, d), sales_rules(as_of))
    supplier = F.concat(F.lit("S"), c("l_suppkey").cast("string"))
    party_keys = {"destination_id": supplier, "seller_key": supplier}
    j = (lines.join(headers, c("l_orderkey") == c("o_orderkey"), "inner")
         .join(it, c("l_partkey") == c("item_key"), "inner").withColumns(party_keys))
    j = join_roles(j, parties, "party_id", {"destination": "destination_id", "seller": "seller_key"}, ["name"],
                   asked=lines.withColumns(party_keys))

    # Each derived value is computed once in its own projection stage and
    # referenced by name afterwards, so no expression is re-evaluated inside
    # every CASE arm that uses it.
    j = j.withColumns({
        "sign": F.when(c("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1)),
        "house": c("o_custkey") % HOUSE_ACCOUNT_MOD == 0,
        "line_date": F.to_date("l_shipdate"),
        # money in decimals as in the ERP, so rounding is exact (no binary ties)
        "ext": c("l_extendedprice").cast(MONEY),
        "dsc_rate": c("l_discount").cast(RATE),
        "tax": c("l_tax").cast(RATE),
    })
    br = c("branch")
    company = F.coalesce(B.site_warehouse_name(c("site")), F.lit(""))
    j = j.withColumns({
        "sale_date": F.coalesce("lk_date", c("line_date")),
        "total": c("ext") * (F.lit(1) - c("dsc_rate")),
        "disc": c("ext") * c("dsc_rate"),
        "company": F.when(company == "", F.lit("WEB")).otherwise(company),
        "web_seller": c("site").isin(WEB_SELLER_SITES) | c("seller_name").isNull(),
        # a house account stands for the other party: the destination, or the
        # origin of what branch a books as incoming
        "to_destination": (br == "b") | (c("l_returnflag") == "R"),
        "gross": F.when(br == "b", F.round(c("ext") * (F.lit(1) + c("tax")), 0)).otherwise(F.round(c("ext"), 0)),
        "late": br.isin("c", "d", "e"),
    })
    sized = c("family").isin(B.SIZED_FAMILIES)
    invoice = F.when(c("lk_key").isNotNull(), F.concat(F.lit("NF"), c("l_orderkey").cast("string")))
    op_date = F.when(br == "d", c("line_date")).otherwise(c("sale_date"))
    out = j.select(
        "company",
        F.coalesce(*[F.when(br == k, F.lit(v)) for k, v in OPERATION.items()]).alias("operation"),
        c("l_orderkey").alias("op_number"),
        "sale_date",
        F.when(~c("house"), c("account")).when(c("to_destination"), c("destination_id")).otherwise(c("origin_id"))
        .alias("customer_id"),
        F.when(~c("house"), c("customer_name")).when(c("to_destination"), c("destination_name")).otherwise(c("origin_name"))
        .alias("customer_name"),
        F.when(c("web_seller"), "WEB").otherwise(F.concat(F.lit("V"), c("l_suppkey").cast("string"))).alias("seller_id"),
        F.when(c("web_seller"), "WEB").otherwise(c("seller_name")).alias("seller_name"),
        "companion_id",
        "companion_name",
        c("group_name").alias("big_group"), "model", "code",
        F.when(br == "b", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("B"), c("l_orderkey").cast("string"), F.lit("-"),
                            c("l_linenumber").cast("string"))).alias("barcode"),
        F.when(sized, (F.lit(10) + c("l_linenumber") % 13).cast("string")).otherwise(F.lit("")).alias("size"),
        c("l_quantity").cast("bigint").alias("qty"),
        # whole amounts, and the sign of the direction on the gross of branch a only
        F.round(F.when(c("late"), c("total") + c("disc")).otherwise(c("total")), 0).cast("bigint").alias("net_total"),
        F.round(c("disc"), 0).cast("bigint").alias("discount"),
        F.when(c("late"), F.round(c("cost").cast(MONEY), 0))
        .otherwise(F.round(c("ext") * F.lit(COST_RATE).cast(RATE), 0)).cast("bigint").alias("cost"),
        (F.when(br == "a", c("gross") * c("sign")).otherwise(c("gross"))).cast("bigint").alias("gross_total"),
        invoice.alias("invoice_no"),
        # ids of the sale (customer and date) and of the order (customer and invoice, '' where it has none)
        concat_blank(c("account"), F.lit("-"), op_date).alias("sale_id"),
        concat_blank(c("account"), F.lit("-"), invoice).alias("order_id"),
        F.when(c("lk_key").isNotNull(), F.concat(F.lit("W"), c("lk_key").cast("string"))).alias("web_id"),
        c("lk_event").alias("event"),
    )
    return out.orderBy(F.col("sale_date").desc()) if sort else out
