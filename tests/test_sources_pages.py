"""Broken lines, page chains, even JDBC parts, text differences by fingerprint."""

import json
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stockline.plans import pages as PG
from stockline.plans import texts as TX
from stockline.sources import TooManyBadLines, read_jsonl_checked
from stockline.sources.tables import histogram_query, range_predicates, stride_bounds

SCHEMA = "id string, n long, tags array<string>"


def folder(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}"


# ---- broken lines ------------------------------------------------------------

def test_good_and_bad_lines_add_up(spark):
    root = folder(spark)
    lines = ['{"id":"a","n":1,"tags":["x"]}', '{"id":"b","n":2', "", "   ", '{"id":"c","n":"three"}', '{"id":"d"}', "[1, 2]", "text",
             '{"id":"e","n":null,"other":1}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/in")
    schema = spark.createDataFrame([], SCHEMA).schema
    good = read_jsonl_checked(spark, f"{root}/in", schema, f"{root}/bad", most_bad=0.6)
    assert {r.id: (r.n, r.tags) for r in good.collect()} == {"a": (1, ["x"]), "d": (None, None), "e": (None, None)}
    bad = spark.read.parquet(f"{root}/bad").collect()
    assert {r.line for r in bad} == {lines[1], lines[4], lines[6], lines[7]}
    assert all(r.file.startswith("file:") and r.block == 0 for r in bad)
    assert good.count() + len(bad) == sum(1 for x in lines if x.strip())
    with pytest.raises(TooManyBadLines, match="4 of 7"):
        read_jsonl_checked(spark, f"{root}/in", schema, f"{root}/bad2", most_bad=0.5)
    assert spark.read.parquet(f"{root}/bad2").count() == 4


# ---- page chains -------------------------------------------------------------

def page(kind, cursor, follow, *ids):
    node = {"customers": {"data": {"customers": {"edges": [{"node": {"id": i, "displayName": i}} for i in ids]}}},
            "members": {"data": {"collection": {"products": {"edges": [{"node": {"id": i, "title": i}} for i in ids]}}}},
            "inventory": {"data": {"inventoryItems": {"nodes": [{"id": i, "sku": i} for i in ids]}}}}[kind]
    return json.dumps({"kind": kind, "cursor": cursor, **({"next": follow} if follow else {}), **node})


def report(spark, lines):
    pages = PG.read_pages(spark.createDataFrame([(x,) for x in lines], "value string"))
    return {r.kind: (r.pages, r.rows, r.missing, r.whole) for r in PG.chain_report(pages).collect()}, pages


def test_chains_name_what_is_missing(spark):
    got, pages = report(spark, [
        page("customers", "c0", "c1", "a", "b"), page("customers", "c1", "c2", "c"), page("customers", "c2", None),
        page("members", "m0", "m1", "x"), page("members", "m2", None, "y"),
        page("inventory", "i0", "i1", "p"), page("inventory", "i1", "i2", "q"), "no json", "{}"])
    assert got == {"customers": (3, 3, "", True), "members": (2, 2, "m1", False), "inventory": (2, 2, "i2", False)}
    assert sorted(r.id for r in PG.page_rows(pages, "customers").collect()) == ["a", "b", "c"]
    assert sorted((r.id, r.label) for r in PG.page_rows(pages, "inventory").collect()) == [("p", "p"), ("q", "q")]


def test_chains_with_two_heads_copies_or_a_circle_are_not_whole(spark):
    one = [page("customers", "c0", "c1", "a"), page("customers", "c1", None, "b")]
    assert report(spark, one)[0]["customers"][3]
    assert not report(spark, [*one, page("customers", "c9", None, "z")])[0]["customers"][3]
    assert not report(spark, [*one, one[0]])[0]["customers"][3]
    assert not report(spark, [page("members", "m0", "m1", "a"), page("members", "m1", "m0", "b")])[0]["members"][3]
    assert report(spark, [])[0] == {}


def test_long_chain_is_complete(spark):
    ids = [f"id{i}" for i in range(1030)]
    lines = [page("members", f"m{k}", f"m{k + 1}" if (k + 1) * 250 < len(ids) else None, *ids[k * 250:(k + 1) * 250]) for k in range(5)]
    got, pages = report(spark, lines)
    assert got == {"members": (5, 1030, "", True)}
    assert sorted(r.id for r in PG.page_rows(pages, "members").collect()) == sorted(ids)


# ---- JDBC parts --------------------------------------------------------------

def skewed_keys(seed, n=20_000):
    rnd = random.Random(seed)
    return [rnd.choice([7, 7, 7, rnd.randrange(100), int(rnd.paretovariate(.7)) % 1_000_000, -50]) for _ in range(n)]


@pytest.mark.parametrize("bins", [50, 10_000])
def test_parts_cover_every_row_once_and_are_even(spark, bins):
    keys = skewed_keys(3)
    low, high = min(keys), max(keys)
    keys += [None] * 10
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    df.createOrReplaceTempView("extract_keys")
    # the query that the database would run
    counts = {int(r.bin): r.n for r in spark.sql(histogram_query("extract_keys", "k", low, high, bins)).collect() if r.bin is not None}
    predicates = range_predicates("k", stride_bounds(counts, low, high, 8, bins))
    sizes = [df.filter(p).count() for p in predicates]
    assert sum(sizes) == len(keys)
    assert df.filter(" AND ".join(f"NOT ({p})" for p in predicates)).count() == 0
    hot = max(Counter(k for k in keys if k is not None).values())
    if bins == 10_000:
        width = max(1, -(-(high - low + 1) // bins))
        most = max(Counter((k - low) // width for k in keys if k is not None).values())
        assert max(sizes) <= max(most, 2 * len(keys) // 8) + 10 and most >= hot


def test_parts_of_one_key_or_none():
    assert range_predicates("k", []) == ["1 = 1"]
    assert stride_bounds({0: 100}, 5, 5, 8) == []
    assert stride_bounds({}, 0, 0, 8) == []
    assert range_predicates("k", [10, 20]) == ["k < 10 OR k IS NULL", "k >= 10 AND k < 20", "k >= 20"]


def test_relations_are_landed_in_parts(spark, sf001):
    from stockline.jobs import land_relations
    from stockline.registry import QUERIES
    root, asked = folder(spark), []

    def read(spark, url, name, key, parts, properties):
        asked.append((url, name, key, parts))
        return spark.read.parquet(f"{sf001}/{name}.parquet")

    land_relations(spark, "jdbc:x", root, 4, read=read)
    assert ("jdbc:x", "lineitem", "l_orderkey", 4) in asked
    assert QUERIES["stock_by_item"](spark, root).count() == QUERIES["stock_by_item"](spark, sf001).count()


# ---- text differences --------------------------------------------------------

TEXTS = "sku long, title string, description string, composition string"


def plain_diff(store, erp):
    def norm(x):
        return " ".join((x or "").split())
    out = []
    for s in store:
        for e in erp:
            if s[0] is not None and s[0] == e[0]:
                flags = [norm(a) != norm(b) for a, b in zip(s[1:], e[1:])]
                if any(flags) and any(x is not None for x in e[1:]):
                    out.append((*s, *flags, *e[1:]))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast_keys", [1000, 0])
def test_text_diff_against_the_plain_join(spark, broadcast_keys):
    rnd = random.Random(6)
    pick = lambda: rnd.choice([None, "", "a b", "a  b\n", "a c", "long " * 50])
    store = [(rnd.choice([None, *range(12)]), pick(), pick(), pick()) for _ in range(60)]
    erp = [(rnd.choice([None, *range(15)]), pick(), pick(), pick()) for _ in range(40)]
    store, erp = store + store[:4], erp + erp[:4]
    got = TX.text_diff(spark.createDataFrame(store, TEXTS), spark.createDataFrame(erp, TEXTS), broadcast_keys)
    assert sorted(map(tuple, got.collect()), key=str) == plain_diff(store, erp)


def test_equal_texts_are_not_shuffled(spark, tmp_path):
    """No exchange of the final plan carries a text column."""
    rows = [(i, f"t{i}", "word " * 200, "c") for i in range(200)]
    spark.createDataFrame(rows, TEXTS).write.parquet(str(tmp_path / "erp"))
    spark.createDataFrame([(i, t, d + ("x" if i == 7 else ""), c) for i, t, d, c in rows], TEXTS).write.parquet(str(tmp_path / "store"))
    df = TX.text_diff(spark.read.parquet(str(tmp_path / "store")), spark.read.parquet(str(tmp_path / "erp")))
    assert [r.sku for r in df.collect()] == [7]
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text and text.count("FileScan parquet") == 2, text
