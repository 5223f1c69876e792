"""Payload checks for the JSON feeds that have no SQL oracle."""

import json

from pyspark.sql import functions as F

from stockline.plans.feeds import LETTERS_23, LETTERS_8A, LETTERS_8B, LETTERS_ALL
from stockline.registry import QUERIES


def payloads(spark, d, name, key):
    return {r[key]: json.loads(r.payload) for r in QUERIES[name](spark, d).collect()}


CONSENT = {"marketingState": "SUBSCRIBED", "marketingOptInLevel": "SINGLE_OPT_IN"}


def test_feed_create_shapes(spark, sf001):
    new = {r.code: r for r in QUERIES["intake_new"](spark, sf001).collect()}
    rows = {r.code: r for r in QUERIES["feed_create"](spark, sf001).collect()}
    assert set(rows) == set(new) and rows
    assert {r.stone_count for r in new.values()} == {0, 1, 2, 3}
    for code, r in rows.items():
        p, item = json.loads(r.payload)["input"], new[code]
        assert list(p)[:8] == ["title", "descriptionHtml", "productCategory", "productType", "status", "handle", "collectionsToJoin", "seo"]
        assert p["status"] == "DRAFT" and p["collectionsToJoin"][0] == "col-new" and p["seo"] == {"title": p["title"]}
        assert {v["price"] for v in p["variants"]} == {item.price_text}
        stones, n = json.loads(item.stones), item.stone_count
        named = stones[:2] if n == 2 or (r.shape == "ring" and n > 2) else stones[:1]
        if r.shape == "ring":
            assert item.category in ("Ring", "Band") and p["options"] == "Size"
            assert [(v["sku"], v["options"]) for v in p["variants"]] == [(f"{code}-{k}", str(k)) for k in range(10, 23)]
        elif r.shape == "sized":
            assert p["variants"] == [{"sku": code, "price": item.price_text, "options": item.size_label}] and p["options"] == "Size"
        else:
            assert p["variants"] == [{"sku": code, "price": item.price_text}] and "options" not in p
        fields = {m["key"]: m["value"] for m in p["metafields"]}
        assert list(fields) == ["genero", "metal", "cobertura", *(["pedra"] if named else []), "cuidadospeca"]
        assert fields["genero"] == '["unisex"]' and all(m["namespace"] == "custom" for m in p["metafields"])
        if named:
            assert json.loads(fields["pedra"]) == named and all(x[0].isupper() for x in named)


def test_every_shape_and_stone_count(spark):
    """The shape table on made items: two stones are named for rings and bands
    with two or more, and for anything else with exactly two."""
    from stockline.plans import feeds as FD
    items = [(f"{category}{label}{n}", category, label, n, json.dumps([f"S{i}" for i in range(n)]))
             for category in ("Ring", "Band", "Small") for label in ("", "18") for n in range(5)]
    df = spark.createDataFrame(items, "code string, category string, size_label string, stone_count long, stones string")
    for c in ("title", "description_html", "category_id", "product_type", "handle", "collection_id", "price_text", "metal_title", "coating"):
        df = df.withColumn(c, F.lit("x"))
    got = {r.code: r for r in FD.feed_create(df).collect()}
    for code, category, label, n, stones in items:
        fields = {m["key"]: m["value"] for m in json.loads(got[code].payload)["input"]["metafields"]}
        ring = category != "Small"
        want = 2 if n == 2 or (ring and n > 2) else min(n, 1)
        assert json.loads(fields.get("pedra", "[]")) == json.loads(stones)[:want], code
        assert got[code].shape == ("ring" if ring else "sized" if label else "two stones" if n == 2 else "plain")


def test_feed_create_letters_shapes(spark, sf001):
    rows = QUERIES["feed_create_letters"](spark, sf001).collect()
    assert rows
    shapes = {tuple(LETTERS_ALL), tuple(LETTERS_23), tuple(LETTERS_8A), tuple(LETTERS_8B)}
    for r in rows:
        p = json.loads(r.payload)["input"]
        letters = tuple(v["options"] for v in p["variants"])
        assert letters in shapes and r.n_variants == len(letters)
        assert {v["sku"] for v in p["variants"]} == {r.code}
        assert ("metafields" in p) == (len(letters) > 8)


def test_feed_create_listed(spark, sf001):
    rows = QUERIES["feed_create_listed"](spark, sf001).collect()
    assert {r.n_listed for r in rows} == {2, 3}
    for r in rows:
        p = json.loads(r.payload)["input"]
        assert [v["sku"] for v in p["variants"]] == [f"{r.code}-{x}" for x in "SML"[:r.n_listed]] and " - " not in p["title"]


def test_brand_casing(spark):
    from stockline.plans import intake as IN
    df = spark.createDataFrame([("New Large Gear",), ("old anvil Ii",), ("Old Bolt",)], "t string")
    assert [r[0] for r in df.select(IN.own_casing(F.col("t"))).collect()] == ["New LARGE GEAR", "OLD ANVIL Ii", "Old Bolt"]


def test_feed_customer_omits_missing(spark, sf001):
    rows = QUERIES["feed_customer"](spark, sf001).collect()
    assert len(rows) == 150
    for r in rows:
        p = json.loads(r.payload)["input"]
        assert ("phone" in p) == ("smsMarketingConsent" in p) == (r["class"] in ("no_address", "complete"))
        assert ("addresses" in p) == (r["class"] in ("no_phone", "complete"))
        assert p["emailMarketingConsent"] == CONSENT
        assert p["metafields"] == {"key": "codclient", "type": "single_line_text_field", "value": r.customer_id, "namespace": "custom"}
        if "phone" in p:
            assert p["phone"].startswith("+") and len(p["phone"]) > 13
        if "addresses" in p:
            assert list(p["addresses"]) == ["address1", "city", "provinceCode", "countryCode", "zip"]


def test_price_campaign_and_flag_payloads(spark, sf001):
    price = [json.loads(r.payload) for r in QUERIES["feed_price"](spark, sf001).collect()]
    assert all(list(p) == ["productId", "variants"] and list(p["variants"][0]) == ["id", "price"] for p in price) and price
    campaign = [(r.mode, json.loads(r.payload)["input"]) for r in QUERIES["feed_campaign_price"](spark, sf001).collect()]
    assert {m for m, _ in campaign} == {"apply", "restore"} and all(list(p) == ["id", "price"] for _, p in campaign)
    flags = QUERIES["feed_flags"](spark, sf001).collect()
    values = {}
    for r in flags:
        values.setdefault(r.key, set()).add(r.value)
        if r.key in ("badges", "sale", "categoria"):
            assert json.loads(r.payload) == {"input": {"metafields": [{"namespace": "custom", "key": r.key, "type": r.type,
                                                                       "value": r.value}], "id": r.owner_id}}
    assert values["sale"] == {"true", "false"} and values["badges"] == {'[""]', '["Entregamos antes do Natal"]'}
    assert values["tags"] == {"Ouro_Branco_Diamantes"} and len(values["categoria"]) > 2
    lookups = [json.loads(r.payload) for r in QUERIES["feed_metafield_lookup"](spark, sf001).collect()]
    assert {p["key"] for p in lookups} == {"badges", "sale"} and {p["name"] for p in lookups} == {"custom"}


def test_feed_activation(spark, sf001):
    rows = QUERIES["feed_activation"](spark, sf001).collect()
    assert len(rows) == 752
    p = json.loads(rows[0].payload)
    assert p["tracked"] is True
    assert [a["locationId"] for a in p["activations"]] == sorted(["loc-1001", "loc-1002", "loc-1003", "loc-2001", "loc-2002"])


def test_feed_text(spark, sf001):
    diff = {r.sku: r for r in QUERIES["text_diff"](spark, sf001).collect()}
    got = payloads(spark, sf001, "feed_text", "sku")
    assert set(got) == set(diff)
    for sku, p in got.items():
        assert p["input"]["descriptionHtml"] == (diff[sku].new_description or "").strip()
        [field] = p["metafields"]
        assert field["ownerId"] == p["input"]["id"] == f"prod-{sku}" and field["key"] == "composicao_text"


def test_response_split_first_error(spark, sf001):
    r = QUERIES["response_split"](spark, sf001)
    rej = r.filter("status = 'rejected'")
    assert rej.count() == rej.filter(F.col("message") == "Quantity below limit").count()
    assert r.filter("status = 'applied' AND message IS NOT NULL").count() == 0
