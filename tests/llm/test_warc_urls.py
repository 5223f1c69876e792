import gzip
import math

import pytest
from helpers import frame

from stockline.llm import op04_warc as op4
from stockline.llm import op05_urls as op5

PAGES = "page_id long, url string, html string"


def test_round_trip(spark, tmp_path):
    rows = [(1, "http://a/", "x" * 10), (2, None, "x" * 10), (3, "http://b/ c\n", None), (4, "u", ""), (5, "u", "é\r\n\r\n\0日"),
            (6, "u", "y" * 17_000_000), (7, "u", "z"), (7, "u", "z"), (None, "u", "q")]
    path = str(tmp_path / "w")
    op4.write_archives(frame(spark, rows, PAGES).selectExpr("*", "'clash' as digest", "1 as refers_to"), path)
    got = {}
    for r in op4.read_archives(spark, path).collect():
        assert r.digest_ok
        got.setdefault(r.page_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    types = {k: (v[0].record_type, v[0].refers_to, v[0].payload_bytes) for k, v in got.items()}
    assert types == {1: ("revisit", 2, 10), 2: ("response", None, 10), 3: ("revisit", 4, 0), 4: ("response", None, 0),
                     5: ("response", None, 10), 6: ("response", None, 17_000_000), 7: ("response", None, 1),
                     None: ("response", None, 1)}
    assert got[5][0].payload == "é\r\n\r\n\0日" and got[1][0].payload_digest == op4.base32_sha1(b"x" * 10)
    for f in (tmp_path / "w").glob("part-*"):  # plain concatenated gzip members
        assert f.stat().st_size == 0 or gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n")


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "w")
    op4.write_archives(spark.createDataFrame([], PAGES), path)
    assert op4.read_archives(spark, path).count() == 0


def test_broken_archives():
    good = op4._member(op4._record(1, "u", b"body", "response", None, 4, op4.base32_sha1(b"body")))
    assert [r.block.endswith(b"body") for r in op4.read_records(good * 3)] == [True] * 3
    with pytest.raises(ValueError, match="cut short"):
        list(op4.read_records(good + good[:-9]))
    with pytest.raises(ValueError, match="framing"):
        list(op4.read_records(op4._member(gzip.decompress(good)[:-1])))
    with pytest.raises(ValueError, match="no record header"):
        list(op4.read_records(op4._member(b"hello\r\n\r\n")))
    with pytest.raises(ValueError, match="at 0"):
        list(op4.read_records(b"not gzip"))
    changed = op4._member(gzip.decompress(good).replace(b"body", b"bodx"))
    assert next(op4.read_records(changed)).headers["warc-payload-digest"] != "sha1:" + op4.base32_sha1(b"bodx")


URLS = [(1, "http://WWW.Example.com/en/x?y#z"), (2, "https://m.example.com/en/"), (3, "http://a.net/es/1"), (4, "http://net/fr/"),
        (5, "http://a.net/fr"), (6, "no host"), (7, None), (8, "x://h"), (9, "x://h?q=/a#/b"), (10, "x://h#/en/"), (11, "http://a.com"),
        (12, "http://com/"), (13, "http://xcom/"), (14, "a://b://c/d"), (15, ""), (15, "")]


def test_hosts_and_rules(spark):
    out = op5.judge_urls(frame(spark, URLS, "page_id long, url string").selectExpr("*", "1 as host", "2 as rate"),
                         spark.createDataFrame([], "page_id long, bad int"), op5.RULES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert out.count() == len(URLS)
    assert got == {
        1: ("www.example.com", "/en/x", "www.example.com/en/", "allow"), 2: ("m.example.com", "/en/", "example.com/en/", "block"),
        3: ("a.net", "/es/1", "net/es/", "block"), 4: ("net", "/fr/", "net/fr/", "block"), 5: ("a.net", "/fr", None, "allow"),
        6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("h", "", None, "allow"), 9: ("h", "", None, "allow"),
        10: ("h", "", None, "allow"), 11: ("a.com", "", None, "allow"), 12: ("com", "/", "com/", "allow"),
        13: ("xcom", "/", None, "allow"), 14: ("b:", "//c/d", None, "allow"), 15: ("", "", None, "allow")}


def test_reputation_against_plain_formulas(spark):
    pages = [(i, f"h{i % 7}.d{i % 3}.co.uk" if i % 2 else f"h{i % 5}.e{i % 4}.org") for i in range(400)]
    bad = [(i, int(i % 7 == 3 or i % 11 == 0)) for i in range(0, 400, 2)] + [(1, 1), (1, 0), (None, 1), (3, None)]
    outcome = {}
    for i, b in bad:
        if i is not None and b is not None:
            outcome[i] = max(b, outcome.get(i, 0))

    def sums(key):
        out = {}
        for i, h in pages:
            n, b = out.setdefault(key(h), [0, 0])
            out[key(h)] = [n + (i in outcome), b + outcome.get(i, 0)]
        return out

    def suffix(h):
        return "co.uk" if h.endswith(".co.uk") else h.split(".")[-1]

    def domain(h):
        return ".".join(h.split(".")[-3 if suffix(h) == "co.uk" else -2:])

    def strength(groups, prior):
        excess = sum((b - n * prior(k)) ** 2 - n * prior(k) * (1 - prior(k)) for k, (n, b) in groups.items() if n)
        pairs = sum(n * (n - 1) * prior(k) * (1 - prior(k)) for k, (n, b) in groups.items() if n)
        rho = max(excess / pairs, 0) if pairs > 0 else 0
        return min(max(1 / rho - 1, 1.0), 1000.0) if rho else 1000.0

    everything = sums(lambda h: "")[""]
    corpus = (everything[1] + .5) / (everything[0] + 1)
    s = sums(suffix)
    ks = strength(s, lambda k: corpus)
    rate_s = {k: (b + ks * corpus) / (n + ks) for k, (n, b) in s.items()}
    d = sums(domain)
    kd = strength(d, lambda k: rate_s[suffix(k)])
    rate_d = {k: (b + kd * rate_s[suffix(k)]) / (n + kd) for k, (n, b) in d.items()}
    h = sums(lambda x: x)
    kh = strength(h, lambda k: rate_d[domain(k)])
    got = op5.reputation(frame(spark, pages, "page_id long, host string"), frame(spark, bad, "page_id long, bad int")).collect()
    assert {r.host for r in got} == set(h)
    for r in got:
        n, b = h[r.host]
        a, w = b + kh * rate_d[domain(r.host)], n + kh
        assert r.rate == pytest.approx(a / w)
        assert r.bound == pytest.approx(max(0, a / w - 1.645 * math.sqrt(a * (w - a) / (w * w * (w + 1)))))
