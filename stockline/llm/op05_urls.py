"""URL filter: curated rules, then empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are summed for each host, registered
domain and public suffix. A beta-binomial prior passes down the hierarchy:
the corpus rate is the prior mean of a suffix, its posterior mean that of a
domain, and that of the domain the prior mean of a host. The strength of the
prior of a level is estimated from the spread of its groups (method of
moments). A host is blocked when the lower bound of its posterior bad rate
reaches the threshold, so a few bad pages on a small host do not block it.

Only sums per host leave the scan (map-side combined), so a host with a third
of all pages is one row per task in the shuffle. The joins of host, domain and
suffix sums are plain joins on those sums; Spark broadcasts a side only below
its own size threshold and splits a skewed one.

Defined results: a null url, or one without ``://``, has an empty host and
path; such pages are judged as a host of their own (the empty one). Repeated
page ids are judged row by row; repeated outcomes of a page count once, bad if
any is bad. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Suffixes of two labels under which names are registered.
SECOND_LEVEL = ["co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp",
                "co.kr", "co.in", "com.br", "com.cn", "com.mx", "co.za", "com.ar", "com.tr"]


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = [Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    has = F.instr(u, "://") > 0
    rest = F.when(has, F.substr(u, F.instr(u, "://") + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (null: none). ``rules``
    is a curated list; it becomes one expression."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    two = F.substring_index(host, ".", -2)
    double = two.isin(SECOND_LEVEL)
    suffix = F.when(double, two).otherwise(F.substring_index(host, ".", -1))
    return suffix, F.when(double, F.substring_index(host, ".", -3)).otherwise(two)


def _shrunk(groups: DataFrame, key: str, prior: str, least: float, most: float) -> DataFrame:
    """Prior strength of one level by the method of moments, then the
    posterior mean of each group. groups: key, n, bad and the prior mean."""
    excess = F.sum(F.when(F.col("n") > 0, F.pow(F.col("bad") - F.col("n") * F.col(prior), 2)
                          - F.col("n") * F.col(prior) * (1 - F.col(prior))))
    pairs = F.sum(F.when(F.col("n") > 0, F.col("n") * (F.col("n") - 1) * F.col(prior) * (1 - F.col(prior))))
    # intra-class correlation rho = excess / pairs; strength = 1 / rho - 1
    rho = F.when(pairs > 0, F.greatest(excess / pairs, F.lit(0.0))).otherwise(0.0)
    strength = groups.agg(F.least(F.greatest(F.coalesce(1 / F.nullif(rho, F.lit(0.0)) - 1, F.lit(most)),
                                             F.lit(least)), F.lit(most)).alias("k")).first()["k"]
    return groups.withColumn("k", F.lit(float(strength))).withColumn(
        f"{key}_rate", (F.col("bad") + F.col("k") * F.col(prior)) / (F.col("n") + F.col("k")))


def reputation(pages: DataFrame, outcomes: DataFrame, least: float = 1.0, most: float = 1000.0,
               z: float = 1.645) -> DataFrame:
    """One row per host: host, domain, suffix, n, bad, rate (posterior mean)
    and bound (lower bound of the posterior). ``pages``: page_id, host;
    ``outcomes``: page_id, bad (0/1). Three prior strengths and the corpus
    rate, four numbers in all, pass through the driver."""
    judged = (outcomes.select("page_id", "bad").filter("page_id IS NOT NULL AND bad IS NOT NULL")
              .groupBy("page_id").agg(F.max("bad").alias("bad")))
    hosts = (pages.select("page_id", "host").join(judged, "page_id", "left").groupBy("host")
             .agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad")))
    suffix, domain = suffix_and_domain(F.col("host"))
    hosts = hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    corpus = (float(total["bad"] or 0) + 0.5) / (float(total["n"] or 0) + 1.0)

    def sums(*keys):
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    suffixes = _shrunk(sums("suffix").withColumn("corpus_rate", F.lit(corpus)), "suffix", "corpus_rate", least, most)
    domains = _shrunk(sums("domain", "suffix").join(suffixes.select("suffix", "suffix_rate"), "suffix"),
                      "domain", "suffix_rate", least, most)
    ranked = _shrunk(hosts.join(domains.select("domain", "suffix", "domain_rate"), ["domain", "suffix"]),
                     "host", "domain_rate", least, most)
    a = F.col("bad") + F.col("k") * F.col("domain_rate")
    total_weight = F.col("n") + F.col("k")
    spread = F.sqrt(a * (total_weight - a) / (total_weight * total_weight * (total_weight + 1)))
    return ranked.select("host", "domain", "suffix", "n", "bad", F.col("host_rate").alias("rate"),
                         F.greatest(F.lit(0.0), F.col("host_rate") - z * spread).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, rate, bound. The rule decides where
    one fits; else the page is blocked if its host's posterior bound reaches
    ``threshold``."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = reputation(split, outcomes).select("host", "rate", "bound")
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("bound") >= threshold, "block").otherwise("allow")
    return (split.join(known, "host", "left")
            .select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"),
                    "rate", "bound"))
