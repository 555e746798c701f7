"""URL filter: explicit host and path rules, else an empirical-Bayes host
reputation.

Reputation: labelled pages give each host (bad, n). A beta-binomial model
shrinks host to registered domain to suffix to the whole table: a level's
posterior mean is the prior mean of the level below, and the prior's
strength at each level is estimated from the spread of its groups (method
of moments). A host is blocked when the lower posterior bound of its bad
rate, mean - z * sd, is above `max_bad`.

Everything is DataFrame code: the host table is an aggregate of the pages
(one row per host, folded on the map side), joined back by host, where
adaptive execution splits a hot host. The driver sees three prior strengths
and one rate.

Defined results: a null url, or one without "://", has empty host and path.
A null host label or page id gives no outcome. Repeated labels of a page
count once each. An unlabelled host takes its domain's posterior, an unknown
domain its suffix's, and with no labels at all nothing is blocked. A port
belongs to the host, but not to its domain and suffix. A numerical or
bracketed address is its own registered domain with an empty suffix. Repeated
rows of pages count each; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import ascii_lower, staged

# Public suffixes of two labels; any other suffix is one label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp",
                      "co.kr", "com.br", "com.mx", "com.ar", "com.cn", "com.tr", "co.in", "co.za")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def without_port(host: Column) -> Column:
    return F.regexp_replace(host, r":[0-9]*$", "")


def suffix_of(host: Column) -> Column:
    name = without_port(host)
    two = F.substring_index(name, ".", -2)
    return (F.when(name.rlike(r"^[0-9.]*$") | name.startswith("["), F.lit(""))
            .when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(name, ".", -1)))


def domain_of(host: Column) -> Column:
    name, suffix = without_port(host), suffix_of(host)
    return (F.when(suffix == "", name).when(suffix.contains("."), F.substring_index(name, ".", -3))
            .otherwise(F.substring_index(name, ".", -2)))


def match_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest fitting rule, else nulls. The
    rules are a short list in the plan, tried from the longest."""
    text = verdict = None
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the last tried stands outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text if text is not None else F.lit(None).cast("string"))
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict if verdict is not None else F.lit(None).cast("string"))
    return (text, verdict) if rules else (F.lit(None).cast("string"),) * 2


def _moments(levels: dict[str, DataFrame]) -> dict[str, Row]:
    """Sums over the groups (bad, n) of each level, all in one action."""
    groups = reduce(lambda a, b: a.unionAll(b), (g.select(F.lit(x).alias("level"), "bad", "n") for x, g in levels.items()))
    made = groups.where("n > 0").groupBy("level").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.sum("bad").alias("bad"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("b2"))
    none = Row(k=0, n=0, n2=0, bad=0, b2=0.0)
    return {x: none for x in levels} | {r.level: r for r in made.collect()}


def _strength(r: Row) -> float:
    """Prior strength a + b of a beta-binomial level, by its moments."""
    if r.k < 2:
        return 10.0
    m = r.bad / r.n
    within, room = m * (1 - m), r.n - r.n2 / r.n - (r.k - 1)
    if within == 0 or room <= 0:
        return 10.0
    spread = (r.b2 - r.n * m * m) - (r.k - 1) * within
    rho = min(max(spread / (within * room), 1e-4), 0.5)
    return 1 / rho - 1


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Posterior (mean, sd) of the bad rate per host of `pages`.

    pages: page_id, host; outcomes: page_id, bad (0 or 1, null: ignored)."""
    labelled = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(
        F.sum("bad").alias("_bad"), F.count("*").alias("_n"))
    hosts = (pages.join(labelled, "page_id", "left").groupBy("host")
             .agg(F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
             .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))))
    hosts = staged(hosts, "url-hosts")  # all levels below read this
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    moments = _moments({"suffix": suffixes, "domain": domains, "host": hosts})
    total = moments["suffix"]
    rate = (total.bad + 1) / (total.n + 20)  # one bad page in twenty, before any label

    def mean(prior: Column, s: float) -> Column:
        return (prior * s + F.col("bad")) / (F.lit(s) + F.col("n"))

    s1, s2, s3 = (_strength(moments[x]) for x in ("suffix", "domain", "host"))
    by_suffix = suffixes.select("suffix", mean(F.lit(rate), s1).alias("suffix_rate"))
    by_domain = domains.join(by_suffix, "suffix").select("domain", mean(F.col("suffix_rate"), s2).alias("domain_rate"))
    post = hosts.join(by_domain, "domain").withColumn("bad_rate", mean(F.col("domain_rate"), s3))
    sd = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.lit(s3) + F.col("n") + 1))
    return post.select("host", "domain", "suffix", "n", "bad", "bad_rate", sd.alias("bad_sd"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], z: float = 1.645,
                max_bad: float = 0.25) -> DataFrame:
    """Per row of `pages` (page_id, url): host, path, rule, verdict, and the
    host's bad_rate and lower bound."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    bound = F.greatest(F.lit(0.0), F.col("bad_rate") - z * F.col("bad_sd"))
    return (rows.join(host_reputation(rows.select("page_id", "host"), outcomes), "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"), verdict.alias("_by_rule"),
                    "bad_rate", bound.alias("bad_bound"))
            .withColumn("verdict", F.coalesce("_by_rule", F.when(F.col("bad_bound") > max_bad, "block").otherwise("allow")))
            .drop("_by_rule"))
