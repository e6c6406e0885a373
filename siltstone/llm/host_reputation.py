"""URL filter: rules, then empirical-Bayes host reputation. DataFrame functions only.

Labelled page outcomes (bad or not) are counted for each host, registered domain (one
label more than the suffix) and suffix (the last label, or two of them in
TWO_LABEL_SUFFIXES); user and port are no part of the domain. Each level is a
beta-binomial whose prior is the posterior of the level above (all pages, suffix, domain,
host) without the group's own pages, so that no outcome counts twice. Its strength comes
from the scatter of the level's counts around it (moments), and is less where little is
known above: the variances add. A host is blocked if the lower posterior bound of its rate of bad pages,
mean - z * standard deviation, is over `limit`: a few bad pages of a small host do
not block it, nor do they fail to once its neighbours are bad too.

A null url, or one without `://`, has an empty host and path; such pages are a host
of their own. Outcomes with null ids or values are left out. Repeated pages count
and are judged each. A host with a third of all pages is one row per task in the
counts, and its partition of the join back is one that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import own_shuffle, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Z = 1.645
LIMIT = 0.5
LEVELS = ("suffix", "domain", "host")

# Public suffixes of two labels, under which the third is registered.
TWO_LABEL_SUFFIXES = (
    "ac.jp", "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn",
    "com.hk", "com.mx", "com.sg", "com.tr", "com.tw", "edu.au", "gov.au", "gov.uk", "me.uk", "ne.jp", "net.au",
    "or.jp", "org.au", "org.nz", "org.uk",
)

Rule = tuple[str, str, str]


def host_and_path(url: str) -> tuple[Column, Column]:
    rest = F.coalesce(F.regexp_extract(url, "(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matched_rule(rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits, or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        found = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _strength(rows: DataFrame) -> float:
    """Prior strength of groups (n, bad) around their means `prior`, from the excess scatter."""
    spread = F.col("prior") * (1 - F.col("prior"))
    off = F.col("bad") - F.col("n") * F.col("prior")
    over, scale = rows.agg(F.sum(off * off - F.col("n") * spread), F.sum(F.col("n") * (F.col("n") - 1) * spread)).first()
    correlation = min(max((over or 0.0) / scale if scale else 0.0, 0.001), 0.5)
    return 1 / correlation - 1


def reputations(hosts: DataFrame) -> DataFrame:
    """(host, rate, bound) from `hosts` (host, n, bad)."""
    name = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index("name", ".", -2)
    long = two.isin(*TWO_LABEL_SUFFIXES)
    hosts = hosts.select(
        "host", F.col("n").cast("double").alias("n"), F.col("bad").cast("double").alias("bad"), name.alias("name")
    ).select(
        "host", "n", "bad",
        F.when(long, F.substring_index("name", ".", -3)).otherwise(two).alias("domain"),
        F.when(long, two).otherwise(F.substring_index("name", ".", -1)).alias("suffix"),
    )
    hosts = written(hosts, "hosts")
    n, bad = (x or 0.0 for x in hosts.agg(F.sum("n"), F.sum("bad")).first())
    above = None
    for level, name in enumerate(LEVELS):
        keys = list(LEVELS[: level + 1])
        rows = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if above is None:
            rows = rows.withColumns({"all_weight": F.lit(1 + n), "all_bad": F.lit(0.5 + bad)})
        else:
            rows = rows.join(own_shuffle(above, *keys[:-1]), keys[:-1])
        others = F.col("all_weight") - F.col("n")
        rows = rows.withColumns({"weight": others, "prior": (F.col("all_bad") - F.col("bad")) / others})
        rows = written(rows.drop("all_weight", "all_bad"), name)
        strength = 1 / (1 / F.lit(_strength(rows)) + 1 / F.col("weight"))
        above = rows.select(
            *keys, (strength + F.col("n")).alias("all_weight"), (strength * F.col("prior") + F.col("bad")).alias("all_bad")
        )
    rate = (strength * F.col("prior") + F.col("bad")) / (strength + F.col("n"))
    deviation = F.sqrt(rate * (1 - rate) / (strength + F.col("n") + 1))
    return rows.select("host", rate.alias("rate"), (rate - Z * deviation).alias("bound"))


def judged(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], limit: float = LIMIT) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page; `outcomes` is (page_id, bad 0 or 1)."""
    host, path = host_and_path("url")
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.filter("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    counted = split.join(own_shuffle(known, "page_id"), "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    blocked = reputations(counted).select("host", (F.col("bound") > limit).alias("blocked"))
    rule = matched_rule(rules)
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return split.join(own_shuffle(blocked, "host"), "host", "left").select(
        "page_id", "host", "path", rule["rule"].alias("rule"), F.coalesce(rule["verdict"], own).alias("verdict")
    )
