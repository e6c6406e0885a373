"""Queries of the operators on pages and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import query, table
from siltstone.llm.host_reputation import TWO_LABEL_SUFFIXES, judged
from siltstone.llm.vector_dedup import near_vectors

# The rules the pages are judged by, as (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query()
def op2_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked by a cosine of 0.95 or more."""
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)

_STRENGTH_SQL = """1 / least(greatest(coalesce(sum((bad - n * prior) * (bad - n * prior) - n * prior * (1 - prior))
        / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0), 0), 0.001), 0.5) - 1"""


@query(
    r"""
    with split as (
        select page_id,
            translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
        from (select page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') as rest from pages)
    ), known as (
        select doc_id as page_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad from labels group by 1
    ), hosts as (
        select host, count(bad)::double as n, coalesce(sum(bad), 0)::double as bad,
            string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') as labels
        from split left join known using (page_id) group by host
    ), named as (
        select *, array_to_string(labels[greatest(len(labels) - 1, 1):], '.') as two, two in ({suffixes}) as long,
            case when long then two else labels[-1] end as suffix,
            case when long then array_to_string(labels[greatest(len(labels) - 2, 1):], '.') else two end as domain
        from hosts
    ), suffix0 as (
        select u.*, all_n - n as weight, (all_bad - bad) / weight as prior
        from (select suffix, sum(n) as n, sum(bad) as bad from named group by suffix) u,
            (select 1 + sum(n) as all_n, 0.5 + sum(bad) as all_bad from hosts)
    ), suffix1 as (select {strength} as k from suffix0
    ), suffix2 as (select *, 1 / (1 / k + 1 / weight) as s from suffix0, suffix1
    ), domain0 as (
        select d.*, u.s + u.n - d.n as weight, (u.s * u.prior + u.bad - d.bad) / (u.s + u.n - d.n) as prior
        from (select suffix, domain, sum(n) as n, sum(bad) as bad from named group by all) d join suffix2 u using (suffix)
    ), domain1 as (select {strength} as k from domain0
    ), domain2 as (select *, 1 / (1 / k + 1 / weight) as s from domain0, domain1
    ), host0 as (
        select h.host, h.n, h.bad, u.s + u.n - h.n as weight, (u.s * u.prior + u.bad - h.bad) / (u.s + u.n - h.n) as prior
        from named h join domain2 u using (suffix, domain)
    ), host1 as (select {strength} as k from host0
    ), host2 as (select *, 1 / (1 / k + 1 / weight) as s from host0, host1
    ), rates as (select host, n + s + 1 as weight, (s * prior + bad) / (s + n) as rate from host2
    ), ruled as (
        select split.*, case
            when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
            when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
            when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
            when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
            when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/'
        end as rule from split
    )
    select page_id, host, path, rule, case
        when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
        when rate - 1.645 * sqrt(rate * (1 - rate) / weight) > 0.5 then 'block' else 'allow' end as verdict
    from ruled join rates using (host)
    """.replace("{suffixes}", ", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)).replace("{strength}", _STRENGTH_SQL)
)
def op3_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages; a labelled page is bad if its text is of low quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judged(table(spark, sf_dir, "pages"), outcomes, RULES)
