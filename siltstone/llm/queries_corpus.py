"""Queries on lines, phrases and ranked search over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.ball_tree_search import ranked
from siltstone.llm.common import query, table
from siltstone.llm.line_runs import without_repeated_lines
from siltstone.llm.phrase_mining import collocations


@query(
    """
    with numbered as (
        select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
    ), lines as (
        select r, doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as pos from numbered
    ), keyed as (
        select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
        from lines
    ), repeated as (
        select key, max(doc_id) as last from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3
    ), marked as (
        select keyed.*, coalesce(keyed.doc_id <> repeated.last, false) as gone from keyed left join repeated using (key)
    )
    select doc_id, count(*) as n_lines, cast(count_if(gone) as bigint) as n_dropped,
        sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
    from marked group by r, doc_id
    """
)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more in three documents or more stay in the largest id only."""
    left = without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    r"""
    with texts as (
        select row_number() over () as r, coalesce(lang, 'und') as lang,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
        from documents
    ), split as (
        select r, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from texts
    ), pieces as (
        select row_number() over () as p, lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from split
    ), words as (
        select p, lang, unnest(ws) as w, generate_subscripts(ws, 1) as i from pieces
    ), totals as (
        select lang, count(*) as n from words group by lang
    ), runs as (
        select lang, w as w1, lead(w, 1) over (partition by p order by i) as w2, lead(w, 2) over (partition by p order by i) as w3
        from words
    ), f1 as (
        select lang, w1 as phrase, count(*) as f from runs group by all
    ), f2 as (
        select lang, w1, w2, w1 || ' ' || w2 as phrase, count(*) as f from runs where w2 is not null group by all having count(*) >= 10
    ), f3 as (
        select lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 as phrase, count(*) as f
        from runs where w3 is not null group by all having count(*) >= 10
    ), cuts as (
        select f2.lang, f2.phrase, f2.f as a, 1 as k, x.f as l, y.f as r
        from f2 join f1 x on x.lang = f2.lang and x.phrase = w1 join f1 y on y.lang = f2.lang and y.phrase = w2
        union all
        select f3.lang, f3.phrase, f3.f, 1, x.f, y.f
        from f3 join f1 x on x.lang = f3.lang and x.phrase = f3.w1
            join f2 y on y.lang = f3.lang and y.w1 = f3.w2 and y.w2 = f3.w3
        union all
        select f3.lang, f3.phrase, f3.f, 2, x.f, y.f
        from f3 join f2 x on x.lang = f3.lang and x.w1 = f3.w1 and x.w2 = f3.w2
            join f1 y on y.lang = f3.lang and y.phrase = f3.w3
    ), scores as (
        select *, (1000000::hugeint * a * a) // (l::hugeint * r) as score from cuts
    ), lowest as (
        select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1
    ), inside as (
        select lang, w1 || ' ' || w2 as phrase, f from f3 union all select lang, w2 || ' ' || w3, f from f3
    ), covered as (
        select lang, phrase, max(f) as f from inside group by all
    ), ranked as (
        select l.*, row_number() over (partition by l.lang order by l.score desc, l.a desc, l.phrase) as rank
        from lowest l left join covered c on c.lang = l.lang and c.phrase = l.phrase
        where not coalesce(100 * c.f >= 50 * l.a, false)
    )
    select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score from ranked join totals using (lang) where rank <= 2000
    """
)
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two or three words."""
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


@query(
    r"""
    with texts as (
        select row_number() over () as r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts
        from documents
    ), items as (
        select row_number() over () as q, item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t
        from benchmark
    ), totals as (
        select count_if(len(ts) > 0)::bigint as docs, sum(len(ts))::bigint as terms from texts
    ), tfs as (
        select r, doc_id, len(ts) as n, t, count(*) as tf from (select r, doc_id, ts, unnest(ts) as t from texts) group by all
    ), weights as (
        select t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from tfs, totals group by t, docs
    ), impacts as (
        select r, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))) as x
        from tfs join weights using (t), totals
    ), scores as (
        select q, item_id, r, doc_id, sum(x)::bigint as score from items join impacts using (t) group by all
    )
    select item_id, row_number() over (partition by q order by score desc, doc_id)::integer as rank, doc_id, score
    from scores where score > 0
    qualify rank <= 10
    """
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
