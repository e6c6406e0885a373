"""Scalar rules: text, casts, dates, bands and flags."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from siltstone.functions import buckets, casts, dates, text
from siltstone.operators.aggregates import case_styles, count_where_true
from siltstone.operators.columns import as_clean_strings, normalise_headers, with_parsed_date
from siltstone.workload import dialect as D
from siltstone.workload import raw
from siltstone.workload.registry import query, table

SIZE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
SEGMENT_GROUPS = {"Home": ["FURNITURE", "HOUSEHOLD"], "Industry": ["MACHINERY", "AUTOMOBILE"]}
CUT_OFF = date(2000, 1, 1)

_SHEET_SQL = raw.SHEET.sql()


@query(
    D.with_tables(
        "select event_id, try_strptime(stamp, '%Y-%m-%dT%H:%M:%SZ') as last_updated from e",
        e=raw.ISO_EVENTS.sql(),
    )
)
def iso_timestamp_parse(spark, sf_dir):
    events = raw.ISO_EVENTS.frame(spark, sf_dir)
    return events.select("event_id", dates.iso_timestamp(F.col("stamp")).alias("last_updated"))


@query(
    D.with_tables(
        "select "
        + ", ".join(f"{D.strip(f'cast({c} as varchar)')} as {c}" for c in raw.SHEET_HEADERS)
        + " from s",
        s=_SHEET_SQL,
    )
)
def sheet_strings(spark, sf_dir):
    return as_clean_strings(raw.SHEET.frame(spark, sf_dir))


@query(D.with_tables("select order_key, order_status, order_total, clerk from s", s=_SHEET_SQL))
def header_normalise(spark, sf_dir):
    sheet = raw.SHEET.frame(spark, sf_dir).withColumnsRenamed(raw.SHEET_HEADERS)
    return normalise_headers(sheet)


@query(
    "select p_partkey, "
    + D.bands("case when p_partkey % 13 = 5 then null else p_size * 2 end", SIZE_BANDS, "65+")
    + " as age_group from part"
)
def range_bucket(spark, sf_dir):
    age = F.when(F.expr("p_partkey % 13 <> 5"), F.col("p_size") * 2)
    return table(spark, sf_dir, "part").select("p_partkey", buckets.age_group(age).alias("age_group"))


@query(
    "select c_custkey, "
    + D.groups("c_mktsegment", SEGMENT_GROUPS, "Other")
    + " as segment_group from customer"
)
def value_map(spark, sf_dir):
    group = buckets.group_of(F.col("c_mktsegment"), SEGMENT_GROUPS, "Other")
    return table(spark, sf_dir, "customer").select("c_custkey", group.alias("segment_group"))


@query(
    D.with_tables(
        f"select customer_id, ingest_seq, {D.title('name')} as name from c", c=raw.CUSTOMERS.sql()
    )
)
def title_case(spark, sf_dir):
    customers = raw.CUSTOMERS.frame(spark, sf_dir)
    return customers.select("customer_id", "ingest_seq", text.title_case(F.col("name")).alias("name"))


@query(
    D.with_tables(
        """select customer_id, ingest_seq, lower(email) as email,
            string_split(lower(email), '@')[2] as email_domain from c""",
        c=raw.CUSTOMERS.sql(),
    )
)
def email_domain(spark, sf_dir):
    customers = raw.CUSTOMERS.frame(spark, sf_dir).withColumn("email", F.lower("email"))
    domain = text.email_domain(F.col("email"))
    return customers.select("customer_id", "ingest_seq", "email", domain.alias("email_domain"))


@query(
    D.with_tables(
        f"select ingest_seq, upper({D.strip('order_status')}) as order_status from o",
        o=raw.ORDERS.sql(),
    )
)
def status_normalise(spark, sf_dir):
    orders = raw.ORDERS.frame(spark, sf_dir)
    return orders.select("ingest_seq", text.clean_upper(F.col("order_status")).alias("order_status"))


@query(
    D.with_tables(
        f"""select ingest_seq,
            upper({D.strip('order_status')}) in ('CANCELLED', 'REFUNDED') as is_cancelled from o""",
        o=raw.ORDERS.sql(),
    )
)
def cancel_flag(spark, sf_dir):
    orders = raw.ORDERS.frame(spark, sf_dir)
    flag = buckets.is_cancelled(text.clean_upper(F.col("order_status")))
    return orders.select("ingest_seq", flag.alias("is_cancelled"))


@query(
    D.with_tables(
        f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
            {D.whole('whole')} as whole, {D.number('amount')} as amount from n""",
        n=raw.NUMBER_TEXTS.sql(),
    )
)
def lenient_cast(spark, sf_dir):
    numbers = raw.NUMBER_TEXTS.frame(spark, sf_dir)
    return numbers.withColumns(
        {"whole": casts.to_long(F.col("whole")), "amount": casts.to_double(F.col("amount"))}
    )


@query(
    D.with_tables(
        f"select customer_id, spend, {D.spend_stamp('spend')} as spend_date_parsed from s",
        s=raw.SALES.sql(),
    )
)
def multi_format_dates(spark, sf_dir):
    sales = raw.SALES.frame(spark, sf_dir).select("customer_id", "spend")
    return with_parsed_date(
        sales, "spend", "spend_date_parsed", dates.unquoted, dates.spend_timestamp
    )


@query(
    D.with_tables(
        f"""select customer_id, spend,
            {D.long_stamp(f"replace({D.strip('spend')}, chr(34), '')")} as long_date from s""",
        s=raw.SALES.sql(),
    )
)
def long_dates(spark, sf_dir):
    sales = raw.SALES.frame(spark, sf_dir).select("customer_id", "spend")
    return with_parsed_date(sales, "spend", "long_date", dates.unquoted, dates.long_date)


@query(
    f"""select o_orderkey, {D.calendar('d', 'order')} from
        (select o_orderkey, case when o_orderkey % 9 = 4 then null else o_orderdate end as d
         from orders)"""
)
def date_parts(spark, sf_dir):
    stamp = F.when(F.expr("o_orderkey % 9 <> 4"), F.col("o_orderdate"))
    parts = dates.calendar_parts(stamp, "order")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", *[column.alias(name) for name, column in parts.items()]
    )


_UNDATED_SQL = """select *, case when l_orderkey % 9 = 4 then null else l_shipdate end as d
    from lineitem"""


def _with_gaps(spark, sf_dir):
    gap = F.when(F.expr("l_orderkey % 9 <> 4"), F.col("l_shipdate"))
    return table(spark, sf_dir, "lineitem").withColumn("d", gap)


@query(
    D.with_tables(
        """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
            d > timestamp '2000-01-01' as is_future_date from l""",
        l=_UNDATED_SQL,
    )
)
def future_flag(spark, sf_dir):
    flag = dates.is_after(F.col("d"), CUT_OFF)
    return _with_gaps(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", flag.alias("is_future_date")
    )


@query(
    D.with_tables(
        "select count(*) filter (d > timestamp '2000-01-01') as future_count from l",
        l=_UNDATED_SQL,
    )
)
def future_count(spark, sf_dir):
    flagged = _with_gaps(spark, sf_dir).select(dates.is_after(F.col("d"), CUT_OFF).alias("late"))
    return count_where_true(flagged, "late", "future_count")


@query(
    D.with_tables(
        f"""select customer_id, spend, sales_amount, channel,
            {D.spend_stamp('spend')} is not null as has_valid_date,
            {D.number('sales_amount')} is not null as has_valid_amount from s""",
        s=raw.SALES.sql(),
    )
)
def presence_flags(spark, sf_dir):
    sales = with_parsed_date(
        raw.SALES.frame(spark, sf_dir), "spend", "day", dates.unquoted, dates.spend_timestamp
    )
    flags = {
        "has_valid_date": F.col("day").isNotNull(),
        "has_valid_amount": casts.to_double(F.col("sales_amount")).isNotNull(),
    }
    return sales.withColumns(flags).drop("day")


@query(
    D.with_tables(
        """select count(*) filter (name = upper(name)) as all_upper,
            count(*) filter (name = lower(name)) as all_lower,
            count(*) - count(*) filter (name = upper(name))
                - count(*) filter (name = lower(name)) as mixed from c""",
        c=raw.CUSTOMERS.sql(),
    )
)
def case_style_counts(spark, sf_dir):
    return case_styles(raw.CUSTOMERS.frame(spark, sf_dir), "name")
