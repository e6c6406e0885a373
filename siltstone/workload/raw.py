"""Dirty inputs worked out from the clean test tables.

The test tables hold no nulls, bad numbers or mixed formats, so each raw table
here spoils some rows by a rule on the key. The column formulas are SQL that
Spark and DuckDB read alike, which gives both engines the same input; everything
after that is written twice, as library calls and as SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Full month names in order.
MONTHS = (
    "January,February,March,April,May,June,July,August,September,October,November,December"
)


@dataclass(frozen=True)
class RawTable:
    """`source` rows, those fitting `twice` given twice with `copy` 0 and 1.

    `given` names intermediate values the column formulas use more than once.
    """

    source: str
    columns: dict[str, str]
    twice: str = "false"
    given: dict[str, str] = field(default_factory=dict)

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.read.parquet(f"{sf_dir}/{self.source}.parquet")
        copies = "0" if self.twice == "false" else self._copies()
        given = [f"{sql} as {name}" for name, sql in self.given.items()]
        numbered = rows.selectExpr("*", *given, f"{copies} as copy")
        return numbered.selectExpr(*[f"{sql} as {name}" for name, sql in self.columns.items()])

    def _copies(self) -> str:
        return f"explode(case when {self.twice} then array(0, 1) else array(0) end)"

    def sql(self) -> str:
        given = "".join(f", {sql} as {name}" for name, sql in self.given.items())
        columns = ", ".join(f"{sql} as {name}" for name, sql in self.columns.items())
        return (
            f"select {columns} from (select *{given} from {self.source}),"
            f" (values (0), (1)) c(copy) where copy = 0 or ({self.twice})"
        )


def _text(value: str) -> str:
    return f"cast({value} as string)"


def _day(stamp: str) -> str:
    return f"cast(cast({stamp} as date) as string)"


def _us(day: str) -> str:
    return f"substr({day}, 6, 2) || '/' || substr({day}, 9, 2) || '/' || substr({day}, 1, 4)"


def _loose(stamp: str) -> str:
    parts = [_text(f"{part}({stamp})") for part in ("year", "month", "day")]
    return " || '-' || ".join(parts)


def _long(stamp: str) -> str:
    month = f"split_part('{MONTHS}', ',', cast(month({stamp}) as int))"
    return f"{month} || ' ' || {_text(f'day({stamp})')} || ', ' || {_text(f'year({stamp})')}"


def _money(value: str) -> str:
    return _text(f"cast({value} as decimal(18, 2))")


ORDERS = RawTable(
    "orders",
    {
        "order_id": f"case when o_orderkey % 997 = 5 then null else 'O' || {_text('o_orderkey')} end",
        "customer_id": f"""case
            when o_orderkey % 11 = 3 then 'n/a'
            when o_orderkey % 13 = 4 then {_text('o_custkey')} || '.0'
            when o_orderkey % 17 = 6 then ' ' || {_text('o_custkey')} || chr(9)
            when o_orderkey % 19 = 2 then null
            when o_orderkey % 41 = 7 then '99999999999'
            else {_text('o_custkey')} end""",
        "order_amount": f"""case
            when o_orderkey % 23 = 1 then 'unknown'
            when o_orderkey % 29 = 2 then null
            when o_orderkey % 31 = 3 then '1.5e3'
            when o_orderkey % 37 = 4 then 'NaN'
            when o_orderkey % 43 = 5 then '12d'
            else {_money('o_totalprice + copy')} end""",
        "order_date": f"""case
            when o_orderkey % 7 = 0 then day_text || ' 10:30:00'
            when o_orderkey % 7 = 1 then '  ' || day_text || chr(9)
            when o_orderkey % 7 = 2 then {_loose('o_orderdate')}
            when o_orderkey % 21 = 3 then 'not a date'
            when o_orderkey % 14 = 5 then {_us('day_text')}
            when o_orderkey % 47 = 6 then '2023-02-30'
            else day_text end""",
        "order_status": """case o_orderkey % 6
            when 0 then 'shipped'
            when 1 then ' Cancelled '
            when 2 then chr(9) || 'refunded'
            when 3 then 'DELIVERED'
            when 4 then null
            else lower(o_orderstatus) end""",
        "product_id": f"""case
            when o_orderkey % 37 = 9 then 'P-none'
            else 'P' || {_text('cast(floor(o_orderkey / 8) as bigint)')} end""",
        "ingest_seq": "o_orderkey * 2 + copy",
    },
    twice="o_orderkey % 10 = 0",
    given={"day_text": _day("o_orderdate")},
)

ORDERS_WITH_HOLES = RawTable(
    "orders",
    {
        name: f"case when o_orderkey % 101 = 3 then null else {sql} end"
        for name, sql in {
            "order_id": "o_orderkey",
            "customer_id": "case when o_orderkey % 7 = 2 then null else o_custkey end",
            "order_amount": "case when o_orderkey % 5 = 1 then null else o_totalprice end",
            "order_status": "case when o_orderkey % 3 = 1 then null else o_orderstatus end",
        }.items()
    },
    twice="o_orderkey % 10 = 0",
)

CUSTOMERS = RawTable(
    "customer",
    {
        "customer_id": f"""case
            when c_custkey % 211 = 7 then null
            when c_custkey % 23 = 9 then 'A' || {_text('c_custkey')}
            else {_text('c_custkey')} end""",
        "name": """case c_custkey % 3
            when 0 then upper(c_mktsegment || ' ' || c_name)
            when 1 then lower(c_mktsegment || ' ' || c_name)
            else 'mARY-jane  o' || chr(39) || 'brien' || chr(9) || 'van ' || lower(c_name) end""",
        "email": f"""case
            when c_custkey % 7 = 3 then 'NOBODY' || {_text('c_custkey')}
            when c_custkey % 17 = 5 then null
            when c_custkey % 19 = 4 then 'A@B@C'
            else 'User' || {_text('c_custkey')} || '@' || c_mktsegment || '.COM' end""",
        "age": """cast(case
            when c_custkey % 31 = 6 then null
            else (c_custkey * 7) % 80 + 10 end as bigint)""",
        "country": """case c_custkey % 10
            when 0 then 'United States'
            when 1 then 'France'
            when 2 then 'India'
            when 3 then 'Australia'
            when 4 then 'South Africa'
            when 5 then 'UAE'
            when 6 then 'Norway'
            when 7 then null
            when 8 then 'Brazil'
            else 'Switzerland' end""",
        "last_updated": f"""case
            when c_custkey % 53 = 8 then 'unknown'
            when c_custkey % 59 = 3 then '2024-01-05T00:00:00.123Z'
            else '2024-01-'
                || lpad({_text('''(c_custkey * 5
                    + case when c_custkey % 8 = 0 then 0 else copy * 3 end) % 28 + 1''')}, 2, '0')
                || 'T' || lpad({_text('c_custkey % 24')}, 2, '0') || ':00:00Z' end""",
        "ingest_seq": "c_custkey * 2 + copy",
    },
    twice="c_custkey % 4 = 0",
)

# A later file: columns absent and in another order; rows past the mark, before it, and undated.
CUSTOMERS_LATER = RawTable(
    "customer",
    {
        "last_updated": f"""case c_custkey % 4
            when 0 then '2024-02-' || lpad({_text('c_custkey % 28 + 1')}, 2, '0') || 'T08:00:00Z'
            when 1 then '2024-01-01T00:00:00Z'
            when 2 then 'unknown'
            else '2024-02-29T00:00:00.5Z' end""",
        "customer_id": f"""case
            when c_custkey % 23 = 9 then 'A' || {_text('c_custkey')}
            else '0' || {_text('c_custkey')} end""",
        "country": "'India'",
        "email": f"'later' || {_text('c_custkey')} || '@later.org'",
    },
)

ACCOUNTS = RawTable(
    "customer",
    {
        "customer_id": f"""case
            when c_custkey % 13 = 4 then 'x' || {_text('c_custkey')}
            when c_custkey % 17 = 6 then null
            when c_custkey % 19 = 3 then {_text('c_custkey')} || '.0'
            else {_text('c_custkey')} end""",
        "account_type": """case
            when copy = 1 then 'BUSINESS'
            when c_custkey % 4 = 0 then ' premium '
            when c_custkey % 4 = 1 then 'STANDARD plus'
            when c_custkey % 4 = 2 then chr(9) || 'basic'
            else null end""",
        "country": """case c_custkey % 3
            when 0 then ' france '
            when 1 then 'United States'
            else chr(9) || 'uae' end""",
        "ingest_seq": "c_custkey * 2 + copy",
    },
    twice="c_custkey % 5 = 0",
)

# Customer ids come from the part key: its range covers the customers and goes
# past them, so some sales have no customer, and no join is needed to get one.
SALES = RawTable(
    "lineitem",
    {
        "customer_id": f"""case
            when l_orderkey % 13 = 4 then 'x' || {_text('l_partkey')}
            when l_orderkey % 17 = 6 then null
            else {_text('l_partkey')} end""",
        "spend": f"""case
            when l_orderkey % 6 = 0 then day_text
            when l_orderkey % 6 = 1 then day_text || ' 10:00:00'
            when l_orderkey % 6 = 2 then {_us('day_text')}
            when l_orderkey % 6 = 3 then '"' || long_text || '"'
            when l_orderkey % 6 = 4 then lower(replace(long_text, ',', ''))
            when l_orderkey % 12 = 5 then 'not a date'
            else ' "' || day_text || '"' || chr(9) end""",
        "sales_amount": f"""case
            when l_orderkey % 23 = 1 then 'unknown'
            when l_orderkey % 29 = 2 then null
            when l_orderkey % 31 = 3 then '1e17'
            when l_orderkey % 37 = 5 then '0.004'
            else {_money('l_extendedprice')} end""",
        "channel": """case l_linenumber % 4
            when 0 then ' online '
            when 1 then 'IN store'
            when 2 then chr(9) || 'pARTNER'
            else null end""",
    },
    twice="(l_orderkey + l_linenumber) % 5 = 0",
    given={"day_text": _day("l_shipdate"), "long_text": _long("l_shipdate")},
)

_SPECS = f"""'"specs":{{'
    || '"dimensions":{{"height":' || {_text('p_size')} || '.5,"width":' || (case when p_partkey % 7 = 3 then '"12 cm"' else {_text('p_size * 2')} end) || '}},'
    || '"storage":{{"capacity_gb":' || (case p_size % 5
        when 0 then '[64,128,' || {_text('p_size * 8')} || ']'
        when 1 then {_text('p_size * 16')}
        when 2 then 'null'
        when 3 then (case when p_partkey % 2 = 0 then '[128.5,' || {_text('p_size')} || '.75]' else {_text('p_size')} || '.5' end)
        else '[]' end) || ',"type":"SSD"}},'
    || '"battery":{{"capacity_mAh":' || {_text('p_size * 100')} || (case when p_partkey % 5 = 2 then '.5' else '' end) || ',"fast_charging":"65W"}},'
    || '"screen":{{"type":"OLED","size_inches":' || {_text('p_size')} || '.25}},'
    || '"processor":{{"brand":"' || p_brand || '","model":"M' || {_text('p_size % 4')} || '"}},'
    || '"ram_gb":' || (case when p_partkey % 11 = 1 then '"many"' else {_text('p_size % 4 * 8')} || (case when p_partkey % 4 = 0 then '.0' else '' end) end) || ','
    || (case when p_partkey % 3 = 1 then '' else '"sensors":["gyro","' || p_type || '"],' end)
    || '"ports":[],"features":["f' || {_text('p_size % 7')} || '"],"connectivity":["wifi","nfc"]}}'"""

_PRICING = f"""'"pricing":{{"base_price":' || (case when p_partkey % 6 = 1 then '"' || {_money('p_retailprice')} || '"' else {_money('p_retailprice')} end)
    || ',"currency":"EUR","discounts":' || (case p_size % 3
        when 0 then '[]'
        when 1 then '[{{"type":"sale","amount":5.5}},{{"type":"clear"}}]'
        else (case when p_partkey % 2 = 0 then '[{{"amount":"5"}},{{"amount":"half"}}]' else '[{{"amount":10}}]' end) end) || '}}'"""

_RECORD = f"""'{{"product_id":"P' || {_text('p_partkey')}
    || '","name":"' || p_name || '","category":"' || p_type || '"'
    || (case when p_partkey % 9 = 4 then '' else ',' || {_SPECS} end)
    || (case when p_partkey % 10 = 6 then '' else ',' || {_PRICING} end) || '}}'"""

PRODUCTS = RawTable("part", {"raw_json": _RECORD})

# One text per part, as if each were a file holding an array of two records.
PRODUCT_FILES = RawTable(
    "part",
    {
        "file_id": "p_partkey",
        "value": f"'[' || {_RECORD} || ',{{\"product_id\":\"X' || {_text('p_partkey')}"
        " || '\",\"name\":\"spare\",\"category\":\"' || p_type || '\"}]'",
    },
)

# Whole-file texts in every state a JSON source can be in.
JSON_FILES = RawTable(
    "part",
    {
        "file_id": "p_partkey",
        "value": f"""case p_partkey % 8
            when 0 then '[' || {_RECORD} || ']'
            when 1 then {_RECORD}
            when 2 then '[' || {_RECORD}
            when 3 then '[]'
            when 4 then ' ' || {_text('p_size')}
            when 6 then '[' || {_RECORD} || '] garbage'
            when 7 then '[' || {_RECORD} || '][' || {_RECORD} || ']'
            else '[' || {_RECORD} || ',' || {_RECORD} || ']' end""",
    },
)

SHEET_HEADERS = {
    "order_key": " Order Key ",
    "order_status": "Order Status",
    "order_total": "ORDER total",
    "clerk": "clerk",
}

SHEET = RawTable(
    "orders",
    {
        "order_key": "o_orderkey",
        "order_status": "' ' || o_orderstatus || chr(9)",
        "order_total": "cast(o_totalprice as decimal(18, 2))",
        "clerk": "case when o_orderkey % 4 = 1 then null else o_orderpriority || ' ' end",
    },
)

ISO_EVENTS = RawTable(
    "events",
    {
        "event_id": "event_id",
        "stamp": f"""case
            when event_id % 7 = 0 then 'garbage'
            else substr({_text('ts')}, 1, 10) || 'T' || substr({_text('ts')}, 12, 8) || 'Z' end""",
    },
)

NUMBER_TEXTS = RawTable(
    "lineitem",
    {
        "l_orderkey": "l_orderkey",
        "l_linenumber": "l_linenumber",
        "l_partkey": "l_partkey",
        "l_suppkey": "l_suppkey",
        "whole": f"""case l_orderkey % 5
            when 0 then {_text('l_orderkey')} || '.0'
            when 1 then 'x'
            when 2 then ' -' || {_text('l_orderkey')} || ' '
            when 3 then '99999999999999999999'
            else {_text('l_orderkey')} end""",
        "amount": f"""case l_orderkey % 8
            when 0 then '1d'
            when 1 then 'NaN'
            when 2 then '1e3'
            when 3 then '1,000'
            when 4 then ''
            when 5 then '.5'
            else {_money('l_extendedprice')} end""",
    },
)
