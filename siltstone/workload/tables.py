"""Nested records, joins, silver tables, the report and the quality checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from siltstone.constants import (
    AGE_BANDS,
    HIGH_VALUE_CUSTOMER,
    HIGH_VALUE_ORDER,
    INGEST_SEQ,
    OLDEST_BAND,
    OTHER_REGION,
    PRODUCT_SCHEMA,
    REGION_COUNTRIES,
    REQUIRED_COLUMNS,
)
from siltstone.functions import dates, nested
from siltstone.functions.casts import to_long
from siltstone.operators import quality
from siltstone.operators.aggregates import amounts_by_key
from siltstone.operators.columns import without_ingest_seq
from siltstone.operators.joins import left_join
from siltstone.plans import gold, medallion, silver
from siltstone.session import shared_folder
from siltstone.sources.files import records_of_arrays, snapshot_records
from siltstone.workload import dialect as D
from siltstone.workload import raw
from siltstone.workload.registry import query, table

CUT_OFF = date(2000, 1, 1)
ORDER_ABOVE = 250_000
CUSTOMER_ABOVE = 2_500_000
RAW_RECORDS = 250_000

# --- nested product records ------------------------------------------------


def _field(path: str, kind: str = "varchar") -> str:
    cast = "cast" if kind == "varchar" else "try_cast"
    return f"{cast}(raw_json ->> '$.{path}' as {kind})"


def _joined(path: str) -> str:
    items = f"from_json(json_extract(raw_json, '$.specs.{path}'), '[\"VARCHAR\"]')"
    return f"coalesce(array_to_string({items}, ','), '') as {path}"


_CAPACITY = "json_extract(raw_json, '$.specs.storage.capacity_gb')"
_DISCOUNTS = (
    "from_json(json_extract(raw_json, '$.pricing.discounts'),"
    " '[{\"type\":\"VARCHAR\",\"amount\":\"VARCHAR\"}]')"
)
_TOTAL = (
    f"coalesce(list_sum(list_transform({_DISCOUNTS}, lambda d: coalesce(try_cast(d.amount as double), 0.0))), 0.0)"
)

_HEAD_SQL = f"""{_field('product_id')} as product_id, {_field('name')} as product_name,
    {_field('category')} as category"""
_STORAGE_SQL = f"""
    case json_type({_CAPACITY})
        when 'ARRAY' then array_to_string(from_json({_CAPACITY}, '["VARCHAR"]'), ',')
        when 'UBIGINT' then cast({_CAPACITY} as varchar)
        when 'BIGINT' then cast({_CAPACITY} as varchar)
        when 'DOUBLE' then cast(cast(trunc(cast({_CAPACITY} as double)) as bigint) as varchar)
        end as storage_options_gb,
    case json_type({_CAPACITY})
        when 'ARRAY' then list_max(from_json({_CAPACITY}, '["DOUBLE"]'))
        when 'UBIGINT' then cast({_CAPACITY} as double)
        when 'BIGINT' then cast({_CAPACITY} as double)
        when 'DOUBLE' then trunc(cast({_CAPACITY} as double))
        end as max_storage_gb,
    {_field('specs.storage.type')} as storage_type"""
_SPECS_SQL = f"""
    {_field('specs.dimensions.height', 'double')} as height,
    {_field('specs.dimensions.width', 'double')} as width,
    {_field('specs.dimensions.depth', 'double')} as depth,
    {_field('specs.dimensions.diameter', 'double')} as diameter,
    {_STORAGE_SQL},
    {_field('specs.battery.capacity_mAh', 'double')} as battery_capacity_mah,
    {_field('specs.battery.fast_charging')} as fast_charging,
    {_field('specs.battery.playback_hours', 'double')} as playback_hours,
    {_field('specs.screen.type')} as screen_type,
    {_field('specs.screen.size_inches', 'double')} as screen_size_inches,
    {_field('specs.processor.brand')} as processor_brand,
    {_field('specs.processor.model')} as processor_model,
    {_field('specs.ram_gb', 'double')} as ram_gb,
    {_joined('sensors')}, {_joined('ports')}, {_joined('features')},
    {_joined('connectivity')}, {_joined('compatibility')}"""
_PRICE_SQL = f"""
    {_field('pricing.base_price', 'double')} as base_price,
    {_field('pricing.currency')} as currency,
    cast(coalesce(len({_DISCOUNTS}), 0) as integer) as discount_count,
    {_TOTAL} as total_discount,
    coalesce(array_to_string(
        list_transform({_DISCOUNTS}, lambda d: coalesce(d.type, '')), ','), '') as discount_types,
    coalesce({_field('pricing.base_price', 'double')}, 0.0) - {_TOTAL} as effective_price"""

_PRODUCTS_SQL = D.with_tables(
    f"select {_HEAD_SQL}, {_SPECS_SQL}, {_PRICE_SQL} from p", p=raw.PRODUCTS.sql()
)


def _products(spark, sf_dir):
    return snapshot_records(raw.PRODUCTS.frame(spark, sf_dir))


def _flat(spark, sf_dir, columns):
    """Product id beside the columns worked out from the parsed record."""
    parsed = raw.PRODUCTS.frame(spark, sf_dir).select(
        F.from_json("raw_json", PRODUCT_SCHEMA).alias("p")
    )
    return parsed.select(
        F.col("p.product_id").alias("product_id"),
        *[column.alias(name) for name, column in columns(F.col("p")).items()],
    )


@query(
    D.with_tables(
        f"""select {_field('product_id')} as product_id, {_field('name')} as name,
            {_field('category')} as category, raw_json
        from (select cast(unnest(from_json(value, '["JSON"]')) as varchar) as raw_json from f)""",
        f=raw.PRODUCT_FILES.sql(),
    )
)
def json_raw_snapshot(spark, sf_dir):
    files = raw.PRODUCT_FILES.frame(spark, sf_dir)
    return snapshot_records(records_of_arrays(files))


@query(
    D.with_tables(
        """select file_id, case
            when not json_valid(value) then 'malformed'
            when json_type(value) = 'ARRAY' then 'ok'
            else 'not_array' end as status from f""",
        f=raw.JSON_FILES.sql(),
    )
)
def json_validate(spark, sf_dir):
    status = nested.json_array_status(F.col("value"))
    return raw.JSON_FILES.frame(spark, sf_dir).select("file_id", status.alias("status"))


@query(
    D.with_tables(
        f"select {_field('product_id')} as product_id, {_SPECS_SQL} from p", p=raw.PRODUCTS.sql()
    )
)
def json_flatten(spark, sf_dir):
    return _flat(spark, sf_dir, lambda p: nested.spec_columns(p["specs"]))


@query(
    D.with_tables(
        f"select {_field('product_id')} as product_id, {_STORAGE_SQL} from p",
        p=raw.PRODUCTS.sql(),
    )
)
def json_storage(spark, sf_dir):
    return _flat(spark, sf_dir, lambda p: nested.storage_columns(p["specs"]["storage"]))


@query(
    D.with_tables(
        f"select {_field('product_id')} as product_id, {_PRICE_SQL} from p",
        p=raw.PRODUCTS.sql(),
    )
)
def json_discounts(spark, sf_dir):
    return _flat(spark, sf_dir, lambda p: nested.price_columns(p["pricing"]))


def _misfits_sql() -> str:
    numbers = {
        **{name: f"specs.dimensions.{name}" for name in ("height", "width", "depth", "diameter")},
        "battery_capacity_mah": "specs.battery.capacity_mAh",
        "playback_hours": "specs.battery.playback_hours",
        "screen_size_inches": "specs.screen.size_inches",
        "ram_gb": "specs.ram_gb",
        "base_price": "pricing.base_price",
    }
    rows = [
        f"select '{name}' as \"column\", count_if({_field(path)} is not null and {_field(path, 'double')} is null) as misfits from p"
        for name, path in numbers.items()
    ]
    unfit = f"list_transform({_DISCOUNTS}, lambda d: d.amount is not null and try_cast(d.amount as double) is null)"
    rows.append(f"select 'discount_amount', count_if(coalesce(list_bool_or({unfit}), false)) from p")
    rows.append(
        f"select 'storage', count_if(json_type({_CAPACITY}) not in ('ARRAY', 'UBIGINT', 'BIGINT', 'DOUBLE', 'NULL')) from p"
    )
    union = " union all ".join(rows)
    return D.with_tables(
        f'select "column", cast(misfits as bigint) as misfits from ({union})', p=raw.PRODUCTS.sql()
    )


@query(_misfits_sql())
def product_misfits(spark, sf_dir):
    return silver.product_misfits(_products(spark, sf_dir))


@query(_PRODUCTS_SQL)
def products_silver(spark, sf_dir):
    return silver.products(_products(spark, sf_dir))


# --- silver tables ---------------------------------------------------------

def _stamped(source: str) -> str:
    return f"""(select * replace (try_strptime(last_updated, '%Y-%m-%dT%H:%M:%SZ') as last_updated)
        from ({source}))"""


def _customers_sql(source: str, order: str = "last_updated desc nulls last, ingest_seq") -> str:
    """Customers of dated rows."""
    return f"""
        select customer_id, {D.title('name')} as name, lower(email) as email, age, country,
            last_updated, {D.bands('age', AGE_BANDS, OLDEST_BAND)} as age_group,
            string_split(lower(email), '@')[2] as email_domain,
            {D.groups('country', REGION_COUNTRIES, OTHER_REGION)} as region
        from ({D.first_per(source, 'customer_id', order)})"""


_CUSTOMERS_SQL = _customers_sql(_stamped(raw.CUSTOMERS.sql()))

_ORDERS_SQL = f"""
    select *, {D.calendar('order_date_parsed', 'order')},
        order_status in ('CANCELLED', 'REFUNDED') as is_cancelled
    from (select order_id, {D.whole('customer_id')} as customer_id,
            {D.number('order_amount')} as order_amount, order_date,
            upper({D.strip('order_status')}) as order_status, product_id,
            {D.order_stamp('order_date')} as order_date_parsed
        from ({D.first_per(f'({raw.ORDERS.sql()})', 'order_id', 'ingest_seq')}))"""

_ACCOUNTS_SQL = f"""
    select customer_id, {D.title(D.strip('account_type'))} as account_type,
        upper({D.strip('country')}) as country
    from ({D.first_per(
        f'''(select * replace ({D.whole('customer_id')} as customer_id)
            from ({raw.ACCOUNTS.sql()}))''',
        'customer_id', 'ingest_seq')})
    where customer_id is not null"""

_SALES_SQL = f"""
    select * replace ({D.title(D.strip('channel'))} as channel),
        spend_date_parsed > timestamp '{CUT_OFF}' as is_future_date,
        {D.calendar('spend_date_parsed', 'spend')},
        spend_date_parsed is not null as has_valid_date,
        sales_amount is not null as has_valid_amount
    from ({D.first_per(
        f'''(select {D.whole('customer_id')} as customer_id, spend,
                {D.number('sales_amount')} as sales_amount, channel,
                {D.spend_stamp('spend')} as spend_date_parsed
            from ({raw.SALES.sql()}))''',
        'customer_id, sales_amount, spend_date_parsed',
        'spend nulls first, channel nulls first')})
    where customer_id is not null"""


def _raw_customers(spark, sf_dir):
    stamp = dates.iso_timestamp(F.col("last_updated"))
    return raw.CUSTOMERS.frame(spark, sf_dir).withColumn("last_updated", stamp)


@query(_CUSTOMERS_SQL)
def customers_silver(spark, sf_dir):
    return silver.customers(_raw_customers(spark, sf_dir))


@query(_ORDERS_SQL)
def orders_silver(spark, sf_dir):
    return silver.orders(raw.ORDERS.frame(spark, sf_dir))


@query(_ACCOUNTS_SQL)
def accounts_silver(spark, sf_dir):
    return silver.accounts(raw.ACCOUNTS.frame(spark, sf_dir))


@query(_SALES_SQL)
def sales_silver(spark, sf_dir):
    return silver.sales(raw.SALES.frame(spark, sf_dir), CUT_OFF)


# --- joins and the report --------------------------------------------------


@query(
    D.with_tables(
        f"""select c_custkey, ingest_seq, c_name, c_mktsegment
        from (select ingest_seq, {D.whole('customer_id')} as c_custkey from o)
            left join (select c_custkey as key, c_name, c_mktsegment from customer)
            on key = c_custkey""",
        o=raw.ORDERS.sql(),
    )
)
def left_enrich(spark, sf_dir):
    orders = raw.ORDERS.frame(spark, sf_dir).select(
        to_long(F.col("customer_id")).alias("c_custkey"), "ingest_seq"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return left_join(orders, customers, "c_custkey", "_cust")


@query(
    """select o_custkey as id, o_orderstatus as status, o_totalprice as amount,
        c_mktsegment as status_cust, c_acctbal as amount_cust, c_name
    from orders left join customer on c_custkey = o_custkey"""
)
def suffix_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as id", "o_orderstatus as status", "o_totalprice as amount"
    )
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as id", "c_mktsegment as status", "c_acctbal as amount", "c_name"
    )
    return left_join(orders, customers, "id", "_cust")


def _figures_sql(key: str, amount: str, source: str) -> str:
    # through text both ways: a double's own digits in, and one rounding out
    total = f"cast(cast(sum(cast(cast({amount} as varchar) as decimal(38, 6))) as varchar) as double)"
    return f"""select {key}, {total} as total_sales_amount,
        {total} / nullif(count({amount}), 0) as avg_sales_amount,
        count({amount}) as sales_transaction_count from {source} group by {key}"""


_ORDER_FIGURES_SQL = _figures_sql(
    "customer_id",
    "sales_amount",
    """(select o_custkey as customer_id,
        case when o_orderkey % 5 = 1 or o_custkey % 50 = 7 then null else o_totalprice end
            as sales_amount from orders)""",
)


def _order_figures(spark, sf_dir):
    amount = F.when(F.expr("o_orderkey % 5 <> 1 and o_custkey % 50 <> 7"), F.col("o_totalprice"))
    sales = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"), amount.alias("sales_amount")
    )
    return amounts_by_key(sales, "customer_id", "sales_amount")


@query(_ORDER_FIGURES_SQL)
def customer_sales_agg(spark, sf_dir):
    return _order_figures(spark, sf_dir)


_ENRICHED_SQL = f"""select c_custkey as customer_id, c_name, total_sales_amount,
        avg_sales_amount, sales_transaction_count
    from customer left join ({_ORDER_FIGURES_SQL}) f on customer_id = c_custkey"""


def _enriched(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey as customer_id", "c_name")
    return left_join(customers, _order_figures(spark, sf_dir), "customer_id", "_sale")


@query(_ENRICHED_SQL)
def agg_then_join(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query(
    f"""select e.customer_id, o_orderkey, o_totalprice as order_amount, total_sales_amount,
        o_totalprice > {ORDER_ABOVE} as is_high_value_order,
        total_sales_amount > {CUSTOMER_ABOVE} as is_high_value_customer
    from orders left join ({_ENRICHED_SQL}) e on e.customer_id = o_custkey"""
)
def threshold_flags(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as customer_id", "o_orderkey", "o_totalprice as order_amount"
    )
    totals = _enriched(spark, sf_dir).select("customer_id", "total_sales_amount")
    joined = left_join(orders, totals, "customer_id", "_sale")
    return gold.flag_high_value(joined, ORDER_ABOVE, CUSTOMER_ABOVE)


def _report_sql(order_above: float, customer_above: float) -> str:
    """The report over o (orders), c (customers, ids as text), p (products), f (sales figures)."""
    return f"""select o.*, c.* exclude (customer_id), p.* exclude (product_id),
            f.* exclude (customer_id), order_amount > {order_above} as is_high_value_order,
            total_sales_amount > {customer_above} as is_high_value_customer
        from o left join c on o.customer_id = {D.whole('c.customer_id')}
            left join p on o.product_id = p.product_id
            left join f on o.customer_id = f.customer_id"""


@query(
    D.with_tables(
        _report_sql(ORDER_ABOVE, CUSTOMER_ABOVE),
        o=_ORDERS_SQL,
        c=_CUSTOMERS_SQL,
        p=_PRODUCTS_SQL,
        s=_SALES_SQL,
        f=_figures_sql("customer_id", "sales_amount", "s"),
    )
)
def gold_report(spark, sf_dir):
    return gold.build_report(
        customers_silver(spark, sf_dir),
        orders_silver(spark, sf_dir),
        products_silver(spark, sf_dir),
        sales_silver(spark, sf_dir),
        order_above=ORDER_ABOVE,
        customer_above=CUSTOMER_ABOVE,
    )


def _raw_files(spark, sf_dir) -> tuple[str, dict]:
    """The raw tables as files, and the configuration that names them.

    A compressed file cannot be split, so none holds more than RAW_RECORDS.
    """
    root = shared_folder(spark, "raw")
    packed = {"compression": "gzip", "maxRecordsPerFile": RAW_RECORDS}
    as_they_are = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    files = {
        "customers_full.csv": raw.CUSTOMERS,
        "customers_later.csv": raw.CUSTOMERS_LATER,
        "book/orders.csv": raw.ORDERS,
        "book/accounts.csv": raw.ACCOUNTS,
        "book/sales_history.csv": raw.SALES,
    }
    for name, source in files.items():
        frame = source.frame(spark, sf_dir)
        if source is raw.ORDERS:  # which null id is first hangs on how the tables are split
            frame = frame.filter("order_id is not null").withColumnsRenamed({"order_id": " Order ID ", "order_date": "Order Date"})
        frame.drop(INGEST_SEQ).write.options(**as_they_are, **packed).csv(f"{root}/{name}")
    raw.PRODUCTS.frame(spark, sf_dir).write.options(**packed).text(f"{root}/products.jsonl")
    return root, {
        "csv_files": {"baseline": "customers_full.csv", "incremental": ["customers_later.csv"]},
        "json_files": ["products.jsonl"],
        "sheets": {"folder": "book", "names": ["orders", "accounts", "sales_history", "notes"]},
    }


_LATER_SQL = f"""select {D.whole('customer_id')} as number, * replace (coalesce(cast(number as varchar), customer_id) as customer_id)
    from {_stamped(raw.CUSTOMERS_LATER.sql())}"""


@query(
    D.with_tables(
        _report_sql(HIGH_VALUE_ORDER, HIGH_VALUE_CUSTOMER),
        o=f"select * replace ({D.strip('order_date')} as order_date) from ({_ORDERS_SQL}) where order_id is not null",
        b=f"select * exclude (ingest_seq) from {_stamped(raw.CUSTOMERS.sql())}",
        d=f"select * from ({_LATER_SQL}) where last_updated > (select max(last_updated) from b)",
        m="""select * from b where customer_id not in (select customer_id from d)
            union all by name select customer_id, email, country, last_updated from d""",
        c=_customers_sql("m", "last_updated desc nulls last"),
        p=_PRODUCTS_SQL,
        s=_SALES_SQL,
        f=_figures_sql("customer_id", "sales_amount", "s"),
    )
)
def medallion_run(spark, sf_dir):
    """The whole run over files: a full load, a delta, sheets, records, checks and the report."""
    root, config = _raw_files(spark, sf_dir)
    return medallion.run(spark, root, shared_folder(spark, "medallion"), config).report


# --- quality checks --------------------------------------------------------

_HOLES = ["order_id", "customer_id", "order_amount", "order_status"]


def _metric_sql(table_name: str, check: str, column: str | None, value: str, source: str) -> str:
    column_sql = f"'{column}'" if column else "cast(null as varchar)"
    return (
        f"select '{table_name}' as table_name, '{check}' as check_name,"
        f" {column_sql} as column_name, cast({value} as bigint) as value from {source}"
    )


def _schema_sql(name: str, columns: list[str], required: list[str], source: str) -> list[str]:
    rows = [_metric_sql(name, "row_count", None, "count(*)", source)]
    for c in required:
        rows.append(_metric_sql(name, "missing_column", c, f"max({int(c not in columns)})", source))
    return rows


def _nulls_sql(name: str, columns: list[str], source: str) -> list[str]:
    return [_metric_sql(name, "null_count", c, f"count(*) - count({c})", source) for c in columns]


def _empty_sql(name: str, columns: list[str], source: str) -> str:
    empty = " and ".join(f"{c} is null" for c in columns)
    return _metric_sql(name, "empty_rows", None, f"count(*) filter ({empty})", source)


def _duplicates_sql(name: str, key: str, source: str) -> str:
    groups = f"(select {key}, count(*) as n from {source} group by {key})"
    return _metric_sql(name, "duplicate_rows", key, "sum(n - 1)", groups)


def _profile_sql(
    name: str, columns: list[str], required: list[str], key: str | None, source: str
) -> list[str]:
    rows = [
        *_schema_sql(name, columns, required, source),
        *_nulls_sql(name, columns, source),
        _empty_sql(name, columns, source),
    ]
    return rows + [_duplicates_sql(name, key, source)] if key else rows


def _checks_sql(rows: list[str], **tables: str) -> str:
    return D.with_tables(" union all ".join(rows), **tables)


def _holes(spark, sf_dir):
    return raw.ORDERS_WITH_HOLES.frame(spark, sf_dir)


_HOLES_SQL = raw.ORDERS_WITH_HOLES.sql()
_ORDER_RULE = REQUIRED_COLUMNS["orders"]


@query(_checks_sql(_schema_sql("orders", _HOLES, _ORDER_RULE, "h"), h=_HOLES_SQL))
def profile_schema(spark, sf_dir):
    return quality.check_schema(_holes(spark, sf_dir), "orders", _ORDER_RULE)


@query(_checks_sql(_nulls_sql("orders", _HOLES, "h"), h=_HOLES_SQL))
def profile_nulls(spark, sf_dir):
    return quality.check_nulls(_holes(spark, sf_dir), "orders")


@query(_checks_sql([_empty_sql("orders", _HOLES, "h")], h=_HOLES_SQL))
def profile_empty_rows(spark, sf_dir):
    return quality.check_empty_rows(_holes(spark, sf_dir), "orders")


@query(_checks_sql([_duplicates_sql("orders", "order_id", "h")], h=_HOLES_SQL))
def profile_duplicates(spark, sf_dir):
    return quality.check_duplicates(_holes(spark, sf_dir), "orders", ["order_id"])


@query(_checks_sql(_profile_sql("orders", _HOLES, _ORDER_RULE, "order_id", "h"), h=_HOLES_SQL))
def profile_table(spark, sf_dir):
    return quality.profile(
        quality.Check("orders", _holes(spark, sf_dir), _ORDER_RULE, ["order_id"])
    )


def _columns(table_of: raw.RawTable) -> list[str]:
    return [c for c in table_of.columns if c != "ingest_seq"]


@query(
    _checks_sql(
        [
            *_profile_sql(
                "customers_bronze",
                _columns(raw.CUSTOMERS),
                REQUIRED_COLUMNS["customer"],
                "customer_id",
                "c",
            ),
            *_profile_sql(
                "orders_bronze",
                _columns(raw.ORDERS),
                REQUIRED_COLUMNS["orders"],
                "order_id",
                "o",
            ),
            *_profile_sql(
                "accounts_bronze",
                _columns(raw.ACCOUNTS),
                REQUIRED_COLUMNS["accounts"],
                "customer_id",
                "a",
            ),
            *_profile_sql(
                "sales_bronze",
                _columns(raw.SALES),
                REQUIRED_COLUMNS["sales_history"],
                None,
                "s",
            ),
        ],
        c=raw.CUSTOMERS.sql(),
        o=raw.ORDERS.sql(),
        a=raw.ACCOUNTS.sql(),
        s=raw.SALES.sql(),
    )
)
def profile_all(spark, sf_dir):
    bronze = {
        name: without_ingest_seq(source.frame(spark, sf_dir))
        for name, source in {
            "customer": raw.CUSTOMERS,
            "orders": raw.ORDERS,
            "accounts": raw.ACCOUNTS,
            "sales_history": raw.SALES,
        }.items()
    }
    plan = [
        ("customers_bronze", "customer", ["customer_id"]),
        ("orders_bronze", "orders", ["order_id"]),
        ("accounts_bronze", "accounts", ["customer_id"]),
        ("sales_bronze", "sales_history", []),
    ]
    return quality.profile_all(
        quality.Check(label, bronze[name], REQUIRED_COLUMNS[name], key) for label, name, key in plan
    )
