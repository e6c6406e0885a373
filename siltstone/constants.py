"""Business constants. All are defaults: every function that uses one takes it
as an argument."""

from datetime import date

# ---------------------------------------------------------------------------
# Results are only right if these stay exactly as they are.
# ---------------------------------------------------------------------------

AGE_BANDS = [
    (25, "18-24"),
    (35, "25-34"),
    (45, "35-44"),
    (55, "45-54"),
    (65, "55-64"),
]
OLDEST_BAND = "65+"

REGION_COUNTRIES = {
    "Americas": ["United States", "Canada", "Brazil"],
    "Europe": [
        "United Kingdom",
        "France",
        "Germany",
        "Italy",
        "Spain",
        "Sweden",
        "Netherlands",
        "Ireland",
        "Switzerland",
    ],
    "Asia": ["India", "Japan", "Singapore", "UAE", "South Korea"],
    "Oceania": ["Australia"],
    "Africa": ["South Africa"],
}
OTHER_REGION = "Other"

CANCELLED_STATUSES = ["CANCELLED", "REFUNDED"]
HIGH_VALUE_ORDER = 1500
HIGH_VALUE_CUSTOMER = 10000
MAX_VALID_DATE = date(2026, 12, 31)

REQUIRED_COLUMNS = {
    "customer": ["customer_id", "name", "email", "age", "country", "last_updated"],
    "orders": [
        "order_id",
        "customer_id",
        "order_amount",
        "order_date",
        "order_status",
        "product_id",
    ],
    "accounts": ["customer_id", "account_type", "country"],
    "sales_history": ["customer_id", "spend", "sales_amount", "channel"],
    "product": ["product_id", "name", "category"],
}

# Unicode White_Space characters.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d \u0085  "
    "           "
    "    　"
)

# Raw product record. capacity_gb is a list, a number or absent; numbers come as numbers or text.
PRODUCT_SCHEMA = """
    product_id STRING, name STRING, category STRING,
    specs STRUCT<
        dimensions: STRUCT<height: STRING, width: STRING, depth: STRING, diameter: STRING>,
        storage: STRUCT<capacity_gb: VARIANT, type: STRING>,
        battery: STRUCT<capacity_mAh: STRING, fast_charging: STRING, playback_hours: STRING>,
        screen: STRUCT<type: STRING, size_inches: STRING>,
        processor: STRUCT<brand: STRING, model: STRING>,
        ram_gb: STRING,
        sensors: ARRAY<STRING>, ports: ARRAY<STRING>, features: ARRAY<STRING>,
        connectivity: ARRAY<STRING>, compatibility: ARRAY<STRING>>,
    pricing STRUCT<
        base_price: STRING, currency: STRING,
        discounts: ARRAY<STRUCT<type: STRING, amount: STRING>>>
"""

# ---------------------------------------------------------------------------
# Names this library chose itself.
# ---------------------------------------------------------------------------

INGEST_SEQ = "ingest_seq"
