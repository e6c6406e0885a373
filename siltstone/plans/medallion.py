"""Raw files to report table in one call."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from types import MappingProxyType
from typing import Any, NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.constants import REQUIRED_COLUMNS
from siltstone.operators.columns import with_short_seq, without_ingest_seq
from siltstone.operators.joins import require_unique
from siltstone.operators.dedup import rows_beyond_first
from siltstone.operators.quality import Check, counts_at_write, missing_columns, profile
from siltstone.plans import gold, silver
from siltstone.plans.bronze import load_with_deltas
from siltstone.sources.files import read_csv, read_products, read_sheets
from siltstone.sources.lake import Lake

SHEET_PLANS = {
    "orders": silver.orders,
    "accounts": silver.accounts,
    "sales_history": silver.sales,
}
BRONZE_KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "accounts": ["customer_id"],
    "sales_history": [],
}
SILVER_KEYS = {**BRONZE_KEYS, "sales_history": ["customer_id"]}
KEYS = {"bronze": BRONZE_KEYS, "silver": SILVER_KEYS}
RULE_NAMES = {"customers": "customer"}


class Result(NamedTuple):
    report: DataFrame
    quality: DataFrame


def _together(jobs: Sequence[Callable[[], object]]) -> None:
    """Run independent writes side by side, so that a small table's last tasks do
    not leave the cluster waiting; the first failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(inheritable_thread_target(job)) for job in jobs]:
            done.result()


class Ledger:
    """Check results of one run, and the checks that end it."""

    def __init__(self, spark: SparkSession, rules: Mapping[str, Sequence[str]], fail_on: Sequence[str]):
        self.spark, self.rules, self.fail_on = spark, rules, fail_on
        self.rows: list[tuple[str, str, str | None, int]] = []

    def add(self, table: str, values: Mapping[tuple[str, str | None], int]) -> None:
        self.rows += [(table, check, column, int(value)) for (check, column), value in values.items()]
        for (check, column), value in values.items():
            if check in self.fail_on and value > 0:
                raise ValueError(f"quality check failed: {table}, {check}, {column}: {value}")

    def read(self, check: Check) -> None:
        """Profile a stored table by reading it."""
        self.add(check.table, {(r[1], r[2]): r[3] for r in profile(check).collect()})

    def publish(
        self, lake: Lake, layer: str, name: str, df: DataFrame, extra: Mapping[tuple[str, str | None], Column] = MappingProxyType({})
    ) -> None:
        """Publish a table if its checks pass; they are counted in the write, but for repeated keys."""
        shown = without_ingest_seq(df)
        table = "report_table" if layer == "gold" else f"{name}_{layer}"
        required = self.rules.get(RULE_NAMES.get(name, name), []) if layer == "bronze" else []
        key = KEYS.get(layer, {}).get(name)
        counts = counts_at_write(shown) | dict(extra)
        labels = {f"c{i}": label for i, label in enumerate(counts)}

        def gate(values: dict[str, int], written: DataFrame) -> None:
            found = missing_columns(shown, required) | {labels[c]: n for c, n in values.items()}
            if key:
                found["duplicate_rows", ",".join(key)] = rows_beyond_first(written, key, "n").first()[0]
            self.add(table, found)

        lake.publish(layer, name, df, counts=dict(zip(labels, counts.values(), strict=True)), gate=gate)

    def frame(self) -> DataFrame:
        found = {(t, c, col): n for t, c, col, n in self.rows}
        removed = [
            (t.replace("_bronze", "_silver"), "removed_rows", None, n - found[t.replace("_bronze", "_silver"), c, None])
            for (t, c, col), n in found.items()
            if c == "row_count" and t.endswith("_bronze") and (t.replace("_bronze", "_silver"), c, None) in found
        ]
        kinds = "table_name string, check_name string, column_name string, value bigint"
        return self.spark.createDataFrame([*self.rows, *removed], kinds)


def load_bronze(
    spark: SparkSession, lake: Lake, raw: str, config: Mapping[str, Any], ledger: Ledger
) -> list[str]:
    """Raw files to bronze; gives the names of the sheets found."""
    files = config["csv_files"]
    baseline, *deltas = [
        read_csv(spark, f"{raw}/{name}", ordinal=place)
        for place, name in enumerate([files["baseline"], *files.get("incremental", [])])
    ]
    catalogues = [
        read_products(spark, f"{raw}/{name}", lines=name.endswith((".jsonl", ".ndjson")))
        for name in config["json_files"]
    ]
    records = reduce(lambda a, b: a.unionByName(b), catalogues)
    sheets = read_sheets(spark, f"{raw}/{config['sheets']['folder']}", config["sheets"]["names"])
    if "orders" not in sheets:
        raise FileNotFoundError(f"no orders sheet with rows under {raw}")

    def load_customers() -> None:
        commit = load_with_deltas(lake, "customers", baseline, deltas, "customer_id", "last_updated")
        ledger.add("customers_bronze", {("undated_delta_rows", "last_updated"): commit.undated or 0})

    _together(
        [
            load_customers,
            partial(lake.publish, "bronze", "products_raw", records),
            *(partial(ledger.publish, lake, "bronze", name, table) for name, table in sheets.items()),
        ]
    )
    customers = without_ingest_seq(lake.read("bronze", "customers"))
    ledger.read(Check("customers_bronze", customers, ledger.rules.get("customer", []), BRONZE_KEYS["customers"]))
    return list(sheets)


def _extra(name: str) -> dict[tuple[str, str | None], Column]:
    """Counted besides, while the table is written."""
    return {("future_dates", "is_future_date"): F.count_if(F.col("is_future_date"))} if name == "sales_history" else {}


def build_silver(lake: Lake, sheets: Sequence[str], ledger: Ledger) -> None:
    plans = {"customers": ("customers", silver.customers), "products": ("products_raw", silver.products)}
    plans |= {name: (name, plan) for name, plan in SHEET_PLANS.items() if name in sheets}
    _together(
        [
            partial(ledger.publish, lake, "silver", name, plan(with_short_seq(lake.read("bronze", source))), _extra(name))
            for name, (source, plan) in plans.items()
            if name != "products"
        ]
        + [partial(lake.publish, "silver", "products", silver.products(lake.read("bronze", "products_raw")))]
    )


def build_gold(lake: Lake, ledger: Ledger) -> None:
    products = lake.read("silver", "products")
    require_unique(products, "product_id")
    has_sales = lake.exists("silver", "sales_history")
    report = gold.build_report(
        lake.read("silver", "customers"),
        lake.read("silver", "orders"),
        products,
        lake.read("silver", "sales_history") if has_sales else None,
    )
    ledger.publish(lake, "gold", "report_data", report)


def run(
    spark: SparkSession,
    raw: str,
    out: str,
    config: Mapping[str, Any],
    fail_on: Sequence[str] = (),
) -> Result:
    """Load, clean, check and join the five raw tables under `raw`.

    `config` names the files:

        {"csv_files": {"baseline": "a.csv", "incremental": ["b.csv", ...]},
         "json_files": ["products.json", ...],
         "sheets": {"folder": "workbook", "names": ["orders", ...]},
         "quality_rules": {"orders": ["order_id", ...], ...}}   # optional

    Each layer is read back from what was written, so no table is worked out twice.
    `fail_on` names checks that end the run when a table does not pass them: before that
    table is replaced (customers in bronze: after its load), and before any later layer
    is begun. What was counted until then is in quality/checks either way.
    """
    lake = Lake(spark, out)
    ledger = Ledger(spark, config.get("quality_rules", REQUIRED_COLUMNS), fail_on)
    try:
        sheets = load_bronze(spark, lake, raw, config, ledger)
        build_silver(lake, sheets, ledger)
        build_gold(lake, ledger)
    finally:
        lake.publish("quality", "checks", ledger.frame())
    lake.publish("quality", "product_misfits", silver.product_misfits(lake.read("bronze", "products_raw")))
    return Result(lake.read("gold", "report_data"), lake.read("quality", "checks"))
