"""Quality checks."""

import pytest

from helpers import plan_of, rows
from siltstone.operators import aggregates
from siltstone.operators.quality import Check, failures, profile, profile_all, require_passed


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "a"), (1, "b"), (None, None), (None, None), (2, None)], "id int, name string"
    )


def test_profile(table):
    got = profile(Check("t", table, ["id", "missing"], ["id"]))
    assert rows(got.select("check_name", "column_name", "value")) == [
        ("duplicate_rows", "id", 2),
        ("empty_rows", None, 2),
        ("missing_column", "id", 0),
        ("missing_column", "missing", 1),
        ("null_count", "id", 2),
        ("null_count", "name", 3),
        ("row_count", None, 5),
    ]


def test_composite_key_and_no_key(table):
    both = profile(Check("t", table, key=["id", "name"]))
    assert both.filter("check_name = 'duplicate_rows'").first()["value"] == 1
    assert profile(Check("t", table)).filter("check_name = 'duplicate_rows'").isEmpty()


def test_empty_table(table):
    got = profile(Check("t", table.limit(0), ["missing"], ["id"]))
    values = {(r.check_name, r.column_name): r.value for r in got.collect()}
    assert values.pop(("missing_column", "missing")) == 1
    assert set(values.values()) == {0}


def test_all_tables_and_failures(table):
    metrics = profile_all([Check("a", table, ["x"]), Check("b", table.dropna(), key=["id"])])
    assert {r.table_name for r in metrics.collect()} == {"a", "b"}
    bad = failures(metrics, ["missing_column", "duplicate_rows"])
    assert rows(bad.select("table_name", "check_name")) == [
        ("a", "missing_column"),
        ("b", "duplicate_rows"),
    ]


def test_required_checks(table):
    metrics = profile(Check("a", table, key=["id"]))
    require_passed(metrics, ["missing_column"])
    require_passed(metrics, [])
    with pytest.raises(ValueError, match="quality check failed.*duplicate_rows"):
        require_passed(metrics, ["duplicate_rows"])


def test_profile_shuffles_one_row_per_task_and_keys(table):
    plan = plan_of(profile(Check("t", table, key=["id"])))
    assert plan.count("Exchange SinglePartition") == 2
    assert plan.count("Exchange hashpartitioning(id") == 1


def test_key_reports(spark):
    df = spark.createDataFrame([(k,) for k in "aabbbcd"], "k string")
    assert rows(aggregates.repeated_keys(df, ["k"])) == [("a", 2), ("b", 3)]
    assert [tuple(r) for r in aggregates.most_repeated(df, ["k"], 1).collect()] == [("b", 3)]
    assert "TakeOrderedAndProject" in plan_of(aggregates.most_repeated(df, ["k"], 1))
    assert rows(aggregates.distinct_count(df, ["k"], "n")) == [(4,)]


def test_case_styles(spark):
    df = spark.createDataFrame([("AB",), ("ab",), ("Ab",), ("aB",), (None,)], "name string")
    assert rows(aggregates.case_styles(df, "name")) == [(1, 1, 3)]
