"""Small helpers shared by the tests."""

from __future__ import annotations

from datetime import datetime


def rows(df):
    """All rows as sorted plain tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


def at(text):
    return datetime.fromisoformat(text) if text else None


def applied(spark, function, values, kind="string"):
    """The function over a column of values, in their order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("x"))).collect()]


def plan_of(df):
    """Physical plan as text, after planning but before running."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    """Physical plan as AQE left it once the query has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
