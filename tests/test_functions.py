"""Scalar rules, on hand-written edge values."""

from datetime import date

from pyspark.sql import functions as F

from helpers import applied, at
from siltstone.functions import buckets, casts, dates, text
from siltstone.operators.columns import with_parsed_date


def test_strip_takes_every_kind_of_whitespace(spark):
    assert applied(spark, text.strip, ["  a b\t", " x　", "\r\n", "", None]) == [
        "a b",
        "x",
        "",
        "",
        None,
    ]


def test_title_case_breaks_words_on_whitespace_only(spark):
    given = ["JOHN smith", "mary-jane o'brien", "JOHN\tsMITH", "a bC", "two  SPACES", "", None]
    assert applied(spark, text.title_case, given) == [
        "John Smith",
        "Mary-jane O'brien",
        "John\tSmith",
        "A Bc",
        "Two  Spaces",
        "",
        None,
    ]


def test_upper_is_stripped(spark):
    assert applied(spark, text.clean_upper, [" Cancelled ", "\trefunded", None]) == [
        "CANCELLED",
        "REFUNDED",
        None,
    ]


def test_email_domain(spark):
    given = ["a@b.com", "ab", "a@b@c", "@", None]
    assert applied(spark, text.email_domain, given) == ["b.com", None, "b", "", None]


def test_header_name():
    names = [" Order ID ", "Order Date", "channel"]
    assert [text.header_name(n) for n in names] == ["order_id", "order_date", "channel"]


def test_to_long(spark):
    given = ["12", " 12 ", "12.0", "1d", "NaN", "1e3", "1,000", "", None, "-7", "9" * 19, "9" * 30]
    expected = [12, 12, None, None, None, None, None, None, None, -7, None, None]
    given, expected = [*given, "0" * 25 + "12", "+3"], [*expected, 12, 3]
    assert applied(spark, casts.to_long, given) == expected


def test_to_double(spark):
    given = ["12", " 12 ", "12.0", "1d", "NaN", "1e3", "1,000", "", None, ".5", "-7.", "inf"]
    expected = [12.0, 12.0, 12.0, None, None, 1000.0, None, None, None, 0.5, -7.0, None]
    assert applied(spark, casts.to_double, given) == expected


def test_iso_timestamp(spark):
    given = ["2024-01-05T10:00:00Z", "2024-01-05T10:00:00", "2024-02-30T10:00:00Z", "x", None]
    assert applied(spark, dates.iso_timestamp, given) == [at("2024-01-05T10:00:00")] + [None] * 4


def test_csv_timestamp(spark):
    given = ["2024-01-05T10:00:00Z", "2024-01-05 10:00:00.5", "2024-01-05T01:02:03", "2024-01-05", "5"]
    assert applied(spark, dates.csv_timestamp, given) == [
        at("2024-01-05T10:00:00"),
        at("2024-01-05T10:00:00.500000"),
        at("2024-01-05T01:02:03"),
        at("2024-01-05"),
        None,
    ]


def test_order_dates_take_two_spellings(spark):
    given = ["2024-01-05", "2024-01-05 10:00:00", "2024-1-5", "01/05/2024", "2024-02-30", None]
    assert applied(spark, dates.day_or_second, given) == [
        at("2024-01-05"),
        at("2024-01-05T10:00:00"),
        at("2024-01-05"),
        None,
        None,
        None,
    ]


SPENDS = {
    "2024-01-05": "2024-01-05",
    "2024-01-05 10:00:00": "2024-01-05T10:00:00",
    "2024-1-5": "2024-01-05",
    "01/05/2024": "2024-01-05",
    "1/5/2024": "2024-01-05",
    "13/05/2024": None,
    "November 10, 2026": "2026-11-10",
    '"November 10, 2026"': "2026-11-10",
    ' "2024-01-05" ': "2024-01-05",
    "november 5 2026": "2026-11-05",
    "MAY  5,  2026": "2026-05-05",
    "Nov 5 2026": None,
    "February 30 2026": None,
    "November 10,2026": None,
    "November 2026": None,
    "not a date": None,
    "": None,
    None: None,
}


def test_spend_dates_take_four_spellings(spark):
    df = spark.createDataFrame([(k,) for k in SPENDS], "spend string")
    parsed = with_parsed_date(df, "spend", "day", dates.unquoted, dates.spend_timestamp)
    assert {r.spend: r.day for r in parsed.collect()} == {k: at(v) for k, v in SPENDS.items()}


def test_dates_do_not_depend_on_the_time_zone(spark, settings):
    settings(spark__sql__session__timeZone="America/Sao_Paulo")
    # Clocks there skipped midnight on this day.
    given = ["2018-11-04", "11/4/2018", "November 4, 2018"]
    assert applied(spark, dates.spend_timestamp, given) == [at("2018-11-04")] * 3


def test_calendar_parts(spark):
    df = spark.sql("select timestamp_ntz'2024-11-05' d union all select null")
    parts = df.select(*[c.alias(n) for n, c in dates.calendar_parts(F.col("d"), "order").items()])
    assert parts.columns == ["order_year", "order_month", "order_quarter"]
    assert {tuple(r) for r in parts.collect()} == {(2024, 11, "Q4"), (None, None, None)}


def test_future_flag_starts_after_midnight_of_the_last_day(spark):
    df = spark.sql(
        """select explode(array(timestamp_ntz'2026-12-31 00:00:00',
            timestamp_ntz'2026-12-31 10:00:00', null)) d"""
    )
    assert [r[0] for r in df.select(dates.is_after(F.col("d"))).collect()] == [False, True, None]
    assert df.select(dates.is_after(F.col("d"), date(2030, 1, 1))).first()[0] is False


def test_age_group_and_null_age(spark):
    given = [17, 24, 25, 64, 65, None]
    expected = ["18-24", "18-24", "25-34", "55-64", "65+", "65+"]
    assert applied(spark, buckets.age_group, given, "bigint") == expected


def test_region(spark):
    given = ["Brazil", "Ireland", "UAE", "Australia", "South Africa", "Norway", "brazil", None]
    assert applied(spark, buckets.region, given) == [
        "Americas",
        "Europe",
        "Asia",
        "Oceania",
        "Africa",
        "Other",
        "Other",
        "Other",
    ]


def test_cancelled_statuses(spark):
    given = ["CANCELLED", "REFUNDED", "SHIPPED", "cancelled", None]
    assert applied(spark, buckets.is_cancelled, given) == [True, True, False, False, None]
