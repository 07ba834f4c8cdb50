"""Profiles, breakdowns and summaries."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from filingstrata.functions.dates import is_quarter_end
from filingstrata.functions.text import digits_only, numeric_text
from filingstrata.operators.breakdown import (
    category_share,
    frequency,
    null_breakdown,
    numeric_summary,
    top_values,
    usage_share,
)
from filingstrata.operators.profile import profile, profile_flags
from helpers import rows


@pytest.fixture(scope="module")
def reported(spark):
    data = [
        ("A", "USD", 0, Decimal("1")), ("A", "USD", 4, None), ("A", "EUR", 4, None), ("B", "USD", 4, Decimal("3")),
        (None, "USD", None, None), ("C", None, 1, None), ("C", "USD", 1, Decimal("-2")), ("C", "USD", 1, Decimal("3")),
    ]
    return spark.createDataFrame(data, "tag string, uom string, qtrs int, value decimal(28,4)")


def test_profile(spark):
    data = [("x", None, 1.0), ("x", None, 1.0), ("y", None, None), (None, None, 2.5)]
    described = profile(spark.createDataFrame(data, "a string, b string, c double"))
    assert rows(described) == [
        ("a", "string", 25.0, 2, "x", 2, 50.0),
        ("b", "string", 100.0, 0, None, 0, 0.0),
        ("c", "double", 25.0, 2, None, None, None),
    ]


def test_profile_ties_go_to_the_smallest_value(spark):
    described = profile(spark.createDataFrame([("z",), ("b",), ("z",), ("b",)], "a string"))
    assert described.first().top1_value == "b"


def test_profile_of_an_empty_table(spark):
    described = profile(spark.createDataFrame([], "a string, b int"))
    assert rows(described) == [("a", "string", None, 0, None, 0, None), ("b", "int", None, 0, None, None, None)]


def test_profile_rules(spark):
    data = [("x", None if i < 11 else "v", i) for i in range(20)]
    flagged = profile_flags(profile(spark.createDataFrame(data, "a string, b string, c int")))
    assert rows(flagged, "cols", "drop_candidate", "dimension_candidate", "dominant_value") == [
        ("a", False, True, True), ("b", True, True, False), ("c", False, False, False),
    ]


def test_nulls_by_key(reported):
    by_tag = null_breakdown(reported, "value", "tag")
    assert by_tag.columns == ["tag", "null_count", "total_count", "null_pct_of_tag"]
    # A missing key is left out, and so is a key that misses nothing.
    assert [tuple(row) for row in by_tag.collect()] == [("A", 2, 3, 66.67), ("C", 1, 3, 33.33)]
    assert [row.tag for row in null_breakdown(reported, "value", "tag", min_pct=50).collect()] == ["A"]


def test_shares(reported):
    found = category_share(reported, "uom").collect()
    assert [tuple(row) for row in found] == [("USD", 6, 75.0), (None, 1, 12.5), ("EUR", 1, 12.5)]


def test_usage_shares_equal_a_plain_join(spark, reported):
    # B has two definitions, so its rows count twice, as in a join of the rows themselves.
    data = [("A", 0), ("B", 1), ("B", 0), ("unused", 1)]
    definitions = spark.createDataFrame(data, "tag string, custom int")
    plain = category_share(reported.join(definitions, "tag", "left"), "custom")
    assert rows(usage_share(reported, definitions, ["tag"], "custom")) == rows(plain)


def test_frequencies(reported):
    assert [tuple(row) for row in frequency(reported, "qtrs").collect()] == [
        (1, 3), (4, 3), (None, 1), (0, 1),
    ]
    assert [tuple(row) for row in top_values(reported, "tag", 2).collect()] == [("A", 3), ("C", 3)]


def test_summary(reported):
    found = {row.column: row for row in numeric_summary(reported, ["value", "qtrs"]).collect()}
    value = found["value"]
    assert (value["count"], value.mean, value.min, value.p25, value.p50, value.p75, value.max) == (
        4, 1.25, "-2.0000", "-2.0000", "1.0000", "3.0000", "3.0000",
    )
    assert value.stddev == pytest.approx(2.3629, abs=1e-4)
    assert found["qtrs"]["count"] == 7 and found["qtrs"].p50 == "1"


def test_summary_keeps_all_digits(spark):
    data = [(Decimal(f"12345678901234567{k}.1234"), word) for k, word in ((8, "b"), (9, None), (10, "a"))]
    data = [(Decimal("123456789012345678.1234") + k, word) for k, (_, word) in enumerate(data)]
    table = spark.createDataFrame(data, "d decimal(28,4), t string")
    number, text = numeric_summary(table, ["d", "t"]).collect()
    assert (number.min, number.p50, number.max) == (
        "123456789012345678.1234", "123456789012345679.1234", "123456789012345680.1234",
    )
    assert number.stddev == 1.0
    assert (text["count"], text.mean, text.stddev, text.min, text.max) == (2, None, None, "a", "b")


def test_summary_of_nothing(spark):
    (row,) = numeric_summary(spark.createDataFrame([], "v int"), ["v"]).collect()
    assert tuple(row) == ("v", 0, None, None, None, None, None, None, None)


@pytest.mark.parametrize(
    ("day", "expected"),
    [
        (date(2024, 3, 31), True), (date(2024, 6, 30), True), (date(2023, 9, 30), True),
        (date(2023, 12, 31), True), (date(2024, 3, 30), False), (date(2024, 1, 31), False), (None, None),
    ],
)
def test_quarter_ends(spark, day, expected):
    table = spark.createDataFrame([(day,)], "day date")
    assert table.select(is_quarter_end(F.col("day"))).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("$ 1,234.50", Decimal("1234.5")), ("USD -7", Decimal("-7")), ("NM", None), ("—", None),
        (None, None), ("1.2.3", None), ("12", Decimal("12")),
    ],
)
def test_numbers_in_text(spark, text, expected):
    table = spark.createDataFrame([(text,)], "text string")
    assert table.select(numeric_text(F.col("text"))).first()[0] == expected


def test_digits(spark):
    table = spark.createDataFrame([("(123) 456-7890",)], "text string")
    assert table.select(digits_only(F.col("text"))).first()[0] == "1234567890"
