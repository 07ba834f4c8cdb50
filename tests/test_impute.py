"""Properties of the imputation operators against brute force."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filingstrata.operators.checks import check_not_null
from filingstrata.operators.impute import (
    Fill,
    fill_from_groups,
    impute_default,
    impute_median,
    impute_mode,
)
from helpers import rows

CELLS = st.lists(
    st.tuples(
        st.sampled_from([None, "a", "b", "c"]),
        st.sampled_from([None, 1, 2, 3]),
        st.sampled_from([None, 10, 20, 30, 40]),
    ),
    min_size=1,
    max_size=30,
)
SLOW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def _mode(values):
    counts = Counter(value for value in values if value is not None)
    return min(counts, key=lambda value: (-counts[value], value)) if counts else None


def _lower_median(values):
    present = sorted(value for value in values if value is not None)
    return present[(len(present) - 1) // 2] if present else None


def _expected(data, column, statistic):
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row[column])
    found = {key: statistic(values) for key, values in groups.items() if key is not None}
    return [row[column] if row[column] is not None else found.get(row[0]) for row in data]


def _table(spark, data):
    numbered = [(i, *row) for i, row in enumerate(data)]
    return spark.createDataFrame(numbered, "i int, k string, m int, v int").repartition(3)


@SLOW
@given(data=CELLS)
def test_mode_and_median_match_brute_force(spark, data):
    table = _table(spark, data)
    fills = [Fill("m", "mode"), Fill("v", "median")]
    modes, medians = _expected(data, 1, _mode), _expected(data, 2, _lower_median)
    expected = [(i, row[0], modes[i], medians[i]) for i, row in enumerate(data)]
    for options in ({}, {"rare_gaps": True}, {"sketch": 10_000}):
        filled = fill_from_groups(table, ["k"], fills, **options)
        assert filled.columns == table.columns
        assert sorted(tuple(row) for row in filled.collect()) == expected


@SLOW
@given(data=CELLS)
def test_global_mode_counts_the_filled_column(spark, data):
    once = _expected(data, 1, _mode)
    overall = _mode(once)
    filled = impute_mode(_table(spark, data), ["m"], ["k"], global_mode=True)
    found = {row.i: row.m for row in filled.collect()}
    assert found == {i: value if value is not None else overall for i, value in enumerate(once)}


def test_one_group_with_a_third_of_the_rows(spark):
    big = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).cast("int").alias("k"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 11).cast("int").alias("m"),
    )
    filled = impute_mode(big, ["m"], ["k"], global_mode=True)
    assert filled.count() == 40_000
    assert filled.filter("m is null").count() == 0
    by_hand = big.filter("k = 0 and m is not null").groupBy("m").count().orderBy(F.desc("count"), "m")
    gap_fill = filled.filter("k = 0").groupBy("m").count().orderBy(F.desc("count")).first()
    assert gap_fill.m == by_hand.first().m


def test_fallback_expression(spark):
    table = _table(spark, [("a", 1, None), ("b", None, None), (None, None, 3)])
    filled = impute_mode(table, ["m"], ["k"], fallback=F.lit(-1))
    assert rows(filled, "i", "m") == [(0, 1), (1, -1), (2, -1)]


def test_median_flag(spark):
    table = _table(spark, [("a", None, 5), ("a", None, None), ("b", None, None), (None, None, 7)])
    filled = impute_median(table, ["v"], ["k"], flag="bare")
    assert rows(filled, "i", "v", "bare") == [(0, 5, False), (1, 5, False), (2, None, True), (3, 7, True)]


def test_defaults_see_earlier_ones(spark):
    table = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    filled = impute_default(table, {"a": F.lit(5), "b": F.col("a") * 2})
    assert rows(filled) == [(1, 2), (5, 10)]


def test_residual_check(spark):
    table = _table(spark, [("a", 1, None), (None, None, None)])
    assert rows(check_not_null(table, ["k", "m", "v"])) == [("k", 1), ("m", 1), ("v", 2)]


def test_unknown_statistic_is_refused():
    with pytest.raises(ValueError, match="unknown statistic"):
        Fill("m", "mean")
    with pytest.raises(ValueError, match="global mode"):
        Fill("m", "median", global_mode=True)
