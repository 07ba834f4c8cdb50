"""Grouped reports: NULL shares, category shares, frequencies, numeric summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from filingstrata.operators.ranks import quantiles_of_counts
from filingstrata.sources.staging import stage

# The quartiles of a numeric summary.
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def null_breakdown(
    df: DataFrame, value: str, by: str, min_pct: float | None = None
) -> DataFrame:
    """NULLs of ``value`` per non-null key: ``null_count``, ``total_count``, ``null_pct_of_<by>``.

    Only keys with at least one NULL, most NULLs first. Both counts come from one aggregation.
    """
    share = f"null_pct_of_{by}"
    counted = (
        df.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count_if(F.col(value).isNull()).alias("null_count"),
            F.count(F.lit(1)).alias("total_count"),
        )
        .filter("null_count > 0")
        .withColumn(share, F.round(F.col("null_count") / F.col("total_count") * 100, 2))
    )
    if min_pct is not None:
        counted = counted.filter(F.col(share) >= min_pct)
    return counted.orderBy(F.desc("null_count"), by)


def frequency(df: DataFrame, by: str) -> DataFrame:
    """Rows per value (NULL is a value), most frequent first."""
    counted = df.groupBy(by).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), by)


def category_share(df: DataFrame, by: str, percentage: str = "percentage") -> DataFrame:
    """Rows per value and their share of all rows in percent, most frequent first."""
    return _with_share(df.groupBy(by).agg(F.count(F.lit(1)).alias("count")), by, percentage)


def usage_share(
    df: DataFrame,
    definitions: DataFrame,
    on: Sequence[str],
    by: str,
    percentage: str = "percentage",
) -> DataFrame:
    """Shares of ``by``, a column of ``definitions``, among the rows of ``df``; NULL for undefined rows.

    Rows are counted per key before the join, so the join moves one row per key and task instead of
    every row of ``df``, and a key that many rows share is one row by then.
    """
    used = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__uses"))
    defined = used.join(definitions.select(*on, by), list(on), "left")
    return _with_share(defined.groupBy(by).agg(F.sum("__uses").alias("count")), by, percentage)


def _with_share(counted: DataFrame, by: str, percentage: str) -> DataFrame:
    # The total is summed from the group counts and reaches them as one broadcast row.
    total = counted.agg(F.sum("count").alias("__total"))
    shared = counted.crossJoin(F.broadcast(total)).select(
        by, "count", (F.col("count") * 100 / F.col("__total")).alias(percentage)
    )
    return shared.orderBy(F.desc("count"), by)


def top_values(df: DataFrame, by: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent non-null values; ties go to the smallest."""
    return frequency(df.filter(F.col(by).isNotNull()), by).limit(n)


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, stddev, min, exact lower quartiles, max.

    The order statistics are exact in the column's own type and written as text, so columns of
    several types share a table and no digit is lost; text columns are ordered as text. Mean and
    standard deviation come from the distances to the mean's neighbourhood, so they hold for large
    decimals too; they are NULL for text. The input is read once: values are counted, the counts
    staged, and everything follows from them.
    """
    sets = [[name] for name in columns]
    counts = df.groupingSets(sets, *columns).agg(
        F.count(F.lit(1)).alias("__n"), *[F.grouping(name).alias(f"__rolled_{name}") for name in columns]
    )
    counts = stage(counts, "summary")
    rows = []
    for name in columns:
        mine = counts.filter((F.col(f"__rolled_{name}") == 0) & F.col(name).isNotNull())
        rows.append(_summary_of(mine.select(F.col(name).alias("value"), "__n"), name))
    return reduce(lambda left, right: left.unionByName(right), rows)


def _summary_of(counted: DataFrame, column: str) -> DataFrame:
    """The summary row of one column from its distinct values and their counts."""
    value, n = F.col("value"), F.col("__n")
    ends = counted.agg(F.sum("__n").alias("count"), F.min("value").alias("low"), F.max("value").alias("max"))
    numeric = isinstance(counted.schema["value"].dataType, NumericType)
    # Differences are taken in the column's type; only what is left of them becomes a double.
    near = counted.crossJoin(F.broadcast(ends.select("low"))) if numeric else None
    if numeric:
        apart = (value - F.col("low")).cast("double")
        first = near.agg((F.sum(apart * n) / F.sum("__n")).alias("shift"))
        spread = near.crossJoin(F.broadcast(first)).agg(
            F.first("shift").alias("shift"),
            F.sqrt(F.try_divide(F.sum((apart - F.col("shift")) ** 2 * n), F.sum("__n") - 1)).alias("stddev"),
        )
        mean = F.col("low").cast("double") + F.col("shift")
        ends = ends.crossJoin(F.broadcast(spread))
    else:
        ends = ends.withColumn("stddev", F.lit(None).cast("double"))
        mean = F.lit(None).cast("double")
    quartiles = quantiles_of_counts(counted, "value", QUARTILES)
    # One row on both sides.
    joined = ends.crossJoin(F.broadcast(quartiles))
    return joined.select(
        F.lit(column).alias("column"),
        F.coalesce("count", F.lit(0)).alias("count"),
        mean.alias("mean"),
        "stddev",
        F.col("low").cast("string").alias("min"),
        *[F.col(name).cast("string").alias(name) for name in QUARTILES],
        F.col("max").cast("string").alias("max"),
    )
