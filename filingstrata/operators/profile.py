"""Column profiles and the rules that read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the profile rules.
SPARSE_ABOVE_PERCENT = 50.0
DIMENSION_BELOW_DISTINCT = 50
DOMINANT_ABOVE_PERCENT = 90.0


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, NULL share, distinct values, and the most frequent text value.

    Columns: ``cols``, ``data_types``, ``null_percentage``, ``distinct_count``, ``top1_value``,
    ``top1_value_count``, ``top1_value_percentage``. The top-1 columns are NULL for columns that are
    not text; ties go to the smallest value; shares of an empty table are NULL.

    One scan and one shuffle of (column, value) counts, pre-aggregated in each task, replace one
    scan per column and per statistic.
    """
    names = df.columns
    as_text = df.select(*[F.col(name).cast("string").alias(name) for name in names])
    values = as_text.unpivot([], names, "cols", "value").groupBy("cols", "value")
    counted = values.agg(F.count(F.lit(1)).alias("n"))

    present = F.col("value").isNotNull()
    rolled = counted.groupBy("cols").agg(
        F.sum("n").alias("rows"),
        _sum_where(~present, F.col("n")).alias("nulls"),
        F.count("value").alias("distinct"),
        F.min_by("value", F.when(present, F.struct(-F.col("n"), F.col("value")))).alias("top"),
        F.coalesce(F.max(F.when(present, F.col("n"))), F.lit(0)).alias("top_n"),
    )

    # One row per column of the profiled table, so that an empty table is described as well.
    described = df.sparkSession.createDataFrame(df.dtypes, "cols string, data_types string")
    is_text = F.col("data_types") == "string"
    top_n = F.coalesce("top_n", F.lit(0))
    return described.join(rolled, "cols", "left").select(
        "cols",
        "data_types",
        _percent(F.col("nulls"), F.col("rows")).alias("null_percentage"),
        F.coalesce("distinct", F.lit(0)).alias("distinct_count"),
        F.when(is_text, F.col("top")).alias("top1_value"),
        F.when(is_text, top_n).alias("top1_value_count"),
        F.when(is_text, _percent(top_n, F.col("rows"))).alias("top1_value_percentage"),
    )


def profile_flags(profiled: DataFrame) -> DataFrame:
    """Add the three rules: too sparse to keep, few enough values for a dimension, one value dominates."""
    return profiled.withColumns(
        {
            "drop_candidate": F.col("null_percentage") > SPARSE_ABOVE_PERCENT,
            "dimension_candidate": (F.col("data_types") == "string")
            & (F.col("distinct_count") < DIMENSION_BELOW_DISTINCT),
            "dominant_value": F.coalesce(
                F.col("top1_value_percentage") > DOMINANT_ABOVE_PERCENT, F.lit(False)
            ),
        }
    )


def _sum_where(condition: Column, amount: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0))


def _percent(part: Column, whole: Column) -> Column:
    return part.cast("double") * 100.0 / whole
