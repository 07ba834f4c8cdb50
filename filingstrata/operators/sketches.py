"""Column profiles that can be stored by quarter and merged, from Spark's own sketches.

A state has one row for each column (and quarter): counts, sums and extremes, which merge exactly, and
sketches of distinct values, of quantiles and of the most frequent texts. States are of bounded size, so
a new quarter costs one scan of its own rows, without a shuffle of values. The exact profile is in
:mod:`.profile`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

HLL_BITS = 12  # 4,096 registers: the standard error of distinct counts is 1.04 / 64, 1.6 %
KLL_K = 200  # ranks of quantiles are off by 1.65 % of the rows at most, with 99 % confidence
TRACKED = 4096  # texts that are followed; frequencies are exact while a column has fewer than 3/4 of that
_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def profile_state(df: DataFrame, per: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """The state of each column of ``df`` other than ``per``, one row for each value of ``per`` and column.

    Columns: ``per``, ``cols``, ``data_types``, ``rows``, ``nulls``, ``distinct_sketch``, and for numbers
    ``low``, ``high``, ``total``, ``squares`` and ``quantile_sketch``; ``top_sketch`` is empty but for texts.
    """
    per = list(per)
    names = [name for name in df.columns if name not in per]
    numbers = [name for name in names if isinstance(df.schema[name].dataType, NumericType)]
    texts = [name for name in names if isinstance(df.schema[name].dataType, StringType)]
    wanted = [F.count(F.lit(1)).alias("__rows")]
    for name in names:
        column = F.col(name)
        wanted += [
            F.count_if(column.isNull()).alias(f"{name}__nulls"),
            F.hll_sketch_agg(column.cast("string"), HLL_BITS).alias(f"{name}__distinct"),
        ]
        if name in numbers:
            value = column.cast("double")
            wanted += [
                F.min(value).alias(f"{name}__low"), F.max(value).alias(f"{name}__high"),
                F.sum(value).alias(f"{name}__total"), F.sum(value * value).alias(f"{name}__squares"),
                F.kll_sketch_agg_double(value, KLL_K).alias(f"{name}__quantile"),
            ]
        # others get an empty sketch of texts: sketches merge only where there are some
        text, held = (f"`{name}`", f"`{name}` IS NOT NULL") if name in texts else ("CAST(NULL AS STRING)", "FALSE")
        wanted.append(F.expr(f"approx_top_k_accumulate({text}, {tracked}) FILTER (WHERE {held})").alias(f"{name}__top"))
    wide = df.groupBy(*per).agg(*wanted)

    def part(name: str, of: str, held: bool, kind: str) -> Column:
        return (F.col(f"{name}__{of}") if held else F.lit(None)).cast(kind)

    rows = [
        F.struct(
            F.lit(name).alias("cols"),
            F.lit(df.schema[name].dataType.simpleString()).alias("data_types"),
            F.col("__rows").alias("rows"),
            F.col(f"{name}__nulls").alias("nulls"),
            F.col(f"{name}__distinct").alias("distinct_sketch"),
            *[part(name, of, name in numbers, "double").alias(of) for of in ("low", "high", "total", "squares")],
            part(name, "quantile", name in numbers, "binary").alias("quantile_sketch"),
            F.col(f"{name}__top").alias("top_sketch"),
        )
        for name in names
    ]
    return wide.select(*per, F.inline(F.array(*rows)))


def merged_state(states: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """States of several quarters as one state (for each value of ``per``)."""
    numeric = F.col("quantile_sketch").isNotNull()
    merged = states.groupBy(*per, "cols", "data_types").agg(
        *[F.sum(name).alias(name) for name in ("rows", "nulls")],
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.expr("kll_merge_agg_double(quantile_sketch) FILTER (WHERE quantile_sketch IS NOT NULL)").alias("quantile_sketch"),
        F.max(numeric).alias("__numeric"), F.expr("approx_top_k_combine(top_sketch)").alias("top_sketch"),
    )
    return merged.withColumn("quantile_sketch", F.when(F.col("__numeric"), F.col("quantile_sketch"))).drop("__numeric")


def profile_of_state(state: DataFrame) -> DataFrame:
    """One row per column: shares, and what the sketches estimate.

    ``cols``, ``data_types``, ``rows``, ``null_percentage``, ``distinct_estimate``, ``top1_value`` and
    ``top1_value_count`` (texts), ``low``, ``high``, ``mean``, ``stddev``, ``p25``, ``p50`` and ``p75`` (numbers).
    Counts, extremes, means and deviations are those of the rows; see the module's constants for the others.
    """
    held = (F.col("rows") - F.col("nulls")).cast("double")
    mean = F.when(held > 0, F.col("total") / held)
    spread = F.greatest(F.col("squares") - F.col("total") * F.col("total") / held, F.lit(0.0))
    quantiles = [
        F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(share))).alias(name)
        for name, share in _QUARTILES.items()
    ]
    best = F.get(F.expr("approx_top_k_estimate(top_sketch, 1)"), F.lit(0))
    return state.select(
        "cols", "data_types", "rows",
        F.when(F.col("rows") > 0, F.col("nulls") * 100.0 / F.col("rows")).alias("null_percentage"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
        best["item"].alias("top1_value"), best["count"].alias("top1_value_count"), "low", "high", mean.alias("mean"), F.when(F.col("total").isNotNull() & (held > 1), F.sqrt(spread / (held - 1))).alias("stddev"), *quantiles,
    )
