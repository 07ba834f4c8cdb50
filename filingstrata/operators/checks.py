"""Checks that return DataFrames, so they can be stored or joined like any other result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with the number of NULLs left (``cols``, ``nulls``), from one scan."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], list(columns), "cols", "nulls")
