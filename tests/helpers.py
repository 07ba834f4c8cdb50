"""Small helpers shared by the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as plain tuples in a fixed order; NULLs first."""
    chosen = df.select(*columns) if columns else df
    return sorted(
        (tuple(row) for row in chosen.collect()),
        key=lambda row: [(value is not None, value if value is not None else 0) for value in row],
    )


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def frame(spark, schema, columns: list[str], data: list[tuple]) -> DataFrame:
    """A frame of ``schema`` from tuples of some of its columns; the others are NULL."""
    full = [tuple(dict(zip(columns, row)).get(name) for name in schema.names) for row in data]
    return spark.createDataFrame(full, schema)
