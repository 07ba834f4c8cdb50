"""Tab-separated files with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_tsv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan tab-separated text. Without a schema the types are inferred, at the cost of one more scan."""
    reader = spark.read.option("header", True).option("sep", "\t")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Write tab-separated text that ``read_tsv`` reads back unchanged (blanks inside values stay)."""
    (
        df.write.option("header", True)
        .option("sep", "\t")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
