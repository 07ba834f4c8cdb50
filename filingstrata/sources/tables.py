"""Layered tables below one root: ``<root>/<layer>/<table>``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from filingstrata.sources import files


@dataclass(frozen=True)
class Lake:
    """Reads and writes layered tables by path, and by ``layer.table`` name once registered.

    ``format`` is any Spark source that overwrites in place; Parquet by default.
    """

    spark: SparkSession
    root: str
    format: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def read(
        self,
        layer: str,
        table: str,
        quarters: Sequence[tuple[int, int]] | None = None,
        merge_schema: bool = False,
        schema: StructType | None = None,
    ) -> DataFrame:
        """Scan a table. ``quarters`` keeps the named (year, quarter) partitions only.

        With ``merge_schema`` the footers of all files are read first, and a column that appears in
        later quarters reads as NULL in the earlier ones. A declared ``schema`` needs no footer.
        """
        reader = self.spark.read.format(self.format).option("mergeSchema", merge_schema)
        reader = reader if schema is None else reader.schema(schema)
        df = reader.load(self.path(layer, table))
        if quarters is None:
            return df
        wanted = F.lit(False)
        for year, quarter in quarters:
            wanted = wanted | ((F.col("year") == year) & (F.col("quarter") == quarter))
        return df.filter(wanted)

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str] = (),
        metrics: Mapping[str, Column] | None = None,
        without: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
    ) -> dict[str, object]:
        """Replace a table and its schema; with ``partition_by``, replace only the partitions in ``df``.

        ``metrics`` names aggregates over the written rows; the job that writes takes them along, and
        their values are returned. They may use the columns ``without`` which the table is written.
        """
        seen = Observation()
        if metrics:
            df = df.observe(seen, *[value.alias(name) for name, value in metrics.items()])
        df = df.drop(*without)
        writer = df.write.format(self.format).mode("overwrite").options(**(options or {}))
        if partition_by:
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.option("overwriteSchema", True)
        writer.save(self.path(layer, table))
        return seen.get if metrics else {}

    def drop_partition(self, layer: str, table: str, values: dict[str, object]) -> None:
        """Remove one partition's files, named by the values of the first partition columns."""
        folder = "/".join(f"{name}={value}" for name, value in values.items())
        files.delete(self.spark, f"{self.path(layer, table)}/{folder}")

    def exists(self, layer: str, table: str) -> bool:
        return files.exists(self.spark, self.path(layer, table))

    def drop(self, layer: str, table: str, schema: str | None = None) -> None:
        """Remove a table's files and its catalog entry, if there are any.

        An entry of that name that is no external table at this lake's path is someone else's: then
        ValueError is raised and nothing is removed.
        """
        if self.is_registered(layer, table, schema):
            self._require_own(layer, table, schema)
            self.spark.sql(f"DROP TABLE {self._name(layer, table, schema)}")
        files.delete(self.spark, self.path(layer, table))

    def register(self, layer: str, table: str, schema: str | None = None) -> str:
        """Make a written table readable as ``spark.table("<schema>.<table>")``; the layer names the schema.

        An earlier entry is replaced only if it is an external table at this lake's path; otherwise
        ValueError is raised and the entry stays.
        """
        name = self.claim(layer, table, schema)
        self.spark.catalog.createTable(name, path=self.path(layer, table), source=self.format)
        if {"year", "quarter"} <= set(self._partition_columns(name)):
            self.spark.catalog.recoverPartitions(name)
        return f"{schema or layer}.{table}"

    def claim(self, layer: str, table: str, schema: str | None = None) -> str:
        """Make room for a catalog entry and return its quoted name; ValueError as in :meth:`register`."""
        name = self._name(layer, table, schema)
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema or layer}`")
        if self.is_registered(layer, table, schema):
            self._require_own(layer, table, schema)
            self.spark.sql(f"DROP TABLE {name}")  # external: the files stay
        return name

    def is_registered(self, layer: str, table: str, schema: str | None = None) -> bool:
        catalog = self.spark.catalog
        return catalog.databaseExists(schema or layer) and catalog.tableExists(f"{schema or layer}.{table}")

    def _name(self, layer: str, table: str, schema: str | None) -> str:
        return f"`{schema or layer}`.`{table}`"

    def _require_own(self, layer: str, table: str, schema: str | None) -> None:
        name = self._name(layer, table, schema)
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name in ('Type', 'Location')")
        found = {row.col_name: row.data_type for row in described.collect()}  # two rows
        own = files.qualified(self.spark, self.path(layer, table))
        at = found.get("Location")
        if found.get("Type") != "EXTERNAL" or not at or files.qualified(self.spark, at) != own:
            raise ValueError(f"{name} is not this lake's table at {own}")

    def _partition_columns(self, name: str) -> list[str]:
        return [column.name for column in self.spark.catalog.listColumns(name) if column.isPartition]
