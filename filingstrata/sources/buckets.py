"""Tables laid out for joins and lookups: buckets by join key, sorted rows with Bloom filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from filingstrata.sources.tables import Lake


def write_bucketed(
    lake: Lake, df: DataFrame, layer: str, table: str, by: Sequence[str], buckets: int, schema: str | None = None
) -> str:
    """Replace a table by ``df`` in buckets of ``by``, sorted inside, and return its registered name.

    Tables with the same buckets join on ``by`` without an exchange. The rows are dealt out by the bucket's
    own hash, so each bucket is one file. Choose as many buckets as the largest table needs tasks; all
    columns of the join in ``by``, so that no single filing fills a bucket. Only reads by name know the buckets.
    """
    name = lake.claim(layer, table, schema)
    dealt = df.repartition(buckets, *by).sortWithinPartitions(*by)
    writer = dealt.write.format(lake.format).mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
    writer.option("path", lake.path(layer, table)).saveAsTable(name)
    return name


def register_bucketed(
    lake: Lake, layer: str, table: str, by: Sequence[str], buckets: int, schema: str | None = None
) -> str:
    """Make the files of :func:`write_bucketed` known in a session that has not written them."""
    columns = lake.read(layer, table).schema
    name = lake.claim(layer, table, schema)
    listed = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in columns)
    keys = ", ".join(f"`{key}`" for key in by)
    path = lake.path(layer, table).replace("'", "\\'")
    lake.spark.sql(
        f"CREATE TABLE {name} ({listed}) USING {lake.format} "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return name


def write_for_lookup(
    lake: Lake, df: DataFrame, layer: str, table: str, key: str, partition_by: Sequence[str] = (), distinct: int = 1_000_000
) -> None:
    """Replace a table (or its partitions in ``df``) so that one value of ``key`` is found without a scan.

    Each file is sorted by the key, so page and row-group bounds leave one stretch of it to read, and has a
    Bloom filter of the key, so files without the value are not read at all. ``distinct`` values a file are
    expected. Nothing is shuffled for it.
    """
    options = {
        f"parquet.bloom.filter.enabled#{key}": "true",
        f"parquet.bloom.filter.expected.ndv#{key}": str(distinct),
        "parquet.bloom.filter.adaptive.enabled": "true",
    }
    lake.write(df.sortWithinPartitions(*partition_by, key), layer, table, partition_by=partition_by, options=options)
