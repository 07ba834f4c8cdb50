"""Total orders over large tables without a one-task window.

A global ``row_number`` puts every row in one task. Here rows are range-partitioned and sorted once,
each partition ("slice") numbers its own rows, and a running total over one row per slice shifts the
slices onto one sequence.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingstrata.operators.joins import splittable_join
from filingstrata.sources.staging import stage

# Layout of monotonically_increasing_id: partition index above, row index in the lower 33 bits.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1

# Most values of one group that one task takes at once; larger groups are ranked across tasks.
LARGE_GROUP = 200_000

# Most copies one task emits for one input row when equal rows are expanded again.
_COPIES_PER_ROW = 100_000


def sorted_slices(df: DataFrame, order_by: Sequence[str], label: str) -> DataFrame:
    """``df`` in range-partitioned order with ``__slice`` (increasing) and ``__at`` (0-based in slice).

    The result is staged, because slice boundaries come from a sample: two evaluations of the same
    plan may cut differently, and counts of one must not be applied to rows of the other.
    """
    keys = [F.col(name).asc_nulls_first() for name in order_by]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__place", F.monotonically_increasing_id())
    )
    staged = stage(placed, label)
    return staged.select(
        *[F.col(name) for name in df.columns],
        F.shiftright("__place", _ROW_BITS).alias("__slice"),
        F.col("__place").bitwiseAND(F.lit(_ROW_MASK)).alias("__at"),
    )


def _slice_offsets(slices: DataFrame, weight: Column, by: Sequence[str] = ()) -> DataFrame:
    """One row per slice (and group): ``__before`` is the weight of all earlier slices, ``__total`` of all.

    The windows see one row per slice, so at most one per shuffle partition and group.
    """
    group = Window.partitionBy(*by)
    earlier = group.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slices.groupBy(*by, "__slice").agg(weight.alias("__weight"))
    return sizes.select(
        *by,
        "__slice",
        F.coalesce(F.sum("__weight").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__weight").over(group).alias("__total"),
    )


def dense_key(
    df: DataFrame, key: str, order_by: Sequence[str] = (), unique: bool = True
) -> DataFrame:
    """Number the rows 1..n in the order of ``order_by`` and then all other columns, NULL first.

    The numbers depend on the rows only, not on partitioning. ``unique`` states that no two rows are
    equal; without it equal rows are counted before they are range-partitioned, so many copies of
    one row do not end up in one task.
    """
    columns = df.columns
    order = [*order_by, *[name for name in columns if name not in order_by]]
    if unique:
        slices = sorted_slices(df, order, "dense_key")
        offsets = _slice_offsets(slices, F.max("__at") + 1)
        # One row per slice: bounded by the number of shuffle partitions, whatever the data size.
        numbered = slices.join(F.broadcast(offsets), "__slice")
        return numbered.select((F.col("__before") + F.col("__at") + 1).alias(key), *columns)

    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    slices = sorted_slices(counted, order, "dense_key")
    offsets = _slice_offsets(slices, F.sum("__copies"))
    running = F.sum("__copies").over(Window.partitionBy("__slice").orderBy("__at"))
    numbered = (
        slices.withColumn("__running", running)
        .join(F.broadcast(offsets), "__slice")
        .withColumn("__first", F.col("__before") + F.col("__running") - F.col("__copies") + 1)
    )
    return _expand_copies(numbered, key, columns)


def _expand_copies(counted: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per copy, numbered from ``__first``.

    A row with very many copies is first split into chunks that are spread over the cluster.
    """
    zero = F.lit(0).cast("long")
    last_chunk = F.floor((F.col("__copies") - 1) / _COPIES_PER_ROW).cast("long")
    chunks = counted.select(
        *columns, "__copies", "__first", F.explode(F.sequence(zero, last_chunk)).alias("__chunk")
    ).repartition("__first", "__chunk")
    low = F.col("__chunk") * _COPIES_PER_ROW
    high = F.least(low + _COPIES_PER_ROW, F.col("__copies")) - 1
    numbers = F.sequence(F.col("__first") + low, F.col("__first") + high)
    return chunks.select(F.explode(numbers).alias(key), *columns)


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact lower quantiles of ``value``: for each name the smallest value covering that share.

    One row per group with the group columns and one column per name in ``probabilities``; NULLs of
    ``value`` are ignored. Equal values are counted before the range partitioning and a group may
    span any number of slices, so neither a frequent value nor a large group is one task's work.
    """
    present = df.filter(F.col(value).isNotNull())
    counted = present.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    return quantiles_of_counts(counted, value, probabilities, by)


def quantiles_of_counts(
    counted: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """As :func:`exact_quantiles`, of distinct non-null values with their counts in ``__n``."""
    by = list(by)
    slices = sorted_slices(counted, [*by, value], "quantiles")

    inside = Window.partitionBy("__slice", *by).orderBy("__at")
    upto_inside = slices.withColumn("__upto", F.sum("__n").over(inside))
    offsets = _slice_offsets(slices, F.sum("__n"), by)
    if by:
        # The slice is part of the key, so the rows of one large group stay spread out.
        same = [upto_inside[name].eqNullSafe(offsets[name]) for name in [*by, "__slice"]]
        ranked = upto_inside.join(offsets, same).select(
            upto_inside["*"], offsets["__before"], offsets["__total"]
        )
    else:
        # One row per slice: bounded by the number of shuffle partitions.
        ranked = upto_inside.join(F.broadcast(offsets), "__slice")

    upto = F.col("__before") + F.col("__upto")
    chosen = []
    for name, probability in probabilities.items():
        rank = F.greatest(F.lit(1), F.ceil(F.lit(probability) * F.col("__total")))
        covers = (upto - F.col("__n") < rank) & (rank <= upto)
        chosen.append(F.max(F.when(covers, F.col(value))).alias(name))
    return ranked.groupBy(*by).agg(*chosen)


def group_medians(
    rows: DataFrame, by: Sequence[str], values: Sequence[str], large: DataFrame | None
) -> DataFrame:
    """Exact lower medians of several columns: one row per group with the group and each column's median.

    ``large`` holds the group columns of the groups with too many values for one task (see
    :func:`large_groups`), or is None where there are none. All others take one shuffle; the large ones
    are ranked across slices. Both ways give the same medians. A group without any value has no row.
    """
    by, values = list(by), list(values)
    if large is None:
        return _medians_in_task(rows, by, values)
    small = _medians_in_task(splittable_join(rows, large, by, "left_anti"), by, values)
    return small.unionByName(_medians_by_rank(splittable_join(rows, large, by, "left_semi"), by, values))


def large_groups(
    sizes: DataFrame, by: Sequence[str], size: str, limit: int | None = None
) -> DataFrame | None:
    """The groups whose ``size`` is beyond the limit, staged; None where there are none."""
    found = sizes.filter(F.col(size) > (LARGE_GROUP if limit is None else limit)).select(*by)
    staged = stage(found, "large_groups")
    return None if staged.isEmpty() else staged


def _medians_in_task(rows: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """The middle row of each sorted group, for all columns of a type at once."""

    def middle(names: list[str]) -> DataFrame:
        many = len(names) > 1
        listed = rows.select(*by, *names).unpivot(by, names, "__of", "__v") if many else rows.select(*by, F.col(names[0]).alias("__v"))
        keys = [*by, "__of"] if many else by
        group = Window.partitionBy(*keys)
        placed = listed.filter(F.col("__v").isNotNull()).select(
            "*", F.row_number().over(group.orderBy("__v")).alias("__at"), F.count(F.lit(1)).over(group).alias("__size")
        )
        found = placed.filter(F.col("__at") == F.ceil(F.col("__size") / 2))
        if not many:
            return found.select(*by, F.col("__v").alias(names[0]))
        return _by_column(found.withColumnRenamed("__v", "__median"), by, names)

    return _for_each_type(rows, by, values, middle)


def _medians_by_rank(rows: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """One rank selection for all columns of a type, with the column as one more part of the key."""

    def ranked(names: list[str]) -> DataFrame:
        unpivoted = rows.select(*by, *names).unpivot(by, names, "__of", "__v")
        return _by_column(exact_quantiles(unpivoted, "__v", {"__median": 0.5}, [*by, "__of"]), by, names)

    return _for_each_type(rows, by, values, ranked)


def _by_column(found: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    medians = [F.max(F.when(F.col("__of") == name, F.col("__median"))).alias(name) for name in names]
    return found.groupBy(*by).agg(*medians)


def _for_each_type(rows: DataFrame, by: list[str], values: list[str], medians: Callable[[list[str]], DataFrame]) -> DataFrame:
    kinds: dict[str, list[str]] = {}
    for name in values:
        kinds.setdefault(rows.schema[name].dataType.simpleString(), []).append(name)
    joined = reduce(lambda left, right: left.join(right, by, "full_outer"), map(medians, kinds.values()))
    return joined.select(*by, *values)


def medians_of_counts(
    counted: DataFrame, value: str, by: Sequence[str], name: str, limit: int | None = None
) -> DataFrame:
    """Exact lower median per group of distinct non-null values with their counts in ``__n``.

    As :func:`group_medians`: a window where the distinct values of a group fit a task, ranks across
    slices for larger groups.
    """
    by = list(by)
    sizes = counted.groupBy(*by).agg(F.count(F.lit(1)).alias("__size"))
    large = large_groups(sizes, by, "__size", limit)
    small = counted if large is None else splittable_join(counted, large, by, "left_anti")
    group = Window.partitionBy(*by)
    upto = F.sum("__n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = small.select(*by, value, "__n", upto.alias("__upto"), F.sum("__n").over(group).alias("__total"))
    half = F.ceil(F.col("__total") / 2)
    middle = (F.col("__upto") >= half) & (F.col("__upto") - F.col("__n") < half)
    found = placed.filter(middle).select(*by, F.col(value).alias(name))
    if large is None:
        return found
    ranked = quantiles_of_counts(splittable_join(counted, large, by, "left_semi"), value, {name: 0.5}, by)
    return found.unionByName(ranked)
