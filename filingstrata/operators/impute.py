"""Filling missing values from group statistics, with explicit fallbacks.

Rows that miss nothing, or whose group key is incomplete, are passed through without a shuffle; only
the rest is joined with the statistics of its group. All statistics of one grouping sit in one lookup
table, so any number of columns costs one join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingstrata.operators.joins import splittable_join
from filingstrata.operators.ranks import group_medians, large_groups
from filingstrata.sources.staging import stage


@dataclass(frozen=True)
class Fill:
    """How one column is filled.

    ``statistic``  "mode" (ties go to the smallest value) or "median" (lower of two middle values)
    ``measure``    expression of the column that a median is taken of, when not the column itself
    ``render``     turns the median back into the column's type
    ``global_mode``  fill what the groups leave over with the most frequent value after group filling
    """

    column: str
    statistic: str
    measure: Column | None = None
    render: Callable[[Column], Column] | None = None
    global_mode: bool = False

    def __post_init__(self):
        if self.statistic not in ("mode", "median"):
            raise ValueError(f"unknown statistic {self.statistic!r}")
        if self.global_mode and self.statistic != "mode":
            raise ValueError("a global mode completes a group mode")

    @property
    def found(self) -> str:
        return f"__found_{self.column}"


def _any_null(names: Sequence[str]) -> Column:
    return reduce(or_, [F.col(name).isNull() for name in names])


def _none_null(names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in names])


def fill_from_groups(
    df: DataFrame,
    by: Sequence[str],
    fills: Sequence[Fill],
    sketch: int | None = None,
    rare_gaps: bool = False,
) -> DataFrame:
    """Fill NULLs of each ``Fill.column`` with its statistic over rows that agree in ``by``.

    Non-null values, the number of rows and the column order stay as they are. NULL in ``by``
    belongs to no group. Medians are exact and depend on the rows only, however these are partitioned:
    one shuffle where a group fits a task, a distributed rank selection for larger groups, whose sizes
    are found while the plan is built.
    ``sketch`` takes approximate medians instead, from sketches of that accuracy: their ranks may be
    off by group size / accuracy, and partitioning may change them. ``rare_gaps`` tells that most
    groups miss nothing: medians are then taken only of rows in groups that do, found by a semi join.
    """
    by = list(by)
    targets = [fill.column for fill in fills]
    modes = [fill for fill in fills if fill.statistic == "mode"]
    medians = [fill for fill in fills if fill.statistic == "median"]

    counts = _value_counts(df, by, [fill.column for fill in modes]) if modes else None
    parts = []
    if modes:
        parts.append(_group_modes(counts, by, modes))
    if medians:
        if sketch is None:
            parts.append(_exact_medians(df, by, medians, targets, rare_gaps))
        else:
            rows = _rows_of_gappy_groups(df, by, targets) if rare_gaps else df.filter(_none_null(by))
            parts.append(_sketched_medians(rows, by, medians, sketch))
    lookup = reduce(lambda left, right: left.join(right, by, "full_outer"), parts)

    fillable = _any_null(targets) & _none_null(by)
    gaps = df.filter(fillable)
    # Null tests are never NULL themselves, so every row is in exactly one of the two parts.
    untouched = df.filter(~fillable)

    # With one target every gap row misses it, so the statistic alone is the value. A later filter
    # on that column then turns the left join into an inner one.
    statistic = {
        fill.column: _rendered(fill)
        if len(fills) == 1
        else F.coalesce(F.col(fill.column), _rendered(fill))
        for fill in fills
    }
    filled = splittable_join(gaps, lookup, by, "left").select(
        *[statistic[name].alias(name) if name in statistic else F.col(name) for name in df.columns]
    )
    result = untouched.unionByName(filled)

    completed = [fill for fill in modes if fill.global_mode]
    if completed:
        result = _fill_global_modes(result, counts, lookup, by, completed)
    return result


def impute_mode(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    fallback: Column | None = None,
    global_mode: bool = False,
) -> DataFrame:
    """Fill with the group's most frequent value, then its global counterpart or ``fallback``."""
    fills = [Fill(name, "mode", global_mode=global_mode) for name in columns]
    result = fill_from_groups(df, by, fills)
    if fallback is not None:
        result = impute_default(result, {name: fallback for name in columns})
    return result


def impute_median(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    sketch: int | None = None,
    flag: str | None = None,
    rare_gaps: bool = False,
) -> DataFrame:
    """Fill with the group's lower median.

    ``flag`` names a column that is true where the row's group has no statistic: a NULL group key,
    or no value in the whole group.
    """
    fills = [Fill(name, "median") for name in columns]
    result = fill_from_groups(df, by, fills, sketch, rare_gaps=rare_gaps)
    if flag is not None:
        # A group without statistics leaves its NULLs unfilled; a group with them leaves none.
        result = result.withColumn(flag, _any_null([*by, *columns]))
    return result


def impute_default(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Replace NULLs by expressions, in order: a later default sees the columns filled before it."""
    for name, default in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), default))
    return df


def _rendered(fill: Fill) -> Column:
    found = F.col(fill.found)
    return fill.render(found) if fill.render else found


def _value_counts(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Rows per group and value, for all columns in one scan; ``__rolled_<c>`` is 0 on rows about ``c``.

    Grouping sets keep each column's own type. The partial aggregation makes a frequent key or value
    one row per task before anything is shuffled.
    """
    sets = [[*by, name] for name in columns]
    return df.groupingSets(sets, *by, *columns).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.grouping(name).alias(f"__rolled_{name}") for name in columns],
    )


def _about(name: str) -> Column:
    return F.col(f"__rolled_{name}") == 0


def _most_frequent(name: str, counted: Column) -> Column:
    """Value with the highest count; the smallest such value on ties."""
    rank = F.when(counted, F.struct(-F.col("__n"), F.col(name)))
    return F.min_by(F.col(name), rank)


def _group_modes(counts: DataFrame, by: list[str], fills: Sequence[Fill]) -> DataFrame:
    """Of groups that miss something, per column: ``__found_<c>`` the mode, ``__gaps_<c>`` the NULLs."""
    aggregates = []
    some_gap = reduce(or_, [F.col(f"__gaps_{fill.column}") > 0 for fill in fills])
    for fill in fills:
        name = fill.column
        aggregates.append(
            _most_frequent(name, _about(name) & F.col(name).isNotNull()).alias(fill.found)
        )
        missing = F.when(_about(name) & F.col(name).isNull(), F.col("__n"))
        aggregates.append(F.coalesce(F.sum(missing), F.lit(0)).alias(f"__gaps_{name}"))
    return counts.filter(_none_null(by)).groupBy(*by).agg(*aggregates).filter(some_gap)


def _rows_of_gappy_groups(df: DataFrame, by: list[str], targets: list[str]) -> DataFrame:
    """Rows that hold a target value, of groups in which some row misses one.

    Groups meet by a hash of their key: two groups with one hash only let unneeded rows through.
    Since the join is not on the key itself, the aggregation after it keeps its own shuffle with a
    map-side part, so the join may split a partition that one large group fills.
    """
    group = F.xxhash64(*by).alias("__group")
    keyed = df.filter(_none_null(by))
    gappy = keyed.filter(_any_null(targets)).select(group).distinct()
    holding = reduce(or_, [F.col(name).isNotNull() for name in targets])
    rows = keyed.filter(holding).select(*by, *targets, group)
    return splittable_join(rows, gappy, ["__group"], "left_semi").drop("__group")


def _sketched_medians(
    rows: DataFrame, by: list[str], fills: Sequence[Fill], accuracy: int
) -> DataFrame:
    """Medians per group; sketches are merged map-side and bounded in size."""
    medians = [
        F.percentile_approx(_measure(fill), 0.5, accuracy).alias(fill.found) for fill in fills
    ]
    return rows.groupBy(*by).agg(*medians)


def _exact_medians(
    df: DataFrame, by: list[str], fills: Sequence[Fill], targets: list[str], rare_gaps: bool
) -> DataFrame:
    """Medians per group; the groups' sizes tell which of them are too large for one task.

    With ``rare_gaps`` the same sizes tell which groups miss something; only their rows are taken.
    Groups meet by a hash of their key there: two groups with one hash only let unneeded rows through.
    """
    names = [fill.found for fill in fills]
    keyed = df.filter(_none_null(by))
    measured = keyed.select(*by, *[_measure(fill).alias(fill.found) for fill in fills])
    held = F.greatest(*[F.count(name) for name in names]) if len(names) > 1 else F.count(names[0])
    if not rare_gaps:
        sizes = measured.groupBy(*by).agg(held.alias("__held"))
        return group_medians(measured, by, names, large_groups(sizes, by, "__held"))
    flagged = keyed.select(
        *by, *[_measure(fill).alias(fill.found) for fill in fills], _any_null(targets).alias("__gap")
    )
    sizes = flagged.groupBy(*by).agg(held.alias("__held"), F.count_if("__gap").alias("__gaps"))
    gappy = stage(sizes.filter((F.col("__gaps") > 0) & (F.col("__held") > 0)), "gappy_groups")
    group = F.xxhash64(*by).alias("__group")
    holding = reduce(or_, [F.col(name).isNotNull() for name in names])
    rows = measured.filter(holding).select("*", group)
    rows = splittable_join(rows, gappy.select(group).distinct(), ["__group"], "left_semi").drop("__group")
    return group_medians(rows, by, names, large_groups(gappy, by, "__held"))


def _measure(fill: Fill) -> Column:
    return F.col(fill.column) if fill.measure is None else fill.measure


def _fill_global_modes(
    df: DataFrame, counts: DataFrame, lookup: DataFrame, by: list[str], fills: Sequence[Fill]
) -> DataFrame:
    """Fill what is left with each column's most frequent value after the group filling.

    Those frequencies follow from the group counts (values present, plus each group's gaps counted
    for the group's mode), so the filled rows are not read again. The result is one row.
    """
    names = [fill.column for fill in fills]
    about_one = [(F.col(f"__rolled_{name}") == 0) & F.col(name).isNotNull() for name in names]
    present = counts.filter(reduce(or_, about_one)).select(
        *names, *[F.col(f"__rolled_{name}").cast("int") for name in names], "__n"
    )
    gains = []
    for fill in fills:
        mine = [F.col(fill.found) if n == fill.column else F.lit(None) for n in names]
        values = [value.cast(df.schema[n].dataType).alias(n) for n, value in zip(names, mine)]
        rolled = [F.lit(int(n != fill.column)).alias(f"__rolled_{n}") for n in names]
        gains.append(F.struct(*values, *rolled, F.col(f"__gaps_{fill.column}").alias("__n")))
    gained = lookup.select(F.inline(F.array(*gains)))
    frequency = (
        present.unionByName(gained)
        .groupBy(*names, *[f"__rolled_{name}" for name in names])
        .agg(F.sum("__n").alias("__n"))
    )
    one_row = frequency.agg(
        *[
            _most_frequent(name, about).alias(f"__global_{name}")
            for name, about in zip(names, about_one)
        ]
    )
    defaults = {name: F.col(f"__global_{name}") for name in names}
    completed = impute_default(df.crossJoin(F.broadcast(one_row)), defaults)
    return completed.select(*df.columns)
