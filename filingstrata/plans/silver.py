"""Bronze to silver: imputation and cleaning of the four inputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingstrata import schemas
from filingstrata.functions.dates import repaired_date, ymd_to_date
from filingstrata.functions.text import digits_only, title_from_camel
from filingstrata.operators.impute import (
    Fill,
    fill_from_groups,
    impute_default,
    impute_median,
    impute_mode,
)
from filingstrata.operators.ranks import dense_key
from filingstrata.sources.staging import stage

# Imputation fallbacks and cleaning limits.
DEFAULT_FYE = "1231"
DEFAULT_FP = "FY"
UNCLASSIFIABLE = "UN"
FIRST_YEAR = 2009
QTRS_BELOW = 5


def _padded(width: int):
    """The number with leading zeros; NULL where it does not fit into so many digits."""
    fits = lambda number: number.between(0, 10**width - 1)
    return lambda number: F.when(fits(number), F.lpad(number.cast("string"), width, "0"))


def _all_present(names: list[str]) -> Column:
    # Separate null tests, unlike dropna, are pushed down to the scan.
    return reduce(and_, [F.col(name).isNotNull() for name in names])


def _number(name: str) -> Column:
    return F.col(name).try_cast("int")


def category_fills() -> list[Fill]:
    return [Fill("sic", "mode", global_mode=True), Fill("countryba", "mode", global_mode=True)]


def date_fills() -> list[Fill]:
    """fy and fp by mode, period and fye by median.

    period (YYYYMMDD) and fye (MMDD) are text: the median is taken of the number and written back
    with its leading zeros, so the result is always a value that occurs.
    """
    return [
        Fill("fy", "mode"),
        Fill("fp", "mode"),
        Fill("period", "median", measure=_number("period"), render=_padded(8)),
        Fill("fye", "median", measure=_number("fye"), render=_padded(4)),
    ]


def impute_sub_categories(sub: DataFrame) -> DataFrame:
    """sic and countryba: the company's mode, then the most frequent value overall."""
    return fill_from_groups(sub, ["cik"], category_fills())


def impute_sub_dates(sub: DataFrame, sketch: int | None = None) -> DataFrame:
    """fy and fp by the company's mode, period and fye by its median, then the defaults."""
    return date_defaults(fill_from_groups(sub, ["cik"], date_fills(), sketch))


def impute_submissions(sub: DataFrame, sketch: int | None = None) -> DataFrame:
    """Both submission imputations with one lookup and one join; the columns do not interact."""
    fills = category_fills() + date_fills()
    return date_defaults(fill_from_groups(sub, ["cik"], fills, sketch))


def date_defaults(sub: DataFrame) -> DataFrame:
    # Order matters: the default period is built from the completed fy and fye.
    defaults = {
        "fye": F.lit(DEFAULT_FYE),
        "fy": F.year(ymd_to_date(F.col("filed"))),
        "period": _padded(8)(F.col("fy").cast("long") * 10000 + _number("fye")),
        "fp": F.lit(DEFAULT_FP),
    }
    return impute_default(sub, defaults)


def clean_submissions(sub: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Require the keys, parse dates, strip phone numbers, trim text, add the filing delay.

    ``keep`` names further columns for the end of the row, here and in the other cleaning steps.
    """
    required = ["adsh", "cik", "name", "sic"]
    trimmed = ["name", "countryba", "stprba", "cityba", "zipba", "form", "instance"]
    period, filed = ymd_to_date(F.col("period")), ymd_to_date(F.col("filed"))
    cleaned = {
        **{name: F.trim(name) for name in trimmed},
        "baph": digits_only(F.col("baph")),
        "period": period,
        "filed": filed,
        "delay_days": F.date_diff(filed, period),
    }
    return sub.filter(_all_present(required)).select(
        *[cleaned.get(name, F.col(name)).alias(name) for name in schemas.SUBMISSIONS], *keep
    )


def impute_num_values(
    num: DataFrame, sub: DataFrame, sketch: int | None = None
) -> DataFrame:
    """Fill value with the median of its (company, tag, unit) and add ``is_value_incomplete``.

    The flag is true for rows whose group has no value at all and for rows without a complete group
    key, that is without a company or a unit.

    The numbers meet their companies once, and the joined rows are staged while the plan is built:
    gaps, untouched rows and medians are filtered scans of them. Rows without tag or unit have no group
    and stay out of the join.
    """
    grouped = F.col("tag").isNotNull() & F.col("uom").isNotNull()
    owners = sub.select("adsh", "cik")
    with_company = num.filter(grouped).join(owners, "adsh", "left").select(*num.columns, "cik")
    filled = impute_median(
        stage(with_company, "numbers"),
        ["value"],
        ["cik", "tag", "uom"],
        sketch,
        flag="is_value_incomplete",
        rare_gaps=True,
    )
    return filled.drop("cik").unionByName(
        num.filter(~grouped).withColumn("is_value_incomplete", F.lit(True))
    )


def clean_numbers(
    num: DataFrame, min_year: int = FIRST_YEAR, max_year: int | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Require value and keys, repair dates by the partition year, keep durations below five quarters.

    ``max_year`` is the last plausible year of ddate; the current year when not given.
    """
    latest = F.lit(max_year) if max_year is not None else F.year(F.current_date())
    cleaned = {
        "ddate": repaired_date(F.col("ddate"), F.col("year"), min_year, latest),
        "version": F.upper("version"),
    }
    required = ["value", "adsh", "tag", "version"]
    kept = num.filter(_all_present(required) & (F.col("qtrs") < QTRS_BELOW))
    return kept.select(*[cleaned.get(name, F.col(name)).alias(name) for name in schemas.NUMBERS], *keep)


def impute_pre_statements(pre: DataFrame) -> DataFrame:
    """stmt by the tag's mode, then 'UN'."""
    return impute_mode(pre, ["stmt"], ["tag"], fallback=F.lit(UNCLASSIFIABLE))


def impute_pre_labels(pre: DataFrame) -> DataFrame:
    """Missing labels from the tag's name."""
    return impute_default(pre, {"plabel": title_from_camel(F.col("tag"))})


def clean_presentations(pre: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Require stmt, trim text."""
    trimmed = {"adsh", "stmt", "tag", "version", "plabel"}
    return pre.filter(F.col("stmt").isNotNull()).select(
        *[
            F.trim(name).alias(name) if name in trimmed else F.col(name)
            for name in schemas.PRESENTATIONS
        ],
        *keep,
    )


def tag_definitions(tag: DataFrame, dedup: bool = True) -> DataFrame:
    """Definitions with upper-case versions; with ``dedup`` the latest one of each (tag, version)."""
    described = [field.name for field in schemas.TAG_SCHEMA.fields]
    versioned = tag.filter(F.col("version").isNotNull()).withColumn("version", F.upper("version"))
    if not dedup:
        return versioned.select(*described)
    attributes = [name for name in described if name not in ("tag", "version")]
    latest = F.max(F.struct("year", "quarter", *attributes)).alias("latest")
    found = versioned.groupBy("tag", "version").agg(latest)
    return found.select("tag", "version", *[F.col(f"latest.{name}") for name in attributes]).select(*described)


def clean_tags(tag: DataFrame, dedup: bool = True) -> DataFrame:
    """Upper-case versions, number the definitions by (tag, version), then drop abstract ones.

    Numbers are given before the abstract rows go, so they have gaps. ``dedup`` keeps the latest
    definition of each (tag, version); without it every quarter's copy stays and is numbered.
    """
    definitions = tag_definitions(tag, dedup)
    numbered = dense_key(definitions, "tag_id", order_by=["tag", "version"], unique=dedup)
    return numbered.filter(~F.col("abstract")).select(*schemas.TAGS)


def silver_submissions(sub: DataFrame, sketch: int | None = None) -> DataFrame:
    return clean_submissions(impute_submissions(sub, sketch))


def silver_numbers(
    num: DataFrame,
    sub: DataFrame,
    min_year: int = FIRST_YEAR,
    max_year: int | None = None,
    sketch: int | None = None,
) -> DataFrame:
    return clean_numbers(impute_num_values(num, sub, sketch), min_year, max_year)


def silver_presentations(pre: DataFrame) -> DataFrame:
    return clean_presentations(impute_pre_labels(impute_pre_statements(pre)))


def silver_tags(tag: DataFrame, dedup: bool = True) -> DataFrame:
    return clean_tags(tag, dedup)
