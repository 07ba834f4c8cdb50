"""One query per operator; each reads the whole tables of the given folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingstrata import schemas
from filingstrata.functions.dates import is_quarter_end, ymd_to_date
from filingstrata.functions.text import numeric_text
from filingstrata.operators.breakdown import (
    category_share,
    frequency,
    null_breakdown,
    numeric_summary,
    top_values,
    usage_share,
)
from filingstrata.operators.checks import check_not_null
from filingstrata.operators.impute import Fill
from filingstrata.operators.profile import profile, profile_flags
from filingstrata.operators.sketches import merged_state, profile_of_state, profile_state
from filingstrata.operators.statistics import filled, group_statistics, merged_counts, value_counts
from filingstrata.plans import gold, incremental, layers, silver
from filingstrata.sources.bronze import conform, ingest, ingest_checked, read_bronze, with_year_quarter
from filingstrata.sources.buckets import write_bucketed, write_for_lookup
from filingstrata.sources.staging import new_folder, stage
from filingstrata.sources.tables import Lake
from filingstrata.sources.text import read_tsv, write_tsv
from verification.adapters import (
    num_raw,
    num_text,
    pre_raw,
    sub_raw,
    table,
    tag_history,
    tag_raw,
)

Query = Callable[[SparkSession, str], DataFrame]

# The plausible years of the test tables: years outside take the partition's year.
YEARS = {"min_year": 1997, "max_year": 2000}


def _silver_sub(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_submissions(sub_raw(spark, sf))


def _silver_num(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_numbers(num_raw(spark, sf), sub_raw(spark, sf), **YEARS)


def _silver_pre(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_presentations(pre_raw(spark, sf))


def _silver_tag(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_tags(tag_raw(spark, sf))


# ---- ingest -------------------------------------------------------------------------------------


def conform_numbers(spark: SparkSession, sf: str) -> DataFrame:
    conformed = conform(num_text(spark, sf), schemas.NUM_SCHEMA, add_missing=True)
    return conformed.withColumn("ddate_parsed", ymd_to_date(F.col("ddate")))


def path_year_quarter(spark: SparkSession, sf: str) -> DataFrame:
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    year, quarter = F.year(day).cast("string"), F.quarter(day).cast("string")
    path = (
        F.when(key % 9 == 0, F.concat(F.lit("/lake/"), year, F.lit("/num.parquet")))
        .when(key % 9 == 1, F.concat(F.lit("/lake/"), year, F.lit("-01q"), quarter, F.lit("/num.parquet")))
        .when(key % 9 == 2, F.concat(F.lit("/lake/FS_"), year, F.lit("_Q"), quarter, F.lit("/num.parquet")))
        .when(key % 9 == 3, F.concat(F.lit("/lake/"), year, F.lit("q7/num.parquet")))
        .otherwise(F.concat(F.lit("/lake/"), year, F.lit("q"), quarter, F.lit("/num.parquet")))
    )
    paths = table(spark, sf, "orders").select("o_orderkey", path.alias("path"))
    return with_year_quarter(paths, "path")


def bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Raw quarter folders written from the submissions, ingested twice, read back."""
    raw, lake = new_folder(spark, "raw"), Lake(spark, new_folder(spark, "lake"))
    submissions = sub_raw(spark, sf)
    folder = F.concat("year", F.lit("q"), "quarter")
    (
        submissions.withColumn("folder", folder)
        .drop("year", "quarter")
        .write.partitionBy("folder")
        .parquet(raw)
    )
    for _ in range(2):
        ingest(lake, raw, "sub", pattern="folder=*", add_missing=True)
    return lake.read("bronze", "submissions").select(*submissions.columns)


def _in_folders(rows: DataFrame, path: str) -> None:
    """Raw quarter folders of rows that name their year and quarter."""
    named = rows.withColumn("folder", F.concat("year", F.lit("q"), "quarter"))
    named.drop("year", "quarter").write.mode("append").partitionBy("folder").parquet(path)


def load_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, NULLs and lost values of each declared column, counted by the load itself."""
    raw = new_folder(spark, "raw")
    _in_folders(num_text(spark, sf), raw)
    return ingest_checked(Lake(spark, new_folder(spark, "lake")), raw, "num", pattern="folder=*", add_missing=True)


def quarantined_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """What the casts of a load lost, with the values as they came."""
    raw, lake = new_folder(spark, "raw"), Lake(spark, new_folder(spark, "lake"))
    _in_folders(num_text(spark, sf), raw)
    ingest_checked(lake, raw, "num", pattern="folder=*", add_missing=True)
    held = lake.read("quarantine", "numbers")
    return held.select("adsh", "tag", "version", "year", "quarter", F.explode("rescued").alias("lost")).select(
        "adsh", "tag", "version", "year", "quarter", "lost.column", "lost.value"
    )


def types_over_quarters(spark: SparkSession, sf: str) -> DataFrame:
    """An undeclared column that is int in the quarters of 1999, long in those of 2000 and absent in 2001."""
    raw, lake = new_folder(spark, "raw"), Lake(spark, new_folder(spark, "lake"))
    numbers, number = num_raw(spark, sf), F.col("adsh").cast("long")
    for year, kind in ((1999, "int"), (2000, "long"), (2001, None)):
        rows = numbers.filter(F.col("year") == year)
        _in_folders(rows.withColumn("filing", number.cast(kind)) if kind else rows, raw)
    for years in ((1999,), (2000, 2001)):
        quarters = [(year, quarter) for year in years for quarter in (1, 2, 3, 4)]
        ingest(lake, raw, "num", pattern="folder=*", add_missing=True, quarters=quarters)
    return read_bronze(lake, "num").select("adsh", "tag", "value", "year", "quarter", "filing")


# ---- silver -------------------------------------------------------------------------------------


def sub_mode_impute(spark: SparkSession, sf: str) -> DataFrame:
    return silver.impute_sub_categories(sub_raw(spark, sf)).select("adsh", "cik", "sic", "countryba")


def sub_date_impute(spark: SparkSession, sf: str) -> DataFrame:
    filled = silver.impute_sub_dates(sub_raw(spark, sf))
    return filled.select("adsh", "cik", "fye", "period", "fy", "fp", "filed")


def sub_clean(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_submissions(sub_raw(spark, sf))


def num_median_impute(spark: SparkSession, sf: str) -> DataFrame:
    return silver.impute_num_values(num_raw(spark, sf), sub_raw(spark, sf))


def num_median_impute_exact(spark: SparkSession, sf: str) -> DataFrame:
    """The same from counted values, as updates by quarter keep them."""
    numbers, by, fills = num_raw(spark, sf), ["cik", "tag", "uom"], [Fill("value", "median")]
    owned = numbers.join(sub_raw(spark, sf).select("adsh", "cik"), "adsh", "left").select(*numbers.columns, "cik")
    counted = merged_counts(value_counts(owned, by, fills, ["year", "quarter"]), by, fills)
    done = filled(owned, group_statistics(counted, by, fills), by, fills)
    return done.select(*numbers.columns, F.col(fills[0].found).isNull().alias("is_value_incomplete"))


def num_median_large_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Two companies, one tag and one unit: groups of thousands of values."""
    unit = F.when(F.col("uom").isNotNull(), F.lit("all"))
    numbers = num_raw(spark, sf).withColumns({"tag": F.lit("all"), "uom": unit})
    return silver.impute_num_values(numbers, sub_raw(spark, sf).withColumn("cik", F.col("cik") % 2))


def num_clean(spark: SparkSession, sf: str) -> DataFrame:
    unflagged = num_raw(spark, sf).withColumn("is_value_incomplete", F.col("uom").isNull())
    return silver.clean_numbers(unflagged, **YEARS)


def pre_stmt_impute(spark: SparkSession, sf: str) -> DataFrame:
    return silver.impute_pre_statements(pre_raw(spark, sf))


def pre_label_impute(spark: SparkSession, sf: str) -> DataFrame:
    return silver.impute_pre_labels(pre_raw(spark, sf))


def pre_clean(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_presentations(pre_raw(spark, sf))


def tag_clean(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_tags(tag_history(spark, sf))


def tag_clean_all_quarters(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_tags(tag_history(spark, sf), dedup=False)


def impute_residuals(spark: SparkSession, sf: str) -> DataFrame:
    submissions = silver.impute_submissions(sub_raw(spark, sf))
    presentations = silver.impute_pre_labels(silver.impute_pre_statements(pre_raw(spark, sf)))
    left = check_not_null(submissions, ["sic", "countryba", "fye", "fy", "period", "fp"])
    right = check_not_null(presentations, ["stmt", "plabel"])
    return left.unionByName(right)


# ---- gold ---------------------------------------------------------------------------------------


def dim_tag(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_tag(_silver_tag(spark, sf))


def dim_submission(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_submission(_silver_sub(spark, sf))


def dim_company(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_company(_silver_sub(spark, sf))


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_date(_silver_num(spark, sf))


def dim_pre(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_pre(_silver_pre(spark, sf))


def _made_once(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Raw submissions and presentations, joined and grouped from the test tables once for all that scans them."""
    return stage(sub_raw(spark, sf), "sub"), stage(pre_raw(spark, sf), "pre")


def _fact(spark: SparkSession, sf: str, **options) -> DataFrame:
    # As between layers of the stored tables: each cleaned input is written once and read back.
    lake = Lake(spark, new_folder(spark, "lake"))
    sub_made, pre_made = _made_once(spark, sf)
    cleaned = {
        "submissions": silver.silver_submissions(sub_made),
        "numbers": silver.silver_numbers(num_raw(spark, sf), sub_made, **YEARS),
        "presentations": silver.silver_presentations(pre_made),
        "tags": _silver_tag(spark, sf),
    }
    for name, rows in cleaned.items():
        lake.write(rows, "silver", name)
    sub, num, pre, tags = (lake.read("silver", name) for name in cleaned)
    return gold.build_fact(
        num, sub, tags, gold.dim_date(num), pre, gold.dim_pre(pre), gold.dim_company(sub), **options
    )


def fact_financial(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf)


def fact_with_units(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf, keep=["uom", "qtrs"])


def fact_from_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The fact of numbers and keys stored in the same buckets."""
    lake = Lake(spark, new_folder(spark, "lake"))
    schema = f"buckets_{lake.root.rsplit('-', 1)[1]}"
    sub_made, pre_made = _made_once(spark, sf)
    cleaned = {
        "plain": silver.silver_numbers(num_raw(spark, sf), sub_made, **YEARS),
        "submissions": silver.silver_submissions(sub_made),
        "presentations": silver.silver_presentations(pre_made),
    }
    for name, rows in cleaned.items():
        lake.write(rows, "silver", name)
    numbers, sub, pre = (lake.read("silver", name) for name in cleaned)
    owned = gold.filing_keys(sub, _silver_tag(spark, sf), pre, gold.dim_pre(pre), gold.dim_company(sub))
    key = ["adsh", "tag", "version"]
    stored = [write_bucketed(lake, df, "silver", name, key, 8, schema) for name, df in (("numbers", numbers), ("filing_keys", owned))]
    bucketed, keys = (spark.table(name) for name in stored)
    return gold.fact_of_keys(bucketed, gold.dim_date(numbers), keys)


def layers_in_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The fact after a run over the first quarters and one over the others; the first stay."""
    raw, lake = new_folder(spark, "raw"), Lake(spark, new_folder(spark, "lake"))
    inputs = {"sub": sub_raw, "num": num_raw, "tag": tag_raw, "pre": pre_raw}
    for stem, rows in inputs.items():
        named = rows(spark, sf).withColumn("folder", F.concat("year", F.lit("q"), "quarter"))
        named.drop("year", "quarter").write.partitionBy("folder").parquet(f"{raw}/stem={stem}")
    every = [(year, quarter) for year in range(1990, 2011) for quarter in (1, 2, 3, 4)]
    options = {"pattern": "stem={stem}/folder=*", "add_missing": True, **YEARS}
    # every input has rows of 2001q1
    for quarters in ([q for q in every if q >= (2001, 1)], [q for q in every if q <= (2001, 1)]):
        layers.run(lake, raw, quarters, **options)
    return lake.read("gold", "fact_financial").select(*schemas.FACT)


def tag_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Tag definitions of 2001q1; every fifth one comes in 2001q2 only, every seventh again and reworded."""
    first = tag_raw(spark, sf).withColumn("quarter", F.when(F.length("tag") % 5 == 0, 2).otherwise(1))
    again = first.filter((F.length("tag") % 7 == 0) & (F.col("quarter") == 1))
    return first.unionByName(again.withColumns({"tlabel": F.lit("again"), "quarter": F.lit(2)}))


def two_updates(spark: SparkSession, sf: str) -> Lake:
    """A lake that first took all quarters but 2001q2, and then that one; filings and all they hold share a quarter."""
    raw, lake = new_folder(spark, "raw"), Lake(spark, new_folder(spark, "lake"))
    filing = F.col("adsh").cast("long")
    by_filing = {"year": (2001 - filing % 3).cast("int"), "quarter": (1 + filing % 2).cast("int")}
    inputs = {
        "sub": sub_raw(spark, sf).withColumns(by_filing),
        "num": num_raw(spark, sf).withColumns(by_filing),
        "pre": pre_raw(spark, sf).withColumns(by_filing),
        "tag": tag_arrivals(spark, sf),
    }
    for stem, rows in inputs.items():
        named = rows.withColumn("folder", F.concat("year", F.lit("q"), "quarter"))
        named.drop("year", "quarter").write.partitionBy("folder").parquet(f"{raw}/stem={stem}")
    every = [(year, quarter) for year in (1999, 2000, 2001) for quarter in (1, 2)]
    options = {"pattern": "stem={stem}/folder=*", "add_missing": True, **YEARS}
    incremental.update(lake, raw, [q for q in every if q != (2001, 2)], **options)
    incremental.update(lake, raw, [(2001, 2)], **options)
    return lake


def numbers_in_two_updates(spark: SparkSession, sf: str) -> DataFrame:
    return two_updates(spark, sf).read("silver", "numbers").select(*schemas.NUMBERS)


def companies_in_two_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Companies with the numbers they were given first; those that came later follow."""
    return two_updates(spark, sf).read("gold", "dim_company")


def fact_in_two_updates(spark: SparkSession, sf: str) -> DataFrame:
    return two_updates(spark, sf).read("gold", "fact_financial").select(*schemas.FACT)


# ---- exploration --------------------------------------------------------------------------------


def _rounded(profiled: DataFrame) -> DataFrame:
    shares = ["null_percentage", "top1_value_percentage"]
    return profiled.withColumns({name: F.round(name, 6) for name in shares})


def profile_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile(num_raw(spark, sf)))


def profile_submissions(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile(sub_raw(spark, sf)))


def profile_tags(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile(tag_raw(spark, sf)))


def profile_presentations(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile(pre_raw(spark, sf)))


def profile_flag_rules(spark: SparkSession, sf: str) -> DataFrame:
    flagged = profile_flags(profile(pre_raw(spark, sf)))
    return flagged.select("cols", "drop_candidate", "dimension_candidate", "dominant_value")


def nulls_by_tag(spark: SparkSession, sf: str) -> DataFrame:
    return null_breakdown(num_raw(spark, sf), "value", "tag")


def nulls_by_tag_ge50(spark: SparkSession, sf: str) -> DataFrame:
    return null_breakdown(num_raw(spark, sf), "value", "tag", min_pct=50)


def nulls_by_uom(spark: SparkSession, sf: str) -> DataFrame:
    return null_breakdown(num_raw(spark, sf), "value", "uom")


def nulls_by_qtrs(spark: SparkSession, sf: str) -> DataFrame:
    return null_breakdown(num_raw(spark, sf), "value", "qtrs")


def _share(df: DataFrame, by: str) -> DataFrame:
    return category_share(df, by).withColumn("percentage", F.round("percentage", 6))


def uom_share(spark: SparkSession, sf: str) -> DataFrame:
    return _share(num_raw(spark, sf), "uom")


def tag_custom_share(spark: SparkSession, sf: str) -> DataFrame:
    return _share(tag_raw(spark, sf), "custom")


def custom_usage(spark: SparkSession, sf: str) -> DataFrame:
    shares = usage_share(num_raw(spark, sf), tag_raw(spark, sf), ["tag", "version"], "custom")
    return shares.withColumn("percentage", F.round("percentage", 6))


def qtrs_freq(spark: SparkSession, sf: str) -> DataFrame:
    return frequency(num_raw(spark, sf), "qtrs")


def datatype_freq(spark: SparkSession, sf: str) -> DataFrame:
    return frequency(tag_raw(spark, sf), "datatype")


def value_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = numeric_summary(num_raw(spark, sf), ["value", "qtrs"])
    return summary.withColumns({name: F.round(name, 3) for name in ("mean", "stddev")})


def filing_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return num_raw(spark, sf).filter(F.col("adsh") == "0000000007")


def filing_lookup_stored(spark: SparkSession, sf: str) -> DataFrame:
    """One filing from a table sorted by filing, with Bloom filters."""
    lake = Lake(spark, new_folder(spark, "lake"))
    write_for_lookup(lake, num_raw(spark, sf), "bronze", "numbers", "adsh", partition_by=["year", "quarter"])
    return lake.read("bronze", "numbers").filter(F.col("adsh") == "0000000007")


def profile_by_quarter(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of the numbers merged from the stored states of their quarters.

    ``distinct_close`` tells whether the estimate is within 5 % of the exact count.
    """
    lake, quarter = Lake(spark, new_folder(spark, "lake")), ["year", "quarter"]
    lake.write(profile_state(num_raw(spark, sf), quarter), "state", "profile", partition_by=quarter)
    merged = profile_of_state(merged_state(lake.read("state", "profile")))
    exact = profile(num_raw(spark, sf).drop(*quarter)).select("cols", "distinct_count")
    close = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= F.greatest(F.col("distinct_count") * 0.05, F.lit(1))
    few = F.col("cols").isin("uom", "version")
    return merged.join(exact, "cols").select(
        "cols", "data_types", "rows", F.round("null_percentage", 6).alias("null_percentage"), close.alias("distinct_close"),
        F.when(few, F.col("top1_value")).alias("top1_value"), F.when(few, F.col("top1_value_count")).alias("top1_value_count"),
        "low", "high", F.round("mean", 3).alias("mean"), F.round("stddev", 3).alias("stddev"),
    )


def non_monetary_tags(spark: SparkSession, sf: str) -> DataFrame:
    return tag_raw(spark, sf).filter(F.col("datatype") != "ECONOMY")


def distinct_forms(spark: SparkSession, sf: str) -> DataFrame:
    return sub_raw(spark, sf).select("form").distinct()


def top_tags(spark: SparkSession, sf: str) -> DataFrame:
    return top_values(num_raw(spark, sf), "tag", 20)


def uom_filter(spark: SparkSession, sf: str) -> DataFrame:
    return num_raw(spark, sf).filter(F.col("uom") == "R")


def quarter_end_dates(spark: SparkSession, sf: str) -> DataFrame:
    numbers = num_raw(spark, sf).withColumn("ddate", ymd_to_date(F.col("ddate")))
    return numbers.filter(is_quarter_end(F.col("ddate")))


def value_parse(spark: SparkSession, sf: str) -> DataFrame:
    filing, value = F.col("adsh").cast("long"), F.col("value").cast("string")
    text = (
        F.when(filing % 10 == 0, F.lit("NM"))
        .when(filing % 10 == 1, F.concat(F.lit("$ "), value))
        .when(filing % 10 == 2, F.concat(F.lit("USD -"), value))
        .when(filing % 10 == 3, F.lit("—"))
        .otherwise(value)
    )
    texts = num_raw(spark, sf).withColumn("value_text", text)
    return texts.select("adsh", "tag", "value_text", numeric_text(F.col("value_text")).alias("value"))


# ---- table round trips --------------------------------------------------------------------------


def tsv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    numbers, path = num_raw(spark, sf), new_folder(spark, "tsv")
    write_tsv(numbers, path)
    return read_tsv(spark, path, numbers.schema)


def overwrite_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced by one of another schema, read back by name."""
    lake = Lake(spark, new_folder(spark, "lake"))
    lake.write(tag_raw(spark, sf).select("tag", "doc"), "roundtrip_check", "tags")
    lake.write(silver.clean_tags(tag_raw(spark, sf)), "roundtrip_check", "tags")
    return spark.table(lake.register("roundtrip_check", "tags"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        conform_numbers, path_year_quarter, bronze_roundtrip, load_checks, quarantined_numbers, types_over_quarters,
        sub_mode_impute, sub_date_impute, sub_clean,
        num_median_impute, num_median_impute_exact, num_median_large_groups, num_clean,
        pre_stmt_impute, pre_label_impute, pre_clean,
        tag_clean, tag_clean_all_quarters, impute_residuals,
        dim_tag, dim_submission, dim_company, dim_date, dim_pre,
        fact_financial, fact_with_units, fact_from_buckets, layers_in_two_runs,
        numbers_in_two_updates, companies_in_two_updates, fact_in_two_updates,
        profile_numbers, profile_submissions, profile_tags, profile_presentations, profile_flag_rules, profile_by_quarter,
        nulls_by_tag, nulls_by_tag_ge50, nulls_by_uom, nulls_by_qtrs,
        uom_share, tag_custom_share, custom_usage, qtrs_freq, datatype_freq, value_summary,
        filing_lookup, filing_lookup_stored, non_monetary_tags, distinct_forms,
        top_tags, uom_filter, quarter_end_dates, value_parse,
        tsv_roundtrip, overwrite_roundtrip,
    )
}
QUERIES["profile_flags"] = QUERIES.pop("profile_flag_rules")
