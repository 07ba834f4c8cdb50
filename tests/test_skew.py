"""One key with a third of all rows: results stay whole, and large partitions are split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from filingstrata.operators.impute import Fill, fill_from_groups
from filingstrata.operators.ranks import exact_quantiles, sorted_slices
from filingstrata.plans import gold, silver
from helpers import plan

ROWS = 120_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def small_partitions(spark):
    """Thresholds scaled down to the test's size."""
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _key(name: str = "k"):
    return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 9973 + 1).alias(name)


def _tag():
    return F.when(F.col("id") % 3 == 0, F.lit("T0")).otherwise(F.concat(F.lit("T"), F.col("id") % 5))


@pytest.mark.parametrize("rare_gaps", [False, True])
def test_filling_a_hot_group(small_partitions, rare_gaps):
    table = small_partitions.range(0, ROWS, 1, 16).select(
        "id", _key(), F.when(F.col("id") % 5 != 0, F.col("id") % 1001).alias("v")
    )
    filled = fill_from_groups(table, ["k"], [Fill("v", "median")], rare_gaps=rare_gaps)
    found = {row.id: row.v for row in filled.collect()}
    assert len(found) == ROWS
    hot = sorted(i % 1001 for i in range(0, ROWS, 3) if i % 5 != 0)
    assert found[0] == hot[(len(hot) - 1) // 2] and found[0] == found[15]
    assert plan(filled).count("skew=true") >= 1
    # Without staged medians one plan has the join with them and the search for groups that miss something.
    sketched = fill_from_groups(table, ["k"], [Fill("v", "median")], sketch=10_000, rare_gaps=rare_gaps)
    sketched.collect()
    assert plan(sketched).count("skew=true") >= 1 + rare_gaps


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_median_does_not_depend_on_partitions(spark, parts):
    """One group of 100,000 values with a few gaps."""
    values = [i * 7919 % 100_003 for i in range(100_000)]
    table = spark.range(100_000).select(
        "id", F.lit("g").alias("k"), F.when(F.col("id") % 1000 != 0, F.col("id") * 7919 % 100_003).alias("v")
    )
    present = sorted(v for i, v in enumerate(values) if i % 1000)
    filled = fill_from_groups(table.repartition(parts), ["k"], [Fill("v", "median")])
    found = filled.filter("id % 1000 = 0").select("v").distinct().collect()
    assert [row.v for row in found] == [present[(len(present) - 1) // 2]]


def test_statements_of_a_hot_tag(small_partitions):
    """A third of the presentations show one tag: the join with the tags' modes is split."""
    shown = small_partitions.range(0, ROWS, 1, 16).select(
        F.col("id").cast("string").alias("adsh"), _key("t").cast("string").alias("tag"),
        F.when(F.col("id") % 2 == 0, F.lit("BS")).alias("stmt"),
    )
    filled = silver.impute_pre_statements(shown)
    found = filled.collect()
    assert len(found) == ROWS and all(row.stmt == "BS" for row in found if row.tag == "0")
    assert "LeftOuter" in plan(filled) and "skew=true" in plan(filled)


def test_exact_median_of_a_hot_group(small_partitions):
    table = small_partitions.range(0, ROWS, 1, 16).select("id", _key(), (F.col("id") * 7919 % 100_003).alias("v"))
    hot = sorted(i * 7919 % 100_003 for i in range(0, ROWS, 3))
    found = exact_quantiles(table, "v", {"p50": 0.5}, ["k"]).filter("k = 0").first()
    assert found.p50 == hot[(len(hot) - 1) // 2]


def test_slices_of_a_hot_leading_value_are_even(small_partitions):
    table = small_partitions.range(0, ROWS, 1, 16).select(_key(), "id")
    sizes = [row["count"] for row in sorted_slices(table, ["k", "id"], "test").groupBy("__slice").count().collect()]
    assert sum(sizes) == ROWS and max(sizes) < 3 * ROWS / len(sizes)


def test_fact_with_one_filing_holding_a_third(small_partitions):
    spark = small_partitions
    numbers = spark.range(0, ROWS, 1, 16).select(
        F.concat(F.lit("f"), _key().cast("string")).alias("adsh"),
        _tag().alias("tag"), F.lit("V").alias("version"),
        F.make_date(F.lit(2024), F.lit(3), F.lit(31)).alias("ddate"),
        F.col("id").cast("decimal(28,4)").alias("value"),
    )
    filings = numbers.select("adsh").distinct()
    presentations = numbers.select("adsh", "tag").distinct().select(
        "adsh", F.lit(1).alias("report"), F.lit(1).alias("line"), F.lit("BS").alias("stmt"),
        "tag", F.lit("v").alias("version"), F.lit("L").alias("plabel"),
    )
    one = F.lit("x")
    submissions = filings.select(
        "adsh", F.lit(1).cast("long").alias("cik"), F.lit(1).alias("sic"), F.lit(2024).alias("fy"),
        *[one.alias(n) for n in "name countryba stprba cityba zipba baph fye form fp".split()],
    )
    tags = spark.createDataFrame([(i, f"T{i}", "V") for i in range(5)], "tag_id long, tag string, version string")
    fact = gold.build_fact(
        numbers, submissions, tags, gold.dim_date(numbers), presentations,
        gold.dim_pre(presentations), gold.dim_company(submissions),
    )
    counted = fact.groupBy("adsh").count()
    sums = {row.adsh: row["count"] for row in counted.collect()}
    assert sum(sums.values()) == ROWS and sums["f0"] == ROWS // 3
    whole = fact.agg(F.sum("value"), F.count("*"))
    assert [tuple(row) for row in whole.collect()] == [(sum(range(ROWS)), ROWS)]
    assert "skew=true" in plan(whole)
