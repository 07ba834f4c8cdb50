"""The generated test tables reshaped to the four quarterly inputs.

NULLs, stray blanks and malformed values are put in by arithmetic on the keys, so that the checking
SQL can produce the very same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _filing(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 10, "0")


def _ymd(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def _camel(name: str) -> Column:
    return F.replace(F.initcap(name), F.lit(" "), F.lit(""))


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _divides(number: int, key: str) -> Column:
    return F.col(key) % number == 0


def sub_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filings, customers as companies."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    filings = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    order, owner, day = "o_orderkey", "o_custkey", F.col("o_orderdate")

    def gap(order_step: int, owner_step: int) -> Column:
        return _divides(order_step, order) | _divides(owner_step, owner)

    sic = (F.col("c_nationkey") * 100 + F.col(order) % 2).cast("int")
    year_end = F.when(_divides(3, owner), F.lit("0630")).otherwise(F.lit("1231"))
    filed = F.date_add(day.cast("date"), (F.col(order) % 90).cast("int"))
    return filings.select(
        _filing(order).alias("adsh"),
        F.col("c_custkey").alias("cik"),
        F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("name"),
        _unless(gap(5, 40), sic).alias("sic"),
        _unless(gap(7, 50), F.concat(F.lit(" "), "o_orderpriority")).alias("countryba"),
        F.concat(F.lit(" "), "c_mktsegment").alias("stprba"),
        F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("cityba"),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("zipba"),
        F.concat(
            F.lit("("), F.lpad((F.col(owner) % 1000).cast("string"), 3, "0"), F.lit(") 555-0100")
        ).alias("baph"),
        _unless(gap(13, 60), year_end).alias("fye"),
        F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")).alias("form"),
        _unless(gap(11, 70), _ymd(day)).alias("period"),
        F.when(_divides(401, order), F.lit(300_000)).otherwise(_unless(gap(17, 80), F.year(day))).alias("fy"),
        _unless(gap(19, 90), F.concat(F.lit("Q"), F.quarter(day).cast("string"))).alias("fp"),
        _ymd(filed).alias("filed"),
        day.alias("accepted"),
        F.concat(F.lit(" inst_"), F.col(order).cast("string"), F.lit(" ")).alias("instance"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"])


def num_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as reported values."""
    unreported = (
        ((F.col("l_orderkey") + F.col("l_linenumber")) % 4 == 0)
        | ((F.col("l_partkey") + F.col("l_suppkey")) % 5 == 0)
        | ((F.length("p_name") % 3 == 0) & _divides(2, "l_orderkey"))
    )
    return _items(spark, sf_dir).select(
        _filing("l_orderkey").alias("adsh"),
        _camel("p_name").alias("tag"),
        F.col("p_brand").alias("version"),
        _unless(_divides(101, "l_partkey"), _ymd(F.col("l_shipdate"))).alias("ddate"),
        (F.col("l_linenumber") - 1).cast("int").alias("qtrs"),
        _unless(_divides(23, "l_partkey"), F.col("l_returnflag")).alias("uom"),
        _unless(unreported, F.col("l_extendedprice").cast("decimal(28,4)")).alias("value"),
        (2001 - F.col("l_orderkey") % 3).cast("int").alias("year"),
        (1 + F.col("l_orderkey") % 4).cast("int").alias("quarter"),
    )


def tag_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as tag definitions, one per (tag, version)."""
    first = F.min("p_partkey")
    return (
        table(spark, sf_dir, "part")
        .groupBy("p_name", "p_brand")
        .agg(
            (first % 2).cast("int").alias("custom"),
            (first % 10 == 0).alias("abstract"),
            F.min("p_type").alias("datatype"),
            F.when(F.min("p_size") % 2 == 0, "I").otherwise("D").alias("iord"),
            F.lit("C").alias("crdr"),
            F.min("p_name").alias("tlabel"),
            F.max("p_name").alias("doc"),
        )
        .select(
            _camel("p_name").alias("tag"),
            F.col("p_brand").alias("version"),
            "custom", "abstract", "datatype", "iord", "crdr", "tlabel", "doc",
            F.lit(2001).alias("year"),
            F.lit(1).alias("quarter"),
        )
    )


def tag_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag definitions recurring over three quarters; every third one is reworded in the second."""
    first = tag_raw(spark, sf_dir)
    reworded = F.when(F.length("tag") % 3 == 0, F.concat("tlabel", F.lit(" (new)")))
    second = first.withColumn("tlabel", F.coalesce(reworded, "tlabel")).withColumn(
        "quarter", F.lit(2)
    )
    third = second.filter(F.length("tag") % 2 == 0).withColumn("quarter", F.lit(3))
    return first.unionByName(second).unionByName(third)


def pre_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each (filing, tag, version) is shown."""
    shown = (
        _items(spark, sf_dir)
        .groupBy("l_orderkey", "p_name", "p_brand")
        .agg(
            F.min("l_linenumber").cast("int").alias("report"),
            (F.min("l_suppkey") % 20).cast("int").alias("line"),
            F.min("l_linestatus").alias("status"),
        )
    )
    no_stmt = _divides(6, "l_orderkey") | (F.col("p_name") == "small ring")
    stmt = F.when(F.col("status") == "O", F.lit(" BS ")).otherwise(F.lit("IS"))
    return shown.select(
        _filing("l_orderkey").alias("adsh"),
        "report",
        "line",
        _unless(no_stmt, stmt).alias("stmt"),
        _camel("p_name").alias("tag"),
        F.col("p_brand").alias("version"),
        _unless(_divides(8, "l_orderkey"), F.concat(F.lit(" "), "p_name")).alias("plabel"),
        F.lit(2001).alias("year"),
        F.lit(1).alias("quarter"),
    )


def num_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported values as text, with malformed numbers, durations and dates among them."""
    texts = num_raw(spark, sf_dir).select(
        "adsh", "tag", "version", "ddate", "uom", "year", "quarter",
        F.col("qtrs").cast("string").alias("qtrs"),
        F.col("value").cast("string").alias("value"),
    )
    filing = F.col("adsh").cast("long")
    return texts.select(
        "adsh", "tag", "version",
        F.when(filing % 13 == 0, F.lit("20240231")).otherwise(F.col("ddate")).alias("ddate"),
        F.when(filing % 11 == 0, F.lit("n/a")).otherwise(F.col("qtrs")).alias("qtrs"),
        "uom",
        F.when(filing % 10 == 0, F.lit("x")).otherwise(F.col("value")).alias("value"),
        "year", "quarter",
    )
