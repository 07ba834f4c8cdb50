"""Physical plans: what must not appear on tables that grow, and what must reach the scan."""

from __future__ import annotations

import re

import pytest

from filingstrata.plans import gold, silver
from filingstrata.sources.tables import Lake
from helpers import plan
from verification.adapters import num_raw, pre_raw, sub_raw, tag_raw

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("stored")))
    inputs = {"sub": sub_raw, "num": num_raw, "pre": pre_raw, "tag": tag_raw}
    for name, build in inputs.items():
        lake.write(build(spark, SF), "bronze", name)
    # Plans as for large tables: no side is small enough to be broadcast by its size.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {name: lake.read("bronze", name) for name in inputs}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


@pytest.fixture(scope="module")
def plans(stored):
    sub, num = silver.silver_submissions(stored["sub"]), silver.silver_numbers(stored["num"], stored["sub"])
    pre, tags = silver.silver_presentations(stored["pre"]), silver.silver_tags(stored["tag"])
    fact = gold.build_fact(num, sub, tags, gold.dim_date(num), pre, gold.dim_pre(pre), gold.dim_company(sub))
    frames = {"sub": sub, "num": num, "pre": pre, "tags": tags, "fact": fact}
    return {name: plan(df) for name, df in frames.items()}


@pytest.mark.parametrize("name", ["sub", "num", "pre", "tags", "fact"])
def test_no_python_and_no_cartesian_product(plans, name):
    assert "Python" not in plans[name] and "CartesianProduct" not in plans[name]


@pytest.mark.parametrize("name", ["num", "pre"])
def test_nothing_in_one_partition(plans, name):
    assert "SinglePartition" not in plans[name]


def test_single_partitions_hold_summaries_only(plans):
    # Submissions: one partial result per task of the overall modes. Tags: one row per slice.
    assert plans["sub"].count("SinglePartition") == 1
    for name in ("sub", "tags", "fact"):
        for below in re.findall(r"Exchange SinglePartition.*\n(.*)", plans[name]):
            assert "partial_min_by" in below or "__weight" in below or "HashAggregate(keys=[__slice" in below or (
                # distinct calendar days
                "HashAggregate(keys=[ddate" in below
            ), below


def test_rows_without_gaps_are_not_shuffled(plans):
    untouched = plans["pre"].split("Union")[1].split("+- Project")[0]
    assert "Exchange" not in untouched and "FileScan" in untouched


def test_numbers_meet_their_companies_once(spark, stored):
    """The join is staged; medians, gaps and the rest read it without another shuffle by filing."""
    text = plan(silver.silver_numbers(stored["num"], stored["sub"]))
    assert "hashpartitioning(adsh" not in text
    assert "bronze/sub" not in text


def test_filters_and_columns_reach_the_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(value\)", plans["num"])
    lookup = [line for line in plans["pre"].splitlines() if "ReadSchema" in line][-1]
    assert re.search(r"ReadSchema: struct<stmt:string,tag:string>", lookup)


def test_one_join_fills_all_submission_columns(stored):
    text = plan(silver.impute_submissions(stored["sub"]))
    assert text.count("LeftOuter") == 1


def test_numbers_shuffled_once_for_the_fact(spark, stored, tmp_path_factory):
    """On stored tables the values move once, to meet the keys gathered on the presentation side."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("silver")))
    cleaned = {
        "numbers": silver.silver_numbers(stored["num"], stored["sub"], 1997, 2000),
        "submissions": silver.silver_submissions(stored["sub"]),
        "presentations": silver.silver_presentations(stored["pre"]),
        "tags": silver.silver_tags(stored["tag"]),
    }
    for name, df in cleaned.items():
        lake.write(df, "silver", name)
    num, sub, pre, tags = (lake.read("silver", name) for name in cleaned)
    fact = gold.build_fact(
        num, sub, tags, gold.dim_date(num), pre, gold.dim_pre(pre), gold.dim_company(sub)
    )
    lines = plan(fact).splitlines()
    (scan,) = [i for i, line in enumerate(lines) if "FileScan" in line and "value#" in line]
    shuffles = [line for line in _ancestors(lines, scan) if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "hashpartitioning(adsh" in shuffles[0]


def _ancestors(lines: list[str], at: int) -> list[str]:
    """The operators above one line of a plan tree."""

    def depth(line: str) -> int:
        return re.search(r"[A-Za-z*(]", line).start()

    found, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if line.strip(" :+-|") and depth(line) < level:
            found.append(line)
            level = depth(line)
    return found
