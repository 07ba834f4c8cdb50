"""The run over all layers, and gold tables from one set of inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from filingstrata.plans import gold, silver
from filingstrata.schemas import INPUTS
from filingstrata.sources.bronze import ingest_all, stored_schema
from filingstrata.sources.staging import staging_scope
from filingstrata.sources.tables import Lake


def refine(
    lake: Lake,
    min_year: int = silver.FIRST_YEAR,
    max_year: int | None = None,
    dedup: bool = True,
    sketch: int | None = None,
) -> None:
    """Bronze to silver, over all stored quarters. Each table is written once and read back by the next step.

    Modes and medians are those of all quarters, so a new quarter may fill gaps of an old one anew.
    ``dedup`` as in ``clean_tags``; ``sketch`` as in ``fill_from_groups``.
    """
    bronze = {
        stem: lake.read("bronze", table, schema=stored_schema(stem))
        for stem, (_, table) in INPUTS.items()
    }
    plans = {
        "submissions": lambda: silver.silver_submissions(bronze["sub"], sketch),
        "numbers": lambda: silver.silver_numbers(bronze["num"], bronze["sub"], min_year, max_year, sketch),
        "presentations": lambda: silver.silver_presentations(bronze["pre"]),
        "tags": lambda: silver.silver_tags(bronze["tag"], dedup),
    }
    for table, plan in plans.items():
        with staging_scope(lake.spark):
            lake.write(plan(), "silver", table)


def publish(
    lake: Lake,
    keep: Sequence[str] = (),
    company_join: str = "attributes",
    normalize_version: bool = True,
    dedup: bool = True,
) -> None:
    """Silver to gold: dimensions first, then the fact from the written dimensions.

    ``dedup`` as in ``dim_company``; the other options as in ``build_fact``.
    """
    submissions, numbers = lake.read("silver", "submissions"), lake.read("silver", "numbers")
    presentations, tags = lake.read("silver", "presentations"), lake.read("silver", "tags")
    dimensions = {
        "dim_tag": lambda: gold.dim_tag(tags),
        "dim_submission": lambda: gold.dim_submission(submissions),
        "dim_company": lambda: gold.dim_company(submissions, dedup),
        "dim_date": lambda: gold.dim_date(numbers),
        "dim_pre": lambda: gold.dim_pre(presentations),
    }
    for table, plan in dimensions.items():
        with staging_scope(lake.spark):
            lake.write(plan(), "gold", table)
    fact: DataFrame = gold.build_fact(
        numbers,
        submissions,
        tags,
        lake.read("gold", "dim_date"),
        presentations,
        lake.read("gold", "dim_pre"),
        lake.read("gold", "dim_company"),
        company_join=company_join,
        normalize_version=normalize_version,
        keep=keep,
    )
    lake.write(fact, "gold", "fact_financial")


TABLES = {
    "silver": ("submissions", "numbers", "presentations", "tags"),
    "gold": ("dim_tag", "dim_submission", "dim_company", "dim_date", "dim_pre", "fact_financial"),
}


def run(
    lake: Lake,
    raw_root: str,
    quarters: Sequence[tuple[int, int]] | None = None,
    min_year: int = silver.FIRST_YEAR,
    max_year: int | None = None,
    pattern: str = "*/{stem}.parquet",
    add_missing: bool = False,
    dedup_tags: bool = True,
    sketch: int | None = None,
    keep: Sequence[str] = (),
    company_join: str = "attributes",
    normalize_version: bool = True,
    dedup_companies: bool = True,
    register: bool = False,
) -> None:
    """Raw quarter folders to bronze, silver and gold. Running it again gives the same tables.

    ``quarters`` names the folders to ingest; quarters stored before stay, and silver and gold are made
    of all of them. ``register`` makes every silver and gold table readable by name.
    """
    ingest_all(lake, raw_root, quarters=quarters, pattern=pattern, add_missing=add_missing)
    refine(lake, min_year, max_year, dedup_tags, sketch)
    publish(lake, keep, company_join, normalize_version, dedup_companies)
    if register:
        for layer, tables in TABLES.items():
            for table in tables:
                lake.register(layer, table)
