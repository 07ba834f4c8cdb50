"""Declared input schemas and the column order of every output table."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _schema(**columns: str) -> StructType:
    """A schema of nullable columns; needs no session, unlike a DDL string."""
    schema = StructType()
    for name, type_name in columns.items():
        schema = schema.add(name, type_name)
    return schema


# Column names and types of the four quarterly inputs.
SUB_SCHEMA = _schema(
    adsh="string", cik="long", name="string", sic="integer",
    countryba="string", stprba="string", cityba="string", zipba="string",
    bas1="string", bas2="string", baph="string",
    countryma="string", stprma="string", cityma="string", zipma="string",
    mas1="string", mas2="string", countryinc="string", stprinc="string",
    ein="string", former="string", changed="date", afs="string", wksi="boolean",
    fye="string", form="string", period="string", fy="integer", fp="string", filed="string",
    accepted="timestamp", prevrpt="boolean", detail="boolean", instance="string",
    nciks="integer", aciks="string",
)
TAG_SCHEMA = _schema(
    tag="string", version="string", custom="integer", abstract="boolean", datatype="string",
    iord="string", crdr="string", tlabel="string", doc="string",
)
NUM_SCHEMA = _schema(
    adsh="string", tag="string", version="string", ddate="string", qtrs="integer", uom="string",
    coreg="string", value="decimal(28,4)", footnote="string",
)
PRE_SCHEMA = _schema(
    adsh="string", report="integer", line="integer", stmt="string", inpth="boolean",
    rfile="string", tag="string", version="string", plabel="string",
)

# Input file stem, declared schema and bronze table name.
INPUTS: dict[str, tuple[StructType, str]] = {
    "sub": (SUB_SCHEMA, "submissions"),
    "num": (NUM_SCHEMA, "numbers"),
    "tag": (TAG_SCHEMA, "tags"),
    "pre": (PRE_SCHEMA, "presentations"),
}

# Output column order.
SUBMISSIONS = [
    "adsh", "cik", "name", "sic", "countryba", "stprba", "cityba", "zipba", "baph", "fye", "form",
    "period", "fy", "fp", "filed", "delay_days", "accepted", "instance",
]
NUMBERS = ["adsh", "tag", "version", "ddate", "qtrs", "uom", "value", "is_value_incomplete"]
PRESENTATIONS = ["adsh", "report", "line", "stmt", "tag", "version", "plabel"]
TAGS = ["tag_id", "tag", "version", "datatype", "iord", "tlabel", "doc"]
DIM_SUBMISSION = ["adsh", "form", "period", "filed", "delay_days", "accepted", "instance"]
COMPANY_ATTRIBUTES = [
    "cik", "name", "sic", "countryba", "stprba", "cityba", "zipba", "baph", "fye", "form", "fy", "fp",
]
PRE_ATTRIBUTES = ["stmt", "report", "line", "plabel"]
DIM_DATE = ["id", "ddate", "year", "quarter", "month", "day"]
FACT = [
    "adsh", "tag", "version", "ddate", "value", "cik",
    "dim_company_id", "dim_date_id", "dim_tag_id", "dim_pre_id",
]
