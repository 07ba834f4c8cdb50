"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__
from helpers import plan
from verification.compare import difference, open_tables
from verification.oracles import ORACLES
from verification.queries import QUERIES, _made_once

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return open_tables(SF)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert ORACLES.keys() <= __spark_entry__.oracle_sql().keys()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert difference(spark, connection, name, SF) is None


def test_the_fact_makes_its_raw_tables_once(spark):
    for made in _made_once(spark, SF):
        scan = plan(made)
        assert "FileScan" in scan and "Join" not in scan and "Aggregate" not in scan
