"""Every query equals its SQL on the smallest tables."""

import pytest

import __spark_entry__ as spark_entry
from conftest import rows
from oracle_check import compare, connect

from carelake.workload.oracle import ORACLE
from carelake.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) is None


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(spark_entry.queries())


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0


def test_link_em_finds_the_copies(spark):
    got = {r[0]: r[1:] for r in rows(spark_entry.queries()["link_em"](spark, SF_DIR))}
    # Three of four names and four of five balances survive the copying unchanged.
    assert got["name"][0] == pytest.approx(0.75, abs=0.05)
    assert got["balance"][0] == pytest.approx(0.8, abs=0.05)
