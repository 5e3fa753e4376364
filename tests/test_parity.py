"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tests.parity import compare, duck
from tidemark.plans import catalogue

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    ok, text = compare(spark, con, name, SF)
    assert ok, text


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "indicator_id",
        "geo_code",
        "period",
        "period_start",
        "value",
        "mom_pct_change",
        "yoy_pct_change",
    ]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(catalogue.ENTRIES) <= set(entry.oracle_sql()) <= set(entry.queries())
