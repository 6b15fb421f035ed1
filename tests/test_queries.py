"""A few registered queries against their SQL; tests/compare.py runs all of them."""

import pytest

import __spark_entry__ as entry
from compare import check, connect

SF = "/root/testdata/sf0.01"
SAMPLE = ["c6_season", "v3_duplicate_flag", "v6_impute_series", "v7_correct_outliers", "ft3_version_asof", "ft8_contract_flags",
          "w6_turnover_rent", "w10_web_channel_conversion", "q3_foreign_key", "a12_peer_gap"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_sql(spark, con, name):
    ok, note = check(spark, con, name, SF)
    assert ok, note


def test_every_oracle_has_a_query():
    """Every SQL names a registered query, whether or not the corpus subpackage is present."""
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_warehouse_query_has_sql():
    """Outside the corpus subpackage every query has its SQL; corpus queries without SQL are tested against brute force."""
    from plazaflow.plans.catalog import ORACLE, QUERIES

    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
