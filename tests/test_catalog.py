"""Every query with SQL gives the same rows as that SQL; the contract file exposes them all."""

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as contract
from shelfwise.catalog.oracle import ORACLE
from shelfwise.catalog.queries import CATALOG


@pytest.fixture(scope="module")
def sql(folder):
    return oracle_connection(folder)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, sql, name):
    got = CATALOG[name](spark, folder).toPandas()
    assert difference(got, sql.execute(ORACLE[name]).df()) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    rows = contract.entry(spark).collect()
    assert len(rows) == 10
    assert [r["mean"] for r in rows] == sorted((r["mean"] for r in rows), reverse=True)


def test_profile_has_every_section(spark, folder):
    sections = {r["section"] for r in CATALOG["profile_sections"](spark, folder).select("section").distinct().collect()}
    assert {"anova", "insights", "target_by_category", "pivot_item_type_by_outlet_type"} <= sections
