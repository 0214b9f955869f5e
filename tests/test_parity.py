"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
from pluvia.parity import ORACLE, QUERIES

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region", "nation", "supplier", "lineitem", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def _rows(table, columns):
    return sorted((tuple(row[name] for name in columns) for row in table.to_pylist()), key=repr)


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["stations_with_most_rain", "mean_temperature_by_uf", "mean_rain_by_region", "read_years"]
)
def test_time_ranges_reach_the_scan(spark, name):
    plan = _plan(driver.queries()[name](spark, SF_DIR))
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in plan.replace(" ", "") or (
        name == "read_years" and "Or(And(GreaterThanOrEqual(l_shipdate,1996" in plan.replace(" ", "")
    )


def test_scans_read_only_what_is_needed(spark):
    plan = _plan(driver.queries()["monthly_temp_by_uf"](spark, SF_DIR))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
    # Line items meet the stations only after they have been summed.
    assert plan.index("Join") < plan.index("partial_sum(cast(l_extendedprice")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    built = driver.queries()[name](spark, SF_DIR)
    plan = _plan(built)
    assert not any(operator in plan for operator in ("Cartesian", "NestedLoop", "Python", "Pandas"))
    columns = sorted(built.columns)
    actual = built.toArrow()
    expected = oracle.execute(driver.oracle_sql()[name]).to_arrow_table()
    assert sorted(expected.column_names) == columns
    types = [{name: str(table.schema.field(name).type) for name in columns} for table in (actual, expected)]
    assert types[0] == types[1]
    assert actual.num_rows > 0
    assert _rows(actual, columns) == _rows(expected, columns)


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["uf", "ano", "mes", "media"]
    assert result.count() > 0
