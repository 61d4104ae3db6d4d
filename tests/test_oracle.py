"""Every query with a SQL form against DuckDB: names, types and values."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

DUCK_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    yield con
    con.close()


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    relation = duck.sql(entry_points.oracle_sql()[name])
    expected_types = dict(zip(relation.columns, [str(t) for t in relation.types], strict=True))
    assert {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in df.schema} == expected_types
    names = sorted(df.columns)
    actual = sorted((tuple(r) for r in df.select(names).collect()), key=_key)
    expected = sorted(relation.select(*names).fetchall(), key=_key)
    assert len(actual) == len(expected) > 0
    assert actual == expected
    assert not any(isinstance(v, float) and math.isnan(v) for row in actual for v in row)


def test_reports_are_ordered(spark, duck):
    for name, order in {
        "top_origin_delays": "Avg_Dep_Delay_Minutes DESC, ORIGIN, ORIGIN_CITY_NAME",
        "monthly_delays": "Avg_Arr_Delay_Minutes DESC, Flight_Month",
        "rollup_monthly_delays": "Avg_Arr_Delay_Minutes DESC, Flight_Month",
        "monthly_trend": "Flight_Month NULLS FIRST",
    }.items():
        df = entry_points.queries()[name](spark, SF_DIR)
        sql = f"SELECT {', '.join(df.columns)} FROM ({entry_points.oracle_sql()[name]}) ORDER BY {order}"
        assert [tuple(r) for r in df.collect()] == duck.sql(sql).fetchall(), name


ROWS_ONLY = sorted(set(entry_points.queries()) - set(entry_points.oracle_sql()))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_runs_without_sql(spark, name):
    assert entry_points.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 13  # twelve months and the unknown one
