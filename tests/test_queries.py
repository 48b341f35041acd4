"""Every query against its DuckDB SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from freshet.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(x):
        return ("nan" if math.isnan(x) else repr(round(x, 6) + 0.0)) if isinstance(x, float) else str(x)

    return [names[i] for i in order], sorted(tuple(value(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    if name not in ORACLE_SQL:
        assert got[1]
        return
    want = duck.execute(ORACLE_SQL[name])
    assert got == plain(want.fetchall(), [c[0] for c in want.description])


def test_geotiff_round_trip_over_several_tiles(spark):
    """rows were those within a tile of 64, which the smallest tables don't exceed."""
    df, part = QUERIES["geotiff_round_trip"](spark, "/root/testdata/sf0.1"), "/root/testdata/sf0.1/part.parquet"
    want = duckdb.sql(ORACLE_SQL["geotiff_round_trip"].replace("FROM part", f"FROM '{part}'"))
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(want.fetchall(), want.columns)


def test_union_is_of_whole_tables(spark):
    want = sum(spark.read.parquet(f"{DATA}/{t}.parquet").count() for t in ("customer", "orders"))
    assert QUERIES["union_schema_drift"](spark, DATA).count() == want


@pytest.mark.parametrize("name", ["buildings_report", "infra_report_subtotals", "structures3_subtotals", "overlay_line_length_by_type"])
def test_reports_join_once(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and plan.count("Relation [") + plan.count("Relation[") == 2


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
