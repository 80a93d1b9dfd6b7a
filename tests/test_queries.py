"""Every query against its DuckDB check: columns, rows and values, in any order; none multiplies tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry
from sparkweave.sources.tables import SCHEMAS

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def rows(data):
    return sorted((tuple(plain(v) for v in r) for r in data), key=repr)


#: Joins of reference tables, whose right side is broadcast while it is small.
REFERENCE_ONLY = {"J06_cross_reference_tables", "J32_nested_loop_reference_tables"}


def no_cross_product(name, df):
    """Streams have no plan of their own here."""
    text = df._jdf.queryExecution().executedPlan().toString()
    assert name[0] == "T" or name in REFERENCE_ONLY or not ("CartesianProduct" in text or "BroadcastNestedLoopJoin" in text)


# types DuckDB would widen to, which would not compare equal with ours
WIDE = ("HUGEINT", "DECIMAL")


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_check(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    no_cross_product(name, df)
    cols = sorted(df.columns)
    ours = rows(tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    cur = duck.execute(CHECKS[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert not [d for d in cur.description if str(d[1]).startswith(WIDE)]
    theirs = rows(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_runs_and_has_rows(spark, sf, name):
    df = QUERIES[name](spark, sf)
    no_cross_product(name, df)
    assert df.count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)
