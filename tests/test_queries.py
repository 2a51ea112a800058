"""Every query of the catalogue against its SQL in DuckDB, over whole tables."""

import duckdb
import pytest

from tidemark.plans.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(norm(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in SQL:
        assert got
        return
    rel = db.sql(SQL[name])
    assert sorted(rel.columns) == cols
    order = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(norm(r[i]) for i in order) for r in rel.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
