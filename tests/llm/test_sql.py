import duckdb
import pytest

from tidemark.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = c.sql(oracle_sql()[name])
    cols = sorted(rel.columns)
    df = queries()[name](spark, SF)
    assert sorted(df.columns) == cols
    order = [rel.columns.index(x) for x in cols]
    assert sorted(map(repr, (tuple(r[x] for x in cols) for r in df.collect()))) == sorted(map(repr, (tuple(r[i] for i in order) for r in rel.fetchall())))
