"""fold_quarantine on events of which several are a user's last in the same second."""

import datetime

import duckdb

from tidemark.plans.catalogue import QUERIES, SQL


def test_ties_go_as_in_sql(spark, tmp_path):
    at = datetime.datetime(2024, 1, 2, 3, 4, 5)
    rows = [(i * 100_000 + u, at - datetime.timedelta(days=u * (i > 3)), u) for i in range(6) for u in range(3)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long").write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["fold_quarantine"](spark, str(tmp_path)).select("path", "firstDetected", "lastChecked", "status").collect()
    db = duckdb.connect()
    db.sql(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = db.sql(f'select path, "firstDetected", "lastChecked", status from ({SQL["fold_quarantine"]})').fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) == 3
    assert {r.path: r.status for r in got} == {"u0": 400, "u1": 401, "u2": 402}
