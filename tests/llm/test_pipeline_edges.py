"""Every stage on tables without rows, with nulls, repeated ids, ties and columns whose names clash."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LONG = "one two three four five six seven eight nine ten " * 3


def stages():
    sys.path.insert(0, ROOT)
    import corpus_pipeline

    return corpus_pipeline.STAGES


@pytest.mark.parametrize("i", range(5))
def test_no_rows(spark, i):
    name, f = stages()[i]
    out = f(spark, spark.createDataFrame([], SCHEMA), SF)
    assert out.count() == 0, name
    if i < 4:
        assert out.columns == COLUMNS


@pytest.mark.parametrize("i", range(5))
def test_odd_rows(spark, i):
    name, f = stages()[i]
    rows = [
        (1, LONG, "en", "a", None), (1, LONG, "en", "a", None), (2, LONG, None, None, 7), (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, " \n", "en", "a", 2),
        (6, "mail me at jane.doe@example.com", "en", "a", 31), (6, "another text of one id", "en", "a", 22), (None, "no id", "en", "a", 5), (7, "x " * 30_000, "en", "a", 60_000),
    ]
    extra = "component_id string, sampled string, tag string, spans string, chance string, rid string, fp string, note string, h string, c string"
    docs = spark.createDataFrame([(*r, *("z" for _ in extra.split(", "))) for r in rows], f"{SCHEMA}, {extra}")
    out = f(spark, docs, SF)
    got = out.collect()
    if i == 4:
        assert {r.doc_id for r in got} == {1, 2, 3, 4, 5, 6, 7} and {r.doc_id: r.length for r in got if r.doc_id in (3, 4)} == {3: 1, 4: 1}
        return
    assert out.columns == COLUMNS and {r.doc_id for r in got} <= {1, 2, 3, 4, 5, 6, 7}, name
    kept = [(r.doc_id, r.text) for r in got]
    given = [r[:2] for r in rows]
    if i == 0:
        assert all(x in given for x in kept)
    if i == 1:
        assert sorted(kept, key=repr) == sorted((r for r in given if r[0] not in (None, 2)), key=repr)
    if i == 2:
        assert sorted((d, t) for d, t in kept if t) == sorted((d, t if "@" not in t else "mail me at <email>") for d, t in given if d is not None and t)
        assert [r.n_chars for r in got if r.doc_id == 3] == [None] and len(kept) == 9
    if i == 3:
        assert all(x in given for x in kept) and sum(d == 1 for d, _ in kept) in (0, 2)
