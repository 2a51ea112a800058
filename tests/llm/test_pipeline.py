import importlib.util
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    sys.path.insert(0, ROOT)
    import corpus_pipeline as P

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, f) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        f(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def module(name):
    spec = importlib.util.spec_from_file_location(name, os.path.join(os.path.dirname(__file__), f"{name}.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_and_ids(spark, steps):
    for before, after in steps[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}


def test_quality_keeps_clean_documents(spark, steps):
    before, after = steps[0]
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {d for d, _ in rows(after)}
    clean = [d for d, _ in rows(before) if labels.get(d) == (1, 0)]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)


def test_one_of_each_group_stays(spark, steps):
    before, after = steps[1]
    want = module("test_ngram_join").brute(rows(before))
    assert sorted(d for d, _ in rows(after)) == sorted(d for d, (_, c) in want.items() if c == d)


def test_personal_data_is_gone(spark, steps):
    before, after = steps[2]
    brute = module("test_pii").brute
    assert after.count() == before.count()
    found = 0
    for d, t in rows(after):
        (emails, ips, cards, phones, _), _ = brute(t)
        assert not emails and not ips and not phones and not cards, (d, t[:200])
        found += "<email>" in t or "<ip>" in t
    assert found and all(r.n_chars == len(r.text) for r in after.collect())


def test_mixture_draws_by_chance(spark, steps):
    from tidemark.llm.mixing import mixed

    before, after = steps[3]
    want = {r.doc_id for r in mixed(before).collect() if module("test_mixing").unit(r.doc_id) < r.chance}
    assert {d for d, _ in rows(after)} == want


def test_packing_holds_all(spark, steps):
    before, after = steps[4]
    m = module("test_packing")
    got = after.collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == m.want_pieces(rows(before))
    m.check_layout(got)


def test_run_is_the_stages(spark, steps):
    import corpus_pipeline as P

    got = sorted((r.doc_id, r.piece, r.ids_crc32) for r in P.run(spark, SF).collect())
    assert got == sorted((r.doc_id, r.piece, r.ids_crc32) for r in steps[-1][1].collect())
