import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import whitening
from tidemark.llm.queries import queries

SF = "/root/testdata/sf0.001"


def slow(rows, components=4):
    """{(id, component): [...]} with fractions up to the eigenvectors; rows: (id, list of floats)."""
    kept = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in kept})
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    y = [[n * a - b for a, b in zip(x, s)] for x in fit]
    v = np.array([[float(Fraction(sum(r[a] * r[b] for r in y), n**3)) for b in range(d)] for a in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    out = []
    for i, x in kept:
        c = [n * a - b for a, b in zip(x, s)]
        w = np.array([float(Fraction(q, n)) for q in c]) @ u / np.sqrt(e)
        out += [(i, k + 1, n, sum(q * q for q in c), w[k], e[k] / np.trace(v)) for k in range(len(e))]
    return out


def close(got, want, scale=1e-9):
    assert [(r.id, r.component, r.n, int(r.deviation_text)) for r in got] == [w[:4] for w in want]
    for k in {w[1] for w in want}:
        g = np.array([r.whitened for r in got if r.component == k])
        w = np.array([x[4] for x in want if x[1] == k])
        assert min(np.abs(g - w).max(), np.abs(g + w).max()) <= scale * max(1, np.abs(w).max())
    assert all(abs(r.explained - w[5]) <= 1e-10 and r.identity_error < 1e-4 for r, w in zip(got, want))


def ran(spark, rows, kind="array<float>", **more):
    df = spark.createDataFrame(rows, f"id long, vector {kind}")
    return sorted(whitening.whitened(df, **more).collect(), key=lambda r: (r.id is None, r.id, r.component))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**80), 2**80), min_size=3, max_size=3), min_size=1, max_size=8))
def test_products_are_exact(rows):
    y, places = np.array(rows, object), {}
    digits = whitening.limbs(y)
    assert all(np.abs(a).max() <= 1 << (whitening.LIMB - 1) for a in digits)
    assert (sum((a.astype(int).astype(object) << (whitening.LIMB * k) for k, a in enumerate(digits)), np.zeros_like(y)) == y).all()
    whitening.add_products(places, y)
    assert (whitening.recombined(places, 3) == y.T.dot(y)).all()


def test_query_against_fractions(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries()["op12_embedding_whitening"](spark, SF)
    assert [f.dataType.simpleString() for f in got.schema][:7] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    got = sorted(got.withColumnRenamed("vec_id", "id").collect(), key=lambda r: (r.id, r.component))
    close(got, sorted(slow(rows), key=lambda w: w[:2]), 1e-7)
    assert all(r.deviation == int(r.deviation_text) for r in got)
    assert len({r.identity_error for r in got}) == 1


def test_left_out_repeated_and_extra(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rng.normal(0, [3, 2, 1, 0.5, 0.2], (40, 5)))]
    rows = good + good[:7] + [(100, None), (101, [None, 1.0, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5), (104, []), (105, good[3][1]), (106, [0.0, -0.0, 0.0, -0.0, 0.0])]
    close(ran(spark, rows), sorted((w for w in slow([r for r in rows if r[1] != []])), key=lambda w: w[:2]))
    wide = spark.createDataFrame([(i, v, 1, 2) for i, v in good], "id long, vector array<float>, component int, x int")
    assert whitening.whitened(wide).count() == 160
    assert ran(spark, []) == []
    assert len(ran(spark, [(None, [1.0, 2.0]), (1, [3.0, 5.0]), (1, [0.0, 7.0])])) == 6


@pytest.mark.parametrize("size", [1e9, 1e17, 1e30])
def test_large_entries(spark, size):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, size, (30, 3)))]
    got = ran(spark, rows, "array<double>")
    assert len(got) == 90
    if size <= 1e9:
        close(got, sorted(slow(rows), key=lambda w: w[:2]))
    held = [[min(max(math.floor(256 * c), -(2**63)), 2**63 - 1) for c in v] for _, v in rows]
    n = len({tuple(x) for x in held})
    s = [sum(x[k] for x in {tuple(x) for x in held}) for k in range(3)]
    dev = {i: sum((n * a - b) ** 2 for a, b in zip(x, s)) for i, x in enumerate(held)}
    assert all(int(r.deviation_text) == dev[r.id] and r.deviation == (dev[r.id] if dev[r.id] < 2**63 else None) for r in got)


def test_no_variance_and_several_lengths(spark):
    got = ran(spark, [(1, [1.0, 2.0])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    got = ran(spark, [(i, [float(i), 2.0 * i, 0.5]) for i in range(9)] + [(20, [1.0]), (21, [3.0])])
    assert [(r.component, r.whitened is None) for r in got if r.id == 5] == [(1, False), (2, True), (3, True)]
    assert [r.n for r in got if r.id >= 20] == [2, 2] and {r.n for r in got if r.id < 20} == {9}
    assert sorted(r.whitened for r in got if r.id >= 20) == [-1.0, 1.0]
