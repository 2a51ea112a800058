from tidemark.llm import packing
from tidemark.llm.packing import Plan, packed
from tidemark.llm.session import written


def test_further_exact_pairs_are_tried_for_a_pair_of_lengths():
    counts = {2000: 3, 1000: 3, 600: 1, 496: 1, 580: 1, 516: 1, 560: 1, 536: 1}
    p = Plan.best(counts)
    assert p.used == counts and p.sequences == 3


def test_sums_are_indexed_by_one_two_and_three_lengths():
    left = {n: 1 for n in (1, 2, 3, 5, 8, 13)}
    sums = packing.Sums(left, 40)
    assert sums.single(8) and not sums.single(4)
    assert list(sums.pairs(16, 40)) == [(13, 3), (8, 8)] and list(sums.pairs(16, 8)) == [(8, 8)]
    assert list(sums.triples(16, 40)) == [(13, 2, 1), (8, 5, 3)]
    del left[13], left[3]
    assert list(sums.pairs(16, 40)) == [(8, 8)] and list(sums.triples(16, 40)) == []
    assert list(sums.pairs(16, 40)) == [(8, 8)] and not list(sums.pairs(7, 1))


def test_repeated_rows_and_hot_lengths_spread_over_buckets(spark):
    rows = [(7, 0, 100, 5)] * 3000 + [(i, 0, 100 if i % 2 else 37, 6) for i in range(2000)]
    parts = spark.createDataFrame(rows, "doc_id long, piece int, length long, ids_crc32 long").repartition(3).selectExpr("*", "monotonically_increasing_id() as row")
    got = packed(written(parts, "parts"), 1000, bucket_rows=50).collect()
    assert len(got) == len(rows) and "row" not in got[0].asDict()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1000
    assert len(by) == 400 + -(-1000 // 27)  # 37s and 100s fill no sequence together
