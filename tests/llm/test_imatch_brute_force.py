"""Fingerprints and likenesses, computed again from the texts with plain Python."""

import math
import random
import re
import struct

import xxhash

from tidemark.llm import imatch

MASK = (1 << 64) - 1


def hashed(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64(data, seed=seed & MASK).intdigest()


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def term(t: str) -> int:
    return signed(hashed(t.encode()))


def of_list(values) -> int:
    h = 42
    for v in values:
        h = hashed(struct.pack("<q", v), h)
    return h


def lexicon(texts: list[str]) -> set[int]:
    """Terms of the band, by counting."""
    n, counts = max(len(texts), 2), {}
    for t in texts:
        for h in {term(x) for x in re.findall(r"[^\W_]+", t.lower())}:
            counts[h] = counts.get(h, 0) + 1
    return {h for h, c in counts.items() if imatch.BAND[0] <= math.log(n / c) / math.log(n) <= imatch.BAND[1]}


def prints(text: str, words: set[int]):
    terms = sorted({h for t in re.findall(r"[^\W_]+", text.lower()) if (h := term(t)) in words})
    whole = [f"all.{of_list(terms):X}"]
    for i in range(imatch.DROPS):
        left = [t for t in terms if ((t & MASK) >> 2 * i) & 3]
        whole.append(f"{i}.{of_list(left):X}" if left else f"{i}.-")
    level = (max(len(terms), 1) - 1).bit_length()
    thin = []
    for lv in [level] if not level else [level - 1, level]:
        by = {}
        for t in terms:
            by.setdefault(((t & MASK) >> 22) & ((1 << lv) - 1), []).append(t)
        thin += sorted(f"{lv}.{s}.{f'{of_list(g):X}'[-8:]}" for s, g in by.items() if s < imatch.SLOTS)
    return thin, whole


def likeness(a, b):
    (thin_a, whole_a), (thin_b, whole_b) = a, b
    if whole_a[0] == whole_b[0]:
        return 1.0
    best = len({x for x in whole_a if not x.endswith("-")} & set(whole_b)) / (imatch.DROPS + 1)
    level = lambda x: x.split(".")[0]
    for lv in {level(x) for x in thin_a} & {level(x) for x in thin_b}:
        x, y = ({v for v in thin if level(v) == lv} for thin in (thin_a, thin_b))
        slots = {v.rsplit(".", 1)[0] for v in x | y}
        best = max(best, len(x & y) / (len(slots) + 1))
    return best


def test_fingerprints_and_likeness(spark):
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(r.choice(vocabulary[: r.choice([30, 400])]) for _ in range(r.choice([0, 1, 3, 20, 90, 400])))) for i in range(60)]
    rows += [(100 + i, rows[i][1] + f" w{i % 7}, W{399 - i}!") for i in range(40)] + [(500, None), (501, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    words = lexicon([t or '' for _, t in rows])
    got = {g.doc_id: g for g in imatch.compared_with_edits(df).collect()}
    order = sorted(((d, t or "") for d, t in rows), reverse=True)
    made = {d: prints(t, words) for d, t in rows for t in [t or ""]}
    for i, (d, t) in enumerate(order):
        follower, following = order[(i + 1) % len(order)]
        k = len(t) // 3
        edited = prints(t[: len(t) - k] + following[:k], words)
        g = got[d]
        assert (g.fingerprint, g.fingerprint_whole) == made[d], d
        assert (g.edited_fingerprint, g.edited_fingerprint_whole) == edited, d
        assert abs(g.near_edited - likeness(made[d], edited)) < 1e-12 and abs(g.near_next - likeness(made[d], made[follower])) < 1e-12, d
    long = [g for g in got.values() if g.n_chars > 1000]
    assert any(0 < g.near_edited < 1 for g in long)
    # documents that differ in a few of many terms share some of the lexicons that leave out a quarter
    near = [likeness(made[i], made[100 + i]) for i in range(40) if len(rows[i][1]) > 300]
    assert near and sum(x > 0.1 for x in near) > 0.9 * len(near)
