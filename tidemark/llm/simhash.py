"""SimHash fingerprints, and near duplicates by a self-join of binary tries.

Fingerprints.  Every bit is the majority of that bit over the XXH64 of all
4-word shingles of a text, repeats included.  Equal fingerprints are one row
from there on, so copies cost nothing more.

Tries.  Two fingerprints link when at most `budget` bits differ.  A trie over
one order of the bits is walked by pairs of its nodes: the pair of a node and
itself goes on to its children, a pair of children that part at this bit has one
more differing bit, and a pair is given up when it has more than the budget.
Near the root the budget cuts nothing off, so the trie is built over several
orders of the bits: of `parts` parts, parts - budget are equal in any two
fingerprints that link, and for each choice of those there is a trie that has
them first.  Its upper levels then allow no differing bit at all: they are a
shuffle by those parts, and each of the nodes below is walked within a task.

Small node pairs are compared fingerprint by fingerprint.  A task hands on a
spanning forest of what it finds, never all pairs of a dense group.  A node with
more than HOT fingerprints is dealt to tasks by pairs of slices of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .components import components
from .session import id_text, written

SEED = 42
#: Shingles whose bits are counted at once.
SHINGLES = 65_536
#: Fingerprints below a node that one task walks; larger nodes are walked by pairs of slices.
HOT = 20_000
#: Pairs of fingerprints that are compared without going further down; node pairs, and pairs of fingerprints, held at once.
LEAF, HELD = 64, 1 << 20


def fingerprint(text: str | None, k: int = 4) -> int:
    """The SimHash of a whole text as an unsigned number; 0 where there is no word."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(len(words) - k + 1, 1)
    begin, end = np.r_[0, ends[: n - 1] + 1].tolist(), ends[-n:].tolist()
    set_bits, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLES):
        h = np.array([digest(body[a:b], SEED) for a, b in zip(begin[at : at + SHINGLES], end[at : at + SHINGLES])], np.uint64)
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                found = np.array([fingerprint(t, k) for t in part.column("text").to_pylist()], np.uint64)
                yield pa.record_batch([part.column("doc_id"), pa.array(K.signed(found))], ["doc_id", "fp"])

    return run


class Orders:
    """The orders of the bits: for each choice of parts that are equal, those parts first."""

    def __init__(self, parts: int, budget: int) -> None:
        if not budget < parts <= 64:
            raise ValueError("there must be more parts than differing bits, and at most 64")
        cuts = [64 * i // parts for i in range(parts + 1)]
        self.spans = list(zip(cuts, np.diff(cuts).tolist()))
        self.chosen = list(combinations(range(parts), parts - budget))
        self.top = [sum(self.spans[p][1] for p in c) for c in self.chosen]

    def turned(self, fp: np.ndarray, order: int) -> np.ndarray:
        """The fingerprints with their bits in an order, the chosen parts in front."""
        first = self.chosen[order]
        out = np.zeros(len(fp), np.uint64)
        for p in (*first, *(q for q in range(len(self.spans)) if q not in first)):
            at, width = self.spans[p]
            out = (out << np.uint64(width)) | ((fp >> np.uint64(at)) & np.uint64((1 << width) - 1))
        return out


def _keyed(orders: Orders):
    """(trie, node, fp) of every fingerprint in every trie; node: the parts in front."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for t, top in enumerate(orders.top):
                node = orders.turned(fp, t) >> np.uint64(64 - top)
                yield pa.record_batch([pa.array(np.full(len(fp), t, np.int32)), pa.array(K.signed(node)), batch.column("fp")], ["trie", "node", "fp"])

    return run


def near_pairs(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, top: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i < j, of fingerprints of one node that differ in at most budget bits, in portions.

    v: fingerprints, in order within each node lo..hi; those of a node have their first `top` bits in common.
    """
    ones: dict[int, np.ndarray] = {}
    stack = [(top, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
    while stack:
        depth, al, ah, bl, bh, used = stack.pop()
        work = (ah - al) * (bh - bl)
        small = (work <= LEAF) | (depth == 64)
        if small.any():
            yield from _compared(v, al[small], ah[small], bl[small], bh[small], budget)
        al, ah, bl, bh, used = (x[~small] for x in (al, ah, bl, bh, used))
        if not len(al):
            continue
        if depth not in ones:
            ones[depth] = np.r_[0, np.cumsum((v >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64)]
        o = ones[depth]
        am, bm = ah - (o[ah] - o[al]), bh - (o[bh] - o[bl])
        cross = al != bl
        down = [
            (al, am, bl, bm, used),
            (am, ah, bm, bh, used),
            (al, am, bm, bh, used + 1),
            *([tuple(x[cross] for x in (am, ah, bl, bm, used + 1))] if cross.any() else []),
        ]
        down = [np.concatenate(x) for x in zip(*down)]
        alive = (down[0] < down[1]) & (down[2] < down[3]) & (down[4] <= budget) & ((down[0] != down[2]) | (down[1] - down[0] > 1))
        down = [x[alive] for x in down]
        for at in range(0, len(down[0]), HELD):
            stack.append((depth + 1, *(x[at : at + HELD] for x in down)))


def _compared(v, al, ah, bl, bh, budget):
    """The pairs of fingerprints of node pairs, compared by their differing bits."""
    wide = bh - bl
    size = (ah - al) * wide
    total = np.cumsum(size)
    cuts = [0, *(np.flatnonzero(np.diff(total // HELD)) + 1).tolist(), len(size)]
    for x, y in zip(cuts, cuts[1:]):
        part = size[x:y]
        of = np.repeat(np.arange(x, y), part)
        k = np.arange(len(of)) - np.repeat(np.cumsum(part) - part, part)
        i, j = al[of] + k // wide[of], bl[of] + k % wide[of]
        near = (np.bitwise_count(v[i] ^ v[j]) <= budget) & ((i < j) | (al[of] != bl[of]))
        yield i[near], j[near]


def _root(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = x = parent[parent[x]]
    return x


def _walk(orders: Orders, budget: int):
    """Links (a, b) of sorted rows (trie, node, i, j, fp): a spanning forest of each node's."""

    def linked(trie: int, keys: list[np.ndarray], fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        v = orders.turned(fp, trie)
        change = np.zeros(len(fp), bool)
        for x in keys:
            change[1:] |= x[1:] != x[:-1]
        group = np.cumsum(change)
        order = np.lexsort((v, group))
        v, fp = v[order], fp[order]
        lo = np.r_[0, np.flatnonzero(change)]
        hi = np.r_[lo[1:], len(fp)]
        some = hi - lo > 1
        parent, label = list(range(len(fp))), np.arange(len(fp))
        for i, j in near_pairs(v, lo[some], hi[some], orders.top[trie], budget):
            other = label[i] != label[j]
            a, b = [], []
            for x, y in zip(i[other].tolist(), j[other].tolist()):
                p, q = _root(parent, x), _root(parent, y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    a.append(x)
                    b.append(y)
            if a:
                yield pa.record_batch([pa.array(K.signed(fp[a])), pa.array(K.signed(fp[b]))], ["a", "b"])
                if len(i) > 1000:  # what is connected need not be looked at again
                    label = np.array(parent)
                    while (label != (up := label[label])).any():
                        label = up

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            keys = np.column_stack(held[:-1])
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last node may go on in the next batch
            yield from each([x[:cut] for x in held])
            held = [x[cut:] for x in held]
        if held is not None:
            yield from each(held)

    def each(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        trie, node, i, j, fp = rows
        for t in np.unique(trie).tolist():
            own = trie == t
            yield from linked(t, [node[own], i[own], j[own]], fp[own].view(np.uint64))

    return run


def near_links(fingerprints: DataFrame, budget: int = 4, parts: int = 6) -> DataFrame:
    """Links (a, b) between rows (fp) of different 64-bit fingerprints.

    They connect what differs in at most `budget` bits, through as many links as
    each task needs, not all; each is a pair that does differ so little.
    """
    orders = Orders(parts, budget)
    rows = fingerprints.mapInArrow(_keyed(orders), "trie int, node long, fp long")
    hot = written(rows.groupBy("trie", "node").agg(F.count("*").alias("c")).where(F.col("c") > HOT).selectExpr("trie", "node", f"ceil(c / {HOT}) AS slices"), "hot-nodes")
    if hot.isEmpty():
        dealt = rows.select("trie", "node", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    else:
        own = rows.join(hot, ["trie", "node"], "left").withColumn("s", F.pmod(F.xxhash64("fp"), F.coalesce("slices", F.lit(1))))
        each = own.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("slices", F.lit(1)) - 1)))
        dealt = each.select("trie", "node", F.least("s", "o").cast("int").alias("i"), F.greatest("s", "o").cast("int").alias("j"), "fp")
    dealt = dealt.repartition("trie", "node", "i", "j").sortWithinPartitions("trie", "node", "i", "j")
    return dealt.mapInArrow(_walk(orders, budget), "a long, b long")


def simhash_duplicates(docs: DataFrame, k: int = 4, budget: int = 4, parts: int = 6) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed number), component_id: a row per document.

    component_id is the smallest doc_id that can be reached by links of at most
    `budget` differing bits.  Texts are taken whole, A-Z lower-cased, words are
    `[^\\x20\\x09-\\x0D]+`; a text of fewer than k words is one shingle.  Null, empty
    and blank texts have the fingerprint 0, which links like any other.  Rows without
    doc_id are left out; repeated rows come out alike; rows of one doc_id with
    different texts keep their own fingerprints and components; other columns are
    ignored.  An empty table gives no rows.
    """
    marked = written(id_text(docs).mapInArrow(_fingerprints(k), "doc_id long, fp long"), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    grouped = components(written(near_links(classes.select("fp"), budget, parts), "near"))
    own = classes.join(grouped.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("c"))
    own = written(own, "of-component")
    least = own.groupBy("c").agg(F.min("first").alias("component_id"))
    of_class = written(own.join(least, "c").select("fp", "component_id"), "of-class")
    return marked.join(of_class, "fp").select("doc_id", "fp", "component_id")


def fingerprint_text(fp):
    """A column of signed fingerprints as 16 hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
