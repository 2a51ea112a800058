"""Repeated word spans across documents, by compaction of a de Bruijn graph.

Nodes are groups of k-1 words, edges windows of k words: an edge leads from the
node of its first words to that of its last.  A word goes if some edge over it
also starts in a document with a smaller doc_id.

1. Every edge is assigned its minimizer, the least of the hashes of the short
   word groups inside it.  Equal edges have equal minimizers, so an edge whose
   minimizer is in a single place in the corpus cannot repeat.  Minimizers are
   counted over all documents (one row per minimizer run, about a fifth of the
   edges); those that repeat go to a Bloom filter sized by their number.
2. A run of neighbouring edges with one repeated minimizer is shuffled as ONE
   row, the nodes along it, under its minimizer.  Each task settles equal runs
   among its own rows first: a run that a third of all documents share sends one
   row a task, not one a document.
3. All places of an edge meet under its minimizer.  There, in- and out-degrees of
   nodes are counted over the different edges; a node with one of each, at which
   no run begins or ends, is inside a nonbranching path.  The edges of such a
   path are in the same documents throughout, so the path is judged once: by the
   smallest doc_id that holds it.  Source coordinates (doc, first edge, number of
   edges) of its later places go back to the documents' words.

Minimizers in more than HOT places do not gather: their edges go one by one,
under hashes of their own.  All of them, however many, are in a second filter.

Nodes are compared by 64-bit hashes, an edge by those of both its nodes.

repeated_paths() goes on from there: paths of different minimizers that meet in a
nonbranching node are joined, in Spark, to the whole repeated passages, which are
then read again at their source coordinates.  What is removed does not depend on
it: a passage goes word by word, whatever paths it is made of.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .components import components
from .session import remove, tagged, written

#: Edges that a task holds before it settles and sends them; places from which a minimizer is hot; nodes that are judged at once.
FLUSH_EDGES, HOT, BATCH = 1_500_000, 2_000, 1 << 19
_ROWS = "key long, doc long, tag int, start int, n int, nodes array<long>"
_NAMES = ["key", "doc", "tag", "start", "n", "nodes"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
_SPANS = "doc_id long, tag int, start int, n int"
_PATHS = "head long, tail long, doc_id long, tag int, start int, n int, places long"


def _runs(words: K.Words, k: int, short: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First edge, number of edges and minimizer of each run of edges with one minimizer."""
    fit = np.flatnonzero(words.fits(k))
    if not len(fit):
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64)
    least = K.sliding_min(words.windows(short), k - short + 1)[fit]
    cut = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (fit[1:] != fit[:-1] + 1)])
    return fit[cut], np.diff(np.r_[cut, len(fit)]), least[cut]


def _count_minimizers(k: int, short: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                _, _, least = _runs(K.Words(part.column("text")), k, short)
                value, count = np.unique(least, return_counts=True)
                yield pa.record_batch([pa.array(K.signed(value)), pa.array(count)], ["m", "c"])

    return run


def _rows(key, doc, tag, start, n, nodes=None) -> pa.RecordBatch:
    nodes = pa.nulls(len(key), _TYPES[-1]) if nodes is None else nodes
    return pa.record_batch([*(pa.array(x, t) for x, t in zip((key, doc, tag, start, n), _TYPES)), nodes], _NAMES)


def _steps(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each pair, n numbers, one after another."""
    return np.arange(n.sum()) - np.repeat(np.r_[0, np.cumsum(n)[:-1]] - first, n)


def _take_lists(flat: np.ndarray, first: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(flat[_steps(first, n)]))


def _deal(bits, hot, k: int, short: int):
    """Runs under their minimizers; copies that the task finds later are settled: rows without nodes, under their document."""

    def settle(held):
        path, key, doc, tag, start, n = (np.concatenate([h[i] for h in held]) for i in range(6))
        flat = np.concatenate([h[6] for h in held])
        first = np.r_[0, np.cumsum(n + 1)[:-1]]
        order = np.lexsort((doc, path))
        new = np.r_[True, path[order][1:] != path[order][:-1]]
        own = doc[order] == doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        late, own = order[~own], order[own]
        if len(late):
            yield _rows(doc[late], doc[late], tag[late], start[late], n[late])
        for i in range(0, len(own), 100_000):
            o = own[i : i + 100_000]
            yield _rows(key[o], doc[o], tag[o], start[o], n[o], _take_lists(flat, first[o], n[o] + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, common, held, size = K.Bloom(bits.value), K.Bloom(hot.value), [], 0
        for batch in batches:
            for part in K.chunks(batch):
                words = K.Words(part.column("text"))
                first, n, key = _runs(words, k, short)
                keep = bloom.has(key)
                first, n, key = first[keep], n[keep], key[keep]
                if not len(first):
                    continue
                nodes = words.windows(k - 1)
                is_hot = common.has(key)
                if is_hot.any():
                    one = _steps(first[is_hot], n[is_hot])
                    alone = K.mix(nodes[one] * np.uint64(K.WORD_BASE) + nodes[one + 1])
                    first, n, key = np.r_[first[~is_hot], one], np.r_[n[~is_hot], np.ones(len(one), np.int64)], np.r_[key[~is_hot], alone]
                ids, tags = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tag"))
                row = words.doc[first]
                flat = K.signed(nodes[_steps(first, n + 1)])
                held.append((words.spans(first, first + n + k - 1), K.signed(key), ids[row], tags[row], first - words.first[row], n, flat))
                size += len(flat)
                if size >= FLUSH_EDGES:
                    yield from settle(held)
                    held, size = [], 0
        if held:
            yield from settle(held)

    return run


class _Graph:
    """The graph of runs: rows one after another, each with n edges along n + 1 nodes of `flat`.

    begin: whether a nonbranching path begins at each edge; edge: number of the
    different edge each one is; a, b: its nodes; row: its run; place: its place in it.
    """

    def __init__(self, flat: np.ndarray, n: np.ndarray) -> None:
        first = np.r_[0, np.cumsum(n + 1)[:-1]]
        at = _steps(first, n)
        self.row, self.place = np.repeat(np.arange(len(n)), n), at - np.repeat(first, n)
        self.a, self.b = flat[at], flat[at + 1]
        order = np.lexsort((self.b, self.a))
        a, b = self.a[order], self.b[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
        self.edge = np.empty(len(a), np.int64)
        self.edge[order] = np.cumsum(new) - 1
        names, number = np.unique(np.r_[a[new], b[new], flat[first], flat[first + n]], return_inverse=True)
        edges = int(new.sum())
        out, into = (np.bincount(number[i * edges : (i + 1) * edges], minlength=len(names)) for i in range(2))
        inner = (out == 1) & (into == 1)
        inner[number[2 * edges :]] = False
        self.begin = (self.place == 0) | ~inner[np.searchsorted(names, self.a)]

    def least(self, value: np.ndarray) -> np.ndarray:
        """For each edge, the least value among its places."""
        out = np.full(int(self.edge.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(out, self.edge, value)
        return out[self.edge]


def _spans(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Later places of the paths of whole minimizers; neighbours in one run are one span."""
    doc, tag, start, n = (rows.column(c).to_numpy(zero_copy_only=False) for c in _NAMES[1:5])
    g = _Graph(rows.column("nodes").flatten().to_numpy(zero_copy_only=False), n.astype(np.int64))
    owner = g.least(doc[g.row])
    path = np.flatnonzero(g.begin)
    late = np.repeat((doc[g.row] > owner)[path], np.diff(np.r_[path, len(g.row)]))
    on = np.flatnonzero(late & ~(np.r_[False, late[:-1]] & (g.place > 0)))
    off = np.flatnonzero(late & ~np.r_[late[1:] & (g.place[1:] > 0), False])
    return _span_batch(doc[g.row[on]], tag[g.row[on]], start[g.row[on]] + g.place[on], off - on + 1)


def _paths(rows: pa.RecordBatch) -> pa.RecordBatch:
    """The first place of each path of whole minimizers that stands in several documents, and how many of the task's rows have it."""
    doc, tag, start, n = (rows.column(c).to_numpy(zero_copy_only=False) for c in _NAMES[1:5])
    g = _Graph(rows.column("nodes").flatten().to_numpy(zero_copy_only=False), n.astype(np.int64))
    path = np.flatnonzero(g.begin)
    end = np.r_[path[1:], len(g.row)]
    d, t, p = doc[g.row[path]], tag[g.row[path]], start[g.row[path]] + g.place[path]
    order = np.lexsort((p, t, d, g.edge[path]))
    e = g.edge[path][order]
    head = np.flatnonzero(np.r_[True, e[1:] != e[:-1]])
    one, last = order[head], order[np.r_[head[1:], len(order)] - 1]
    some = d[last] > d[one]
    one, places = one[some], np.diff(np.r_[head, len(order)])[some]
    cols = [g.a[path[one]], g.b[end[one] - 1], d[one], t[one], p[one], (end - path)[one], places]
    return pa.record_batch([pa.array(x).cast(f) for x, f in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))], [c.split()[0] for c in _PATHS.split(", ")])


def _span_batch(doc, tag, start, n) -> pa.RecordBatch:
    return pa.record_batch([pa.array(doc, pa.int64()), *(pa.array(np.asarray(x).astype(np.int32)) for x in (tag, start, n))], [c.split()[0] for c in _SPANS.split(", ")])


def _judge(settle, with_settled: bool = True):
    """Rows by key: settled ones pass, the others are judged in batches of whole minimizers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            run_ = batch.column("nodes").is_valid()
            done = batch.filter(pa.compute.invert(run_))
            if done.num_rows and with_settled:
                yield _span_batch(*(done.column(c).to_numpy(zero_copy_only=False) for c in _NAMES[1:5]))
            rest = batch.filter(run_)
            if not rest.num_rows:
                continue
            held.append(rest)
            size += len(rest.column("nodes").flatten())
            if size < BATCH:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last minimizer may go on
            if cut:
                yield settle(table.slice(0, cut).combine_chunks().to_batches()[0])
                held = table.slice(cut).combine_chunks().to_batches()
                size = sum(len(b.column("nodes").flatten()) for b in held)
        if held:
            yield settle(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


def _dealt(docs: DataFrame, k: int, short: int, log2_bits: int | None) -> DataFrame:
    """Runs of edges whose minimizer repeats, by minimizer."""
    base, send = tagged(docs), docs.sparkSession.sparkContext.broadcast
    counted = base.mapInArrow(_count_minimizers(k, short), "m long, c long").groupBy("m").agg(F.sum("c").alias("c")).where("c > 1")
    counted = written(counted, "minimizers")
    bits, hot = send(K.bloom(counted, "m", log2_bits)), send(K.bloom(counted.where(F.col("c") > HOT), "m"))
    remove(counted)
    return base.mapInArrow(_deal(bits, hot, k, short), _ROWS).repartition("key").sortWithinPartitions("key")


def repeated_spans(docs: DataFrame, k: int = 13, short: int = 5, log2_bits: int | None = None) -> DataFrame:
    """(doc_id, tag, start, n): runs of n windows, from word `start` on, that also start in a smaller doc_id.

    tag is the 32-bit hash of the row's text, which tells rows of one doc_id
    apart.  Runs of one document may touch or overlap.  Rows without doc_id take
    no part; null and short texts have no windows; an empty table has no spans.
    """
    return _dealt(docs, k, short, log2_bits).mapInArrow(_judge(_spans), _SPANS)


def _read_again(k: int):
    """Passages whose first and last nodes are what stands at their source coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                words = K.Words(part.column("text"))
                start, n, head, tail = (part.column(c).to_numpy(zero_copy_only=False) for c in ("start", "n", "head", "tail"))
                a = words.first[:-1] + start
                inside = a + n + k - 1 <= words.first[1:]
                nodes = K.signed(words.windows(k - 1))
                a, b = np.where(inside, a, 0), np.where(inside, a + n, 0)
                good = pa.array(inside & (nodes[a] == head) & (nodes[b] == tail) if len(nodes) else inside)
                yield part.filter(good).select(["doc_id", "tag", "start", "n", "places"])

    return run


def repeated_paths(docs: DataFrame, k: int = 13, short: int = 5, least_words: int = 50, log2_bits: int | None = None) -> DataFrame:
    """doc_id, tag, start, n_words, places: passages of least_words words or more that several documents share, at their first place.

    Paths are the nonbranching ones of each minimizer; those that meet in a node
    with one path in and one out are joined (label propagation over the links),
    ordered by the source coordinates of their first places, and cut where these
    do not follow each other.  Each passage is read again there.  places is the
    least number of places among its paths, as their tasks counted them after
    settling copies.  A passage that is a ring of paths is cut where it closes.
    """
    pieces = written(_dealt(docs, k, short, log2_bits).mapInArrow(_judge(_paths, with_settled=False), _PATHS), "paths")
    pieces = pieces.withColumn("id", F.xxhash64("doc_id", "tag", "start", "n"))
    ends = pieces.select(F.col("tail").alias("v"), F.lit(1).alias("i"), F.lit(0).alias("o")).union(pieces.select("head", F.lit(0), F.lit(1)))
    plain = ends.groupBy("v").agg(F.sum("i").alias("i"), F.sum("o").alias("o")).where("i = 1 and o = 1").select("v")
    left = pieces.select(F.col("id").alias("a"), F.col("tail").alias("v")).join(plain, "v")
    links = written(left.join(pieces.select(F.col("id").alias("b"), F.col("head").alias("v")), "v").select("a", "b"), "path-links")
    chain = components(links).withColumnRenamed("node", "id")
    rows = pieces.join(chain, "id", "left").withColumn("chain", F.coalesce("component", "id"))
    w = Window.partitionBy("chain", "doc_id", "tag").orderBy("start")
    goes_on = F.coalesce(F.lag(F.col("start") + F.col("n")).over(w) == F.col("start"), F.lit(False))
    rows = rows.withColumn("island", F.sum(F.when(goes_on, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    by = F.struct("start", "head"), F.struct("start", "tail")
    whole = rows.groupBy("chain", "doc_id", "tag", "island").agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n"), F.min(by[0]).alias("h"), F.max(by[1]).alias("t"), F.min("places").alias("places"))
    whole = whole.where(F.col("n") + k - 1 >= least_words).select("doc_id", "tag", "start", "n", F.col("h.head").alias("head"), F.col("t.tail").alias("tail"), "places")
    source = tagged(docs).dropDuplicates(["doc_id", "tag"])
    checked = whole.join(source, ["doc_id", "tag"]).select("doc_id", "tag", "start", "n", "head", "tail", "places", "text").mapInArrow(_read_again(k), "doc_id long, tag int, start int, n int, places long")
    return checked.select("doc_id", "tag", "start", (F.col("n") + k - 1).alias("n_words"), "places")


def _cut(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                words = K.Words(part.column("text"))
                spans = part.column("spans")
                cover = np.zeros(len(words.hash) + 1, np.int64)
                have = np.diff(spans.offsets.to_numpy(zero_copy_only=False)) if len(spans) else np.zeros(0, np.int64)
                have = np.where(spans.is_valid().to_numpy(zero_copy_only=False), have, 0)
                flat = spans.flatten()
                if len(flat):
                    own, end = np.repeat(words.first[:-1], have), np.repeat(words.first[1:], have)
                    begin = np.minimum(own + flat.field("start").to_numpy(zero_copy_only=False), end)
                    np.add.at(cover, begin, 1)
                    np.add.at(cover, np.minimum(begin + flat.field("n").to_numpy(zero_copy_only=False) + k - 1, end), -1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = np.flatnonzero(~gone)
                body = words.body.copy()
                mark = np.zeros(len(body) + 1, np.int8)
                np.add.at(mark, words.start[kept], 1)
                np.add.at(mark, words.end[kept], -1)
                inside = np.cumsum(mark[:-1], dtype=np.int8) > 0
                after = kept[1:][words.doc[kept[1:]] == words.doc[kept[:-1]]]
                body[words.start[after] - 1] = 0x20
                inside[words.start[after] - 1] = True
                offsets = np.r_[0, np.cumsum(inside)][words.at]
                text = pa.LargeStringArray.from_buffers(len(words.at) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body[inside]))
                removed = np.bincount(words.doc[gone], minlength=len(words.at) - 1)
                yield pa.record_batch([part.column("doc_id"), pa.array(words.counts), pa.array(removed), text.cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, k: int = 13, short: int = 5, log2_bits: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space), a row per document.

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text, unchanged.  A null or
    empty text has no words and an empty kept_text; texts of fewer than k
    words lose nothing; rows of one doc_id lose nothing to each other, and each
    loses what its own text repeats of smaller ids, so that equal ones come out
    alike; rows without doc_id are left out; other columns are ignored,
    whatever their names.
    """
    spans = repeated_spans(docs, k, short, log2_bits).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return tagged(docs).join(spans, ["doc_id", "tag"], "left").mapInArrow(_cut(k), "doc_id long, n_words long, n_removed long, kept_text string")
