"""Repeated byte strings, by merging Burrows-Wheeler transforms of shards.

A string of `length` bytes is late if it also starts earlier (in a smaller
doc_id, or further left in the same document).  Every byte under a late string
goes.

Dealing out.  A string's minimizer is the least of the hashes of its K-byte
windows, the leftmost of equals.  Neighbouring strings with one minimizer form
a segment.  Equal strings have equal minimizers at equal places, so segments
meet by minimizer, and a minimizer that stands once in the corpus cannot hold a
repeat; those that repeat go to a Bloom filter sized by their number.

Whole copies.  Segments with equal bytes are settled as a whole, first within a
task, then by minimizer: all but the first are late.

Partial overlaps.  What is left of a minimizer's segments differ, yet may share
strings.  They are gathered in batches of whole minimizers, cut into shards,
and each shard's suffixes are sorted into a Burrows-Wheeler transform.  The
transforms are merged as Holt and McMillan do: an interleave of the shards,
first arbitrary, is refined by passes that each move every suffix two symbols
back, so that after n passes suffixes stand in the order of their first 2n
symbols; the other shards' suffixes are never sorted again.  The block borders
that the passes carry along are the common prefixes: suffixes in one block at
`length` symbols are a repeated interval, whose earliest member is the first.

Minimizers in more than HOT places (a line in a third of all documents) do not
gather: their strings go one by one, under hashes of their own.  All of them,
however many, are in a second Bloom filter; a minimizer that is in it by chance
goes the same way in every task.

Whole copies, and strings of hot minimizers, are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .session import remove, tagged, written

LENGTH = 100
#: Bytes of a minimizer; places from which one is hot.
ANCHOR, HOT = 40, 20_000
#: Bytes of segments that a task holds before it sends them, of a batch that is merged, of a shard.
HELD, BATCH, SHARD = 8 << 20, 1 << 20, 1 << 17
#: at: start << 16 | n << 8 | lead + 2; n is at most length - anchor + 1, lead less, -1 of settled spans, -2 of lone strings.
_ROWS = "key long, doc long, tag int, at long, bytes binary"
_NAMES = ["key", "doc", "tag", "at", "bytes"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
_SPANS = "doc_id long, tag int, start int, n int"


class _Hashes:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, body: np.ndarray) -> None:
        up, self.down = K._BYTES.get(len(body) + 1)
        self.total = np.zeros(len(body) + 1, np.uint64)
        np.cumsum(K.BYTE_VALUE[body] * up[: len(body)], out=self.total[1:])

    def windows(self, k: int) -> np.ndarray:
        n = max(0, len(self.total) - k)
        return K.mix((self.total[k:] - self.total[:n]) * self.down[:n] + np.uint64(k))

    def spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return K.mix((self.total[b] - self.total[a]) * self.down[a] + (b - a).astype(np.uint64))


def leftmost_least(x: np.ndarray, w: int) -> np.ndarray:
    """For each i up to len(x) - w, the place of the least of x[i : i + w], the leftmost of equals (by their upper bits)."""
    n, block, low = len(x) - w + 1, 1 << 20, np.uint64((1 << 21) - 1)
    out = np.zeros(max(n, 0), np.int64)
    for a in range(0, n, block):
        part = x[a : min(len(x), a + block + w - 1)]
        packed = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        least = K.sliding_min(packed, w)[: min(block, n - a)]
        out[a : a + len(least)] = (least & low).astype(np.int64) + a
    return out


def _segments(body: np.ndarray, at: np.ndarray, length: int, anchor: int):
    """(hashes, row, first, n, minimizer place, key) of a chunk's segments."""
    hashes = _Hashes(body)
    none = np.zeros(0, np.int64)
    if len(body) < length:
        return hashes, none, none, none, none, none.view(np.uint64)
    grams = hashes.windows(anchor)
    place = leftmost_least(grams, length - anchor + 1)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(place)]
    fit = np.flatnonzero(np.arange(len(place)) + length <= at[1:][row])
    if not len(fit):
        return hashes, none, none, none, none, none.view(np.uint64)
    p = place[fit]
    cut = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (fit[1:] != fit[:-1] + 1)])
    first = fit[cut]
    return hashes, row[first], first, np.diff(np.r_[cut, len(fit)]), p[cut], grams[p[cut]]


def _count(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                *_, key = _segments(*K.flat(part.column("text")), length, anchor)
                value, count = np.unique(key, return_counts=True)
                yield pa.record_batch([pa.array(K.signed(value)), pa.array(count)], ["m", "c"])

    return run


def _table(key, doc, tag, start, n, lead, text=None) -> pa.RecordBatch:
    at = (np.asarray(start, np.int64) << 16) | (np.asarray(n, np.int64) << 8) | (np.asarray(lead, np.int64) + 2)
    cols = [pa.array(x, t) for x, t in zip((key, doc, tag, at), _TYPES)]
    return pa.record_batch([*cols, pa.nulls(len(key), pa.binary()) if text is None else text], _NAMES)


def _late(doc, tag, start, n) -> pa.RecordBatch:
    """Settled spans, under their document: they meet there in the end."""
    return _table(doc, doc, tag, start, n, np.full(len(doc), -1))


def _gather(body: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.r_[0, np.cumsum(size)]
    return body[np.arange(offsets[-1]) - np.repeat(offsets[:-1] - first, size)], offsets


def _binary(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def _first_of(seg, doc, tag, start) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first occurrence of every hash, and of all that stand elsewhere; repeats of one place are dropped."""
    order = np.lexsort((start, tag, doc, seg))
    g, d, t, p = seg[order], doc[order], tag[order], start[order]
    head = np.r_[True, g[1:] != g[:-1]] if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    return order[head], order[(d != d[first]) | (t != t[first]) | (p != p[first])]


def _deal(bits, hot, length: int, anchor: int):
    def settle(held):
        key, seg, doc, tag, start, n, lead = (np.concatenate([h[i] for h in held]) for i in range(7))
        flat = np.concatenate([h[7] for h in held])
        size = np.where(lead >= 0, n + length - 1, 0)
        begin = np.r_[0, np.cumsum(size)[:-1]]
        own, late = _first_of(seg, doc, tag, start)
        if len(late):
            yield _late(doc[late], tag[late], start[late], n[late])
        for i in range(0, len(own), 20_000):
            o = own[i : i + 20_000]
            text, offsets = _gather(flat, begin[o], size[o])
            yield _table(key[o], doc[o], tag[o], start[o], n[o], lead[o], _binary(text, offsets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, common, held, size = K.Bloom(bits.value), K.Bloom(hot.value), [], 0
        for batch in batches:
            for part in K.chunks(batch):
                body, at = K.flat(part.column("text"))
                hashes, row, first, n, place, key = _segments(body, at, length, anchor)
                keep = bloom.has(key)
                row, first, n, place, key = row[keep], first[keep], n[keep], place[keep], key[keep]
                if not len(key):
                    continue
                ids, tags = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tag"))
                lead = place - first
                is_hot = common.has(key)
                if is_hot.any():
                    h, count = np.flatnonzero(is_hot), n[is_hot]
                    one = np.arange(count.sum()) - np.repeat(np.r_[0, np.cumsum(count)[:-1]] - first[h], count)
                    value = hashes.spans(one, one + length)
                    row, first = np.r_[row[~is_hot], np.repeat(row[h], count)], np.r_[first[~is_hot], one]
                    n = np.r_[n[~is_hot], np.ones(len(one), np.int64)]
                    key, lead = np.r_[key[~is_hot], K.mix(value)], np.r_[lead[~is_hot], np.full(len(one), -2)]
                seg = hashes.spans(first, first + n + length - 1)
                doc, tag, start = ids[row], tags[row], first - at[row]
                own, late = _first_of(seg, doc, tag, start)
                if len(late):
                    yield _late(doc[late], tag[late], start[late], n[late])
                text, _ = _gather(body, first[own], np.where(lead[own] >= 0, n[own] + length - 1, 0))
                held.append((K.signed(key[own]), K.signed(seg[own]), doc[own], tag[own], start[own], n[own], lead[own], text))
                size += len(text) + 64 * len(own)
                if size >= HELD:
                    yield from settle(held)
                    held, size = [], 0
        if held:
            yield from settle(held)

    return run


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes of a text in order; symbol 0 ends a string, and a suffix with its string; equal ones stand by place."""
    n = len(symbols)
    key = np.zeros(n, np.int64)
    stop = np.zeros(n, bool)
    for i in range(6):
        s = np.zeros(n, np.int64)
        s[: max(n - i, 0)] = symbols[i:]
        s[stop] = 0
        stop |= s == 0
        key = (key << 9) | s
    width, rank = 6, None
    ends = np.flatnonzero(symbols == 0)
    to_end = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    while True:
        order = np.argsort(key, kind="stable")
        k = key[order]
        new = np.r_[True, k[1:] != k[:-1]]
        if new.all() or width > to_end.max():
            return order
        rank = np.zeros(n, np.int64)
        rank[order] = np.cumsum(new)
        beyond = np.zeros(n, np.int64)
        live = np.flatnonzero(to_end >= width)
        beyond[live] = rank[live + width]
        key = rank * (n + 2) + beyond
        width *= 2


def repeated_intervals(symbols: np.ndarray, shard_of: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, block) of the suffixes that share their first `length` symbols with another: one block number each.

    symbols: strings one after another, each ended by 0; shard_of: the shard of every place, ascending, strings whole.
    """
    n = len(symbols)
    cuts = np.flatnonzero(np.r_[True, shard_of[1:] != shard_of[:-1], True])
    # the shards' transforms, shard by shard: sorted places and the two symbols before each
    places = np.concatenate([a + suffix_order(symbols[a:b]) for a, b in zip(cuts[:-1], cuts[1:])])
    padded = np.r_[0, 0, symbols].astype(np.uint32)
    before, two_before = padded[places + 1], padded[places]
    pair = ((two_before << 9) | before).astype(np.uint32)
    inside = (before != 0) & (two_before != 0)  # the suffix two symbols back is one of the same string
    shard = shard_of[places].astype(np.int16)
    # suffixes of fewer than two symbols before their end come from nowhere: they stand first among their symbol's
    after = np.r_[symbols, 0].astype(np.uint32)
    short = (after[places] == 0) | (after[places + 1] == 0)
    first = places[short]
    first_pair = np.where(symbols[first] == 0, 0, symbols[first].astype(np.uint32) << 9)
    # 18 bits of symbols, dense, so that passes sort small numbers
    names, dense = np.unique(np.r_[first_pair, pair[inside]], return_inverse=True)
    dense = dense.astype(np.uint16 if len(names) <= 1 << 16 else np.uint32)  # UTF-8 has fewer than 2**16 pairs
    first_dense, pair_dense = dense[: len(first)], np.zeros(n, dense.dtype)
    pair_dense[inside] = dense[len(first) :]
    order0 = np.argsort(first_dense, kind="stable")
    fixed_shard, fixed_dense = shard[short][order0], first_dense[order0]

    z, block, steps = shard.copy(), np.zeros(n, np.int64), 0
    while True:
        index = np.empty(n, np.int64)  # merged place -> place in the shards' transforms
        index[np.argsort(z, kind="stable")] = np.arange(n)
        if steps * 2 >= length:
            break
        moves = np.flatnonzero(inside[index])
        source = index[moves]
        symbol = np.r_[fixed_dense, pair_dense[source]]
        order = np.argsort(symbol, kind="stable")
        # short suffixes are all different; others differ by symbols or by what follows
        behind = np.r_[-1 - np.arange(len(fixed_dense)), block[moves]][order]
        sorted_symbol = symbol[order]
        border = np.r_[True, (sorted_symbol[1:] != sorted_symbol[:-1]) | (behind[1:] != behind[:-1])]
        block = np.cumsum(border)
        z = np.r_[fixed_shard, z[moves]][order]
        steps += 1
    size = np.bincount(block)
    many = size[block] > 1
    return places[index[many]], block[many]


def _merge(length: int, anchor: int):
    """Rows by key: late copies, and late strings of segments that overlap in part."""

    def overlaps(key, doc, tag, start, n, lead, flat, begin, size):
        """Spans among different segments of one batch."""
        hashes = _Hashes(flat)
        half = (length - anchor + 1) // 2
        shared = np.zeros(len(key), bool)
        middle = begin + lead
        for a, b in ((middle - half, middle), (middle + anchor, middle + anchor + half)):
            ok = np.flatnonzero((a >= begin) & (b <= begin + size))
            both = K.mix(hashes.spans(a[ok], b[ok]) + key[ok].view(np.uint64) * np.uint64(K.WORD_BASE))
            _, back, count = np.unique(both, return_inverse=True, return_counts=True)
            shared[ok[count[back] > 1]] = True
        s = np.flatnonzero(shared)
        if not len(s):
            return None
        bounds = np.r_[0, np.cumsum(size[s] + 1)]
        symbols = np.zeros(bounds[-1], np.uint16)
        place = np.ones(bounds[-1], bool)
        place[bounds[1:] - 1] = False
        symbols[place] = _gather(flat, begin[s], size[s])[0].astype(np.uint16) + 1
        owner = np.repeat(np.arange(len(s)), size[s] + 1)
        shard_of = (bounds[:-1] // SHARD)[owner]
        where, block = repeated_intervals(symbols, shard_of, length)
        o = s[owner[where]]
        offset = where - bounds[owner[where]]
        use = offset < n[o]
        o, offset, block = o[use], offset[use], block[use]
        d, t, p = doc[o], tag[o], start[o] + offset
        _, late = _first_of(block, d, t, p)
        return _spans(d[late], t[late], p[late], np.ones(len(late), np.int64)) if len(late) else None

    def settle(rows: pa.Table):
        """Whole minimizers."""
        batch = rows.combine_chunks()
        key, doc, tag, at = (batch.column(c).to_numpy() for c in _NAMES[:4])
        flat, begin = K.flat(batch.column("bytes"))
        start, n, lead = at >> 16, (at >> 8) & 255, (at & 255) - 2
        size = np.diff(begin)
        seg = _Hashes(flat).spans(begin[:-1], begin[1:])
        seg = K.signed(K.mix(seg + key.view(np.uint64) * np.uint64(K.WORD_BASE) + (lead == -2).astype(np.uint64)))
        own, late = _first_of(seg, doc, tag, start)
        if len(late):
            yield _spans(doc[late], tag[late], start[late], n[late])
        own = own[lead[own] >= 0]
        _, back, count = np.unique(key[own], return_inverse=True, return_counts=True)
        own = own[count[back] > 1]
        if len(own):
            found = overlaps(key[own], doc[own], tag[own], start[own], n[own], lead[own], flat, begin[own], size[own])
            if found is not None:
                yield found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            at = batch.column("at").to_numpy(zero_copy_only=False)
            done = at & 255 == 1
            if done.any():
                some = batch.filter(pa.array(done))
                at = at[done]
                yield _spans(*(some.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag")), at >> 16, (at >> 8) & 255)
            rest = batch.filter(pa.array(~done))
            if not rest.num_rows:
                continue
            held.append(rest)
            size += rest.nbytes
            if size < BATCH:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last minimizer may go on
            if cut:
                yield from settle(table.slice(0, cut))
                held, size = table.slice(cut).to_batches(), table.slice(cut).nbytes
        if held:
            yield from settle(pa.Table.from_batches(held))

    return run


def _spans(doc, tag, start, n) -> pa.RecordBatch:
    return pa.record_batch([pa.array(doc, pa.int64()), *(pa.array(np.asarray(x).astype(np.int32)) for x in (tag, start, n))], [f.split()[0] for f in _SPANS.split(", ")])


def late_strings(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, log2_bits: int | None = None) -> DataFrame:
    """(doc_id, tag, start, n): n strings of `length` bytes, from byte `start` on, that also start earlier; tag as in tagged()."""
    if length - anchor >= 250:
        raise ValueError("strings of one minimizer are counted in eight bits")
    base, send = tagged(docs), docs.sparkSession.sparkContext.broadcast
    counted = base.mapInArrow(_count(length, anchor), "m long, c long").groupBy("m").agg(F.sum("c").alias("c")).where("c > 1")
    counted = written(counted, "minimizers")
    bits, common = send(K.bloom(counted, "m", log2_bits)), send(K.bloom(counted.where(F.col("c") > HOT), "m"))
    remove(counted)
    dealt = base.mapInArrow(_deal(bits, common, length, anchor), _ROWS)
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_merge(length, anchor), _SPANS)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                body, at = K.flat(part.column("text"))
                spans = part.column("spans")
                have = np.diff(spans.offsets.to_numpy(zero_copy_only=False)) if len(spans) else np.zeros(0, np.int64)
                have = np.where(spans.is_valid().to_numpy(zero_copy_only=False), have, 0)
                flat, cover = spans.flatten(), np.zeros(len(body) + 1, np.int64)
                if len(flat):
                    own, end = np.repeat(at[:-1], have), np.repeat(at[1:], have)
                    begin = np.minimum(own + flat.field("start").to_numpy(zero_copy_only=False), end)
                    np.add.at(cover, begin, 1)
                    np.add.at(cover, np.minimum(begin + flat.field("n").to_numpy(zero_copy_only=False) + length - 1, end), -1)
                gone = np.cumsum(cover[:-1]) > 0
                total = np.r_[0, np.cumsum(gone)]
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                edge = at[:-1][at[:-1] < at[1:]]
                begins[edge] = gone[edge]
                runs = np.r_[0, np.cumsum(begins)]
                offsets = (np.arange(len(body) + 1) - total)[at]
                cols = [part.column("doc_id"), pa.array(np.diff(at)), pa.array(np.diff(total[at])), pa.array(np.diff(runs[at])), _binary(body[~gone], offsets)]
                yield pa.record_batch(cols, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeated_strings(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, log2_bits: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary): a row per document.

    A null text is empty; texts shorter than length lose nothing.  Repeated
    rows of one doc_id and text are one document and come out alike; rows of
    one doc_id with different texts are documents of their own, in the order of
    their texts' hashes.  Rows without doc_id are left out, other columns are
    ignored, an empty table gives no rows.
    """
    spans = late_strings(docs, length, anchor, log2_bits)
    spans = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return tagged(docs).join(spans, ["doc_id", "tag"], "left").mapInArrow(_cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
