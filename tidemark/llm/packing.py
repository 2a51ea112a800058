"""Packing token pieces into sequences by exact-complement hashing.

Lengths, not documents, are what a packing depends on, and there are at most
`size` of them.  So the plan is made on a table of (length, count), whose size
has nothing to do with the number of documents:

1. Sums are indexed: by sum, the single lengths, the pairs and the triples that
   have it.  For a length L with copies left, the gap size - L is looked up; the
   combination found is consumed as often as the availability counts allow at
   once.  Counts only fall, so a combination that has run out never comes back,
   and its entry is passed over for good.
2. What is left is placed best-fit: longest first, into the open sequences with
   the smallest gap that still takes it, again many at once.

Every step uses up either a length or a kind of gap, so steps are bounded by
the number of lengths.  The plan is a list of slots (length, from rank, to
rank, first sequence, offset); pieces get a rank within their length from
counts per (length, bucket) and take the slot that holds their rank.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import neg

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .session import id_text, written

#: The id after each document, and tokens a sequence holds.
END_ID, SEQUENCE = 1, 4096
#: Pieces of words that a worker remembers; words, which take less, are four times as many.
REMEMBERED = 500_000

class Encoder:
    """ids of texts, as unsigned 32-bit numbers.

    The vocabulary drops white space and never merges across it, nor across
    the pieces that its pattern cuts a word into.  So a text's ids are those
    of its words one after another, a word's those of its pieces; both repeat.
    A batch is cut into words at once, each different word is cut into pieces
    once, and words (by their 64-bit hash) and pieces are remembered.  Words that hold control characters,
    special tokens or letters beyond the Latin blocks are left to the
    tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        import regex

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        self.special = {t["content"].encode()[:2] for t in stored["added_tokens"]}
        self.cut = regex.compile(stored["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] + "| ")
        self.memory: dict[str, bytes] = {" ": b""}
        self._forget()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _odd(self, words: K.Words) -> np.ndarray:
        """For every word, whether it is left to the tokenizer whole."""
        body = words.body
        after = np.r_[body[1:], np.uint8(0)]
        odd = (body < 0x21) | (body == 0x7F) | (body > 0xC9) | ((body == 0xC2) & (after <= 0xA0)) | ((body == 0xC9) & (after >= 0x90))
        for a, b in self.special:
            odd |= (body == a) & (after == b)
        total = np.r_[0, np.cumsum(odd)]
        return total[words.end] > total[words.start]

    def _plain(self, names: list[bytes]) -> tuple[bytes, np.ndarray]:
        """The ids of plain words one after another, and how many each has."""
        if not names:
            return b"", np.zeros(0, np.int64)
        pieces = self.cut.findall(self.tokenizer.normalizer.normalize_str(b" ".join(names).decode()))
        different = set(pieces)
        new = [p for p in different if p not in self.memory]
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory = {p: ids for p in different if (ids := self.memory.get(p)) is not None} | {" ": b""}
        found = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        flat = np.array(list(chain.from_iterable(found)), "<u4").tobytes()
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) * 4
        self.memory.update(zip(new, [flat[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]))
        parts = list(map(self.memory.__getitem__, pieces))
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        breaks = np.flatnonzero(size == 0)
        total = np.r_[0, np.cumsum(size)]
        return b"".join(parts), np.diff(np.r_[0, total[breaks], total[-1]])

    def _learn(self, words: K.Words, one: np.ndarray, keys: np.ndarray) -> None:
        """Store the ids of the words at places `one`, whose hashes are `keys`, ascending."""
        odd, body = self._odd(words)[one], words.body.tobytes()
        names = [body[a:b] for a, b in zip(words.start[one].tolist(), words.end[one].tolist())]
        some, rest = np.flatnonzero(~odd), np.flatnonzero(odd)
        plain, size = self._plain([names[i] for i in some.tolist()])
        others = [self.whole(names[i].decode()) for i in rest.tolist()]
        order = np.r_[some, rest]
        size = np.r_[size, np.fromiter(map(len, others), np.int64, len(others)) // 4]
        begin = np.zeros(len(one), np.int64)
        count = np.zeros(len(one), np.int64)
        begin[order], count[order] = len(self.flat) + np.cumsum(size) - size, size
        self.flat = np.concatenate([self.flat, np.frombuffer(plain + b"".join(others), "<u4")])
        place = np.searchsorted(self.keys, keys)
        self.keys, self.begin, self.count = (np.insert(x, place, y) for x, y in ((self.keys, keys), (self.begin, begin), (self.count, count)))

    def _forget(self) -> None:
        self.keys, self.begin, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (a null text has none)."""
        words = K.Words(texts)
        keys, one, which = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.keys) > 4 * REMEMBERED:
            self._forget()
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[at] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            self._learn(words, one[new], keys[new])
            at = np.searchsorted(self.keys, keys)
        count = self.count[at][which]
        bounds = np.r_[0, np.cumsum(count)]
        return self.flat[np.arange(bounds[-1]) - np.repeat(bounds[:-1] - self.begin[at][which], count)], bounds[words.first]


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """A worker process keeps its encoder from task to task."""
    return Encoder(path)


def _pieces(tokenizer: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(tokenizer), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for part in K.chunks(batch):
                ids, piece, start, length, crc = [], [], [], [], []
                flat, at = encoder.batch(part.column("text"))
                for doc, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    data = flat[a:b].tobytes() + end
                    for i, c in enumerate(range(0, len(data), 4 * size)):
                        cut = data[c : c + 4 * size]
                        ids.append(doc)
                        piece.append(i)
                        start.append(c // 4)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])
        encoder.memory = {" ": b""}  # words stay, which take little; other work in this process may need the room

    return run


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each text's ids and END_ID, cut only where longer than size."""
    return id_text(docs).mapInArrow(_pieces(tokenizer, size), "doc_id long, piece int, start long, length long, ids_crc32 long")


class Sums:
    """Index of the sums of one, two and three available lengths, by sum.

    Entries of a sum are made when it is first looked up, and hold the lengths
    available then, longest first.  `left` is the caller's table of counts, which
    only fall: what has run out at the front of a sum's entries is passed for good.
    """

    def __init__(self, left: dict[int, int], size: int) -> None:
        self.left = left
        self.has = np.zeros(size + 1, bool)
        self.has[[n for n in left if n <= size]] = True
        self.two: dict[int, list[int]] = {}
        self.three: dict[int, list[int]] = {}
        self.front: dict[tuple[int, int], int] = {}

    def single(self, total: int) -> bool:
        return total in self.left

    def _entries(self, index: dict[int, list[int]], parts: int, total: int, most: int) -> Iterator[int]:
        """The longest lengths of combinations of so many parts, none above most."""
        if total not in index:
            n = np.arange(total - parts + 1, (total - 1) // parts, -1)
            n = n[self.has[n]]
            index[total] = (n[self.has[total - n]] if parts == 2 else n).tolist()
        entries, at = index[total], self.front.get((parts, total), 0)
        while at < len(entries) and not (entries[at] in self.left and (parts > 2 or total - entries[at] in self.left)):
            at += 1
        self.front[parts, total] = at
        for i in range(bisect_left(entries, -most, at, key=neg), len(entries)):
            yield entries[i]

    def pairs(self, total: int, most: int) -> Iterator[tuple[int, int]]:
        """Available pairs (longer first) with this sum, no length above most."""
        for n in self._entries(self.two, 2, total, most):
            if n in self.left and total - n in self.left:
                yield n, total - n

    def triples(self, total: int, most: int) -> Iterator[tuple[int, int, int]]:
        """Available triples (longest first) with this sum, no length above most."""
        for a in self._entries(self.three, 3, total, most):
            if a in self.left:
                for b, c in self.pairs(total - a, a):
                    if a not in self.left:
                        break
                    yield a, b, c


class Plan:
    """Slots for a table of length counts."""

    def __init__(self, counts: dict[int, int], size: int = SEQUENCE, most: int = 3) -> None:
        self.size = size
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.used = dict.fromkeys(self.left, 0)
        self.slots: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self._exact(most)
        self._best_fit()

    @classmethod
    def best(cls, counts: dict[int, int], size: int = SEQUENCE) -> Plan:
        """The plan with fewest sequences among those whose exact combinations go up to three, two, one.

        Exact fills of long lengths can use up the short ones that others
        need, so deeper is not always better.  One that wastes less than a
        sequence is taken at once.
        """
        least = max(-(-sum(n * c for n, c in counts.items()) // size), sum(c for n, c in counts.items() if 2 * n > size))
        found = None
        for most in (3, 2, 1):
            plan = cls(counts, size, most)
            if found is None or plan.sequences < found.sequences:
                found = plan
            if found.sequences == least:
                break
        return found

    def _take(self, length: int, times: int, first: int, offset: int) -> None:
        rank = self.used[length]
        self.slots.append((length, rank, rank + times, first, offset))
        self.used[length] = rank + times
        self.left[length] -= times
        if not self.left[length]:
            del self.left[length]

    def _times(self, combo: tuple[int, ...]) -> int:
        return min((self.left.get(n, 0) // combo.count(n) for n in set(combo)), default=0)

    def _fill(self, combo: tuple[int, ...]) -> bool:
        times = self._times(combo)
        if times <= 0:
            return False
        first, offset = self.sequences, 0
        self.sequences += times
        for n in sorted(combo, reverse=True):
            self._take(n, times, first, offset)
            offset += n
        return True

    def _exact(self, most: int) -> None:
        """Longest first: complete it by one other length, then (all over again) by two, then by three."""
        sums = Sums(self.left, self.size)
        for n in sorted(self.left, reverse=True):
            if n == self.size:
                self._fill((n,))
            elif n in self.left and sums.single(self.size - n):
                self._fill((n, self.size - n))
        for parts in range(2, most + 1):
            sums = Sums(self.left, self.size)
            for n in sorted(self.left, reverse=True):
                gap = self.size - n
                if n not in self.left or gap < parts:
                    continue
                for others in sums.pairs(gap, n) if parts == 2 else sums.triples(gap, n):
                    self._fill((n, *others))
                    if n not in self.left:
                        break

    def _best_fit(self) -> None:
        gaps: list[int] = []
        open_: dict[int, list[tuple[int, int]]] = {}

        def add(gap: int, first: int, times: int) -> None:
            if gap:
                if gap not in open_:
                    insort(gaps, gap)
                    open_[gap] = []
                open_[gap].append((first, times))

        for n in sorted(self.left, reverse=True):
            while n in self.left:
                i = bisect_left(gaps, n)
                if i == len(gaps):
                    each = self.size // n
                    full, rest = divmod(self.left[n], each)
                    for share, times in ((each, full), (rest, 1)):
                        if share and times:
                            first = self.sequences
                            self.sequences += times
                            for j in range(share):
                                self._take(n, times, first, j * n)
                            add(self.size - share * n, first, times)
                    break
                gap = gaps[i]
                first, times = open_[gap].pop()
                take = min(times, self.left[n])
                if take < times:
                    open_[gap].append((first + take, times - take))
                if not open_[gap]:
                    del open_[gap], gaps[i]
                self._take(n, take, first, self.size - gap)
                add(gap - n, first, take)


def _place(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, begin, _, first, offset = plan.value
        span = int(begin.max()) + 1 if len(begin) else 1
        keys = length.astype(object) * span + begin if span * 4097 > 1 << 62 else length * span + begin
        for batch in batches:
            n, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, n * span + np.minimum(rank, span - 1), side="right") - 1
            out = batch.drop_columns(["rank"])
            yield pa.record_batch([*out.columns, pa.array(first[at] + rank - begin[at]), pa.array(offset[at])], [*out.schema.names, "sequence_id", "offset"])

    return run


def packed(parts: DataFrame, size: int = SEQUENCE, bucket_rows: int = 4_000) -> DataFrame:
    """parts with sequence_id and offset.  parts must be a written table with doc_id, piece, length of 1..size.

    Only the table of counts by length (size rows at most) reaches the driver.
    A length's pieces are dealt to buckets of some bucket_rows rows, by `row`, a
    column of the written table that differs from row to row (else by doc_id and
    piece); ranks are counted within a bucket, from the sum of those before.
    """
    spark = parts.sparkSession
    counts = {r.length: r.c for r in parts.groupBy("length").agg(F.count("*").alias("c")).collect()}
    plan = Plan.best(counts, size)
    table = np.array(sorted(plan.slots) or np.zeros((0, 5)), np.int64).reshape(-1, 5)
    slots = spark.sparkContext.broadcast(tuple(np.ascontiguousarray(table[:, i]) for i in range(5)))
    own = ["row"] if "row" in parts.columns else ["doc_id", "piece"]
    many = [(n, -(-c // bucket_rows)) for n, c in counts.items() if c > bucket_rows]
    buckets = F.broadcast(spark.createDataFrame(many, "length long, buckets long"))
    dealt = parts.join(buckets, "length", "left").withColumn("bucket", F.pmod(F.xxhash64(*own), F.coalesce("buckets", F.lit(1)))).drop("buckets")
    before = dealt.groupBy("length", "bucket").agg(F.count("*").alias("c"))
    before = before.select("length", "bucket", (F.sum("c").over(Window.partitionBy("length").orderBy("bucket")) - F.col("c")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", *own))
    ranked = dealt.withColumn("place", inside).join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("place") - 1)
    kept = [f for f in parts.schema if f.name != "row"]
    return ranked.select(*[f.name for f in kept], "rank").mapInArrow(_place(slots), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row per piece.

    A null or empty text is the single id END_ID.  Only texts of more than
    size ids (END_ID included) are cut.  Rows without doc_id are left out;
    repeated rows are packed as often as they stand; an empty table gives no rows.
    """
    return packed(written(pieces(docs, tokenizer, size).withColumn("row", F.monotonically_increasing_id()), "pieces"), size)
