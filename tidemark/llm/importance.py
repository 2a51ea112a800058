"""Quality by importance resampling: hashed n-gram models of target and raw text.

Features of a text are its words (letters and digits, lower-cased), pairs of
words, the shapes of its space-separated tokens (runs of letters, capitals and
digits and every other character), pairs of shapes, the eighths of words that
repeat the one before, and the power of two of its length, hashed into a fixed
number of buckets.  A document has a feature or not (its own repeats would make
chance look like evidence).  The raw model counts documents over ALL of them; the
target model over labelled good documents, at most TARGETS of them, those whose
ids have the smallest hashes.  A document's log weight is the sum over its
features of log p_target - log p_raw.

Both models are smoothed by SMOOTH counts, and a bucket whose target count is
within chance (LEAST_Z standard deviations) or size (LEAST_LOG) of what the raw
model expects has ratio one: with a million buckets, noise would otherwise add
up over a long text.

Sampling is without replacement, by Gumbel top-k: the k documents with the
largest log weight plus Gumbel noise, the noise a function of the id and a
seed.  k is given, or estimated from labels: one label in HELD_OUT is kept from the
target model, and its log weights say where good and bad documents part best, with good ones dear
(cut_between); k is the number of documents of that log weight or more.  The
k-th largest key is found by counting, never by sorting all rows in one place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .session import id_text, written

#: log2 of the buckets of single features and of word pairs; most labelled targets.
ONE_BITS, TWO_BITS, TARGETS = 22, 19, 100_000
SMOOTH, LEAST_Z, LEAST_LOG = 1.0, 4.5, 0.5
#: Of so many labels one is kept from the target model, to estimate k; labels used for that at most; bad documents that weigh as much as a good one that goes.
HELD_OUT, MOST_HELD, GOOD_WEIGHT = 5, 20_000, 20
#: Rows within one step of the counting search that are sorted at last.
LAST_ROWS = 10_000
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_WORD = np.where(_ALNUM, K.BYTE_VALUE[K.LOWER], np.uint64(0))
#: Letters that are not capitals count as one kind, and so do capitals and digits.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[[*range(97, 123), *range(128, 256)]] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, bucket) of every different feature of every text, and the number of rows."""
    words = K.Words(texts)
    body, n = words.body, len(words.hash)
    up, down = K._BYTES.get(len(body) + 2)
    total = np.r_[np.uint64(0), np.cumsum(_WORD[body] * up[: len(body)])]
    plain = (total[words.end] - total[words.start]) * down[words.start]
    kind = _KIND[body]
    change = np.ones(len(body), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[words.start] = True
    rank = np.cumsum(change)
    shaped = np.r_[np.uint64(0), np.cumsum(np.where(change, K.BYTE_VALUE[kind] * up[rank], np.uint64(0)))]
    shape = (shaped[words.end] - shaped[words.start]) * down[rank[words.start]] if n else plain
    pair = np.flatnonzero(words.fits(2))
    has = plain != 0
    twice = pair[has[pair] & has[pair + 1]]
    one = np.uint64(64 - ONE_BITS)
    single = np.concatenate([K.mix(plain[has]), K.mix(shape + np.uint64(7)), K.mix(shape[pair] * np.uint64(K.WORD_BASE) + shape[pair + 1] + np.uint64(11))]) >> one
    double = (K.mix(plain[twice] * np.uint64(K.WORD_BASE) + plain[twice + 1]) >> np.uint64(64 - TWO_BITS)) + np.uint64(1 << ONE_BITS)
    again = np.bincount(words.doc[pair[words.hash[pair] == words.hash[pair + 1]]], minlength=len(words.counts))
    told = np.flatnonzero(words.counts > 0)
    length = np.log2(words.counts[told]).astype(np.uint64)
    single = np.concatenate([single, K.mix((8 * again[told] // words.counts[told]).astype(np.uint64) + np.uint64(1 << 30)) >> one, K.mix(length + np.uint64(1 << 20)) >> one])
    row = np.concatenate([words.doc[has], words.doc, words.doc[pair], told, told, words.doc[twice]])
    both = np.sort((row << (ONE_BITS + 1)) | np.concatenate([single, double]).astype(np.int64))
    both = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
    return both >> (ONE_BITS + 1), both & ((1 << (ONE_BITS + 1)) - 1), len(words.at) - 1


def _counts(targets):
    size = (1 << ONE_BITS) + (1 << TWO_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(size, np.int32), np.zeros(size, np.int32)
        held: tuple[list, list] = ([], [])

        def add(least: int) -> None:
            for total, some in zip((raw, good), held):
                if some and sum(map(len, some)) >= least:
                    total += np.bincount(np.concatenate(some), minlength=size).astype(np.int32)
                    some.clear()

        for batch in batches:
            for part in K.chunks(batch):
                row, bucket, n = features(part.column("text"))
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(targets.value, ids), max(len(targets.value) - 1, 0))
                chosen = targets.value[at] == ids if len(targets.value) else np.zeros(n, bool)
                held[0].append(bucket)
                held[1].append(bucket[chosen[row]])
                add(4_000_000)
        add(1)
        some = np.flatnonzero(raw)
        for i in range(0, len(some), 200_000):
            s = some[i : i + 200_000]
            yield pa.record_batch([pa.array(s.astype(np.int32)), pa.array(raw[s].astype(np.int64)), pa.array(good[s].astype(np.int64))], ["b", "raw", "good"])

    return run


def _held_out() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(HELD_OUT)) == 0


def _one_a_document(labels: DataFrame) -> DataFrame:
    """doc_id, good: labels that say whether a document is good (quality 1, not toxic); one that any row calls bad is bad."""
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))
    told = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    return told.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(good).alias("good"))


def target_ids(labels: DataFrame, most: int = TARGETS) -> np.ndarray:
    """Ids labelled good and not held out, ascending: at most `most`, those with the smallest hashes."""
    good = _one_a_document(labels).where("good").where(~_held_out()).select("doc_id")
    rows = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).toArrow()
    return np.sort(rows["doc_id"].to_numpy().astype(np.int64))


def cut_between(good: np.ndarray, bad: np.ndarray) -> float:
    """The log weight from which on GOOD_WEIGHT times the share of good ones, less that of bad ones, is largest, then moved down to the middle of the gap below.

    Without bad ones all are taken, and without good ones too: such labels part nothing.
    """
    if not len(good) or not len(bad):
        return -math.inf
    value = np.sort(np.concatenate([good, bad]))
    share = lambda x: 1 - np.searchsorted(np.sort(x), value) / len(x)
    best = int(np.argmax(GOOD_WEIGHT * share(good) - share(bad)))
    return float((value[best] + value[best - 1]) / 2) if best else -math.inf


def estimated_cut(scored: DataFrame, labels: DataFrame) -> float:
    """cut_between for the held-out labels of scored (doc_id, log_weight): at most MOST_HELD, those with the smallest hashes."""
    held = _one_a_document(labels).where(_held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_HELD)
    rows = scored.select("doc_id", "log_weight").join(F.broadcast(held), "doc_id").groupBy("doc_id", "good").agg(F.min("log_weight").alias("w")).toArrow()
    good, weight = rows["good"].to_numpy(), rows["w"].to_numpy()
    return cut_between(weight[good], weight[~good])


def log_ratios(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, log p_target - log p_raw) of those buckets where they differ beyond chance."""
    spark = docs.sparkSession
    targets = spark.sparkContext.broadcast(target_ids(labels))
    rows = id_text(docs).mapInArrow(_counts(targets), "b int, raw long, good long").groupBy("b").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    # both totals, then only the buckets that differ, leave the cluster
    rows = written(rows, "ngrams")
    one = F.col("b") < (1 << ONE_BITS)
    sums = rows.groupBy(one.alias("one")).agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect()
    share = {r.one: r.good / r.raw if r.raw else 0.0 for r in sums}
    if not any(share.values()):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    expected = F.col("raw") * F.when(one, F.lit(share.get(True, 0.0))).otherwise(F.lit(share.get(False, 0.0)))
    rows = rows.withColumn("e", expected).withColumn("r", F.log((F.col("good") + SMOOTH) / (F.col("e") + SMOOTH)))
    kept = rows.where((F.abs(F.col("good") - F.col("e")) >= LEAST_Z * F.sqrt(F.col("e") + 1)) & (F.abs("r") >= LEAST_LOG)).select("b", F.col("r").cast("float")).toArrow()
    return kept["b"].to_numpy().astype(np.int32), kept["r"].to_numpy().astype(np.float32)


def _weights(ratios):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((1 << ONE_BITS) + (1 << TWO_BITS), np.float32)
        dense[ratios.value[0]] = ratios.value[1]
        for batch in batches:
            for part in K.chunks(batch):
                row, bucket, n = features(part.column("text"))
                yield pa.record_batch([part.column("doc_id"), pa.array(np.bincount(row, dense[bucket], n).astype(np.float64))], ["doc_id", "log_weight"])

    return run


def gumbel(seed: int) -> Column:
    """Standard Gumbel noise of a doc_id, from the first 52 bits of a keyed digest."""
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "doc_id").cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, column: str, k: int) -> tuple[float, int] | None:
    """(value, tie): rows with a larger value, and those of equal value with doc_id up to tie, number k.  None: no row.

    Values are counted by 4096 classes between two bounds, again within the
    class that holds the k-th, until it has few rows or one value; ids of one
    value likewise, in whole numbers.  Repeated rows of the id at the cut are
    alike, and all in.
    """
    if k <= 0:
        return None
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= n:
        return -math.inf, 0
    rows, left = df.select("doc_id", F.col(column).alias("v")).where("v is not null"), k
    while n > LAST_ROWS and low < high:
        width = (high - low) / 4096
        if not low < low + width:  # fewer than 4096 different values are left
            for v, n in sorted(((r.v, r.n) for r in rows.groupBy("v").agg(F.count("*").alias("n")).collect()), reverse=True):
                if n >= left:
                    break
                left -= n
            low = high = v
            rows = rows.where(F.col("v") == v)
            break
        c = F.least(F.floor((F.col("v") - low) / width), F.lit(4095))
        counts = sorted(((r.c, r.n, r.lo, r.hi) for r in rows.groupBy(c.alias("c")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()), reverse=True)
        for _, n, low, high in counts:
            if n >= left:
                break
            left -= n
        rows = rows.where((F.col("v") >= low) & (F.col("v") <= high))
    if low < high:
        last = rows.orderBy(F.desc("v"), "doc_id").limit(left).collect()[-1]
        return last.v, last.doc_id
    first, last = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    while first < last:
        width = -(-(last - first + 1) // 4096)
        c = F.floor((F.col("doc_id").cast("decimal(20,0)") - F.lit(first).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
        for _, n, first, last in sorted((r.c, r.n, r.lo, r.hi) for r in rows.groupBy(c.alias("c")).agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).collect()):
            if n >= left:
                break
            left -= n
        rows = rows.where((F.col("doc_id") >= first) & (F.col("doc_id") <= last))
    return low, first


def resampled(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 7) -> DataFrame:
    """doc_id, log_weight, key, sampled: a row per document.

    A null, empty or blank text has no features and log weight 0.  Without
    usable labels the target is empty, which says nothing: all weights are 0.
    Without a given k, and without held-out labels of both kinds, all are taken.
    Rows without doc_id are left out, repeated rows come out alike, other
    columns are ignored, an empty table gives no rows.
    """
    ratios = log_ratios(docs, labels)
    spark = docs.sparkSession
    scored = id_text(docs).mapInArrow(_weights(spark.sparkContext.broadcast(ratios)), "doc_id long, log_weight double")
    scored = written(scored.withColumn("key", F.col("log_weight") + gumbel(seed)), "weights")
    if k is None:
        k = scored.where(F.col("log_weight") >= F.lit(estimated_cut(scored, labels))).count()
    cut = kth_largest(scored, "key", k)
    taken = F.lit(False) if cut is None else F.lit(True) if cut[0] == -math.inf else (F.col("key") > cut[0]) | ((F.col("key") == cut[0]) & (F.col("doc_id") <= cut[1]))
    return scored.withColumn("sampled", taken)
