"""Similarity self-join on word shingles, through a token-group matrix.

Documents A and B link when 100 * |A and B| >= percent * |A or B|, A and B
being their sets of k-word shingles.  The join is exact (up to 64-bit hashes).

Classes.  Documents with equal sets are one class, joined through the hash of
the set; from here on there is one row per class, named by the hash of the
doc_id and text of its first document.

Order.  Any one order of all shingles gives a complete candidate search: two
linked sets share a shingle among the first n - ceil(n * percent / 100) + 1 of
each.  Shingles run by frequency class, then by hash; the class comes from
heavy-hitter counts that every task takes over all its documents.  A common
passage thus stands at the end of every set and makes no candidates.

Groups.  The first round links the members of every posting to one of them
only (a posting of more than HOT sets is dealt in slices, each with one of its
own, and those to one of them), so a large group of near copies costs one row a member: to the one whose
own prefix is the most common, for edits make rare shingles, and what is edited
least is near to most.  The components of these links partition the documents; big ones are split into
blocks.  The matrix holds each block's token union.

Queries.  A posting with one component left is done.  For the others, a
document meets the blocks of other components: the overlap with the token
union bounds the similarity to every member at once (a count by document and
block), and only blocks above the bound are opened, their members bounded one
by one in the same way, and survivors compared in full.  Every pair not already in one component is thus examined.

What is sent to all tasks: at most TOP shingles, those of hot postings among them
once more, and a bitmap of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .components import components
from .session import id_text, remove, written

#: Heavy hitters: shingles that a task counts at once, those it names, those that count.
COUNTED, NAMED, TOP = 1_500_000, 32_768, 262_144
#: Sets in which a frequent shingle may stand before its posting is dealt in slices of so many.
HOT = 4_096
#: Expected members of a block of the matrix.
BLOCK = 64
_LOW = np.uint64((1 << 60) - 1)


def _sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle hash) of each text's set, by row."""
    doc, value = K.shingles(K.Words(texts, lower=True), k)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])] if len(doc) else np.zeros(0, bool)
    return doc[new], value[new]


def _heavy(k: int):
    def name(held):
        value, count = np.unique(np.concatenate(held), return_counts=True)
        some = np.flatnonzero(count >= 2)
        some = some[np.lexsort((value[some], -count[some]))][:NAMED]
        return pa.record_batch([pa.array(K.signed(value[some])), pa.array(count[some])], ["h", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in K.chunks(batch):
                doc, value = K.shingles(K.Words(part.column("text"), lower=True), k)
                held.append(value)
                size += len(value)
                if size >= COUNTED:
                    yield name(held)
                    held, size = [], 0
        if held:
            yield name(held)

    return run


def heavy_shingles(base: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Frequent shingles, their class 1..7, and how often tasks have named them; at most TOP of them."""
    top = base.mapInArrow(_heavy(k), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "h").limit(TOP).toArrow()
    value = top["h"].to_numpy().view(np.uint64)
    order = np.argsort(value)
    count = top["c"].to_numpy()[order]
    return value[order], np.clip(np.log2(np.maximum(count, 1)) / 2, 1, 7).astype(np.uint64), count


def hot_postings(spark, heavy: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """(h, slices) of the keys that stand in so many sets that their posting is dealt to several tasks; at most TOP rows."""
    value, rank, count = heavy
    some = count > HOT
    h = K.signed((value[some] >> np.uint64(4)) | (rank[some] << np.uint64(60)))
    return spark.createDataFrame(list(zip(h.tolist(), (-(-count[some] // HOT)).tolist())), "h long, slices long")


def _need(n, percent):
    return -(-n * percent // 100)


def _prefixes(heavy, k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rank = heavy.value[:2]
        for batch in batches:
            for part in K.chunks(batch):
                rows = part.num_rows
                doc, value = _sets(part.column("text"), k)
                key = value >> np.uint64(4)
                if len(common):
                    at = np.minimum(np.searchsorted(common, value), len(common) - 1)
                    key |= np.where(common[at] == value, rank[at], np.uint64(0)) << np.uint64(60)
                key = K.signed(key)
                order = np.lexsort((key, doc))
                n = np.bincount(doc, minlength=rows)
                sums = [np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)]
                full = np.flatnonzero(n)
                first = np.r_[0, np.cumsum(n)[:-1]]
                for out, salt in zip(sums, (1, 2)):
                    if len(full):
                        out[full] = np.add.reduceat(K.mix(value * np.uint64(2 * salt + 1) + np.uint64(salt)), first[full])
                size = np.where(n > 0, n - _need(n, percent) + 1, 0)
                offsets = np.r_[0, np.cumsum(size)]
                take = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - first, size)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(key[order][take]))
                common_share = np.r_[0, np.cumsum(key[order][take] >> 60)]
                core = 100 * (common_share[offsets[1:]] - common_share[offsets[:-1]]) // np.maximum(size, 1)
                yield pa.record_batch([part.column("doc_id"), part.column("rid"), pa.array(n), pa.array(K.signed(sums[0])), pa.array(K.signed(sums[1])), pa.array(core), lists], ["doc_id", "rid", "n", "k1", "k2", "core", "prefix"])

    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, slice, rep, n, slack) in order: those of postings with two members or more, with the first member.

    A slice of a hot posting has a number from 1, and all its rows are kept: there are others elsewhere.
    """
    last = None  # h, rep, n, slack of the row before, its posting's first member and size, and whether that row waits for a second
    for batch in batches:
        if not batch.num_rows:
            continue
        h, rep, n, slack, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "rep", "n", "slack", "slice"))
        head = np.r_[last is None or (h[0], part[0]) != (last[0], last[7]), (h[1:] != h[:-1]) | (part[1:] != part[:-1])]
        heads = np.flatnonzero(head)
        at = np.cumsum(head)
        pivot = np.r_[last[4] if last else 0, rep[heads]][at]
        size = np.r_[last[5] if last else 0, n[heads]][at]
        shared = ~head
        shared[:-1] |= ~head[1:]
        shared |= part > 0
        out = [h[shared], rep[shared], n[shared], slack[shared], pivot[shared], size[shared]]
        if last and last[6] and not head[0]:
            out = [np.r_[v, x] for v, x in zip(last, out)]
        last = (h[-1], rep[-1], n[-1], slack[-1], pivot[-1], size[-1], bool(head[-1]) and not part[-1], part[-1])
        if len(out[0]):
            yield pa.record_batch([pa.array(x) for x in out], ["h", "rep", "n", "slack", "pivot", "pn"])


def may_link(shared, na, nb, percent: int):
    """Whether sets of na and nb members can link when their prefixes have `shared` tokens in common.

    The prefix that ends first in the order is known in full on both sides,
    so at most its other members are common as well.
    """
    rest = F.greatest(F.ceil(na * percent / 100), F.ceil(nb * percent / 100)) - 1
    return (100 + percent) * (shared + rest) >= percent * (na + nb)


def alike_in_size(na, low, high, percent: int):
    return (100 * high >= percent * na) & (100 * na >= percent * low)


def least_shared(na, low, high, percent: int) -> tuple:
    """(overlap, shared): what a set of na members and one of low..high need to link.

    Linked sets have `overlap` tokens in common at least.  Then, of the tokens
    from which a set has more than overlap - shared left (itself included),
    they have `shared` in common, whatever that number; it is chosen so that
    those tokens lie within both prefixes.
    """
    overlap = F.ceil((na + low) * percent / (100 + percent))
    return overlap, 1 + F.greatest(F.floor((overlap - F.ceil(F.greatest(na, high) * percent / 100)) / 4), F.lit(0))


def meeting(rows: DataFrame, keys: list[str], na, low, high, slack_a, slack_b, percent: int) -> DataFrame:
    """The keys of joined (token) rows with as many shared tokens as a link needs."""
    overlap, shared = least_shared(na, low, high, percent)
    near = rows.where(alike_in_size(na, low, high, percent)).where((slack_a > overlap - shared) & (slack_b > overlap - shared))
    return near.groupBy(*keys).agg(F.count("*").alias("s"), F.first(shared).alias("need")).where("s >= need").select(*keys)


def _linked(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text_a"):
                rows = part.num_rows
                (da, va), (db, vb) = (_sets(part.column(c), k) for c in ("text_a", "text_b"))
                doc, value = np.r_[da, db], np.r_[va, vb]
                order = np.lexsort((value, doc))
                doc, value = doc[order], value[order]
                twice = doc[1:][(doc[1:] == doc[:-1]) & (value[1:] == value[:-1])]
                shared = np.bincount(twice, minlength=rows)
                either = np.bincount(doc, minlength=rows) - shared
                keep = pa.array((100 * shared >= percent * either) & (shared > 0))
                yield pa.record_batch([part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])

    return run


def _named(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = K.Bloom(bits.value)
        for batch in batches:
            yield batch.filter(pa.array(some.has(batch.column("rid").to_numpy(zero_copy_only=False))))

    return run


def compared(base: DataFrame, pairs: DataFrame, k: int, percent: int, repeated: bool = False, log2_bits: int | None = None) -> DataFrame:
    """The pairs (a, b) of rids whose whole texts link.  Only texts named by a pair are shuffled.

    repeated: a rid may stand more than once, and is then taken once.  Else both
    joins have nothing but an exchange on either side, which Spark can split.
    """
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "named")
    bits = base.sparkSession.sparkContext.broadcast(K.bloom(ids, "id", log2_bits))
    remove(ids)
    some = base.select("rid", "text").mapInArrow(_named(bits), "rid long, text string")
    some = some.dropDuplicates(["rid"]) if repeated else some
    left = some.select(F.col("rid").alias("a"), F.col("text").alias("text_a"))
    right = some.select(F.col("rid").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(_linked(k, percent), "a long, b long")


def similar_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id: a row per document.

    class_id is the smallest doc_id with the same set; component_id the
    smallest doc_id reachable by links.  Texts are taken whole, A-Z lower-cased,
    words are `[^\\x20\\x09-\\x0D]+`; fewer than k words are one shingle.  A null,
    empty or blank text has no shingle and links with nothing, itself apart.
    Rows without doc_id are left out; repeated rows come out alike; rows of one
    doc_id with different texts are documents of their own, each in the class and
    component of its text; other columns are ignored.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    base = id_text(docs).withColumn("rid", F.xxhash64("doc_id", "text"))
    heavy = spark.sparkContext.broadcast(heavy_shingles(base, k))
    sets = written(base.mapInArrow(_prefixes(heavy, k, percent), "doc_id long, rid long, n long, k1 long, k2 long, core long, prefix array<long>").withColumn("row", F.monotonically_increasing_id()), "sets")
    classes = written(sets.where("n > 0").groupBy("k1", "k2", "n").agg(F.min(F.struct("doc_id", "rid", "row")).alias("f")).select("k1", "k2", "n", F.col("f.doc_id").alias("first"), F.col("f.rid").alias("rep"), F.col("f.row").alias("row")), "classes")
    reps = sets.join(classes.select("row"), "row", "left_semi").select(F.col("rid").alias("rep"), "n", "core", "prefix")
    rows = reps.select(F.posexplode("prefix").alias("i", "h"), "rep", "n", "core").select("h", "rep", "n", (F.col("n") - F.col("i")).alias("slack"), "core")
    hot = hot_postings(spark, heavy.value)
    rows = rows.join(F.broadcast(hot), "h", "left").withColumn("slice", F.coalesce(F.pmod(F.xxhash64("rep"), "slices") + 1, F.lit(0))).drop("slices")
    rows = rows.repartition("h", "slice").sortWithinPartitions("h", "slice", F.desc("core"), "rep")
    postings = written(rows.mapInArrow(_postings, "h long, rep long, n long, slack long, pivot long, pn long"), "postings")

    # first members of the slices of a hot posting link to one of them
    own = postings.where("rep = pivot").join(F.broadcast(hot.select("h")), "h", "left_semi")
    lead = own.groupBy("h").agg(F.min(F.struct("rep", "n")).alias("l")).select("h", F.col("l.rep").alias("pivot"), F.col("l.n").alias("pn"))
    bridges = own.select("h", "rep", "n", "slack").join(lead, "h").select(postings.columns)
    star = postings.unionByName(bridges).where((F.col("rep") != F.col("pivot")) & alike_in_size(F.col("n"), F.col("pn"), F.col("pn"), percent))
    star = star.groupBy(F.col("rep").alias("a"), F.col("pivot").alias("b"), "n", "pn").agg(F.count("*").alias("s")).where(may_link(F.col("s"), F.col("n"), F.col("pn"), percent))
    close = written(star.select("a", "b"), "pairs")
    repeated = not sets.groupBy("rid").agg(F.count("*").alias("c")).where("c > 1").isEmpty()
    links = written(compared(base, close, k, percent, repeated), "near")
    grouped = components(links)

    # the matrix: blocks of components, and the documents that meet blocks of others
    member = postings.join(grouped.select(F.col("node").alias("rep"), "component"), "rep", "left").select("h", "rep", "n", "slack", F.coalesce("component", "rep").alias("c"))
    member = written(member, "members")
    mixed = member.groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("h")
    sizes = grouped.groupBy(F.col("component").alias("c")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    row = member.join(mixed, "h", "left_semi").join(sizes, "c", "left").select("h", "rep", "n", "slack", "c", F.pmod(F.xxhash64("rep"), F.coalesce("blocks", F.lit(1))).alias("g"))
    row = written(row, "mixed")
    group = row.groupBy("c", "g").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("rep").alias("one"), (F.min("rep") < F.max("rep")).alias("many"))
    union = row.groupBy("h", "c", "g").agg(F.max("slack").alias("left"))
    matrix = written(union.join(group, ["c", "g"]), "matrix")
    query = row.select("h", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("slack").alias("sa"), F.col("c").alias("qc"))
    meet = query.join(matrix, "h").where(F.col("qc") < F.col("c"))
    meet = meeting(meet, ["a", "c", "g", "one", "many"], F.col("na"), F.col("low"), F.col("high"), F.col("sa"), F.col("left"), percent)
    opened = written(meet, "opened")
    inside = row.select("h", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("slack").alias("sb"), "c", "g").join(opened.where("many").select("a", "c", "g"), ["c", "g"])
    inside = inside.join(query.select("h", "a", "na", "sa"), ["h", "a"])
    inside = meeting(inside, ["a", "b"], F.col("na"), F.col("nb"), F.col("nb"), F.col("sa"), F.col("sb"), percent)
    cross = opened.where("not many").select("a", F.col("one").alias("b")).union(inside)
    seen = close.union(close.select("b", "a"))
    cross = written(cross.join(seen, ["a", "b"], "left_anti"), "pairs")
    more = compared(base, cross, k, percent, repeated)
    final = components(links.select("a", "b").union(more)).withColumnRenamed("node", "rep")

    grouped = written(classes.join(final, "rep", "left").select("k1", "k2", "n", "first", F.coalesce("component", "rep").alias("c")), "of-component")
    least = grouped.groupBy("c").agg(F.min("first").alias("component"))
    of_class = written(grouped.join(least, "c").select("k1", "k2", "n", F.col("first").alias("rep"), "component"), "of-class")
    out = sets.select("doc_id", "n", "k1", "k2").join(of_class, ["k1", "k2", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("class_id"), F.coalesce("component", "doc_id").alias("component_id"))
