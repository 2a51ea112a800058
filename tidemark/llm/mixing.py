"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic) whose tokens are summed
over all documents.  Raking scales the cells in turn so that their totals by
source, by language and by topic meet the target shares.  A cell's ratio of
raked to real tokens, times a common scale, is the chance of its documents;
the scale is such that, with chances capped at one, `keep` of all tokens are
expected.  Documents are drawn by a hash of their id, so a run repeats.

Topics are clusters: every document becomes a vector of DIMS whole numbers from
the hashes of its longer words, and TURNS rounds of k-means run over the vectors
of all documents.  Sums are whole numbers, so that a run repeats exactly; what
leaves the cluster is a sum and a count for each topic.  Topics start from a
few documents (SEEDS, those with the smallest id hashes), the farthest from
those taken before.

Cells are far fewer than documents.  Up to CELLS of them are raked on the
driver, and sent to all tasks; more are raked as a table, and joined.  Both take
the same steps, to the same closeness.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .session import id_text, remove, written

DIMENSIONS = ("source", "lang", "topic")
#: Numbers of a document's vector, rounds of k-means, documents that topics may start from.
DIMS, TURNS, SEEDS = 64, 6, 512
#: Topics; powers that real shares are raised to for target shares (1: as they are, 0: all equal); expected share of tokens.
TOPICS, POWERS, KEEP = 8, {"source": 0.7, "lang": 0.7, "topic": 0.5}, 0.8
#: Cells that the driver rakes; rounds at most; largest relative error of a marginal at which raking ends.
CELLS, ROUNDS, CLOSE = 100_000, 60, 1e-6
NONE = "(none)"


def unit(seed: int) -> Column:
    """A number in (0, 1) for a doc_id, from the first 52 bits of a keyed digest."""
    return (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "doc_id").cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


_DESCRIBED = "doc_id long, source string, lang string, tokens long, vector binary"


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in K.chunks(batch):
            words = K.Words(part.column("text"), lower=True)
            rows = part.num_rows
            long = np.flatnonzero(words.end - words.start > 4)
            place = (words.hash[long] % np.uint64(DIMS)).astype(np.int64)
            sign = 1.0 - 2.0 * ((words.hash[long] >> np.uint64(40)) & np.uint64(1)).astype(float)
            v = np.bincount(words.doc[long] * DIMS + place, sign, rows * DIMS).astype(float).reshape(rows, DIMS)
            size = np.sqrt((v * v).sum(axis=1, keepdims=True))
            v = np.rint(127 * np.divide(v, size, out=np.zeros_like(v), where=size > 0)).astype(np.int8)
            yield pa.record_batch([*(part.column(c) for c in ("doc_id", "source", "lang")), pa.array(words.counts), _packed(v)], ["doc_id", "source", "lang", "tokens", "vector"])


def _packed(v: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(DIMS), len(v), [None, pa.py_buffer(np.ascontiguousarray(v))]).cast(pa.binary())


def _unpacked(column: pa.Array) -> np.ndarray:
    return K.flat(column)[0].view(np.int8).reshape(-1, DIMS)


def nearest(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The place of the centre with the largest product (ties: the first); -1 for a vector of zeros."""
    if not len(centres):
        return np.full(len(v), -1)
    return np.where(v.any(axis=1), (v.astype(np.int64) @ centres.astype(np.int64).T).argmax(axis=1), -1)


def scaled(sums: np.ndarray) -> np.ndarray:
    """Whole-number centres of one length, from sums."""
    size = np.sqrt((sums.astype(float) ** 2).sum(axis=1, keepdims=True))
    return np.rint(1000 * np.divide(sums, size, out=np.zeros(sums.shape), where=size > 0)).astype(np.int64)


def _sums(centres):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres.value), DIMS), np.int64)
        for batch in batches:
            v = _unpacked(batch.column("vector"))
            topic = nearest(v, centres.value)
            for t in range(len(total)):
                total[t] += v[topic == t].sum(axis=0, dtype=np.int64)
        yield pa.record_batch([pa.array(np.repeat(np.arange(len(total)), DIMS)), pa.array(np.tile(np.arange(DIMS), len(total))), pa.array(total.ravel())], ["t", "i", "s"])

    return run


def topic_centres(rows: DataFrame, topics: int = TOPICS) -> np.ndarray:
    """Centres of the vectors of rows (a written table); fewer than `topics` where documents do not differ."""
    spark = rows.sparkSession
    some = rows.where(F.col("vector") != F.lit(bytearray(DIMS))).select("doc_id", "vector").orderBy(F.xxhash64("doc_id"), "doc_id", "vector").limit(SEEDS).toArrow()
    v = _unpacked(some["vector"].combine_chunks()).astype(np.int64)
    centres = scaled(v[:1])
    while 0 < len(centres) < topics:
        far = (scaled(v) @ centres.T).max(axis=1)
        if far.min() > 0.999e6:
            break
        centres = np.concatenate([centres, scaled(v[far.argmin()][None])])
    for _ in range(TURNS if len(centres) > 1 else 0):
        found = rows.select("vector").mapInArrow(_sums(spark.sparkContext.broadcast(centres)), "t long, i long, s long").groupBy("t", "i").agg(F.sum("s").alias("s")).toArrow()
        sums = np.zeros(centres.shape, np.int64)
        sums[found["t"].to_numpy(), found["i"].to_numpy()] = found["s"].to_numpy()
        new = np.where(sums.any(axis=1, keepdims=True), scaled(sums), centres)
        if (new == centres).all():
            break
        centres = new
    return centres


def _topics(centres):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            topic = nearest(_unpacked(batch.column("vector")), centres.value)
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "source", "lang")), pa.array(topic.astype(str), pa.string()), batch.column("tokens")], ["doc_id", *DIMENSIONS, "tokens"])

    return run


def described(docs: DataFrame, topics: int = TOPICS, topic_column: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens (words).

    topic is that column of docs, or the number of the nearest topic centre (no
    word of five bytes or more: -1).  Null sources, languages and topics are
    '(none)'; a null text has no tokens.
    """
    base = id_text(docs.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(NONE)) for c in {"source", "lang", *filter(None, [topic_column])}}), keep=["source", "lang", *filter(None, [topic_column])])
    if topic_column:
        told = base.withColumnRenamed(topic_column, "topic") if topic_column not in ("source", "lang") else base.withColumn("topic", F.col(topic_column))
        return told.select("doc_id", *DIMENSIONS, F.size(F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), 0)).cast("long").alias("tokens"))
    rows = written(base.mapInArrow(_vectors, _DESCRIBED), "vectors")
    centres = rows.sparkSession.sparkContext.broadcast(topic_centres(rows, topics))
    return rows.mapInArrow(_topics(centres), "doc_id long, source string, lang string, topic string, tokens long")


def target_shares(totals: dict[str, float], power: float, wanted: dict[str, float] | None = None) -> dict[str, float]:
    """Target shares, of a sum of one, of the names that have tokens.

    Without wanted ones, real shares raised to a power.  Else the wanted shares
    of the names that they list; names that they do not list divide what is left
    of one, in proportion to their raised real shares.
    """
    real = sum(totals.values())
    raised = {k: (v / real) ** power for k, v in totals.items() if v > 0} if real else {}
    if wanted:
        rest = max(0.0, 1 - sum(wanted.values()))
        open_ = sum(v for k, v in raised.items() if k not in wanted)
        raised = {k: wanted[k] if k in wanted else rest * v / open_ for k, v in raised.items()}
    whole = sum(raised.values())
    return {k: v / whole if whole else 0.0 for k, v in raised.items()}


def rake(cells: np.ndarray, index: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Cell values whose sums by each index are the targets (of equal sum), from the given values."""
    x = cells.astype(float)
    for _ in range(rounds):
        worst = 0.0
        for i, goal in zip(index, targets):
            have = np.bincount(i, x, len(goal))
            factor = np.divide(goal, have, out=np.ones_like(goal), where=have > 0)
            worst = max(worst, float(np.abs(factor[have > 0] - 1).max(initial=0)))
            x = x * factor[i]
        if worst < CLOSE:
            break
    return x


def scale_for(sums, goal: float) -> float:
    """s at which sum(tokens * min(1, s * ratio)) is goal, where sums(s) gives (tokens of s * ratio >= 1, tokens * ratio of the others).

    Cells that are full at one s stay full at the next, so steps end at the
    exact scale.
    """
    s, before = 0.0, -1.0
    while s > before:
        full, rest = sums(s)
        if rest <= 0:
            return s if s else 1.0
        s, before = max((goal - full) / rest, s), s
    return s


def _raked_on_driver(cells: DataFrame, powers: dict, keep: float, targets: dict) -> DataFrame:
    rows = cells.orderBy(*DIMENSIONS).toPandas()
    tokens = rows["tokens"].to_numpy(float)
    index, goals = [], []
    for d in DIMENSIONS:
        names, i = np.unique(rows[d].to_numpy(str), return_inverse=True)
        sums = np.bincount(i, tokens, len(names))
        shares = target_shares(dict(zip(names, sums)), powers[d], targets.get(d))
        index.append(i)
        goals.append(np.array([shares.get(n, 0.0) for n in names]) * tokens.sum())
    raked = rake(tokens, index, goals)
    ratio = np.divide(raked, tokens, out=np.zeros_like(raked), where=tokens > 0)

    def sums(s: float) -> tuple[float, float]:
        full = s * ratio >= 1
        return tokens[full].sum(), (tokens * ratio)[~full].sum()

    rows["chance"] = np.minimum(1.0, scale_for(sums, keep * tokens.sum()) * ratio)
    rows.loc[tokens == 0, "chance"] = 1.0
    return cells.sparkSession.createDataFrame(rows[[*DIMENSIONS, "chance"]], "source string, lang string, topic string, chance double")


def _raked_as_table(cells: DataFrame, powers: dict, keep: float, targets: dict) -> DataFrame:
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    x = written(cells.withColumn("x", F.col("tokens").cast("double")), "cells")
    goals = {}
    for d in DIMENSIONS:
        share = cells.groupBy(d).agg(F.sum("tokens").alias("t")).where("t > 0").withColumn("g", F.pow(F.col("t") / total, F.lit(float(powers[d]))))
        if wanted := targets.get(d):
            told = F.create_map(*(F.lit(v) for kv in wanted.items() for v in (kv[0], float(kv[1]))))
            share = share.withColumn("w", F.try_element_at(told, F.col(d)))
            open_ = share.where("w is null").agg(F.sum("g")).first()[0] or 1.0
            share = share.withColumn("g", F.coalesce("w", F.col("g") / open_ * max(0.0, 1 - sum(wanted.values()))))
        whole = share.agg(F.sum("g")).first()[0] or 1.0
        goals[d] = written(share.select(d, (F.col("g") / whole * total).alias("g")), "goals")
    for _ in range(ROUNDS):
        worst, before = 0.0, x
        for d in DIMENSIONS:
            factor = x.groupBy(d).agg(F.sum("x").alias("have")).where("have > 0").join(goals[d], d).select(d, (F.col("g") / F.col("have")).alias("f"))
            factor = written(factor, "factors")
            worst = max(worst, factor.agg(F.max(F.abs(F.col("f") - 1))).first()[0] or 0.0)
            x = x.join(factor, d, "left").withColumn("x", F.col("x") * F.coalesce("f", F.lit(1.0))).drop("f")
        x = written(x, "cells")
        remove(before)
        if worst < CLOSE:
            break
    x = x.withColumn("r", F.when(F.col("tokens") > 0, F.col("x") / F.col("tokens")).otherwise(0.0))

    def sums(s: float) -> tuple[float, float]:
        full = F.lit(s) * F.col("r") >= 1
        a, b = x.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("tokens") * F.col("r")))).first()
        return float(a or 0), b or 0.0

    s = scale_for(sums, keep * total)
    return x.select(*DIMENSIONS, F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.lit(s) * F.col("r"))).otherwise(1.0).alias("chance"))


def mixed(docs: DataFrame, powers: dict | None = None, keep: float = KEEP, topics: int = TOPICS, seed: int = 11, targets: dict[str, dict[str, float]] | None = None, topic_column: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens, chance, sampled: a row per document.

    targets: by 'source', 'lang' and 'topic' the wanted shares of tokens (see
    target_shares); a dimension without any gets its real shares raised to its
    power.  Names without tokens are passed over.  Cells without tokens have
    chance 1.  Rows without doc_id are left out, repeated rows come out alike,
    other columns are ignored, an empty table gives no rows.
    """
    powers = POWERS | (powers or {})
    rows = written(described(docs, topics, topic_column), "mixing")
    cells = written(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    if cells.count() <= CELLS:
        chances = F.broadcast(_raked_on_driver(cells, powers, keep, targets or {}))
    else:
        chances = _raked_as_table(cells, powers, keep, targets or {})
    return rows.join(chances, list(DIMENSIONS)).select("doc_id", *DIMENSIONS, "tokens", "chance", (unit(seed) < F.col("chance")).alias("sampled"))
