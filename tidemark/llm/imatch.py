"""I-Match fingerprints with randomised lexicon subsets, in DataFrame functions only.

Terms are the runs of letters and digits of the lower-cased text.  Their
document frequencies are counted over all documents, by the term's 64-bit hash;
the lexicon is the terms whose inverse document frequency, as a share of the
largest possible one, lies in a band.  No task gets the lexicon: a document's
terms are looked up by what is outside the band.

* Terms above it are few: of N documents with D different terms each, at most
  D * N**0.15 stand in more than N**0.85 documents.  A session variable holds
  their hashes, in buckets, so that plans print none.
* Terms below it stand in N**0.03 documents or fewer, which is one or two at any
  size: the count of a term also keeps the smallest and the largest doc_id it
  was seen in, and so every document gets a note of its own rare terms.
* An edited text has terms of both documents it is made of, and a few around
  its cuts that neither may have.  Those are joined with the lexicon, and the
  strangers among them are noted as well.

I-Match hashes the sorted distinct terms that a document has in a lexicon.  A
fingerprint holds that hash for

* the whole lexicon, and DROPS randomised lexicons that each leave out a quarter
  of the terms, by their hashes: every term of a document, however long, is in
  about three quarters of these hashes.  Documents that share one of them differ
  at most in terms that it leaves out.
* thin lexicons (level, slot), which take each term with chance 2**-level.  A
  document of m lexicon terms uses the two levels next to log2 m, at which a
  thin lexicon holds about one of its terms, and SLOTS of each: a sample of some
  32 to 64 terms, in which terms that change spoil the lexicons they fall in and
  leave the others equal.  They grade likeness where all larger lexicons differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .session import id_text, remove, written

#: Band of ln(N / df) / ln(N); lexicons that leave out a quarter; thin lexicons of a level.
BAND, DROPS, SLOTS = (0.15, 0.97), 8, 32
#: Characters on each side of a cut whose terms are looked up.
WINDOW = 40
TERM_BREAK = r"[^\p{L}\p{N}]+"
#: Documents of a stretch of ids on average, and stretches at most.
STRETCH, STRETCHES = 1000, 32_768


def _hashes(text: str) -> Column:
    return F.expr(f"transform(split(lower({text}), r'{TERM_BREAK}'), t -> if(t = '', null, xxhash64(t)))")


def _occurrences(base: DataFrame) -> DataFrame:
    """(doc_id, h): a text's different terms."""
    return base.select("doc_id", F.explode(F.array_distinct(F.array_compact(_hashes("text")))).alias("h"))


class Lexicon:
    """The terms of a band: `terms` (h) as a table, those above it as a constant, those below it by document.

    A query keeps the constant of its own analysis.
    """

    def __init__(self, docs: DataFrame, band: tuple[float, float] = BAND) -> None:
        base = id_text(docs)
        n = float(max(base.count(), 2))
        seen = _occurrences(base).groupBy("h").agg(F.count("*").alias("df"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        self.counts = written(seen, "imatch-terms")
        share = F.log(F.lit(n) / F.col("df")) / F.log(F.lit(n))
        self.terms = self.counts.where((share >= band[0]) & (share <= band[1])).select("h")
        often, rare = self.counts.where(share < band[0]).select("h"), self.counts.where(share > band[1])
        # the least count in the band tells whether two ids name all documents of a rare term
        most = (rare.agg(F.max("df").alias("m")).first().m or 0)
        if most <= 2:
            self.rare = rare.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("doc_id"), "h")
        else:
            self.rare = _occurrences(base).join(rare.select("h"), "h").select("doc_id", "h")
        spark, buckets = docs.sparkSession, max(1, 2 * often.count())
        spark.sql("DECLARE OR REPLACE VARIABLE tidemark_often ARRAY<ARRAY<BIGINT>>")
        some = often.groupBy(F.pmod("h", F.lit(buckets)).alias("i")).agg(F.collect_list("h").alias("x"))
        every = spark.range(buckets).select(F.col("id").alias("i")).join(some, "i", "left")
        row = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", F.coalesce("x", F.array().cast("array<bigint>")).alias("x")))), lambda y: y.x).alias("v"))
        spark.sql("SET VARIABLE tidemark_often = (SELECT v FROM {row})", row=row)
        self.often = F.expr("session.tidemark_often")

    def notes(self, more: DataFrame | None = None) -> DataFrame:
        """(doc_id, note): the hashes that no text of a document has in the lexicon, of rare terms and of more (doc_id, h)."""
        rows = self.rare if more is None else self.rare.unionByName(more)
        return rows.groupBy("doc_id").agg(F.collect_set("h").alias("note"))


def _terms(text: str, often: Column, note: str) -> Column:
    """Sorted distinct hashes of the terms of a text that are neither above the band nor noted (a null note: none)."""
    known = F.filter(F.array_distinct(_hashes(text)), lambda h: h.isNotNull() & ~F.array_contains(F.get(often, F.pmod(h, F.size(often).cast("long")).cast("int")), h))
    return F.sort_array(F.array_except(known, F.expr(f"coalesce({note}, cast(array() as array<bigint>))")))


def _level(terms: str) -> str:
    return f"cast(ceil(log2(greatest(size({terms}), 1))) as int)"


def _slot(level: str) -> str:
    return f"(shiftrightunsigned(t, 22) & (shiftleft(1L, {level}) - 1))"


def _print(chosen: str, level: str) -> str:
    """SQL: 'level.slot.hash' of the subsets of a level that hold a term, from the few terms in the subsets used."""
    slot = _slot(level)
    of_slot = f"transform(array_distinct(transform({chosen}, t -> {slot})), s -> struct(s as s, filter({chosen}, t -> {slot} = s) as g))"
    return f"sort_array(transform({of_slot}, x -> concat_ws('.', {level}, x.s, right(hex(xxhash64(x.g)), 8))))"


def _larger(terms: str) -> str:
    """SQL: array of the hash of all terms and of those that each lexicon does not leave out (two bits of the term's hash are not 0)."""
    left = f"transform(sequence(0, {2 * DROPS - 2}, 2), b -> filter({terms}, t -> shiftrightunsigned(t, b) & 3 <> 0))"
    return f"concat(array(concat('all.', hex(xxhash64({terms})))), transform({left}, (g, i) -> concat_ws('.', i, if(size(g) = 0, '-', hex(xxhash64(g))))))"


def fingerprint_of(df: DataFrame, text: str, often: Column, note: str, out: str) -> DataFrame:
    """df with columns out, an array of 'level.slot.hash' at two levels, and out_whole: 'all.hash' of all lexicon terms, then 'i.hash' of each lexicon that leaves out a quarter, '-' where none is left."""
    df = df.withColumn("_t", _terms(text, often, note)).withColumn("_l", F.expr(_level("_t")))
    df = df.withColumns({name: F.expr(f"filter(_t, t -> {_slot(level)} < {SLOTS})") for name, level in (("_high", "_l"), ("_low", "greatest(_l - 1, 0)"))})
    return df.withColumn(out, F.expr(f"if(_l = 0, {_print('_high', '_l')}, concat({_print('_low', '(_l - 1)')}, {_print('_high', '_l')}))")).withColumn(f"{out}_whole", F.expr(_larger("_t"))).drop("_t", "_l", "_high", "_low")


def likeness(a: str, b: str, whole_a: str, whole_b: str) -> Column:
    """0 to 1 for two fingerprints: the share of equal hashes, of the lexicons that leave out a quarter, or of the thin ones at the better of their common levels.

    The larger share counts; thin lexicons are those that either uses, and one
    more.  It is 1 if and only if the hashes of all lexicon terms are equal, also of none.
    """
    levels = f"array_intersect(transform({a}, x -> substring_index(x, '.', 1)), transform({b}, x -> substring_index(x, '.', 1)))"
    at = lambda v: f"filter({v}, x -> substring_index(x, '.', 1) = l)"
    slots = lambda v: f"transform({at(v)}, x -> substring_index(x, '.', 2))"
    thin = f"transform({levels}, l -> size(array_intersect({at(a)}, {at(b)})) / (size(array_union({slots(a)}, {slots(b)})) + 1))"
    large = f"size(filter(array_intersect({whole_a}, {whole_b}), x -> not endswith(x, '-'))) / {DROPS + 1}D"
    return F.expr(f"cast(case when get({whole_a}, 0) = get({whole_b}, 0) then 1 else greatest(coalesce(array_max({thin}), 0), {large}) end as double)")


def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """doc_id, text, fingerprint, fingerprint_whole (arrays of strings); equal texts have equal ones, texts without lexicon terms an empty one."""
    lexicon = Lexicon(docs, band)
    noted = id_text(docs).join(lexicon.notes(), "doc_id", "left")
    return fingerprint_of(noted, "text", lexicon.often, "note", "fingerprint").select("doc_id", "text", "fingerprint", "fingerprint_whole")


def _stretches(base: DataFrame) -> tuple[list[int], dict[int, int]]:
    """Lower ends of stretches of ids, ascending, and the largest id of each stretch that has one."""
    n = base.count()
    parts = max(1, min(STRETCHES, n // STRETCH))
    ends = sorted(set(base.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 20 * parts).alias("q")).first().q or [])) if parts > 1 else []
    rows = base.groupBy(_stretch(ends).alias("s")).agg(F.max("doc_id").alias("m")).collect()
    return ends, {r.s: r.m for r in rows}


def _stretch(ends: list[int]) -> Column:
    """How many ends are at most doc_id, by halving."""
    if not ends:
        return F.lit(0)
    bounds = f"from_json('[{','.join(map(str, ends))}]', 'array<bigint>')"
    step = f"if(get({bounds}, (a.lo + a.hi) div 2) <= doc_id, named_struct('lo', (a.lo + a.hi) div 2 + 1, 'hi', a.hi), named_struct('lo', a.lo, 'hi', (a.lo + a.hi) div 2))"
    return F.expr(f"aggregate(sequence(1, {len(ends).bit_length()}), named_struct('lo', 0L, 'hi', {len(ends)}L), (a, i) -> if(a.lo < a.hi, {step}, a), a -> cast(a.lo as int))")


def with_next(docs: DataFrame, notes: DataFrame | None = None) -> tuple[DataFrame, Window]:
    """doc_id, text, note, next_text: a row's note, and the text of the next row by descending doc_id; after the last comes the first.

    Rows are dealt by stretches of ids.  The largest id of a stretch is the
    follower of the stretch above, and is sent there as well (column ghost);
    so there is one shuffle and no single sorted partition.  Notes (doc_id, note)
    are dealt along, and stand before the texts of their doc_id.  Callers drop
    ghosts after windows over the second value.
    """
    base = id_text(docs)
    ends, largest = _stretches(base)
    some = sorted(largest)
    above = dict(zip(some, [*some[1:], some[0]])) if some else {}
    none = F.lit(None).cast("struct<id: bigint, hashes: array<bigint>>")
    own = base.withColumn("_note", none)
    if notes is not None:
        own = own.unionByName(notes.select("doc_id", F.lit(None).cast("string").alias("text"), F.struct(F.col("doc_id").alias("id"), F.col("note").alias("hashes")).alias("_note")))
    own = own.withColumn("s", _stretch(ends))
    pairs = ",".join(f'"{m}":{above[s]}' for s, m in largest.items())
    ghost = F.try_element_at(F.from_json(F.lit("{" + pairs + "}"), "map<string,int>"), F.col("doc_id").cast("string"))
    places = F.array_compact(F.array(F.struct(F.col("s"), F.lit(False).alias("ghost")), F.when(ghost.isNotNull(), F.struct(ghost.alias("s"), F.lit(True).alias("ghost")))))
    placed = own.withColumn("at", F.explode(places)).select("doc_id", "text", "_note", "at.s", "at.ghost")
    order = Window.partitionBy("s").orderBy("ghost", F.desc("doc_id"), F.col("text").asc_nulls_first())
    held = F.last("_note", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("_held", held).where("text IS NOT NULL")
    placed = placed.withColumn("note", F.when(F.col("_held.id") == F.col("doc_id"), F.col("_held.hashes"))).drop("_held", "_note")
    return placed.withColumn("next_text", F.lead("text").over(order)), order


def _cut(rows: DataFrame) -> DataFrame:
    """rows (n_chars, text, next_text) with head and piece: what the edited text keeps, and what follows it."""
    return rows.withColumns({"head": F.expr("substring(text, 1, int(n_chars - n_chars div 3))"), "piece": F.expr("substring(coalesce(next_text, ''), 1, int(n_chars div 3))")})


def _strangers(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, h): terms around the cuts of a document's edited text that are not in the lexicon.

    A window of WINDOW characters on either side of a cut has all terms that the
    cut can change, if it has three; else the text on that side is taken whole.
    """
    rows = _cut(with_next(docs)[0].where(~F.col("ghost")).withColumn("n_chars", F.length("text").cast("long")))
    few = lambda c: f"size(split(lower({c}), r'{TERM_BREAK}')) < 5"
    right, left = (lambda c: f"if({few(f'right({c}, {WINDOW})')}, {c}, right({c}, {WINDOW}))"), (lambda c: f"if({few(f'left({c}, {WINDOW})')}, {c}, left({c}, {WINDOW}))")
    rows = rows.select("doc_id", F.expr(f"concat({right('head')}, {left('piece')})").alias("joint"), F.expr(right("piece")).alias("end"))
    found = rows.select("doc_id", F.explode(F.array_distinct(F.array_compact(F.concat(_hashes("joint"), _hashes("end"))))).alias("h"))
    return found.join(lexicon.terms, "h", "left_anti").select("doc_id", "h")


def compared_with_edits(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint (arrays), both with _whole (arrays), near_edited, near_next.

    The edited text has its last third (rounded down, in code points) replaced
    by the beginning of the next text by descending doc_id.  A null text is
    empty; rows without doc_id are left out; rows of one doc_id follow each
    other by text; other columns are ignored; no rows give no rows.
    """
    lexicon = Lexicon(docs, band)
    notes = written(lexicon.notes(_strangers(docs, lexicon)), "imatch-notes")
    remove(lexicon.counts)
    rows, order = with_next(docs, notes)
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("next_note", F.lead("note").over(order))
    rows = _cut(rows).withColumn("edited", F.concat("head", "piece")).drop("next_text", "head", "piece")
    rows = rows.withColumn("notes", F.expr("concat(coalesce(note, cast(array() as array<bigint>)), coalesce(next_note, cast(array() as array<bigint>)))")).drop("next_note")
    rows = fingerprint_of(fingerprint_of(rows, "text", lexicon.often, "note", "fingerprint"), "edited", lexicon.often, "notes", "edited_fingerprint").drop("note", "notes")
    rows = rows.withColumns({"_next": F.lead("fingerprint").over(order), "_next_whole": F.lead("fingerprint_whole").over(order)}).where(~F.col("ghost"))
    edited = likeness("fingerprint", "edited_fingerprint", "fingerprint_whole", "edited_fingerprint_whole")
    following = likeness("fingerprint", "coalesce(_next, fingerprint)", "fingerprint_whole", "coalesce(_next_whole, fingerprint_whole)")
    return rows.select("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "fingerprint_whole", "edited_fingerprint_whole", edited.alias("near_edited"), following.alias("near_next"))


def near_pairs_key(df: DataFrame, column: str = "fingerprint") -> DataFrame:
    """A row per (doc_id, subset hash): documents that share one are candidates for near copies."""
    return df.select("doc_id", F.explode(column).alias("key"))
