"""Groups of spelling variants, by anagram keys.

A word's key is the sum of a power of each of its letters, so that it does not
depend on their order.  Two words that differ by one letter have keys that differ
by that letter's value (one added or removed) or by the difference of two values
(one for another).  Every word is listed under its whole key, and under its key
less each of its letters; a join of that list with itself finds one-letter
additions, removals and exchanges alike.  The order of letters is verified from
their first difference on.

Words of few letters in all orders share a key.  Where more than CROWD rows stand
under one, rows are told apart by a hash of the letters that are left, in their
order, as well: no near word is lost, and what is joined stays near words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .session import id_text, written

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of which h is a multiple lose a letter; least length and occurrences of a word; how much more frequent a form is.
MISSPELT, LENGTH, TIMES, RATIO = 199, 6, 5, 5
#: A letter's value is its code point to this power; keys are sums of values modulo a prime, so that long words stay in a long.
POWER, MODULUS = 5, (1 << 61) - 1
#: Letters of words that are compared by the edit distance.
SHORT = 64
#: Rows of one key that are joined without regard to the order of letters.
CROWD = 256


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts, with their occurrences."""
    run = id_text(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    run = run.select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    spelt = run.select(F.when(F.col("h") % MISSPELT == 0, less).otherwise(F.col("run")).alias("word"))
    return spelt.where(F.char_length("word") >= LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= TIMES)


def letter_value(letter: Column) -> Column:
    """A letter's code point to the power, below the modulus for all letters up to U+00FF."""
    point = F.ascii(letter).cast("long")
    return reduce(lambda a, b: a * b, [point] * POWER)


def anagram_key(letters: Column) -> Column:
    return F.aggregate(letters, F.lit(0).cast("long"), lambda s, c: (s + letter_value(c)) % MODULUS)


def _letters(word) -> Column:
    return F.filter(F.split(word, ""), lambda c: c != "")


def one_letter_apart(a: str, b: str) -> Column:
    """Whether two different words are alike but for one letter.

    Short ones by Spark's edit distance, whose time grows with the product of
    their lengths; long ones from the first difference on, in time that grows with their length.
    """
    at = F.array_position(F.zip_with(_letters(a), _letters(b), lambda x, y: ~x.eqNullSafe(y)), True).cast("int")
    more = F.char_length(a) - F.char_length(b)
    rest_a = F.substr(a, F.when(more < 0, at).otherwise(at + 1))
    rest_b = F.substr(b, F.when(more > 0, at).otherwise(at + 1))
    linear = (F.abs(more) <= 1) & (rest_a == rest_b)
    return F.when(F.greatest(F.char_length(a), F.char_length(b)) <= SHORT, F.levenshtein(a, b, 1) == 1).otherwise(linear)


def listed(words: DataFrame) -> DataFrame:
    """(key, way, order, cut, word, n): each word under its key (cut ''), and under its key less each letter.

    way and order are empty but for crowded keys.  There a word is listed for
    additions ('added': by a hash of the letters left, the first of equal letters
    in a run cut) and for exchanges ('exchanged': with the place of the gap).
    """
    word = words.select("word", "n", _letters("word").alias("letters"), anagram_key(_letters("word")).alias("whole"))
    cuts = F.transform(F.concat(F.array(F.lit("")), F.array_distinct("letters")), lambda c: F.struct(c.alias("cut"), F.when(c == "", F.col("whole")).otherwise((F.col("whole") - letter_value(c) + MODULUS) % MODULUS).alias("key")))
    plain = written(word.select("word", "n", F.inline(cuts)).select("key", "cut", "word", "n"), "keys")
    crowded = written(plain.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > CROWD).select("key"), "crowded")
    if crowded.isEmpty():
        return plain.select("key", F.lit("").alias("way"), F.lit(0).cast("long").alias("order"), "cut", "word", "n")
    some = plain.join(crowded, "key", "left_semi")
    place = some.where("cut <> ''").select("key", "cut", "word", "n", F.posexplode(_letters("word")).alias("at", "letter")).where("letter = cut")
    left = F.concat(F.substr("word", F.lit(1), F.col("at")), F.substr("word", F.col("at") + 2))
    first = (F.col("at") == 0) | (F.substr("word", F.col("at"), F.lit(1)) != F.col("cut"))
    added, exchanged = F.lit("added").alias("way"), F.lit("exchanged").alias("way")
    exact = [
        some.where("cut = ''").select("key", added, F.xxhash64("word").alias("order"), "cut", "word", "n"),
        place.where(first).select("key", added, F.xxhash64(left).alias("order"), "cut", "word", "n"),
        place.select("key", exchanged, F.xxhash64("at", left).alias("order"), "cut", "word", "n"),
    ]
    few = plain.join(crowded, "key", "left_anti").select("key", F.lit("").alias("way"), F.lit(0).cast("long").alias("order"), "cut", "word", "n")
    return reduce(DataFrame.union, exact, few)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words that differ by one letter, both ways, once each."""
    rows = written(listed(words), "listed")
    other = rows.select("key", "way", "order", F.col("cut").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = rows.join(other, ["key", "way", "order"]).where("cut <> other AND (way <> 'added' OR cut = '' OR other = '')")
    return met.where(one_letter_apart("word", "near")).select("word", "n", "near", "near_n")


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root): the last form that forms lead to, by doubling steps; every form is more frequent, so there are no rings."""
    step = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = written(step.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        step = further.select("word", "root")
        if further.where("moved").isEmpty():
            return step


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root: a row for each word of all texts.

    Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), of which only
    A-Z are lower-cased, with 6 letters and 5 occurrences or more; a run whose
    crc32 with its doc_id is a multiple of 199 loses one letter first.  Near words
    differ by one inserted, deleted or replaced letter.  A word's form is its most
    frequent near word (ties: the first in code-point order) if that is 5 times as
    frequent or more; root is where forms end, the word itself if it has none.
    Null and empty texts have no words; rows without doc_id are left out; repeated
    rows count as often as they stand; other columns are ignored; a table without
    words gives no rows.
    """
    word = written(words(docs), "words")
    best = near_words(word).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.rank")).alias("form_n"))
    kept = F.col("form_n") >= RATIO * F.col("n")
    rows = written(word.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(kept, F.col("form")).alias("form"), F.when(kept, F.col("form_n")).alias("form_n")), "forms")
    root = rooted(rows.where("form IS NOT NULL"))
    return rows.join(root, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
