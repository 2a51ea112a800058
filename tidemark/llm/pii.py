"""Personal data spans by weak supervision, in DataFrame functions only.

Four base kinds have fixed patterns and checks; what they find always stands.
Wider patterns propose more spans (written-out addresses, national phone
numbers, card-like digit runs, IPv6, bank and social security numbers).  Five
labelers vote on every candidate, base or not, +1, -1 or 0:

    regex      the strict pattern and its check digits
    gazetteer  known top-level domains, dialling codes, card issuers, countries
    context    words before the span that speak for the kind, or for another
    shape      runs of one or two digits only
    border     letters or digits right next to the span

Expectation-maximisation (a two-class latent model for each kind, one
reliability a labeler and kind) runs on the table of candidates by kind, votes
and shape, which has at most 6 * 3**5 * 8 * 4 * 2 rows whatever the input, and
which is all that reaches the driver.  Its posteriors train a logistic
classifier over votes, votes by kind, and what no labeler sees: length, number of
separators, whether a label or line begins before the span.  Written as one
expression, it accepts or refuses the further candidates.

A span's place comes from the pieces that the text falls into when split at the
matches, so places are counted in code points and need no row-wise code.  Running
sums and maxima over a text's spans take log2(n) passes over the array, and never
an array or text that grows by one span a step: work is n log n in the matches.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .session import tagged, written

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
#: The base patterns.  Possessive, and begun only where a run begins (or where the
#: last match ended), which gives the same matches in linear time and flat stack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
#: Runs of 13 digits or more of CARD: a shorter one starts no longer one further on.
LONG = CARD.replace(")++", "){12,}+")
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: name, kind, pattern, a character or string that a text must have, base or not
PATTERNS = (
    ("email", "email", EMAIL, "@", True),
    ("ip", "ip", IP, ".", True),
    ("card", "card", LONG, None, True),
    ("phone", "phone", PHONE, "+", True),
    ("email2", "email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++", "at", False),
    ("ip2", "ip", r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])", ":", False),
    ("phone2", "phone", r"(?<![0-9A-Za-z+.-])\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])", None, False),
    ("iban", "iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])", None, False),
    ("ssn", "ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", "-", False),
)
#: Gazetteers (fixed values).
TLDS = "com org net edu gov mil int info biz io dev app de fr es it nl uk eu ch at be se no dk fi pl pt us ca au nz jp cn in br mx"
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
COUNTRIES = "AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LI LT LU LV MT NL NO PL PT RO SE SI SK"
#: Words before a span that speak for its kind (English, French, German, Spanish), and for none.
FOR = {
    "email": "e-?mail|mail|contact|courriel|correo|kontakt|address",
    "ip": "ip|host|server|address|adresse|router|client|from|login",
    "card": "card|visa|mastercard|amex|carte|karte|tarjeta|credit|payment",
    "phone": "phone|tel|call|mobile|fax|whatsapp|t[ée]l[ée]phone|telefon|tel[ée]fono|contact",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "ssn": "ssn|social|security",
}
AGAINST = "version|isbn|order|invoice|ref|page|section|build|release|item|serial|part"
_SPAN = "struct<start:int,k:int,end:int,base:boolean,v1:int,v2:int,v3:int,v4:int,v5:int,len:int,sep:int,lead:int>"
VOTES = ("v1", "v2", "v3", "v4", "v5")
#: Code points of a block of text, when it is cut at many places.
BLOCK = 1024


def _lit_list(words: str) -> str:
    return ", ".join(f"'{w}'" for w in words.split())


def _quoted(pattern: str) -> str:
    """The pattern as a raw SQL string."""
    if "'" in pattern:
        raise ValueError("no apostrophes in patterns")
    return f"r'{pattern}'"


def _strict(name: str) -> str:
    """SQL over c.m (the match) and c.d (its digits): the strict check of a pattern."""
    return {
        "email": "true",
        "ip": r"forall(split(c.m, r'\.'), p -> length(ltrim('0', p)) <= 3 and int(concat('0', right(ltrim('0', p), 3))) <= 255)",
        "card": f"length(c.d) between 14 and 19 and {_luhn()}",
        "phone": "length(c.d) between 10 and 15",
        "iban": "length(replace(c.m, ' ', '')) between 15 and 32",
    }.get(name, "true")


def _luhn() -> str:
    """Every second digit from the right, the last not, is doubled and its digits added."""
    digit = "cast(substring(c.d, length(c.d) - i + 1, 1) as int)"
    return f"aggregate(sequence(1, length(c.d)), 0, (a, i) -> a + if(i % 2 = 1, {digit}, 2 * {digit} - if({digit} > 4, 9, 0))) % 10 = 0"


def _gazetteer(kind: str) -> str:
    return {
        "email": f"lower(regexp_extract(c.m, r'([A-Za-z]+)$', 1)) in ({_lit_list(TLDS)})",
        "ip": "contains(c.m, ':') or int(right(concat('000', regexp_extract(c.m, '^([0-9]+)', 1)), 3)) between 1 and 223",
        "card": "c.d rlike '^(4|5[1-5]|2[2-7]|3[47]|6011|65)'",
        "phone": f"not startswith(c.m, '+') or substring(c.d, 1, 1) in ({_lit_list(CODES)}) or substring(c.d, 1, 2) in ({_lit_list(CODES)})",
        "iban": f"substring(c.m, 1, 2) in ({_lit_list(COUNTRIES)})",
        "ssn": "not (c.d rlike '^(000|666|9)') and not (c.d rlike '^...00') and not (c.d rlike '0000$')",
    }[kind]


def _let(value: str, name: str, body: str) -> str:
    """SQL: body with a name for value, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _running(values: str, pick: str, nothing: str, back: bool = False) -> str:
    """SQL: for each place of an array of INT, pick (of a and b) over it and all before, or from it on; doubling steps."""
    far = "i + shiftleft(1, p)" if back else "i - shiftleft(1, p)"
    both = pick.replace("$a", "v").replace("$b", f"if({far} between 0 and size(x) - 1, get(x, {far}), {nothing})")
    return f"aggregate(sequence(0, cast(ceil(log2(size({values}) + 1)) as int)), {values}, (x, p) -> if(shiftleft(1, p) < size(x), transform(x, (v, i) -> {both}), x))"


def _candidates(name: str, kind: str, base: bool) -> str:
    """SQL: the matches m_name and pieces s_name of a text as an array of _SPAN."""
    places = f"transform(m_{name}, (m, i) -> length(get(s_{name}, i)) + length(m))"
    found = f"struct(get(ends, i) - length(m) as start, m as m, regexp_replace(m, '[^0-9]', '') as d, right(get(s_{name}, i), 40) as l, left(get(s_{name}, i + 1), 1) as r)"
    placed = _let(places, "steps", _let(_running("steps", "$a + $b", "0"), "ends", f"transform(m_{name}, (m, i) -> {found})"))
    strict = _strict(name)
    k = KINDS.index(kind)
    context = f"case when lower(c.l) rlike {_quoted(rf'(?:^|[^a-z])(?:{FOR[kind]})[^0-9@]*$')} then 1 when lower(c.l) rlike {_quoted(rf'(?:^|[^a-z])(?:{AGAINST})[^a-z]*$')} then -1 else 0 end"
    few = "length(c.d) > 5 and size(array_distinct(transform(sequence(1, least(length(c.d), 40)), i -> substring(c.d, i, 1)))) <= 2"
    border = "if(c.l rlike '[0-9A-Za-z]$' or c.r rlike '^[0-9A-Za-z]', -1, 1)"
    votes = f"if({strict}, 1, -1) as v1, if({_gazetteer(kind)}, 1, -1) as v2, {context} as v3, if({few}, -1, 0) as v4, {border} as v5"
    shape = "least(length(c.m) div 4, 7) as len, least(length(regexp_replace(c.m, '[0-9A-Za-z]', '')), 3) as sep, if(c.l rlike r'(?:^|[:=(\n])[ \t]*$', 1, 0) as lead"
    keep = f"filter({placed}, c -> {strict if name not in ('card',) else 'length(c.d) between 13 and 19'})"
    is_base = f"({strict})" if base else "false"
    built = f"transform({keep}, c -> struct(c.start as start, {k} as k, c.start + length(c.m) as end, {is_base} as base, {votes}, {shape}))"
    return f"if(size(m_{name}) > 0, {built}, cast(array() as array<{_SPAN}>))"


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, tag, c: every candidate span of a text with its votes, by place (a null text has none); tag as in tagged()."""
    out = tagged(docs)
    for name, _, pattern, needs, _ in PATTERNS:
        found = f"regexp_extract_all(text, {_quoted(pattern)}, 0)"
        out = out.withColumn(f"m_{name}", F.expr(f"if(contains(text, '{needs}'), {found}, cast(array() as array<string>))" if needs else found))
    out = out.withColumns({f"s_{n}": F.expr(f"if(size(m_{n}) > 0, split(text, {_quoted(p)}, -1), null)") for n, _, p, _, _ in PATTERNS}).drop("text")
    return out.select("doc_id", "tag", F.array_sort(F.flatten(F.array(*[F.expr(_candidates(n, k, b)) for n, k, _, _, b in PATTERNS]))).alias("c"))


#: Prior shares of a check's votes for what is no personal data (one digit in ten fits by chance), and for what is.
CHECK = ({-1: 0.9, 0: 0.0, 1: 0.1}, {-1: 0.01, 0: 0.0, 1: 0.99})


def em(rows: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[list[float], list[list[dict[int, float]]], float]:
    """Two-class latent model over (votes, count): posteriors of each row, P(vote | class) by labeler, the prior.

    It starts from a weighted majority, in which the first labeler, the pattern's
    own check, counts most.  Where that check tells candidates apart, its
    reliability has a prior (CHECK) as heavy as the candidates themselves: votes
    that are alike for all candidates could otherwise be shared out at will.
    """
    if not rows:
        return [], [], 0.5
    labelers = range(len(rows[0][0]))
    post = [min(0.95, max(0.05, 0.5 + 0.4 * v[0] + 0.1 * sum(v[1:]))) for v, _ in rows]
    table, prior = [], 0.5
    checked = sum(c for _, c in rows) if {v[0] for v, _ in rows} >= {-1, 1} else 0
    for _ in range(rounds):
        total = sum(c for _, c in rows)
        mass = sum(p * c for p, (_, c) in zip(post, rows))
        prior = (mass + 1) / (total + 2)
        table = []
        for j in labelers:
            seen = [{x: 1.0 + (checked * CHECK[k][x] if j == 0 else 0.0) for x in (-1, 0, 1)} for k in (0, 1)]
            for p, (v, c) in zip(post, rows):
                seen[1][v[j]] += p * c
                seen[0][v[j]] += (1 - p) * c
            table.append([{k: x / sum(s.values()) for k, x in s.items()} for s in seen])
        new = []
        for v, _ in rows:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[j][1][v[j]] / table[j][0][v[j]]) for j in labelers)
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        moved = max(abs(a - b) for a, b in zip(post, new))
        post = new
        if moved < 1e-6:
            break
    return post, table, prior


FIELDS = ("len", "sep", "lead")


def _features(k: int, votes: tuple[int, ...], shape: tuple[int, ...]) -> list[tuple[str, int]]:
    """(field, value) of a candidate; a value of a field with a kind stands for both: kind * 100 + value + 1."""
    return [("k", k), *((f, k * 100 + x + 1) for f, x in zip(FIELDS, shape)), *zip(VOTES, votes), *((f"k_{v}", k * 100 + x + 1) for v, x in zip(VOTES, votes))]


def classifier(rows: list[tuple[int, tuple[int, ...], tuple[int, ...], int]], post: list[float], rounds: int = 200) -> dict[tuple[str, int], float]:
    """Weights of a logistic model over (field, value), fitted to posteriors of (kind, votes, shape, count).

    Every row has one value in each field, so a round is one lookup and one
    counting of a matrix of places, whatever the number of rows.
    """
    if not rows:
        return {}
    names: dict[tuple[str, int], int] = {}
    at = np.array([[names.setdefault(f, len(names)) for f in _features(k, votes, shape)] for k, votes, shape, _ in rows])
    share = np.log1p([r[3] for r in rows])
    share, want, weights = share / share.sum(), np.asarray(post), np.zeros(len(names))
    for _ in range(rounds):
        wrong = (want - 1 / (1 + np.exp(-np.clip(weights[at].sum(axis=1), -30, 30)))) * share
        weights += 2.0 * np.bincount(at.ravel(), np.repeat(wrong, at.shape[1]), len(names)) - 0.001 * weights
    return {f: float(weights[i]) for f, i in names.items()}


def _score(weights: dict[tuple[str, int], float]) -> str:
    parts = []
    for field in ("k", *FIELDS, *VOTES, *(f"k_{v}" for v in VOTES)):
        cases = "".join(f" when {v} then {w!r}D" for (f, v), w in sorted(weights.items()) if f == field)
        name = field.removeprefix("k_")
        value = f"x.{field}" if field == "k" or field in VOTES else f"x.k * 100 + x.{name} + 1"
        parts.append(f"case {value}{cases} else 0D end" if cases else "0D")
    return " + ".join(parts)


def _joined(spans: str) -> Column:
    """kind:start:end of an array of spans, by start, then kind as listed."""
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform(array_sort(transform({spans}, x -> struct(x.start, x.k, x.end))), x -> concat_ws(':', get(array({kinds}), x.k), x.start, x.end)), ',')")


def posteriors(rows: list[tuple[int, tuple[int, ...], tuple[int, ...], int]]) -> list[float]:
    """Of each row (kind, votes, shape, count) the chance that it is personal data, each kind with a model of its own."""
    counts: dict[int, dict[tuple[int, ...], int]] = {}
    for k, votes, _, c in rows:
        of_kind = counts.setdefault(k, {})
        of_kind[votes] = of_kind.get(votes, 0) + c
    found = {}
    for k, of_kind in counts.items():
        patterns = sorted(of_kind.items())
        found |= {(k, votes): p for (votes, _), p in zip(patterns, em(patterns)[0])}
    return [found[k, votes] for k, votes, _, _ in rows]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, tag, base, spans: arrays of (start, k, end) by kind index, places in code points, end exclusive.

    base holds the fixed kinds' spans; spans holds them and those the method
    adds, which never overlap a base span.  Null and empty texts have none.
    Rows without doc_id are left out, repeated rows come out alike, rows of one
    doc_id are told apart by tag, the hash of their text; other columns are
    ignored, an empty table gives no rows.
    """
    found = written(candidates(docs), "pii")
    names = ("k", *VOTES, *FIELDS)
    one = found.select(F.explode("c").alias("x")).groupBy(*[f"x.{n}" for n in names]).agg(F.count("*").alias("c")).collect()
    rows = sorted((r.k, tuple(r[v] for v in VOTES), tuple(r[f] for f in FIELDS), r["c"]) for r in one)
    weights = classifier(rows, posteriors(rows))
    # the furthest end of base spans that start no later, the nearest start of those that start no earlier
    reach = _running("transform(c, x -> if(x.base, x.end, 0))", "greatest($a, $b)", "0")
    ahead = _running("transform(c, x -> if(x.base, x.start, 2147483647))", "least($a, $b)", "2147483647", back=True)
    taken = f"x.base or (get(reach, i) <= x.start and get(ahead, i) >= x.end and {_score(weights)} > 0)"
    some = "exists(c, x -> not x.base)"
    every = _let(reach, "reach", _let(ahead, "ahead", f"filter(c, (x, i) -> {taken})"))
    return found.select("doc_id", "tag", F.expr("filter(c, x -> x.base)").alias("base"), F.expr(f"if({some}, {every}, c)" if weights else "c").alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    counts = [F.expr(f"cast(size(filter(base, x -> x.k = {KINDS.index(k)})) as long)").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with every span's text replaced by <kind>; overlapping spans are replaced as one, under the first one's kind.

    n_chars, where there is one, follows the new text.  Rows without doc_id
    have no spans that could be known, and are left out; each of the others
    gets the spans of its own text.
    """
    names = iter(f"_pii{i}" for i in range(len(docs.columns) + 3))
    tag, spans, blocks = (next(n for n in names if n not in docs.columns) for _ in range(3))
    some = found.where(F.size("spans") > 0).dropDuplicates(["doc_id", "tag"])
    some = some.select("doc_id", F.col("tag").alias(tag), F.expr("array_sort(transform(spans, x -> struct(x.start, x.k, x.end)))").alias(spans))
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    # a span that starts before an earlier one's end belongs to it
    heads = f"filter(transform({spans}, (x, i) -> struct(if(i = 0, 0, get(reach, i - 1)) as a, x.start as b, x.k as k)), y -> y.a <= y.b)"
    cut = f"if(y.a div {BLOCK} = y.b div {BLOCK}, substring(get({blocks}, y.a div {BLOCK}), y.a % {BLOCK} + 1, y.b - y.a), concat(substring(get({blocks}, y.a div {BLOCK}), y.a % {BLOCK} + 1), array_join(slice({blocks}, y.a div {BLOCK} + 2, y.b div {BLOCK} - y.a div {BLOCK} - 1), ''), coalesce(substring(get({blocks}, y.b div {BLOCK}), 1, y.b % {BLOCK}), '')))"
    parts = f"transform({heads}, y -> concat({cut}, '<', get(array({kinds}), y.k), '>'))"
    tail = _let("cast(struct(element_at(reach, -1) as a, length(text) as b) as struct<a:int,b:int>)", "y", cut)
    new = _let(_running(f"transform({spans}, x -> x.end)", "greatest($a, $b)", "0"), "reach", f"concat(array_join({parts}, ''), {tail})")
    out = docs.where("doc_id is not null").withColumn(tag, F.hash(F.coalesce("text", F.lit("")))).join(some, ["doc_id", tag], "left")
    out = out.withColumn(blocks, F.expr(f"if({spans} is null, null, regexp_extract_all(text, '(?s).{{1,{BLOCK}}}', 0))"))
    out = out.withColumn("text", F.expr(f"if({spans} is null, text, {new})"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns) if "n_chars" in docs.columns else out.select(docs.columns)
