import hashlib
import random
import re
import time

from tidemark.llm import pii
from tidemark.llm.pii import digest, find_personal_data, redact
from tidemark.llm.queries import queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - (9 if int(c) > 4 else 0)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    text = text or ""
    out = []
    for k, (p, ok) in enumerate([(EMAIL, lambda m: True), (IP, lambda m: all(int(x) <= 255 for x in m.split("."))), (CARD, lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)), (PHONE, lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15)]):
        out += [(m.start(), k, m.end()) for m in p.finditer(text) if ok(m[0])]
    out.sort()
    names = ("email", "ip", "card", "phone")
    counts = tuple(sum(k == i for _, k, _ in out) for i in range(4))
    return (*counts, hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in out).encode()).hexdigest()), {f"{names[k]}:{a}:{b}" for a, k, b in out}


TEXTS = [
    None, "", "é😀 a.b@c.d 10.0.0.1", "a@b.c@d.e a@b.c_x@d.e @x.y a@b", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4 00000000000000000001.1.1.1 9999999999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 41111111111111111111 49927398716 30569309025904", "+1 (743) 555-3824 +12 +1234567890123456 +49 30 123456-78. +1--------2 +1 (212) 555-1212)",
    "1" * 60_000, "a" * 60_000 + "@b.c", "x" * 50_000, "+" + "1 " * 20_000, "😀" * 3000 + "me@here.org" + "é" * 100, "call (415) 555-2671 or mail joe [at] example [dot] com, ssn 123-45-6789", "iban DE89 3704 0044 0532 0130 00 ok",
    "12-34 5.6.7.8-9 a-4111111111111111@x.y.", "1.1.1.1" * 5, "card 4111 1111 1111 1112 now", "2001:0db8:0000:0000:0000:ff00:0042:8329",
]


def test_base_spans(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a@b.c"), (2, TEXTS[2])]
    got = digest(find_personal_data(spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, c int").repartition(3))).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        want, spans = brute(TEXTS[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want, TEXTS[r.doc_id][:80]
        assert spans <= set(r.spans.split(",")) or not spans


def test_added_spans_are_real_places(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] * 3, "doc_id long, text string")
    for r in find_personal_data(df).collect():
        base = [(x.start, x.end) for x in r.base]
        for x in r.spans:
            assert 0 <= x.start < x.end <= len(TEXTS[r.doc_id])
            assert (x.start, x.end) in base or not any(a < x.end and x.start < b for a, b in base)


def test_em_finds_reliable_labelers():
    rows = [((1, 1, 0, 0, 1), 300), ((1, -1, 0, 0, 1), 40), ((-1, -1, 0, -1, -1), 200), ((-1, 1, 0, 0, -1), 30), ((1, 1, 1, 0, 1), 50)]
    post, table, prior = pii.em(rows)
    assert post[0] > 0.95 and post[4] > 0.95 and post[2] < 0.05 and 0.3 < prior < 0.9
    assert table[0][1][1] > 0.9 > 0.1 > table[0][0][1]
    w = pii.classifier([(0, v, (2, 1, 0), c) for v, c in rows], post)
    score = lambda v: sum(w.get(f, 0.0) for f in pii._features(0, v, (2, 1, 0)))
    assert score(rows[0][0]) > 0 > score(rows[2][0])


def test_numbers_that_fail_their_check_digits_need_context(spark):
    good = [4111111111111111, 5500005555555559, 4012888888881881, 378282246310005]
    rows = [(i, f"word {good[i % 4]} word") for i in range(40)] + [(100 + i, f"word {4111111111111112 + 10 * i} word") for i in range(40)] + [(200 + i, f"pay by credit card: {good[i % 4]} now") for i in range(20)]
    got = {r.doc_id: len(r.spans) for r in find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    fails = {100 + i for i in range(40) if not luhn(str(4111111111111112 + 10 * i))}
    assert len(fails) > 30 and not any(got[i] for i in fails) and all(got[i] == 1 for i in (*range(40), *range(200, 220)))


def test_redaction_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "é me@x.org and 10.0.0.1!", "en", "s", 24), (2, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in redact(df, find_personal_data(df)).collect()}
    assert out[1].text == "é <email> and <ip>!" and out[1].n_chars == len(out[1].text) and out[2].text is None
    odd = spark.createDataFrame([(1, "a@b.cc " * 1500 + "é" * 3000, 5, "q"), (1, "x", 6, "q"), (None, "a@b.cc", 7, "q"), (2, "1.1.1.1-4.4.4.4", 8, "q")], "doc_id long, text string, tag int, _pii0 string")
    out = sorted((r.doc_id, r.text, r.tag, r._pii0) for r in redact(odd, find_personal_data(odd)).collect())
    assert out == [(1, "<email> " * 1500 + "é" * 3000, 5, "q"), (1, "x", 6, "q"), (2, "<ip>-<ip>", 8, "q")]
    empty = spark.createDataFrame([], df.schema)
    assert find_personal_data(empty).count() == 0


def test_query_on_table(spark):
    path = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    df = queries()["op3_pii_weak_supervision"](spark, path)
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())
    got = df.collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == brute(docs[r.doc_id])[0]


def test_overlaps_and_redaction_against_brute_force(spark):
    r = random.Random(8)
    bits = ["a@b.cc", "4111 1111 1111 1111", "+1 (743) 555-3824", "415-555-2671", "10.0.0.1", "DE89 3704 0044 0532 0130 00", "123-45-6789", "joe [at] example [dot] com", "é😀", "\n", "call", "x" * 700, "9" * 13]
    rows = [(i, r.choice(["", " ", "-"]).join(r.choice(bits) for _ in range(r.choice([1, 5, 40])))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = find_personal_data(df)
    got, text = {r.doc_id: r for r in found.collect()}, dict(rows)
    for d, f in got.items():
        assert f"{brute(text[d])[0]}" and [(x.start, x.k, x.end) for x in f.base] == sorted((a, pii.KINDS.index(k), b) for k, a, b in (x.split(":") for x in brute(text[d])[1]) for a, b in [(int(a), int(b))])
        base = [(x.start, x.end) for x in f.base]
        assert all((x.start, x.end) in base or not any(a < x.end and x.start < b for a, b in base) for x in f.spans)
    for x in redact(df, found).collect():
        out, at = "", 0
        for s in sorted(got[x.doc_id].spans, key=lambda s: (s.start, s.k, s.end)):
            if s.start >= at:
                out += text[x.doc_id][at : s.start] + f"<{pii.KINDS[s.k]}>"
            at = max(at, s.end)
        assert x.text == out + text[x.doc_id][at:]


def test_many_matches_take_time_in_proportion(spark):
    numbers = lambda n: " ".join(str(10**5 + i) for i in range(n))

    def seconds(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        began = time.time()
        pii.candidates(df).write.format("noop").mode("overwrite").save()
        return time.time() - began

    seconds([numbers(1000)] * 20)
    many, one = seconds([numbers(1000)] * 20), seconds([numbers(20_000)])
    assert one < 2 * many + 1
    mails = " ".join(f"user{i}@mail{i % 7}.example.org" for i in range(20_000))
    phones = " ".join(f"415-555-{i:04}" for i in range(9000))
    df = spark.createDataFrame([(1, numbers(150_000)), (2, mails), (3, phones)], "doc_id long, text string")
    began = time.time()
    found = find_personal_data(df)
    assert {r.doc_id: r.n for r in found.selectExpr("doc_id", "size(base) as n").collect()} == {1: 0, 2: 20_000, 3: 0}
    out = {r.doc_id: r.text for r in redact(df, found).collect()}
    assert out[2] == " ".join(["<email>"] * 20_000) and out[1] == numbers(150_000)
    assert time.time() - began < 60
