import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tidemark.llm.packing import Encoder, Plan, pack_documents
from tidemark.llm.queries import queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_layout(rows, size=4096):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def want_pieces(rows, size=4096):
    t = Tokenizer.from_file(PATH)
    out = []
    for d, text in rows:
        if d is None:
            continue
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        for i, a in enumerate(range(0, len(ids), size)):
            part = ids[a : a + size]
            out.append((d, i, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out)


def check_encoder(e, texts):
    ids, at = e.batch(pa.array([*texts, None]))
    for text, a, b in zip([*texts, ""], at[:-1], at[1:]):
        assert ids[a:b].tobytes() == e.whole(text), text


def test_encoder_equals_whole_texts():
    e = Encoder(PATH)
    odd = ["it's 12 o'clock", "É́A b́", "a\x1cb c", "x\x85y", "ΑΣ ΑΣ Σ", "<|endoftext|> a", "日本 語　x", "é\ń", "", " ", "!!a!! 3.14 I'LL don't", "​q​ w", "a﻿b", "İstanbul I", "ẞ ﬁ Ǆ x<|endoftext|>y a\x00b a\x7fb\xa0c \u2003z"]
    check_encoder(e, odd)


def test_encoder_with_little_memory(monkeypatch):
    monkeypatch.setattr("tidemark.llm.packing.REMEMBERED", 7)
    e, r = Encoder(PATH), random.Random(2)
    for _ in range(30):
        check_encoder(e, [" ".join(r.choice(["The", "the.", "it's", "ÉTÉ,", "été", "3.5", "don't!!", "日本", "'rest", "!'s", "e\u0301x"]) + r.choice("abcé'.,;4") for _ in range(r.randrange(12))) for _ in range(10)])


def test_plan_places_everything():
    r = random.Random(1)
    for counts in [{}, {4096: 7}, {2048: 5, 1024: 3}, {1: 10000, 4095: 3}, {r.randrange(1, 4097): r.randrange(1, 50) for _ in range(900)}]:
        p = Plan.best(counts)
        filled = {}
        for n, a, b, first, offset in p.slots:
            for i in range(b - a):
                filled.setdefault(first + i, []).append((offset, n))
        for parts in filled.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= 4096
        assert p.used == counts and len(filled) == p.sequences
        total = sum(n * c for n, c in counts.items())
        big = sum(c for n, c in counts.items() if n > 2048)
        assert p.sequences <= max(-(-total // 4096) * 1.02 + 1, big + 1)


def test_documents(spark):
    rows = [(None, "a"), (1, None), (2, ""), (3, "word " * 9000), (4, "x"), (4, "x"), (5, "it's fine " * 300)] + [(10 + i, "hot " * 99) for i in range(200)]
    got = pack_documents(spark.createDataFrame([(a, b, "n") for a, b in rows], "doc_id long, text string, length string").repartition(4), PATH).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want_pieces(rows)
    check_layout(got)
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query_on_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = queries()["op4_best_fit_packing"](spark, path).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want_pieces(rows)
    total = sum(r.length for r in got)
    assert check_layout(got) <= -(-total // 4096) + 1
