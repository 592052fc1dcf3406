"""Byte-level BPE against the tokenizers library, collocations and hard negatives
against plain Python."""

import hashlib
import json
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import bpe_speculative as B
from cohortlens.llm import collocations as C
from cohortlens.llm import hard_negatives as H

TRICKY = ["a", "aa", "'s", "'", "''", " ", "  ", "\n", "\t", "é", "ß", "1", "२", "½", "!", "?", "..", "<|endoftext|>", "<|", "'re", "'l", "İ", " ", " ", "​", "字", "😀", "\U0001d400", "\x00", "\x85", "᠎", "ing", "tion", "zzzz", "====", "----"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(B.public_vocabulary(B.VOCABULARY))


def ids_of(own: B.Codec, texts: list[str]) -> list[list[int]]:
    return [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)]


def same(library, texts: list[str]) -> None:
    own = B.codec()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(own, texts) == want
    assert [own.decode(np.asarray(x, "<u4").tobytes()) for x in want] == [library.decode(x, skip_special_tokens=False) for x in want]


def test_ids_of_random_texts_equal_the_library(library):
    rng = random.Random(1)
    same(library, ["".join(rng.choice(TRICKY) for _ in range(rng.randrange(25))) for _ in range(3000)])
    same(library, ["".join(rng.choice("abcehinorst") for _ in range(rng.randrange(30))) for _ in range(3000)])
    same(library, ["".join(rng.choice("ab -=") * rng.randrange(1, 40) for _ in range(5)) for _ in range(500)])


def test_every_character_of_the_first_planes_equals_the_library(library):
    same(library, [f"a{c}1{c}!{c} {c}{c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x1FFFF, 3)])])


def test_speculation_fails_and_is_mended():
    """Words whose greedy longest match is not what merging gives exist, and both ways of merging agree."""
    m = B.codec().merges
    rng = random.Random(2)
    words = list({"".join(rng.choice("ehinorstau") for _ in range(rng.randrange(2, 70))).encode() for _ in range(2000)})
    coded, failed = m.encode_words(words)
    assert 0 < failed < len(words)
    for w, ids in zip(words, coded):
        exact = m._merge_long([m.single[b] for b in w])
        assert m._merge_short([m.single[b] for b in w]) == exact == np.frombuffer(ids, "<u4").tolist()


def test_compatible_pairs_are_those_that_stay_apart(library):
    m = B.codec().merges
    rng = np.random.default_rng(3)
    tokens = [k for k in m.proposed.values() if len(m.bytes_of[k]) > 1]
    u, v = (rng.choice(tokens, 4000) for _ in range(2))
    said = m.compatible(u, v)
    for a, b, ok in zip(u.tolist(), v.tolist(), said.tolist()):
        assert (m.merge(m.bytes_of[a] + m.bytes_of[b]) == [a, b]) == ok


def test_long_texts_are_cut_where_words_end(library, monkeypatch):
    monkeypatch.setattr(B, "WINDOW", 50)
    rng = random.Random(4)
    texts = ["".join(rng.choice([*TRICKY, "the ", "of ", " and"]) for _ in range(600)) for _ in range(30)] + ["x" * 5000]
    same(library, texts)
    assert len(list(B.codec().windows("ab cd " * 400))) > 10


def test_other_vocabularies_are_refused():
    from cohortlens.llm.token_orc import public_vocabulary

    with open(public_vocabulary("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    with pytest.raises(ValueError):
        B._check(spec)


def test_round_trip_and_columns(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello world's <|endoftext|> end", "y"), (3, "Hello world's <|endoftext|> end", "y"), (None, "ab " * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.round_trip(docs).collect()}
    want = set()
    for k, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.add((k, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == want and B.round_trip(docs).count() == 5
    assert sorted((r.text or "") for r in B.decode(B.encode(docs)).collect()) == sorted((r[1] or "") for r in rows)
    assert B.round_trip(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, [70_000, -1, None, 262]), (2, None)], "doc_id long, ids array<int>")
    assert [r.text for r in B.decode(odd).orderBy("doc_id").collect()] == [" the", ""]


# --- collocations -----------------------------------------------------------------


def plain_collocations(rows, least=10, top=2000):
    """The definition, word by word."""
    f, n = {}, Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            c = f.setdefault(lang, Counter())
            for k in (1, 2, 3):
                c.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = set()
    for lang, c in f.items():
        found = []
        long = Counter()
        for p, a in c.items():
            if len(p) == 3 and a >= least:
                for q in (p[:2], p[1:]):
                    long[q] = max(long[q], a)
        for p, a in c.items():
            if len(p) > 1 and a >= least and not (len(p) == 2 and long[p] and 100 * long[p] >= 50 * a):
                cuts = [(1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def some_texts(seed, rows, words=30):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "city", "É", "x'y", "ab", "a\x00b", " "] + [f"w{k}" for k in range(words)]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]
    return [(rng.choice(["en", "en", "de", None]), "".join(rng.choice(vocabulary[: rng.randrange(3, len(vocabulary))]) + rng.choice(ends) for _ in range(rng.randrange(80)))) for _ in range(rows)]


def check_collocations(spark, rows, **more):
    docs = spark.createDataFrame([(k, t, x, 1, "n") for k, (x, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, word string")
    got = [tuple(r) for r in C.collocations(docs, **more).collect()]
    assert len(set(got)) == len(got) and set(got) == plain_collocations(rows, **more)


def test_collocations_equal_the_definition(spark):
    rows = some_texts(1, 150) + [("en", None), ("de", ""), (None, "...")] + [("en", "New York city hall.")] * 30
    check_collocations(spark, rows)
    check_collocations(spark, rows, least=3, top=20)
    check_collocations(spark, [])
    check_collocations(spark, [("en", None)])


def test_hot_pairs_are_spread_and_counted_once(spark, monkeypatch):
    """Pairs above HEAVY in one slice and below it in another, over many routes."""
    monkeypatch.setattr(C, "HEAVY", 3)
    monkeypatch.setattr(C, "ROUTE", 50)
    rng = random.Random(3)
    hot = [("en", "of the " + rng.choice(["x", "y", "z"]) + rng.choice(["", " q", ". of the", " of the of the"])) for _ in range(200)]
    check_collocations(spark, hot + some_texts(4, 60))


def test_partitions_give_counts_and_abandon_the_infrequent():
    rng = np.random.default_rng(5)
    h = rng.integers(1, 6, 4000).astype(np.uint64)
    h[rng.random(4000) < 0.1] = 0
    block, route = C.suffixes(h, 1)
    block = C._unpack(C._pack(block))
    ptr, words, n = C.partition_counts(block, 10)
    got = Counter()
    for p, k, c in zip(ptr, words, n):
        got[tuple(int(block[c][p]) for c in ("w1", "w2", "w3")[:k])] += int(c)
    want = Counter()
    ws = h.tolist()
    for k in (2, 3):
        want.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1) if 0 not in ws[i : i + k])
    assert {p: c for p, c in got.items() if c >= 10} == {p: c for p, c in want.items() if c >= 10}


def test_words_that_share_a_hash_are_told_apart(spark):
    """With few bits words share hashes; seeds are tried until none that is frequent does."""
    docs = spark.createDataFrame([("en", "a b c d e " * 20)], "lang string, text string")
    tried = []
    for first in range(4):
        found, seed = C.word_counts(docs, seed=first, bits=5)
        tried.append(seed - first)
        assert {(r.word, r.n) for r in found.collect()} == {*((w, 20) for w in "abcde"), ("", 100)}
        assert found.select("h").distinct().count() == 6
    assert any(tried)


def test_long_texts_are_cut_at_marks(spark, monkeypatch):
    monkeypatch.setattr(C, "SLICE", 200)
    check_collocations(spark, [("en", ", ".join(["big red dog", "big red cat"] * 3000)), ("en", "no end " * 3000)])


# --- hard negatives ----------------------------------------------------------------


def plain_negatives(rows, every=50, positives=5, negatives=3):
    rows = list({(i, c, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, c, v in rows if None not in (i, c, v) and all(x is not None and np.isfinite(x) for x in v)})
    out = Counter()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, label, v in rows:
        if a % every:
            continue
        scored = sorted({(-dot(v, w), i, c == label) for i, c, w in rows if i != a})
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            held = [(n, t) for t, n, alike in scored if not alike and 50 * -s <= 100 * -t <= 95 * -s]
            out.update((a, p, k, n, -s, -t) for k, (n, t) in enumerate(held[:negatives], 1))
    return out


def check_negatives(spark, rows, every=50):
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("score", F.lit("x")).withColumn("number", F.lit(1))
    got = Counter(tuple(r) for r in H.hard_negatives(table, F.col("vec_id") % every == 0).collect())
    assert got == plain_negatives(rows, every)
    return got


def test_hard_negatives_equal_the_definition(spark):
    rng = np.random.default_rng(1)
    rows = [(k, int(rng.integers(0, 4)), rng.normal(0.3, 1, 6).round(2).tolist()) for k in range(400)]
    odd = [(500, None, [1.0] * 6), (550, 1, None), (None, 1, [1.0] * 6), (600, 1, [float("nan")] * 6), (650, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (700, 1, [float("inf")] * 6), (750, 2, [1.0, 2.0])]
    assert sum(check_negatives(spark, rows + odd + rows[:60] + rows[:3] * 5, 20).values()) > 100
    assert not check_negatives(spark, [])
    assert not check_negatives(spark, rows[1:20])


def test_ties_zeros_and_negative_scores(spark):
    """Scores of zero lie in the window of a positive of zero, whose smaller id may come later."""
    rows = [(0, 1, [1.0, 0.0]), (9, 1, [0.0, 1.0]), (3, 2, [0.0, 2.0]), (4, 2, [0.0, 3.0]), (5, 2, [-1.0, 0.0]), (100, 3, [2.0, 0.0])]
    rows += [(k, 3, [2.0, 0.0]) for k in range(20, 30)] + [(k, 4, [1.5, 0.0]) for k in range(30, 40)] + [(50, 4, [-1.0, -1.0]), (51, 4, [1.0, 1.0])]
    assert check_negatives(spark, rows)


def test_blocks_of_anchors_and_large_numbers(spark, monkeypatch):
    monkeypatch.setattr(H, "ANCHOR_BYTES", 100)
    monkeypatch.setattr(H, "PRODUCT", 7)
    rng = np.random.default_rng(2)
    rows = [(k, int(rng.integers(0, 3)), (rng.normal(0.5, 1, 3) * 10.0**5).round(1).tolist()) for k in range(60)]
    check_negatives(spark, rows, 20)
    assert np.array_equal(H.product(np.array([[2.0**50, 1.0]]), np.array([[2.0**11, 3.0]])), [[2**61 + 3]])
    assert np.array_equal(H.product(np.array([[2.0**80]]), np.array([[2.0**80], [-(2.0**80)]])), [[2**63 - 1, -(2**63)]])


def test_memory_of_the_words_of_a_slice_is_bounded():
    """Words of a slice are objects a part at a time, and suffixes are sorted in parts."""
    rng = random.Random(4)
    names = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(9000)]
    text = " ".join(rng.choices(names, k=1_200_000))
    rows = pa.record_batch({"lang": ["en"], "text": [text]})

    def most(step) -> int:
        tracemalloc.start()
        try:
            for _ in step(iter([rows])):
                pass
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    assert most(C._count_words(0, 64)) < 5 * len(text)
    assert most(C._send(0, 4)) < 21 * len(text)
