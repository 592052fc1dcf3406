"""Exact duplicates, source mixing and token files against plain Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import exact_recipes, mixing, token_orc
from cohortlens.llm.common import new_folder

SCHEMA = "doc_id long, text string, source string, size string, kept int, row string"
LONG = " ".join(f"word{zlib.crc32(b"%d" % k) % 9973} x" for k in range(30_000))


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "a b  c", "s1"), (2, "abc", "s1"), (3, "a bc", None), (4, None, "s2"), (5, "", "s2"), (6, " \t\n", "s2"), (7, LONG, "s3"), (8, LONG.replace(" x", "x"), "s3"),
            (9, LONG + "!", "s3"), (10, "abc", "s1"), (10, "abc", "s1"), (None, "nobody", None), (None, "nobody", None), (11, "ÄÖ é", "s1"), (12, "ÄÖé", "s4"), (13, "a bc", "s4")]
    return spark.createDataFrame([(*r, "z", 7, "q") for r in rows], SCHEMA)


def expected_groups(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[plain(t)].append((-len(t or ""), d is None, d or 0, d))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("name", [exact_recipes.digest, lambda chunk: bytes([len(chunk) % 2])], ids=["digest", "colliding digest"])
def test_exact_groups(docs, name):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = expected_groups(rows)
    got = exact_recipes.duplicates(docs, name=name).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"]) for r in got) == sorted((str(d), str(want[plain(t)][0]), want[plain(t)][1]) for d, t in rows)
    kept = defaultdict(int)
    for r in got:
        assert by_sha[r["text_sha256"]] == (r["keep_id"], r["group_size"])
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1}


def test_chunks_do_not_depend_on_what_stands_before():
    text = LONG.encode()
    moved = b"another beginning " * 40 + text
    one = exact_recipes.cut(text, exact_recipes.boundaries(text), 0, len(text))
    two = exact_recipes.cut(moved, exact_recipes.boundaries(moved), 0, len(moved))
    assert b"".join(one) == text and b"".join(two) == moved
    assert len(set(one) & set(two)) > 0.9 * len(set(one))
    inside = exact_recipes.cut(b"..." + text, exact_recipes.boundaries(b"..." + text), 3, len(text) + 3)
    assert inside == one


def water_level(sizes, weights, most):
    target, open_, left = {}, set(sizes), sum(sizes.values())
    while open_:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * left > most * sizes[s] * total}
        if not over:
            return target | {s: weights[s] * left / total for s in open_}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= most * sizes[s]
        open_ -= over
    return target


def test_targets_and_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(k, f"src{k % 7}" if k % 11 else None, int(rng.lognormal(4, 1)) * (k % 7 != 5)) for k in range(3000)]
    rows += [(k, "tiny", 3) for k in range(5000, 5004)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.mix(df, F.col("size")).select("doc.doc_id", "source", "size", "source_size", "target", "copies").collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water_level({s: n for s, n in sizes.items() if n}, {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}, 3)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["target"] == pytest.approx(want.get(r["source"], 0.0)) and r["source_size"] == sizes[r["source"]]
        each = r["target"] / r["source_size"] if r["source_size"] else 0
        assert int(each) <= r["copies"] <= min(3, int(each) + 1)
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * largest[s]
    again = mixing.mix(df.repartition(5), F.col("size")).select("doc.doc_id", "copies").collect()
    assert sorted((r["doc_id"], r["copies"]) for r in again) == sorted((r["doc_id"], r["copies"]) for r in got)


def test_mix_keeps_columns_and_repeated_rows(docs):
    out = mixing.emitted(mixing.mix(docs, mixing.words("text")))
    assert out.columns == docs.columns
    sizes = {str(r["doc_id"]): len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
    mixed = mixing.mix(docs, mixing.words("text")).collect()
    assert len(mixed) == docs.count() and all(r["size"] == sizes[str(r["doc"]["doc_id"])] for r in mixed)
    assert out.count() == sum(r["copies"] for r in mixed)


def test_only_numbers_are_dealt_by_ranges(spark, monkeypatch):
    """The longest documents stand together in the line; their texts must not."""
    seen, staged = [], mixing.staged_in_order

    def spy(df, *more):
        seen.append(df)
        return staged(df, *more)

    monkeypatch.setattr(mixing, "staged_in_order", spy)
    rows = [(k % 40, "word " * (1 + k % 7), f"src{k % 3}") for k in range(200)] + [(None, None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, mixing.words("text")).collect()
    assert sorted(map(str, ((r["doc"]["doc_id"], r["doc"]["text"], r["doc"]["source"]) for r in got))) == sorted(map(str, rows))
    assert all(r["source"] == r["doc"]["source"] for r in got)
    assert [f.dataType.typeName() for df in seen for f in df.schema if f.name != "source"] == ["long"] * 3


def test_tokens_round_trip(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_orc.public_vocabulary())
    odd = [(20, "It's <|endoftext|> I'll <|STARTOFTEXT|>"), (21, "abc,, d.e, (x) ''s ½²Ⅷ İ ΣΑΣ. áb ́c\x1cd e"), (22, "日本語 テスト 12345"), (23, "don't!!! WHY'S"), (24, "q" * 3000)]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    path = new_folder(spark, "tokens-test")
    token_orc.write_tokens(more, path)
    rows = token_orc.read_tokens(spark, path).collect()
    want = sorted(((r["doc_id"], (*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2)) for r in more.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(rows, key=lambda r: r["start"])
    assert sorted((str(r["doc_id"]), tuple(r["ids"])) for r in got) == sorted((str(d), i) for d, i in want)
    assert [r["doc_id"] for r in got] == [d for d, _ in want]
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    digests = {(r["start"]): r["ids_crc32"] for r in token_orc.digests(token_orc.read_tokens(spark, path)).collect()}
    assert digests == {r["start"]: zlib.crc32(np.asarray(r["ids"], "<u4").tobytes()) for r in got}
    some = token_orc.read_tokens(spark, path, F.col("doc_id").isin(7, 22))
    assert sorted(r["doc_id"] for r in some.collect()) == [7, 22]
    assert re.search(r"PushedFilters: \[.*doc_id", some._jdf.queryExecution().toString())


def test_orc_files_have_indexes_and_bloom_filters(spark):
    from pyarrow import fs, orc

    path = new_folder(spark, "tokens-test")
    token_orc.write_tokens(spark.range(5000).selectExpr("id AS doc_id", "concat('some words ', id) AS text"), path)
    files = [f.path for f in fs.LocalFileSystem().get_file_info(fs.FileSelector(path.removeprefix("file://"))) if f.path.endswith(".orc")]
    opened = [orc.ORCFile(f) for f in files]
    assert sum(f.nrows for f in opened) == 5000 and {f.compression for f in opened} == {"ZSTD"}
    assert {f.row_index_stride for f in opened} == {token_orc.ROW_GROUP} and all(f.nstripes for f in opened)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for f in files:
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.orc.OrcFile.readerOptions(conf))
        footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
        kinds = {str(footer.getStreams(k).getKind()) for k in range(footer.getStreamsCount())}
        assert "ROW_INDEX" in kinds and any("BLOOM_FILTER" in k for k in kinds)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_recipes.duplicates(empty).count() == 0
    assert mixing.mix(empty, mixing.words("text")).count() == 0 and mixing.emitted(mixing.mix(empty, mixing.words("text"))).columns == empty.columns
    assert token_orc.encode_and_reread(empty).count() == 0


def test_ids_of_all_letters_and_marks_equal_the_library():
    """Letters that become a letter and a mark when composed or lower-cased join the marks behind them."""
    import random
    import unicodedata

    import numpy as np
    from tokenizers import Tokenizer

    path = token_orc.public_vocabulary()
    tokenizer, encode = Tokenizer.from_file(path), token_orc._encoder(path)
    kinds = {c: unicodedata.category(chr(c))[0] for c in range(0x1FFFF) if not (0xD800 <= c < 0xE000 or 0x3400 <= c < 0xA000 or 0xAC00 <= c < 0xD7A4)}
    letters, marks = ([chr(c) for c, kind in kinds.items() if kind == k] for k in "LM")
    texts = [f"a{c}, {c}{c}. {c}-a!" for c in letters] + [f"a{c}, {c}- e{c}." for c in marks]
    rng = random.Random(3)
    odd = ["VELİ, ALİ.", "aİ-", "য়,", "ज़.", "é", "!", "..", "'s", "'", "a", "1", " ", "\n", "\t", "ß", "ſ", "K", "字", "ﬁ", "<|x", "ΑΣ", "<|endoftext|>"]
    texts += ["".join(rng.choice(odd) for _ in range(rng.randrange(14))) for _ in range(5000)]
    got = [np.frombuffer(x, "<i4").tolist() for x in encode(texts)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_marks_are_split_off_before_words_are_looked_up(monkeypatch):
    """A word is learnt once, whatever marks follow it; a column may begin anywhere in its batch."""
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = token_orc.public_vocabulary()
    stems = ["lessing", "étonné", "weiß", "ĭthring"]
    words = [w + m for w in stems for m in ("", ",", ".", "!?", ",,", ";-")] + ["İ,", "ſ.", "x́,", "don't,"]
    texts = ["left out", *(" ".join(words[k:] + words[:k]) for k in range(len(words))), "a <|endoftext|>, b", "", None]
    seen, met = [], token_orc._MARKED
    monkeypatch.setattr(token_orc, "_MARKED", lambda w: seen.append(w) or met(w))
    got = token_orc._encoder.__wrapped__(path)(pa.array(texts).slice(1))
    want = Tokenizer.from_file(path).encode_batch([t or "" for t in texts[1:]], add_special_tokens=False)
    assert [np.frombuffer(x, "<i4").tolist() for x in got] == [e.ids for e in want]
    assert not [w for w in seen if w.decode().startswith(tuple(stems)) and w.decode() not in stems]


def test_other_vocabularies_are_encoded_whole():
    import numpy as np
    from tokenizers import Tokenizer

    path = token_orc.public_vocabulary("byte_bpe_50k.json")
    texts = ["Hello  World's end", "", "a, b.\n c", "é" * 50]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<i4").tolist() for x in token_orc._encoder(path)(texts)] == want
