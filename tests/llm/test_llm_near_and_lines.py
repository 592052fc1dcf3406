"""Near duplicates, components, line chunks and decontamination against brute force."""

import itertools
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import decontaminate, line_chunks, minhash_tensor
from cohortlens.llm.graph import components
from cohortlens.llm.shingles import shingle_set

SCHEMA = "doc_id long, text string, component_id string, label int, node string"


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def lowest_reachable(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def near_copies(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(6):
        base = [word() for _ in range(120)]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [" ".join([word() for _ in range(100)] + passage) for _ in range(30)]  # a shared passage is no near copy
    chain = [word() for _ in range(100)]
    for k in range(8):  # each close to the next, the ends far apart
        chain = chain[3:] + [word() for _ in range(3)]
        texts.append(" ".join(chain))
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    texts = near_copies()
    rows = [(k + 10, t) for k, t in enumerate(texts)]
    rows += [(900, texts[0]), (901, texts[0].upper()), (902, None), (903, ""), (904, " \n"), (905, "one two"), (906, "One  TWO"), (907, "one"), (908, " ".join(str(k % 5000) for k in range(20_000))), (1, texts[5]), (1, texts[5]), (None, texts[20])]
    return spark.createDataFrame([(*r, "c", 1, "n") for r in rows], SCHEMA)


def test_shingle_counts():
    for text in ["", None, "a", "a b c d e", "a b c d e f", "A b\tC\x0bd e f a b c d e", "é É x y z w"]:
        assert len(shingle_set(text)) == len(shingles(text))


def test_near_duplicates(docs):
    rows = [(r["doc_id"], shingles(r["text"])) for r in docs.collect()]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if rows[a][1] and rows[b][1] and 100 * len(rows[a][1] & rows[b][1]) >= 75 * len(rows[a][1] | rows[b][1])]
    label = lowest_reachable(range(len(rows)), links)
    lowest = {}
    for k, (d, s) in enumerate(rows):
        if d is not None:
            lowest[label[k]] = min(lowest.get(label[k], d), d)
    want = sorted((str(d), len(s), str(lowest[label[k]])) for k, (d, s) in enumerate(rows))
    got = minhash_tensor.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)
    stay = minhash_tensor.representatives(docs)
    assert stay.columns == docs.columns
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(set(lowest.values()))


def test_pivots_reach_every_link_of_a_bucket(spark, monkeypatch):
    """With one bucket for all classes and none compared early, pivots find every link."""
    texts = near_copies(2)[:40]
    monkeypatch.setattr(minhash_tensor, "EARLY", 0)
    monkeypatch.setattr(minhash_tensor, "_shared", lambda rows, keys: rows.select("node", *[F.lit(1).cast("long").alias(k) for k in keys]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a, b in combinations(range(len(texts)), 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = lowest_reachable(range(len(texts)), links)
    got = {r["doc_id"]: r["component_id"] for r in minhash_tensor.near_duplicates(df).collect()}
    assert got == want


def test_rows_of_a_large_group_of_copies(spark, monkeypatch):
    """Copies that are no links of each other make a row for a class and key of
    A (not for a table), and bounds tell most of them apart before they are pairs."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base, texts = [word() for _ in range(150)], []
    for k in range(160):
        copy = list(base)
        for at in rng.sample(range(len(copy)), 1 if k < 60 else rng.randrange(5, 9)):
            copy[at] = word()
        texts.append(" ".join(copy))
    counts = {}
    stage = minhash_tensor.stage

    def counted(df, label, keep=False):
        out = stage(df, label, keep)
        counts[label] = counts.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(minhash_tensor, "stage", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash_tensor.near_duplicates(df).collect()}
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a, b in combinations(range(len(texts)), 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert got == lowest_reachable(range(len(texts)), links)
    assert len(set(got.values())) > 20
    assert counts["buckets"] <= minhash_tensor.BANDS * len(texts)
    assert counts["compared"] <= 8 * len(texts)


def test_sketches_differ_no_more_than_sets():
    rng = random.Random(6)
    for n in (1, 5, 150, 3000):
        a = {rng.getrandbits(64) for _ in range(n)}
        b = set(rng.sample(sorted(a), n - n // 10)) | {rng.getrandbits(64) for _ in range(n // 7)}
        x, y = (minhash_tensor.sketch(np.array(sorted(s), np.uint64)) for s in (a, b))
        assert sum(int(w).bit_count() for w in (x ^ y).view(np.uint64)) <= len(a ^ b)
        assert len(x) == minhash_tensor.SKETCH and not (x ^ x).any()


def test_components_of_a_long_path(spark):
    path = spark.range(1, 60).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(100, 102), (102, 101), (7, 7)], "a long, b long"))
    got = {r["node"]: r["label"] for r in components(path).collect()}
    assert got == {**{k: 1 for k in range(1, 61)}, 100: 100, 101: 100, 102: 100}


PASSAGE = [f"this is line number {k} of a passage that many hold" for k in range(12)]


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(4)
    own = lambda n: [" ".join(rng.choice("abcdefghijklm") * rng.randrange(2, 6) for _ in range(12)) for _ in range(n)]
    rows = [(k, "\n".join(own(4) + PASSAGE + own(3))) for k in range(5)] + [(50, "\n".join(own(9))), (51, None), (52, ""), (53, "\n\n\n"), (54, "x"), (55, "x"), (None, "\n".join(PASSAGE)), (56, "\n".join(own(3000))), (57, " ".join(["long"] * 60)), (58, "y\n" + " ".join(["long"] * 60))]
    rows += [(60, "\n".join(PASSAGE + own(2) + PASSAGE)), (61, rows[0][1]), (61, rows[0][1])]
    return spark.createDataFrame([(d, t, "f", 1, "s") for d, t in rows], "doc_id long, text string, first string, seed int, chunk string")


def test_chunks_are_compared_by_digests(lines):
    """What is moved to compare chunks does not grow with their bytes."""
    found = line_chunks.repeated_chunks(lines)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "min(chunk" in plan and "sha2(" in plan


def test_line_chunks(lines):
    got = {r["doc_id"]: r for r in line_chunks.report(lines).collect()}
    assert set(got) == {None, 0, 1, 2, 3, 4, 60, 61, 58, 57}
    assert got[None]["removed_lines"] == 0 and got[None]["shared_lines"] == 12 and got[57]["removed_lines"] == 0
    assert all(got[k]["removed"] == ",".join(map(str, range(4, 16))) for k in (1, 2, 3, 4)) and got[58]["removed"] == "1"
    assert got[0]["removed_lines"] >= 8  # 61 is a copy of 0, so the lines around the passage follow it twice, and only rolling cuts part them
    clean = line_chunks.without_repeats(lines)
    assert clean.columns == lines.columns and clean.count() == lines.count()
    text = {r["doc_id"]: r["text"] for r in clean.collect()}
    before = {r["doc_id"]: r["text"] for r in lines.collect()}
    assert all(text[k] == before[k] for k in (50, 51, 52, 53, 54, 55, 56, None))
    for k in (1, 2, 3, 4):
        kept, had = text[k].split("\n"), before[k].split("\n")
        assert kept[:4] == had[:4] and kept[-3:] == had[-3:] and len(had) - len(kept) == got[k]["removed_lines"]
    assert all(line in "\n".join(x for x in text.values() if x) for line in PASSAGE)


def test_short_passages_between_foreign_lines(spark):
    """Passages of one to four lines, planted in documents of lines of their own, are all found, at their own edges."""
    rng, n = random.Random(11), itertools.count()
    own = lambda k: [f"own{next(n)} " + " ".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(k)]
    passages = [[f"passage{p} line{k} " + " ".join(rng.choice("stuvwxyz") for _ in range(60 if size == 1 else 14)) for k in range(size)] for p, size in enumerate([1, 2, 3, 4] * 10)]
    rows, planted = [], {}
    for d in range(120):
        p = d % len(passages)
        head, tail = own(rng.randrange(0, 5)), own(rng.randrange(0, 5))
        rows.append((d, "\n".join(head + passages[p] + tail)))
        planted[d] = list(range(len(head), len(head) + len(passages[p])))
    rows += [(200, "\n".join(own(4))), (201, "short\nsame"), (202, "short\nsame")]
    got = {r["doc_id"]: r for r in line_chunks.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == set(planted)
    for d, at in planted.items():
        first = d < len(passages)
        assert got[d]["removed"] == ("" if first else ",".join(map(str, at))) and got[d]["shared_lines"] == (len(at) if first else 0)
        assert got[d]["first_doc_ids"] == ("" if first else str(d % len(passages)))


def test_passage_beside_a_frequent_line(spark):
    """A blank line that often follows a passage does not hide it from places where it does not."""
    rng, n = random.Random(12), itertools.count()
    own = lambda k: [f"own{next(n)} words" for _ in range(k)]
    passage = [f"part{k} " + " ".join(rng.choice("stuvwxyz") for _ in range(14)) for k in range(8)]
    rows = [(d, "\n".join(own(3) + passage + ([""] if d % 2 else []) + own(2))) for d in range(20)]
    got = {r["doc_id"]: r for r in line_chunks.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == set(range(20))
    assert all(set(range(3, 11)) <= set(map(int, got[d]["removed"].split(","))) for d in range(2, 20))


def test_line_chunks_run_without_python(lines):
    plan = line_chunks.without_repeats(lines)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


ITEMS = [(1, "the quick badger ran over seven frozen lakes before dawn and slept under a silver birch until noon came"), (2, "copper kettles whistle loudest whenever northern sailors argue about forgotten maps of hidden coral islands"), (3, None), (4, "")]


def test_decontamination(spark):
    rng = random.Random(9)
    filler = [f"w{k}" for k in range(400)] + ["the", "over", "about", "sailors", "maps", "dawn"]
    noise = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    paraphrase = ITEMS[1][1].replace("copper", "brass").replace("argue", "quarrel").replace("northern ", "")
    rows = [(k, noise(150)) for k in range(40)] + [(100, f"{noise(30)} {ITEMS[0][1].upper()} {noise(50)}"), (101, ITEMS[1][1]), (102, f"{noise(2000)} {paraphrase} {noise(10)}"), (103, f"{ITEMS[0][1]} {ITEMS[1][1]}"), (104, None), (105, ""), (106, " ".join(reversed(ITEMS[0][1].split()))), (None, ITEMS[0][1])]
    docs = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, cosine string, item_id int")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["item_id"]) for r in decontaminate.leaks(docs, bench).collect())
    assert got == [("100", 1), ("101", 2), ("102", 2), ("103", 1), ("103", 2), ("None", 1)]
    stay = decontaminate.without_leaks(docs, bench)
    assert stay.columns == docs.columns and sorted(r["doc_id"] for r in stay.collect()) == [*range(40), 104, 105, 106]
    none = bench.where("item_id > 2")
    assert decontaminate.leaks(docs, none).count() == 0 and decontaminate.without_leaks(docs, none).count() == docs.count()


def test_decontamination_of_long_and_short_items(spark):
    rng = random.Random(11)
    noise = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    long = [f"term{k}" for k in range(95)]
    very = [f"part{k}" for k in range(200)]
    items = [(1, " ".join(long)), (2, " ".join(very)), (3, "zyzzyva"), (4, "blue heron"), (5, "Seven, frozen lakes!"), (6, "one odd fjord sphinx"), (7, "w1 w2 w3 w4"), (8, "...")]
    garbled = [w for k, w in enumerate(long[:64]) if k % 3] + [f"w{k}" for k in range(20)] + long[-6:]  # two thirds of the first piece, and the item's end
    unanswered = [w for k, w in enumerate(long[:64]) if k % 3] + noise(40)
    texts = {1: noise(30) + long[64:] + noise(30), 2: noise(50) + long[31:] + noise(40), 3: noise(10) + garbled + noise(60), 4: noise(10) + unanswered, 5: noise(9) + very[136:] + noise(5), 6: noise(80) + ["zyzzyva"] + noise(70), 7: ["blue", "heron"], 8: noise(5) + ["blue", "x", "heron"], 9: noise(90) + "SEVEN frozen-lakes".replace("-", " ").split() + noise(9), 10: noise(60) + "one odd fjord sphinx".split() + noise(60), 11: noise(60) + ["w1", "w2", "w3", "w4"] + noise(60), 12: ["heron", "blue"], 13: long + very}
    texts |= {k: rng.sample(long + very + [f"v{k}" for k in range(300)], 140) for k in range(100, 220)}  # the items' words in no order
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in texts.items()], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    hold = {(d, i) for d, t in texts.items() for i, item in items if (w := item.lower().replace(",", "").strip("!.").split()) and any([x.lower() for x in t[k : k + len(w)]] == w for k in range(len(t)))}
    assert hold <= got and got - hold == {(2, 1), (3, 1), (5, 2)}
    assert {r["doc_id"] for r in decontaminate.without_leaks(docs, bench).collect()} == set(texts) - {d for d, _ in got}


def test_pieces_hold_every_word():
    for n in (1, 3, 63, 64, 65, 95, 96, 127, 128, 129, 200, 1000):
        words = [f"x{k}".encode() for k in range(n)]
        bench = decontaminate.Benchmark.of([(1, b" ".join(words).decode())])
        assert {w for item in bench.items for w in item} == set(words) and all(len(item) == min(n, 64) for item in bench.items)
        assert all(a == words[-6:] for a in bench.answers) and bench.after[-1] == 0


def test_common_length():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_length(a, b) == table[-1][-1]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert minhash_tensor.near_duplicates(empty).count() == 0 and minhash_tensor.representatives(empty).columns == empty.columns
    assert line_chunks.report(empty).count() == 0 and line_chunks.without_repeats(empty).count() == 0
    assert decontaminate.leaks(empty, bench).count() == 0 and decontaminate.without_leaks(empty, bench).count() == 0


def test_marks_leave_out_rows_that_a_join_would_drop(spark, monkeypatch):
    """Texts are not moved only to be dropped, whatever the number of wanted documents; full marks lose nothing."""
    from pyspark.sql import functions as F

    from cohortlens.llm import line_chunks

    rows = spark.range(3000).select(F.when(F.col("id") != 7, F.col("id")).alias("a"), (F.col("id") % 5).alias("b"))
    wanted = spark.createDataFrame([(None, 2), *((k, k % 5) for k in range(0, 3000, 100)), (1, 3)], "x long, y long")
    want = {(None, 2), *((k, k % 5) for k in range(0, 3000, 100))}
    got = {tuple(r) for r in line_chunks._marked(rows, ["a", "b"], wanted, ["x", "y"]).collect()}
    assert want <= got and len(got) < 2 * len(want)
    monkeypatch.setattr(line_chunks, "MARKS", 4)
    assert line_chunks._marked(rows, ["a", "b"], wanted, ["x", "y"]).count() == 3000
    docs = spark.createDataFrame([(1, "x1 y\nx2 z\n" + "w " * 60 + "\nq"), (None, "r\nx1 y\nx2 z\n" + "w " * 60), (3, "s"), (4, None)], "doc_id long, text string")
    few = {tuple(r) for r in line_chunks.report(docs).collect()}
    monkeypatch.undo()
    assert few == {tuple(r) for r in line_chunks.report(docs).collect()} and len(few) == 2
