"""Collocations by a multikey three-way quicksort of suffix pointers.

A suffix is a place in a piece of text with the words from there on, up to
DEPTH. Words are 64-bit hashes of language and word from the first step on;
whether two words share a hash is seen when words are counted (each hash must
have one word), and another seed is taken if so, so counts are exact.

1. Words are counted per language, within tasks first.
2. Suffixes are routed globally by their two leading words, packed in one block
   per slice of text and route. A slice sends a phrase once, with its count. A
   pair of words that is frequent within a slice goes to its route as one
   number, and its suffixes are routed by all their words instead: so no route
   gets more than HEAVY suffixes of a pair from any slice, however hot it is.
3. In a route, all suffixes are pointers that are partitioned around a pivot of
   their current word into smaller, equal and larger; an equal partition goes
   on with the next word, and its size is the count of the words so far. All
   partitions of a route take such a step together, in numpy. A partition
   smaller than the least count is abandoned: its phrases are infrequent.
4. What frequent phrases need of each other are joins of their counts; the
   arithmetic is in decimals of 38 digits.

Null texts count as empty, null languages as ``und``. Repeated rows count each
time. Texts of any length are cut into slices where a piece ends.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import SALTS, broadcast_if_small, slices, stage

#: Occurrences of a candidate, its most words, candidates returned per language, and the share of a longer one, in hundredths, that hides it.
LEAST, DEPTH, TOP, HIDDEN = 10, 3, 2_000, 50
#: Words of the corpus per route; occurrences of a pair in a slice above which its suffixes are routed by all words.
ROUTE, HEAVY = 1 << 18, 64
#: Partitions of a route, as a power of two, that a hash of the leading words makes before any words are compared.
LEAD_BITS = 20
#: Bytes of text whose suffixes are sent together, and that are objects of a word each at a time; words counted or
#: hashes kept by a worker at a time; rows of words in a batch; parts in which the suffixes of a slice are sorted.
SLICE, PART, KEPT, ROWS, SORTED_PARTS = 16 << 20, 1 << 20, 250_000, 50_000, 8
UNKNOWN = "und"
_MARKS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(_MARKS + b"\t", b"." * len(_MARKS) + b" ")
_MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_WHOLE, _TOTAL, _APART = range(3)
_BLOCK = [("w1", "<u8"), ("w2", "<u8"), ("w3", "<u8"), ("n", "<u4"), ("kind", "u1")]


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lowered, with b'.' where a piece ends."""
    return text.lower().translate(_PLAIN).replace(b".", b" . ").split()


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about PART bytes of it at a time, cut behind a space."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PART) + 1 or len(text)
        yield words_of(text[at:end])
        at = end


def _texts_by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Language and texts, joined where pieces end, of slices of the rows (lang, text)."""
    for batch in slices(batches, 1, SLICE):
        by: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            by.setdefault(UNKNOWN if lang is None else lang, []).append(text.as_buffer() or b"")
        for lang in list(by):
            whole, at = b".".join(by.pop(lang)), 0
            while at < len(whole):  # a very long text goes on after a mark, as that ends a piece
                end = _piece_end(whole, at + SLICE)
                yield lang, whole[at:end]
                at = end


def _piece_end(data: bytes, at: int) -> int:
    ends = [k for m in _MARKS if (k := data.find(m, at, at + (1 << 20))) >= 0] if at < len(data) else []
    if ends or at >= len(data):
        return min(ends) + 1 if ends else len(data)
    return _piece_end(data, at + (1 << 20))


def _salt(lang: str) -> bytes:
    return b"%d:%b:" % (len(name := lang.encode()), name)


def _hash(salt: bytes, word: bytes, seed: int, bits: int) -> int:
    """Not 0, which stands for no word."""
    return xxhash.xxh64_intdigest(salt + word, seed) >> 64 - bits or 1


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint64).view(np.int64)


def _count_words(seed: int, bits: int):
    def rows(lang: str, counts: Counter) -> Iterator[pa.RecordBatch]:
        counts[b""] = counts.total() - counts.pop(b".", 0)  # all words together, as the empty word
        each, salt = iter(counts.items()), _salt(lang)
        while found := list(islice(each, ROWS)):
            h = np.fromiter((_hash(salt, w, seed, bits) for w, _ in found), np.uint64, len(found))
            yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), pa.array([lang] * len(found), pa.string()), pa.array([w.decode() for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["h", "lang", "word", "n"])

    def each(batches):
        held: dict[str, Counter] = {}
        for lang, text in _texts_by_lang(batches):
            for words in _parts(text):
                counts = held.setdefault(lang, Counter())
                counts.update(words)
                if len(counts) > KEPT or len(held) > 64:
                    yield from rows(lang, held.pop(lang))
        for lang in list(held):
            yield from rows(lang, held.pop(lang))

    return each


def word_counts(docs: DataFrame, least: int = LEAST, seed: int = 0, bits: int = 64) -> tuple[DataFrame, int]:
    """(h, lang, word, n) of words with ``least`` occurrences, staged, and the seed
    with which each of them has a hash of its own, of ``bits`` bits. The empty word
    has the number of all words."""
    while True:
        counted = docs.select("lang", "text").mapInArrow(_count_words(seed, bits), "h long, lang string, word string, n long")
        each = counted.repartition("h").groupBy("h", "lang", "word").agg(F.sum("n").alias("n"))
        by_hash = each.groupBy("h").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"), F.min(F.struct("lang", "word")).alias("w"))
        found = stage(by_hash.where((F.col("n") >= least) | (F.col("w.word") == "")).select("h", "w.lang", "w.word", "n", "words"), "collocation-words")
        if found.where("words > 1").isEmpty():
            return found.drop("words"), seed
        seed += 1


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _routes(mixed: np.ndarray, routes: int) -> np.ndarray:
    return ((mixed >> np.uint64(32)) * np.uint64(routes) >> np.uint64(32)).astype(np.int32)


def suffixes(h: np.ndarray, routes: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of words ``h`` (0 ends a piece) that have two words or more,
    as records with their counts, and the route of each; in order of routes.

    Equal suffixes are met by sorting mixed hashes. Were two different ones to
    share those, some equal ones would go as two records: counts stay right."""
    h = np.append(h, np.uint64(0))
    # sorted in parts by the pair's hash, each with all suffixes of its pairs: one part's columns at a time
    part = ((h[:-1] * _MIX[0] + h[1:] * _MIX[1] >> np.uint64(32)) * np.uint64(SORTED_PARTS) >> np.uint64(32)).astype(np.uint8)
    part[(h[:-1] == 0) | (h[1:] == 0)] = SORTED_PARTS  # no pair
    out, size = np.empty(len(part) + len(part) // HEAVY + 1, _BLOCK), 0
    for k in range(SORTED_PARTS):
        found = _counted(h, np.flatnonzero(part == k))
        out[size : size + len(found)] = found
        size += len(found)
    del h
    out = out[:size]
    mixed = out["w1"] * _MIX[0] + out["w2"] * _MIX[1]
    mixed = np.where(out["kind"] == _APART, mixed * _MIX[1] + out["w3"] * _MIX[2], mixed)
    route = _routes(mixed, routes)
    del mixed
    order = np.argsort(route, kind="stable")
    return out[order], route[order]


def _counted(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The suffixes at ``at``, among them all of each pair that is there, as records with their counts."""
    w1, w2, w3 = h[at], h[at + 1], h[at + 2]
    pair = w1 * _MIX[0] + w2 * _MIX[1]
    order = np.argsort(pair & np.uint64(0xFFFFFFFF00000000) | (w3 * _MIX[2] >> np.uint64(32)))
    w1, w2, w3 = w1[order], w2[order], w3[order]
    runs = _runs(w1, w2, w3)
    n = np.diff(np.append(runs, len(w1)))
    w1, w2, w3 = w1[runs], w2[runs], w3[runs]
    pairs = _runs(w1, w2)
    total = np.add.reduceat(n, pairs) if len(pairs) else n
    heavy = total > HEAVY
    apart = np.repeat(heavy, np.diff(np.append(pairs, len(w1))))
    out = np.zeros(len(w1) + int(heavy.sum()), _BLOCK)
    own, sums = out[: len(w1)], out[len(w1) :]
    own["w1"], own["w2"], own["w3"], own["n"], own["kind"] = w1, w2, w3, n, np.where(apart, _APART, _WHOLE)
    sums["w1"], sums["w2"], sums["n"], sums["kind"] = w1[pairs][heavy], w2[pairs][heavy], total[heavy], _TOTAL
    return out[(out["kind"] != _APART) | (out["w3"] != 0)]  # a suffix of two words is in its pair's number


def _pack(block: np.ndarray) -> bytes:
    """A block column by column, compressed."""
    return len(block).to_bytes(4, "little") + pa.compress(b"".join(np.ascontiguousarray(block[c]).tobytes() for c, _ in _BLOCK), "zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    out = np.empty(n, _BLOCK)
    raw, at = pa.decompress(data[4:], out.nbytes, "zstd", asbytes=True), 0
    for name, kind in _BLOCK:
        out[name] = np.frombuffer(raw, kind, n, at)
        at += n * np.dtype(kind).itemsize
    return out


def _send(seed: int, routes: int):
    known: dict[str, dict[bytes, int]] = {}

    def each(batches):
        for lang, text in _texts_by_lang(batches):
            salt, hashes, words = _salt(lang), [], []
            for words in _parts(text):
                if len(known) > 64 or len(known.get(lang, ())) > KEPT:
                    known.clear()
                own = known.setdefault(lang, {b".": 0})
                own.update((w, _hash(salt, w, seed, 64)) for w in set(words).difference(own))
                hashes.append(np.fromiter(map(own.__getitem__, words), np.uint64, len(words)))
            h = np.concatenate([np.empty(0, np.uint64), *hashes])
            del hashes, words
            block, route = suffixes(h, routes)
            firsts = _runs(route)
            ends = np.append(firsts, len(route))
            for k, first in enumerate(firsts.tolist()):
                yield pa.RecordBatch.from_arrays([pa.array([route[first]], pa.int64()), pa.array([_pack(block[first : ends[k + 1]])], pa.binary())], ["route", "block"])

    return each


def partition_counts(block: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pointers to one suffix per phrase, the words of the phrase (2 or 3), and
    its count, by three-way partitioning. ``least``: partitions below are abandoned.

    Phrases of three words whose pair has numbers of its own from some slice
    are counted in several routes and come with what is counted here."""
    weight, apart = block["n"].astype(np.int64), np.flatnonzero(block["kind"] == _APART)
    # the route's partitions by a hash of the leading words: those below least hold no frequent pair
    lead = ((block["w1"] * _MIX[0] + block["w2"] * _MIX[1]) * _MIX[2] >> np.uint64(64 - LEAD_BITS)).astype(np.int64)
    own = block["kind"] != _APART
    ptr = np.flatnonzero(own & (np.bincount(lead[own], weight[own], 1 << LEAD_BITS) >= least)[lead]) if len(block) else apart
    keys = np.stack([block["w1"], block["w2"], block["w3"]])
    found = [(apart, np.full(len(apart), DEPTH), weight[apart])]
    size, depth = np.array([len(ptr)]), np.zeros(1, np.int64)
    while len(ptr):
        first, part = np.cumsum(size) - size, np.repeat(np.arange(len(size)), size)
        value, pivot = keys[depth[part], ptr], keys[depth, ptr[first + size // 2]][part]
        side = np.where(value < pivot, 0, np.where(value == pivot, 1, 2))
        target = part * 3 + side
        total = np.bincount(target, weight[ptr], 3 * len(size)).astype(np.int64)
        alive = total >= least
        use = alive[target]
        ptr, target = ptr[use], target[use]
        moved = np.argsort(target, kind="stable")
        ptr, target = ptr[moved], target[moved]
        size = np.bincount(target, minlength=3 * len(size))
        # equal partitions of the second word or the third are phrases
        now = np.repeat(depth, 3) + (np.arange(len(size)) % 3 == 1)
        begin = np.cumsum(size) - size
        phrase = np.flatnonzero(alive & (now > np.repeat(depth, 3)) & (now >= 2))
        found.append((ptr[begin[phrase]], now[phrase], total[phrase]))
        # pairs with numbers of their own: their longer phrases are summed up elsewhere
        spread = np.zeros(len(size), bool)
        spread[target[block["kind"][ptr] == _TOTAL]] = True
        spread &= (now == 2) & (np.repeat(depth, 3) == 1)
        loose = ptr[spread[target] & (block["w3"][ptr] != 0)]
        found.append((loose, np.full(len(loose), DEPTH), weight[loose]))
        go_on = ~spread[target] & (now[target] < DEPTH)
        go_on &= (now[target] < 2) | (block["w3"][ptr] != 0)
        ptr, target = ptr[go_on], target[go_on]
        size = np.bincount(target, minlength=len(size))
        depth, size = now[size > 0], size[size > 0]
    return tuple(np.concatenate(x) for x in zip(*found))


def _count_route(least: int):
    def each(table: pa.Table) -> pa.Table:
        block = np.concatenate([_unpack(x) for x in table.column("block").to_pylist()])
        ptr, words, n = partition_counts(block, least)
        w3 = np.where(words == DEPTH, block["w3"][ptr], np.uint64(0))
        return pa.table({"w1": _signed(block["w1"][ptr]), "w2": _signed(block["w2"][ptr]), "w3": _signed(w3), "n": n})

    return each


def phrase_counts(docs: DataFrame, seed: int, words: int, least: int = LEAST) -> DataFrame:
    """(w1, w2, w3, n) of phrases with ``least`` occurrences, staged; w3 is 0 for
    phrases of two words. ``words``: how many the corpus has."""
    routes = max(1, -(-words // ROUTE))
    blocks = docs.select("lang", "text").mapInArrow(_send(seed, routes), "route long, block binary")
    parts = blocks.groupBy("route").applyInArrow(_count_route(least), "w1 long, w2 long, w3 long, n long")
    return stage(parts.groupBy("w1", "w2", "w3").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "collocation-phrases")


def _score(a: str, left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)) in whole numbers; counts below 10 ** 15."""
    a, left, right = (f"CAST({x} AS DECIMAL(15, 0))" for x in (a, left, right))
    return f"(CAST({a} * {a} * 1000000 AS DECIMAL(38, 0)) div CAST({left} * {right} AS DECIMAL(38, 0)))"


def _best(rows: DataFrame, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows of each language, ranked within SALTS parts of it first."""
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(SALTS))).orderBy(*order)
    first = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    Candidates have 2 or 3 words and ``least`` occurrences, a. A cut after the
    first k words gives l and r, the occurrences of its parts, and the score
    floor(1000000 * a * a / (l * r)); the least counts, of equal ones that of
    the smallest k. A candidate is dropped if a longer one holds its words side
    by side and has HIDDEN hundredths of its occurrences. Ordered by score and
    a descending, then by the phrase's bytes."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    words, seed = word_counts(rows, least)
    totals = words.where("word = ''").select("lang", F.col("n").alias("all"))
    size = totals.agg(F.sum("all")).first()[0] or 0
    words = words.where("word <> ''")
    found = phrase_counts(rows, seed, size, least)
    pairs, triples = found.where("w3 = 0").select("w1", "w2", F.col("n").alias("a")), found.where("w3 <> 0").select("w1", "w2", "w3", F.col("n").alias("a"))

    def count_of(rows: DataFrame, column: str, name: str, *more: str) -> DataFrame:
        own = broadcast_if_small(words.select(F.col("h").alias(column), F.col("n").alias(name), *more))
        return rows.join(own, column)

    holders = triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longest = holders.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    two = pairs.join(longest, ["w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < HIDDEN * F.col("a")))
    two = count_of(count_of(two, "w1", "l", "lang"), "w2", "r").select("lang", "w1", "w2", F.lit(0).cast("long").alias("w3"), "a", "l", "r", F.expr(_score("a", "l", "r")).alias("score"))
    three = triples.join(pairs.withColumnRenamed("a", "l2"), ["w1", "w2"]).join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1")), ["w2", "w3"])
    three = count_of(count_of(three, "w1", "l1", "lang"), "w3", "r2").select("*", F.expr(_score("a", "l1", "r1")).alias("s1"), F.expr(_score("a", "l2", "r2")).alias("s2"))
    cut = F.when(F.col("s1") <= F.col("s2"), F.struct(F.col("l1").alias("l"), F.col("r1").alias("r"), F.col("s1").alias("score"))).otherwise(F.struct(F.col("l2").alias("l"), F.col("r2").alias("r"), F.col("s2").alias("score")))
    scored = stage(two.unionByName(three.select("lang", "w1", "w2", "w3", "a", cut.alias("c")).select("lang", "w1", "w2", "w3", "a", "c.*")), "collocation-scores")
    # spelt out are those that may be among the first: score and a decide, ties included
    near = _at_least(scored, top)
    spelt = near
    for column in ("w1", "w2", "w3"):
        spelt = spelt.join(broadcast_if_small(words.select(F.col("h").alias(column), F.col("word").alias(f"{column}_word"))), column, "left")
    spelt = spelt.withColumn("phrase", F.concat_ws(" ", "w1_word", "w2_word", "w3_word"))
    best = _best(spelt, [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("all").alias("n"), "score")


def _at_least(scored: DataFrame, top: int) -> DataFrame:
    """Rows whose (score, a) is not below that of their language's row number ``top``."""
    ranked = _best(scored, [F.desc("score"), F.desc("a")], top)
    least = ranked.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("least"))  # a row per language
    return scored.join(least, "lang").where(F.struct("score", "a") >= F.col("least")).drop("least")
