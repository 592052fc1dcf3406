"""Benchmark decontamination by latent semantic retrieval.

Passages of the corpus and the benchmark's items are TF-IDF vectors over the
items' telling words. A randomised SVD (a sketch of the Gram matrix, summed by
Spark over all passages in one pass that also counts document frequencies)
gives a latent space. Windows of every text are projected into it, and windows
close to an item by cosine are candidates. A candidate stands if the longest
common subsequence of words covers enough of the item, or a good part of it
and its answer (its last words) as well, as in a paraphrase. Items that a text holds word for
word are looked up besides, however short they are and whatever surrounds them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import slices

#: Words of a passage of the corpus (for the SVD), and of the windows that are searched, with their steps; a longer item is cut, the last piece overlapping the one before.
PASSAGE, WINDOWS, ITEM = 48, ((24, 12), (48, 24)), 64
#: Dimensions of the latent space; singular values divide the coordinates to this power.
RANK, WHITEN, SEED = 64, 0.5, 5
#: Words in a larger share of items than this tell little and are no features, but of each item the FEWEST rarest are.
COMMON, FEWEST = 0.02, 6
#: A window is looked at if it has this many features; it is a candidate at this cosine.
HITS, COSINE = 4, 0.5
#: Part of an item's words that a common subsequence covers: alone, or together with the answer's words.
COVERED, WITH_ANSWER, ANSWER_WORDS, ANSWER_COVERED = 0.8, 0.6, 6, 0.8
#: The benchmark is held by every task; a larger one is to be given in parts.
MOST_BYTES = 256 << 20
#: Bytes of text worked on at a time.
SLICE = 2 << 20
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z), parted by white space and ASCII marks."""
    return (text or "").encode().translate(_PLAIN).split()


@dataclass
class Benchmark:
    """Items cut to ITEM words, so that every word is in a piece: ids, words,
    the whole item's answer and how many of its words come after the piece; for
    each word that is a feature its number. For what is looked up word for word:
    the pieces of given words, and for the rarest word of a piece where it
    stands in pieces (its place, their length)."""

    ids: list
    items: list[list[bytes]]
    answers: list[list[bytes]]
    after: list[int]
    features: dict[bytes, int]
    verbatim: dict[tuple, list[int]]
    anchors: dict[bytes, set[tuple[int, int]]]

    @classmethod
    def of(cls, rows: list[tuple]) -> Benchmark:
        ids, items, answers, after = [], [], [], []
        for key, text in rows:
            words = words_of(text)
            for at in [*range(0, len(words) - ITEM, ITEM), max(0, len(words) - ITEM)] if words else []:
                ids.append(key)
                items.append(words[at : at + ITEM])
                answers.append(words[-ANSWER_WORDS:])
                after.append(max(0, len(words) - at - ITEM))
        seen: dict[bytes, int] = {}
        for w in (w for item in items for w in set(item)):
            seen[w] = seen.get(w, 0) + 1
        chosen: set[bytes] = set()
        verbatim: dict[tuple, list[int]] = {}
        anchors: dict[bytes, set[tuple[int, int]]] = {}
        for k, item in enumerate(items):
            rarest = sorted(set(item), key=lambda w: (seen[w], w))
            verbatim.setdefault(tuple(item), []).append(k)
            anchors.setdefault(rarest[0], set()).add((item.index(rarest[0]), len(item)))
            chosen.update(rarest[:FEWEST], (w for w in rarest if seen[w] <= max(2, COMMON * len(items))))
        return cls(ids, items, answers, after, {w: k for k, w in enumerate(sorted(chosen))}, verbatim, anchors)


@dataclass
class Space:
    """The latent space: a row for each feature (its idf times the scaled singular vectors), and the items' unit vectors."""

    rows: np.ndarray
    items: np.ndarray


def hits_of(words: list[bytes], features: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text's features, and their numbers."""
    at = [k for k, w in enumerate(words) if w in features]
    return np.array(at, np.int64), np.array([features[words[k]] for k in at], np.int64)


def _test_vectors(n: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((n, RANK))


def sketch(passage: np.ndarray, feature: np.ndarray, test: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a matrix with a row of word counts per passage: in how many rows each
    column is, and its Gram matrix times the test vectors."""
    n = len(test)
    cells, counts = np.unique(passage * n + feature, return_counts=True)
    row, column = cells // n, cells % n
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    owner = np.cumsum(np.diff(row, prepend=-1) > 0) - 1
    gram = np.empty((n, test.shape[1]))
    for k in range(test.shape[1]):  # one test vector at a time: a number per cell, not a row
        of_row = np.add.reduceat(test[column, k] * counts, starts)[owner] * counts
        gram[:, k] = np.bincount(column, of_row, n)
    return np.bincount(column, minlength=n), gram


def _passages(texts: list[str | None], features: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, int]:
    passage, feature, n = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    for text in texts:
        words = words_of(text)
        at, f = hits_of(words, features)
        passage.append(at // PASSAGE + n)
        feature.append(f)
        n += -(-len(words) // PASSAGE)
    return np.concatenate(passage), np.concatenate(feature), n


def gathered(docs: DataFrame, text: str, bench: Benchmark) -> tuple[int, np.ndarray, np.ndarray]:
    """Over all passages of ``docs``: their number, the features' document
    frequencies, and the Gram matrix times the test vectors. What comes to the
    driver has a row per feature of the benchmark."""
    n, shared = len(bench.features), docs.sparkSession.sparkContext.broadcast(bench)

    def each(batches):
        features, test = shared.value.features, _test_vectors(n)
        total, frequency, gram = 0, np.zeros(n, np.int64), np.zeros((n, RANK))
        for batch in slices(batches, 0, SLICE):
            passage, feature, k = _passages(batch.column(0).to_pylist(), features)
            total += k
            if len(passage):
                f, g = sketch(passage, feature, test)
                frequency += f
                gram += g
        seen = np.flatnonzero(frequency)
        number = np.concatenate([[-1], seen])  # -1: the passages
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(np.concatenate([[total], frequency[seen]]), pa.int64()), *[pa.array(np.concatenate([[0.0], gram[seen, k]])) for k in range(RANK)]], ["feature", "n", *[f"g{k}" for k in range(RANK)]])

    schema = "feature long, n long, " + ", ".join(f"g{k} double" for k in range(RANK))
    sums = docs.select(text).mapInArrow(each, schema).groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(f"g{k}").alias(f"g{k}") for k in range(RANK)])
    total, frequency, gram = 0, np.zeros(n, np.int64), np.zeros((n, RANK))
    for r in sums.toLocalIterator():
        if r[0] < 0:
            total = r[1]
        else:
            frequency[r[0]], gram[r[0]] = r[1], r[2:]
    return total, frequency, gram


def latent_space(bench: Benchmark, passages: int, frequency: np.ndarray, gram: np.ndarray) -> Space:
    """The randomised SVD: for test vectors X, the idf-weighted Gram matrix G
    is nearly (G X)(X' G X)^-1 (G X)', whose eigenvectors come from a thin
    factor. The items take part, with the corpus's weight in all."""
    n, test = len(bench.features), _test_vectors(len(bench.features))
    numbers = [hits_of(item, bench.features)[1] for item in bench.items]
    owner = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
    in_items, gram_items = sketch(owner, np.concatenate(numbers), test)
    weight = max(1.0, float(np.abs(gram).sum()) / max(float(np.abs(gram_items).sum()), 1e-9))
    idf = np.log((passages + len(bench.items) + 1) / (frequency + in_items + 1)) + 0.1
    image = idf[:, None] * (gram + weight * gram_items)  # G X with X = test / idf
    x = test / idf[:, None]
    shift = 1e-9 * np.linalg.norm(image)
    core = x.T @ (image + shift * x)
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    safe = values > values.max() * 1e-10
    factor = (image + shift * x) @ (vectors[:, safe] / np.sqrt(values[safe]))
    left, singular, _ = np.linalg.svd(factor, full_matrices=False)
    rows = (idf[:, None] * left / np.maximum(singular, singular.max() * 1e-6) ** WHITEN).astype(np.float32)
    items = np.stack([rows[x].sum(0) if len(x) else np.zeros(rows.shape[1], np.float32) for x in numbers])
    assert rows.shape[0] == n
    return Space(rows, items / np.maximum(np.linalg.norm(items, axis=1, keepdims=True), 1e-12))


def common_length(item: list[bytes], words: list[bytes]) -> int:
    """Length of the longest common subsequence, by the bits of one number."""
    where: dict[bytes, int] = {}
    for k, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for w in words:
        if m := where.get(w):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(item) - row.bit_count()


def judged(item: list[bytes], words: list[bytes], answer: list[bytes], more: list[bytes]) -> tuple[float, bool, bool]:
    """Part of the item that the words cover in order, whether they and what comes ``more`` hold the answer, and whether it has leaked."""
    part = common_length(item, words) / len(item)
    has_answer = common_length(answer, words + more) >= ANSWER_COVERED * len(answer)
    return part, has_answer, part >= COVERED or (part >= WITH_ANSWER and has_answer)


def candidates(words: list[bytes], bench: Benchmark, space: Space) -> dict[int, list[tuple[int, int, float]]]:
    """item -> windows (first word, end, cosine) near it."""
    at, feature = hits_of(words, bench.features)
    found: dict[int, list[tuple[int, int, float]]] = {}
    if len(at) < HITS:
        return found
    sums = np.concatenate([np.zeros((1, space.rows.shape[1])), np.cumsum(space.rows[feature], axis=0, dtype=np.float64)])
    for size, step in WINDOWS:
        first = np.arange(0, max(1, len(words) - size + step), step)
        low, high = np.searchsorted(at, first), np.searchsorted(at, first + size)
        use = high - low >= HITS
        if not use.any():
            continue
        vectors = (sums[high[use]] - sums[low[use]]).astype(np.float32)
        near = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)) @ space.items.T
        window, item = np.nonzero(near >= COSINE)
        for w, i in zip(window.tolist(), item.tolist()):
            start = int(first[use][w])
            found.setdefault(i, []).append((start, min(len(words), start + size), float(near[w, i])))
    return found


def held_verbatim(words: list[bytes], bench: Benchmark) -> dict[int, int]:
    """item -> first place where the words hold it word for word."""
    found: dict[int, int] = {}
    for k, w in enumerate(words):
        for place, size in bench.anchors.get(w, ()):
            if place <= k and k - place + size <= len(words):
                for i in bench.verbatim.get(tuple(words[k - place : k - place + size]), ()):
                    found.setdefault(i, k - place)
    return found


def leaks_of(text: str | None, bench: Benchmark, space: Space) -> list[tuple]:
    """(item id, cosine, part covered, answer held, first word, end) of the items that a text holds; the best of an item's places."""
    words = words_of(text)
    best: dict = {}
    for i, windows in candidates(words, bench, space).items():
        item, reached = bench.items[i], -1
        have = set(item)
        for start, end, cosine in sorted(windows):
            low, high = max(0, start - len(item)), min(len(words), end + len(item))
            if high <= reached or len(have.intersection(words[low:high])) < WITH_ANSWER * len(have):
                continue
            after = bench.after[i]
            part, answer, leaked = judged(item, words[low:high], bench.answers[i], words[high : high + after + after // 4])
            if leaked:
                reached = high
                row = (bench.ids[i], cosine, part, answer, low, high)
                if bench.ids[i] not in best or best[bench.ids[i]][2] < part:
                    best[bench.ids[i]] = row
    for i, low in held_verbatim(words, bench).items():
        if bench.ids[i] not in best or best[bench.ids[i]][2] < 1:
            high, after = low + len(bench.items[i]), bench.after[i]
            _, answer, _ = judged(bench.items[i], words[low:high], bench.answers[i], words[high : high + after + after // 4])
            best[bench.ids[i]] = (bench.ids[i], 1.0, 1.0, answer, low, high)
    return list(best.values())


def prepared(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> tuple[Benchmark, Space] | None:
    """The benchmark and its latent space over all passages of ``docs``; None if no item has a word."""
    size = benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"a benchmark of {size} bytes; give it in parts of {MOST_BYTES} bytes at most")
    bench = Benchmark.of([(r[0], r[1]) for r in benchmark.where(F.col(text).isNotNull()).select(item_id, text).orderBy(item_id, text).collect()])
    if not bench.items:
        return None
    return bench, latent_space(bench, *gathered(docs, text, bench))


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, item_id, cosine, covered, answer, first_word, end_word: a row
    for each item that a row of ``docs`` holds. Null and empty texts hold none;
    null and empty items are passed over; item ids are integers."""
    schema = "doc_id long, item_id long, cosine double, covered double, answer boolean, first_word long, end_word long"
    made = prepared(docs, benchmark, text)
    if made is None:
        return docs.sparkSession.createDataFrame([], schema)
    shared = docs.sparkSession.sparkContext.broadcast(made)
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64())
    names = [c.split()[0] for c in schema.split(", ")]

    def each(batches):
        for batch in slices(batches, 1, SLICE):
            rows = [(d, *r) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in leaks_of(t, *shared.value)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(each, schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item of the benchmark."""
    made = prepared(docs, benchmark, text)
    if made is None:
        return docs
    shared, at = docs.sparkSession.sparkContext.broadcast(made), docs.columns.index(text)

    def each(batches):
        for batch in slices(batches, at, SLICE):
            yield batch.filter(pa.array([not leaks_of(t, *shared.value) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(each, docs.schema)
