"""Toxicity by subword-bag embeddings and a linear softmax, in numpy.

A word is the bag of its character n-grams and itself, each hashed to a bucket
that has a vector; a document is the mean over its distinct words of the means
over their subwords; a linear softmax tells the classes. Vectors and softmax
are trained together, by steps with momentum in proportion to the gradient (a
step per number, as large for rare noise as for telling subwords, would learn
the noise). A misspelling that was never seen shares most of its n-grams with
the word it stands for, and so the vectors.

Training runs in one task on a bounded sample (TOXIC_ROWS, CLEAN_ROWS, texts of
up to LONGEST characters); what the driver and the scoring tasks get is one
number per bucket, the softmax's margin of its vector, as that is all a score needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import slices, smallest_by_hash, stage

#: Labelled rows to learn from, at most, by label, chosen by a hash of their ids; longer texts are passed over.
TOXIC_ROWS, CLEAN_ROWS, LONGEST = 1_000, 2_000, 20_000
#: n-grams, hashed to 2 ** BITS buckets with vectors of SIZE numbers.
SHORTEST_GRAM, LONGEST_GRAM, BITS, SIZE = 3, 5, 18, 4
#: A bucket has a vector if it is in this share of the sample's documents, and in FEWEST of them.
RARE, COMMON, FEWEST = 0.01, 0.5, 3
#: Words that count as neutral in every document: a few words alone say little.
NEUTRAL = 40
EPOCHS, RATE, SCALE, SEED = 60, 0.3, 50.0, 1
#: Documents with this score are predicted toxic.
THRESHOLD = 0.7
#: Words whose margins a worker keeps; bytes of text it scores at a time; words of the sample whose subwords are formed at a time.
KEPT, SLICE, WORDS = 300_000, 2 << 20, 20_000
_FACTOR = np.random.default_rng(11).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' n-grams (of bytes, borders marked) and of the words themselves, and for each the word's place in the list."""
    data = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner, starts = np.repeat(np.arange(len(words)), lengths), np.cumsum(lengths) - lengths
    within = np.arange(len(data)) - starts[owner]
    hashes, owners = [np.add.reduceat(data * _FACTOR[0] ** within.astype(np.uint64), starts)], [np.arange(len(words))]
    for n in range(SHORTEST_GRAM, LONGEST_GRAM + 1):
        last = len(data) - n + 1
        inside = np.flatnonzero(owner[:last] == owner[n - 1 :]) if last > 0 else np.empty(0, np.int64)
        hashes.append(sum(data[inside + j] * _FACTOR[n * 8 + j] for j in range(n)) if len(inside) else np.empty(0, np.uint64))
        owners.append(owner[inside])
    return (np.concatenate(hashes) * _FACTOR[1] >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


def bag(text: str | None) -> set[bytes]:
    return set((text or "").lower().encode().split())


@dataclass
class Model:
    """A margin (of class 1 over class 0) for each bucket, and the bias."""

    margins: np.ndarray
    bias: float

    def score(self, texts: list[str | None], known: dict[bytes, float]) -> np.ndarray:
        """0 to 1; texts without words have 0. ``known`` keeps words' margins from call to call."""
        out, bags = np.zeros(len(texts)), [bag(t) for t in texts]
        if len(known) > KEPT:
            known.clear()
        if new := [w for w in set().union(*bags) if w not in known]:
            buckets, owners = subwords(new)
            sums, counts = np.bincount(owners, self.margins[buckets], len(new)), np.bincount(owners, minlength=len(new))
            known.update(zip(new, (sums / counts).tolist()))
        for k, words in enumerate(bags):
            if not words:
                continue
            z = SCALE * sum(map(known.__getitem__, words)) / (len(words) + NEUTRAL) + self.bias
            out[k] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows of the given lengths; of an empty run, 0."""
    out, full = np.zeros((len(counts), values.shape[1]), np.float32), counts > 0
    if full.any():
        out[full] = np.add.reduceat(values, (np.cumsum(counts) - counts)[full])
    return out


def _subwords_in_order(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and places as ``subwords`` gives them, word by word; a bounded number of words at a time."""
    buckets, owners = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
    for at in range(0, len(words), WORDS):
        bucket, owner = subwords(words[at : at + WORDS])
        order = np.argsort(owner, kind="stable")
        buckets.append(bucket[order].astype(np.int32))
        owners.append((owner[order] + at).astype(np.int32))
    return np.concatenate(buckets), np.concatenate(owners)


def fit(texts: list[str], labels: list[int]) -> Model:
    """Train on texts and their labels (0 or 1). Without both labels every score is that of the label there is."""
    kept = [(t, k) for t, k in zip(texts, labels) if bag(t)]
    if len({k for _, k in kept}) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 30.0 if kept and kept[0][1] else -30.0)
    vocabulary: dict[bytes, int] = {}
    y = np.asarray([k for _, k in kept], np.float32)
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in sorted(bag(t))], np.int32) for t, _ in kept]
    per_doc, word = np.array([len(d) for d in docs]), np.concatenate(docs)
    bucket, owner = _subwords_in_order(list(vocabulary))
    total = np.bincount(owner, minlength=len(vocabulary)).astype(np.float32)
    first = np.cumsum(total.astype(np.int64)) - total.astype(np.int64)
    seen_in = np.zeros(1 << BITS, np.int32)
    for d in docs:
        seen_in[np.unique(np.concatenate([bucket[first[w] : first[w] + int(total[w])] for w in d]))] += 1
    use = ((seen_in >= max(FEWEST, RARE * len(docs))) & (seen_in <= COMMON * len(docs)))[bucket]
    # words by bucket and documents by word, and the same the other way for the gradients
    bucket, per_word = bucket[use], np.bincount(owner[use], minlength=len(vocabulary))
    by_bucket, by_word = np.argsort(bucket, kind="stable"), np.argsort(word, kind="stable")
    word_of = np.repeat(np.arange(len(vocabulary), dtype=np.int32), per_word)[by_bucket]
    doc_of = np.repeat(np.arange(len(docs), dtype=np.int32), per_doc)[by_word]
    del by_bucket, by_word, owner
    used, per_bucket = np.unique(bucket, return_counts=True)
    per_word_docs = np.bincount(word, minlength=len(vocabulary))
    place = np.searchsorted(used, bucket).astype(np.int32)
    share, part = (SCALE / (per_doc + NEUTRAL)).astype(np.float32)[:, None], (1 / np.maximum(total, 1))[:, None]
    rng = np.random.default_rng(SEED)
    vectors, softmax, bias = (rng.standard_normal((len(used), SIZE)) * 0.01).astype(np.float32), rng.standard_normal((SIZE, 2)).astype(np.float32), np.zeros(2, np.float32)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()).astype(np.float32)[:, None]
    right = np.stack([1 - y, y], 1)
    moments = [np.zeros_like(p) for p in (vectors, softmax, bias)]
    for epoch in range(1, EPOCHS + 1):
        words = _sums(vectors[place], per_word) * part
        hidden = _sums(words[word], per_doc) * share
        z = hidden @ softmax + bias
        p = np.exp(z - z.max(1, keepdims=True))
        wrong = (p / p.sum(1, keepdims=True) - right) * weight
        from_docs = (wrong @ softmax.T) * share
        from_words = _sums(from_docs[doc_of], per_word_docs) * part
        steps = (_sums(from_words[word_of], per_bucket), hidden.T @ wrong, wrong.sum(0))
        for value, step, m, rate in zip((vectors, softmax, bias), steps, moments, (RATE, RATE / 10, RATE / 10)):
            m += 0.1 * (step - m)
            value -= rate * (1 - epoch / (EPOCHS + 1)) * m / (np.abs(m).max() + 1e-12)
    margins = np.zeros(1 << BITS, np.float32)
    margins[used] = vectors @ (softmax[:, 1] - softmax[:, 0])
    return Model(margins, float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame, learn_from: Callable[[Column], Column], text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Model:
    """A model from the rows of ``docs`` whose id ``learn_from`` accepts and
    ``labels`` (doc_id, label) marks 0 or 1; null texts are passed over. The
    sample is drawn from the ids, so the corpus is read but not moved."""
    told = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & learn_from(F.col(doc_id))).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("label"))
    sizes = docs.select(F.col(doc_id).alias("id"), F.length(text).alias("n")).where(F.col("n") <= LONGEST).select("id")
    known = told.join(sizes, "id", "left_semi")
    by_label = [smallest_by_hash(known.where(F.col("label") == k), "label", "id", most) for k, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]
    chosen = stage(by_label[0].union(by_label[1]), "toxicity-sample")
    rows = docs.where(F.length(text) <= LONGEST).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    picked = stage(rows.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text")), "toxicity-texts")  # TOXIC_ROWS + CLEAN_ROWS at most
    fitted = picked.repartition(1).sortWithinPartitions("label", "id").select("label", "text").mapInArrow(_fit_rows, "margins binary, bias double").first()
    if fitted is None:  # nothing to learn from, and Spark ran no task
        return fit([], [])
    return Model(np.frombuffer(fitted["margins"], np.float32), fitted["bias"])


def _fit_rows(batches):
    """One row with the model of the task's rows (label, text); the sample is one task's."""
    labels, found = [], []
    for batch in batches:
        labels += batch.column(0).to_pylist()
        found += batch.column(1).to_pylist()
    model = fit(found, labels)
    yield pa.RecordBatch.from_arrays([pa.array([model.margins.astype(np.float32).tobytes()], pa.binary()), pa.array([model.bias])], ["margins", "bias"])


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and the score of every row's whole text; null and empty texts score 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 1 MB, whatever the corpus

    def each(batches):
        known: dict[bytes, float] = {}
        for batch in slices(batches, 1, SLICE):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(batch.column(1).to_pylist(), known), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(each, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    """Whether a document is set aside for testing: by its id alone, a third."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def not_held_out(doc_id: Column) -> Column:
    return ~held_out(doc_id)


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below THRESHOLD."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def each(batches):
        known: dict[bytes, float] = {}
        for batch in slices(batches, at, SLICE):
            yield batch.filter(pa.array(shared.value.score(batch.column(at).to_pylist(), known) < THRESHOLD))

    return docs.mapInArrow(each, docs.schema)
