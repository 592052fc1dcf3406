"""Hard negatives by a secondary sort.

Anchors are scored against all rows in blocks: a bounded block of anchors is
sent to every task, which multiplies it with slices of its rows. What leaves a
task is what can still be in the result, so pairs are never shuffled as such:

1. each task's best rows of the anchor's label give the anchor's positives;
2. each positive opens a window of scores, and each task keeps, per window, the
   best rows of other labels in it.

Both are packed into keys (anchor, descending score, positive or negative, id)
that ``repartitionAndSortWithinPartitions`` brings together and sorts by the
shuffle itself. An iterator streams over the keys of a partition: a positive
opens its window, a negative is given out to the windows that hold its score, a
window that is full or has been passed is closed. No anchor's rows are gathered.

Rows with a null id, label or vector, or with a null or non-finite component,
take no part. Equal rows (id, label and vector) count once; rows of one id that
differ are rows, but never of use to an anchor of that id. A vector that is
shorter than another counts as followed by zeros. Scores are exact whole
numbers; those beyond 64 bits are cut to the largest or smallest of them.
An empty table, or one without anchors, gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import stage, staged_in_order

POSITIVES, NEGATIVES = 5, 3
#: The window of a positive's score, in hundredths, both ends included.
LOW, HIGH = 50, 95
#: Components become floor(SCALE * x).
SCALE = 256
#: Bytes of anchors in a block, and numbers in one product of anchors and rows.
ANCHOR_BYTES, PRODUCT = 16 << 20, 2 << 20
_POSITIVE, _NEGATIVE = 0, 1
_KEY = np.dtype([("anchor", ">u8"), ("number", ">u8"), ("down", ">u8"), ("kind", "u1"), ("id", ">u8")])
_SIGN, _LEAST, _MOST = np.uint64(1 << 63), np.iinfo(np.int64).min, np.iinfo(np.int64).max


def matrix(vectors: pa.Array) -> np.ndarray:
    """floor(SCALE * x) of all components, shorter vectors filled with zeros."""
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def product(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit numbers. In floating point while every partial
    sum is a whole number below 2 ** 53, so exact; in whole numbers beyond."""
    n = min(anchors.shape[1], rows.shape[1])
    a, b = anchors[:, :n], rows[:, :n]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * n
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if most < 2.0**62 and max(np.abs(a).max(), np.abs(b).max()) < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.array([[int(x) for x in v] for v in a], object) @ np.array([[int(x) for x in v] for v in b], object).T
    return np.clip(whole, _LEAST, _MOST).astype(np.int64)


class Best:
    """Per group the ``most`` best (score, id) met so far: higher scores first, then smaller ids; equal ones count once."""

    def __init__(self, groups: int, most: int):
        self.most, self.group, self.score, self.id = most, *(np.empty(0, np.int64) for _ in range(3))
        #: A score below its group's bar is of no use any more.
        self.bar = np.full(groups, _LEAST)

    def add(self, group: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(group):
            return
        group, score, id_ = np.concatenate([self.group, group]), np.concatenate([self.score, score]), np.concatenate([self.id, id_])
        order = np.lexsort((id_, ~score, group))
        group, score, id_ = group[order], score[order], id_[order]
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | (score[1:] != score[:-1]) | (id_[1:] != id_[:-1])
        group, score, id_ = group[new], score[new], id_[new]
        first = np.searchsorted(group, group)
        place = np.arange(len(group)) - first
        keep = place < self.most
        self.group, self.score, self.id = group[keep], score[keep], id_[keep]
        full = place == self.most - 1
        self.bar[group[full]] = score[full]


class Block:
    """A bounded block of anchors: number, id, label and vector of each; with their windows once positives are known."""

    def __init__(self, number: np.ndarray, id_: np.ndarray, label: np.ndarray, vectors: np.ndarray):
        self.number, self.id, self.label, self.vectors = number, id_, label, vectors
        self.low = self.high = None

    def open(self, scores: np.ndarray, low: int, high: int) -> None:
        """Windows from the positives' scores, (anchors, positives), with _LEAST where there is none."""
        there = scores != _LEAST
        bound = lambda p, f: f(int(p))
        self.low = np.array([[bound(p, lambda p: -(-low * p // 100)) if x else _MOST for p, x in zip(*r)] for r in zip(scores, there)], np.int64).reshape(scores.shape)
        self.high = np.array([[bound(p, lambda p: high * p // 100) if x else _LEAST for p, x in zip(*r)] for r in zip(scores, there)], np.int64).reshape(scores.shape)

    def products(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Scores (anchors, rows), ids and labels of the rows (id, label, vector), a bounded number at a time."""
        step = max(1, PRODUCT // max(1, len(self.id)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                yield product(self.vectors, matrix(part.column(2))), part.column(0).to_numpy(), part.column(1).to_numpy()


def _positives(block, most: int):
    def each(batches):
        own = block.value
        best = Best(len(own.id), most)
        for score, id_, label in own.products(batches):
            a, r = np.nonzero((score >= best.bar[:, None]) & (own.label[:, None] == label) & (own.id[:, None] != id_))
            best.add(a, score[a, r], id_[r])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own.number[best.group], best.score, best.id)], ["number", "score", "id"])

    return each


def _negatives(block, most: int):
    def each(batches):
        own = block.value
        per = own.low.shape[1]
        best = Best(len(own.id) * per, most)
        for score, id_, label in own.products(batches):
            other = (own.label[:, None] != label) & (own.id[:, None] != id_)
            for k in range(per):
                bar = np.maximum(own.low[:, k], best.bar[k::per])
                a, r = np.nonzero(other & (score >= bar[:, None]) & (score <= own.high[:, k][:, None]))
                best.add(a * per + k, score[a, r], id_[r])
        found = np.unique(np.stack([best.group // per, best.score, best.id]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own.number[found[0]], found[1], found[2])], ["number", "score", "id"])

    return each


def _keys(id_of: dict, kind: int):
    """Packed keys of the rows (number, score, id); ids and numbers of a block's anchors are in ``id_of``."""

    def each(batches):
        for batch in batches:
            number, score, id_ = (batch.column(k).to_numpy() for k in range(3))
            keys = np.empty(len(number), _KEY)
            own = id_of.value
            keys["anchor"], keys["number"] = own.id[np.searchsorted(own.number, number)].astype(np.uint64) ^ _SIGN, number
            keys["down"], keys["kind"], keys["id"] = ~(score.astype(np.uint64) ^ _SIGN), kind, id_.astype(np.uint64) ^ _SIGN
            ends = pa.array(np.arange(len(keys) + 1) * _KEY.itemsize, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.BinaryArray.from_buffers(pa.binary(), len(keys), [None, ends.buffers()[1], pa.py_buffer(keys.tobytes())])], ["key"])

    return each


def _anchor_of(key: bytes) -> int:
    """Keys of an anchor go to one partition, consecutive anchors to different ones."""
    return int.from_bytes(key[8:16], "big")


def _stream(positives: int, negatives: int, low: int, high: int):
    """Results from the keys of a partition, in their order; what is held is an anchor's open windows."""

    def each(pairs):
        anchor, last, windows, opened = None, None, [], 0
        for key, _ in pairs:
            if key == last:
                continue
            last = key
            if key[:16] != anchor:
                anchor, windows, opened = key[:16], [], 0
            score, id_ = (1 << 63) - 1 - int.from_bytes(key[16:24], "big"), int.from_bytes(key[25:], "big") - (1 << 63)
            if key[24] == _POSITIVE:
                if opened < positives:
                    windows.append([id_, score, 0])
                    opened += 1
                continue
            for window in windows:
                if low * window[1] <= 100 * score <= high * window[1]:
                    window[2] += 1
                    yield int.from_bytes(anchor[:8], "big") - (1 << 63), window[0], window[2], id_, window[1], score
            windows = [w for w in windows if w[2] < negatives and 100 * score >= low * w[1]]

    return each


def hard_negatives(rows: DataFrame, is_anchor: Column, id_: str = "vec_id", label: str = "label", vector: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row's score is its integer inner product with the anchor; higher scores
    come first, ties by smaller id. An anchor's positives are its first
    ``positives`` other rows of its label; for each, the first ``negatives`` rows
    of other labels with a score of ``low`` to ``high`` hundredths of its own are
    returned. A positive of a negative score has none. Labels are whole numbers."""
    spark = rows.sparkSession
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    used = rows.where(F.col(id_).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    narrow = [F.col(id_).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector")]
    table = used.select(*narrow)
    anchors = staged_in_order(used.where(is_anchor).select(*narrow).distinct(), [F.col("id"), F.col("label"), F.xxhash64("vector")], "anchors", "number")
    shape = anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("size")).first()
    step, found = max(1, ANCHOR_BYTES // (8 * max(1, shape["size"] or 1))), []
    for first in range(0, shape["n"], step):
        own = anchors.where((F.col("number") >= first) & (F.col("number") < first + step)).orderBy("number").toArrow().combine_chunks()  # a bounded block
        block = Block(*(own.column(c).to_numpy() for c in ("number", "id", "label")), matrix(own.column("vector").chunk(0)))
        sent = spark.sparkContext.broadcast(block)
        near = table.mapInArrow(_positives(sent, positives), "number long, score long, id long")
        order = Window.partitionBy("number").orderBy(F.desc("score"), "id")
        near = stage(near.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives), "positives")
        known = near.select("number", "place", "score").toArrow()  # ``positives`` per anchor of the block
        scores = np.full((len(block.id), positives), _LEAST)
        scores[known.column("number").to_numpy() - first, known.column("place").to_numpy() - 1] = known.column("score").to_numpy()
        block.open(scores, low, high)
        windows = spark.sparkContext.broadcast(block)
        far = table.mapInArrow(_negatives(windows, negatives), "number long, score long, id long")
        keys = near.select("number", "score", "id").mapInArrow(_keys(sent, _POSITIVE), "key binary").union(far.mapInArrow(_keys(sent, _NEGATIVE), "key binary"))
        found.append(stage(keys, "pairs"))
        sent.destroy()
        windows.destroy()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not found:
        return spark.createDataFrame([], schema)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_keys = reduce(DataFrame.union, found).rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(parts, _anchor_of)
    return spark.createDataFrame(sorted_keys.mapPartitions(_stream(positives, negatives, low, high)), schema, verifySchema=False)
