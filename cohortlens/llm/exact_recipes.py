"""Exact duplicates by content-defined chunk recipes.

A text, without its white space, is cut where a rolling hash of its own bytes
says so; a recipe is the ordered list of its chunks' identifiers. Chunks are
deduplicated over the corpus by their bytes: an identifier is a 128-bit digest,
and where two different chunks have one digest, the digest and a number. So
equal recipes mean equal bytes, and texts are compared by short lists; the
bytes of a chunk leave a task once, however many of its documents hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import row_id, slices, stage, with_group_result

WHITE = b" \t\n\x0b\x0c\r"
#: Bytes of a chunk: at least, on average beyond that, at most.
LEAST, MEAN, MOST = 512, 2048, 8192
#: Bytes a boundary depends on: the rolling hash forgets what is older.
WINDOW = 32
#: Positions hashed at a time.
BLOCK = 1 << 20
_GEAR = np.random.default_rng(4).integers(0, 1 << 32, 256, dtype=np.uint32)


def digest(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def boundaries(data: bytes) -> np.ndarray:
    """Ends (exclusive) at which the rolling hash of the WINDOW bytes before allows a cut."""
    found, all_bytes = [], np.frombuffer(data, np.uint8)
    for at in range(0, len(data), BLOCK):
        low = max(0, at - WINDOW + 1)
        h, shift = _GEAR[all_bytes[low : at + BLOCK]], 1
        while shift < WINDOW:  # after each step h covers twice as many bytes
            h[shift:] += h[:-shift] << np.uint32(shift)
            shift *= 2
        found.append(np.flatnonzero(h[at - low :] < np.uint32((1 << 32) // MEAN)) + at + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def cut(data: bytes, allowed: np.ndarray, start: int, end: int) -> list[bytes]:
    """The chunks of data[start:end]; they depend on nothing outside it."""
    chunks = []
    inside = allowed[allowed.searchsorted(start + LEAST) : allowed.searchsorted(end)]
    while start < end:
        k = inside.searchsorted(start + LEAST)
        stop = min(int(inside[k]) if k < len(inside) else end, start + MOST, end)
        chunks.append(data[start:stop])
        start = stop
    return chunks


def _normalised(column: pa.Array) -> Iterator[tuple[bytes, list[bytes]]]:
    """For each text of the column: its bytes without white space, and their chunks."""
    plain = [(x or "").encode().translate(None, WHITE) for x in column.to_pylist()]
    together = b"".join(plain)
    allowed, at = boundaries(together), 0
    for text in plain:
        yield text, cut(together, allowed, at, at + len(text))
        at += len(text)


def _recipes(name: Callable[[bytes], bytes]):
    def each(batches):
        for batch in slices(batches, 1):
            ids, shas = [], []
            for text, chunks in _normalised(batch.column(1)):
                ids.append([name(c) for c in chunks])
                shas.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(shas, pa.string()), pa.array(ids, pa.list_(pa.binary()))], ["doc_id", "n_chars", "text_sha256", "recipe"])

    return each


def _chunks(name: Callable[[bytes], bytes]):
    def each(batches):
        for batch in slices(batches, 0):
            seen: dict[bytes, bytes] = {}
            for _, chunks in _normalised(batch.column(0)):
                seen.update((c, name(c)) for c in chunks)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen.values()), pa.binary()), pa.array(list(seen), pa.binary())], ["digest", "chunk"])

    return each


def _places(name: Callable[[bytes], bytes]):
    def each(batches):
        for batch in slices(batches, 0):
            rows = [(hashlib.sha256(text).hexdigest(), k, name(c), c) for text, chunks in _normalised(batch.column(0)) for k, c in enumerate(chunks)]
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.binary(), pa.binary()))], ["text_sha256", "at", "digest", "chunk"])

    return each


def recipes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", name: Callable[[bytes], bytes] = digest) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars (code points of the text),
    text_sha256 (of the normalised text), recipe (digests in order), variants
    (numbers that tell chunks of one digest apart, in order; null when its
    digests each stand for one chunk), and row, a number of its own. Null
    texts count as empty and have an empty recipe."""
    only = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"))
    found = stage(only.mapInArrow(_recipes(name), "doc_id long, n_chars long, text_sha256 string, recipe array<binary>").withColumn("row", row_id()), "recipes")
    contents = only.select("text").mapInArrow(_chunks(name), "digest binary, chunk binary").groupBy("digest", "chunk").agg(F.lit(1).alias("one"))
    shared = stage(contents.groupBy("digest").agg(F.sum("one").alias("n")).where("n > 1").select("digest"), "shared-digests")
    if shared.isEmpty():  # each digest stands for one chunk, as the bytes have shown
        return found.withColumn("variants", F.lit(None).cast("array<int>"))
    rank = F.row_number().over(Window.partitionBy("digest").orderBy("chunk"))
    numbers = contents.join(shared, "digest", "left_semi").select("digest", "chunk", rank.alias("variant"))
    places = only.select("text").mapInArrow(_places(name), "text_sha256 string, at int, digest binary, chunk binary").distinct()
    told = places.join(numbers, ["digest", "chunk"]).groupBy("text_sha256").agg(F.array_sort(F.collect_list(F.struct("at", "variant"))).getField("variant").alias("variants"))
    return found.join(told, "text_sha256", "left").select(*found.columns, "variants")


def duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", name: Callable[[bytes], bytes] = digest) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, n_chunks. Of texts that are equal without white space the one
    with the most code points stays, then the smallest doc_id (a null doc_id
    last); of repeated rows that tie in both, one. Null and empty texts are
    one group. An empty table gives an empty result."""
    rows = recipes(docs, text, doc_id, name)
    best = F.struct("n_chars", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("low"), F.bitwise_not("row").alias("first"))
    grouped = with_group_result(rows, ["recipe", "variants"], F.col("row"), {"best": ("max", best), "group_size": ("sum", F.lit(1).cast("long"))})
    return grouped.select("doc_id", F.bitwise_not(F.col("best.low")).alias("keep_id"), "group_size", (F.bitwise_not(F.col("best.first")) == F.col("row")).alias("kept"), "text_sha256", F.size("recipe").alias("n_chunks"))
