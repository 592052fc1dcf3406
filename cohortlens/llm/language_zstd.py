"""Language identification by compression.

For each language a raw-content zstandard dictionary is made from sample
texts. A text, in lower case, is cut into blocks, each compressed with every dictionary; the
language whose sizes sum to the least is chosen, and the choice is rejected
where it leads the next by less than a margin.
"""

from __future__ import annotations

import re
from collections import defaultdict

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import broadcast_if_small, slices, smallest_by_hash, stage

#: Sample texts per language, at most, chosen by a hash of their ids; characters taken from one; bytes of a dictionary.
ROWS, PIECE, DICTIONARY = 400, 800, 256 << 10
#: Bytes of a text compressed at a time: beyond that a text would be its own dictionary.
BLOCK = 4 << 10
LEVEL = 3
#: A choice that saves less than this share of the next smallest size is rejected.
MARGIN = 0.01
UNKNOWN = "und"
_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m.group().isalpha() for m in _WORDLIKE.finditer(text))


def sample(docs: DataFrame, learn_from: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> dict[str, bytes]:
    """A dictionary for each language that rows with ``learn_from`` name, from
    ROWS pieces per language at most; rows without an id are passed over."""
    rows = docs.where(learn_from & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(doc_id).alias("id"), F.substring(text, 1, PIECE).alias("text"))
    chosen = stage(smallest_by_hash(rows.select("lang", "id").where("id is not null").distinct(), "lang", "id", ROWS), "language-sample")
    found = defaultdict(list)
    pieces = rows.join(broadcast_if_small(chosen), ["lang", "id"]).groupBy("lang", "id").agg(F.min("text").alias("text"))
    for r in sorted(pieces.collect(), key=lambda r: (r["lang"], xxhash.xxh64_intdigest(str(r["id"])))):
        found[r["lang"]].append(r["text"].lower().encode())
    return {k: b"\n".join(v)[:DICTIONARY] for k, v in found.items()}


class Compressors:
    """One compressor per language; dictionaries are digested once."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.languages = sorted(dictionaries)
        self.each = []
        for k in self.languages:
            d = zstandard.ZstdCompressionDict(dictionaries[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.each.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False))

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode()
        blocks = [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.each]

    def choose(self, text: str | None) -> tuple[str, float, bool]:
        """Language, lead over the next (0 to 1), and whether the lead suffices."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        ranked = sorted(zip(self.sizes(text), self.languages))
        lead = 1 - ranked[0][0] / ranked[1][0] if len(ranked) > 1 else 1.0
        return ranked[0][1], lead, lead >= MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score (the lead, 0 to 1) and accepted for every row's
    whole text. Null texts, texts without a letter, and all texts if no
    language was learnt, are UNKNOWN with score 0; equal sizes go to the
    language that sorts first, and are not accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # DICTIONARY bytes per language

    def each(batches):
        compressors = Compressors(shared.value)
        for batch in slices(batches, 1):
            found = [compressors.choose(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())], ["doc_id", "lang_pred", "score", "accepted"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(each, "doc_id long, lang_pred string, score double, accepted boolean")
