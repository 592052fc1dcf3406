"""Token ids in ORC files.

Documents are dealt by ranges of doc_id and sorted, so files, and stripes and
row groups in them, hold narrow ranges of ids: ORC's row indexes (minimum and
maximum) and Bloom filters on doc_id let a reader skip all but the stripes it
needs, and stripes are read in parallel. Token ids are lists of integers in
ORC's run-length encoding. Each file also carries its shard number and each
row the ids before it in its shard, so a global start needs one sum per shard.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import new_folder, slices, texts

#: Ends each document.
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a worker keeps; longer words are encoded each time; words encoded at a time.
KEPT_WORDS, KEPT_LENGTH, TOGETHER = 250_000, 40, 5_000
#: Bytes that are not ASCII marks, and ASCII marks behind them (no digits, no apostrophe: those have rules of their own).
_MARKED = re.compile(rb"([a-z\x80-\xff]+)([!-&(-/:-@\[-`{-~]+)").fullmatch
#: The same as a pattern of Arrow's, for letters that composition and lower case leave letters (ASCII, Latin-1 and some more).
_LATIN_MARKED = r"^([a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}]+)([!-&(-/:-@\[-`{-~]+)$"
#: Bytes of text encoded together.
SLICE = 2 << 20
#: Rows of an ORC row group, which has an index entry and a Bloom filter of its own; bytes of a stripe.
ROW_GROUP, STRIPE = 2_000, 16 << 20
SCHEMA = "doc_id long, ids array<int>, n_tokens long, shard int, shard_start long"


def public_vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _letters(word: bytes) -> bool:
    """Whether a lower-cased word is letters only, also once the vocabulary's rules
    (composition, lower case) are applied: a capital I with a dot, or a Hindi letter
    that is excluded from composition, becomes a letter and a mark, and marks go
    together with those behind them."""
    return word.isalpha() or (not word.isascii() and unicodedata.normalize("NFC", word.decode()).lower().isalpha() and unicodedata.normalize("NFC", word.decode().lower()).isalpha())


#: The rules that ``_encoder`` relies on when it takes texts apart: of the normaliser, the words' pattern, and the bytes of a word.
_RULES = (
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "</w>",
)


def _words_apart(path: str) -> bool:
    """Whether a tokenizer file has the rules under which a text's ids are those of its words."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    normalizer, pre = spec.get("normalizer") or {}, (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    special = all(t["content"].startswith("<|") and not t["lstrip"] and not t["rstrip"] for t in spec["added_tokens"])
    return special and (normalizer.get("normalizers"), pre[0].get("pattern"), spec["model"].get("end_of_word_suffix")) == _RULES


def _strings(column: pa.Array | list[str]) -> pa.Array:
    """The strings as an Arrow array; null counts as empty."""
    return pc.fill_null(pa.array(column, pa.string()) if isinstance(column, list) else column.cast(pa.string()), "")


def _put_together(ids: np.ndarray, each: np.ndarray, elements: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of rows of elements one behind the other, and how many a row has.
    ``ids``, ``each``: those of the distinct elements; ``elements``: which of
    them the rows hold; ``of``: how many elements a row has."""
    n = each[elements]
    ends = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat((np.cumsum(each) - each)[elements] - ends[:-1], n) + np.arange(ends[-1])
    return ids[at], np.diff(ends[np.concatenate([[0], np.cumsum(of)])])


@functools.lru_cache(2)
def _encoder(path: str):
    """Texts -> the bytes of their ids (little-endian, 4 bytes each).

    The public vocabulary's rules lower case, drop white space and let no token
    cross it, nor the border of letters and others; so a text's ids are those
    of its words, and a worker keeps the ids of words that it has met. With a
    vocabulary of other rules, texts are encoded whole."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores in use
    from tokenizers import Tokenizer

    tokenizer, known, older = Tokenizer.from_file(path), {}, {}
    tokenizer.no_truncation()
    tokenizer.no_padding()
    ids_of = lambda text: np.asarray(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<i4")
    if not _words_apart(path):
        return lambda batch: [ids_of(t).tobytes() for t in texts(_strings(batch))]
    ends_word = np.zeros(tokenizer.get_vocab_size(), bool)
    ends_word[[k for token, k in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def learn(words: list[bytes]) -> None:
        """Words of letters are encoded together: each ends at its first token that ends a word."""
        plain = [w for w in words if w.isalpha() or _letters(w)]
        for at in range(0, len(plain), TOGETHER):
            part = plain[at : at + TOGETHER]
            ids = ids_of(b" ".join(part).decode())
            stops = (np.flatnonzero(ends_word[ids]) + 1).tolist()
            if len(stops) != len(part):
                known.update((w, ids_of(w.decode()).tobytes()) for w in part)
                continue
            data, start = ids.tobytes(), 0
            for w, stop in zip(part, stops):
                known[w] = data[4 * start : 4 * stop]
                start = stop
        known.update((w, ids_of(w.decode()).tobytes()) for w in words if w not in known)

    def encode(batch: pa.Array) -> list[bytes]:
        # special tokens are found in a text as it stands, so a text that may hold one is encoded whole
        nonlocal known, older
        whole = pc.match_substring(batch, "<|")
        split = pc.split_pattern(pc.replace_substring(pc.ascii_lower(batch), "\n", " "), " ")
        words = split.flatten().dictionary_encode()  # each distinct word is taken apart once, and each distinct part looked up once
        apart = pc.split_pattern(pc.replace_substring_regex(words.dictionary, _LATIN_MARKED, r"\1 \2"), " ")
        pieces = apart.flatten().dictionary_encode()
        distinct = pieces.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if len(known) > KEPT_WORDS:  # what is not met again until then is forgotten
            known, older = {}, known
        coded = list(map(known.get, distinct))
        missed = [k for k, ids in enumerate(coded) if ids is None]
        known.update((distinct[k], older[distinct[k]]) for k in missed if distinct[k] in older)
        new = [distinct[k] for k in missed if distinct[k] not in known]
        stems = {w: (m[1], m[2]) for w in new if not w.isalpha() and (m := _MARKED(w)) and _letters(m[1])}
        parts = {x for x in (*(w for w in new if w not in stems), *(x for pair in stems.values() for x in pair)) if x not in known}
        learn(list(parts))
        known.update((w, known[stem] + known[marks]) for w, (stem, marks) in stems.items())
        for k in missed:
            coded[k] = known[distinct[k]]
        for w in {w for w in (*new, *parts) if len(w) > KEPT_LENGTH}:
            del known[w]
        ids, each = np.frombuffer(b"".join(coded), "<i4"), np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        for element, of in ((pieces, apart), (words, split)):
            ids, each = _put_together(ids, each, element.indices.to_numpy(), pc.list_value_length(of).to_numpy())
        data, bounds = ids.tobytes(), (4 * np.concatenate([[0], np.cumsum(each)])).tolist()
        out = [data[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for k in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            out[k] = ids_of(batch[k].as_py()).tobytes()
        return out

    return lambda batch: encode(_strings(batch))


def _encoded(vocabulary: str | None, end_id: int):
    def each(batches):
        encode, shard, start = _encoder(vocabulary or public_vocabulary()), TaskContext.get().partitionId(), 0
        end = np.asarray([end_id], "<i4").tobytes()
        for batch in slices(batches, 1, SLICE):
            data = [x + end for x in encode(batch.column(1))]
            counts = np.fromiter((len(x) // 4 for x in data), np.int64, len(data))
            ends = np.cumsum(counts)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(np.frombuffer(b"".join(data), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(counts), pa.array(np.full(len(data), shard, np.int32)), pa.array(ends - counts + start)], ["doc_id", "ids", "n_tokens", "shard", "shard_start"])
            start += int(ends[-1])

    return each


def write_tokens(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Encode every whole text (null: empty) and write it to ``path`` in
    ascending doc_id (null first; ties by a hash of the text, then in any
    order among repeated rows). Other columns are ignored. ``vocabulary``: path
    of a tokenizer file on the executors, by default the public one. An empty
    table gives files without rows."""
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("tie")]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("tie"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    (dealt.mapInArrow(_encoded(vocabulary, end_id), SCHEMA).write.option("compression", "zstd").option("orc.create.index", "true").option("orc.row.index.stride", str(ROW_GROUP)).option("orc.stripe.size", str(STRIPE))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids. A condition on doc_id reaches the ORC
    reader, which skips stripes and row groups by index and Bloom filter."""
    rows = spark.read.schema(SCHEMA).orc(path)
    sums = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    shards = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    chosen = rows if where is None else rows.where(where)
    return chosen.join(F.broadcast(shards), "shard").select("doc_id", (F.col("first") + F.col("shard_start")).alias("start"), "n_tokens", "ids")


def _digests(batches):
    for batch in batches:
        ids = batch.column(2)
        offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 from the ids that were read back."""
    return tokens.select("doc_id", "start", "ids").mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_reread(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write the documents' tokens, by default into the shared folder, and return their digests from the files."""
    path = folder or new_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary=vocabulary)
    return digests(read_tokens(docs.sparkSession, path))
