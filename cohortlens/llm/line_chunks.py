"""Repeated passages by content-defined chunks of lines. DataFrame functions only.

Where two lines follow each other in one place of the corpus only, no passage
that repeats can run across: there, every cutting has a boundary. So a passage
between foreign lines is cut out at its own edges, however short it is. What
lies between two such boundaries is cut in several ways: not at all; by
rolling hashes over pairs of line hashes, alike wherever the lines occur, so
that a passage is found whose neighbours happen to be repeated with it; and
into single lines, of which the long ones count. Chunks of several lines (or
as long as several) that occur again anywhere, byte for byte, are removed
except where they first occur; the SHA-256 of their bytes tells.

Pairs of lines, and then codes of chunks, are counted first, as a few numbers
each; of chunks whose code repeats the bytes are read again and their digests
moved and compared, so that no chunk is ever moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import WORD, broadcast_if_small, stage

#: Cuttings: 0 is by boundaries of the corpus alone, 1 to ROLLING also where a rolling hash of a pair of lines
#: says so, once in EVERY times; SINGLE has each line for itself.
ROLLING, EVERY = 3, 2
SINGLE = ROLLING + 1
#: A chunk is removable if it has LINES lines and WORDS words at least, or LONG words in one line.
LINES, WORDS, LONG = 2, 10, 50
#: Bits of the marks by which rows that a join would drop are left out before they are moved (8 MB at most; 32,768 to a row).
MARKS = 1 << 26
_MODULUS = 4294967296


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    plain = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(plain).alias("text_key"), plain.alias("plain"))


def _lines(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return _keyed(docs, text, doc_id).select("doc_id", "text_key", F.split("plain", "\n", -1).alias("lines"))


def _marked(rows: DataFrame, keys: list[str], wanted: DataFrame, of: list[str]) -> DataFrame:
    """The ``rows`` whose keys are among those ``of`` staged ``wanted``, and a
    few others. Marks, a bit for the hash of each wanted key, go to all tasks, so
    that most rows that a join would drop are not moved for it. With so many
    keys that all bits are set, all rows stay; the join after it is exact."""
    mark = lambda names: F.pmod(F.xxhash64(*names), F.lit(MARKS))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("__m")).alias("__bits")
    marks = wanted.select(mark(of).alias("__m")).groupBy(F.bitmap_bucket_number("__m").alias("__bucket")).agg(bits)
    at = F.bitmap_bit_position("__m")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.get(F.array(*[byte.bitwiseAND(1 << k) != 0 for k in range(8)]), (at % 8).cast("int"))
    near = rows.withColumn("__m", mark(keys)).join(F.broadcast(marks), F.bitmap_bucket_number("__m") == F.col("__bucket"))
    return near.where(held).select(*rows.columns)


def _wanted_lines(docs: DataFrame, text: str, doc_id: str, wanted: DataFrame) -> DataFrame:
    """doc_id, text_key, lines and the columns of staged ``wanted`` (d, t, ...)
    for the documents that it names; most other texts stay where they are."""
    near = _marked(_keyed(docs, text, doc_id), ["doc_id", "text_key"], wanted, ["d", "t"])
    found = near.join(wanted, near["doc_id"].eqNullSafe(wanted["d"]) & (near["text_key"] == wanted["t"]))
    return found.select("*", F.split("plain", "\n", -1).alias("lines")).drop("plain", "d", "t")


def _followers(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, text_key, i, alone, a, b: hashes of each line i and the one
    before it, and (``alone``) of each long line i by itself."""
    long_ = lambda x: F.when(F.length(x) >= 2 * LONG - 1, F.regexp_count(x, F.lit(WORD)) >= LONG).otherwise(False)
    lines = _lines(docs, text, doc_id).select("doc_id", "text_key", F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("x"), long_(x).alias("long"))).alias("of"))
    pairs = F.transform(F.slice("of", 2, F.size("of")), lambda y, k: F.struct((k + 1).alias("i"), F.lit(False).alias("alone"), F.get("of", k)["x"].alias("a"), y["x"].alias("b")))
    alone = F.transform("of", lambda y, k: F.struct(k.alias("i"), y["long"].alias("alone"), y["x"].alias("a"), y["x"].alias("b")))
    return lines.select("doc_id", "text_key", F.explode(F.concat(pairs, F.filter(alone, lambda y: y["alone"]))).alias("f")).select("doc_id", "text_key", "f.*")


def _joined(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """d, t (doc_id and text_key of documents with lines that may repeat),
    joined (lines that follow the line before them elsewhere too), alone (long
    lines that occur elsewhere). A frequent pair is combined in the tasks
    before it is sent, and Spark splits it where it is joined."""
    rows, keys = _followers(docs, text, doc_id), ["alone", "a", "b"]
    place = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text_key", "i")
    often = rows.groupBy(*keys).agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low < high").select(*keys)
    found = rows.join(broadcast_if_small(stage(often, "repeated-pairs")), keys)
    at = lambda alone: F.collect_set(F.when(F.col("alone") == alone, F.col("i")))
    return stage(found.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(at(False).alias("joined"), at(True).alias("alone")), "joined")


def _chunks(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, text_key, seed (the cutting), first (line, from 0), n, code: the
    chunks that are removable if they repeat. A code is two hashes of the
    chunk's lines."""
    of_docs = _wanted_lines(docs, text, doc_id, _joined(docs, text, doc_id))
    hashes = [F.transform("lines", line_hash).alias("hashes"), F.transform("lines", lambda x: F.xxhash64(x)).alias("others")]
    lines = of_docs.select("doc_id", "text_key", "joined", "alone", *hashes, F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))).alias("words"))

    def rolls(seed: Column, i: Column) -> Column:
        mixed = (F.get("hashes", i - 1) * (F.lit(7919) + seed * 104) + F.get("hashes", i) * 31 + seed * 2654435761) % _MODULUS
        return (seed > 0) & (F.pmod(F.shiftright(mixed, 9), F.lit(EVERY)) == 0)

    def cut(seed: Column) -> Column:
        return F.array_except(F.sequence(F.lit(0), F.size("hashes") - 1), F.filter("joined", lambda i: ~rolls(seed, i)))

    def chunk(seed: Column, first: Column, n: Column) -> Column:
        part = lambda column: F.slice(column, first + 1, n)
        words = F.aggregate(part("words"), F.lit(0), lambda x, y: x + y)
        code = F.struct(F.xxhash64(part("others")).alias("x"), F.xxhash64(part("hashes")).alias("y"))
        return F.struct(seed.alias("seed"), first.alias("first"), n.alias("n"), words.alias("n_words"), code.alias("code"))

    def of_starts(seed: Column, starts: Column) -> Column:
        return F.transform(starts, lambda first, k: chunk(seed, first, F.coalesce(F.get(starts, k + 1), F.size("hashes")) - first))

    # an array of one array of starts, so that it is made once and not for each chunk
    spans = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(ROLLING)), lambda seed: F.flatten(F.transform(F.array(cut(seed)), lambda starts: of_starts(seed, starts)))))
    single = F.transform("alone", lambda first: chunk(F.lit(SINGLE), first, F.lit(1)))
    chunks = lines.select("doc_id", "text_key", F.explode(F.concat(spans, single)).alias("s")).select("doc_id", "text_key", "s.*")
    return chunks.where(((F.col("n") >= LINES) & (F.col("n_words") >= WORDS)) | (F.col("n_words") >= LONG)).drop("n_words")


def repeated_chunks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text_key, seed, first, n, first_doc_id, keeps: each occurrence of
    a chunk that occurs more than once (``keeps``: the first, by doc_id, null
    first, then text_key and line). Occurrences in one document count too.
    Rows of one doc_id and text are the same document and have one fate. Should
    two chunks of one code differ in bytes (in their SHA-256), both stay."""
    rows, keys = stage(_chunks(docs, text, doc_id), "chunks"), ["seed", "n", "code"]
    often = stage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times"), "often")
    found = stage(_marked(rows, keys, often, keys).join(often, keys).select("doc_id", "text_key", "first", *keys), "repeated-codes")
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_key", "first")
    wanted = stage(found.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(F.collect_set(F.struct("first", *keys)).alias("chunks")), "repeated-in")
    of_docs = _wanted_lines(docs, text, doc_id, wanted)
    bytes_ = F.array_join(F.slice("lines", F.col("c.first") + 1, F.col("c.n")), "\n")
    chunk = F.unhex(F.sha2(bytes_, 256)).alias("chunk")
    digests = of_docs.select("doc_id", "text_key", "lines", F.explode("chunks").alias("c")).select("doc_id", "text_key", "c.*", chunk)
    same = digests.groupBy(*keys).agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"), F.min(place).alias("earliest"), F.max(place).alias("latest")).where("low = high and earliest <> latest")
    return found.join(same.select(*keys, "earliest"), keys).select("doc_id", "text_key", "seed", "first", "n", F.col("earliest.doc_id").alias("first_doc_id"), (place == F.col("earliest")).alias("keeps"))


def removals(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document (doc_id and text) that holds repeated chunks:
    doc_id, text_key, removed (line numbers, ascending, from 0), first_doc_ids
    (where what was removed stays), and kept_lines (of repeated chunks that
    stay here). A line stays if, in a cutting, it belongs to a first occurrence
    and no cutting finds an earlier one."""
    found = repeated_chunks(docs, text, doc_id)
    lines = F.sequence("first", F.col("first") + F.col("n") - 1)
    held = lambda keeps: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("keeps") == keeps, lines)))))
    return found.groupBy("doc_id", "text_key").agg(held(False).alias("removed"), held(True).alias("kept_lines"), F.array_sort(F.collect_set(F.when(~F.col("keeps"), F.col("first_doc_id")))).alias("first_doc_ids"))


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with its columns, the text without removed lines.
    A text of which nothing was removed is left as it is, null included."""
    gone = removals(docs, text, doc_id).where(F.size("removed") > 0).select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t"), F.col("removed").alias("__removed"))
    joined = docs.join(gone, F.col(doc_id).eqNullSafe(F.col("__d")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("__t")), "left")
    split = joined.withColumn("__lines", F.when(F.col("__removed").isNotNull(), F.split(F.col(text), "\n", -1)))
    # what lies between one removed line and the next
    before, after = F.concat(F.array(F.lit(-1)), "__removed"), F.concat("__removed", F.array(F.size("__lines")))
    kept = F.array_join(F.flatten(F.zip_with(before, after, lambda x, y: F.slice("__lines", x + 2, y - x - 1))), "\n")
    return split.withColumn(text, F.when(F.col("__removed").isNull(), F.col(text)).otherwise(kept)).select(*docs.columns)


def report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document that holds a repeated chunk: doc_id, removed_lines,
    removed (their numbers, comma-joined), shared_lines (repeated, but first
    here), first_doc_ids (comma-joined)."""
    r = removals(docs, text, doc_id)
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return r.select("doc_id", F.size("removed").cast("long").alias("removed_lines"), join("removed").alias("removed"), F.size(F.array_except("kept_lines", "removed")).cast("long").alias("shared_lines"), join("first_doc_ids").alias("first_doc_ids"))
