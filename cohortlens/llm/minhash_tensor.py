"""Near duplicates by MinHash with tensored banding.

Two small collections of band keys are computed for a document, A and B, of
BANDS keys each, a key being ROWS minhashes. A hash table is a pair of one key
from either, so 2 * BANDS * ROWS minhashes serve BANDS * BANDS tables of
2 * ROWS minhashes, where as many tables apart would take BANDS / 2 times the
work. The product is formed only where a first key is shared and undecided, and
never as rows for each table.

Documents with one and the same shingle set are first made one class. Then,
among the classes that share a key of A, each is held against one other, once
or twice: that links most copies, at a pair a class. For what is still
undecided, the shingles that other labels hold too are counted: only they can
be shared by a link that is not known yet, so a class with too few of them is
done, whatever passages it has in common with however many others.

The rest meets by keys of A, a row for a class and key, and members are held
against a few pivots; what that links gets one label; pivots, once held against
all members of another label, leave, as does a member that the smallest set and
the most shared shingles of its bucket leave no link. Once pivots link little,
what is left is held against all members of a bucket that are not of its
largest label: there the tables are formed, as pairs have to share a key of B
too, and a sketch of each set tells nearly all that are no link apart before
they become rows. So every two classes that share a table are either compared
on their full sets, told apart by an exact bound (set sizes, shingles of other
labels, sketches), or already in one component.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import broadcast_if_small, null_safe_join, slices, stage
from cohortlens.llm.graph import components
from cohortlens.llm.shingles import mixed, shingle_set

#: Keys in each collection and minhashes in a key: at a similarity of 0.75 two
#: documents share none of the BANDS * BANDS tables three times in 10,000.
BANDS, ROWS = 16, 3
#: Linked: SHARED * union <= 100 * intersection.
SHARED = 75
#: Pairs with fewer of the 2 * BANDS keys in common are not compared early, but left to the tables.
AGREE = 3
#: Times that each class is held against one other before the tables are formed.
EARLY = 2
#: Pivots of a bucket by round; after these rounds a label may have FASTER times as many from round to round.
PIVOTS = (1, 1, 8, 64)
FASTER = 4
#: After a round with fewer links than one for FEW classes, all that is left is held at once.
FEW = 50
#: 64-bit words of a set's sketch.
SKETCH = 16
#: Bytes of text whose sets a worker holds at a time.
SLICE = 2 << 20
#: Sketches that are counted before they may be broadcast.
LATE_ROWS = 50_000
_WORDS = [f"w{k}" for k in range(SKETCH)]
_HASHES = 2 * BANDS * ROWS
_random = np.random.default_rng(8)
_MULTIPLY = _random.integers(0, 1 << 63, _HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _random.integers(0, 1 << 64, _HASHES, dtype=np.uint64)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """A row of _HASHES 32-bit minima for each set (which has a member at least)."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), _HASHES), np.uint64)
    for k in range(_HASHES):
        out[:, k] = np.minimum.reduceat(((flat ^ _FLIP[k]) * _MULTIPLY[k]) >> np.uint64(32), starts)
    return out


def _signed(batches):
    for batch in slices(batches, 1, SLICE):
        sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
        full = [k for k, s in enumerate(sets) if len(s)]
        keys: list[np.ndarray | None] = [None] * len(sets)
        if full:
            low = minhashes([sets[k] for k in full]).reshape(len(full), 2 * BANDS, ROWS)
            packed = low[:, :, 0]
            for k in range(1, ROWS):
                packed = mixed(packed) ^ low[:, :, k]
            packed = packed.view(np.int64)
            for k, row in zip(full, packed):
                keys[k] = row
        digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "text_key", "n_shingles", "digest", "keys"])


def _sets(batches):
    for batch in slices(batches, 1, SLICE):
        sets = [shingle_set(t).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "members"])


def sketch(members: np.ndarray) -> np.ndarray:
    """SKETCH words: of each bit, whether an odd number of members falls on it.
    Members that two sets share cancel out, so their sketches differ in no more
    bits than the sets do in members."""
    bits = 64 * SKETCH
    on = (members * _MULTIPLY[0]) >> np.uint64(64 - (bits.bit_length() - 1))
    odd = np.bincount(on.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketched(batches):
    for batch in slices(batches, 1):
        words = np.stack([sketch(np.frombuffer(m, np.uint64)) for m in batch.column(1).to_pylist()]) if batch.num_rows else np.empty((0, SKETCH), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.ascontiguousarray(words[:, k])) for k in range(SKETCH)]], ["node", *_WORDS])


def _members(batches):
    for batch in slices(batches, 2):
        sets = [np.frombuffer(m, np.int64) for m in batch.column(2).to_pylist()]
        each = [len(s) for s in sets]
        columns = [np.repeat(batch.column(k).to_numpy(), each) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, (*columns, np.concatenate(sets)))], ["node", "label", "shingle"])


def _linked(batches):
    for batch in slices(batches, 2):
        held = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            held.append(100 * both >= SHARED * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, pa.bool_())], ["a", "b", "linked"])


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key another row has too. A frequent key is counted in
    every task before it is sent, and Spark splits it where it is joined."""
    return rows.join(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), keys)


def classes_and_labels(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """The documents with class digests; the classes with their component's label."""
    text_key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    only = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), text_key.alias("text_key"))
    rows = stage(only.mapInArrow(_signed, "doc_id long, text_key long, n_shingles long, digest binary, keys array<long>"), "signed")
    one = F.min(F.struct("text_key", "doc_id")).alias("one")
    classes = stage(rows.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("low_doc"), one, F.max("n_shingles").alias("size"), F.min("keys").alias("keys")).withColumn("node", F.monotonically_increasing_id()), "classes")
    labels = _Linker(only, classes).labels()
    if labels is None:
        return rows, classes.withColumn("label", F.col("node"))
    return rows, classes.join(broadcast_if_small(labels), "node", "left").withColumn("label", F.coalesce("label", "node"))


def _may_link(size: Column, foreign: Column, other_size: Column, other_foreign: Column) -> Column:
    """Whether two sets of different labels may be linked. They share at most
    the smaller number of shingles that other labels hold too."""
    most = F.least(foreign, other_foreign)
    return 100 * most >= SHARED * (size + other_size - most)


def _may_differ(size: Column, other_size: Column, other_words: list[str]) -> Column:
    """Whether two sets may be linked by their sketches: links differ in a
    seventh of the sum of their sizes at most, as 100 * both >= SHARED * either."""
    apart = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(o))) for w, o in zip(_WORDS, other_words)), F.lit(0))
    return (100 + SHARED) * apart <= (100 - SHARED) * (size + other_size)


def _worth_holding(one: str, other: str) -> Column:
    """Whether sizes and keys (of structs) make a link likely."""
    a, b = F.col(f"{one}.size"), F.col(f"{other}.size")
    same = lambda k: F.get(f"{one}.keys", F.lit(k)) == F.get(f"{other}.keys", F.lit(k))
    agree = sum((F.when(same(k), 1).otherwise(0) for k in range(2 * BANDS)), F.lit(0))
    return (100 * F.least(a, b) >= SHARED * F.greatest(a, b)) & (agree >= AGREE)


class _Linker:
    """Finds the links among classes; ``only``: the documents with text_key."""

    def __init__(self, only: DataFrame, classes: DataFrame) -> None:
        self.only, self.classes = only, classes
        self.known: DataFrame | None = None  # node, label of those in a link
        self.tried: DataFrame | None = None  # a, b of pairs that are no link
        self.sets: DataFrame | None = None  # node, members of the undecided classes

    def labels(self) -> DataFrame | None:
        """node, label of the classes in a link (others are their own component); None if there is no link."""
        met = stage(_shared(self.classes.select("node", F.posexplode(F.slice("keys", 1, BANDS)).alias("i", "a")), ["i", "a"]), "met")
        for turn in range(EARLY):
            self._compare(self._one_each(met, turn))
        open_ = self._labelled(met).groupBy("i", "a").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("i", "a")
        undecided = stage(met.join(open_, ["i", "a"]).select("node", "i", "a"), "undecided")
        described = self._with_foreign(undecided.select("node").distinct())
        left = stage(undecided.join(described.select("node", "size", "foreign"), "node").withColumn("bucket", F.xxhash64("i", "a")).drop("i", "a"), "buckets")
        turn = 0
        while True:
            rows = self._labelled(left)
            bounds = [F.min("size").alias("least"), F.max("foreign").alias("most")]
            sums = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), *bounds).where("low < high").drop("low", "high")
            open_ = rows.join(sums, "bucket").where(_may_link(F.col("size"), F.col("foreign"), F.col("least"), F.col("most")))
            held = stage(open_.select("bucket", "node", "size", "foreign", "label"), "held")
            if held.isEmpty():
                return self.known
            last = len(PIVOTS) - 1
            pivots = stage(self._pivots(held, PIVOTS[min(turn, last)], FASTER ** max(0, turn - last)), "pivots")
            apart = (held["bucket"] == pivots["p_bucket"]) & (held["label"] != pivots["p_label"])
            plausible = held.join(pivots, apart & _may_link(held["size"], held["foreign"], pivots["p_size"], pivots["p_foreign"]))
            links = self._compare(plausible.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct())
            done = (held["bucket"] == pivots["p_bucket"]) & (held["node"] == pivots["p_node"])
            left = held.join(pivots, done, "left_anti").select("bucket", "node", "size", "foreign")
            if links * FEW < held.select("node").distinct().count():
                self._compare(self._all_left(left, described))
                return self.known
            turn += 1

    def _all_left(self, left: DataFrame, described: DataFrame) -> DataFrame:
        """a, b: the pairs of a bucket's members that share a table too, have
        different labels, and are not told apart by a bound. Of two members one
        at least is not of the bucket's largest label, so those are held
        against all."""
        rows = self._labelled(left)
        sizes = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.count(F.lit(1)).alias("labels")).where("labels > 1").drop("labels")
        open_ = stage(rows.join(largest, "bucket"), "open")
        late = stage(open_.select("node").distinct(), "late")
        sets = self.sets.join(broadcast_if_small(late), "node").select("node", "members")
        sketches = sets.mapInArrow(_sketched, "node long, " + ", ".join(f"{w} long" for w in _WORDS))
        others = described.select("node", F.slice("keys", BANDS + 1, BANDS).alias("others"))
        ends = open_.join(broadcast_if_small(stage(sketches.join(others, "node"), "sketches"), LATE_ROWS), "node")
        pivots = ends.where("label <> largest").select(*[F.col(c).alias(f"p_{c}") for c in ends.columns])
        one, other = F.col, lambda c: F.col(f"p_{c}")
        apart = (one("bucket") == other("bucket")) & (one("label") != other("label")) & ((one("label") == one("largest")) | (one("node") < other("node")))
        bound = _may_link(one("size"), one("foreign"), other("size"), other("foreign")) & _may_differ(one("size"), other("size"), [f"p_{w}" for w in _WORDS])
        table = reduce(lambda x, y: x | y, [F.get("others", F.lit(k)) == F.get("p_others", F.lit(k)) for k in range(BANDS)])
        return ends.join(pivots, apart & bound & table).select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct()

    def _with_foreign(self, nodes: DataFrame) -> DataFrame:
        """node, size, keys, foreign of those ``nodes`` that may be linked to one
        of them of another label. ``foreign``: how many of a class's shingles
        some of these nodes of another label hold too. A frequent shingle is
        combined in the tasks before it is sent; counting needs only the
        shingles that several labels hold."""
        self.sets = stage(self._sets_of(stage(nodes, "nodes")), "sets")
        spread = self._labelled(self.sets).select("node", "label", "members")
        shingles = spread.mapInArrow(_members, "node long, label long, shingle long")
        ends = shingles.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        shared = broadcast_if_small(stage(ends.where("low < high").select("shingle"), "shared"))
        foreign = shingles.join(shared, "shingle").groupBy("node").agg(F.count(F.lit(1)).alias("foreign"))
        described = self.classes.select("node", "size", "keys").join(foreign, "node")
        return stage(described.where(100 * F.col("foreign") >= SHARED * F.col("size")), "described")

    def _sets_of(self, nodes: DataFrame) -> DataFrame:
        """node, members: the shingle sets of staged ``nodes``, from the texts."""
        of = self.classes.join(broadcast_if_small(nodes), "node")
        wanted = stage(of.select("node", F.col("one.text_key").alias("k"), F.col("one.doc_id").alias("d")), "wanted")
        same = (self.only["text_key"] == wanted["k"]) & self.only["doc_id"].eqNullSafe(wanted["d"])
        texts = self.only.join(broadcast_if_small(wanted), same).select("node", "text")
        return texts.mapInArrow(_sets, "node long, members binary").dropDuplicates(["node"])

    @staticmethod
    def _pivots(held: DataFrame, ways: int, apiece: int) -> DataFrame:
        """Pivots of buckets (bucket, node, label, size, foreign, each with p_
        before its name). Labels are dealt over ``ways`` by a hash, their
        members over ``apiece``, and each part's member with the fewest shingles of its own is a pivot: of copies
        with changes the least changed one links the most. A label that fills a
        bucket spends few pivots, and the few members of other labels are soon
        all done; where two labels have many members, FASTER ends it in a
        logarithm of rounds."""
        names = ("node", "label", "size", "foreign")
        least = F.min(F.struct((1 - F.col("foreign") / F.col("size")).alias("own"), *names)).alias("p")
        dealt = [F.pmod(F.xxhash64("label"), F.lit(ways)), F.pmod(F.xxhash64(F.col("node"), F.lit(1)), F.lit(apiece))]
        parts = held.groupBy("bucket", *dealt).agg(least)
        return parts.select(F.col("bucket").alias("p_bucket"), *[F.col(f"p.{c}").alias(f"p_{c}") for c in names])

    def _labelled(self, rows: DataFrame) -> DataFrame:
        if self.known is None:
            return rows.withColumn("label", F.col("node"))
        return rows.join(broadcast_if_small(self.known), "node", "left").withColumn("label", F.coalesce("label", "node"))

    def _one_each(self, met: DataFrame, turn: int) -> DataFrame:
        """a, b: each class with the pivot it likes best of its buckets' pivots
        that have another label. A bucket's pivot is its smallest node at
        first, then the smallest by a hash."""
        rows = self._labelled(met)
        order = F.col("node") if turn == 0 else F.xxhash64("node", F.lit(turn))
        pivots = rows.groupBy("i", "a").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.struct(order.alias("o"), "node", "label")).alias("p")).where("low < high").select("i", "a", "p")
        best = rows.join(pivots, ["i", "a"]).where("label <> p.label").groupBy("node").agg(F.min("p").alias("p"))
        pairs = best.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()
        one = lambda e: self.classes.select(F.col("node").alias(e), F.struct("size", "keys").alias(f"of_{e}"))
        both = pairs.join(one("a"), "a").join(one("b"), "b")
        return both.where(_worth_holding("of_a", "of_b")).select("a", "b")

    def _compare(self, pairs: DataFrame) -> int:
        """Compare pairs on full sets, merge the labels of those that are links, and count these."""
        if self.tried is not None:
            pairs = pairs.join(broadcast_if_small(self.tried), ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        if pairs.isEmpty():
            return 0
        sets = self.sets
        if sets is None:
            nodes = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")
            sets = stage(self._sets_of(stage(nodes, "nodes")), "sets")
        end = lambda e: sets.select(F.col("node").alias(e), F.col("members").alias(f"set_{e}"))
        compared = pairs.join(end("a"), "a").join(end("b"), "b").select("a", "b", "set_a", "set_b")
        seen = stage(compared.mapInArrow(_linked, "a long, b long, linked boolean"), "compared")
        none, found = seen.where("not linked").select("a", "b"), seen.where("linked").select("a", "b")
        self.tried = none if self.tried is None else self.tried.union(none)
        number = found.count()
        if not number:
            return 0
        links = found
        if self.known is not None:  # what is linked already comes as links to its label
            links = found.union(self.known.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b")))
        self.known = components(links)
        return number


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest
    doc_id that links reach, null only where no reached row has one), kept
    (doc_id is the component's). Texts without words are linked with nothing,
    and rows of one doc_id share its fate. Other columns are ignored; an empty
    table gives an empty result."""
    rows, labelled = classes_and_labels(docs, text, doc_id)
    lowest = labelled.groupBy("label").agg(F.min("low_doc").alias("component_id"))
    of_class = labelled.select("digest", "label").join(lowest, "label").select("digest", "component_id")
    told = rows.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return told.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each group of
    near duplicates: that of the smallest doc_id (a null one last). Texts
    without words stay. Of rows equal in doc_id and text one stays."""
    rows, labelled = classes_and_labels(docs, text, doc_id)
    lowest = labelled.groupBy("label").agg(F.min("low_doc").alias("low"))
    of_class = labelled.select("digest", "label").join(lowest, "label").select("digest", "label", "low")
    members = rows.where("n_shingles > 0").select("digest", "doc_id", "text_key").join(of_class, "digest").where(F.col("doc_id").eqNullSafe(F.col("low")))
    chosen = members.groupBy("label").agg(F.min(F.struct("doc_id", "text_key")).alias("c")).select("c.doc_id", "c.text_key")
    wordless = rows.where("n_shingles = 0").select("doc_id", "text_key").distinct()
    staying = chosen.union(wordless).withColumns({"stays": F.lit(True)})
    each = rows.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    fate = stage(null_safe_join(each, staying, ["doc_id", "text_key"], "left").where("stays is null or n > 1").select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "stays"), "fate")
    same = docs[doc_id].cast("long").eqNullSafe(F.col("d")) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == F.col("t"))
    gone, repeated = fate.where("stays is null"), fate.where("stays")
    kept = docs.join(broadcast_if_small(gone), same, "left_anti")
    if repeated.isEmpty():
        return kept
    return kept.join(broadcast_if_small(repeated), same, "left_anti").union(docs.join(broadcast_if_small(repeated), same, "left_semi").dropDuplicates([doc_id, text]))
