"""Exact k nearest neighbours (M7) by a metric index kept as tables.

*Index.* Every point belongs to the cell of its nearest pivot and keeps its
distance from it; a cell is cut into rings of about equal size by that distance,
a ring that is still large (many points at one distance) into parts by a hash.
A row per ring holds its size and its least and greatest distance.

*Search.* A point first meets the part it lies in, which bounds the distance of
its k-th neighbour, then the rings that may be nearest to it, then every other
ring that may still hold something nearer. "May" is the triangle inequality: a
ring of pivot p holds nothing nearer than ``d(q, p) - greatest``, than ``least -
d(q, p)``, or than half the difference of q's distances from p and from its own
pivot. So a point travels only to rings that its k-th distance crosses into;
only points that no bound can tell apart (many dimensions of equal weight) are
compared with most others.

Parts have at most PART_ROWS points or so, and those who visit one come in
chunks of at most VISIT_ROWS, so a task's memory is bounded on both sides.

*Meetings.* Where points would have to visit more than FIRST rings each, what
travels and what each visit finds would fill the disks. Then parts are rows (a
part's points packed into one), a task keeps MEET_ROWS points or so with the
k nearest that their points have met so far, and reads the other parts one by
one from where they are staged. Nothing is shuffled but the k nearest of each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Points per cell aimed at, and the most pivots (they are sent to every task).
#: Where no bound tells rings apart, every point travels to each of them.
CELL_ROWS, PIVOTS = 2048, 1024
#: Points of a part, and of those who visit it at a time.
PART_ROWS, VISIT_ROWS = 4096, 4096
#: Rings of a cell at most; rings a point visits before its bound is drawn anew.
RINGS, FIRST = 100, 4
#: Points of a task that the other parts come to, at most or so.
MEET_ROWS = 16384
#: Numbers in one block of distances, or of differences.
BLOCK = 1 << 20
#: What distances and bounds may be off by in floating point, as a share.
SLACK = 1e-9
FOUND = "id long, neighbor long, distance double"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float) if len(column) else np.empty((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by the norm expansion, correct to about SLACK of the norms."""
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(d2, 0.0))


def near(qid: np.ndarray, q: np.ndarray, bound: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance): for each query its k nearest of the candidates (other ids,
    distance up to its bound), ties by id, as row numbers of both. The norm expansion
    chooses, with slack; distances are those of the differences."""
    out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    if not len(cid) or not len(qid):
        return out[0]
    norms, step = (c * c).sum(1), max(1, BLOCK // len(cid))
    block = np.empty((min(step, len(qid)), len(cid)))
    for at in range(0, len(qid), step):
        part, ids = q[at : at + step], qid[at : at + step]
        own = (part * part).sum(1)
        d2 = np.matmul(part, c.T, out=block[: len(part)])  # less the query's own norm, which goes to the other side
        d2 *= -2.0
        d2 += norms
        slack = SLACK * (own + norms.max()) + 1e-300
        most = np.minimum(bound[at : at + step] ** 2 * (1 + SLACK), np.inf) - own + slack
        some = d2 <= most[:, None]
        if len(cid) > k + 1 and np.count_nonzero(some) > 2 * k * len(part):  # one of them may be the query itself
            some = d2 <= np.minimum(most, np.partition(d2, k, axis=1)[:, k] + 2 * slack)[:, None]
        i, j = np.divmod(np.flatnonzero(some), len(cid))
        i, j = i[ids[i] != cid[j]], j[ids[i] != cid[j]]
        d, most = np.empty(len(i)), max(1, BLOCK // max(1, c.shape[1]))  # of many equal distances all pairs of a block are left
        for x in range(0, len(i), most):
            d[x : x + most] = np.sqrt(((part[i[x : x + most]] - c[j[x : x + most]]) ** 2).sum(1))
        order = np.lexsort((cid[j], d, i))
        i, j, d = i[order], j[order], d[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((i[keep] + at, j[keep], d[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(qid: np.ndarray, q: np.ndarray, bound: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, neighbor, distance) of ``near``."""
    i, j, d = near(qid, q, bound, cid, c, k)
    return qid[i], cid[j], d


def _last(i: np.ndarray, d: np.ndarray, n: int, k: int) -> np.ndarray:
    """The k-th distance of each of n queries (inf if it has fewer), of rows sorted by query and distance."""
    counts = np.bincount(i, minlength=n)
    out = np.full(n, np.inf)
    out[counts >= k] = d[np.cumsum(counts)[counts >= k] - 1]
    return out


def _pivots(points: DataFrame, n: int) -> np.ndarray:
    """A bounded number of distinct points, drawn by a hash of the id."""
    most = min(PIVOTS, max(1, n // CELL_ROWS))
    rows = points.orderBy(F.xxhash64("id"), "id").limit(most).collect()
    return np.unique(np.array([r["vec"] for r in rows], float), axis=0)


def _with_cell(pivots: np.ndarray):
    def each(batches):
        for batch in batches:
            d = _distances(_matrix(batch.column(1)), pivots)
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], ["id", "vec", "cell", "d"])

    return each


class Rings:
    """The index's table of rings as arrays: cell, least and greatest distance, and parts of each."""

    def __init__(self, pivots: np.ndarray, rows: list):
        self.pivots = pivots
        self.cell, self.parts = (np.array([r[c] for r in rows], np.int64) for c in ("cell", "parts"))
        self.least, self.greatest = (np.array([r[c] for r in rows], float) for c in ("least", "greatest"))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """For each query and ring a distance that nothing in the ring can be under."""
        d = _distances(q, self.pivots)
        to = d[:, self.cell]
        low = np.maximum(np.maximum(to - self.greatest, self.least - to), (to - d.min(1)[:, None]) / 2)
        return np.maximum(low - SLACK * (to + self.greatest), 0.0)


def _places(rings: Rings, start: int, stop: int, batch: pa.RecordBatch):
    """(row, ring) of a batch of (id, vec, ring, part, bound) for the rings a point has
    to visit, of those from ``start`` to ``stop`` in the order of their bounds."""
    q, own, bound = _matrix(batch.column(1)), batch.column(2).to_numpy(), batch.column(4).to_numpy()
    step = max(1, BLOCK // len(rings.cell))
    for at in range(0, len(q), step):
        low = rings.bounds(q[at : at + step])
        rank = np.argsort(np.argsort(low, axis=1, kind="stable"), axis=1)
        use = (low <= bound[at : at + step, None]) & (rank >= start) & (rank < stop)
        use[np.arange(len(low)), own[at : at + step]] &= rings.parts[own[at : at + step]] > 1
        i, ring = np.nonzero(use)
        yield i + at, ring.astype(np.int32)


def _visits(rings: Rings, start: int, stop: int):
    """(ring, id, vec, own_ring, own_part, bound): a row for each ring that a point
    visits, in batches of VISIT_ROWS at most, however many rings there are."""

    def each(batches):
        for batch in batches:
            for i, ring in _places(rings, start, stop, batch):
                for x in range(0, len(i), VISIT_ROWS):
                    rows = batch.take(pa.array(i[x : x + VISIT_ROWS]))
                    yield pa.RecordBatch.from_arrays([pa.array(ring[x : x + VISIT_ROWS]), *rows.columns], ["ring", "id", "vec", "own_ring", "own_part", "bound"])

    return each


def _visitors(rings: Rings, start: int, stop: int):
    """(ring, n): how many rows of ``_visits`` there are for a ring, a row for each task."""

    def each(batches):
        n = np.zeros(len(rings.cell), np.int64)
        for batch in batches:
            for _, ring in _places(rings, start, stop, batch):
                n += np.bincount(ring, minlength=len(n))
        ring = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array(ring.astype(np.int32)), pa.array(n[ring])], ["ring", "n"])

    return each


def _meet(k: int):
    def each(visitors: pa.Table, members: pa.Table) -> pa.Table:
        if not visitors.num_rows or not members.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "neighbor": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
        found = nearest(visitors["id"].to_numpy(), _matrix(visitors["vec"]), visitors["bound"].to_numpy(), members["id"].to_numpy(), _matrix(members["vec"]), k)
        return pa.table(dict(zip(("id", "neighbor", "distance"), found)))

    return each


def _within(k: int):
    def each(members: pa.Table) -> pa.Table:
        ids, vectors = members["id"].to_numpy(), _matrix(members["vec"])
        return pa.table(dict(zip(("id", "neighbor", "distance"), nearest(ids, vectors, np.full(len(ids), np.inf), ids, vectors, k))))

    return each


def _bounded(k: int):
    """Members of a part with the distance of the k-th nearest to each inside of it (inf if there are fewer)."""

    def each(members: pa.Table) -> pa.Table:
        ids, vectors = members["id"].to_numpy(), _matrix(members["vec"])
        i, _, d = near(ids, vectors, np.full(len(ids), np.inf), ids, vectors, k)
        return members.append_column("bound", pa.array(_last(i, d, len(ids), k)))

    return each


PACKED = "number int, ring int, ids binary, vecs binary, bounds binary, needs array<int>"


def _packed(rings: Rings, starts: np.ndarray):
    """A part as one row: its number, its points as bytes, and the rings that one of them has to visit."""

    def each(members: pa.Table) -> pa.Table:
        ring, need = members["ring"][0].as_py(), np.zeros(len(rings.cell), bool)
        need[ring] = True
        for _, r in _places(rings, 0, len(need), members):
            need[r] = True
        vecs = members["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        number = int(starts[ring]) + members["part"][0].as_py()
        return pa.table({"number": pa.array([number], pa.int32()), "ring": pa.array([ring], pa.int32()), "ids": [members["id"].to_numpy().tobytes()], "vecs": [vecs.tobytes()],
                         "bounds": [members["bound"].to_numpy().tobytes()], "needs": pa.array([np.flatnonzero(need)], pa.list_(pa.int32()))})

    return each


def _unpacked(row: dict, kind: type) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["vecs"], kind).reshape(len(ids), -1).astype(float)


class Meeting:
    """The points of a part and the k nearest to each of those that they have met."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, bound: np.ndarray, rings: Rings, k: int):
        self.ids, self.q, self.bound, self.rings, self.k = ids, q, bound, rings, k
        self.own, self.found, self.waiting = _distances(q, rings.pivots).min(1), [], 0

    def meet(self, ring: int, cid: np.ndarray, c: np.ndarray) -> None:
        """Points of the ring; only who may have one of its k nearest there looks at them."""
        least, greatest = self.rings.least[ring], self.rings.greatest[ring]
        to = _distances(self.q, self.rings.pivots[self.rings.cell[ring]][None])[:, 0]
        low = np.maximum(np.maximum(to - greatest, least - to), (to - self.own) / 2) - SLACK * (to + greatest)
        come = np.flatnonzero(low <= self.bound)
        i, j, d = near(self.ids[come], self.q[come], self.bound[come], cid, c, self.k)
        self.found.append((come[i], cid[j], d))
        self.waiting += len(i)
        if self.waiting > len(self.ids) * self.k:
            self.kept()

    def kept(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, neighbor, d = (np.concatenate(x) for x in zip((np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)), *self.found))
        order = np.lexsort((neighbor, d, i))
        i, neighbor, d = i[order], neighbor[order], d[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < self.k
        i, neighbor, d = i[keep], neighbor[keep], d[keep]
        self.found, self.waiting = [(i, neighbor, d)], 0
        self.bound = np.minimum(self.bound, _last(i, d, len(self.ids), self.k))
        return i, neighbor, d


def _meetings(rings: Rings, k: int, kind: type):
    """What the points of a task's parts find, of rows of a part that comes and the number of a
    part that it meets; first come rows without a part that have the points of those."""

    def each(batches):
        here: dict[int, Meeting] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["ring"] < 0:
                    ids, q = _unpacked({"ids": row["own_ids"], "vecs": row["own_vecs"]}, kind)
                    here[row["number"]] = Meeting(ids, q, np.frombuffer(row["bounds"], float), rings, k)
                else:
                    here[row["number"]].meet(row["ring"], *_unpacked(row, kind))
        while here:
            part = here.popitem()[1]
            i, neighbor, d = part.kept()
            for x in range(0, len(i), BLOCK // 8):
                yield pa.RecordBatch.from_arrays([pa.array(part.ids[i[x : x + BLOCK // 8]]), pa.array(neighbor[x : x + BLOCK // 8]), pa.array(d[x : x + BLOCK // 8])], ["id", "neighbor", "distance"])

    return each


def _met(members: DataFrame, n: int, rings: Rings, k: int, kind: str) -> DataFrame:
    """What all points find when parts come to parts: each task reads every part that one of its own needs."""
    spark = members.sparkSession
    starts = np.cumsum(rings.parts) - rings.parts
    tasks = max(-(-n // MEET_ROWS), min(int(rings.parts.sum()), 3 * spark.sparkContext.defaultParallelism))
    packed = cut_lineage(members.groupBy("ring", "part").applyInArrow(_packed(rings, starts), PACKED))
    own = packed.select("number", F.col("ids").alias("own_ids"), F.col("vecs").alias("own_vecs"), "bounds", "needs").repartitionById(tasks, F.col("number") % tasks)
    first = spark.createDataFrame([(-1, b"", b"")], "ring int, ids binary, vecs binary").coalesce(1)
    come = first.unionByName(packed.select("ring", "ids", "vecs")).coalesce(1)  # each task reads its partitions in this order
    new = F.col("ring") < 0
    rows = come.hint("shuffle_replicate_nl").join(own, new | F.array_contains("needs", F.col("ring")))
    rows = rows.select("number", "ring", "ids", "vecs", *[F.when(new, F.col(c)).alias(c) for c in ("own_ids", "own_vecs", "bounds")])
    return rows.mapInArrow(_meetings(rings, k, np.float32 if kind == "array<float>" else np.float64), FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy("distance", "neighbor")  # k rows of each place visited, at most
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def knn_graph(points: DataFrame, k: int, id_col: str = "id", vec: str = "vec", part_rows: int = PART_ROWS) -> DataFrame:
    """(id, neighbor, distance, rank): exact k nearest neighbours (Euclidean,
    self excluded, ties by neighbour id), k at most the number of other points."""
    kind = "array<float>" if points.select(vec).dtypes[0][1] == "array<float>" else "array<double>"  # floats travel as they are
    rows = cut_lineage(points.select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast(kind).alias("vec")))
    spark, n = rows.sparkSession, rows.count()
    if n < 2:
        return spark.createDataFrame([], FOUND + ", rank int")
    k = max(1, min(int(k), n - 1))
    pivots = _pivots(rows, n)
    celled = cut_lineage(rows.mapInArrow(_with_cell(pivots), f"id long, vec {kind}, cell int, d double"))

    # rings: cuts at hundredths of a cell's distances, as many as its size asks for
    shares = [i / RINGS for i in range(1, RINGS)]
    cells = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("d", shares, 10_000).alias("cuts"))  # a row per pivot
    wanted = F.least(F.ceil(F.col("n") / part_rows), F.lit(RINGS)).cast("int")
    cuts = cells.select("cell", F.expr(f"transform(sequence(1, {RINGS - 1}), i -> i)").alias("all"), "cuts", wanted.alias("rings"))
    chosen = cuts.select("cell", F.expr(f"array_distinct(transform(filter(all, i -> floor(i * rings / {RINGS}) > floor((i - 1) * rings / {RINGS})), i -> cuts[i - 1]))").alias("cuts"))
    ringed = celled.join(F.broadcast(chosen), "cell").withColumn("ring", F.size(F.filter("cuts", lambda c: c < F.col("d")))).drop("cuts")
    parts = F.ceil(F.count(F.lit(1)) / part_rows).cast("int")
    table = ringed.groupBy("cell", "ring").agg(F.min("d").alias("least"), F.max("d").alias("greatest"), parts.alias("parts")).orderBy("cell", "ring").collect()  # RINGS x PIVOTS at most
    rings = Rings(pivots, table)
    numbers = spark.createDataFrame([(r["cell"], r["ring"], i, r["parts"]) for i, r in enumerate(table)], "cell int, ring int, number int, parts int")
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int")
    placed = ringed.join(F.broadcast(numbers), ["cell", "ring"]).select("id", "vec", F.col("number").alias("ring"), part.alias("part"))
    members = cut_lineage(placed.groupBy("ring", "part").applyInArrow(_bounded(k), f"id long, vec {kind}, ring int, part int, bound double"))
    visits = members.mapInArrow(_visitors(rings, 0, len(table)), "ring int, n long").agg(F.sum("n")).first()[0] or 0  # one number
    if visits > FIRST * n:
        return _best(_met(members, n, rings, k, kind), k)
    members = members.drop("bound")
    found = members.groupBy("ring", "part").applyInArrow(_within(k), FOUND)
    steps = [(0, FIRST), (FIRST, len(table))] if len(table) > 2 * FIRST else [(0, len(table))]
    for start, stop in steps:
        found = cut_lineage(_best(found, k).drop("rank"))
        full = F.when(F.count(F.lit(1)) == k, F.max("distance")).otherwise(float("inf"))
        bounded = cut_lineage(members.join(found.groupBy("id").agg(full.alias("bound")), "id", "left").select("id", "vec", "ring", "part", F.coalesce("bound", F.lit(math.inf)).alias("bound")))
        come = bounded.mapInArrow(_visitors(rings, start, stop), "ring int, n long").groupBy("ring").agg(F.sum("n").alias("n"))
        visits = bounded.mapInArrow(_visits(rings, start, stop), f"ring int, id long, vec {kind}, own_ring int, own_part int, bound double")
        found = found.unionByName(_searched(visits, come, members, numbers, k))
    return _best(found, k)


def _searched(visits: DataFrame, come: DataFrame, members: DataFrame, numbers: DataFrame, k: int) -> DataFrame:
    """What visitors find in all parts of the rings they visit, but for their own part.
    Visitors of a ring come in chunks by its number of them (``come``), each of which meets every part."""
    chunks = cut_lineage(come.select("ring", F.ceil(F.col("n") / VISIT_ROWS).cast("int").alias("chunks")))  # a row per ring
    parts = F.broadcast(numbers.select(F.col("number").alias("ring"), "parts"))
    come = visits.join(F.broadcast(chunks), "ring").join(parts, "ring").select("*", F.pmod(F.xxhash64("id", F.lit(2)), F.col("chunks")).cast("int").alias("chunk"), F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    come = come.where((F.col("ring") != F.col("own_ring")) | (F.col("part") != F.col("own_part"))).select("ring", "part", "chunk", "id", "vec", "bound")
    there = members.join(F.broadcast(chunks), "ring").select("ring", "part", F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"), "id", "vec")
    keys = ["ring", "part", "chunk"]
    return come.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(_meet(k), FOUND)
