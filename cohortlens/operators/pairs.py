"""Closest and farthest pair of points in the plane (M18), at any size on Spark.

*Closest pair* by a sieve. The nearest distances of a bounded number of points,
drawn by a hash, give a bound; on a grid of that side, points with no other
point in their own and the adjoining cells can't be in a closer pair and go.
The next points are drawn from those that stay, which have close neighbours,
so the bound falls fast; once cells hold a few points each on average, points
of adjoining cells are compared by one join.

*Farthest pair* by directions, then boxes. The extreme points of many directions
are aggregates; they give a lower bound of the distance and, by the lines
through them, a polygon around all points. Points that are not as far as the
bound from any corner of it go. The rest is looked at through tight bounding
boxes: pairs of boxes whose far corners are nearer than the bound go, the
others are cut into smaller boxes, down to single points.

Points that coincide are one point with their lowest id. Ties: lowest (smaller
id, larger id). Null coordinates take no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .cells import BOX, box_of, in_sub_cells, next_cells

#: Pairs at or below this distance are not counted as pairs of different points.
MIN_PAIR_DISTANCE = 1e-8
#: Points drawn in a round of the sieve.
DRAWN = 64
#: Comparisons per point, on average, at which the sieve ends.
COMPARED = 40
#: Directions whose extreme points are sought, round by round.
DIRECTIONS = (64, 1024)
PAIR = "a long, b long, distance double"


def _spots(points: DataFrame, id_col: str, x: str, y: str) -> DataFrame:
    """(id, x, y): distinct places with their lowest id."""
    rows = points.select(F.col(id_col).cast("long").alias("id"), (F.col(x).cast("double") + 0.0).alias("x"), (F.col(y).cast("double") + 0.0).alias("y"))
    return cut_lineage(rows.where("x IS NOT NULL AND y IS NOT NULL").groupBy("x", "y").agg(F.min("id").alias("id")))


# --- closest ----------------------------------------------------------------------


def _nearest_of(drawn: np.ndarray):
    """The least distance above MIN_PAIR_DISTANCE of any point of the task from any drawn one."""

    def each(batches):
        for batch in batches:
            x, y = (batch.column(k).to_numpy() for k in range(2))
            d = np.hypot(x[:, None] - drawn[None, :, 0], y[:, None] - drawn[None, :, 1])
            d = d[d > MIN_PAIR_DISTANCE]
            if len(d):
                yield pa.RecordBatch.from_arrays([pa.array([d.min()])], ["d"])

    return each


def _adjoining() -> Column:
    """The cell of a point and the eight around it."""
    steps = [F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return F.explode(F.array(*steps))


def closest_pair(points: DataFrame, id_col: str = "record_id", x: str = "x", y: str = "y") -> DataFrame:
    """(a, b, distance) of the closest pair with distance > MIN_PAIR_DISTANCE; no row if there is none."""
    spots, spark = _spots(points, id_col, x, y), points.sparkSession
    left, bound = spots, math.inf
    while True:
        drawn = left.orderBy(F.xxhash64("x", "y"), "id").limit(DRAWN).collect()
        if not drawn:
            return spark.createDataFrame([], PAIR)
        near = spots.select("x", "y").mapInArrow(_nearest_of(np.array([[r["x"], r["y"]] for r in drawn])), "d double").agg(F.min("d")).first()[0]
        if near is None:  # no point has another one: all lie within MIN_PAIR_DISTANCE of the drawn ones
            near = 4 * MIN_PAIR_DISTANCE
        before, bound = bound, min(bound, near)
        side = bound * (1 + 1e-9)
        placed = left.withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
        cells = cut_lineage(placed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")))
        around = cells.select("n", _adjoining().alias("c")).groupBy("c.cx", "c.cy").agg(F.sum("n").alias("around"))
        cells = cut_lineage(cells.join(around, ["cx", "cy"]))
        left = cut_lineage(placed.join(cells.where("around > 1").select("cx", "cy"), ["cx", "cy"], "left_semi").select("id", "x", "y"))
        work = cells.where("around > 1").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("around")).alias("compared")).first()
        if (work["n"] or 0) == 0 or work["compared"] <= COMPARED * work["n"] or bound == before:
            return _compared(left, side)


def _compared(left: DataFrame, side: float) -> DataFrame:
    """The closest of the pairs in adjoining cells."""
    placed = left.withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
    one = placed.select(F.col("id").alias("i"), F.col("x").alias("ix"), F.col("y").alias("iy"), _adjoining().alias("c")).select("i", "ix", "iy", "c.*")
    dx, dy = F.col("ix") - F.col("x"), F.col("iy") - F.col("y")
    both = one.join(placed, ["cx", "cy"]).where(F.col("i") < F.col("id")).select(F.sqrt(dx * dx + dy * dy).alias("distance"), F.col("i").alias("a"), F.col("id").alias("b"))
    best = both.where(F.col("distance") > MIN_PAIR_DISTANCE).agg(F.min(F.struct("distance", "a", "b")).alias("p"))
    return best.where("p IS NOT NULL").select("p.a", "p.b", "p.distance")


# --- farthest ---------------------------------------------------------------------


def _directions(n: int) -> np.ndarray:
    angle = 2 * math.pi * np.arange(n) / n
    return np.stack([np.cos(angle), np.sin(angle)])


def _extremes(n: int):
    """Per direction the task's extreme point."""
    directions = _directions(n)

    def each(batches):
        best, at = np.full(n, -np.inf), np.zeros((n, 2))
        for batch in batches:
            xy = np.stack([batch.column(k).to_numpy() for k in range(2)], axis=1)
            for first in range(0, len(xy), 4096):
                part = xy[first : first + 4096]
                along = part @ directions
                k = along.argmax(0)
                value = along[k, np.arange(n)]
                better = value > best
                best[better], at[better] = value[better], part[k[better]]
        use = np.flatnonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(use.astype(np.int32)), pa.array(best[use]), pa.array(at[use, 0]), pa.array(at[use, 1])], ["k", "along", "x", "y"])

    return each


def _corners(along: np.ndarray) -> np.ndarray:
    """Corners of the polygon between the lines at ``along`` in each direction."""
    u = _directions(len(along))
    v, next_ = np.roll(u, -1, axis=1), np.roll(along, -1)
    det = u[0] * v[1] - u[1] * v[0]
    return np.stack([(along * v[1] - next_ * u[1]) / det, (next_ * u[0] - along * v[0]) / det], axis=1)


def _far_enough(corners: np.ndarray, bound: float):
    """The points that are at least the bound from some corner."""

    def each(batches):
        for batch in batches:
            x, y = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            keep = np.zeros(len(x), bool)
            for first in range(0, len(x), 4096):
                part = slice(first, first + 4096)
                keep[part] = np.hypot(x[part, None] - corners[None, :, 0], y[part, None] - corners[None, :, 1]).max(1) >= bound
            yield batch.filter(pa.array(keep))

    return each


def _kept_boxes(bound: float):
    """Pairs of sub-boxes whose far corners are at least the bound apart: how far,
    a distance that some of their points have, and whether both are single points."""

    def each(batches):
        for batch in batches:
            rows = []
            for pair, same, *boxes in zip(*(batch.column(k).to_pylist() for k in range(4))):
                a, b = (np.array([[s[c] for c in ("sub", *BOX, "n")] for s in v]) for v in boxes)
                gap = [np.maximum(np.abs(b[None, :, hi] - a[:, None, lo]), np.abs(a[:, None, hi] - b[None, :, lo])) for lo, hi in ((1, 2), (3, 4))]
                high, low = np.hypot(*gap), np.maximum(*gap)
                i, j = np.nonzero(high >= bound)
                if same:
                    i, j = i[i <= j], j[i <= j]
                rows.append((np.full(len(i), pair), a[i, 0], b[j, 0], low[i, j], high[i, j], (a[i, 5] == 1) & (b[j, 5] == 1)))
            if rows:
                kinds = (np.int64, np.int32, np.int32, float, float, bool)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(t)) for x, t in zip(zip(*rows), kinds)], ["pair", "a_sub", "b_sub", "low", "high", "single"])

    return each


def farthest_pair(points: DataFrame, id_col: str = "record_id", x: str = "x", y: str = "y") -> DataFrame:
    """(a, b, distance) of the farthest pair; points that all coincide give their
    two lowest ids, fewer than two points no row."""
    spots, spark = _spots(points, id_col, x, y), points.sparkSession
    left, bound = spots, 0.0
    for n in DIRECTIONS:
        found = left.select("x", "y").mapInArrow(_extremes(n), "k int, along double, x double, y double")
        rows = found.groupBy("k").agg(F.max(F.struct("along", "x", "y")).alias("m")).orderBy("k").select("m.*").collect()  # a row per direction
        if not rows:
            return spark.createDataFrame([], PAIR)
        at, along = np.array([[r["x"], r["y"]] for r in rows]), np.array([r["along"] for r in rows])
        bound = max(bound, float(np.hypot(at[:, None, 0] - at[None, :, 0], at[:, None, 1] - at[None, :, 1]).max()))
        if bound == 0.0:  # one place
            same = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(id_col).cast("long").alias("id")).orderBy("id").limit(2).collect()
            return spark.createDataFrame([(same[0]["id"], same[1]["id"], 0.0)] if len(same) == 2 else [], PAIR)
        slack = 1e-9 * (bound + float(np.abs(along).max()))
        left = cut_lineage(left.select("id", "x", "y").mapInArrow(_far_enough(_corners(along + slack), bound - slack), "id long, x double, y double"))
    return _by_boxes(left, bound)


def _by_boxes(left: DataFrame, bound: float) -> DataFrame:
    """The farthest pair of points, ``bound`` being the distance of some pair: by boxes, round by round smaller."""
    spark, found = left.sparkSession, None
    held, todo = left.withColumn("cell", F.lit(0).cast("long")), spark.createDataFrame([(0, 0, 0)], "pair long, a long, b long")
    while not todo.isEmpty():
        placed = in_sub_cells(held)
        small = placed.groupBy("cell", "sub").agg(*box_of(), F.count(F.lit(1)).alias("n"))
        boxes = cut_lineage(small.groupBy("cell").agg(F.collect_list(F.struct("sub", *BOX, "n")).alias("boxes")))  # SPLIT ** 2 at most
        both = todo.join(boxes.select(F.col("cell").alias("a"), F.col("boxes").alias("a_boxes")), "a").join(boxes.select(F.col("cell").alias("b"), F.col("boxes").alias("b_boxes")), "b")
        slack = 1e-12 * bound
        kept = both.select("pair", (F.col("a") == F.col("b")).alias("same"), "a_boxes", "b_boxes").mapInArrow(_kept_boxes(bound - slack), "pair long, a_sub int, b_sub int, low double, high double, single boolean")
        kept = cut_lineage(kept.join(todo, "pair"))
        bound = max(bound, kept.agg(F.max(F.when(F.col("single"), F.col("high")).otherwise(F.col("low")))).first()[0] or 0.0)
        kept = kept.where(F.col("high") >= bound - slack)
        point = placed.select("cell", "sub", "id", "x", "y")
        end = lambda e: point.select(F.col("cell").alias(e), F.col("sub").alias(f"{e}_sub"), F.col("id").alias(f"{e}_id"), F.col("x").alias(f"{e}_x"), F.col("y").alias(f"{e}_y"))
        dx, dy = F.col("a_x") - F.col("b_x"), F.col("a_y") - F.col("b_y")
        pairs = kept.where("single").join(end("a"), ["a", "a_sub"]).join(end("b"), ["b", "b_sub"]).where("a_id <> b_id")
        pairs = cut_lineage(pairs.select(F.sqrt(dx * dx + dy * dy).alias("distance"), F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).agg(F.min(F.struct((-F.col("distance")).alias("d"), "a", "b")).alias("p")))
        found = pairs if found is None else found.unionByName(pairs)
        todo, held = next_cells(kept.where(~F.col("single")), placed)  # sub-boxes of several points
    best = found.agg(F.min("p").alias("p")).where("p IS NOT NULL")
    return best.select("p.a", "p.b", (-F.col("p.d")).alias("distance"))
