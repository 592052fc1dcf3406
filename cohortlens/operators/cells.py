"""Which cells of points come within a radius of each other.

Cells are decided by the bounding boxes of what they hold: boxes farther apart
than the radius don't touch, boxes within the radius of each other's far corners
do. A pair of cells in between is looked at through sub-cells: every cell is cut
into SPLIT x SPLIT of them, each with its own bounding box, and a task compares
the boxes of both cells (SPLIT ** 2 of each at most). Pairs of sub-cells that
are still in between go into the next round as cells. Boxes are tight, so a box
that holds one distinct point is a point and decides; every round makes boxes
SPLIT times smaller. No points are compared with points, and a cell that holds
a third of all points is as many boxes as any other, made by partial aggregates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import broadcast_if_small

#: Sub-cells of a cell on each axis.
SPLIT = 16
BOX = ("x0", "x1", "y0", "y1")


def box_kind(r2: float) -> Column:
    """Of boxes a_* and b_*: "none" if nothing of them is within the radius, "all" if everything is, else "partial"."""
    zero = F.lit(0.0)
    gx = F.greatest(zero, F.col("b_x0") - F.col("a_x1"), F.col("a_x0") - F.col("b_x1"))
    gy = F.greatest(zero, F.col("b_y0") - F.col("a_y1"), F.col("a_y0") - F.col("b_y1"))
    sx = F.greatest(F.col("b_x1") - F.col("a_x0"), F.col("a_x1") - F.col("b_x0"))
    sy = F.greatest(F.col("b_y1") - F.col("a_y0"), F.col("a_y1") - F.col("b_y0"))
    return F.when(gx * gx + gy * gy > r2, "none").when(sx * sx + sy * sy <= r2, "all").otherwise("partial")


def box_of() -> list[Column]:
    return [F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")]


def in_sub_cells(held: DataFrame) -> DataFrame:
    """``held`` (cell, x, y, ...) with each point's sub-cell of its cell's bounding
    box. What lies at the ends of a box is never in one sub-cell, so every round divides."""
    boxes = held.groupBy("cell").agg(*box_of())

    def place(v: str) -> Column:
        side = F.col(f"{v}1") - F.col(f"{v}0")
        return F.when(side > 0, F.least(F.floor((F.col(v) - F.col(f"{v}0")) / side * SPLIT), F.lit(SPLIT - 1))).otherwise(F.lit(0)).cast("int")

    return cut_lineage(held.join(broadcast_if_small(boxes)[0], "cell").withColumn("sub", place("x") * SPLIT + place("y")).drop(*BOX))


def next_cells(open_: DataFrame, placed: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
    """The sub-cells of undecided pairs (a, a_sub, b, b_sub) as the cells of the
    next round: the pairs (pair, a, b, *keep) in new numbers, and the points of ``placed`` in them."""
    ends = open_.select(F.col("a").alias("cell"), F.col("a_sub").alias("sub")).unionByName(open_.select(F.col("b").alias("cell"), F.col("b_sub").alias("sub"))).distinct()
    numbered = cut_lineage(ends.withColumn("next", F.monotonically_increasing_id()))
    for end in ("a", "b"):
        own = numbered.select(F.col("cell").alias(end), F.col("sub").alias(f"{end}_sub"), F.col("next").alias(f"{end}_next"))
        open_ = open_.join(own, [end, f"{end}_sub"])
    pairs = open_.select(F.monotonically_increasing_id().alias("pair"), F.col("a_next").alias("a"), F.col("b_next").alias("b"), *keep)
    return cut_lineage(pairs), cut_lineage(placed.join(numbered, ["cell", "sub"]).drop("cell", "sub").withColumnRenamed("next", "cell"))


def _sub_boxes(placed: DataFrame) -> DataFrame:
    """(cell, boxes): the sub-cells with points of each cell of ``placed`` (cell, sub, x, y)."""
    small = placed.groupBy("cell", "sub").agg(*box_of())
    return small.groupBy("cell").agg(F.collect_list(F.struct("sub", *BOX)).alias("boxes"))  # SPLIT ** 2 at most


def _boxes(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten()
    whole = np.stack([flat.field(k).to_numpy(zero_copy_only=False).astype(float) for k in range(5)], axis=1)
    return np.split(whole, np.cumsum(column.value_lengths().to_numpy())[:-1])


def _decided(r2: float):
    """(pair, a_sub, b_sub): -1, -1 for a pair that touches; else the sub-cells of it that are in between."""

    def each(batches):
        for batch in batches:
            pair, a_sub, b_sub = [], [], []
            for p, a, b in zip(batch.column(0).to_pylist(), _boxes(batch.column(1)), _boxes(batch.column(2))):
                g, s = [], []
                for lo, hi in ((1, 2), (3, 4)):
                    g.append(np.maximum(0.0, np.maximum(b[None, :, lo] - a[:, None, hi], a[:, None, lo] - b[None, :, hi])))
                    s.append(np.maximum(b[None, :, hi] - a[:, None, lo], a[:, None, hi] - b[None, :, lo]))
                near, far = g[0] * g[0] + g[1] * g[1] <= r2, s[0] * s[0] + s[1] * s[1] <= r2
                if far.any():
                    i, j = np.array([-1]), np.array([-1])
                else:
                    i, j = np.nonzero(near)
                    i, j = a[i, 0].astype(int), b[j, 0].astype(int)
                pair.append(np.full(len(i), p))
                a_sub.append(i)
                b_sub.append(j)
            if pair:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(t)) for x, t in ((pair, np.int64), (a_sub, np.int32), (b_sub, np.int32))], ["pair", "a_sub", "b_sub"])

    return each


def touching(points: DataFrame, pairs: DataFrame, radius2: float) -> DataFrame:
    """Those of ``pairs`` (a, b: cell numbers) of which some point of a and some
    point of b are within the radius. ``points``: (cell, x, y)."""
    pairs = cut_lineage(pairs.select("a", "b"))
    undecided = cut_lineage(pairs.select(F.monotonically_increasing_id().alias("pair"), F.col("a"), F.col("b")))
    origin = undecided.select("pair", F.col("a").alias("a0"), F.col("b").alias("b0"))
    todo, found = undecided.select("pair", "a", "b", F.col("pair").alias("of")), None
    held = points.select("cell", "x", "y")
    while not todo.isEmpty():
        used = todo.select(F.col("a").alias("cell")).unionByName(todo.select(F.col("b").alias("cell"))).distinct()
        held = held.join(used, "cell", "left_semi")
        placed = in_sub_cells(held)
        subs = cut_lineage(_sub_boxes(placed))
        both = todo.join(subs.select(F.col("cell").alias("a"), F.col("boxes").alias("a_boxes")), "a").join(subs.select(F.col("cell").alias("b"), F.col("boxes").alias("b_boxes")), "b")
        said = cut_lineage(both.select("pair", "a_boxes", "b_boxes").mapInArrow(_decided(radius2), "pair long, a_sub int, b_sub int").join(todo, "pair"))
        now = said.where("a_sub < 0").select("of")
        found = cut_lineage((now if found is None else found.unionByName(now)).distinct())
        open_ = said.where("a_sub >= 0").join(found, "of", "left_anti")
        todo, held = next_cells(open_, placed, "of")  # sub-cells that are still in between
    if found is None:
        return pairs.limit(0)
    return origin.join(found.select(F.col("of").alias("pair")), "pair", "left_semi").select(F.col("a0").alias("a"), F.col("b0").alias("b"))
