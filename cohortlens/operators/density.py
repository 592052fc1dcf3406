"""DBSCAN (M12) in set form on a grid, with cells as the vertices of its graph.

Cells have side eps / sqrt(2), so any two points of one cell are neighbours and
all core points of a cell are in one cluster: a cell is one vertex, however many
points it holds. Between cells up to two apart, the bounding boxes of their
points decide first: nothing within eps, everything, or in between. In between,

* two cells with minPts points or more (all of them core) only have to be known
  to touch or not, which is decided by ever smaller boxes (``cells.py``);
* a point of a cell with fewer points visits the cell and counts what it finds
  there. Cells are cut into chunks by their measured size for that, so a cell
  that holds a third of all points is as many tasks, and what comes back is a
  number per visitor and cell.

Core points, links between cells, components and cluster ids follow: ids in
order of each component's lowest point index; a border point takes the lowest
cluster id among its core neighbours; the rest is noise (-1). This set form
gives exactly the ids and border choices of the sequential scan.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.rowindex import with_row_index
from .cells import box_kind, box_of, touching
from .common import broadcast_if_small
from .components import connected_components

#: Points of a cell that meet the visitors from sparse cells in one group.
CHUNK_ROWS = 10_000
# Half of the 5 x 5 neighbourhood (lexicographically positive offsets): every
# unordered pair of distinct cells within reach is visited once.
HALF_OFFSETS = [(dx, dy) for dx in range(-2, 3) for dy in range(-2, 3) if (dx, dy) > (0, 0)]


def _cell_pairs(stats: DataFrame, r2: float) -> DataFrame:
    a = stats.select(*[F.col(c).alias(f"a_{c}") for c in stats.columns])
    a = a.select("*", F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                                          for dx, dy in HALF_OFFSETS])).alias("o"))
    a = a.select("*", (F.col("a_cx") + F.col("o.dx")).alias("b_cx"),
                 (F.col("a_cy") + F.col("o.dy")).alias("b_cy")).drop("o")
    b = stats.select(*[F.col(c).alias(f"b_{c}") for c in stats.columns])
    j = a.join(b, ["b_cx", "b_cy"])
    return j.withColumn("kind", box_kind(r2)).filter(F.col("kind") != "none")


def dbscan(points: DataFrame, eps: float, min_pts: int, id_col: str = "record_id",
           x: str = "x", y: str = "y", index_col: str | None = None) -> DataFrame:
    """(id, label) with -1 for noise. ``index_col`` (default: the id) is the
    point order that decides cluster numbering and border ties."""
    return _grid_labels(points, max(float(eps), 0.0), max(2, int(math.floor(min_pts))), id_col, x, y,
                        index_col)


def _grid_labels(points: DataFrame, radius: float, min_n: int, id_col: str, x: str, y: str,
                 index_col: str | None) -> DataFrame:
    idx = index_col or id_col
    pts = points.select(F.col(id_col).alias("pid"), F.col(idx).alias("ix"), F.col(x).alias("x"),
                        F.col(y).alias("y"))
    if radius == 0.0:
        return _dbscan_zero(pts, min_n, id_col)
    side = radius / math.sqrt(2.0)
    r2 = radius * radius
    placed = cut_lineage(pts.select("*", F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy")))
    stats = placed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"), F.min("ix").alias("first"), *box_of())
    stats = cut_lineage(stats.withColumn("cell", F.monotonically_increasing_id()))
    cp = cut_lineage(_cell_pairs(stats, r2).select("a_cell", "a_n", "b_cell", "b_n", "kind"))
    members = cut_lineage(placed.join(broadcast_if_small(stats.select("cx", "cy", "cell", F.col("n").alias("cell_n")))[0], ["cx", "cy"]).drop("cx", "cy"))
    sparse = members.filter(F.col("cell_n") < min_n)
    full, partial = cp.filter("kind = 'all'"), cp.filter("kind = 'partial'")
    beside = _both_ways(full.select("a_cell", "b_cell", "a_n", "b_n"))
    near = _visits(sparse, members, _both_ways(partial.select("a_cell", "b_cell", "a_n", "b_n")), min_n, r2)

    # core points of sparse cells: own cell, cells entirely within reach, and what was counted
    around = beside.groupBy("cell").agg(F.sum("o_n").alias("around"))
    met = near.groupBy("pid").agg(F.sum("met").alias("met"))
    reach = F.col("cell_n") + F.coalesce("around", F.lit(0)) + F.coalesce("met", F.lit(0))
    counted = cut_lineage(sparse.join(around, "cell", "left").join(met, "pid", "left").select("pid", "ix", "cell", (reach >= min_n).alias("core")))
    core = counted.filter("core").select("pid", "cell", "ix")

    # a vertex per cell with core points: its lowest core index
    dense_roots = stats.filter(F.col("n") >= min_n).select("cell", F.col("first").alias("root"))
    roots = cut_lineage(dense_roots.unionByName(core.groupBy("cell").agg(F.min("ix").alias("root"))))
    two_dense = partial.filter((F.col("a_n") >= min_n) & (F.col("b_n") >= min_n)).select(F.col("a_cell").alias("a"), F.col("b_cell").alias("b"))
    from_core = near.join(core.select("pid"), "pid", "left_semi")
    to_core = from_core.join(core.select(F.col("pid").alias("other")), "other", "left_semi")
    links = (full.select(F.col("a_cell").alias("a"), F.col("b_cell").alias("b")).unionByName(touching(members.select("cell", "x", "y"), two_dense, r2))
             .unionByName(from_core.filter("other IS NULL").select(F.col("cell").alias("a"), F.col("o_cell").alias("b")))
             .unionByName(to_core.select(F.col("cell").alias("a"), F.col("o_cell").alias("b"))).distinct())
    root_of = lambda end: roots.select(F.col("cell").alias(end), F.col("root").alias(f"root_{end}"))
    edges = links.join(root_of("a"), "a").join(root_of("b"), "b").select(F.col("root_a").alias("src"), F.col("root_b").alias("dst"))
    comps = connected_components(edges, roots.select("root"), vid="root")
    order = with_row_index(comps.select("component").distinct(), "cid", order_by=["component"], start=0)
    cids = cut_lineage(comps.join(order, "component").join(roots, "root").select("cell", "cid"))

    # border points: lowest cluster id over core neighbours
    other_cids = cids.select(F.col("cell").alias("o_cell"), "cid")
    border = counted.filter(~F.col("core")).select("pid", "cell")
    own = border.join(cids, "cell").select("pid", "cid")
    by_full = border.join(beside.join(other_cids, "o_cell").groupBy("cell").agg(F.min("cid").alias("cid")), "cell").select("pid", "cid")
    seen_core = near.filter("other IS NULL").unionByName(near.join(core.select(F.col("pid").alias("other")), "other", "left_semi"))
    by_near = seen_core.join(border.select("pid"), "pid", "left_semi").join(other_cids, "o_cell").select("pid", "cid")
    reached = own.unionByName(by_full).unionByName(by_near).groupBy("pid").agg(F.min("cid").alias("cid"))
    in_cell = broadcast_if_small(cids)[0]
    labels = (members.filter(F.col("cell_n") >= min_n).select("pid", "cell").join(in_cell, "cell").select("pid", "cid")
              .unionByName(core.join(in_cell, "cell").select("pid", "cid"))
              .unionByName(border.join(reached, "pid", "left").select("pid", F.coalesce("cid", F.lit(-1)).alias("cid"))))
    return labels.select(F.col("pid").alias(id_col), F.col("cid").cast("int").alias("label"))


def _both_ways(pairs: DataFrame) -> DataFrame:
    """(cell, n, o_cell, o_n): each pair of cells from either side."""
    ways = [pairs.select(F.col(f"{a}_cell").alias("cell"), F.col(f"{a}_n").alias("n"), F.col(f"{b}_cell").alias("o_cell"), F.col(f"{b}_n").alias("o_n")) for a, b in ("ab", "ba")]
    return ways[0].unionByName(ways[1])


def _visits(sparse: DataFrame, members: DataFrame, pairs: DataFrame, min_n: int, r2: float) -> DataFrame:
    """(pid, cell, o_cell, other, met): how many points of a neighbouring cell lie
    within the radius of a point of a sparse cell; one by one (``other``) where
    that cell is sparse too, as a number where it is not."""
    ways = pairs.filter(F.col("n") < min_n).select("cell", "o_cell", F.ceil(F.col("o_n") / CHUNK_ROWS).cast("int").alias("chunks"))
    come = sparse.select("pid", "cell", F.col("x").alias("sx"), F.col("y").alias("sy")).join(ways, "cell").withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).drop("chunks")
    chunks = F.ceil(F.col("cell_n") / CHUNK_ROWS).cast("int")
    there = members.select(F.col("cell").alias("o_cell"), F.pmod(F.xxhash64("pid"), chunks).cast("int").alias("chunk"), "x", "y", F.when(F.col("cell_n") < min_n, F.col("pid")).alias("other"))
    dx, dy = F.col("sx") - F.col("x"), F.col("sy") - F.col("y")
    found = come.join(there, ["o_cell", "chunk"]).filter(dx * dx + dy * dy <= r2)
    return cut_lineage(found.groupBy("pid", "cell", "o_cell", "other").agg(F.count(F.lit(1)).alias("met")))


def _dbscan_zero(pts: DataFrame, min_n: int, id_col: str) -> DataFrame:
    """eps = 0: neighbours are exact duplicates; each duplicate group with at
    least min_n members is one cluster, numbered by its lowest index."""
    g = pts.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.min("ix").alias("first"))
    dense = g.filter(F.col("n") >= min_n)
    order = with_row_index(dense.select("first"), "cid", order_by=["first"], start=0)
    lab = dense.join(order, "first").select("x", "y", "cid")
    return (pts.join(lab, ["x", "y"], "left")
            .select(F.col("pid").alias(id_col), F.coalesce("cid", F.lit(-1)).cast("int").alias("label")))


def radius_components(points: DataFrame, radius: float, id_col: str = "record_id", x: str = "x",
                      y: str = "y", index_col: str | None = None) -> DataFrame:
    """(id, label): components of the graph linking points at distance <=
    radius, numbered by lowest point index (DBSCAN with minPts = 1)."""
    return _grid_labels(points, max(float(radius), 0.0), 1, id_col, x, y, index_col)


#: Relative width of the bracket in which single-link joins groups edge by edge.
BRACKET = 0.05


def single_link(points: DataFrame, k: int, id_col: str = "record_id", x: str = "x", y: str = "y",
                index_col: str | None = None) -> DataFrame:
    """Single-link hierarchical clustering into exactly k groups (all
    points if there are fewer), labels by first appearance.

    Cutting the k-1 heaviest minimum-spanning-tree edges equals linking all
    pairs closer than a threshold. Bisection narrows the threshold to a bracket
    (each probe one distributed radius-components run); the groups at its lower
    end are then joined by the edges within it, shortest first, then by the
    ends' indexes, until k are left. So ties leave exactly k groups too."""
    idx = index_col or id_col
    pts = cut_lineage(points.select(F.col(id_col).alias("pid"), F.col(idx).alias("ix"), F.col(x).alias("x"), F.col(y).alias("y")))
    b = pts.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.count(F.lit(1))).first()
    n = b[4]
    k = max(1, min(int(k), n)) if n else 1
    lab = cut_lineage(radius_components(pts, 0.0, "pid", "x", "y", "ix"))
    groups = lab.agg(F.countDistinct("label")).first()[0]
    lo, hi = 0.0, (math.hypot(b[1] - b[0], b[3] - b[2]) * (1 + 1e-9) + 1e-12 if n else 1.0)
    if groups < k:  # coincident points have to be told apart: every point starts alone
        lab = pts.select("pid", F.col("ix").alias("label"))
        groups, hi = n, 0.0
    while groups > k and hi - lo > BRACKET * hi:
        mid = (lo + hi) / 2
        if not lo < mid < hi:
            break
        probe = cut_lineage(radius_components(pts, mid, "pid", "x", "y", "ix"))
        found = probe.agg(F.countDistinct("label")).first()[0]
        if found >= k:
            lo, lab, groups = mid, probe, found
        else:
            hi = mid
    if groups > k:
        lab = _join_groups(pts.join(lab, "pid"), hi, groups - k)
    first = pts.join(lab, "pid").groupBy("label").agg(F.min("ix").alias("first"))
    order = with_row_index(first, "number", order_by=["first"], start=0)
    return lab.join(order, "label").select(F.col("pid").alias(id_col), F.col("number").cast("int").alias("label"))


def _join_groups(pts: DataFrame, radius: float, joins: int) -> DataFrame:
    """(pid, label) after ``joins`` joins of groups along their shortest edges
    of at most ``radius``, in the order (length, index, index).

    Per pair of groups only the first edge counts. The minimum spanning forest
    is found by rounds in which each group takes its first edge out; the first
    ``joins`` edges of the forest are those a sequential clustering would join by."""
    side = radius if radius > 0 else 1.0
    cells = pts.select("ix", "label", "x", "y", F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy"))
    if radius > 0:
        near = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]))
        spots = cells.groupBy("label", "x", "y", "cx", "cy").agg(F.min("ix").alias("ix"))
        a = spots.select(*[F.col(c).alias(f"a_{c}") for c in spots.columns], near.alias("o")).select("*", (F.col("a_cx") + F.col("o.dx")).alias("cx"), (F.col("a_cy") + F.col("o.dy")).alias("cy"))
        length = F.hypot(F.col("a_x") - F.col("x"), F.col("a_y") - F.col("y"))
        pairs = a.join(spots, ["cx", "cy"]).where((F.col("a_label") < F.col("label")) & (length <= radius * (1 + 1e-12))).select(F.col("a_label").alias("u"), F.col("label").alias("v"), F.struct(length.alias("d"), F.least("a_ix", "ix").alias("i"), F.greatest("a_ix", "ix").alias("j")).alias("e"))
    else:  # coincident points: each to the first of its place
        home = cells.groupBy("x", "y").agg(F.min(F.struct("ix", "label")).alias("home"))
        pairs = cells.join(home, ["x", "y"]).where("ix <> home.ix").select(F.least("label", "home.label").alias("u"), F.greatest("label", "home.label").alias("v"), F.struct(F.lit(0.0).alias("d"), F.col("home.ix").alias("i"), F.col("ix").alias("j")).alias("e"))
    edges = cut_lineage(pairs.groupBy("u", "v").agg(F.min("e").alias("e")).select("u", "v", "e", F.col("u").alias("cu"), F.col("v").alias("cv")))
    forest = None
    while not edges.isEmpty():
        ends = edges.select(F.col("cu").alias("c"), "e", "u", "v").unionByName(edges.select(F.col("cv").alias("c"), "e", "u", "v"))
        taken = cut_lineage(ends.groupBy("c").agg(F.min(F.struct("e", "u", "v")).alias("t")).select("t.e", "t.u", "t.v").distinct())
        forest = taken if forest is None else cut_lineage(forest.unionByName(taken).distinct())
        comp = connected_components(forest.select(F.col("u").alias("src"), F.col("v").alias("dst")))
        side_of = lambda df, end: df.drop(f"c{end}").join(comp.select(F.col("id").alias(end), F.col("component").alias(f"c{end}")), end)
        edges = cut_lineage(side_of(side_of(edges, "u"), "v").where("cu <> cv"))
    ranked = with_row_index(forest, "_rank", order_by=["e"])
    comp = connected_components(ranked.where(F.col("_rank") <= joins).select(F.col("u").alias("src"), F.col("v").alias("dst")))
    return pts.join(comp.withColumnRenamed("id", "label"), "label", "left").select("pid", F.coalesce("component", "label").alias("label"))
