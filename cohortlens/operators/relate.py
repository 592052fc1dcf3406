"""Relations between variables.

Pearson r is pairwise-complete and guarded: NULL when fewer than 2 complete
pairs or either variance over those pairs is 0 (never a divide-by-zero
error under ANSI). All pairs of a matrix are computed in one aggregation pass
(chunked), with Spark's stable central-moment aggregates.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse as P
from .filters import numeric

HEATMAP_THRESHOLD = 0.7   # P15: abs(r) > 0.7 flagged on the heatmap
VECTOR_THRESHOLD = 0.8    # P15: abs(r) >= 0.8 flagged by the vector check
PAIRS_PER_PASS = 40       # pairs per aggregation pass (4 aggregates each)
GRAM_MIN_COLUMNS = 16     # from this many columns on, use the masked Gram form (two passes)
ZERO_VARIANCE = 1e-12     # relative tolerance for "variance over complete pairs is 0"


def _pair_aggs(x: Column, y: Column, tag: str) -> list[Column]:
    both = x.isNotNull() & y.isNotNull()
    xp, yp = F.when(both, x), F.when(both, y)
    return [F.count_if(both).alias(f"{tag}__n"), F.covar_pop(xp, yp).alias(f"{tag}__cov"),
            F.stddev_pop(xp).alias(f"{tag}__sx"), F.stddev_pop(yp).alias(f"{tag}__sy")]


def _r(n: Column, cov: Column, sx: Column, sy: Column) -> Column:
    return F.when((n >= 2) & (sx > 0) & (sy > 0), cov / (sx * sy))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (x, y, n, r)."""
    row = df.agg(*_pair_aggs(numeric(df, x), numeric(df, y), "p"))
    return row.select(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col("p__n").alias("n"),
                      _r(F.col("p__n"), F.col("p__cov"), F.col("p__sx"), F.col("p__sy")).alias("r"))


def _gram_upper(nums: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete (x, y, n, r) for all unordered pairs in two passes.

    Pass 1: column means. Pass 2: every task centres its rows, sets missing
    cells to 0 and forms, with a mask M of present cells, N = M'M, A = M'X,
    B = M'X^2 and C = X'X (numpy); the partial matrices are summed per pair
    by Spark. Over the rows where both i and j are present: n = N_ij,
    mean_i = A_ji / n, var_i = B_ji / n - mean_i^2, cov = C_ij / n -
    mean_i mean_j."""
    import numpy as np
    import pandas as pd

    means = nums.agg(*[F.avg(c).alias(c) for c in cols]).first()
    centre = np.array([means[c] if means[c] is not None else 0.0 for c in cols], dtype=float)
    p = len(cols)
    iu, ju = np.triu_indices(p, 1)

    def partial(batches):
        tot = None
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            m = ~np.isnan(x)
            xc = np.where(m, x - centre, 0.0)
            mf = m.astype(float)
            part = (mf.T @ mf, mf.T @ xc, mf.T @ (xc * xc), xc.T @ xc)
            tot = part if tot is None else tuple(a + b for a, b in zip(tot, part))
        if tot is None:
            return
        n, a, b, c = tot
        yield pd.DataFrame({"i": iu, "j": ju, "n": n[iu, ju], "a_i": a[ju, iu], "a_j": a[iu, ju],
                            "b_i": b[ju, iu], "b_j": b[iu, ju], "c": c[iu, ju]})

    schema = "i int, j int, n double, a_i double, a_j double, b_i double, b_j double, c double"
    sums = nums.mapInPandas(partial, schema).groupBy("i", "j").agg(
        *[F.sum(k).alias(k) for k in ["n", "a_i", "a_j", "b_i", "b_j", "c"]])
    n = F.col("n")
    mi, mj = F.col("a_i") / n, F.col("a_j") / n
    vi, vj = F.col("b_i") / n - mi * mi, F.col("b_j") / n - mj * mj
    cov = F.col("c") / n - mi * mj
    ok = (n >= 2) & (vi > ZERO_VARIANCE * F.col("b_i") / n) & (vj > ZERO_VARIANCE * F.col("b_j") / n)
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.element_at(names, F.col("i") + 1).alias("x"), F.element_at(names, F.col("j") + 1).alias("y"),
                       n.cast("long").alias("n"), F.when(ok, cov / F.sqrt(vi * vj)).alias("r"))


def correlation_matrix(df: DataFrame, cols: list[str], diagonal: bool = True,
                       method: str = "auto") -> DataFrame:
    """Long form (x, y, n, r) for every ordered pair (both triangles,
    computed once per unordered pair), diagonal r = 1. ``method``:
    'aggregate' (Spark's central-moment aggregates, chunked passes),
    'gram' (two passes whatever the width) or 'auto'."""
    nums = df.select(*[numeric(df, c).alias(c) for c in cols])
    if method == "gram" or (method == "auto" and len(cols) >= GRAM_MIN_COLUMNS):
        upper = _gram_upper(nums, cols)
        lower = upper.select(F.col("y").alias("x"), F.col("x").alias("y"), "n", "r")
        out = upper.unionByName(lower)
        if diagonal:
            diag = nums.agg(*[F.count(c).alias(c) for c in cols]).select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"), F.col(c).alias("n"),
                         F.lit(1.0).alias("r")) for c in cols])).alias("s")).select("s.*")
            out = out.unionByName(diag)
        return out
    pairs = list(combinations(range(len(cols)), 2))
    parts = []
    for start in range(0, len(pairs), PAIRS_PER_PASS):
        chunk = pairs[start:start + PAIRS_PER_PASS]
        aggs = []
        for i, j in chunk:
            aggs += _pair_aggs(F.col(cols[i]), F.col(cols[j]), f"c{i}_{j}")
        row = nums.agg(*aggs)
        structs = [F.struct(F.lit(cols[i]).alias("x"), F.lit(cols[j]).alias("y"),
                            F.col(f"c{i}_{j}__n").alias("n"),
                            _r(F.col(f"c{i}_{j}__n"), F.col(f"c{i}_{j}__cov"),
                               F.col(f"c{i}_{j}__sx"), F.col(f"c{i}_{j}__sy")).alias("r"))
                   for i, j in chunk]
        parts.append(row.select(F.explode(F.array(*structs)).alias("s")).select("s.*"))
    if not parts:
        upper = df.sparkSession.createDataFrame([], "x string, y string, n long, r double")
    else:
        upper = parts[0]
        for p in parts[1:]:
            upper = upper.unionByName(p)
    lower = upper.select(F.col("y").alias("x"), F.col("x").alias("y"), "n", "r")
    out = upper.unionByName(lower)
    if diagonal:
        diag = nums.agg(*[F.count(c).alias(c) for c in cols]).select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"), F.col(c).alias("n"),
                     F.lit(1.0).alias("r")) for c in cols])).alias("s")).select("s.*")
        out = out.unionByName(diag)
    return out


def high_pairs(matrix: DataFrame, threshold: float = HEATMAP_THRESHOLD, strict: bool = True) -> DataFrame:
    """Unordered off-diagonal pairs with abs(r) > (or >=) threshold."""
    a = F.abs(F.col("r"))
    cond = (a > threshold) if strict else (a >= threshold)
    return matrix.filter((F.col("x") < F.col("y")) & cond)


def trend_line(df: DataFrame, x: str, y: str, log: bool = False) -> DataFrame:
    """OLS y = a + b x on finite pairs (optionally log1p(max(0, .)) on
    both axes), endpoints at min/max x; no line (NULL) if var(x) = 0."""
    xv, yv = numeric(df, x), numeric(df, y)
    if log:
        xv, yv = P.log1p_pos(xv), P.log1p_pos(yv)
    pts = df.select(xv.alias("x"), yv.alias("y")).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    agg = pts.agg(F.count(F.lit(1)).alias("n"), F.var_pop("x").alias("vx"),
                  F.covar_pop("x", "y").alias("cxy"), F.avg("x").alias("mx"), F.avg("y").alias("my"),
                  F.min("x").alias("x0"), F.max("x").alias("x1"))
    slope = F.when(F.col("vx") > 0, F.col("cxy") / F.col("vx"))
    inter = F.col("my") - slope * F.col("mx")
    return agg.select("n", slope.alias("slope"), inter.alias("intercept"), "x0", "x1",
                      (inter + slope * F.col("x0")).alias("y0"),
                      (inter + slope * F.col("x1")).alias("y1"))


def bivariate_points(df: DataFrame, x: str, y: str, id_col: str = "record_id",
                     color: str | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Finite (x, y) pairs with an optional colour (missing -> 0) or a
    cluster label joined by id."""
    cols = [F.col(id_col), numeric(df, x).alias("x"), numeric(df, y).alias("y")]
    if color:
        cols.append(F.coalesce(numeric(df, color), F.lit(0.0)).alias("color"))
    pts = df.select(*cols).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    if labels is not None:
        pts = pts.join(labels, id_col, "left")
    return pts
