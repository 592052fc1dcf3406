"""Neighbour operators: closest / farthest pair (M18, ``pairs.py``), exact
k-nearest-neighbour graph (M7, ``metric.py``) and perplexity-calibrated
affinities (M8) over it."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metric import knn_graph  # noqa: F401
from .pairs import closest_pair, farthest_pair  # noqa: F401

#: Points calibrated at a time.
AFFINITY_ROWS = 1024

# --- perplexity-calibrated affinities ------------------------------------------------

def _calibrate(d2: np.ndarray, valid: np.ndarray, target: float, steps: int = 50, tol: float = 1e-5):
    """Vectorised bisection on beta (one row per point) so that the entropy
    of exp(-beta d2) over the valid neighbours equals ``target``."""
    rows = d2.shape[0]
    beta = np.ones(rows)
    lo = np.full(rows, -np.inf)
    hi = np.full(rows, np.inf)
    done = np.zeros(rows, dtype=bool)
    for _ in range(steps):
        p = np.where(valid, np.exp(-d2 * beta[:, None]), 0.0)
        s = p.sum(1)
        s = np.where(s > 0, s, 1e-10)
        h = np.log(s) + beta * (p * d2).sum(1) / s
        diff = h - target
        done |= np.abs(diff) < tol
        up = (diff > 0) & ~done
        down = (diff <= 0) & ~done
        lo = np.where(up, beta, lo)
        hi = np.where(down, beta, hi)
        beta = np.where(up, np.where(np.isinf(hi), beta * 2, (beta + hi) / 2), beta)
        beta = np.where(down, np.where(np.isinf(lo), beta / 2, (beta + lo) / 2), beta)
        if done.all():
            break
    p = np.where(valid, np.exp(-d2 * beta[:, None]), 0.0)
    s = p.sum(1)
    return p / np.where(s > 0, s, 1e-10)[:, None]


def neighbor_affinity(knn: DataFrame, n: int, perplexity: float | None = None) -> DataFrame:
    """(i, j, p): symmetric affinities (p_j|i + p_i|j) / 2n over the kNN graph
    (deviation: truncated to the k nearest neighbours instead of all n)."""
    perp = perplexity or min(30.0, max(2.0, math.floor((n - 1) / 3)))
    target = math.log(perp)
    lists = knn.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "neighbor", "distance"))).alias("nb"))

    def cond(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, AFFINITY_ROWS):
                batch = whole.slice(at, AFFINITY_ROWS)
                lists, sizes = batch.column(1), batch.column(1).value_lengths().to_numpy()
                items = lists.flatten()
                valid = np.arange(sizes.max())[None, :] < sizes[:, None]
                d2 = np.zeros(valid.shape)
                d2[valid] = items.field(2).to_numpy(zero_copy_only=False) ** 2
                p = _calibrate(d2, valid, target)
                i, j = np.repeat(batch.column(0).to_numpy(), sizes), items.field(1).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j)), pa.array(p[valid])], ["i", "j", "p"])

    # both directions of a pair have the same sum: it is formed once, under the lesser id
    pairs = lists.mapInArrow(cond, "i long, j long, p double").groupBy("i", "j").agg((F.sum("p") / F.lit(2.0 * n)).alias("p"))
    there, back = F.struct("i", "j", "p"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "p")
    alone = F.struct("i", "j", (F.col("p") * 2).alias("p"))
    return pairs.select(F.explode(F.when(F.col("i") == F.col("j"), F.array(alone)).otherwise(F.array(there, back))).alias("s")).select("s.*")
