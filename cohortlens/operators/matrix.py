"""Matrix preparation and projection (M1-M6).

Only p-sized statistics reach the driver (means, medians, standard
deviations, the p x p covariance); rows stay distributed and scores are plain
column expressions, so the whole preparation fuses into one projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import complete_cases, numeric
from .profile import rank_stats

IMPUTE_METHODS = ("mean", "median", "zero", "drop")
PCA_GRADES = [(0.8, "high"), (0.6, "moderate")]  # M6: PC1+PC2 share, else "low"


def build_matrix(df: DataFrame, variables: list[str], id_col: str = "record_id") -> DataFrame:
    """M1: id plus the strict numeric value of every variable."""
    return df.select(id_col, *[numeric(df, v).alias(v) for v in variables])


def column_medians(df: DataFrame, variables: list[str]) -> dict[str, float]:
    """Exact midpoint medians of finite values (distributed rank selection)."""
    q = rank_stats(df, variables).select("column", "median").collect()
    return {r["column"]: r["median"] for r in q}


def impute_values(m: DataFrame, variables: list[str], method: str) -> dict[str, float]:
    """Fill value per variable; an all-missing variable gets 0."""
    if method == "zero":
        return {v: 0.0 for v in variables}
    if method == "mean":
        row = m.agg(*[F.avg(v).alias(v) for v in variables]).first()
        vals = {v: row[v] for v in variables}
    elif method == "median":
        vals = column_medians(m, variables)
    else:
        raise ValueError(f"unknown imputation {method!r}")
    return {v: (float(vals[v]) if vals.get(v) is not None else 0.0) for v in variables}


def impute(m: DataFrame, variables: list[str], method: str = "mean",
           id_col: str = "record_id") -> DataFrame:
    """M2: fill missing values (mean / median / zero) or drop incomplete rows."""
    if method == "drop":
        return complete_cases(m, variables)
    fill = impute_values(m, variables, method)
    return m.select(id_col, *[F.coalesce(F.col(v), F.lit(fill[v])).alias(v) for v in variables])


def zscore_params(m: DataFrame, variables: list[str]) -> dict[str, tuple[float, float]]:
    row = m.agg(*[F.avg(v).alias(f"{v}__m") for v in variables],
                *[F.stddev_pop(v).alias(f"{v}__s") for v in variables]).first()
    return {v: (row[f"{v}__m"] or 0.0, row[f"{v}__s"] or 0.0) for v in variables}


def zscore(m: DataFrame, variables: list[str], id_col: str = "record_id",
           params: dict | None = None) -> DataFrame:
    """M3: (x - mean) / population std; zero std -> 0."""
    params = params or zscore_params(m, variables)

    def z(v: str) -> Column:
        mu, sd = params[v]
        return F.lit(0.0) if not sd or sd <= 0 else (F.col(v) - F.lit(mu)) / F.lit(sd)

    return m.select(id_col, *[z(v).alias(v) for v in variables])


def prepare(df: DataFrame, variables: list[str], method: str = "mean",
            id_col: str = "record_id") -> DataFrame:
    """M4: build + impute + standardise."""
    m = build_matrix(df, variables, id_col)
    return zscore(impute(m, variables, method, id_col), variables, id_col)


def orient(vec: np.ndarray) -> np.ndarray:
    """Sign rule: the largest-magnitude loading is positive (ties -> first)."""
    a = np.abs(vec)
    strongest = int(np.argmax(a >= a.max() * (1 - 1e-9)))
    return -vec if vec[strongest] < 0 else vec


@dataclass
class PCAResult:
    scores: DataFrame
    variables: list[str]
    explained: list[float]
    loadings: dict[str, list[float]] = field(default_factory=dict)
    rows_used: int = 0


def gram(z: DataFrame, variables: list[str]) -> tuple[int, np.ndarray]:
    """n and the p x p matrix of sums z_i z_j in one aggregation pass."""
    p = len(variables)
    exprs = ["count(1) AS n"] + [f"sum(`{variables[i]}` * `{variables[j]}`) AS g{i}_{j}"
                                 for i in range(p) for j in range(i, p)]
    row = z.selectExpr(*exprs).first()
    g = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            g[i, j] = g[j, i] = row[f"g{i}_{j}"] or 0.0
    return int(row["n"]), g


def pca(df: DataFrame, variables: list[str], method: str = "mean", id_col: str = "record_id",
        components: int = 2) -> PCAResult:
    """M5: PCA on z-scores. Covariance = Z'Z / (n-1); explained = eigenvalue /
    trace; scores = z . loading as column expressions."""
    z = prepare(df, variables, method, id_col)
    n, g = gram(z, variables)
    if n < 2 or not variables:
        raise ValueError("PCA needs at least 2 rows and 1 variable")
    cov = g / max(n - 1, 1)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    trace = float(np.trace(cov)) or 1.0
    comps, explained = [], []
    for k in range(components):
        if k < len(variables):
            comps.append(orient(vecs[:, k]))
            explained.append(float(max(vals[k], 0.0)) / trace)
        else:
            comps.append(np.zeros(len(variables)))
            explained.append(0.0)
    names = ["x", "y"] + [f"pc{i + 1}" for i in range(2, components)]
    score_cols = []
    for k, vec in enumerate(comps):
        terms = " + ".join(f"`{v}` * ({float(w)!r}D)" for v, w in zip(variables, vec))
        score_cols.append(F.expr(f"0.0D + {terms}").alias(names[k]))
    scores = z.select(id_col, *score_cols)
    loadings = {f"PC{k + 1}": [float(w) for w in vec] for k, vec in enumerate(comps)}
    return PCAResult(scores, list(variables), explained, loadings, n)


def pca_grade(explained: list[float]) -> str:
    """M6: quality grade of the first two components."""
    s = sum(explained[:2])
    for thr, name in PCA_GRADES:
        if s >= thr:
            return name
    return "low"
