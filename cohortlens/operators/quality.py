"""Coverage, dataset readiness and vector quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse as P
from .filters import complete_cases, numeric
from .profile import infer_types
from .relate import VECTOR_THRESHOLD, correlation_matrix, high_pairs

# --- fixed values (must equal the reference for equal results) -------------
READY_MIN_NUMERIC = 20         # P19: ready if at least 20 numeric columns ...
READY_MAX_MEAN_MISSING = 35.0  # ... and mean missing below 35 %
HIGH_MISSING_PCT = 40.0        # P19: columns listed as high-missing
TOP_MISSING = 5
# P20 score ladder: (threshold, points), first match wins.
SCORE_SIZE = [(8, 15), (4, 10)]
SCORE_NUMERIC = [(5, 25), (3, 18), (2, 10)]
SCORE_MISSING = [(15.0, 20), (35.0, 12)]       # mean missing below
SCORE_COMPLETE = [(80.0, 20), (60.0, 12)]      # complete-case share at least
SCORE_CORR = [(2, 20), (5, 12)]                # high-correlation pairs at most
LEVELS = [(80, "high"), (55, "medium")]        # else "low"
# ---------------------------------------------------------------------------


def coverage(df: DataFrame, flags: list[str], loaded_text: bool = False) -> DataFrame:
    """Per flag, 100 x mean(flag, missing as 0), or the share of
    loaded-flag texts (X7). One aggregation pass."""
    present = [f for f in flags if f in df.columns]
    if loaded_text:
        aggs = [(F.avg(P.flag_loaded(f).cast("double")) * 100).alias(f) for f in present]
    else:
        aggs = [(F.avg(F.coalesce(numeric(df, f), F.lit(0.0))) * 100).alias(f) for f in present]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(f).alias("flag"),
                 F.col(f).alias("coverage_pct"), F.col("__rows").alias("rows"))
        for i, f in enumerate(present)])).alias("s")).select("s.*")


def readiness(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Counts by type, mean missing %, top high-missing columns and the
    ready verdict (numeric >= 20 and mean missing < 35)."""
    cols = cols or df.columns
    t = infer_types(df, cols)
    rows = df.count()
    miss = t.withColumn("missing_pct", (F.lit(rows) - F.col("non_missing")) * 100.0 / F.lit(max(rows, 1)))
    hi = miss.filter(F.col("missing_pct") >= HIGH_MISSING_PCT)
    # at most five column names reach the driver
    top = [r["column"] for r in hi.orderBy(F.desc("missing_pct"), F.asc("column")).limit(TOP_MISSING).collect()]
    base = miss.agg(F.count(F.lit(1)).alias("columns"),
                    F.count_if(F.col("type") == "numeric").alias("numeric"),
                    F.count_if(F.col("type") == "categorical").alias("categorical"),
                    F.avg("missing_pct").alias("mean_missing_pct"))
    ready = (F.col("numeric") >= READY_MIN_NUMERIC) & (F.col("mean_missing_pct") < READY_MAX_MEAN_MISSING)
    return base.select("columns", "numeric", "categorical", "mean_missing_pct",
                       F.lit(",".join(top)).alias("top_missing"), ready.alias("ready"))


def _ladder(x, steps, above: bool = True, else_pts: int = 0):
    expr = F.lit(else_pts)
    for thr, pts in reversed(steps):
        cond = (x >= thr) if above else (x < thr)
        expr = F.when(cond, F.lit(pts)).otherwise(expr)
    return expr


def vector_score(df: DataFrame, vector: list[str]) -> DataFrame:
    """P20: vector quality score and level (one agg for missing and
    complete cases, one pass for the correlation pairs)."""
    present = [c for c in vector if c in df.columns]
    t = infer_types(df, present)
    rows = df.count()
    nums = [r["column"] for r in t.filter(F.col("type") == "numeric").select("column").collect()]
    nums = [c for c in present if c in set(nums)]
    complete = complete_cases(df, nums).count() if nums else 0
    corr_pairs = (high_pairs(correlation_matrix(df, nums, diagonal=False), VECTOR_THRESHOLD, strict=False)
                  .count() if len(nums) >= 2 else 0)
    stats = t.agg(F.avg((F.lit(rows) - F.col("non_missing")) * 100.0 / F.lit(max(rows, 1)))
                  .alias("mean_missing_pct"),
                  F.count_if((F.lit(rows) - F.col("non_missing")) * 100.0 / F.lit(max(rows, 1))
                             >= HIGH_MISSING_PCT).alias("high_missing"))
    size, numeric_n = len(present), len(nums)
    complete_pct = complete * 100.0 / rows if rows else 0.0
    s = stats.select(
        F.lit(size).alias("size"), F.lit(numeric_n).alias("numeric"), "mean_missing_pct",
        "high_missing", F.lit(complete_pct).alias("complete_pct"),
        F.lit(corr_pairs).cast("long").alias("high_corr_pairs"))
    score = (_ladder(F.col("size"), SCORE_SIZE) + _ladder(F.col("numeric"), SCORE_NUMERIC)
             + _ladder(F.col("mean_missing_pct"), SCORE_MISSING, above=False)
             + _ladder(F.col("complete_pct"), SCORE_COMPLETE)
             + F.when(F.col("high_corr_pairs") <= SCORE_CORR[0][0], SCORE_CORR[0][1])
             .when(F.col("high_corr_pairs") <= SCORE_CORR[1][0], SCORE_CORR[1][1]).otherwise(0))
    lvl = F.when(F.col("score") >= LEVELS[0][0], LEVELS[0][1]).when(
        F.col("score") >= LEVELS[1][0], LEVELS[1][1]).otherwise("low")
    return s.withColumn("score", score).withColumn("level", lvl)
