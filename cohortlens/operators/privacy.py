"""Privacy-minimised publishing (V1-V5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse as P
from ..sources.rowindex import with_row_index
from .common import broadcast_if_small
from .filters import numeric

# --- fixed values (must equal the reference for equal results) -------------
REMOVED_COLUMNS = ["pid", "geo_area", "height", "weight", "ethnicity", "edu_level", "employment",
                   "marital_status", "dependents", "cohort", "neuro_identify", "neuro_diagnosed",
                   "neuro_diag_asd", "neuro_diag_adhd", "neuro_diag_dyslexia"]
RARE_COLUMNS = ["gender", "country"]
RARE_MIN_COUNT = 10
RARE_LABEL = "Other"
AGE_STEP = 5
# ---------------------------------------------------------------------------


def suppress_rare(df: DataFrame, col: str, min_count: int = RARE_MIN_COUNT, label: str = RARE_LABEL) -> DataFrame:
    """V4: trimmed values seen fewer than ``min_count`` times become
    ``label``; missing stays missing. Counting is a grouped aggregate; the
    (value -> rare) table is broadcast only when small."""
    v = F.nullif(P.trimmed(col), F.lit(""))
    counts = df.select(v.alias("_v")).filter(F.col("_v").isNotNull()).groupBy("_v").agg(
        F.count(F.lit(1)).alias("_n"))
    rare = counts.filter(F.col("_n") < min_count).select("_v", F.lit(True).alias("_rare"))
    rare, _ = broadcast_if_small(rare)
    out = df.withColumn("_v", v).join(rare, "_v", "left")
    return out.withColumn(col, F.when(F.col("_rare"), F.lit(label)).otherwise(F.col("_v"))).drop("_v", "_rare")


def publish(df: DataFrame, id_col: str = "record_id", order_by: list | None = None,
            drop: list[str] | None = None, rare: list[str] | None = None,
            generalise: dict[str, float] | None = None, shuffle_key: str | None = None) -> DataFrame:
    """V1-V3: drop identifying columns, re-number ``record_id`` 1..n, generalise
    age to 5-year steps (missing stays missing) and suppress rare categories.

    The new numbers follow ``order_by`` (columns of ``df``, default the current
    id); with ``shuffle_key`` they follow a hash of key and id, so they tell
    nothing about the order of the source and can be repeated by who holds the
    key. Only ids and their order are sorted and written; ids have to be unique."""
    drop = REMOVED_COLUMNS if drop is None else drop
    rare = RARE_COLUMNS if rare is None else rare
    generalise = {"age": AGE_STEP} if generalise is None else generalise
    keyed = [F.sha2(F.concat(F.lit(f"{shuffle_key}:"), F.col(id_col).cast("string")), 256)]
    order = keyed if shuffle_key is not None else [F.col(c) if isinstance(c, str) else c for c in order_by or [id_col]]
    ranked = df.select(F.col(id_col).alias("_id"), *[c.alias(f"_order_{i}") for i, c in enumerate(order)])
    numbers = with_row_index(ranked, "_new_id", order_by=[*(f"_order_{i}" for i in range(len(order))), "_id"]).select("_id", "_new_id")
    out = df.drop(*[c for c in drop if c in df.columns and c != id_col])
    for c, step in generalise.items():
        if c in out.columns:
            out = out.withColumn(c, P.generalise(numeric(out, c), float(step)))
    for c in rare:
        if c in out.columns:
            out = suppress_rare(out, c)
    cols = out.columns
    return out.join(numbers, F.col(id_col).eqNullSafe(F.col("_id"))).withColumn(id_col, F.col("_new_id")).select(*cols)


def release_note(published: DataFrame) -> DataFrame:
    """V5: one-row release manifest for the integration report."""
    return published.agg(F.count(F.lit(1)).alias("final_rows")).select(
        "final_rows", F.lit(len(published.columns)).alias("final_columns"),
        F.lit(True).alias("minimized"), F.lit(True).alias("direct_identifiers_removed"),
        F.lit(AGE_STEP).alias("age_generalization_years"),
        F.lit(RARE_MIN_COUNT).alias("rare_category_threshold"))
