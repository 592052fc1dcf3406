"""Interpretation of clusters (M22-M28, M30-M33) and the official run.

Profiles come from one unpivoted long table (id, label, variable, value)
aggregated by (label, variable) and by variable; only k x p statistics reach
the driver (for the 4 x 4 canonical assignment).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import cluster as C
from . import matrix as M
from ..session import cut_lineage
from .filters import numeric

# --- fixed values (must equal the reference for equal results) -------------
RECOMMENDED_VECTOR = [
    "age", "num_platforms", "num_telemetry_platforms", "self_reported_weekly_play", "gdt_total",
    "promis_total", "wemwbs_total", "bangs_total", "telem_nocturnal_sessions",
    "steam_playtime_2weeks_max", "steam_playtime_forever_max", "steam_unique_games",
    "steam_owned_games_count", "daily_played_days", "daily_stress_days", "cog_mean_accuracy",
    "cog_mean_rt", "timeuse_gaming_entries", "timeuse_num_days"]
PROFILE_VARIABLES = [
    "num_platforms", "num_telemetry_platforms", "telem_nocturnal_sessions", "telem_total_sessions",
    "steam_playtime_2weeks_max", "steam_playtime_forever_max", "timeuse_gaming_entries",
    "timeuse_num_days", "promis_total", "wemwbs_total", "gdt_total", "bangs_total", "cog_mean_rt",
    "cog_mean_accuracy"]
WELLBEING_VARIABLES = ["promis_total", "wemwbs_total", "gdt_total", "bangs_total",
                       "timeuse_gaming_entries", "timeuse_num_days"]
SUMMARY_VARIABLES = ["telem_nocturnal_sessions", "telem_total_sessions", "num_platforms",
                     "num_telemetry_platforms", "timeuse_num_days", "timeuse_gaming_entries",
                     "promis_total", "wemwbs_total", "gdt_total", "bangs_total"]
COVERAGE_FLAGS = ["has_steam", "has_xbox", "has_nintendo", "has_android", "has_ios", "has_cognitive",
                  "has_timeuse", "has_daily", "has_biweekly"]
# Canonical profiles: weights on standardised differences, in canonical order.
# The second one scores closeness to the global mean over SIGNATURE_COLUMNS.
CANONICAL_WEIGHTS = [
    {"num_platforms": 1.0, "num_telemetry_platforms": 1.0},
    None,
    {"telem_total_sessions": 1.0, "telem_nocturnal_sessions": 1.0},
    {"promis_total": 1.0, "gdt_total": 1.0, "bangs_total": 1.0, "wemwbs_total": -1.0,
     "timeuse_gaming_entries": 0.5, "timeuse_num_days": 0.5},
]
SIGNATURE_COLUMNS = ["num_platforms", "num_telemetry_platforms", "telem_total_sessions",
                     "telem_nocturnal_sessions", "promis_total", "wemwbs_total", "gdt_total",
                     "bangs_total", "timeuse_gaming_entries", "timeuse_num_days"]
OFFICIAL_K = 4
OFFICIAL_SEED = 2026
OFFICIAL_ITERATIONS = 100
TOP_PROFILE = 8
# ---------------------------------------------------------------------------

# Own names of the canonical profiles, in canonical order.
CANONICAL_NAMES = ["multiplatform", "lower-intensity base", "high total and nocturnal intensity",
                   "wellbeing, risk and recorded use"]


def long_values(df: DataFrame, variables: list[str], id_col: str = "record_id",
                extra: list[str] | None = None) -> DataFrame:
    """(id, extra..., variable, value) for finite values only."""
    extra = extra or []
    wide = df.select(id_col, *extra, *[numeric(df, v).alias(v) for v in variables])
    return wide.unpivot([id_col, *extra], variables, "variable", "value").filter(F.col("value").isNotNull())


def global_stats(long: DataFrame) -> DataFrame:
    """Per variable: mean, population std (0 or n < 2 -> 1), observed count."""
    g = long.groupBy("variable").agg(F.avg("value").alias("global_mean"),
                                     F.stddev_pop("value").alias("_sd"), F.count(F.lit(1)).alias("n"))
    sd = F.when((F.col("n") < 2) | (F.col("_sd") == 0) | F.col("_sd").isNull(), F.lit(1.0)).otherwise(F.col("_sd"))
    return g.select("variable", "global_mean", sd.alias("global_std"), F.col("n").alias("global_n"))


def cluster_profile(df: DataFrame, labels: DataFrame, variables: list[str], id_col: str = "record_id",
                    label: str = "label", k: int | None = None) -> DataFrame:
    """Per (label, variable): mean over observed (not imputed) member
    values, global mean, z = (mean - global) / std, observed count; no
    observation -> mean NULL and z 0. Labels 0..k-1 all appear."""
    rows = df.select(id_col, *variables).join(labels.select(id_col, label), id_col)
    long = long_values(rows, variables, id_col, [label])
    g = global_stats(long_values(df, variables, id_col))
    per = long.groupBy(label, "variable").agg(F.avg("value").alias("mean"),
                                              F.count(F.lit(1)).alias("observed"))
    spark = df.sparkSession
    if k is None:  # number of clusters: a small, bounded list
        labs = sorted(r[0] for r in labels.select(label).distinct().collect())
    else:
        labs = list(range(k))
    grid = spark.createDataFrame([(int(lb), i, v) for lb in labs for i, v in enumerate(variables)],
                                 f"{label} int, var_order int, variable string")
    out = grid.join(per, [label, "variable"], "left").join(g, "variable", "left")
    z = F.when(F.col("mean").isNull(), F.lit(0.0)).otherwise((F.col("mean") - F.col("global_mean")) / F.col("global_std"))
    return out.select(label, "var_order", "variable", "mean", "global_mean", z.alias("z"),
                      F.coalesce("observed", F.lit(0)).cast("long").alias("observed"))


def top_variables(profile: DataFrame, k: int = 5, label: str = "label") -> DataFrame:
    """Top-k variables per cluster by abs(z) (finite z only),
    ties by variable order."""
    w = Window.partitionBy(label).orderBy(F.desc(F.abs("z")), F.asc("var_order"))
    return (profile.filter(F.col("mean").isNotNull()).withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def canonical_scores(profile: DataFrame, label: str = "label") -> DataFrame:
    """(label, canonical, score) from the profile's z values (absent
    variable -> 0)."""
    z = {v: F.coalesce(F.max(F.when(F.col("variable") == v, F.col("z"))), F.lit(0.0))
         for v in set(SIGNATURE_COLUMNS) | {x for w in CANONICAL_WEIGHTS if w for x in w}}
    scores = []
    for ci, w in enumerate(CANONICAL_WEIGHTS):
        if w is None:
            s = -sum(F.abs(z[v]) for v in SIGNATURE_COLUMNS) / len(SIGNATURE_COLUMNS)
        else:
            s = sum(z[v] * F.lit(wt) for v, wt in w.items())
        scores.append(F.struct(F.lit(ci).alias("canonical"), s.alias("score")))
    return (profile.groupBy(label).agg(F.array(*scores).alias("s"))
            .select(label, F.explode("s").alias("x")).select(label, "x.canonical", "x.score"))


def best_assignment(scores: DataFrame, k: int = OFFICIAL_K, label: str = "label") -> DataFrame:
    """Raw label per canonical name maximising the total score over all
    k! assignments (ties -> first permutation in lexicographic order). The
    k x k score matrix (16 numbers) is the only driver input."""
    mat = {(r[label], r["canonical"]): r["score"] for r in scores.collect()}
    best, best_perm = None, None
    for perm in permutations(range(k)):
        total = sum(mat.get((raw, can), 0.0) for can, raw in enumerate(perm))
        if best is None or total > best:
            best, best_perm = total, perm
    rows = [(int(raw), int(can), CANONICAL_NAMES[can], float(mat.get((raw, can), 0.0)))
            for can, raw in enumerate(best_perm)]
    return scores.sparkSession.createDataFrame(rows, f"{label} int, canonical int, name string, selection_score double")


@dataclass
class OfficialRun:
    labels: DataFrame       # (id, raw_label, label)
    clusters: DataFrame     # (label, name, count, selection_score)
    profile: DataFrame      # canonical label x variable
    manifest: DataFrame     # one row
    features: list[str]


def official_run(df: DataFrame, candidates: list[str] | None = None, id_col: str = "record_id",
                 seed: int = OFFICIAL_SEED, iterations: int = OFFICIAL_ITERATIONS) -> OfficialRun:
    """>= 4 rows; features = numeric candidates with a finite value
    (>= 2); median imputation; z-scores; K-means k=4; profile of validation
    variables + features on observed values; canonical names."""
    candidates = candidates or RECOMMENDED_VECTOR
    # one pass: row count and the finite-value count of every candidate and
    # profile variable (features and profile columns need a finite value)
    wanted = [c for c in dict.fromkeys(candidates + PROFILE_VARIABLES) if c in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(numeric(df, c)).alias(c) for c in wanted]).first()
    n = counts["__rows"]
    if n < 4:
        raise ValueError("the official run needs at least four rows")
    feats = [c for c in candidates if c in df.columns and counts[c] > 0]
    if len(feats) < 2:
        raise ValueError("the official run needs at least two numeric features")
    z = M.prepare(df, feats, "median", id_col)
    km = C.kmeans(z, feats, OFFICIAL_K, iterations, seed, id_col)
    prof_vars = [c for c in dict.fromkeys(PROFILE_VARIABLES + feats) if c in df.columns and counts[c] > 0]
    # k x p rows, read twice (score matrix and output): materialised once
    raw_prof = cut_lineage(cluster_profile(df, km.labels, prof_vars, id_col, "label", OFFICIAL_K))
    mapping = best_assignment(canonical_scores(raw_prof))
    m = mapping.select(F.col("label").alias("raw_label"), F.col("canonical").alias("label"), "name",
                       "selection_score")
    labels = km.labels.withColumnRenamed("label", "raw_label").join(F.broadcast(m.select("raw_label", "label")),
                                                                    "raw_label")
    counts = labels.groupBy("label").agg(F.count(F.lit(1)).alias("count"))
    clusters = m.join(counts, "label", "left").select(
        "label", "name", F.coalesce("count", F.lit(0)).alias("count"), "selection_score")
    profile = (raw_prof.withColumnRenamed("label", "raw_label").join(F.broadcast(m), "raw_label")
               .select("label", "name", "var_order", "variable", "mean", "global_mean", "z", "observed"))
    ids = df.agg(F.min_by(F.col(id_col).cast("string"), F.col(id_col)).alias("first_id"),
                 F.max_by(F.col(id_col).cast("string"), F.col(id_col)).alias("last_id"))
    manifest = ids.select(
        F.lit(n).alias("rows"), "first_id", "last_id", F.lit(",".join(feats)).alias("features"),
        F.lit("median").alias("imputation"), F.lit("zscore").alias("standardization"),
        F.lit(OFFICIAL_K).alias("clusters"), F.lit(seed).alias("seed"), F.lit(iterations).alias("iterations"),
        F.lit(km.iterations).alias("iterations_run"), F.lit(km.converged).alias("converged"),
        F.lit(km.sse).alias("sse"))
    return OfficialRun(labels, clusters, profile, manifest, feats)


def run_matches(manifest: DataFrame, df: DataFrame, features: list[str], id_col: str = "record_id") -> bool:
    """A stored run applies only to the same rows (count, first and last
    id) and the same feature list."""
    m = manifest.first()
    cur = df.agg(F.count(F.lit(1)).alias("n"), F.min_by(F.col(id_col).cast("string"), F.col(id_col)).alias("a"),
                 F.max_by(F.col(id_col).cast("string"), F.col(id_col)).alias("b")).first()
    return (m["rows"] == cur["n"] and m["first_id"] == cur["a"] and m["last_id"] == cur["b"]
            and m["features"] == ",".join(features))


def selection_profile(df: DataFrame, selected: DataFrame, variables: list[str],
                      id_col: str = "record_id") -> DataFrame:
    """Selected rows vs all rows per variable: group mean, global mean,
    z = difference / population std (0 -> 1), coverage = observed / selected.
    Variables need a group value and >= 2 population values."""
    g = global_stats(long_values(df, variables, id_col))
    sel = df.join(selected.select(id_col), id_col, "left_semi")
    n_sel = sel.count()
    grp = long_values(sel, variables, id_col).groupBy("variable").agg(
        F.avg("value").alias("group_mean"), F.count(F.lit(1)).alias("observed"))
    j = grp.join(g, "variable").filter(F.col("global_n") >= 2)
    return j.select("variable", "group_mean", "global_mean",
                    ((F.col("group_mean") - F.col("global_mean")) / F.col("global_std")).alias("z"),
                    (F.col("observed") / F.lit(max(n_sel, 1))).alias("coverage"))


def pair_compare(df: DataFrame, coords: DataFrame, a_id, b_id, variables: list[str],
                 id_col: str = "record_id") -> DataFrame:
    """Two rows side by side per variable: values, difference (b - a),
    % of abs(a) (NULL when a = 0), z of each and z difference; plus their
    2-D distance."""
    g = global_stats(long_values(df, variables, id_col))
    two = long_values(df.filter(F.col(id_col).isin(a_id, b_id)), variables, id_col)
    piv = two.groupBy("variable").agg(
        F.max(F.when(F.col(id_col) == a_id, F.col("value"))).alias("a_value"),
        F.max(F.when(F.col(id_col) == b_id, F.col("value"))).alias("b_value"))
    var = df.sparkSession.createDataFrame([(v,) for v in variables], "variable string")
    j = var.join(piv, "variable", "left").join(g, "variable", "left")
    diff = F.col("b_value") - F.col("a_value")
    za = (F.col("a_value") - F.col("global_mean")) / F.col("global_std")
    zb = (F.col("b_value") - F.col("global_mean")) / F.col("global_std")
    pts = coords.filter(F.col(id_col).isin(a_id, b_id)).agg(
        F.max(F.when(F.col(id_col) == a_id, F.col("x"))).alias("ax"), F.max(F.when(F.col(id_col) == a_id, F.col("y"))).alias("ay"),
        F.max(F.when(F.col(id_col) == b_id, F.col("x"))).alias("bx"), F.max(F.when(F.col(id_col) == b_id, F.col("y"))).alias("by")).first()
    dist = None
    if None not in (pts["ax"], pts["ay"], pts["bx"], pts["by"]):
        dist = float(((pts["ax"] - pts["bx"]) ** 2 + (pts["ay"] - pts["by"]) ** 2) ** 0.5)
    return j.select("variable", "a_value", "b_value", diff.alias("difference"),
                    F.when(F.col("a_value") != 0, diff / F.abs(F.col("a_value")) * 100).alias("pct"),
                    za.alias("a_z"), zb.alias("b_z"), (zb - za).alias("z_difference"),
                    F.lit(dist).cast("double").alias("distance"))


def coverage_by_cluster(df: DataFrame, labels: DataFrame, flags: list[str], id_col: str = "record_id",
                        label: str = "label") -> DataFrame:
    """Per cluster, 100 x mean(flag, missing -> 0)."""
    present = [f for f in flags if f in df.columns]
    j = df.select(id_col, *present).join(labels.select(id_col, label), id_col)
    agg = j.groupBy(label).agg(F.count(F.lit(1)).alias("members"),
                               *[(F.avg(F.coalesce(numeric(df, f), F.lit(0.0))) * 100).alias(f) for f in present])
    return agg.unpivot([label, "members"], present, "flag", "coverage_pct")


def cluster_means(df: DataFrame, labels: DataFrame, variables: list[str], id_col: str = "record_id",
                  label: str = "label") -> DataFrame:
    """Members and observed means of the summary variables per cluster."""
    present = [v for v in variables if v in df.columns]
    j = df.select(id_col, *[numeric(df, v).alias(v) for v in present]).join(labels.select(id_col, label), id_col)
    return j.groupBy(label).agg(F.count(F.lit(1)).alias("members"), *[F.avg(v).alias(v) for v in present])


def cluster_z_means(z: DataFrame, labels: DataFrame, variables: list[str], id_col: str = "record_id",
                    label: str = "label") -> DataFrame:
    """Mean of the imputed z-scores per cluster (long form)."""
    j = z.join(labels.select(id_col, label), id_col)
    agg = j.groupBy(label).agg(*[F.avg(v).alias(v) for v in variables])
    return agg.unpivot([label], variables, "variable", "z_mean")


def export_projection(df: DataFrame, coords: DataFrame, labels: DataFrame | None,
                      id_col: str = "record_id") -> DataFrame:
    """Every row with its projection coordinates and cluster label
    (NULL when absent)."""
    out = df.join(coords.select(id_col, "x", "y"), id_col, "left")
    if labels is not None:
        out = out.join(labels.select(id_col, "label"), id_col, "left")
    return out
