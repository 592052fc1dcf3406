"""Interpretation, official run and privacy queries on the integrated table."""

from __future__ import annotations

from itertools import permutations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import cluster as C
from ..operators import interpret as IN
from ..operators import matrix as M
from ..operators import privacy as PV
from ..operators.filters import numeric_features
from .oracle_integration import WIDE_ROUNDED, integration_with
from ..session import cut_lineage
from .q_integration import AVG_DIGITS, wide_table
from .registry import query, rounded, sql_rounded
from .standins import table

W = integration_with()
K = 4
# The Spark side derives the same list from the data (features with a finite value).
FEATS = IN.RECOMMENDED_VECTOR
PROF = list(dict.fromkeys(IN.PROFILE_VARIABLES + FEATS))
#: All that profiles, official runs and their exports read of the wide table.
READ = ["record_id", *dict.fromkeys([*PROF, *IN.SUMMARY_VARIABLES, *IN.COVERAGE_FLAGS, "pid", "age", "gender", "country"])]


def official_space(spark, sf_dir):
    """(wide, features, z, labels): median-imputed z-scores of the official
    features and labels from the nearest of the first four rows' vectors
    (a deterministic, SQL-expressible labelling)."""
    wide = wide_table(spark, sf_dir, columns=READ)
    feats = numeric_features(wide, IN.RECOMMENDED_VECTOR)
    z = M.prepare(wide, feats, "median")
    rows = z.orderBy("record_id").limit(K).collect()
    centres = np.array([[r[c] for c in feats] for r in rows], dtype=float)
    labels = C.assign(z, feats, centres).select("record_id", "label")
    return wide, feats, z, labels


def _d(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def _zsql(cols):
    return ", ".join(
        f"CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () "
        f"ELSE 0.0 END AS {c}" for c in cols)


D2 = " + ".join(f"(z.{c} - q.{c}) * (z.{c} - q.{c})" for c in FEATS)
SPACE_SQL = W + f""", med AS (SELECT {', '.join(f'median({_d(c)}) AS {c}' for c in FEATS)} FROM wide),
imp AS (SELECT record_id, {', '.join(f'COALESCE({_d(c)}, (SELECT {c} FROM med), 0.0) AS {c}' for c in FEATS)} FROM wide),
z AS (SELECT record_id, {_zsql(FEATS)} FROM imp),
c0 AS (SELECT row_number() OVER (ORDER BY record_id) - 1 AS c, {', '.join(FEATS)} FROM z ORDER BY record_id LIMIT {K}),
lab AS (SELECT record_id, CAST(c AS INTEGER) AS label FROM (
  SELECT z.record_id, q.c, row_number() OVER (PARTITION BY z.record_id ORDER BY {D2}, q.c) AS rn FROM z, c0 q)
  WHERE rn = 1)"""


def _long_sql(name: str, cols: list[str]) -> str:
    sel = ", ".join(f"{_d(c)} AS {c}" for c in cols)
    return f"""{name} AS (UNPIVOT (SELECT record_id, {sel} FROM wide) ON {', '.join(cols)}
  INTO NAME variable VALUE value)"""


def _gstats_sql(name: str, long: str) -> str:
    return f"""{name} AS (SELECT variable, avg(value) AS global_mean,
  CASE WHEN count(*) < 2 OR stddev_pop(value) = 0 OR stddev_pop(value) IS NULL THEN 1.0 ELSE stddev_pop(value) END AS global_std,
  count(*) AS global_n FROM {long} GROUP BY variable)"""


def _vars_values(cols: list[str]) -> str:
    return ", ".join(f"('{c}', {i})" for i, c in enumerate(cols))


PROFILE_SQL = SPACE_SQL + f""", {_long_sql('lv', PROF)}, {_gstats_sql('g', 'lv')},
per AS (SELECT label, variable, avg(value) AS mean, count(*) AS observed FROM lv JOIN lab USING (record_id)
        GROUP BY label, variable),
grid AS (SELECT l.label, v.variable, v.var_order FROM (SELECT CAST(range AS INTEGER) AS label FROM range({K})) l,
         (VALUES {_vars_values(PROF)}) v(variable, var_order) WHERE v.variable IN (SELECT variable FROM g)),
prof AS (SELECT grid.label, grid.var_order, grid.variable, per.mean, g.global_mean,
           CASE WHEN per.mean IS NULL THEN 0.0 ELSE (per.mean - g.global_mean) / g.global_std END AS z,
           CAST(COALESCE(per.observed, 0) AS BIGINT) AS observed
         FROM grid LEFT JOIN per USING (label, variable) LEFT JOIN g USING (variable))"""

PROF_COLS = ["mean", "global_mean", "z"]


def profile_df(spark, sf_dir):
    wide, feats, z, labels = official_space(spark, sf_dir)
    prof_vars = numeric_features(wide, list(dict.fromkeys(IN.PROFILE_VARIABLES + feats)))
    return cut_lineage(IN.cluster_profile(wide, labels, prof_vars, k=K))


@query("cluster_profile", sql_rounded(PROFILE_SQL + " SELECT label, variable, mean, global_mean, z, observed FROM prof",
                                      PROF_COLS))
def cluster_profile(spark, sf_dir):
    p = profile_df(spark, sf_dir).select("label", "variable", "mean", "global_mean", "z", "observed")
    return rounded(p, PROF_COLS)


@query("cluster_top_variables", sql_rounded(PROFILE_SQL + """
SELECT label, variable, rank, z FROM (
  SELECT label, variable, z, row_number() OVER (PARTITION BY label ORDER BY abs(z) DESC, var_order) AS rank
  FROM prof WHERE mean IS NOT NULL) WHERE rank <= 5""", ["z"]))
def cluster_top_variables(spark, sf_dir):
    t = IN.top_variables(profile_df(spark, sf_dir), 5)
    return rounded(t.select("label", "variable", F.col("rank").cast("bigint").alias("rank"), "z"), ["z"])


def _canonical_sql() -> str:
    needed = sorted(set(IN.SIGNATURE_COLUMNS) | {v for w in IN.CANONICAL_WEIGHTS if w for v in w})
    zs = ", ".join(f"COALESCE(max(CASE WHEN variable = '{v}' THEN z END), 0.0) AS z_{v}" for v in needed)
    scores = []
    for ci, w in enumerate(IN.CANONICAL_WEIGHTS):
        if w is None:
            s = "-(" + " + ".join(f"abs(z_{v})" for v in IN.SIGNATURE_COLUMNS) + f") / {len(IN.SIGNATURE_COLUMNS)}"
        else:
            s = " + ".join(f"z_{v} * {wt!r}" for v, wt in w.items())
        scores.append(f"SELECT label, {ci} AS canonical, {s} AS score FROM zs")
    perms = ", ".join(f"({i}, {', '.join(map(str, p))})" for i, p in enumerate(permutations(range(K))))
    names = ", ".join(f"({i}, '{n}')" for i, n in enumerate(IN.CANONICAL_NAMES))
    join = " OR ".join(f"(sc.canonical = {i} AS_AND sc.label = p.r{i})" for i in range(K)).replace(" AS_AND ", " AND ")
    return PROFILE_SQL + f""", zs AS (SELECT label, {zs} FROM prof GROUP BY label),
sc AS ({" UNION ALL ".join(scores)}),
perms AS (SELECT * FROM (VALUES {perms}) p(perm, r0, r1, r2, r3)),
tot AS (SELECT p.perm, sum(sc.score) AS total FROM perms p JOIN sc ON {join} GROUP BY p.perm),
best AS (SELECT * FROM perms WHERE perm = (SELECT perm FROM tot ORDER BY total DESC, perm LIMIT 1)),
m AS (SELECT r0 AS label, 0 AS canonical FROM best UNION ALL SELECT r1, 1 FROM best
      UNION ALL SELECT r2, 2 FROM best UNION ALL SELECT r3, 3 FROM best)
SELECT CAST(m.label AS INTEGER) AS label, CAST(m.canonical AS INTEGER) AS canonical, n.name, sc.score AS selection_score
FROM m JOIN (VALUES {names}) n(canonical, name) USING (canonical)
JOIN sc ON sc.label = m.label AND sc.canonical = m.canonical"""


@query("canonical_labels", sql_rounded(_canonical_sql(), ["selection_score"]))
def canonical_labels(spark, sf_dir):
    best = IN.best_assignment(IN.canonical_scores(profile_df(spark, sf_dir)))
    return rounded(best, ["selection_score"])


SEL_COLS = ["group_mean", "global_mean", "z", "coverage"]


@query("selection_profile", sql_rounded(W + f""", {_long_sql('lv', FEATS)}, {_gstats_sql('g', 'lv')},
sel AS (SELECT record_id FROM wide WHERE has_xbox = 1),
grp AS (SELECT variable, avg(value) AS group_mean, count(*) AS observed FROM lv
        WHERE record_id IN (SELECT record_id FROM sel) GROUP BY variable)
SELECT variable, group_mean, global_mean, (group_mean - global_mean) / global_std AS z,
  observed / (SELECT greatest(count(*), 1) FROM sel) AS coverage
FROM grp JOIN g USING (variable) WHERE global_n >= 2""", SEL_COLS))
def selection_profile(spark, sf_dir):
    wide = wide_table(spark, sf_dir, columns=READ)
    feats = numeric_features(wide, IN.RECOMMENDED_VECTOR)
    sel = wide.filter(F.col("has_xbox") == 1).select("record_id")
    return rounded(IN.selection_profile(wide, sel, feats), SEL_COLS)


PAIR_COLS = ["a_value", "b_value", "difference", "pct", "a_z", "b_z", "z_difference", "distance"]


@query("pair_compare", sql_rounded(SPACE_SQL + f""", {_long_sql('lv', FEATS)}, {_gstats_sql('g', 'lv')},
two AS (SELECT variable, max(CASE WHEN record_id = 1 THEN value END) AS a_value,
          max(CASE WHEN record_id = 2 THEN value END) AS b_value FROM lv WHERE record_id IN (1, 2) GROUP BY variable),
pts AS (SELECT max(CASE WHEN record_id = 1 THEN num_platforms END) AS a_x, max(CASE WHEN record_id = 1 THEN telem_nocturnal_sessions END) AS a_y,
          max(CASE WHEN record_id = 2 THEN num_platforms END) AS b_x, max(CASE WHEN record_id = 2 THEN telem_nocturnal_sessions END) AS b_y
        FROM z WHERE record_id IN (1, 2))
SELECT v.variable, a_value, b_value, b_value - a_value AS difference,
  CASE WHEN a_value <> 0 THEN (b_value - a_value) / abs(a_value) * 100 END AS pct,
  (a_value - global_mean) / global_std AS a_z, (b_value - global_mean) / global_std AS b_z,
  (b_value - global_mean) / global_std - (a_value - global_mean) / global_std AS z_difference,
  (SELECT sqrt((a_x - b_x) * (a_x - b_x) + (a_y - b_y) * (a_y - b_y)) FROM pts) AS distance
FROM (VALUES {', '.join(f"('{c}')" for c in FEATS)}) v(variable) LEFT JOIN two USING (variable) LEFT JOIN g USING (variable)
WHERE v.variable IN (SELECT variable FROM g)""",
                                        PAIR_COLS))
def pair_compare(spark, sf_dir):
    wide, feats, z, _ = official_space(spark, sf_dir)
    coords = z.select("record_id", F.col("num_platforms").alias("x"), F.col("telem_nocturnal_sessions").alias("y"))
    return rounded(IN.pair_compare(wide, coords, 1, 2, feats), PAIR_COLS)


@query("coverage_by_cluster", sql_rounded(SPACE_SQL + ", j AS (SELECT * FROM wide JOIN lab USING (record_id)) "
                                          + " UNION ALL ".join(
    f"SELECT label, count(*) AS members, '{f}' AS flag, avg(COALESCE(CAST({f} AS DOUBLE), 0.0)) * 100 AS coverage_pct "
    f"FROM j GROUP BY label" for f in IN.COVERAGE_FLAGS),
    ["coverage_pct"]))
def coverage_by_cluster(spark, sf_dir):
    wide, _, _, labels = official_space(spark, sf_dir)
    return rounded(IN.coverage_by_cluster(wide, labels, IN.COVERAGE_FLAGS), ["coverage_pct"])


@query("wellbeing_contrast", sql_rounded(PROFILE_SQL + " SELECT label, variable, mean, global_mean, z, observed FROM prof "
                                         f"WHERE variable IN ({', '.join(repr(v) for v in IN.WELLBEING_VARIABLES)})",
                                         PROF_COLS))
def wellbeing_contrast(spark, sf_dir):
    p = profile_df(spark, sf_dir).filter(F.col("variable").isin(*IN.WELLBEING_VARIABLES))
    return rounded(p.select("label", "variable", "mean", "global_mean", "z", "observed"), PROF_COLS)


@query("cluster_means", sql_rounded(SPACE_SQL + f""" SELECT label, count(*) AS members,
  {', '.join(f'avg({_d(c)}) AS {c}' for c in IN.SUMMARY_VARIABLES)}
FROM wide JOIN lab USING (record_id) GROUP BY label""", IN.SUMMARY_VARIABLES, 4))
def cluster_means(spark, sf_dir):
    wide, _, _, labels = official_space(spark, sf_dir)
    return rounded(IN.cluster_means(wide, labels, IN.SUMMARY_VARIABLES), IN.SUMMARY_VARIABLES, 4)


@query("cluster_z_means", sql_rounded(SPACE_SQL + f""", zm AS (SELECT label, {', '.join(f'avg({c}) AS {c}' for c in FEATS)}
  FROM z JOIN lab USING (record_id) GROUP BY label), {_long_sql('lv', FEATS)}
SELECT label, variable, z_mean FROM (UNPIVOT zm ON {', '.join(FEATS)} INTO NAME variable VALUE z_mean)
WHERE variable IN (SELECT DISTINCT variable FROM lv)""", ["z_mean"]))
def cluster_z_means(spark, sf_dir):
    _, feats, z, labels = official_space(spark, sf_dir)
    return rounded(IN.cluster_z_means(z, labels, feats), ["z_mean"])


@query("export_projection", sql_rounded(SPACE_SQL + """
SELECT w.record_id, w.pid, w.age, w.gender, w.country, z.num_platforms AS x, z.telem_nocturnal_sessions AS y, lab.label
FROM wide w LEFT JOIN z USING (record_id) LEFT JOIN lab USING (record_id)""", ["x", "y"]))
def export_projection(spark, sf_dir):
    wide, _, z, labels = official_space(spark, sf_dir)
    coords = z.select("record_id", F.col("num_platforms").alias("x"), F.col("telem_nocturnal_sessions").alias("y"))
    out = IN.export_projection(wide.select("record_id", "pid", "age", "gender", "country"), coords, labels)
    return rounded(out, ["x", "y"])


@query("official_profile")
def official_profile(spark, sf_dir):
    """Median imputation, z-scores, seeded K-means k=4 (seed 2026,
    100 iterations), profile on observed values, canonical names."""
    run = IN.official_run(wide_table(spark, sf_dir, columns=READ))
    return run.profile.join(run.clusters.select("label", "count", "selection_score"), "label")


# --- privacy -------------------------------------------------------------------------

CATEGORY_SQL = "SELECT p_partkey, p_brand || '/' || p_type AS category FROM part"


@query("rare_category_suppress", f"""WITH c AS ({CATEGORY_SQL}),
n AS (SELECT trim(category) AS v, count(*) AS n FROM c WHERE trim(category) <> '' GROUP BY 1)
SELECT p_partkey, CASE WHEN n.n < 10 THEN 'Other' ELSE NULLIF(trim(category), '') END AS category
FROM c LEFT JOIN n ON n.v = trim(c.category)""")
def rare_category_suppress(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    c = p.select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("category"))
    return PV.suppress_rare(c, "category")


SHUFFLE_KEY = "release-1"
_REMOVED = ["pid", "height", "weight", "ethnicity", "edu_level", "employment", "marital_status", "dependents", "cohort",
            "neuro_identify", "neuro_diagnosed", "neuro_diag_asd", "neuro_diag_adhd", "neuro_diag_dyslexia"]


@query("privacy_publish", sql_rounded(W + f""", n_g AS (SELECT trim(gender) AS v, count(*) AS n FROM wide WHERE trim(gender) <> '' GROUP BY 1),
n_c AS (SELECT trim(country) AS v, count(*) AS n FROM wide WHERE trim(country) <> '' GROUP BY 1)
SELECT wide.* EXCLUDE ({', '.join(_REMOVED)}) REPLACE (
  CAST(row_number() OVER (ORDER BY sha256('{SHUFFLE_KEY}:' || record_id)) AS BIGINT) AS record_id,
  floor(age / 5 + 0.5) * 5 AS age,
  CASE WHEN n_g.n < 10 THEN 'Other' ELSE NULLIF(trim(gender), '') END AS gender,
  CASE WHEN n_c.n < 10 THEN 'Other' ELSE NULLIF(trim(country), '') END AS country)
FROM wide LEFT JOIN n_g ON n_g.v = trim(wide.gender) LEFT JOIN n_c ON n_c.v = trim(wide.country)""", WIDE_ROUNDED, AVG_DIGITS))
def privacy_publish(spark, sf_dir):
    """V1-V4: every published column, under new numbers in the order of a keyed hash."""
    return rounded(PV.publish(wide_table(spark, sf_dir), shuffle_key=SHUFFLE_KEY), WIDE_ROUNDED, AVG_DIGITS)


@query("release_note", W + f"""SELECT count(*) AS final_rows,
  CAST((SELECT count(*) FROM (DESCRIBE SELECT * EXCLUDE ({', '.join(_REMOVED)}) FROM wide)) AS INTEGER) AS final_columns,
  true AS minimized, true AS direct_identifiers_removed, 5 AS age_generalization_years, 10 AS rare_category_threshold
FROM wide""")
def release_note(spark, sf_dir):
    """V5: the note that goes with a release, counted from the published table."""
    return PV.release_note(PV.publish(wide_table(spark, sf_dir), shuffle_key=SHUFFLE_KEY))


# --- case studies, run fingerprint, projection quality --------------------------------

CASE_CLUSTERS = [(2, 2), (3, 3), (4, 0)]  # (case number, canonical cluster it inspects)


@query("case_reasons", sql_rounded(_canonical_sql().rsplit("SELECT CAST(m.label AS INTEGER)", 1)[0] + f"""
, cnt AS (SELECT label, count(*) AS n FROM lab GROUP BY label),
ranked AS (SELECT label, variable, z, row_number() OVER (PARTITION BY label ORDER BY abs(z) DESC, var_order) AS rank
           FROM prof),
cases AS (SELECT * FROM (VALUES {', '.join(f'({c}, {k})' for c, k in CASE_CLUSTERS)}) c(case_no, canonical))
SELECT cases.case_no, CAST(m.canonical AS INTEGER) AS label, n.name, cnt.n AS members, ranked.rank, ranked.variable, ranked.z
FROM cases JOIN m USING (canonical) JOIN (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(IN.CANONICAL_NAMES))}) n(canonical, name) USING (canonical)
JOIN cnt ON cnt.label = m.label JOIN ranked ON ranked.label = m.label WHERE ranked.rank <= 3""", ["z"]))
def case_reasons(spark, sf_dir):
    """For the cases that inspect one canonical profile, the profile's
    size and its three most distinct variables (by abs z)."""
    wide, feats, z, labels = official_space(spark, sf_dir)
    prof_vars = numeric_features(wide, list(dict.fromkeys(IN.PROFILE_VARIABLES + feats)))
    prof = IN.cluster_profile(wide, labels, prof_vars, k=K)
    best = IN.best_assignment(IN.canonical_scores(prof))
    w = Window.partitionBy("label").orderBy(
        F.desc(F.abs("z")), F.asc("var_order"))
    top = prof.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 3)
    counts = labels.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    cases = spark.createDataFrame(CASE_CLUSTERS, "case_no int, canonical int")
    out = (cases.join(best, "canonical").join(counts, "label").join(top.select("label", "rank", "variable", "z"), "label")
           .select("case_no", F.col("canonical").alias("label"), "name", "members",
                   F.col("rank").cast("bigint").alias("rank"), "variable", "z"))
    return rounded(out, ["z"])


@query("official_manifest")
def official_manifest(spark, sf_dir):
    """M22 + M25: the run manifest and whether it applies to the current rows
    and features (fingerprint: row count, first and last id, features)."""
    wide = wide_table(spark, sf_dir, columns=READ)
    run = IN.official_run(wide)
    ok = IN.run_matches(run.manifest, wide, run.features)
    return run.manifest.withColumn("matches", F.lit(ok))


@query("pca_quality")
def pca_quality(spark, sf_dir):
    """M5 + M6 on all official features (p > 2, median imputation): explained
    variance of the first two components and the quality grade."""
    wide = wide_table(spark, sf_dir, columns=READ)
    feats = numeric_features(wide, IN.RECOMMENDED_VECTOR)
    res = M.pca(wide, feats, "median")
    rows = [(res.explained[0], res.explained[1], M.pca_grade(res.explained), res.rows_used, len(feats))]
    return spark.createDataFrame(rows, "pc1 double, pc2 double, grade string, rows_used long, variables int")
