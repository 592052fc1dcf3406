"""Parse/filter, profiling, relation and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse as P
from ..operators import filters as FL
from ..operators import integrate as I
from ..operators import profile as PR
from ..operators import quality as QA
from ..operators import relate as RL
from ..operators.interpret import RECOMMENDED_VECTOR
from .features import CUST_SQL, cust
from .oracle_integration import integration_with
from .q_integration import wide_table
from .registry import query, sigd, sql_sig
from .sqlfrag import flag, sn, sv
from .standins import register_tables, standin_ctes, table

W = integration_with()
WC = "WITH " + CUST_SQL + "\n"

# --- parse / filter ----------------------------------------------------------

TEXTS_SQL = """SELECT o_orderkey, o_orderpriority AS t1, substr(o_orderpriority, 1, 1) AS t2,
  ' ' || CAST(o_totalprice AS STRING) || ' ' AS t3,
  CASE o_orderstatus WHEN 'P' THEN 'NaN' WHEN 'O' THEN '1e3' ELSE '0x10' END AS t4,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'always' WHEN '2-HIGH' THEN ' Very Often'
    WHEN '3-MEDIUM' THEN 'SOMETIMES ' WHEN '4-NOT SPECIFIED' THEN 'NA' ELSE 'rarely' END AS w1,
  CASE o_orderstatus WHEN 'P' THEN 'never' WHEN 'O' THEN 'null' ELSE '  ' END AS w2
FROM orders"""


def _texts(spark, sf_dir):
    register_tables(spark, sf_dir, ["orders"])
    return spark.sql(TEXTS_SQL)


@query("strict_numeric", f"""SELECT o_orderkey, {sn('t1')} AS x1, {sn('t2')} AS x2, {sn('t3')} AS x3,
  {sn('t4')} AS x4 FROM ({TEXTS_SQL}) t""")
def strict_numeric(spark, sf_dir):
    t = _texts(spark, sf_dir)
    return t.select("o_orderkey", *[P.strict_numeric(f"t{i}").alias(f"x{i}") for i in range(1, 5)])


@query("ordinal_parse", f"""SELECT o_orderkey, {sv('w1')} AS v1, {sv('w2')} AS v2, {sv('t2')} AS v3
FROM ({TEXTS_SQL}) t""")
def ordinal_parse(spark, sf_dir):
    t = _texts(spark, sf_dir)
    return t.select("o_orderkey", P.survey_value("w1").alias("v1"), P.survey_value("w2").alias("v2"),
                    P.survey_value("t2").alias("v3"))


@query("cohort_filter", "WITH " + standin_ctes(["intake"]) + f"""
SELECT pid, qualified FROM src_intake WHERE {flag('qualified')} AND pid IS NOT NULL AND pid <> ''""")
def cohort_filter(spark, sf_dir):
    from .standins import raw_sources
    return I.cohort_filter(raw_sources(spark, sf_dir, ["intake"])["intake"]).select("pid", "qualified")


def _rng(x, lo=None, hi=None, include_missing=None):
    """Oracle form of a range filter."""
    conds = []
    if lo is not None:
        conds.append(f"{x} >= {lo}")
    if hi is not None:
        conds.append(f"{x} <= {hi}")
    inside = " AND ".join(conds) or "true"
    passes = "false" if include_missing is False else "true"
    return f"(CASE WHEN {x} IS NULL THEN {passes} ELSE {inside} END)"


@query("filter_range", WC + f"SELECT record_id, acctbal FROM cust WHERE {_rng('acctbal', 0, 5000)}")
def filter_range(spark, sf_dir):
    df = cust(spark, sf_dir, materialise=False)
    return FL.filter_rows(df, {"acctbal": FL.ColumnFilter(min=0, max=5000)}).select("record_id", "acctbal")


@query("filter_category", WC + f"""SELECT record_id FROM cust
WHERE {_rng('nation', 2, 20)} AND CAST(nation AS VARCHAR) IN ('1', '3', '5', '7', '11', '13', '21')
  AND segment IN ('BUILDING', 'MACHINERY')""")
def filter_category(spark, sf_dir):
    df = cust(spark, sf_dir, materialise=False)
    f = {"nation": FL.ColumnFilter(min=2, max=20, values=["1", "3", "5", "7", "11", "13", "21"]),
         "segment": FL.ColumnFilter(values=["BUILDING", "MACHINERY"])}
    return FL.filter_rows(df, f).select("record_id")


@query("filter_selection", WC + f"""SELECT record_id FROM cust
WHERE {_rng('spend', 1000000, None)}
  AND CAST(record_id AS VARCHAR) IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders
                                     WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def filter_selection(spark, sf_dir):
    df = cust(spark, sf_dir, materialise=False)
    o = table(spark, sf_dir, "orders")
    sel = o.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")).select("o_custkey")
    return FL.filter_rows(df, {"spend": FL.ColumnFilter(min=1000000)}, selected=sel).select("record_id")


@query("filter_combined", WC + f"""SELECT record_id FROM cust
WHERE {_rng('acctbal', -500, 8000, False)} AND segment IN ('AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD')
  AND {_rng('ev_total', 100, None)} AND {_rng('n_orders', None, 12)}""")
def filter_combined(spark, sf_dir):
    df = cust(spark, sf_dir, materialise=False)
    f = {"acctbal": FL.ColumnFilter(min=-500, max=8000, include_missing=False),
         "segment": FL.ColumnFilter(values=["AUTOMOBILE", "FURNITURE", "HOUSEHOLD"]),
         "ev_total": FL.ColumnFilter(min=100),
         "n_orders": FL.ColumnFilter(max=12)}
    return FL.filter_rows(df, f).select("record_id")


@query("complete_cases", WC + """SELECT record_id FROM cust
WHERE acctbal IS NOT NULL AND n_events IS NOT NULL AND ev_mean IS NOT NULL""")
def complete_cases(spark, sf_dir):
    return FL.complete_cases(cust(spark, sf_dir, materialise=False), ["acctbal", "n_events", "ev_mean"]).select("record_id")


@query("keyword_search", """SELECT p_partkey, p_name, p_brand FROM part
WHERE contains(lower(p_name), 'red') OR contains(lower(p_brand), 'red') OR contains(lower(p_type), 'red')
  OR contains(lower(CAST(p_size AS VARCHAR)), 'red')""")
def keyword_search(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return FL.keyword_rows(p, "RED", ["p_name", "p_brand", "p_type", "p_size"]).select(
        "p_partkey", "p_name", "p_brand")


@query("preview_page", WC + """SELECT record_id, segment, nation, n_orders, n_urgent, n_status
FROM cust ORDER BY record_id LIMIT 10 OFFSET 30""")
def preview_page(spark, sf_dir):
    df = cust(spark, sf_dir, materialise=False).select("record_id", "segment", "nation", "n_orders", "n_urgent", "n_status")
    return FL.preview_page(df, page=3)


DETAIL_SECTIONS = {"profile": ["segment", "nation", "acctbal"],
                   "orders": ["n_orders", "n_urgent", "n_status"],
                   "events": ["n_events", "ev_night", "n_titles"]}


DOUBLE_COLS = {"acctbal", "spend", "mean_price", "max_price", "ev_total", "ev_mean", "ev_max",
               "l_quantity", "l_extendedprice", "l_discount", "l_tax"}


def _txt(c):
    """Reference text form: integral doubles print without '.0'."""
    if c not in DOUBLE_COLS:
        return f"CAST({c} AS VARCHAR)"
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} = floor({c}) AND abs({c}) < 1e15 "
            f"THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END")


@query("participant_detail", WC + " UNION ALL ".join(
    f"SELECT {i} AS section_order, '{s}' AS section, '{c}' AS field, {_txt(c)} AS value FROM cust "
    f"WHERE record_id = 42 AND {_txt(c)} IS NOT NULL AND {_txt(c)} <> ''"
    for i, (s, cols) in enumerate(DETAIL_SECTIONS.items()) for c in cols))
def participant_detail(spark, sf_dir):
    return FL.participant_detail(cust(spark, sf_dir, materialise=False), 42, DETAIL_SECTIONS)


# --- profiling -----------------------------------------------------------------

INFER_SQL = W + f""", wide_txt AS (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM wide),
long AS (FROM wide_txt UNPIVOT INCLUDE NULLS (value FOR "column" IN (COLUMNS(*)))),
t AS (SELECT "column", CAST(count_if(value IS NOT NULL AND value <> '') AS BIGINT) AS non_missing,
        count({sn('value')}) AS numeric_values, (SELECT count(*) FROM wide) AS rows
      FROM long GROUP BY "column")"""


@query("infer_types", INFER_SQL + """
SELECT "column", non_missing, numeric_values,
  CASE WHEN non_missing > 0 AND numeric_values / non_missing > 0.75 THEN 'numeric' ELSE 'categorical' END AS type
FROM t""")
def infer_types(spark, sf_dir):
    return PR.infer_types(wide_table(spark, sf_dir)).drop("position")


LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _li_profile_sql() -> str:
    parts = []
    for i, c in enumerate(LI_COLS):
        num = c in LI_NUM
        x = c if num else "CAST(NULL AS DOUBLE)"
        t = _txt(c)
        typ = "'numeric'" if num else "'categorical'"
        parts.append(f"""SELECT {i + 1} AS position, '{c}' AS "column", {typ} AS type,
  count({x}) AS valid, CAST(count_if({c} IS NULL) AS BIGINT) AS missing,
  CAST(count_if({c} IS NULL) AS DOUBLE) * 100.0 / count(*) AS missing_pct,
  count(DISTINCT {t}) AS unique,
  (SELECT -sum(p * log2(p)) FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM lineitem
     WHERE {c} IS NOT NULL GROUP BY {t})) AS entropy,
  avg({x}) AS mean, stddev_pop({x}) AS std, min({x}) AS min, max({x}) AS max,
  CASE WHEN stddev_pop({x}) > 0 AND count({x}) > 2 THEN
    (SELECT avg(power(({x}) - m, 3)) / power(var_pop({x}), 1.5)
     FROM lineitem, (SELECT avg({x}) AS m FROM lineitem)) END AS skewness,
  CASE WHEN stddev_pop({x}) > 0 AND count({x}) > 2 THEN
    (SELECT avg(power(({x}) - m, 4)) / power(var_pop({x}), 2) - 3
     FROM lineitem, (SELECT avg({x}) AS m FROM lineitem)) END AS kurtosis
FROM lineitem""")
    return " UNION ALL ".join(parts)


PROFILE_DOUBLES = ["missing_pct", "entropy", "mean", "std", "min", "max", "skewness", "kurtosis"]


@query("column_profile", sql_sig(_li_profile_sql(), PROFILE_DOUBLES))
def column_profile(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return sigd(PR.column_profile(li, LI_COLS), PROFILE_DOUBLES)


TOP_COLS = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]


@query("top_values", " UNION ALL ".join(
    f"""SELECT "column", value, count, rank FROM (
  SELECT '{c}' AS "column", v AS value, count(*) AS count,
    row_number() OVER (ORDER BY count(*) DESC,
      CASE WHEN regexp_matches(v, '^(0|[1-9][0-9]{{0,8}})$') THEN 0 ELSE 1 END,
      CASE WHEN regexp_matches(v, '^(0|[1-9][0-9]{{0,8}})$') THEN CAST(v AS BIGINT) END NULLS LAST,
      v) AS rank
  FROM (SELECT {_txt(c)} AS v FROM lineitem) WHERE v IS NOT NULL AND v <> '' GROUP BY v)
WHERE rank <= 10""" for c in TOP_COLS))
def top_values(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return PR.top_values(PR.frequencies(li, TOP_COLS)).select(
        "column", "value", "count", F.col("rank").cast("bigint").alias("rank"))


ENT_COLS = ["p_brand", "p_type", "p_size", "p_name"]


@query("entropy", sql_sig(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", -sum(p * log2(p)) AS entropy, CAST(sum(cnt) AS BIGINT) AS count,
  count(*) AS unique
FROM (SELECT count(*) AS cnt, count(*) / sum(count(*)) OVER () AS p FROM part GROUP BY {c})"""
    for c in ENT_COLS), ["entropy"]))
def entropy(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return sigd(PR.entropy(PR.frequencies(p, ENT_COLS)).select("column", "entropy", "count", "unique"),
                ["entropy"])


Q_COLS = [("orders", "o_totalprice"), ("lineitem", "l_quantity"), ("lineitem", "l_extendedprice")]


def _quartile_sql(t: str, c: str) -> str:
    return f"""SELECT '{c}' AS "column", count(*) AS n,
  CASE WHEN count(*) % 2 = 0 THEN (max(CASE WHEN rn = count_all // 2 THEN x END)
      + max(CASE WHEN rn = count_all // 2 + 1 THEN x END)) / 2
    ELSE max(CASE WHEN rn = (count_all + 1) // 2 THEN x END) END AS median,
  max(CASE WHEN rn = CAST(floor(count_all * 0.25) AS BIGINT) + 1 THEN x END) AS q1,
  max(CASE WHEN rn = CAST(floor(count_all * 0.75) AS BIGINT) + 1 THEN x END) AS q3
FROM (SELECT {c} AS x, row_number() OVER (ORDER BY {c}) AS rn, count(*) OVER () AS count_all
      FROM {t} WHERE {c} IS NOT NULL)"""


@query("quartiles_floor_rank", sql_sig("SELECT \"column\", n, median, q1, q3, q3 - q1 AS iqr FROM ("
                                       + " UNION ALL ".join(_quartile_sql(t, c) for t, c in Q_COLS) + ")",
                                       ["median", "q1", "q3", "iqr"]))
def quartiles_floor_rank(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    q = PR.quartiles(o, ["o_totalprice"]).unionByName(PR.quartiles(li, ["l_quantity", "l_extendedprice"]))
    return sigd(q, ["median", "q1", "q3", "iqr"])


SHAPE_COLS = ["acctbal", "n_orders", "spend", "mean_price", "ev_total", "ev_mean", "has_orders"]


@query("shape_stats", sql_sig(WC + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, avg({c}) AS mean, stddev_pop({c}) AS std,
  CASE WHEN stddev_pop({c}) > 0 AND count({c}) > 2 THEN
    (SELECT avg(power({c} - m, 3)) / power(var_pop({c}), 1.5) FROM cust, (SELECT avg({c}) AS m FROM cust)) END AS skewness,
  CASE WHEN stddev_pop({c}) > 0 AND count({c}) > 2 THEN
    (SELECT avg(power({c} - m, 4)) / power(var_pop({c}), 2) - 3 FROM cust, (SELECT avg({c}) AS m FROM cust)) END AS kurtosis
FROM cust""" for c in SHAPE_COLS), ["mean", "std", "skewness", "kurtosis"], 8))
def shape_stats(spark, sf_dir):
    m = PR.moments(cust(spark, sf_dir), SHAPE_COLS)
    return sigd(m.select("column", "n", "mean", "std", "skewness", "kurtosis"),
                ["mean", "std", "skewness", "kurtosis"], 8)


@query("frequency_top20", """SELECT p_brand AS value, count(*) AS count FROM part
GROUP BY p_brand ORDER BY count DESC, value LIMIT 20""")
def frequency_top20(spark, sf_dir):
    return PR.frequency_top(table(spark, sf_dir, "part"), "p_brand", 20)


HIST_COLS = ["spend", "ev_total"]


@query("histogram30", sql_sig(WC + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", bin, lo + (bin - 1) * ((hi - lo) / 30) AS bin_start, count(*) AS count
FROM (SELECT CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor(({c} - lo) / ((hi - lo) / 30)) AS INTEGER) + 1, 30) END AS bin,
        lo, hi
      FROM cust, (SELECT min({c}) AS lo, max({c}) AS hi FROM cust) WHERE {c} IS NOT NULL)
GROUP BY bin, lo, hi""" for c in HIST_COLS), ["bin_start"]))
def histogram30(spark, sf_dir):
    return sigd(PR.histogram(cust(spark, sf_dir), HIST_COLS), ["bin_start"])


BOX_COLS = ["spend", "n_orders", "ev_max", "acctbal"]


@query("box_outliers", sql_sig(WC + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", record_id, {c} AS x FROM cust,
  (SELECT max(CASE WHEN rn = CAST(floor(n * 0.25) AS BIGINT) + 1 THEN v END) AS q1,
          max(CASE WHEN rn = CAST(floor(n * 0.75) AS BIGINT) + 1 THEN v END) AS q3
   FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS rn, count(*) OVER () AS n
         FROM cust WHERE {c} IS NOT NULL))
WHERE {c} IS NOT NULL AND ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))"""
    for c in BOX_COLS), ["x"]))
def box_outliers(spark, sf_dir):
    return sigd(PR.box_outliers(cust(spark, sf_dir), BOX_COLS), ["x"])


# --- relations and quality -------------------------------------------------------

def _pair_sql(x: str, y: str, src: str = "cust") -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    return f"""SELECT '{x}' AS x, '{y}' AS y, CAST(count_if({both}) AS BIGINT) AS n,
  CASE WHEN count_if({both}) >= 2
        AND stddev_pop(CASE WHEN {both} THEN {x} END) > 0 AND stddev_pop(CASE WHEN {both} THEN {y} END) > 0
    THEN covar_pop(CASE WHEN {both} THEN {x} END, CASE WHEN {both} THEN {y} END)
      / (stddev_pop(CASE WHEN {both} THEN {x} END) * stddev_pop(CASE WHEN {both} THEN {y} END)) END AS r
FROM {src}"""


@query("pearson_pair", sql_sig(WC + _pair_sql("n_orders", "spend"), ["r"]))
def pearson_pair(spark, sf_dir):
    return sigd(RL.pearson(cust(spark, sf_dir, materialise=False), "n_orders", "spend"), ["r"])


CORR_COLS = ["acctbal", "n_orders", "spend", "mean_price", "max_price", "n_urgent", "n_events",
             "ev_total", "ev_mean", "has_orders"]


def _corr_sql() -> str:
    ups = [_pair_sql(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]
    diag = [f"SELECT '{c}' AS x, '{c}' AS y, count({c}) AS n, 1.0 AS r FROM cust" for c in CORR_COLS]
    return WC + f""", up AS ({" UNION ALL ".join(ups)})
SELECT x, y, n, r FROM up UNION ALL SELECT y AS x, x AS y, n, r FROM up UNION ALL {" UNION ALL ".join(diag)}"""


@query("correlation_matrix", sql_sig(_corr_sql(), ["r"]))
def correlation_matrix(spark, sf_dir):
    return sigd(RL.correlation_matrix(cust(spark, sf_dir), CORR_COLS), ["r"])


@query("high_corr_pairs", sql_sig(f"SELECT x, y, r FROM ({_corr_sql()}) WHERE x < y AND abs(r) > 0.7", ["r"]))
def high_corr_pairs(spark, sf_dir):
    m = RL.correlation_matrix(cust(spark, sf_dir), CORR_COLS)
    return sigd(RL.high_pairs(m, 0.7).select("x", "y", "r"), ["r"])


TREND = ["slope", "intercept", "x0", "x1", "y0", "y1"]


@query("ols_trend", sql_sig(WC + """, p AS (
  SELECT ln(1 + greatest(n_orders, 0.0)) AS x, ln(1 + greatest(spend, 0.0)) AS y FROM cust
  WHERE n_orders IS NOT NULL AND spend IS NOT NULL),
a AS (SELECT count(*) AS n, var_pop(x) AS vx, covar_pop(x, y) AS cxy, avg(x) AS mx, avg(y) AS my,
  min(x) AS x0, max(x) AS x1 FROM p),
b AS (SELECT *, CASE WHEN vx > 0 THEN cxy / vx END AS slope FROM a)
SELECT n, slope, my - slope * mx AS intercept, x0, x1, (my - slope * mx) + slope * x0 AS y0,
  (my - slope * mx) + slope * x1 AS y1 FROM b""", TREND))
def ols_trend(spark, sf_dir):
    return sigd(RL.trend_line(cust(spark, sf_dir, materialise=False), "n_orders", "spend", log=True), TREND)


@query("bivariate_points", sql_sig(WC + """SELECT record_id, spend AS x, ev_total AS y, COALESCE(acctbal, 0.0) AS color
FROM cust WHERE spend IS NOT NULL AND ev_total IS NOT NULL""", ["x", "y", "color"]))
def bivariate_points(spark, sf_dir):
    return sigd(RL.bivariate_points(cust(spark, sf_dir, materialise=False), "spend", "ev_total", color="acctbal"), ["x", "y", "color"])


# fixed values: the flags of the coverage overview, in its order
COVERAGE_FLAGS = ["has_biweekly", "has_daily", "has_steam", "has_xbox", "has_nintendo",
                  "has_android", "has_ios", "has_cognitive", "has_timeuse"]


@query("source_coverage", sql_sig(W + " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{f}' AS flag, avg(COALESCE(CAST({f} AS DOUBLE), 0.0)) * 100 AS coverage_pct, "
    f"count(*) AS rows FROM wide" for i, f in enumerate(COVERAGE_FLAGS)), ["coverage_pct"]))
def source_coverage(spark, sf_dir):
    return sigd(QA.coverage(wide_table(spark, sf_dir, materialise=False), COVERAGE_FLAGS), ["coverage_pct"])


@query("dataset_readiness", sql_sig(INFER_SQL + """,
m AS (SELECT "column", CASE WHEN non_missing > 0 AND numeric_values / non_missing > 0.75 THEN 'numeric'
        ELSE 'categorical' END AS type, (rows - non_missing) * 100.0 / rows AS missing_pct FROM t)
SELECT count(*) AS columns, CAST(count_if(type = 'numeric') AS BIGINT) AS numeric,
  CAST(count_if(type = 'categorical') AS BIGINT) AS categorical, avg(missing_pct) AS mean_missing_pct,
  array_to_string(list_slice(list("column" ORDER BY missing_pct DESC, "column")
    FILTER (WHERE missing_pct >= 40), 1, 5), ',') AS top_missing,
  count_if(type = 'numeric') >= 20 AND avg(missing_pct) < 35 AS ready
FROM m""", ["mean_missing_pct"]))
def dataset_readiness(spark, sf_dir):
    return sigd(QA.readiness(wide_table(spark, sf_dir)), ["mean_missing_pct"])


def _vector_sql() -> str:
    from itertools import combinations
    vec = RECOMMENDED_VECTOR
    miss = " UNION ALL ".join(
        f"SELECT '{c}' AS col, (count(*) - count({c})) * 100.0 / count(*) AS missing_pct, count({c}) > 0 AS has "
        f"FROM wide" for c in vec)
    # a column without any value is not numeric (type rule): it takes no part
    # in complete cases or correlation pairs
    has = ", ".join(f"count({c}) > 0 AS has_{c}" for c in vec)
    complete = " AND ".join(f"({c} IS NOT NULL OR NOT h.has_{c})" for c in vec)
    pairs = " UNION ALL ".join(
        _pair_sql(a, b, "wide").replace("'" + a + "' AS x, '" + b + "' AS y, ", "", 1)
        .replace("FROM wide", f"FROM wide, h WHERE h.has_{a} AND h.has_{b}")
        for a, b in combinations(vec, 2))
    return W + f""", m AS ({miss}), h AS (SELECT {has} FROM wide),
r AS ({pairs}),
s AS (SELECT {len(vec)} AS size, (SELECT CAST(count_if(has) AS INTEGER) FROM m) AS numeric,
  (SELECT avg(missing_pct) FROM m) AS mean_missing_pct,
  (SELECT CAST(count_if(missing_pct >= 40) AS BIGINT) FROM m) AS high_missing,
  (SELECT CASE WHEN (SELECT count_if(has) FROM m) = 0 THEN 0.0 ELSE count_if({complete}) * 100.0 / count(*) END
   FROM wide, h) AS complete_pct,
  (SELECT CAST(count_if(abs(r) >= 0.8) AS BIGINT) FROM r) AS high_corr_pairs),
sc AS (SELECT *, (CASE WHEN size >= 8 THEN 15 WHEN size >= 4 THEN 10 ELSE 0 END)
  + (CASE WHEN numeric >= 5 THEN 25 WHEN numeric >= 3 THEN 18 WHEN numeric >= 2 THEN 10 ELSE 0 END)
  + (CASE WHEN mean_missing_pct < 15 THEN 20 WHEN mean_missing_pct < 35 THEN 12 ELSE 0 END)
  + (CASE WHEN complete_pct >= 80 THEN 20 WHEN complete_pct >= 60 THEN 12 ELSE 0 END)
  + (CASE WHEN high_corr_pairs <= 2 THEN 20 WHEN high_corr_pairs <= 5 THEN 12 ELSE 0 END) AS score FROM s)
SELECT *, CASE WHEN score >= 80 THEN 'high' WHEN score >= 55 THEN 'medium' ELSE 'low' END AS level FROM sc"""


@query("vector_score", sql_sig(_vector_sql(), ["mean_missing_pct", "complete_pct"]))
def vector_score(spark, sf_dir):
    return sigd(QA.vector_score(wide_table(spark, sf_dir, columns=RECOMMENDED_VECTOR), RECOMMENDED_VECTOR),
                ["mean_missing_pct", "complete_pct"])

