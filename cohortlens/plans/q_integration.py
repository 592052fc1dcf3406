"""Integration queries: stand-in sources -> per-person feature blocks -> wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import integrate as I
from .oracle_integration import WIDE_ROUNDED, integration_with
from .registry import query, rounded, sql_rounded
from ..session import cut_lineage
from .standins import raw_sources, standin_ctes

W = integration_with()
# Averages of 2-decimal inputs over n < 256 rows are exact at 9 decimals, so
# rounding there never sits on a tie (6 decimals can: 64 rows -> x.xxxxxx5).
AVG_DIGITS = 9


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return raw_sources(spark, sf_dir)


def wide_table(spark: SparkSession, sf_dir: str, materialise: bool = True, columns: list[str] | None = None) -> DataFrame:
    """The integrated wide cohort table (unrounded). Analyses that make
    several passes get it materialised once in the checkpoint folder, with the
    ``columns`` that they read (default: all); a single-pass query keeps the
    plan so Catalyst prunes the aggregates and parsers of the columns it does
    not read."""
    wide = I.integrate(sources(spark, sf_dir), intake_row_index="row_index", biweekly_row_index="row_index")
    if columns is not None:
        read = set(columns)
        wide = wide.select(*[c for c in wide.columns if c in read])
    return cut_lineage(wide) if materialise else wide


def _cohort_keys(src: dict[str, DataFrame]) -> DataFrame:
    return I.cohort_filter(src["intake"]).select("pid").distinct()


def _block(spark, sf_dir, name, fn):
    src = raw_sources(spark, sf_dir, ["intake", name])
    return fn(I.restrict_to_cohort(src[name], _cohort_keys(src)))


@query("cohort_semi_join", "WITH " + standin_ctes(["intake", "xbox"]) + """,
people AS (SELECT DISTINCT pid FROM src_intake
  WHERE COALESCE(qualified IN ('1', 'TRUE'), false) AND pid IS NOT NULL AND pid <> '')
SELECT * FROM src_xbox WHERE pid IN (SELECT pid FROM people)""")
def cohort_semi_join(spark, sf_dir):
    src = raw_sources(spark, sf_dir, ["intake", "xbox"])
    return I.restrict_to_cohort(src["xbox"], _cohort_keys(src))


@query("integrate_cohort", sql_rounded(W + "SELECT * FROM wide", WIDE_ROUNDED, AVG_DIGITS))
def integrate_cohort(spark, sf_dir):
    return rounded(wide_table(spark, sf_dir, materialise=False), WIDE_ROUNDED, AVG_DIGITS)


@query("platform_count", W + "SELECT pid, record_id, age, num_platforms FROM people")
def platform_count(spark, sf_dir):
    src = raw_sources(spark, sf_dir, ["intake"])
    return I.intake_rows(src["intake"], row_index="row_index").select(
        "pid", "record_id", "age", "num_platforms")


@query("first_wave", W + """SELECT pid, wave, row_index, CAST(n_rows AS BIGINT) AS num_waves
FROM bw_ranked WHERE rn = 1""")
def first_wave(spark, sf_dir):
    src = raw_sources(spark, sf_dir, ["intake", "biweekly"])
    bw = I.restrict_to_cohort(src["biweekly"], _cohort_keys(src))
    return I.first_wave(bw.select("pid", "wave", "row_index"), "pid", "wave", "row_index")


@query("scale_totals", W + "SELECT pid, gdt_total, promis_total, wemwbs_total FROM bw")
def scale_totals(spark, sf_dir):
    src = raw_sources(spark, sf_dir, ["intake", "biweekly"])
    bw = I.restrict_to_cohort(src["biweekly"], _cohort_keys(src))
    return I.biweekly_features(bw, "pid").select("pid", "gdt_total", "promis_total", "wemwbs_total")


@query("scale_total_threshold", W + """SELECT pid, bangs_total,
  CAST(""" + " + ".join(f"CAST(bw_bangs_{i} IS NOT NULL AS INTEGER)" for i in range(1, 19))
       + """ AS INTEGER) AS bangs_answered FROM bw""")
def scale_total_threshold(spark, sf_dir):
    src = raw_sources(spark, sf_dir, ["intake", "biweekly"])
    bw = I.restrict_to_cohort(src["biweekly"], _cohort_keys(src))
    out = I.biweekly_features(bw, "pid")
    answered = sum(F.col(f"bw_bangs_{i}").isNotNull().cast("int") for i in range(1, 19))
    return out.select("pid", "bangs_total", answered.cast("int").alias("bangs_answered"))


@query("daily_counts", W + "SELECT * FROM daily")
def daily_counts(spark, sf_dir):
    return _block(spark, sf_dir, "daily", I.daily_features)


@query("minutes_sum_mean", sql_rounded(W + "SELECT * FROM android",
                                       ["android_total_minutes", "android_mean_daily_minutes"], AVG_DIGITS))
def minutes_sum_mean(spark, sf_dir):
    out = _block(spark, sf_dir, "android", lambda d: I.minutes_features(d, "android"))
    return rounded(out, ["android_total_minutes", "android_mean_daily_minutes"], AVG_DIGITS)


_SESS_ROUND = ["nintendo_total_duration_min", "nintendo_mean_session_min"]


@query("session_features", sql_rounded(W + "SELECT * FROM nintendo", _SESS_ROUND, AVG_DIGITS))
def session_features(spark, sf_dir):
    out = _block(spark, sf_dir, "nintendo", lambda d: I.session_features(d, "nintendo"))
    return rounded(out, _SESS_ROUND, AVG_DIGITS)


@query("nocturnal_sessions", W + """SELECT pid, count(*) AS rows,
  count(TRY_CAST(NULLIF(regexp_extract(session_start, 'T([0-9]{2}):', 1), '') AS INTEGER)) AS rows_with_hour,
  CAST(count_if(COALESCE(TRY_CAST(NULLIF(regexp_extract(session_start, 'T([0-9]{2}):', 1), '') AS INTEGER) < 6
    OR TRY_CAST(NULLIF(regexp_extract(session_start, 'T([0-9]{2}):', 1), '') AS INTEGER) >= 22, false)) AS BIGINT)
    AS nocturnal_sessions
FROM src_xbox WHERE pid IN (SELECT pid FROM people) GROUP BY pid""")
def nocturnal_sessions(spark, sf_dir):
    return _block(spark, sf_dir, "xbox", I.nocturnal_counts)


@query("playtime_features", W + "SELECT * FROM steam")
def playtime_features(spark, sf_dir):
    return _block(spark, sf_dir, "steam", I.playtime_features)


@query("owned_features", W + "SELECT * FROM steam_owned")
def owned_features(spark, sf_dir):
    return _block(spark, sf_dir, "steam_owned", I.owned_features)


@query("link_events", W + "SELECT * FROM steam_link")
def link_events(spark, sf_dir):
    return _block(spark, sf_dir, "steam_link", I.link_features)


@query("cognitive_features", sql_rounded(W + "SELECT * FROM cognitive",
                                         ["cog_mean_rt", "cog_mean_accuracy"], AVG_DIGITS))
def cognitive_features(spark, sf_dir):
    return rounded(_block(spark, sf_dir, "cognitive", I.cognitive_features),
                   ["cog_mean_rt", "cog_mean_accuracy"], AVG_DIGITS)


@query("timeuse_features", W + "SELECT * FROM timeuse")
def timeuse_features(spark, sf_dir):
    return _block(spark, sf_dir, "timeuse", I.timeuse_features)


_FLAGS = ["pid", "has_biweekly", "has_daily", "has_android", "has_ios", "has_nintendo", "has_xbox",
          "has_steam", "has_cognitive", "has_timeuse", "num_telemetry_platforms",
          "has_any_telemetry"]


@query("availability_flags", W + f"SELECT {', '.join(_FLAGS)} FROM wide")
def availability_flags(spark, sf_dir):
    return wide_table(spark, sf_dir, materialise=False).select(*_FLAGS)


_TELEM = ["pid", "telem_nocturnal_sessions", "telem_total_sessions", "telem_activity_count"]


@query("derived_telemetry", W + f"SELECT {', '.join(_TELEM)} FROM wide")
def derived_telemetry(spark, sf_dir):
    return wide_table(spark, sf_dir, materialise=False).select(*_TELEM)


def _dictionary_sql() -> str:
    from ..operators.integrate import SOURCE_FILES
    agg_prefixes = ["daily_", "android_", "ios_", "nintendo_", "xbox_", "steam_", "telem_",
                    "cog_", "timeuse_"]
    src_rules = [("bw_", "biweekly"), ("daily_", "daily"), ("android_", "android"),
                 ("ios_", "ios"), ("nintendo_", "nintendo"), ("xbox_", "xbox"),
                 ("steam_", "steam")]
    case_src = "CASE WHEN starts_with(variable, 'bw_') OR variable IN ('gdt_total', 'promis_total', " \
               f"'wemwbs_total', 'bangs_total') THEN '{SOURCE_FILES['biweekly']}' "
    for p, b in src_rules[1:]:
        case_src += f"WHEN starts_with(variable, '{p}') THEN '{SOURCE_FILES[b]}' "
    case_src += "WHEN starts_with(variable, 'telem_') THEN 'derived_telemetry' "
    case_src += f"WHEN starts_with(variable, 'cog_') THEN '{SOURCE_FILES['cognitive']}' "
    case_src += f"WHEN starts_with(variable, 'timeuse_') THEN '{SOURCE_FILES['timeuse']}' "
    case_src += f"ELSE '{SOURCE_FILES['intake']}' END"
    aggd = " OR ".join(f"starts_with(variable, '{p}')" for p in agg_prefixes)
    case_agg = ("CASE WHEN starts_with(variable, 'bw_') THEN 'first_wave' "
                "WHEN ends_with(variable, '_total') THEN 'sum' "
                f"WHEN {aggd} THEN 'aggregated' ELSE 'direct' END")
    return W + f""", wide_txt AS (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM wide),
miss AS (
  SELECT variable, CAST(count_if(value IS NULL OR value = '') AS BIGINT) AS missing_values
  FROM wide_txt UNPIVOT INCLUDE NULLS (value FOR variable IN (COLUMNS(*)))
  GROUP BY variable)
SELECT variable, {case_src} AS source_file,
  CASE WHEN starts_with(variable, 'bw_') THEN substr(variable, 4) ELSE variable END AS original_column,
  variable AS generated_column, {case_agg} AS aggregation,
  'Variable: ' || variable AS description, 'mixed' AS data_type,
  CAST(missing_values AS BIGINT) AS missing_values
FROM miss"""


@query("data_dictionary", _dictionary_sql())
def data_dictionary(spark, sf_dir):
    return I.data_dictionary(wide_table(spark, sf_dir, materialise=False)).drop("position")


@query("source_inventory", "WITH " + standin_ctes() + ",\nx AS (" + " UNION ALL ".join(
    f"SELECT '{I.SOURCE_FILES[n]}' AS file, '{n}' AS block, true AS used, count(*) AS rows FROM src_{n}"
    for n in I.SOURCE_FILES) + ") SELECT * FROM x")
def source_inventory(spark, sf_dir):
    return I.source_inventory(sources(spark, sf_dir))
