"""DuckDB oracle for the integration queries: the consolidation written as
plain SQL (window de-duplication, GROUP BY per source, left joins)."""

from __future__ import annotations

from ..operators.integrate import (BIWEEKLY_COLUMNS, PLATFORM_FLAGS, SCALE_ITEMS,
                                   THRESHOLD_SCALES)
from .sqlfrag import dtext, flag, gaming, noct, sv, wave
from .standins import STANDIN_SQL, standin_ctes

BW_PRESENT = ["gdt_1", "gdt_2", "gdt_3", "gdt_4"] + [f"promis_{i}" for i in range(1, 9)] + \
    [f"wemwbs_{i}" for i in range(1, 8)] + [f"bangs_{i}" for i in range(1, 19)] + ["life_sat"]

# Columns of the wide table that are doubles of arbitrary precision
# (averages, sums of decimals): rounded on both sides before comparing.
WIDE_ROUNDED = ["android_total_minutes", "android_mean_daily_minutes", "ios_total_minutes",
                "ios_mean_daily_minutes", "nintendo_total_duration_min",
                "nintendo_mean_session_min", "xbox_total_duration_min", "xbox_mean_session_min",
                "cog_mean_rt", "cog_mean_accuracy"]


def people_cte() -> str:
    plats = " + ".join(f"CAST({flag(p)} AS INTEGER)" for p in PLATFORM_FLAGS)
    text = ", ".join(f"NULLIF({c}, '') AS {c}" for c in ["gender", "country", "cohort", "edu_level", "employment", "marital_status", "ethnicity"])
    numbers = ", ".join(f"{sv(c)} AS {c}" for c in ["age", "height", "weight", "self_reported_weekly_play", "dependents", "plays_xbox", "plays_steam", "plays_nintendo", "plays_ios", "plays_android", "plays_playstation", "neuro_identify", "neuro_diagnosed", "neuro_diag_asd", "neuro_diag_adhd", "neuro_diag_dyslexia"])
    renamed = ", ".join(f"{sv(c)} AS intake_{c}" for c in ["life_sat", "affective_valence", *(f"wemwbs_{i}" for i in range(1, 8))])
    return f"""intake_q AS (
  SELECT * FROM src_intake
  WHERE {flag('qualified')} AND pid IS NOT NULL AND pid <> ''),
intake_last AS (
  SELECT pid, {text}, {numbers}, {renamed}, {plats} AS num_platforms
  FROM intake_q
  QUALIFY row_number() OVER (PARTITION BY pid ORDER BY row_index DESC) = 1),
intake_first AS (SELECT pid, min(row_index) AS first_row FROM intake_q GROUP BY pid),
people AS (
  SELECT l.*, CAST(row_number() OVER (ORDER BY f.first_row) AS BIGINT) AS record_id
  FROM intake_last l JOIN intake_first f USING (pid))"""


def _bw_cte() -> str:
    cols = []
    for c in BIWEEKLY_COLUMNS:
        cols.append(f"{sv(c)} AS bw_{c}" if c in BW_PRESENT else f"CAST(NULL AS DOUBLE) AS bw_{c}")
    totals = []
    for name, (p, n) in SCALE_ITEMS.items():
        totals.append(" + ".join(f"bw_{p}_{i}" for i in range(1, n + 1)) + f" AS {name}")
    for name, (p, n, k) in THRESHOLD_SCALES.items():
        answered = " + ".join(f"CAST(bw_{p}_{i} IS NOT NULL AS INTEGER)" for i in range(1, n + 1))
        total = " + ".join(f"COALESCE(bw_{p}_{i}, 0.0)" for i in range(1, n + 1))
        totals.append(f"CASE WHEN {answered} >= {k} THEN {total} END AS {name}")
    return f"""bw_ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY pid ORDER BY {wave('wave')}, row_index) AS rn,
    count(*) OVER (PARTITION BY pid) AS n_rows
  FROM src_biweekly s WHERE pid IN (SELECT pid FROM people)),
bw_items AS (
  SELECT pid, {", ".join(cols)}, CAST(n_rows AS BIGINT) AS bw_num_waves
  FROM bw_ranked WHERE rn = 1),
bw AS (SELECT *, {", ".join(totals)} FROM bw_items)"""


def block_ctes() -> str:
    def r(name: str) -> str:
        return f"src_{name} WHERE pid IN (SELECT pid FROM people)"

    def minutes(prefix: str) -> str:
        m = sv("total_gaming_minutes")
        return f"""{prefix} AS (
  SELECT pid, COALESCE(sum({m}), 0.0) AS {prefix}_total_minutes,
    avg({m}) AS {prefix}_mean_daily_minutes, count({m}) AS {prefix}_days_with_data
  FROM {r(prefix)} GROUP BY pid)"""

    def sessions(prefix: str) -> str:
        d = sv("duration")
        return f"""{prefix} AS (
  SELECT pid, count({d}) AS {prefix}_total_sessions,
    COALESCE(sum({d}), 0.0) AS {prefix}_total_duration_min,
    avg({d}) AS {prefix}_mean_session_min, max({d}) AS {prefix}_max_session_min,
    count(DISTINCT {dtext('title_id')}) AS {prefix}_unique_games,
    CAST(count_if({noct('session_start')}) AS BIGINT) AS {prefix}_nocturnal_sessions
  FROM {r(prefix)} GROUP BY pid)"""

    return ",\n".join([
        f"""daily AS (
  SELECT pid, count(*) AS daily_num_responses, CAST(count_if({flag('played24hr')}) AS BIGINT) AS daily_played_days,
    CAST(count_if({flag('had_stress')}) AS BIGINT) AS daily_stress_days
  FROM {r('daily')} GROUP BY pid)""",
        minutes("android"), minutes("ios"), sessions("nintendo"), sessions("xbox"),
        f"""steam AS (
  SELECT pid, min({sv('playtime_2weeks')}) AS steam_playtime_2weeks_min,
    max({sv('playtime_2weeks')}) AS steam_playtime_2weeks_max,
    max({sv('playtime_forever')}) AS steam_playtime_forever_max,
    count(DISTINCT {dtext('title_id')}) AS steam_unique_games, count(*) AS steam_total_records
  FROM {r('steam')} GROUP BY pid)""",
        f"""steam_owned AS (
  SELECT pid, count(*) AS steam_owned_games_count,
    COALESCE(sum({sv('playtime_forever')}), 0.0) AS steam_owned_total_playtime
  FROM {r('steam_owned')} GROUP BY pid)""",
        f"""steam_link AS (
  SELECT pid, 1 AS steam_linked, count(*) AS steam_link_events FROM {r('steam_link')} GROUP BY pid)""",
        f"""cognitive AS (
  SELECT pid, avg({sv('rt')}) AS cog_mean_rt, avg({sv('accuracy')}) AS cog_mean_accuracy,
    count(DISTINCT {dtext('task')}) AS cog_num_tasks, count({sv('rt')}) AS cog_num_trials
  FROM {r('cognitive')} GROUP BY pid)""",
        f"""timeuse AS (
  SELECT pid, count(*) AS timeuse_num_entries, count(DISTINCT {dtext('date')}) AS timeuse_num_days,
    CAST(count_if({gaming('activity')}) AS BIGINT) AS timeuse_gaming_entries
  FROM {r('timeuse')} GROUP BY pid)""",
    ])


FLAG_TESTS = {
    "has_biweekly": "bw_gdt_1", "has_daily": "daily_num_responses",
    "has_android": "android_total_minutes", "has_ios": "ios_total_minutes",
    "has_nintendo": "nintendo_total_sessions", "has_xbox": "xbox_total_sessions",
    "has_steam": "steam_total_records", "has_cognitive": "cog_num_trials",
    "has_timeuse": "timeuse_num_entries",
}


def wide_cte() -> str:
    joins = " ".join(f"LEFT JOIN {b} USING (pid)" for b in
                     ["bw", "daily", "android", "ios", "nintendo", "xbox", "steam", "steam_owned",
                      "steam_link", "cognitive", "timeuse"])
    flags = ", ".join(f"CAST({c} IS NOT NULL AS INTEGER) AS {n}" for n, c in FLAG_TESTS.items())
    tp = " + ".join(f"CAST({FLAG_TESTS[f]} IS NOT NULL AS INTEGER)"
                    for f in ["has_android", "has_ios", "has_nintendo", "has_xbox", "has_steam"])

    def z(c: str) -> str:
        return f"COALESCE(CAST({c} AS DOUBLE), 0.0)"

    act = " + ".join(z(c) for c in ["android_days_with_data", "ios_days_with_data",
                                     "nintendo_total_sessions", "xbox_total_sessions",
                                     "steam_total_records"])
    noct_sum = z("nintendo_nocturnal_sessions") + " + " + z("xbox_nocturnal_sessions")
    return f"""wide AS (
  SELECT *, {flags}, {tp} AS num_telemetry_platforms,
    CAST(({tp}) > 0 AS INTEGER) AS has_any_telemetry,
    {noct_sum} AS telem_nocturnal_sessions, {act} AS telem_total_sessions,
    {act} AS telem_activity_count
  FROM people {joins})"""


def integration_with(names: list[str] | None = None) -> str:
    """WITH clause holding the stand-ins, people, every block and ``wide``."""
    names = names or list(STANDIN_SQL)
    return ("WITH " + standin_ctes(names) + ",\n" + people_cte() + ",\n" + _bw_cte() + ",\n"
            + block_ctes() + ",\n" + wide_cte() + "\n")
