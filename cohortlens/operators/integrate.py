"""Cohort integration: many per-person source tables -> one wide row per person.

Every block is ``groupBy(key).agg(...)`` (partial aggregation before the
shuffle, so a hot key is combined map-side) followed by a left join from the
cohort. Raw inputs are all-string tables, as read from CSV.

Rule for "present but empty" (the reference's semantics): a person with rows
but no valid number gets sum 0 / count 0 and mean/max NULL; a person without
rows gets NULL everywhere. Distinct counts include the empty string.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse as P
from ..sources.rowindex import with_row_index
from .common import broadcast_if_small

# --- fixed values (must equal the reference for equal results) -------------
PLATFORM_FLAGS = ["plays_xbox", "plays_steam", "plays_nintendo", "plays_ios",
                  "plays_android", "plays_playstation"]
INTAKE_TEXT = ["gender", "country", "cohort", "edu_level", "employment", "marital_status", "ethnicity"]
INTAKE_NUMERIC = (["age", "height", "weight", "self_reported_weekly_play"] + PLATFORM_FLAGS
                  + ["neuro_identify", "neuro_diagnosed", "neuro_diag_asd", "neuro_diag_adhd",
                     "neuro_diag_dyslexia", "dependents"])
INTAKE_RENAMED = {"life_sat": "intake_life_sat", "affective_valence": "intake_affective_valence",
                  **{f"wemwbs_{i}": f"intake_wemwbs_{i}" for i in range(1, 8)}}
SCALE_ITEMS = {"gdt_total": ("gdt", 4), "promis_total": ("promis", 8),
               "wemwbs_total": ("wemwbs", 7)}
THRESHOLD_SCALES = {"bangs_total": ("bangs", 18, 15)}
BIWEEKLY_COLUMNS = (
    [f"gdt_{i}" for i in range(1, 5)] + [f"promis_{i}" for i in range(1, 9)]
    + [f"wemwbs_{i}" for i in range(1, 8)] + [f"bangs_{i}" for i in range(1, 19)]
    + [f"bfi_2_xs_{i}" for i in range(1, 16)]
    + ["affective_valence", "life_sat", "self_reported_daily_play", "self_reported_weekly_play",
       "gaming_value_work", "gaming_value_social", "gaming_value_cognitive",
       "gaming_value_emotion", "gaming_value_routines", "positives", "problematic_play",
       "mctq_wd_sleep_latency_minutes", "mctq_fd_sleep_latency_minutes", "mctq_workdays_per_week",
       "eps_reading", "eps_tv", "eps_public", "eps_passenger", "eps_afternoon", "eps_talking",
       "eps_lunch", "eps_car", "psqi_overall_quality", "psqi_sleep_latency_min",
       "psqi_sleepdur_hours"]
    + [f"trojan_{i}" for i in range(1, 16)] + ["played_any_games", "survey_duration"])
TELEMETRY_FLAGS = ["has_android", "has_ios", "has_nintendo", "has_xbox", "has_steam"]
# Column order: this priority list first (those present), then the rest sorted.
PRIORITY_COLUMNS = (
    ["record_id", "pid", "age", "gender", "country", "cohort", "edu_level", "employment",
     "marital_status", "ethnicity", "height", "weight", "num_platforms",
     "self_reported_weekly_play"] + PLATFORM_FLAGS
    + ["neuro_identify", "neuro_diagnosed", "neuro_diag_asd", "neuro_diag_adhd",
       "neuro_diag_dyslexia", "dependents", "intake_life_sat", "intake_affective_valence"]
    + [f"intake_wemwbs_{i}" for i in range(1, 8)]
    + ["gdt_total", "promis_total", "wemwbs_total", "bangs_total", "telem_nocturnal_sessions",
       "telem_activity_count", "telem_total_sessions", "steam_playtime_2weeks_min"]
    + [f"bw_gdt_{i}" for i in range(1, 5)] + [f"bw_promis_{i}" for i in range(1, 9)]
    + [f"bw_wemwbs_{i}" for i in range(1, 8)])
# Source file of each block (used by the data dictionary and the report).
SOURCE_FILES = {
    "intake": "survey_intake_raw.csv.gz",
    "biweekly": "survey_biweekly_raw.csv.gz",
    "daily": "survey_daily_raw.csv.gz",
    "android": "telemetry_android_raw.csv.gz",
    "ios": "telemetry_ios_raw.csv.gz",
    "nintendo": "telemetry_nintendo_raw.csv.gz",
    "xbox": "telemetry_xbox_raw.csv.gz",
    "steam": "telemetry_steam_raw.csv.gz",
    "steam_owned": "telemetry_steam_owned_games_raw.csv.gz",
    "steam_link": "telemetry_steam_account_linking_raw.csv.gz",
    "cognitive": "cognitive_tasks_raw.csv.gz",
    "timeuse": "timeuse_raw.csv.gz",
}
# Rules of lineage, in order: totals of the biweekly survey; prefix -> block; prefixes of
# aggregated columns; texts of the data dictionary.
BIWEEKLY_TOTALS = ["gdt_total", "promis_total", "wemwbs_total", "bangs_total"]
LINEAGE_PREFIXES = {"daily_": "daily", "android_": "android", "ios_": "ios", "nintendo_": "nintendo",
                    "xbox_": "xbox", "steam_": "steam", "telem_": "derived_telemetry",
                    "cog_": "cognitive", "timeuse_": "timeuse"}
DICTIONARY_TEXT, DICTIONARY_TYPE = "Variable: ", "mixed"
# ---------------------------------------------------------------------------


def _dsum(x: Column) -> Column:
    """Sum that is 0 (not NULL) for a present group without valid values."""
    return F.coalesce(F.sum(x), F.lit(0.0))


def _distinct_text(c: str) -> Column:
    """Distinct count including the empty string for NULL (reference ``?? ""``)."""
    return F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("")))


# --- F1 / J1 ---------------------------------------------------------------

def cohort_filter(intake: DataFrame, key: str = "pid", qualified: str = "qualified") -> DataFrame:
    """qualified in {'TRUE','1'} and a non-empty key."""
    k = F.col(key)
    return intake.filter(P.flag_true(qualified) & k.isNotNull() & (k.cast("string") != ""))


def restrict_to_cohort(df: DataFrame, cohort_keys: DataFrame, key: str = "pid",
                       broadcastable: bool | None = None) -> DataFrame:
    """Keep source rows whose key is in the cohort (left semi join).

    With a small (checked) key set the semi join is a map-side broadcast
    filter before any shuffle; with a larger one the same join is shuffled.
    """
    keys = cohort_keys.select(key).distinct()
    if broadcastable is None:
        keys, broadcastable = broadcast_if_small(keys)
    return df.join(F.broadcast(keys) if broadcastable else keys, on=key, how="left_semi")


# --- A1 .. A13: per-source feature blocks ------------------------------------

def _texts(names: list[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in names]).cast("array<string>")


def _packed_intake(intake: DataFrame, key: str, row_index: str | None, record_id: str | None) -> tuple[DataFrame, list[Column]]:
    """The rows of ``intake_rows`` with their cells in two arrays (pid, _cells,
    _words, num_platforms, record_id), and the columns that unpack them.

    Cells go to their person as they are; only those of the last row are parsed,
    after the shuffle (a raw table of few megabytes is one task) and by a single
    ``transform``: a parser for each of 30 columns makes one method that is too
    large to be compiled, four times as slow. Through joins go arrays."""
    df = cohort_filter(intake, key)
    if row_index is None:
        df = with_row_index(df, "_row")
        row_index = "_row"
    cols = set(df.columns)
    named = [(c, c) for c in INTAKE_NUMERIC] + list(INTAKE_RENAMED.items())
    numbers = [(src, dst) for src, dst in named if src in cols]
    words = [c for c in INTAKE_TEXT if c in cols]
    plats = [P.flag_true(p).cast("int") for p in PLATFORM_FLAGS if p in cols]
    row = [_texts([src for src, _ in numbers]).alias("_cells"), _texts(words).alias("_words"),
           (reduce(lambda a, b: a + b, plats) if plats else F.lit(0)).alias("num_platforms")]
    if record_id is not None:
        row.append(F.col(record_id).cast("long").alias("record_id"))
    rec = df.select(F.col(key).cast("string").alias("pid"), F.struct(*row).alias("_last"), F.col(row_index).alias("_row"))
    out = rec.groupBy("pid").agg(F.max_by("_last", F.col("_row")).alias("_last"), F.min("_row").alias("_first"))
    out = out.select("pid", "_last.*", "_first")
    if record_id is None:
        out = with_row_index(out, "record_id", order_by=["_first"])
    out = out.select("pid", F.transform("_cells", P.survey_value).alias("_cells"), "_words", "num_platforms", "record_id")
    cell = {dst: F.col("_cells")[i].alias(dst) for i, (_, dst) in enumerate(numbers)}
    word = [F.nullif(F.col("_words")[i], F.lit("")).alias(c) for i, c in enumerate(words)]
    own = set(INTAKE_NUMERIC)
    return out, [*(x for c, x in cell.items() if c in own), *word, *(x for c, x in cell.items() if c not in own), F.col("num_platforms"), F.col("record_id")]


def intake_rows(intake: DataFrame, key: str = "pid", row_index: str | None = None,
                record_id: str | None = None) -> DataFrame:
    """Intake -> one row per qualified person (F1 + A1).

    Duplicate key: the last row (by ``row_index``) wins; ``record_id`` is the
    dense rank of each person's first appearance (deviation: the reference
    leaves gaps). If ``record_id`` names an input column it is used as is.
    """
    rows, columns = _packed_intake(intake, key, row_index, record_id)
    return rows.select("pid", *columns)


def first_wave(df: DataFrame, key: str = "pid", wave: str = "wave",
               row_index: str = "row_index") -> DataFrame:
    """A2 + A3: the row with the lowest wave number per key (ties -> first row
    seen) and the number of rows (not distinct waves)."""
    others = [c for c in df.columns if c != key]
    order = F.struct(P.wave_number(wave).alias("w"), F.col(row_index).alias("r"))
    return df.groupBy(key).agg(
        F.min_by(F.struct(*others), order).alias("first"),
        F.count(F.lit(1)).alias("num_waves")).select(key, "first.*", "num_waves")


def scale_total(items: list[Column]) -> Column:
    """A4: all-or-nothing sum (NULL if any item is NULL)."""
    return reduce(lambda a, b: a + b, items)


def threshold_total(items: list[Column], min_answered: int) -> Column:
    """A5: sum of answered items when at least ``min_answered`` are answered
    (no proration), else NULL."""
    answered = reduce(lambda a, b: a + b, [x.isNotNull().cast("int") for x in items])
    total = reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0.0)) for x in items])
    return F.when(answered >= min_answered, total)


def _array_total(arr: Column) -> Column:
    """A4 on an item array: left-to-right sum, NULL as soon as one is NULL."""
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def _array_threshold(arr: Column, min_answered: int) -> Column:
    """A5 on an item array."""
    answered = F.size(F.filter(arr, lambda x: x.isNotNull()))
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))
    return F.when(answered >= min_answered, total)


def _packed_biweekly(bw: DataFrame, key: str, wave: str, row_index: str, columns: list[str] | None) -> tuple[DataFrame, list[Column]]:
    """The rows of ``biweekly_features`` with their items in one array (key,
    _items, bw_num_waves), and the columns that unpack it.

    Items that the table has travel as one text array through the first-wave
    aggregate and are parsed once by a single ``transform`` (one compact
    expression instead of one inlined parser per item, which keeps the
    generated code small); the others are NULL without being carried or parsed."""
    columns = BIWEEKLY_COLUMNS if columns is None else columns
    present = [c for c in columns if c in bw.columns]
    fw = first_wave(bw.select(key, wave, row_index, _texts(present).alias("_items")), key, wave, row_index)
    parsed = fw.select(key, F.transform("_items", P.survey_value).alias("_items"),
                       F.col("num_waves").cast("long").alias("bw_num_waves"))
    pos = {c: i for i, c in enumerate(present)}

    def item(c: str) -> Column:
        return F.col("_items")[pos[c]] if c in pos else F.lit(None).cast("double")

    def item_array(prefix: str, n: int) -> Column:
        # by positions: a total that repeats the expressions of n item columns gives Spark's
        # constraint propagation 2^n forms of it (of 18 items more than a driver's memory)
        at = F.array(*[F.lit(pos.get(f"{prefix}_{i}")).cast("int") for i in range(1, n + 1)])
        return F.transform(at, lambda i: F.get("_items", i))

    out = [item(c).alias(f"bw_{c}") for c in columns]
    out.append(F.col("bw_num_waves"))
    out += [_array_total(item_array(p, n)).alias(name) for name, (p, n) in SCALE_ITEMS.items()]
    out += [_array_threshold(item_array(p, n), k).alias(name)
            for name, (p, n, k) in THRESHOLD_SCALES.items()]
    return parsed, out


def biweekly_features(bw: DataFrame, key: str = "pid", wave: str = "wave",
                      row_index: str = "row_index", columns: list[str] | None = None) -> DataFrame:
    """First wave per person, items parsed with X3 and prefixed ``bw_``, wave
    count and the four scale totals."""
    rows, out = _packed_biweekly(bw, key, wave, row_index, columns)
    return rows.select(key, *out)


def daily_features(df: DataFrame, key: str = "pid", played: str = "played24hr",
                   stress: str = "had_stress") -> DataFrame:
    """Responses, played days, stress days."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("daily_num_responses"),
        F.count_if(P.flag_true(played)).alias("daily_played_days"),
        F.count_if(P.flag_true(stress)).alias("daily_stress_days"))


def minutes_features(df: DataFrame, prefix: str, key: str = "pid",
                     minutes: str = "total_gaming_minutes") -> DataFrame:
    """Mobile telemetry total, mean and days with a valid value."""
    m = P.survey_value(minutes)
    return df.groupBy(key).agg(
        _dsum(m).alias(f"{prefix}_total_minutes"),
        F.avg(m).alias(f"{prefix}_mean_daily_minutes"),
        F.count(m).alias(f"{prefix}_days_with_data"))


def session_features(df: DataFrame, prefix: str, key: str = "pid", duration: str = "duration",
                     start: str = "session_start", title: str = "title_id") -> DataFrame:
    """Console sessions. Sessions = valid durations; nocturnal counts rows
    whose start hour passes X9 even when the duration is invalid."""
    d = P.survey_value(duration)
    return df.groupBy(key).agg(
        F.count(d).alias(f"{prefix}_total_sessions"),
        _dsum(d).alias(f"{prefix}_total_duration_min"),
        F.avg(d).alias(f"{prefix}_mean_session_min"),
        F.max(d).alias(f"{prefix}_max_session_min"),
        _distinct_text(title).alias(f"{prefix}_unique_games"),
        F.count_if(P.is_nocturnal(start)).alias(f"{prefix}_nocturnal_sessions"))


def nocturnal_counts(df: DataFrame, key: str = "pid", start: str = "session_start") -> DataFrame:
    """X9 per key: rows, rows with a readable hour, nocturnal rows."""
    h = P.iso_hour(start)
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(h).alias("rows_with_hour"),
        F.count_if(P.is_nocturnal_hour(h)).alias("nocturnal_sessions"))


def playtime_features(df: DataFrame, key: str = "pid", recent: str = "playtime_2weeks",
                      lifetime: str = "playtime_forever", title: str = "title_id") -> DataFrame:
    """Steam min/max recent playtime, max lifetime, distinct games, rows."""
    r, f = P.survey_value(recent), P.survey_value(lifetime)
    return df.groupBy(key).agg(
        F.min(r).alias("steam_playtime_2weeks_min"),
        F.max(r).alias("steam_playtime_2weeks_max"),
        F.max(f).alias("steam_playtime_forever_max"),
        _distinct_text(title).alias("steam_unique_games"),
        F.count(F.lit(1)).alias("steam_total_records"))


def owned_features(df: DataFrame, key: str = "pid", lifetime: str = "playtime_forever") -> DataFrame:
    """A10: owned games rows and total playtime (0 when none valid)."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("steam_owned_games_count"),
        _dsum(P.survey_value(lifetime)).alias("steam_owned_total_playtime"))


def link_features(df: DataFrame, key: str = "pid") -> DataFrame:
    """Linked flag and number of linking events."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("steam_link_events")).select(
        key, F.lit(1).alias("steam_linked"), "steam_link_events")


def cognitive_features(df: DataFrame, key: str = "pid", rt: str = "rt",
                       accuracy: str = "accuracy", task: str = "task") -> DataFrame:
    """Mean RT, mean accuracy, distinct tasks, trials = valid RTs."""
    r = P.survey_value(rt)
    return df.groupBy(key).agg(
        F.avg(r).alias("cog_mean_rt"),
        F.avg(P.survey_value(accuracy)).alias("cog_mean_accuracy"),
        _distinct_text(task).alias("cog_num_tasks"),
        F.count(r).alias("cog_num_trials"))


def timeuse_features(df: DataFrame, key: str = "pid", date: str = "date",
                     activity: str = "activity") -> DataFrame:
    """Entries, distinct days, gaming entries."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("timeuse_num_entries"),
        _distinct_text(date).alias("timeuse_num_days"),
        F.count_if(P.is_gaming(activity)).alias("timeuse_gaming_entries"))


# --- A14, A15: flags and derived totals ---------------------------------------

def availability_flags(wide: DataFrame) -> DataFrame:
    """``has_*`` flags, telemetry platform count, any-telemetry flag.
    ``has_biweekly`` tests the first item, not row presence (reference rule)."""
    cols = set(wide.columns)
    tests = {
        "has_biweekly": "bw_gdt_1", "has_daily": "daily_num_responses",
        "has_android": "android_total_minutes", "has_ios": "ios_total_minutes",
        "has_nintendo": "nintendo_total_sessions", "has_xbox": "xbox_total_sessions",
        "has_steam": "steam_total_records", "has_cognitive": "cog_num_trials",
        "has_timeuse": "timeuse_num_entries",
    }
    flags = {name: (F.col(c).isNotNull().cast("int") if c in cols else F.lit(0))
             for name, c in tests.items()}
    tp = reduce(lambda a, b: a + b, [flags[f] for f in TELEMETRY_FLAGS])
    return wide.select("*", *[v.alias(k) for k, v in flags.items()],
                       tp.alias("num_telemetry_platforms"),
                       (tp > 0).cast("int").alias("has_any_telemetry"))


def derived_telemetry(wide: DataFrame) -> DataFrame:
    """nocturnal = Nintendo + Xbox; activity = Android days + iOS days +
    Nintendo + Xbox sessions + Steam records (NULL as 0)."""
    cols = set(wide.columns)

    def z(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in cols else F.lit(0.0)

    noct = z("nintendo_nocturnal_sessions") + z("xbox_nocturnal_sessions")
    act = (z("android_days_with_data") + z("ios_days_with_data") + z("nintendo_total_sessions")
           + z("xbox_total_sessions") + z("steam_total_records"))
    return wide.select("*", noct.alias("telem_nocturnal_sessions"),
                       act.alias("telem_total_sessions"), act.alias("telem_activity_count"))


def order_columns(columns: list[str]) -> list[str]:
    """F8: priority list (present ones) then the rest sorted by code unit."""
    present = set(columns)
    first = [c for c in PRIORITY_COLUMNS if c in present]
    rest = sorted(c for c in columns if c not in set(PRIORITY_COLUMNS))
    return first + rest


# --- consolidation --------------------------------------------------------------

BLOCKS = {
    "daily": lambda df: daily_features(df),
    "android": lambda df: minutes_features(df, "android"),
    "ios": lambda df: minutes_features(df, "ios"),
    "nintendo": lambda df: session_features(df, "nintendo"),
    "xbox": lambda df: session_features(df, "xbox"),
    "steam": lambda df: playtime_features(df),
    "steam_owned": lambda df: owned_features(df),
    "steam_link": lambda df: link_features(df),
    "cognitive": lambda df: cognitive_features(df),
    "timeuse": lambda df: timeuse_features(df),
}


def integrate(sources: dict[str, DataFrame], key: str = "pid", intake_row_index: str | None = None,
              intake_record_id: str | None = None, biweekly_row_index: str = "row_index",
              biweekly_columns: list[str] | None = None) -> DataFrame:
    """J1 + J2 + A1-A15: the wide cohort table (one row per qualified person).

    ``sources`` maps block names (keys of ``SOURCE_FILES``) to raw tables with
    a ``pid`` column. Absent sources leave their columns absent.
    """
    base, columns = _packed_intake(sources["intake"], key, intake_row_index, intake_record_id)
    keys, small = broadcast_if_small(base.select("pid"))
    wide = base
    aggs = []
    for name, fn in BLOCKS.items():
        if name in sources:
            src = restrict_to_cohort(sources[name].withColumnRenamed(key, "pid"), keys, "pid", small)
            agg = fn(src)
            aggs.append(agg)
            columns += [F.col(c) for c in agg.columns if c != "pid"]
    if "biweekly" in sources:
        bw = restrict_to_cohort(sources["biweekly"].withColumnRenamed(key, "pid"), keys, "pid", small)
        agg, unpacked = _packed_biweekly(bw, "pid", "wave", biweekly_row_index, biweekly_columns)
        aggs.append(agg)
        columns += unpacked
    for a in aggs:  # arrays of intake cells and items are unpacked after the last join
        wide = wide.join(a, on="pid", how="left")
    wide = wide.select("pid", *columns)
    wide = derived_telemetry(availability_flags(wide))
    return wide.select(*order_columns(wide.columns))


# --- X15, A16, S10 ----------------------------------------------------------------

def lineage_source(c) -> Column:
    """Source file by column-name prefix (rules in order)."""
    c = F.col(c) if isinstance(c, str) else c
    rules = [(c.startswith("bw_") | c.isin(*BIWEEKLY_TOTALS), SOURCE_FILES["biweekly"])]
    rules += [(c.startswith(p), SOURCE_FILES.get(b, b)) for p, b in LINEAGE_PREFIXES.items()]
    expr = F.lit(SOURCE_FILES["intake"])
    for cond, val in reversed(rules):
        expr = F.when(cond, F.lit(val)).otherwise(expr)
    return expr


def lineage_aggregation(c) -> Column:
    """Aggregation kind by prefix/suffix (rules in order)."""
    c = F.col(c) if isinstance(c, str) else c
    aggregated = reduce(lambda a, b: a | b, [c.startswith(p) for p in LINEAGE_PREFIXES])
    return (F.when(c.startswith("bw_"), "first_wave").when(c.endswith("_total"), "sum")
            .when(aggregated, "aggregated").otherwise("direct"))


def data_dictionary(wide: DataFrame) -> DataFrame:
    """One row per column: position, source, original name, aggregation
    kind and missing count (one aggregation pass over all columns)."""
    cols = wide.columns
    from .filters import missing as missing_of
    missing = wide.agg(*[F.count_if(missing_of(wide, c)).alias(c) for c in cols])
    long = missing.unpivot([], cols, "variable", "missing_values")
    pos = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i + 1))])
    v = F.col("variable")
    return long.select(
        F.element_at(pos, v).alias("position"), "variable",
        lineage_source(v).alias("source_file"),
        F.when(v.startswith("bw_"), F.substring(v, 4, 1 << 20)).otherwise(v).alias("original_column"),
        v.alias("generated_column"),
        lineage_aggregation(v).alias("aggregation"),
        F.concat(F.lit(DICTIONARY_TEXT), v).alias("description"),
        F.lit(DICTIONARY_TYPE).alias("data_type"),
        F.col("missing_values").cast("long").alias("missing_values"))


def source_inventory(sources: dict[str, DataFrame], wide: DataFrame | None = None) -> DataFrame:
    """Rows per source and whether the source was used (one count job
    per source; counts are combined in Spark, not hard-coded)."""
    parts = []
    for name, df in sources.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(SOURCE_FILES.get(name, name)).alias("file"), F.lit(name).alias("block"),
            F.lit(name in BLOCKS or name in ("intake", "biweekly")).alias("used"), "rows"))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    if wide is not None:
        totals = wide.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit("participants").alias("file"), F.lit("result").alias("block"),
            F.lit(True).alias("used"), "rows")
        out = out.unionByName(totals)
    return out


def round_output(df: DataFrame, cols: list[str] | None = None, digits: int = 3) -> DataFrame:
    """Optional rounding of aggregate outputs (the reference's offline
    telemetry aggregates keep 3 decimals; the interactive path keeps all)."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    keep = set(cols)
    return df.select(*[F.round(c, digits).alias(c) if c in keep else F.col(c) for c in df.columns])
