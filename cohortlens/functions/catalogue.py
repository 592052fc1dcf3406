"""Column catalogue operators (X16, X17, X19, F12, F13, P12 as a table).

The catalogue is a DataFrame with one row per column name (metadata only,
small). Family and question metadata are tiny fixed tables joined with an
explicit broadcast (their size is fixed, not data-dependent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values (must equal the reference for equal results) -------------
# Prefixes of the variable families, in order; a column belongs to a family when it
# equals or starts with one of its prefixes (a column may match several).
FAMILY_PREFIXES = [
    ["age", "gender", "country", "cohort", "edu_level", "employment", "marital_status", "ethnicity", "height", "weight", "dependents", "num_platforms"],
    ["neuro_"],
    ["bw_gdt", "gdt_"],
    ["bw_promis", "promis_"],
    ["bw_wemwbs", "wemwbs_", "intake_wemwbs"],
    ["bw_bangs", "bangs_"],
    ["bw_bfi"],
    ["bw_trojan"],
    ["bw_mctq", "bw_eps", "bw_psqi"],
    ["bw_gaming_value", "bw_positives", "bw_problematic"],
    ["telem_"],
    ["steam_"],
    ["xbox_"],
    ["nintendo_"],
    ["android_"],
    ["ios_"],
    ["cog_"],
    ["timeuse_"],
    ["daily_"],
    ["has_", "num_telemetry"],
]
# Question texts by item (looked up after stripping a 'bw_' then an 'intake_'
# prefix): item, label, stem, measure.
_GDT_STEM = "Please indicate how often the following issues occurred over the past 3 months."
_PROMIS_STEM = "In the past 7 days..."
_WEMWBS_STEM = "Feelings and thoughts over the last 2 weeks."
QUESTIONS = [
    ("gdt_1", "Difficulties controlling gaming activity", _GDT_STEM, "Gaming Disorder Test"),
    ("gdt_2", "Increasing priority to gaming over other life interests", _GDT_STEM, "Gaming Disorder Test"),
    ("gdt_3", "Continued gaming despite negative consequences", _GDT_STEM, "Gaming Disorder Test"),
    ("gdt_4", "Significant life problems due to gaming behavior", _GDT_STEM, "Gaming Disorder Test"),
    ("promis_1", "I felt worthless", _PROMIS_STEM, "PROMIS Depression"),
    ("promis_2", "I had nothing to look forward to", _PROMIS_STEM, "PROMIS Depression"),
    ("promis_3", "I felt helpless", _PROMIS_STEM, "PROMIS Depression"),
    ("promis_4", "I felt sad", _PROMIS_STEM, "PROMIS Depression"),
    ("promis_5", "I felt like a failure", _PROMIS_STEM, "PROMIS Depression"),
    ("promis_6", "I felt depressed", _PROMIS_STEM, "PROMIS Depression"),
    ("promis_7", "I felt unhappy", _PROMIS_STEM, "PROMIS Depression"),
    ("promis_8", "I felt hopeless", _PROMIS_STEM, "PROMIS Depression"),
    ("wemwbs_1", "Feeling optimistic about the future", _WEMWBS_STEM, "WEMWBS"),
    ("wemwbs_2", "Feeling relaxed", _WEMWBS_STEM, "WEMWBS"),
    ("wemwbs_3", "Thinking clearly", _WEMWBS_STEM, "WEMWBS"),
    ("wemwbs_4", "Feeling close to other people", _WEMWBS_STEM, "WEMWBS"),
    ("wemwbs_5", "Able to make up my own mind", _WEMWBS_STEM, "WEMWBS"),
    ("wemwbs_6", "Feeling useful", _WEMWBS_STEM, "WEMWBS"),
    ("wemwbs_7", "Dealing with problems well", _WEMWBS_STEM, "WEMWBS"),
]
# ---------------------------------------------------------------------------
#: Our own names of the families, in the order of their prefixes.
FAMILY_NAMES = [
    "demographics", "neurodiversity", "gaming disorder items", "depression items", "wellbeing items",
    "need satisfaction items", "personality items", "trojan items", "sleep", "gaming motives",
    "derived telemetry", "steam", "xbox", "nintendo", "android", "ios", "cognitive tasks", "time use",
    "daily survey", "availability flags",
]
FAMILIES = list(zip(FAMILY_NAMES, FAMILY_PREFIXES))


def catalogue(spark: SparkSession, columns: list[str]) -> DataFrame:
    """(position, column) for a column list (schema metadata)."""
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(columns)], "position int, column string")


def families_table(spark: SparkSession) -> DataFrame:
    rows = [(i, label, p) for i, (label, prefixes) in enumerate(FAMILIES) for p in prefixes]
    return spark.createDataFrame(rows, "family_order int, family string, prefix string")


def family_members(cat: DataFrame) -> DataFrame:
    """(family, column) for every family a column equals or starts with."""
    fam = F.broadcast(families_table(cat.sparkSession))  # fixed 40-row table
    j = cat.join(fam, cat["column"].startswith(fam["prefix"]) | (cat["column"] == fam["prefix"]))
    return j.groupBy("family_order", "family", "position", "column").agg(F.count(F.lit(1)).alias("_n")).drop("_n")


def question_info(cat: DataFrame) -> DataFrame:
    """Question label/stem/measure after stripping 'bw_' then 'intake_'."""
    spark = cat.sparkSession
    q = F.broadcast(spark.createDataFrame(QUESTIONS, "item string, label string, stem string, measure string"))
    item = F.regexp_replace(F.regexp_replace("column", "^bw_", ""), "^intake_", "")
    return cat.withColumn("item", item).join(q, "item", "left")


def search_columns(cat: DataFrame, text: str) -> DataFrame:
    """Columns whose name contains ``text`` (case-insensitive)."""
    return cat.filter(F.lower("column").contains(text.lower()))


def effective_vector(selected: list[str], types: dict[str, str], available: list[str],
                     recommended: list[str], mode: str = "selected") -> list[str]:
    """selected numeric columns when at least 2 are selected in
    'selected' mode, else the recommended list (its order) restricted to
    present numeric columns."""
    picked = [c for c in selected if types.get(c) == "numeric"]
    if mode == "selected" and len(picked) >= 2:
        return picked
    have = set(available)
    return [c for c in recommended if c in have and types.get(c) == "numeric"]


def add_group(vector: list[str], items: list[str], total_col: str | None = None) -> list[str]:
    """append a survey group's items (and total) without duplicates."""
    out = list(vector)
    for c in items + ([total_col] if total_col else []):
        if c not in out:
            out.append(c)
    return out
