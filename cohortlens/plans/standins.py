"""Stand-in raw inputs built from the driver's test tables.

The reference reads about a dozen all-string survey and telemetry tables keyed
by ``pid``. The test tables are a TPC-H-like star schema, so each raw source
is a plain SQL projection of a test table into the raw schema the job expects
(text cells, flags as 'TRUE'/'1', ISO start times). The projections are
written in the SQL subset shared by Spark SQL and DuckDB, so the Spark job
and the DuckDB oracle read exactly the same rows. They only re-shape rows;
all of the job's work (parsing, filtering, aggregation, joins) happens in the
library on the Spark side and in hand-written SQL on the oracle side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# Per-order item answers: line i's quantity / discount / tax (NULL when the
# order has no line i), as text.
_LINE_ITEMS = """SELECT l_orderkey,
    """ + ",\n    ".join(
    [f"CAST(max(CASE WHEN l_linenumber = {i} THEN l_quantity END) AS STRING) AS q_{i}" for i in range(1, 8)]
    + [f"CAST(max(CASE WHEN l_linenumber = {i} THEN round(l_discount * 100) END) AS STRING) AS d_{i}" for i in range(1, 7)]
    + [f"CAST(max(CASE WHEN l_linenumber = {i} THEN round(l_tax * 100) END) AS STRING) AS t_{i}" for i in range(1, 7)]
) + "\n  FROM lineitem GROUP BY l_orderkey"

_BANGS = ", ".join(
    [f"li.q_{i} AS bangs_{i}" for i in range(1, 7)]
    + [f"li.d_{i} AS bangs_{i + 6}" for i in range(1, 7)]
    + [f"li.t_{i} AS bangs_{i + 12}" for i in range(1, 7)])

STANDIN_SQL: dict[str, str] = {
    # Intake: one row per customer; market segment decides qualification.
    "intake": """SELECT CAST(c.c_custkey AS STRING) AS pid, c.c_custkey AS row_index,
    CASE c.c_mktsegment WHEN 'BUILDING' THEN 'FALSE' WHEN 'MACHINERY' THEN '1' ELSE 'TRUE' END AS qualified,
    CASE WHEN c.c_acctbal < 0 THEN 'NA' ELSE CAST(18 + CAST(floor(c.c_acctbal / 200) AS INT) AS STRING) END AS age,
    CASE c.c_nationkey % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE '' END AS gender,
    n.n_name AS country,
    c.c_mktsegment AS cohort,
    CASE WHEN c.c_custkey % 2 = 1 THEN 'TRUE' ELSE 'FALSE' END AS plays_xbox,
    CASE WHEN c.c_custkey % 3 = 0 THEN '1' ELSE '0' END AS plays_steam,
    CASE WHEN c.c_custkey % 5 = 0 THEN 'TRUE' ELSE '' END AS plays_nintendo,
    CASE WHEN c.c_custkey % 4 = 1 THEN 'true' ELSE 'FALSE' END AS plays_ios,
    CASE WHEN c.c_custkey % 7 = 2 THEN '1' ELSE 'NA' END AS plays_android,
    CASE WHEN c.c_acctbal > 5000 THEN 'TRUE' ELSE 'FALSE' END AS plays_playstation,
    CASE c.c_custkey % 8 WHEN 0 THEN 'never' WHEN 1 THEN ' Rarely' WHEN 2 THEN 'sometimes'
      WHEN 3 THEN 'OFTEN ' WHEN 4 THEN 'Very Often' WHEN 5 THEN 'always' WHEN 6 THEN 'NA' ELSE '3' END AS wemwbs_6,
    CAST(c.c_nationkey AS STRING) AS wemwbs_7,
    CASE c.c_custkey % 9 WHEN 0 THEN 'always' WHEN 1 THEN '2' WHEN 2 THEN 'NULL' WHEN 3 THEN 'Rarely' ELSE '4' END AS wemwbs_1,
    CAST(c.c_custkey % 6 AS STRING) AS wemwbs_2, CAST(c.c_custkey % 5 AS STRING) AS wemwbs_3,
    CASE WHEN c.c_custkey % 11 = 0 THEN '' ELSE CAST(c.c_nationkey % 5 AS STRING) END AS wemwbs_4,
    CASE WHEN c.c_acctbal < 1000 THEN 'never' ELSE 'often' END AS wemwbs_5,
    CASE c.c_custkey % 10 WHEN 0 THEN 'NA' ELSE CAST(c.c_custkey % 10 AS STRING) END AS life_sat,
    CAST(c.c_nationkey % 7 AS STRING) AS affective_valence,
    CASE WHEN c.c_custkey % 13 = 0 THEN 'NA' ELSE CAST(floor(c.c_acctbal / 250) AS STRING) END AS self_reported_weekly_play,
    CAST(150 + c.c_custkey % 50 AS STRING) AS height,
    CASE WHEN c.c_custkey % 17 = 0 THEN '' ELSE CAST(45 + c.c_nationkey * 3 AS STRING) END AS weight,
    CAST(c.c_custkey % 4 AS STRING) AS dependents,
    CASE c.c_custkey % 3 WHEN 0 THEN 'secondary' WHEN 1 THEN 'degree' ELSE '' END AS edu_level,
    CASE WHEN c.c_acctbal > 3000 THEN 'employed' ELSE 'student' END AS employment,
    CASE c.c_custkey % 4 WHEN 0 THEN 'married' WHEN 1 THEN 'single' ELSE '' END AS marital_status,
    n.n_name AS ethnicity,
    CASE WHEN c.c_custkey % 6 = 0 THEN '1' ELSE '0' END AS neuro_identify,
    CASE WHEN c.c_custkey % 12 = 0 THEN '1' WHEN c.c_custkey % 12 = 1 THEN 'NA' ELSE '0' END AS neuro_diagnosed,
    CASE WHEN c.c_custkey % 24 = 0 THEN '1' ELSE '0' END AS neuro_diag_asd,
    CASE WHEN c.c_custkey % 36 = 0 THEN '1' ELSE '0' END AS neuro_diag_adhd,
    CASE WHEN c.c_custkey % 48 = 0 THEN '1' ELSE '' END AS neuro_diag_dyslexia
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    # Biweekly waves: one row per order, wave = leading number of the priority,
    # items = the order's line values.
    "biweekly": f"""SELECT CAST(o.o_custkey AS STRING) AS pid, o.o_orderpriority AS wave,
    o.o_orderkey AS row_index,
    li.q_1 AS gdt_1, li.q_2 AS gdt_2, li.q_3 AS gdt_3, li.q_4 AS gdt_4,
    li.q_1 AS promis_1, li.q_2 AS promis_2, li.q_3 AS promis_3, li.q_4 AS promis_4,
    li.t_1 AS promis_5, li.t_2 AS promis_6, li.t_3 AS promis_7, li.t_4 AS promis_8,
    li.q_1 AS wemwbs_1, li.q_2 AS wemwbs_2, li.q_3 AS wemwbs_3, li.q_4 AS wemwbs_4,
    li.q_5 AS wemwbs_5, li.q_6 AS wemwbs_6, li.q_7 AS wemwbs_7,
    {_BANGS},
    CASE o.o_orderstatus WHEN 'F' THEN 'often' WHEN 'O' THEN 'never' ELSE 'NULL' END AS life_sat
  FROM orders o LEFT JOIN ({_LINE_ITEMS}) li ON o.o_orderkey = li.l_orderkey""",
    "daily": """SELECT CAST(o_custkey AS STRING) AS pid,
    CASE o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN '1' ELSE '0' END AS played24hr,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '1'
      WHEN o_orderpriority = '3-MEDIUM' THEN 'true' ELSE 'FALSE' END AS had_stress
  FROM orders""",
    "android": """SELECT CAST(user_id AS STRING) AS pid,
    CASE WHEN value < 5 THEN 'NA' ELSE CAST(value AS STRING) END AS total_gaming_minutes
  FROM events WHERE event_type = 'click'""",
    "ios": """SELECT CAST(user_id AS STRING) AS pid,
    CASE WHEN value < 5 THEN '' ELSE CAST(value AS STRING) END AS total_gaming_minutes
  FROM events WHERE event_type = 'view'""",
    "nintendo": """SELECT CAST(user_id AS STRING) AS pid,
    CASE WHEN event_type = 'error' THEN 'NA' ELSE CAST(value AS STRING) END AS duration,
    replace(CAST(ts AS STRING), ' ', 'T') AS session_start,
    CASE WHEN event_type = 'error' THEN NULL ELSE props END AS title_id
  FROM events WHERE event_type IN ('purchase', 'error')""",
    "xbox": """SELECT CAST(user_id AS STRING) AS pid, CAST(value AS STRING) AS duration,
    replace(CAST(ts AS STRING), ' ', 'T') AS session_start, props AS title_id
  FROM events WHERE event_type IN ('signup', 'view', 'click')""",
    "steam": """SELECT CAST(o_custkey AS STRING) AS pid,
    CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE CAST(round(o_totalprice / 1000) AS STRING) END AS playtime_2weeks,
    CAST(round(o_totalprice / 100) AS STRING) AS playtime_forever,
    o_orderpriority AS title_id
  FROM orders WHERE o_orderstatus <> 'F'""",
    "steam_owned": """SELECT CAST(o.o_custkey AS STRING) AS pid,
    CASE WHEN l.l_returnflag = 'R' THEN 'NA' ELSE CAST(l.l_quantity AS STRING) END AS playtime_forever
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "steam_link": """SELECT CAST(user_id AS STRING) AS pid FROM events WHERE event_type = 'signup'""",
    "cognitive": """SELECT CAST(user_id AS STRING) AS pid, CAST(value AS STRING) AS rt,
    CASE event_type WHEN 'purchase' THEN '1' WHEN 'error' THEN '0' ELSE '0.5' END AS accuracy,
    event_type AS task
  FROM events""",
    "timeuse": """SELECT CAST(o_custkey AS STRING) AS pid,
    CAST(CAST(o_orderdate AS DATE) AS STRING) AS date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Gaming' WHEN '2-HIGH' THEN 'video GAMES' ELSE 'work' END AS activity
  FROM orders""",
}


def register_tables(spark: SparkSession, sf_dir: str, tables: list[str] | None = None) -> None:
    """Register the parquet test tables as temp views (column pruning and
    filter pushdown still reach the scans)."""
    for t in tables or TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_sources(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The stand-in raw sources as Spark DataFrames."""
    register_tables(spark, sf_dir, ["customer", "nation", "orders", "lineitem", "events"])
    names = names or list(STANDIN_SQL)
    return {n: spark.sql(STANDIN_SQL[n]) for n in names}


def standin_ctes(names: list[str] | None = None) -> str:
    """The same stand-ins as SQL CTE text (for the oracle)."""
    names = names or list(STANDIN_SQL)
    return ",\n".join(f"src_{n} AS ({STANDIN_SQL[n]})" for n in names)
