"""Column-catalogue and source/sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import catalogue as CT
from ..functions.parse import ITEM_NAME_RE
from ..operators import profile as PR
from ..operators.integrate import PRIORITY_COLUMNS
from ..session import ensure_checkpoint_dir
from ..sources import readers as RD
from ..sources import sinks as SK
from .oracle_integration import integration_with
from .q_integration import wide_table
from .registry import query
from .standins import table

W = integration_with()

# column names of the wide table, positioned like the Spark side (priority
# list first, then the rest by name)
COLS_SQL = W + """, wt AS (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM wide LIMIT 1),
cols AS (SELECT DISTINCT variable AS col FROM (FROM wt UNPIVOT INCLUDE NULLS (value FOR variable IN (COLUMNS(*))))),
pri AS (SELECT * FROM (VALUES """ + ", ".join(f"('{c}', {i})" for i, c in enumerate(PRIORITY_COLUMNS)) + """) p(col, ord)),
pos AS (SELECT c.col, p.ord AS pos FROM cols c JOIN pri p USING (col)
        UNION ALL
        SELECT col, 1000 + row_number() OVER (ORDER BY col) AS pos FROM cols WHERE col NOT IN (SELECT col FROM pri))"""


def _families_values() -> str:
    return ", ".join(f"({i}, '{label}', '{p}')" for i, (label, prefixes) in enumerate(CT.FAMILIES)
                     for p in prefixes)


@query("variable_families", COLS_SQL + f""", fam AS (SELECT * FROM (VALUES {_families_values()}) f(family_order, family, prefix))
SELECT DISTINCT fam.family_order, fam.family, pos.col AS "column"
FROM pos JOIN fam ON starts_with(pos.col, fam.prefix) OR pos.col = fam.prefix""")
def variable_families(spark, sf_dir):
    cat = CT.catalogue(spark, wide_table(spark, sf_dir, materialise=False).columns)
    return CT.family_members(cat).select("family_order", "family", "column")


def _questions_values() -> str:
    return ", ".join("('" + "', '".join(x.replace("'", "''") for x in q) + "')" for q in CT.QUESTIONS)


@query("question_lookup", COLS_SQL + f""", q AS (SELECT * FROM (VALUES {_questions_values()}) q(item, label, stem, measure))
SELECT pos.col AS "column", q.item, q.label, q.measure
FROM pos JOIN q ON q.item = regexp_replace(regexp_replace(pos.col, '^bw_', ''), '^intake_', '')""")
def question_lookup(spark, sf_dir):
    cat = CT.catalogue(spark, wide_table(spark, sf_dir, materialise=False).columns)
    return CT.question_info(cat).filter(F.col("label").isNotNull()).select("column", "item", "label", "measure")


@query("column_search", COLS_SQL + """ SELECT col AS "column" FROM pos WHERE contains(lower(col), 'night') OR contains(lower(col), 'nocturnal')""")
def column_search(spark, sf_dir):
    cat = CT.catalogue(spark, wide_table(spark, sf_dir, materialise=False).columns)
    return CT.search_columns(cat, "night").unionByName(CT.search_columns(cat, "NOCTURNAL")).select("column").distinct()


ITEM_SQL = COLS_SQL + f""",
m AS (SELECT col, pos, lower(regexp_extract(col, '{ITEM_NAME_RE}', 1)) AS prefix,
        CAST(regexp_extract(col, '(\\d+)', 1) AS BIGINT) AS num FROM pos),
g AS (SELECT prefix, string_agg(col, ',' ORDER BY num, pos) AS items, count(*) AS n_items FROM m
      WHERE prefix <> '' AND prefix NOT IN ({', '.join(repr(p) for p in PR.ITEM_SKIP_PREFIXES)})
      GROUP BY prefix HAVING count(*) >= 2)
SELECT upper(prefix) AS name, items, n_items,
  (SELECT col FROM pos WHERE col IN (prefix || '_total', 'bw_' || prefix || '_total', prefix || 'total')
   ORDER BY pos LIMIT 1) AS total_col
FROM g"""


@query("item_groups", ITEM_SQL)
def item_groups(spark, sf_dir):
    groups = PR.item_groups(wide_table(spark, sf_dir, materialise=False).columns)
    rows = [(g["name"], ",".join(g["items"]), len(g["items"]), g["total_col"]) for g in groups]
    return spark.createDataFrame(rows, "name string, items string, n_items long, total_col string")


@query("csv_roundtrip", """SELECT row_number() OVER (ORDER BY p_partkey) AS record_id,
  CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
  CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""")
def csv_roundtrip(spark, sf_dir):
    """S7 + S2: write a table with the CSV sink into the shared checkpoint
    folder, read it back as raw text and backfill record_id in file order."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    SK.write_csv(table(spark, sf_dir, "part"), folder)
    return RD.read_csv_with_record_id(spark, folder)
