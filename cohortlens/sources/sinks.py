"""Sinks (S7, S8): CSV with the reference's quoting, parquet tables and a
JSON manifest row. All writes are distributed (one file per task)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite") -> None:
    """Header CSV; NULL and '' written as empty; a field is quoted only
    when it holds a comma, a quote or a line break; quotes are doubled."""
    out = df.select(*(columns or df.columns))
    (out.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("nullValue", "").option("emptyValue", "").option("quoteAll", False).csv(path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S8 for tables (labels, long profile, clusters)."""
    df.write.mode(mode).parquet(path)


def write_manifest(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S8 for the one-row run manifest / integration report."""
    df.coalesce(1).write.mode(mode).json(path)
