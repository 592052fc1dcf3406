"""Filters and projections (F1-F13): one Column predicate per filter set,
semi joins for id selections, point lookups without collecting tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse as P
from .common import broadcast_if_small


@dataclass
class ColumnFilter:
    """Range (inclusive) and/or category filter on one column.

    ``include_missing``: None or True lets missing and non-numeric rows pass
    a range filter; False drops them (reference semantics).
    """
    min: float | None = None
    max: float | None = None
    values: list[str] | None = None
    include_missing: bool | None = None


def numeric(df: DataFrame, c: str) -> Column:
    """Numeric view of a column: typed numbers pass through (non-finite ->
    NULL), text goes through the strict parser (X1)."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return P.finite(F.col(c))
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.col(c).cast("double")
    if isinstance(dt, T.BooleanType):
        return F.lit(None).cast("double")
    return P.strict_numeric(c)


def missing(df: DataFrame, c: str) -> Column:
    """X5 for a typed column: only text can hold the empty string, so other
    types test NULL alone (no cast per cell)."""
    if isinstance(df.schema[c].dataType, T.StringType):
        return P.is_missing(c)
    return F.col(c).isNull()


def text_form(df: DataFrame, c: str) -> Column:
    """Text of a cell as the reference prints it: integral doubles without
    '.0'; NULL stays NULL."""
    dt = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        whole = (col == F.floor(col)) & (F.abs(col) < F.lit(1e15))
        return F.when(whole, col.cast("long").cast("string")).otherwise(col.cast("string"))
    return col.cast("string")


def filter_predicate(df: DataFrame, filters: dict[str, ColumnFilter]) -> Column:
    """F2 + F3 + F5: conjunction of all column filters as one predicate."""
    preds = []
    for c, f in filters.items():
        has_range = f.min is not None or f.max is not None
        x = numeric(df, c)
        unreadable = missing(df, c) | x.isNull()
        pred = F.lit(True)
        if has_range:
            inside = F.lit(True)
            if f.min is not None:
                inside = inside & (x >= F.lit(float(f.min)))
            if f.max is not None:
                inside = inside & (x <= F.lit(float(f.max)))
            pred = F.when(unreadable, F.lit(f.include_missing is not False)).otherwise(inside)
        if f.values:
            in_set = F.coalesce(text_form(df, c), F.lit("")).isin(*[str(v) for v in f.values])
            # A missing value that passed the range test skips the category test.
            pred = pred & ((unreadable & F.lit(has_range)) | in_set)
        preds.append(pred)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def filter_rows(df: DataFrame, filters: dict[str, ColumnFilter] | None = None,
                selected: DataFrame | None = None, id_col: str = "record_id") -> DataFrame:
    """F4 + F5: column filters AND (no selection or id in the selection).

    ``selected`` is a DataFrame with one column of ids (any type, compared as
    text). It is joined as a left semi join, broadcast only if small.
    """
    out = df.filter(filter_predicate(df, filters or {}))
    if selected is not None:
        ids = selected.select(F.col(selected.columns[0]).cast("string").alias("_sel_id")).distinct()
        ids, _ = broadcast_if_small(ids)
        out = out.join(ids, out[id_col].cast("string") == ids["_sel_id"], "left_semi")
    return out


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    """rows where every listed column is a finite number."""
    cond = reduce(lambda a, b: a & b, [numeric(df, c).isNotNull() for c in cols])
    return df.filter(cond)


def numeric_features(df: DataFrame, candidates: list[str]) -> list[str]:
    """candidates that are numeric and hold at least one finite value
    (one aggregation pass; only p counts reach the driver)."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        return []
    counts = df.agg(*[F.count(numeric(df, c)).alias(c) for c in present]).first()
    return [c for c in present if counts[c] > 0]


def preview_page(df: DataFrame, page: int = 0, size: int = 10, order: str = "record_id",
                 max_cols: int = 20) -> DataFrame:
    """one page of rows (first ``max_cols`` columns) in ``order``."""
    cols = df.columns[:max_cols]
    if order not in cols:
        cols = [order] + cols[:max_cols - 1]
    return df.select(*cols).orderBy(order).offset(page * size).limit(size)


def keyword_rows(df: DataFrame, needle: str, cols: list[str] | None = None) -> DataFrame:
    """Rows where any cell contains ``needle`` (case-insensitive)."""
    return df.filter(P.row_contains(cols or df.columns, needle))


def participant_detail(df: DataFrame, record_id, sections: dict[str, list[str]],
                       id_col: str = "record_id") -> DataFrame:
    """one person's non-missing fields, one row per (section, field)."""
    row = df.filter(F.col(id_col) == F.lit(record_id))
    parts = []
    for order, (name, cols) in enumerate(sections.items()):
        cols = [c for c in cols if c in df.columns]
        if not cols:
            continue
        long = row.select(*[text_form(df, c).alias(c) for c in cols]).unpivot(
            [], cols, "field", "value")
        parts.append(long.select(F.lit(order).alias("section_order"), F.lit(name).alias("section"),
                                 "field", "value"))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.filter(F.col("value").isNotNull() & (F.col("value") != ""))
