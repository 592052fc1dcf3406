"""Registry of named queries (Spark side) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an
    optional oracle SQL string."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Round the named (default: all double) columns for stable comparison."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    cs = set(cols)
    return df.select(*[round_half_up(F.col(c), digits).alias(c) if c in cs else F.col(c)
                       for c in df.columns])


SIG_DIGITS = 9


def sig(c, digits: int = SIG_DIGITS):
    """Round to ``digits`` significant digits with the same IEEE operations as
    the oracle's ``sql_sig`` (0 and NULL pass through)."""
    c = F.col(c) if isinstance(c, str) else c
    scale = F.pow(F.lit(10.0), F.lit(float(digits - 1)) - F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.floor(c * scale + F.lit(0.5)).cast("double") / scale)


def sigd(df: DataFrame, cols: list[str] | None = None, digits: int = SIG_DIGITS) -> DataFrame:
    """Round the named (default: all double) columns to significant digits."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    cs = set(cols)
    return df.select(*[sig(F.col(c), digits).alias(c) if c in cs else F.col(c) for c in df.columns])


def sql_sig_expr(c: str, digits: int = SIG_DIGITS) -> str:
    scale = f"pow(10.0, {float(digits - 1)!r} - floor(log10(abs({c}))))"
    return f"(CASE WHEN {c} = 0 THEN 0.0 ELSE floor({c} * {scale} + 0.5) / {scale} END)"


def sql_sig(inner: str, cols: list[str], digits: int = SIG_DIGITS) -> str:
    """DuckDB: significant-digit rounding of the named columns of ``inner``."""
    if not cols:
        return inner
    rep = ", ".join(f"{sql_sig_expr(c, digits)} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) AS _r"


def round_half_up(c, digits: int = 6):
    """floor(x * 10^d + 0.5) / 10^d: the same IEEE operations as the oracle's
    ``rnd`` so equal doubles always round equally on both sides."""
    scale = float(10 ** digits)
    return (F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def sql_rounded(inner: str, cols: list[str], digits: int = 6) -> str:
    """DuckDB: round the named columns of ``inner`` (a full SELECT)."""
    if not cols:
        return inner
    scale = float(10 ** digits)
    rep = ", ".join(f"floor({c} * {scale!r} + 0.5) / {scale!r} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) AS _r"
