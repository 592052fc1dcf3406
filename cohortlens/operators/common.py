"""Small shared helpers: checked broadcast, rounding, unpivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest side we broadcast without a shuffle. The check counts at most
# this many + 1 rows, so it is cheap even when the side is huge.
BROADCAST_MAX_ROWS = 1_000_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most
    ``max_rows + 1`` of them)."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, bool]:
    """Broadcast hint only behind a proven row bound; otherwise leave the
    side to a shuffle join (AQE may still convert it at run time)."""
    if row_count_at_most(df, max_rows):
        return F.broadcast(df), True
    return df, False


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unpivot_values(df: DataFrame, ids: list[str], cols: list[str], var: str = "column",
                   val: str = "value", value_type: str = "double") -> DataFrame:
    """Wide -> long (one row per id and column) with a common value type."""
    casted = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return casted.unpivot(ids, cols, var, val)


def safe_div(a, b) -> Column:
    """Division that yields NULL instead of raising on a zero divisor."""
    return F.try_divide(col_of(a), col_of(b))
