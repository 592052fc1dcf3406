"""Exact order statistics of many columns at once by radix selection.

A double's bits, with the order of its sign mended, are a 64-bit number that
sorts as the double does. A round counts, for every column and every rank that
is wanted of it, the values whose leading bits are those found so far by their
next DIGIT bits; the counts of all tasks are summed by Spark and the digit in
which the rank falls is fixed. All columns and ranks go through a round
together, in one pass over the table. A rank whose values are all equal is
settled at once (least and greatest of a digit travel with its count), so
columns of whole numbers need two or three rounds, and any column has at most
64 / DIGIT of them.

What a task holds and sends is at most 2 ** DIGIT counts per wanted rank and
column; nothing is sorted, and no column's values gather anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Bits fixed in a round.
DIGIT = 12
_SIGN = np.uint64(1 << 63)
_COUNTS = "target int, digit int, n long, least double, greatest double"


def ordered(values: np.ndarray) -> np.ndarray:
    """64-bit numbers that sort as the doubles do (both zeros alike)."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def restored(keys: np.ndarray) -> np.ndarray:
    """The doubles of ``ordered``."""
    keys = np.asarray(keys, np.uint64)
    return np.where(keys & _SIGN, keys ^ _SIGN, ~keys).view(np.float64)


@dataclass
class Target:
    """A wanted rank (from 1) of a column, the leading bits known of its value, and its rank among the values with these."""

    column: int
    rank: int
    within: int
    prefix: int = 0
    value: float | None = None


def _digits(bits: int) -> tuple[int, int]:
    """How many bits the next round fixes, and where they begin from below, after ``bits`` are known."""
    width = min(DIGIT, 64 - bits)
    return width, 64 - bits - width


def _counted(wanted: list[tuple[int, int]], bits: int):
    """Counts by the next digit of the values of a column with a prefix, for each of ``wanted`` (column, prefix)."""
    width, shift = _digits(bits)

    def each(batches):
        size = 1 << width
        n = np.zeros((len(wanted), size), np.int64)
        least, greatest = np.full((len(wanted), size), np.inf), np.full((len(wanted), size), -np.inf)
        for batch in batches:
            keys: dict[int, np.ndarray] = {}
            for t, (column, prefix) in enumerate(wanted):
                if column not in keys:
                    keys = {column: ordered(batch.column(column).drop_null().to_numpy(zero_copy_only=False).astype(np.float64))}
                own = keys[column]
                if bits:
                    own = own[own >> np.uint64(64 - bits) == np.uint64(prefix)]
                if not len(own):
                    continue
                digit = (own >> np.uint64(shift) & np.uint64(size - 1)).astype(np.int64)
                n[t] += np.bincount(digit, minlength=size)
                values = restored(own)
                np.minimum.at(least[t], digit, values)
                np.maximum.at(greatest[t], digit, values)
        t, digit = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(digit.astype(np.int32)), pa.array(n[t, digit]), pa.array(least[t, digit]), pa.array(greatest[t, digit])], ["target", "digit", "n", "least", "greatest"])

    return each


def _summed(table: DataFrame, wanted: list[tuple[int, int]], bits: int) -> DataFrame:
    """(target, digit, n, least, greatest, upto): counts over all tasks, and how many values of a target lie up to a digit."""
    counts = table.mapInArrow(_counted(wanted, bits), _COUNTS)
    whole = counts.groupBy("target", "digit").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    up = Window.partitionBy("target").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)  # 2 ** DIGIT rows of a target
    return whole.withColumn("upto", F.sum("n").over(up))


def order_statistics(df: DataFrame, cols: list[str], ranks_of) -> tuple[dict[str, int], dict[str, dict[int, float]]]:
    """For each of the numeric columns the number of its values, and the values at
    the ranks (from 1, ascending) that ``ranks_of(number)`` names. Nulls are left
    out; a column without values has no ranks. Reads ``df`` once and what it
    stages of it once a round."""
    table = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    spark = df.sparkSession
    first = [(i, 0) for i in range(len(cols))]
    counts = cut_lineage(_summed(table, first, 0))  # at most 2 ** DIGIT rows per column
    numbers = {r["target"]: r["n"] for r in counts.groupBy("target").agg(F.max("upto").alias("n")).collect()}  # a row per column
    targets = [Target(i, int(rank), int(rank)) for i in sorted(numbers) for rank in sorted(set(ranks_of(numbers[i])))]
    active, bits, groups = targets, 0, {(t.column, 0): t.column for t in targets}
    while active:
        width, _ = _digits(bits)
        asked = spark.createDataFrame([(k, groups[t.column, t.prefix], t.within) for k, t in enumerate(active)], "k int, target int, rank long")
        hit = counts.join(F.broadcast(asked), "target").where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        for r in hit.collect():  # a row per rank wanted
            t = active[r["k"]]
            t.prefix, t.within = t.prefix << width | r["digit"], r["rank"] - (r["upto"] - r["n"])
            if r["least"] == r["greatest"]:
                t.value = float(r["least"])
        bits += width
        active = [t for t in active if t.value is None]
        if active:
            wanted = sorted({(t.column, t.prefix) for t in active})
            groups = {w: k for k, w in enumerate(wanted)}
            counts = cut_lineage(_summed(table, wanted, bits))
    found: dict[str, dict[int, float]] = {c: {} for c in cols}
    for t in targets:
        found[cols[t.column]][t.rank] = t.value
    return {c: numbers.get(i, 0) for i, c in enumerate(cols)}, found
