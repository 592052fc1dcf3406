"""Row index without a global window over rows.

A ``row_number()`` over an unpartitioned window moves every row into one
task. Instead the rows are sorted by range and written to the shared
checkpoint folder; from then on their partitions are fixed. A row's index is
its partition's offset (the rows of the partitions before it) plus its
position inside the partition, which the low 33 bits of
``monotonically_increasing_id`` hold. Counting and numbering both read the
written rows, so they cannot see different partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def with_row_index(df: DataFrame, name: str = "row_index", order_by: list | None = None,
                   start: int = 1) -> DataFrame:
    """Add a dense index ``start..start+n-1`` in current (or ``order_by``) order.

    ``order_by`` sorts globally first (range partitioning, no single task).
    The rows are materialised once, whatever their number."""
    if order_by:
        df = df.orderBy(*order_by)
    fixed = cut_lineage(df)
    tagged = fixed.withColumn("_ri_part", F.spark_partition_id()).withColumn(
        "_ri_mono", F.monotonically_increasing_id())
    counts = tagged.groupBy("_ri_part").agg(F.count(F.lit(1)).alias("_ri_n"))
    before = Window.orderBy("_ri_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("_ri_part", (F.coalesce(F.sum("_ri_n").over(before), F.lit(0)) + start).alias("_ri_first"))
    pos = F.col("_ri_mono") - F.shiftleft(F.col("_ri_part").cast("long"), 33)
    out = tagged.join(F.broadcast(offsets), "_ri_part").withColumn(name, (F.col("_ri_first") + pos).cast("long"))
    return out.drop("_ri_part", "_ri_mono", "_ri_first")
