"""Mixing sources to target weights by systematic sampling.

Each source gets a share of all words by its weight, but at most MOST_COPIES
times its own; what is over is shared again by weight. Within a source every
document expects target / size copies. The documents stand in a line, longest
first, with the prefix sums of their expected copies, shifted by one random
offset a source; a document is taken once for each integer it crosses. So a
document gets its expectation rounded down or up, and a source's words stray
from the target by about one long document at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import WORD, null_safe_join, row_id, stage, staged_in_order

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"


def words(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size -> with weight and target, for a table with a row
    for each source. Weights are dealt by the sources' code points, null last,
    repeating. The level at which shares stop rising is found in one pass:
    sources are ordered by size to weight, and those before the first that
    can take its share stand at their limit."""
    order = Window.orderBy(F.col("source").asc_nulls_last())  # a row for each source
    dealt = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    limits = sources.withColumn("weight", dealt.cast("long")).withColumn("limit", F.col("source_size") * most)
    rising = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward, whole = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    level = limits.select("*", F.row_number().over(rising).alias("at"), F.coalesce(F.sum("limit").over(before), F.lit(0)).alias("given"), F.sum("weight").over(onward).alias("left"), F.sum("source_size").over(whole).alias("total"))
    free = F.col("limit") * F.col("left") >= F.col("weight") * (F.col("total") - F.col("given"))
    first = level.select("*", F.min_by(F.struct("at", "given", "left"), F.when(free, F.col("at"))).over(whole).alias("first"))
    share = (F.col("weight") * (F.col("total") - F.col("first.given"))).cast("double") / F.col("first.left")
    return first.select("source", "source_size", "weight", F.when(F.col("at") < F.col("first.at"), F.col("limit").cast("double")).otherwise(share).alias("target"))


def offset_of(source: Column, seed: str) -> Column:
    """The source's random offset in [0, 1), the same in every run."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(source, F.lit("")), F.lit(seed))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, size: Column, doc_id: str = "doc_id", source: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` (all its columns in a struct ``doc``) with its
    source, size, source_size, target and copies. Rows are ordered within a
    source by size, then doc_id; repeated rows stand side by side and each has
    its own chance. Sources of no words have the target 0. An empty table
    gives an empty result.

    The line is of numbers only: dealt by ranges, the longest documents stand
    together, and a task would get the texts of a whole range of them."""
    row = docs.select(F.col(source).alias("source"), size.cast("long").alias("size"), F.col(doc_id).alias("id"), F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    rows = stage(row.withColumn("row", row_id()), "mix-rows")  # by the row's number even one row repeated without end is dealt over many tasks
    line = staged_in_order(rows.drop("doc"), [F.col("source"), F.col("size").desc(), F.col("id"), F.col("row")], "mix", "position")
    sources = line.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("position").alias("start"))
    told = targets(sources.select("source", "source_size"), weights, most)
    plan = null_safe_join(sources, told.select("source", "target"), ["source"]).withColumn("shift", offset_of(F.col("source"), seed))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = null_safe_join(line, plan, ["source"]).withColumns({"each": each, "before": F.col("position") - F.col("start")})
    crossed = F.floor((F.col("before") + 1) * F.col("each") + F.col("shift")) - F.floor(F.col("before") * F.col("each") + F.col("shift"))
    taken = joined.select("row", "source", "size", "source_size", "target", F.least(crossed, F.lit(most)).cast("long").alias("copies"))
    return rows.select("row", "doc").join(taken, "row").drop("row")


def emitted(mixed: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixed.where("copies > 0").select(F.explode(F.array_repeat("doc", F.col("copies").cast("int"))).alias("doc")).select("doc.*")
