"""Connected components on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import broadcast_if_small, stage


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for the nodes of
    ``links`` (a, b: long). Each round every node takes the smallest label
    among its neighbours', then the label of its label; it ends when no label
    changes, however many rounds that takes."""
    both = stage(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        known = broadcast_if_small(labels)
        heard = both.join(known, both["a"] == labels["node"]).select(F.col("b").alias("node"), F.col("label").alias("next"), F.lit(None).cast("long").alias("old"))
        lower = heard.union(labels.select("node", "label", F.col("label").alias("old"))).groupBy("node").agg(F.min("next").alias("next"), F.max("old").alias("old"))
        jump = known.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        new = stage(lower.join(jump, "next", "left").select("node", F.least("next", F.coalesce("jump", "next")).alias("label"), "old"), "labels")
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
