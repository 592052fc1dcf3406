"""Session features (A8) maintained incrementally with Structured Streaming.

Raw session rows arrive as CSV files in a folder. Cells are parsed with the
same Column expressions as the batch job and aggregated by Spark's own
streaming aggregation in update mode, so the output equals the batch
``session_features`` on all rows seen so far. State per person is a few
numbers and that person's distinct titles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse as P

RAW_SCHEMA = "pid string, duration string, session_start string, title_id string"


def session_feature_stream(spark: SparkSession, folder: str, prefix: str = "xbox",
                           max_files_per_batch: int | None = None) -> DataFrame:
    """Streaming DataFrame of per-person session features (update mode);
    ``max_files_per_batch`` bounds the new files read per micro-batch."""
    reader = spark.readStream.schema(RAW_SCHEMA).option("header", True)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    parsed = reader.csv(folder).select("pid", P.survey_value("duration").alias("d"),
                                       P.is_nocturnal("session_start").alias("night"),
                                       F.coalesce(F.col("title_id"), F.lit("")).alias("title"))
    return parsed.groupBy("pid").agg(
        F.count("d").alias(f"{prefix}_total_sessions"),
        F.coalesce(F.sum("d"), F.lit(0.0)).alias(f"{prefix}_total_duration_min"),
        F.avg("d").alias(f"{prefix}_mean_session_min"),
        F.max("d").alias(f"{prefix}_max_session_min"),
        F.size(F.collect_set("title")).cast("long").alias(f"{prefix}_unique_games"),
        F.count_if("night").alias(f"{prefix}_nocturnal_sessions"))


def run_to_table(spark: SparkSession, folder: str, out: str, checkpoint: str, prefix: str = "xbox",
                 max_files_per_batch: int | None = None) -> DataFrame:
    """Process every file currently in ``folder`` (availableNow trigger) and
    return the latest state per person.

    Each micro-batch's updates are written to ``out/batch_id=<n>`` with
    overwrite, so a retried batch replaces its own output (idempotent sink);
    the result keeps, per person, the row of the highest batch."""
    stream = session_feature_stream(spark, folder, prefix, max_files_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    q = (stream.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    res = spark.read.parquet(out)
    cols = [c for c in res.columns if c not in ("pid", "batch_id")]
    latest = res.groupBy("pid").agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("s"))
    return latest.select("pid", "s.*")
