"""Session helpers: building a local session for tests and finding the shared
checkpoint folder on a cluster."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "cohortlens") -> SparkSession:
    """Return the active session, or build a local one (tests, bench).

    On a cluster the session already exists and keeps its own settings; the
    builder settings below only apply to a fresh local session.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    partitions = partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none (local tests) a private scratch folder is
    created. Never use a machine-local folder on a cluster: set
    ``spark.checkpoint.dir`` to shared storage there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint folder (reliable, survives
    executor loss) and return the re-read DataFrame. An eager Dataset
    checkpoint computes and writes the rows in one job, so no persist is
    needed around it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
