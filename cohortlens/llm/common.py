"""Helpers shared by the corpus operators: the shared folder, staged tables,
bounded Arrow batches, salted group results and global row positions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir

#: Texts handed to one vectorised step at a time, in bytes of UTF-8.
SLICE_BYTES = 8 << 20
#: Ways in which the rows of one key are spread before they meet their group's result.
SALTS = 64
#: Rows of a few numbers that are counted before they may be broadcast.
BROADCAST_ROWS = 500_000
#: The characters that separate words, and nothing else does.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share. Set by the cluster in
    ``spark.checkpoint.dir``; only a local master may go without."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder or ensure_checkpoint_dir(spark)


_made: dict[str, list[str]] = {}


def new_folder(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A new name in the shared folder; unless ``keep``, ``release`` deletes it."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not keep:
        _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete what this application's operators have staged so far. Only for a
    caller whose results from them are all written, such as a pipeline between
    two stages: a DataFrame that was not written yet would lose its input."""
    conf, hadoop = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs
    for path in _made.pop(spark.sparkContext.applicationId, []):
        at = hadoop.Path(path)
        at.getFileSystem(conf).delete(at, True)


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once into the shared folder and return it reread: later
    steps neither repeat the work nor depend on any one executor."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label, keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut to about ``most`` bytes in column number ``text``; a longer text comes alone."""
    for batch in batches:
        column = batch.column(text)
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())).to_numpy()
        at = 0
        while at < batch.num_rows:
            base = int(ends[at - 1]) if at else 0
            upto = max(at + 1, int(ends.searchsorted(base + most, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def texts(column: pa.Array) -> list[str]:
    """The strings; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def row_id() -> Column:
    """A number for each row. Only to be used in what is staged at once: a
    second run of the same plan may number otherwise."""
    return F.monotonically_increasing_id()


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null equals null; the keys come once, from the left."""
    named = {k: f"__right_{i}" for i, k in enumerate(keys)}
    other = right.select(*[F.col(c).alias(named.get(c, c)) for c in right.columns])
    return left.join(other, [F.col(k).eqNullSafe(F.col(v)) for k, v in named.items()], how).drop(*named.values())


def broadcast_if_small(table: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table, marked for broadcast if it has ``most`` rows at most;
    beyond that Spark joins it by a shuffle."""
    return F.broadcast(table) if table.count() <= most else table


def smallest_by_hash(rows: DataFrame, group: str, id_: str, most: int) -> DataFrame:
    """Of narrow ``rows``, ``most`` per group at most: those with the smallest
    hash of the id. Ranked first within SALTS parts of a group, so that the
    second ranking meets SALTS * most rows of a group, whatever its size."""
    h = F.xxhash64(F.col(id_))
    part = Window.partitionBy(group, F.pmod(h, F.lit(SALTS))).orderBy(h, id_)
    first = rows.withColumn("__rank", F.row_number().over(part)).where(F.col("__rank") <= most)
    whole = Window.partitionBy(group).orderBy(h, id_)
    return first.withColumn("__rank", F.row_number().over(whole)).where(F.col("__rank") <= most).drop("__rank")


def salted_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has a row for each key (null is one).

    Rows of a key are spread by ``spread`` over SALTS ways; the table's row is
    first joined to the ways that occur, then to the rows. So a key that holds
    a third of all rows is joined in SALTS tasks, and a rare key costs one row."""
    salt, by = "__salt", list(keys)
    rows = rows.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    ways = null_safe_join(rows.select(*by, salt).distinct(), table, by)
    return null_safe_join(rows, ways, [*by, salt], how).drop(salt)


def with_group_result(rows: DataFrame, keys: Sequence[str], spread: Column, combine: dict[str, tuple[str, Column]]) -> DataFrame:
    """Each row with aggregates of its whole group, without gathering a group.

    ``combine``: name -> (aggregate, expression), the aggregate being one of
    sum, min and max, which may be applied to its own partial results. Rows
    are spread as in ``salted_join``; null keys are a group."""
    salt, by = "__salt", list(keys)
    rows = rows.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    part = rows.groupBy(*by, salt).agg(*[getattr(F, how)(value).alias(name) for name, (how, value) in combine.items()])
    whole = part.groupBy(*by).agg(*[getattr(F, how)(name).alias(name) for name, (how, _) in combine.items()])
    return null_safe_join(rows, null_safe_join(part.select(*by, salt), whole, by), [*by, salt]).drop(salt)


def staged_in_order(df: DataFrame, order: Sequence[Column], label: str, position: str) -> DataFrame:
    """``df`` sorted over all its rows, staged, with each row's position from 0.

    Rows are dealt by range, so no key gathers in a task; positions are a
    file's offset plus the row's index in it, both fixed once written."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    each = found.groupBy("__file").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    offsets = each.select("__file", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    return found.join(F.broadcast(offsets), "__file").select(*df.columns, (F.col("__offset") + F.col("__index")).alias(position))
