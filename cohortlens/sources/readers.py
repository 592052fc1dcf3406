"""Sources (S1-S6, S11): CSV, gzip CSV, folders and zip archives of CSVs.

All readers return DataFrames; nothing is parsed on the driver. Row order
(file order) is recovered from ``_metadata`` (file name, split start) plus
the position inside each split, so a ``record_id`` backfill numbers rows as
they appear in the files without a global sort or a single-task window.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import zipfile

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------
SUFFIXES = [(".zip", "zip"), (".csv.gz", "csv.gz"), (".csv", "csv")]
# -----------------------------------------------------------------------------


def detect_file_type(name: str) -> str | None:
    """S1: 'zip', 'csv.gz' or 'csv' by suffix (case-insensitive), else None."""
    low = name.lower()
    for suffix, kind in SUFFIXES:
        if low.endswith(suffix):
            return kind
    return None


def file_type_col(name: Column) -> Column:
    """S1 as a column expression (for file listings)."""
    low = F.lower(name)
    expr = F.lit(None).cast("string")
    for suffix, kind in reversed(SUFFIXES):
        expr = F.when(low.endswith(suffix), F.lit(kind)).otherwise(expr)
    return expr


def base_name(path: Column) -> Column:
    """Text after the last '/'."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def with_file_order(df: DataFrame, name: str = "file_row") -> DataFrame:
    """Dense 1..n index in file order (file path, then split start, then row
    position inside the split). ``df`` must come straight from a file scan."""
    tagged = df.select("*", F.col("_metadata.file_path").alias("_fp"),
                       F.col("_metadata.file_block_start").alias("_fs"),
                       F.monotonically_increasing_id().alias("_mono"))
    splits = tagged.groupBy("_fp", "_fs").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_m0"))
    before = Window.orderBy("_fp", "_fs").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    off = splits.select("_fp", "_fs", "_m0", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).alias("_base"))
    out = tagged.join(off, ["_fp", "_fs"])
    return out.withColumn(name, (F.col("_base") + F.col("_mono") - F.col("_m0")).cast("long")).drop(
        "_fp", "_fs", "_mono", "_base", "_m0")


def _scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              infer: bool = False, multiline: bool = False) -> DataFrame:
    reader = (spark.read.option("header", True).option("multiLine", multiline)
              .option("mode", "PERMISSIVE").option("emptyValue", ""))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False, multiline: bool = False, partitions: int | None = None) -> DataFrame:
    """Header CSV (gzip inferred from the suffix). Without a
    schema every column is text (raw sources). Empty lines are skipped by
    the reader. A gzip file is one unsplittable split, so it is spread over
    ``partitions`` (default: the session's parallelism) right after the scan."""
    return _spread(_scan_csv(spark, path, schema, infer, multiline), path, partitions)


def _spread(df: DataFrame, path: str, partitions: int | None) -> DataFrame:
    if not path.lower().endswith(".gz"):
        return df
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


def read_csv_with_record_id(spark: SparkSession, path: str, **kw) -> DataFrame:
    """CSV with ``record_id`` backfilled by row number (file order) when
    the column is absent or NULL; a backfilled column is put first. Rows are
    numbered where they are scanned and only then spread."""
    df = _scan_csv(spark, path, **{k: v for k, v in kw.items() if k != "partitions"})
    present = "record_id" in df.columns
    indexed = _spread(with_file_order(df, "_row"), path, kw.get("partitions"))
    if present:
        return indexed.withColumn("record_id", F.coalesce(F.col("record_id").cast("string"),
                                                            F.col("_row").cast("string"))).drop("_row")
    cols = df.columns
    return indexed.select(F.col("_row").alias("record_id"), *cols)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, kind, size, modified) of the CSV / CSV.GZ files below a
    folder. Only metadata is read (the content column is never selected)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
             .select("path", "length", "modificationTime"))
    return (files.select("path", base_name(F.col("path")).alias("name"),
                         file_type_col(base_name(F.col("path"))).alias("kind"),
                         F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
            .filter(F.col("kind").isin("csv", "csv.gz")))


def read_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """One all-text DataFrame per CSV file below ``folder``, keyed by base
    name (the file list is metadata and small)."""
    return {r["name"]: read_csv(spark, r["path"]) for r in list_files(spark, folder).collect()}


ARCHIVE_SCHEMA = "archive string, member string, line_no long, line string, error string"


def _archive_lines(batches):
    """One archive per row: stream every CSV / CSV.GZ member line by line (in
    bounded batches); an unreadable member yields one error row instead of
    failing the job."""
    cols = ["archive", "member", "line_no", "line", "error"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                zf = zipfile.ZipFile(io.BytesIO(content))
            except zipfile.BadZipFile as exc:
                yield pd.DataFrame([(path, None, None, None, f"bad archive: {exc}")], columns=cols)
                continue
            for info in zf.infolist():
                if info.is_dir():
                    continue
                name = info.filename.rsplit("/", 1)[-1]
                kind = detect_file_type(name)
                if kind not in ("csv", "csv.gz"):
                    continue
                buf = []
                try:
                    raw = zf.open(info)
                    stream = gzip.open(raw) if kind == "csv.gz" else raw
                    text = io.TextIOWrapper(stream, encoding="utf-8-sig", newline="")
                    for i, line in enumerate(text):
                        line = line.rstrip("\r\n")
                        if line.strip() == "":
                            continue
                        buf.append((path, name, i, line, None))
                        if len(buf) >= 50_000:
                            yield pd.DataFrame(buf, columns=cols)
                            buf = []
                except Exception as exc:  # a bad member is skipped with a warning row
                    buf.append((path, name, None, None, f"unreadable member: {exc}"))
                if buf:
                    yield pd.DataFrame(buf, columns=cols)


def archive_lines(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, line_no, line, error) for every CSV / CSV.GZ
    member of the zip archive(s) at ``path``; one archive per task."""
    bins = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return bins.mapInPandas(_archive_lines, ARCHIVE_SCHEMA)


def read_archive(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """One all-text DataFrame per member (header = its first line, parsed
    with ``from_csv``) and a DataFrame of skipped members / warnings."""
    from ..session import cut_lineage
    lines = cut_lineage(archive_lines(spark, path))
    errors = lines.filter(F.col("error").isNotNull()).select("archive", "member", "error")
    ok = lines.filter(F.col("error").isNull())
    first = ok.groupBy("member").agg(F.min("line_no").alias("h_no"),
                                     F.min_by("line", "line_no").alias("header")).collect()
    tables = {}
    for r in first:
        names = list(pd.read_csv(io.StringIO(r["header"] + "\n"), dtype=str).columns)
        schema = ", ".join(f"`{c}` string" for c in names)
        body = ok.filter((F.col("member") == r["member"]) & (F.col("line_no") > F.lit(r["h_no"])))
        parsed = body.select(F.from_csv("line", schema).alias("r")).select("r.*")
        tables[r["member"]] = parsed
    return tables, errors


def fingerprint(spark: SparkSession, paths: list[str], salt: str = "") -> str:
    """Fingerprint of input files (path, size, modification time) used
    to key a stored aggregate, so a cache is never reused for other input."""
    meta = (spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
            .orderBy("path").collect())
    h = hashlib.sha256(salt.encode())
    for r in meta:
        h.update(json.dumps([r["path"], r["length"], str(r["modificationTime"])]).encode())
    return h.hexdigest()[:16]


def cached_table(spark: SparkSession, build, folder: str, key: str) -> DataFrame:
    """Read ``folder/key`` if it exists, else build, write (parquet) and
    read it back. ``key`` should come from ``fingerprint``."""
    target = f"{folder.rstrip('/')}/{key}"
    try:
        return spark.read.parquet(target)
    except AnalysisException as exc:  # only an absent table is built; any other error is the caller's to see
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        build().write.mode("overwrite").parquet(target)
        return spark.read.parquet(target)
