"""Column profiling (P1-P12) over one unpivoted long table.

Wide aggregates give per-column moments in one pass. Frequencies, distinct
counts, entropy and top values come from ``groupBy(column, value)`` (partial
aggregation first, so a column with few values never funnels rows into one
task). Exact rank statistics (median, floor-rank quartiles) are found by radix
selection (``quantiles.py``) instead of ``percentile``/``median`` aggregates,
which keep every distinct value of a group in one buffer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parse as P
from .filters import missing, numeric, text_form
from .quantiles import order_statistics

NUMERIC_SHARE = 0.75  # P1: share of parseable values above which a column is numeric
TOP_VALUES = 10
HIST_BINS = 30
DENSITY_BINS = 36
ITEM_SKIP_PREFIXES = ["has", "num", "intake", "daily", "bw"]
TOTAL_PATTERNS = ["{p}_total", "bw_{p}_total", "{p}total"]
AGG_CHUNK = 64  # columns per aggregation pass: keeps generated code small


def _chunks(xs: list, n: int):
    for i in range(0, len(xs), n):
        yield xs[i:i + n]


def infer_types(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Numeric if more than 75 % of non-missing cells parse; all-missing
    columns are categorical. One aggregation pass."""
    cols = cols or df.columns
    parts = []
    for start in range(0, len(cols), AGG_CHUNK):
        chunk = cols[start:start + AGG_CHUNK]
        aggs = []
        for c in chunk:
            aggs += [F.count_if(~missing(df, c)).alias(f"{c}__n"),
                     F.count(numeric(df, c)).alias(f"{c}__num")]
        row = df.agg(*aggs)
        parts.append(row.select(F.explode(F.array(*[
            F.struct(F.lit(start + i + 1).alias("position"), F.lit(c).alias("column"),
                     F.col(f"{c}__n").alias("non_missing"), F.col(f"{c}__num").alias("numeric_values"))
            for i, c in enumerate(chunk)])).alias("s")).select("s.*"))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    share = F.try_divide(F.col("numeric_values").cast("double"), F.col("non_missing"))
    return long.withColumn("type", F.when((F.col("non_missing") > 0) & (share > NUMERIC_SHARE),
                                          "numeric").otherwise("categorical"))


def long_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) rows for non-missing cells, value in reference text form."""
    wide = df.select(*[text_form(df, c).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "value").filter(
        F.col("value").isNotNull() & (F.col("value") != ""))


def long_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, x) rows for finite numeric cells."""
    wide = df.select(*[numeric(df, c).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "x").filter(F.col("x").isNotNull())


def frequencies(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, count): the shared frequency table."""
    return long_text(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def top_k(df: DataFrame, partition: list[str], order: list[Column], k: int,
          salt_col: Column | None = None, buckets: int = 64) -> DataFrame:
    """Exact top-k per group in two rounds: top-k inside ``buckets`` salted
    sub-groups, then top-k of the survivors. No group ever holds more than
    its share of one bucket, even when one group holds most rows."""
    salt = F.pmod(F.xxhash64(salt_col if salt_col is not None else F.struct(*df.columns)),
                  F.lit(buckets))
    w1 = Window.partitionBy(*partition, "_salt").orderBy(*order)
    first = (df.withColumn("_salt", salt).withColumn("_rn", F.row_number().over(w1))
             .filter(F.col("_rn") <= k).drop("_rn", "_salt"))
    w2 = Window.partitionBy(*partition).orderBy(*order)
    return first.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)


def _js_key_order() -> list[Column]:
    """Tie order of equal counts: integer-like keys ascending first (object
    key order), then the text (deviation: the reference uses first appearance)."""
    v = F.col("value")
    int_like = v.rlike(r"^(0|[1-9][0-9]{0,8})$")
    return [F.desc("count"), F.desc(int_like.cast("int")),
            F.when(int_like, v.try_cast("long")).asc_nulls_last(), v.asc()]


def top_values(freq: DataFrame, k: int = TOP_VALUES) -> DataFrame:
    """Top-k values per column with counts (rank 1 = mode)."""
    return top_k(freq, ["column"], _js_key_order(), k, salt_col=F.col("value"))


def entropy(freq: DataFrame) -> DataFrame:
    """Shannon entropy (base 2) per column from the frequency table."""
    tot = freq.groupBy("column").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("unique"))
    p = F.col("count") / F.col("n")
    return (freq.join(tot, "column").groupBy("column")
            .agg((-F.sum(p * F.log2(p))).alias("entropy"), F.first("n").alias("count"),
                 F.first("unique").alias("unique")))


def moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """P2 + P5 + P7 per column: counts, missing, mean, population std, min,
    max, skewness and excess kurtosis (NULL unless std > 0 and n > 2)."""
    parts = []
    total = F.count(F.lit(1))
    for chunk in _chunks(cols, AGG_CHUNK // 4):
        aggs = [total.alias("__rows")]
        for c in chunk:
            x = numeric(df, c)
            aggs += [F.count_if(missing(df, c)).alias(f"{c}__miss"), F.count(x).alias(f"{c}__n"),
                     F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std"),
                     F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                     F.skewness(x).alias(f"{c}__skew"), F.kurtosis(x).alias(f"{c}__kurt")]
        row = df.agg(*aggs)
        parts.append(row.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col("__rows").alias("rows"),
                     F.col(f"{c}__miss").alias("missing"), F.col(f"{c}__n").alias("n"),
                     F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                     F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"),
                     F.col(f"{c}__skew").alias("skew"), F.col(f"{c}__kurt").alias("kurt"))
            for c in chunk])).alias("s")).select("s.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ok = (F.col("std") > 0) & (F.col("n") > 2)
    return out.select(
        "column", "rows", "missing",
        (F.col("missing") * 100.0 / F.col("rows")).alias("missing_pct"), "n", "mean", "std",
        "min", "max", F.when(ok, F.col("skew")).alias("skewness"),
        F.when(ok, F.col("kurt")).alias("kurtosis"))


def column_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P1 + P2 + P4 + P5 + P7: one row per column."""
    cols = cols or df.columns
    types = infer_types(df, cols).select("position", "column", "type")
    ent = entropy(frequencies(df, cols)).select("column", "unique", "entropy")
    mom = moments(df, cols)
    out = types.join(mom, "column").join(ent, "column", "left")
    num = F.col("type") == "numeric"
    return out.select(
        "position", "column", "type", F.col("n").alias("valid"), "missing", "missing_pct",
        F.coalesce("unique", F.lit(0)).alias("unique"),
        F.coalesce("entropy", F.lit(0.0)).alias("entropy"),
        *[F.when(num, F.col(c)).alias(c) for c in ["mean", "std", "min", "max", "skewness",
                                                     "kurtosis"]])


# --- exact rank selection ------------------------------------------------------

def _rank_targets(n: int) -> dict[str, list[int]]:
    """1-based ranks needed per statistic: midpoint median, floor-rank
    quartiles (Q1 = sorted[floor(n/4)], Q3 = sorted[floor(3n/4)], 0-based)."""
    if n <= 0:
        return {}
    med = [n // 2, n // 2 + 1] if n % 2 == 0 else [(n + 1) // 2]
    return {"median": med, "q1": [math.floor(n * 0.25) + 1], "q3": [math.floor(n * 0.75) + 1]}


def rank_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n, median, q1, q3) for finite values: midpoint median and
    floor-rank quartiles (Q1 = sorted[floor(n/4)], Q3 = sorted[floor(3n/4)]),
    by radix selection of all columns together; columns without values are left out."""
    nums = df.select(*[numeric(df, c).alias(c) for c in cols])
    counts, at = order_statistics(nums, cols, lambda n: [k for ranks in _rank_targets(n).values() for k in ranks])
    rows = []
    for c in cols:
        if counts[c]:
            median, (q1,), (q3,) = ([at[c][k] for k in ranks] for ranks in _rank_targets(counts[c]).values())
            rows.append((c, counts[c], sum(median) / len(median), q1, q3))
    return df.sparkSession.createDataFrame(rows, "column string, n long, median double, q1 double, q3 double")


def quartiles(df: DataFrame, cols: list[str]) -> DataFrame:
    """Median (midpoint), floor-rank Q1/Q3 and IQR per numeric column."""
    q = rank_stats(df, cols)
    return q.select("column", "n", "median", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))


def frequency_top(df: DataFrame, col: str, k: int = 20) -> DataFrame:
    """Top-k categories by count (ties by value text)."""
    t = text_form(df, col)
    return (df.select(t.alias("value")).filter(F.col("value").isNotNull() & (F.col("value") != ""))
            .groupBy("value").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("value")).limit(k))


def histogram(df: DataFrame, cols: list[str], bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram per column; the max lands in the last bin,
    min == max puts everything in bin 1."""
    long = long_numeric(df, cols)
    rng = long.groupBy("column").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / width).cast("int") + 1, F.lit(bins)))
    return (long.join(F.broadcast(rng), "column").withColumn("bin", b)
            .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"),
                                          F.first("lo").alias("lo"), F.first("hi").alias("hi"))
            .select("column", "bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_start"),
                    "count"))


def box_outliers(df: DataFrame, cols: list[str], id_col: str = "record_id") -> DataFrame:
    """P10: points outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR] per column."""
    q = quartiles(df, cols)
    wide = df.select(id_col, *[numeric(df, c).alias(c) for c in cols])
    long = wide.unpivot([id_col], cols, "column", "x").filter(F.col("x").isNotNull())
    j = long.join(F.broadcast(q.select("column", "q1", "q3", "iqr")), "column")
    out = (F.col("x") < F.col("q1") - 1.5 * F.col("iqr")) | (F.col("x") > F.col("q3") + 1.5 * F.col("iqr"))
    return j.filter(out).select("column", id_col, "x")


def density_grid(points: DataFrame, x: str = "x", y: str = "y", bins: int = DENSITY_BINS) -> DataFrame:
    """Bins x bins count grid over the bounding box of the points."""
    r = points.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"),
                   F.max(y).alias("y1")).first()  # four numbers reach the driver

    def cell(v, lo, hi):
        if lo is None or hi is None or hi == lo:
            return F.lit(0)
        w = (hi - lo) / bins
        return F.least(F.floor((F.col(v) - F.lit(lo)) / F.lit(w)).cast("int"), F.lit(bins - 1))

    return (points.select(cell(x, r["x0"], r["x1"]).alias("gx"), cell(y, r["y0"], r["y1"]).alias("gy"))
            .groupBy("gx", "gy").agg(F.count(F.lit(1)).alias("count")))


def item_groups(columns: list[str]) -> list[dict]:
    """Survey item groups from column names (metadata only; a column
    list is small). Items ordered by first digit run, total column by
    pattern, groups sorted by name."""
    import re
    rx = re.compile(P.ITEM_NAME_RE.replace("(?i)", ""), re.I)
    groups: dict[str, list[str]] = {}
    for c in columns:
        m = rx.match(c)
        if not m:
            continue
        prefix = m.group(1).lower()
        if prefix in ITEM_SKIP_PREFIXES:
            continue
        groups.setdefault(prefix, [])
        if c not in groups[prefix]:
            groups[prefix].append(c)
    out = []
    for prefix, items in groups.items():
        if len(items) < 2:
            continue
        items = sorted(items, key=lambda c: int(re.search(r"(\d+)", c).group(1)))
        total = next((c for c in columns if c in [t.format(p=prefix) for t in TOTAL_PATTERNS]), None)
        out.append({"name": prefix.upper(), "items": items, "total_col": total})
    return sorted(out, key=lambda g: g["name"])
