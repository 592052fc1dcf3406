"""Clustering (M9-M13, M19-M20) as DataFrame jobs.

K-means: any number of fits of one table go through their passes together. A
Lloyd step of all of them is one aggregation (runs x k x p partial sums per
task); the centres are the only state on the driver. A fit ends when labels
repeat, which is seen by a fingerprint of all labels that does not depend on
the order of rows and travels with the sums. Seeding is k-means++ drawn with
one least key per centre (an exponential race keyed on a hash of the row id,
so the draw is reproducible for a seed and independent of partitioning).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _num(v: float) -> str:
    """Exact double literal in SQL text (shortest round-trip digits)."""
    return f"({float(v)!r}D)"


def _sq_dist_sql(cols: list[str], centre) -> str:
    return " + ".join(f"(`{c}` - {_num(v)}) * (`{c}` - {_num(v)})" for c, v in zip(cols, centre))


def sq_dist(cols: list[str], centre) -> Column:
    """Squared Euclidean distance of the row to a literal centre. Built as
    one SQL expression (one driver call instead of one per term)."""
    return F.expr(_sq_dist_sql(cols, centre))


def assign(df: DataFrame, cols: list[str], centres, label: str = "label",
           with_distance: bool = False) -> DataFrame:
    """M10 assignment: nearest centre, ties -> lowest index."""
    parts = ", ".join(f"named_struct('d', {_sq_dist_sql(cols, c)}, 'i', {i})" for i, c in enumerate(centres))
    best = F.expr(f"array_min(array({parts}))")
    out = df.withColumn("_best", best).withColumn(label, F.col("_best.i"))
    if with_distance:
        out = out.withColumn("_d2", F.col("_best.d"))
    return out.drop("_best")


def centre_stats(labelled: DataFrame, cols: list[str], k: int, label: str = "label"):
    """Per-label counts and means in one global aggregation: k x (p + 1)
    conditional sums, combined per task and merged into one row (no shuffle
    by label). Returns (counts, means) arrays."""
    exprs = []
    for c in range(k):
        exprs.append(f"count_if(`{label}` = {c}) AS n{c}")
        exprs += [f"sum(CASE WHEN `{label}` = {c} THEN `{x}` END) AS s{c}_{j}" for j, x in enumerate(cols)]
    row = labelled.selectExpr(*exprs).first()
    counts = np.array([row[f"n{c}"] for c in range(k)], dtype=np.int64)
    means = np.full((k, len(cols)), np.nan)
    for c in range(k):
        if counts[c]:
            means[c] = [row[f"s{c}_{j}"] / counts[c] for j in range(len(cols))]
    return counts, means


def lloyd(df: DataFrame, cols: list[str], centres, iterations: int = 1):
    """Fixed number of Lloyd steps from given centres (no re-seeding):
    returns the final centres and counts."""
    centres = np.asarray(centres, dtype=float)
    counts = np.zeros(len(centres), dtype=np.int64)
    for _ in range(iterations):
        counts, means = centre_stats(assign(df, cols, centres), cols, len(centres))
        centres = np.where(np.isnan(means), centres, means)
    return centres, counts


def _uniform(id_col: str, seed: int, step: int) -> Column:
    """Deterministic uniform in (0, 1] from the MD5 of id, seed and step."""
    digits = F.substring(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{int(seed)}:{int(step)}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(1.0)) / F.lit(float(1 << 52))


def kmeans_pp_seeds(df: DataFrame, cols: list[str], k: int, seeds: list[int], id_col: str = "record_id") -> np.ndarray:
    """k-means++ seeding for every seed, (seeds, k, columns): the first centre
    uniform, each next one drawn with probability proportional to the squared
    distance to the nearest centre (exponential race: argmin -ln(u) / distance,
    ties by id). One pass per centre for all seeds. If every point sits on a
    centre, the point whose place in the order of ids is the number of centres
    so far (from 0, over again after the last) is taken."""
    pt = F.array(*[F.col(c).cast("double") for c in cols])
    drawn = lambda key: F.min(F.when(key.isNotNull(), F.struct(key.alias("key"), F.col(id_col).alias("id"), pt.alias("p"))))
    first = df.agg(*[drawn(_uniform(id_col, seed, 0)).alias(f"p{r}") for r, seed in enumerate(seeds)]).first()
    centres = [[list(first[f"p{r}"]["p"])] for r in range(len(seeds))]
    for step in range(1, k):
        exprs = []
        for r, seed in enumerate(seeds):
            d2 = F.expr("least(" + ", ".join(_sq_dist_sql(cols, c) for c in centres[r]) + ")") if step > 1 else sq_dist(cols, centres[r][0])
            exprs.append(drawn(F.when(d2 > 0, -F.log(_uniform(id_col, seed, step)) / d2)).alias(f"p{r}"))
        row, in_order = df.agg(*exprs).first(), None
        for r in range(len(seeds)):
            if row[f"p{r}"] is None and in_order is None:
                in_order = [list(x["p"]) for x in df.orderBy(id_col).limit(k).select(pt.alias("p")).collect()]  # k rows
            centres[r].append(list(row[f"p{r}"]["p"]) if row[f"p{r}"] is not None else in_order[step % len(in_order)])
    return np.asarray(centres, dtype=float)


@dataclass
class KMeansResult:
    labels: DataFrame          # (id, label)
    centres: np.ndarray
    iterations: int
    converged: bool
    sse: float
    counts: np.ndarray


_MARK = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _marks(hashes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """A 64-bit mark of each (id, label); a fingerprint of all labels is the marks' exclusive or."""
    h = hashes.astype(np.int64).view(np.uint64) ^ (labels.astype(np.uint64) + np.uint64(1)) * _MARK[0]
    h = (h ^ h >> np.uint64(29)) * _MARK[1]
    return h ^ h >> np.uint64(32)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances (rows, centres), added up column by column."""
    d = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        d += (x[:, j, None] - centres[None, :, j]) ** 2
    return d


def _step_sums(runs: list[int], centres: np.ndarray, p: int):
    """Per run and label: rows, sums of the columns and the labels' fingerprint, of the task's rows."""
    k = centres.shape[1]

    def each(batches):
        n, sums, mark = np.zeros((len(runs), k), np.int64), np.zeros((len(runs), k, p)), np.zeros((len(runs), k), np.uint64)
        for batch in batches:
            x = np.stack([batch.column(j).to_numpy(zero_copy_only=False) for j in range(p)], axis=1).astype(float)
            h = batch.column(p).to_numpy()
            for i, own in enumerate(centres):
                label = _distances(x, own).argmin(1)
                n[i] += np.bincount(label, minlength=k)
                for j in range(p):
                    sums[i, :, j] += np.bincount(label, x[:, j], k)
                np.bitwise_xor.at(mark[i], label, _marks(h, label))
        run, label = (a.ravel() for a in np.meshgrid(runs, range(k), indexing="ij"))
        data = [run.astype(np.int32), label.astype(np.int32), n.ravel(), mark.view(np.int64).ravel(), *sums.reshape(-1, p).T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a)) for a in data], ["run", "label", "n", "mark", *(f"s{j}" for j in range(p))])

    return each


def _farthest(data: DataFrame, cols: list[str], id_col: str, assigned: np.ndarray, centres: np.ndarray, moved: dict):
    """The row farthest from the centre of its label (ties: lowest id): labels by
    the centres ``assigned``, but for rows already moved to another label."""
    label = assign(data, cols, assigned).withColumn("_old", F.col("label"))
    for id_, (new, _) in moved.items():
        label = label.withColumn("label", F.when(F.col(id_col) == F.lit(id_), F.lit(new)).otherwise(F.col("label")))
    d2 = F.expr("CASE " + " ".join(f"WHEN label = {c} THEN {_sq_dist_sql(cols, centre)}" for c, centre in enumerate(centres)) + " END")
    pt = F.array(*[F.col(c).cast("double") for c in cols])
    return label.agg(F.min(F.struct((-d2).alias("d"), F.col(id_col).alias("id"), "_h", "label", pt.alias("p"))).alias("m")).first()["m"]


def kmeans_many(df: DataFrame, cols: list[str], k: int, seeds: list[int], iterations: int = 80, id_col: str = "record_id") -> tuple[DataFrame, list[KMeansResult]]:
    """Fits of one table for several seeds, and their labels side by side (id, l0, l1, ...).

    k = max(2, min(k, rows)). A step assigns each row to its nearest centre (ties:
    lowest index) and moves centres to their members' means, label by label; a
    label without members takes the row that is then farthest from its own centre
    (ties: lowest id). A fit ends when a step's labels are those of the step before."""
    # ids are assumed unique: a row's hash stands for it in the fingerprint
    data = cut_lineage(df.select(id_col, *cols, F.xxhash64(F.col(id_col).cast("string")).alias("_h")))
    n = data.count()
    if n < 2:
        raise ValueError("k-means needs at least 2 rows")
    k, p = max(2, min(int(k), n)), len(cols)
    centres = kmeans_pp_seeds(data, cols, k, seeds, id_col)
    fits = [{"assigned": c.copy(), "centres": c.copy(), "mark": None, "moved": {}, "counts": np.zeros(k, np.int64), "steps": 0, "converged": False} for c in centres]
    active = list(range(len(seeds)))
    schema = "run int, label int, n long, mark long, " + ", ".join(f"s{j} double" for j in range(p))
    for step in range(1, iterations + 1):
        sums = data.select(*cols, "_h").mapInArrow(_step_sums(active, np.stack([fits[r]["centres"] for r in active]), p), schema)
        whole = sums.groupBy("run", "label").agg(F.sum("n").alias("n"), F.bit_xor("mark").alias("mark"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(p)])
        rows = {(x["run"], x["label"]): x for x in whole.collect()}  # runs x k
        for r in active:
            f, mark = fits[r], 0
            f["assigned"], f["moved"], f["steps"] = f["centres"].copy(), {}, step
            counts, total = np.array([rows[r, c]["n"] for c in range(k)]), np.array([[rows[r, c][f"s{j}"] for j in range(p)] for c in range(k)])
            for c in range(k):
                mark ^= rows[r, c]["mark"] & (1 << 64) - 1
            for c in range(k):
                if counts[c]:
                    f["centres"][c] = total[c] / counts[c]
                    continue
                far = _farthest(data, cols, id_col, f["assigned"], f["centres"], f["moved"])
                point, old = np.asarray(far["p"]), far["label"]
                f["moved"][far["id"]] = (c, far["_h"])
                for x in (old, c):
                    mark ^= int(_marks(np.array([far["_h"]]), np.array([x]))[0])
                counts[old], counts[c], total[old], f["centres"][c] = counts[old] - 1, 1, total[old] - point, point
            f["counts"], f["converged"], f["mark"] = counts, mark == f["mark"], mark
        active = [r for r in active if not fits[r]["converged"]]
        if not active:
            break
    wide = data
    for r, f in enumerate(fits):
        wide = assign(wide, cols, f["assigned"], f"l{r}")
        for id_, (label, _) in f["moved"].items():
            wide = wide.withColumn(f"l{r}", F.when(F.col(id_col) == F.lit(id_), F.lit(label)).otherwise(F.col(f"l{r}")))
    wide = cut_lineage(wide)
    own = ["sum(CASE " + " ".join(f"WHEN l{r} = {c} THEN {_sq_dist_sql(cols, centre)}" for c, centre in enumerate(f["centres"])) + f" END) AS s{r}" for r, f in enumerate(fits)]
    sse = wide.selectExpr(*own).first()
    results = [KMeansResult(wide.select(id_col, F.col(f"l{r}").alias("label")), f["centres"], f["steps"], f["converged"], float(sse[f"s{r}"]), f["counts"]) for r, f in enumerate(fits)]
    return wide.select(id_col, *[f"l{r}" for r in range(len(seeds))]), results


def kmeans(df: DataFrame, cols: list[str], k: int, iterations: int = 80, seed: int = 42, id_col: str = "record_id") -> KMeansResult:
    """M9: one fit of ``kmeans_many``."""
    return kmeans_many(df, cols, k, [seed], iterations, id_col)[1][0]


def adjusted_rand(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """ARI of two labelings given as columns of one table (rows = items).
    NULL (NaN in the reference) for fewer than 2 items; 1 when max = expected."""
    cont = pairs.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))

    def c2(x):
        return x * (x - 1) / 2.0

    # the two marginal pair sums are scalars: they reach the driver as numbers
    row_pairs = cont.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(c2(F.col("n")))).first()[0] or 0.0
    col_pairs = cont.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(c2(F.col("n")))).first()[0] or 0.0
    t = cont.agg(F.sum(c2(F.col("n"))).alias("pairs"), F.sum("n").alias("total"))
    total = c2(F.col("total"))
    expected = F.lit(float(row_pairs)) * F.lit(float(col_pairs)) / total
    maximum = F.lit((float(row_pairs) + float(col_pairs)) / 2)
    ari = F.when(F.col("total") < 2, F.lit(None).cast("double")).when(
        maximum == expected, F.lit(1.0)).otherwise((F.col("pairs") - expected) / (maximum - expected))
    return t.select(F.col("total").alias("n"), ari.alias("ari"))


def pairwise_rand(labels: DataFrame, columns: list[str]) -> DataFrame:
    """(i, j, ari) for all pairs of label columns: contingency tables of all pairs
    and their margins come from one pass with GROUPING SETS, whose partial counts
    have a row per pair of labels."""
    spark, n = labels.sparkSession, len(columns)
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    sets = [(i,) for i in range(n)] + pairs
    mask = lambda used: sum(1 << n - 1 - c for c in range(n) if c not in used)  # noqa: E731  as grouping_id has it
    listed = ", ".join("(" + ", ".join(f"`{columns[c]}`" for c in used) + ")" for used in sets)
    names = ", ".join(f"`{c}`" for c in columns)
    counted = spark.sql(f"SELECT grouping_id({names}) AS g, count(1) AS n FROM {{labels}} GROUP BY {names} GROUPING SETS ({listed})", labels=labels)
    sums = counted.groupBy("g").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2.0).alias("same"), F.sum("n").alias("total"))
    asked = spark.createDataFrame([(i, j, mask((i, j)), mask((i,)), mask((j,))) for i, j in pairs], "i int, j int, g long, gi long, gj long")
    margin = lambda of: sums.select(F.col("g").alias(f"g{of}"), F.col("same").alias(f"same_{of}"))
    joined = asked.join(sums, "g").join(margin("i"), "gi").join(margin("j"), "gj")
    expected = F.col("same_i") * F.col("same_j") / (F.col("total") * (F.col("total") - 1) / 2.0)
    most = (F.col("same_i") + F.col("same_j")) / 2
    ari = F.when(F.col("total") >= 2, F.when(most == expected, F.lit(1.0)).otherwise((F.col("same") - expected) / (most - expected)))
    return joined.select("i", "j", ari.alias("ari"))


def stability(df: DataFrame, cols: list[str], k: int, runs: int = 8, base_seed: int = 2026,
              iterations: int = 100, id_col: str = "record_id") -> DataFrame:
    """``runs`` K-means fits (seeds base_seed + i) in common passes, all
    pairwise ARI from one aggregation, mean and min."""
    runs = max(2, runs)
    labels, _ = kmeans_many(df, cols, k, [base_seed + i for i in range(runs)], iterations, id_col)
    scores = pairwise_rand(labels, [f"l{i}" for i in range(runs)])
    return scores.agg(F.lit(runs).alias("runs"), F.avg("ari").alias("mean_ari"), F.min("ari").alias("min_ari"))


def kmeans_best_of(df: DataFrame, cols: list[str], k: int, n_init: int = 10, iterations: int = 80,
                   seed: int = 42, id_col: str = "record_id") -> KMeansResult:
    """K-means restarted ``n_init`` times (seeds seed, seed + 1, ...) in
    common passes, keeping the fit with the lowest SSE (ties -> first)."""
    _, fits = kmeans_many(df, cols, k, [seed + i for i in range(max(1, n_init))], iterations, id_col)
    return min(fits, key=lambda f: f.sse)
