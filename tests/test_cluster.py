import numpy as np
import pyarrow as pa
import pytest

from cohortlens.operators import cells as CELLS
from cohortlens.operators import cluster as C
from cohortlens.operators import components as CC
from cohortlens.operators import density as D
from cohortlens.operators import matrix as M
from cohortlens.operators import metric as METRIC
from cohortlens.operators import neighbors as N
from cohortlens.operators import pairs as PAIRS
from cohortlens.operators import validate as V

POINTS = [(1, 0.0, 0.0), (2, 0.1, 0.0), (3, 10.0, 10.0), (4, 10.1, 10.0)]


def pts(spark, rows=POINTS):
    return spark.createDataFrame(rows, "record_id long, x double, y double")


def labels(df, id_col="record_id"):
    return {r[id_col]: r["label"] for r in df.collect()}


def test_kmeans_reproducible_no_empty(spark):
    df = pts(spark)
    a = C.kmeans(df, ["x", "y"], 3, 100, seed=7)
    b = C.kmeans(df, ["x", "y"], 3, 100, seed=7)
    la, lb = labels(a.labels), labels(b.labels)
    assert la == lb
    assert len(set(la.values())) == 3
    assert a.iterations <= 100


def plain_kmeans(x, centres, iterations):
    """The sequential rule: labels, means label by label, empty labels take the farthest row; ends when labels repeat."""
    centres, labels = [c.copy() for c in centres], [-1] * len(x)
    for step in range(1, iterations + 1):
        new = [int(np.argmin([((v - c) ** 2).sum() for c in centres])) for v in x]
        done, labels = new == labels, new
        for c in range(len(centres)):
            members = [v for v, m in zip(x, labels) if m == c]
            if members:
                centres[c] = np.mean(members, axis=0)
            else:
                far = max(range(len(x)), key=lambda i: (((x[i] - centres[labels[i]]) ** 2).sum(), -i))
                labels[far], centres[c] = c, x[far].copy()
        if done:
            break
    return labels, centres, step, done


def test_fits_go_together_and_follow_the_sequential_rule(spark, monkeypatch):
    """Several seeds, empty labels among them (centres drawn twice), copies."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(60, 2)), np.full((20, 2), 5.0), rng.normal(size=(40, 2)) + 8]).round(2)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "record_id long, a double, b double").repartition(3)
    drawn = C.kmeans_pp_seeds(df, ["a", "b"], 4, [1, 2, 3], "record_id")
    assert drawn.shape == (3, 4, 2) and np.array_equal(drawn, C.kmeans_pp_seeds(df.repartition(2), ["a", "b"], 4, [1, 2, 3], "record_id"))
    drawn[1][2], drawn[2][1], drawn[2][3] = drawn[1][0], drawn[2][0], drawn[2][0]  # labels without members
    monkeypatch.setattr(C, "kmeans_pp_seeds", lambda *a: drawn.copy())
    wide, fits = C.kmeans_many(df, ["a", "b"], 4, [1, 2, 3], 30)
    rows = sorted(wide.collect())
    for r, fit in enumerate(fits):
        labels_, centres, steps, done = plain_kmeans(x, drawn[r], 30)
        assert [row[f"l{r}"] for row in rows] == labels_
        assert np.allclose(fit.centres, centres) and (fit.iterations, fit.converged) == (steps, done)
        assert fit.sse == pytest.approx(sum(((v - centres[m]) ** 2).sum() for v, m in zip(x, labels_)))
        assert list(fit.counts) == [labels_.count(c) for c in range(4)]


def test_seeding_of_fewer_places_than_centres(spark):
    df = spark.createDataFrame([(i, float(i // 3)) for i in range(6)], "record_id long, a double")
    assert sorted(C.kmeans_pp_seeds(df, ["a"], 4, [5], "record_id")[0][:2].ravel()) == [0.0, 1.0]
    fit = C.kmeans(df, ["a"], 4, seed=5)
    want = plain_kmeans(np.array([[i // 3] for i in range(6)], float), C.kmeans_pp_seeds(df, ["a"], 4, [5], "record_id")[0], 80)
    assert [r["label"] for r in fit.labels.orderBy("record_id").collect()] == want[0] and fit.sse == 0.0


def test_all_pairs_of_labelings_in_one_pass(spark):
    rng = np.random.default_rng(4)
    rows = [(i, *map(int, rng.integers(0, 3, 3)), 7) for i in range(200)]
    df = spark.createDataFrame(rows, "record_id long, l0 int, l1 int, l2 int, l3 int")
    got = {(r["i"], r["j"]): r["ari"] for r in C.pairwise_rand(df, ["l0", "l1", "l2", "l3"]).collect()}
    assert len(got) == 6
    for (i, j), ari in got.items():
        want = C.adjusted_rand(df.selectExpr(f"l{i} AS a", f"l{j} AS b")).first()["ari"]
        assert ari == pytest.approx(want)


def test_lloyd_step_matches_numpy(spark):
    rng = np.random.default_rng(1)
    xy = rng.normal(size=(200, 2))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "record_id long, x double, y double")
    cent = xy[:3].copy()
    got, counts = C.lloyd(df, ["x", "y"], cent, iterations=2)
    for _ in range(2):
        d = ((xy[:, None, :] - cent[None]) ** 2).sum(2)
        lab = d.argmin(1)
        cent = np.array([xy[lab == c].mean(0) if (lab == c).any() else cent[c] for c in range(3)])
    assert np.allclose(got, cent)
    assert counts.sum() == 200


def test_dbscan_core_border_noise(spark):
    df = pts(spark, [(1, 0.0, 0.0), (2, 0.1, 0.0), (5, 0.2, 0.0), (6, 4.0, 4.0)])
    lab = labels(D.dbscan(df, 0.15, 2))
    assert lab == {1: 0, 2: 0, 5: 0, 6: -1}


def test_dbscan_zero_radius_duplicates(spark):
    df = pts(spark, [(1, 1.0, 1.0), (2, 1.0, 1.0), (3, 2.0, 2.0)])
    lab = labels(D.dbscan(df, 0, 2))
    assert lab == {1: 0, 2: 0, 3: -1}


def brute_dbscan(xy, eps, min_pts):
    n = len(xy)
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(2))
    nb = [np.where(d[i] <= eps)[0] for i in range(n)]
    lab = [-1] * n
    seen = [False] * n
    cid = 0
    for i in range(n):
        if seen[i]:
            continue
        seen[i] = True
        if len(nb[i]) < min_pts:
            continue
        lab[i] = cid
        queue = list(nb[i])
        q = 0
        while q < len(queue):
            j = queue[q]
            if not seen[j]:
                seen[j] = True
                if len(nb[j]) >= min_pts:
                    for c in nb[j]:
                        if c not in queue:
                            queue.append(c)
            if lab[j] == -1:
                lab[j] = cid
            q += 1
        cid += 1
    return lab


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_dbscan_matches_sequential_scan(spark, seed):
    rng = np.random.default_rng(seed)
    xy = np.round(rng.normal(size=(120, 2)) * 0.5, 1)  # many ties and duplicates
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)],
                               "record_id long, x double, y double")
    got = labels(D.dbscan(df, 0.25, 4))
    want = brute_dbscan(xy, 0.25, 4)
    assert [got[i] for i in range(len(xy))] == want


def test_single_link_exact_k(spark):
    lab = labels(D.single_link(pts(spark), 2))
    assert len(set(lab.values())) == 2
    assert lab[1] == lab[2] == 0 and lab[3] == lab[4] == 1


def test_connected_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101)], "src long, dst long")
    verts = spark.createDataFrame([(i,) for i in list(range(31)) + [100, 101, 200]], "id long")
    comp = {r["id"]: r["component"] for r in CC.connected_components(edges, verts).collect()}
    assert all(comp[i] == 0 for i in range(31)) and comp[101] == 100 and comp[200] == 200


def test_adjusted_rand(spark):
    same = spark.createDataFrame([(0, 5), (0, 5), (1, 6), (1, 6)], "a int, b int")
    assert C.adjusted_rand(same).first()["ari"] == pytest.approx(1.0)
    one = spark.createDataFrame([(0, 1)], "a int, b int")
    assert C.adjusted_rand(one).first()["ari"] is None


def test_summary_metrics_silhouette(spark):
    p = pts(spark)
    df = p.withColumn("label", (p["record_id"] > 2).cast("int"))
    s = {r["label"]: r["count"] for r in V.summary(df, ["x", "y"]).collect()}
    assert s == {0: 2, 1: 2}
    m = V.metrics(df, ["x", "y"]).first()
    assert m["sse"] == pytest.approx(4 * 0.05 ** 2) and m["size_balance"] == 1.0
    sil = V.silhouette(df, ["x", "y"]).first()
    assert sil["sample_size"] == 4 and sil["silhouette"] > 0.95


def test_pca_collinear(spark):
    df = spark.createDataFrame([(i, float(i), 2.0 * i) for i in range(1, 5)], "record_id long, a double, b double")
    res = M.pca(df, ["a", "b"], "mean")
    assert res.explained[0] == pytest.approx(1.0) and res.explained[1] == pytest.approx(0.0, abs=1e-12)
    assert [abs(v) for v in res.loadings["PC1"]] == pytest.approx([0.70710678, 0.70710678])


def test_impute_all_missing_to_zero(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, 3.0)], "record_id long, a double, b double")
    out = M.impute(df, ["a", "b"], "mean").orderBy("record_id").collect()
    assert [(r["a"], r["b"]) for r in out] == [(0.0, 1.0), (0.0, 3.0)]
    z = M.zscore(M.impute(df, ["a", "b"], "median"), ["a", "b"]).collect()
    assert all(np.isfinite([r["a"], r["b"]]).all() for r in z)


def test_farthest_pair_of_many_copies(spark):
    corners = [(0.0, 0.0), (3.0, 0.0), (0.0, 4.0), (1.0, 1.0)]
    rows = [(1000 - k, *corners[k % 4]) for k in range(400)]  # 300 rows stand on the hull
    df = spark.createDataFrame(rows, "record_id long, x double, y double").repartition(5)
    low = {c: min(r[0] for r in rows if r[1:] == c) for c in corners}
    a, b = sorted((low[(3.0, 0.0)], low[(0.0, 4.0)]))
    assert tuple(N.farthest_pair(df).first()) == (a, b, 5.0)
    assert tuple(N.farthest_pair(df.where("x = 3")).first()) == (low[(3.0, 0.0)], low[(3.0, 0.0)] + 4, 0.0)
    assert N.farthest_pair(df.where("record_id = 1000")).count() == N.farthest_pair(df.limit(0)).count() == 0


def all_pairs(rows):
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    return [(np.hypot(p[1] - q[1], p[2] - q[2]), min(p[0], q[0]), max(p[0], q[0])) for k, p in enumerate(rows) for q in rows[:k]]


def point_sets():
    rng = np.random.default_rng(5)
    angles = np.arange(120) * 2 * np.pi / 120
    return {
        "uniform": rng.uniform(size=(300, 2)),
        "lattice": rng.integers(0, 12, size=(300, 2)) / 4.0,
        "circle": np.stack([np.cos(angles), np.sin(angles)], axis=1).round(12),
        "line": np.stack([np.zeros(200), rng.uniform(size=200).round(2)], axis=1),
        "hot": np.concatenate([np.full((150, 2), 0.25), 0.25 + rng.uniform(0, 1e-6, (100, 2)), rng.uniform(-5, 5, (50, 2))]),
        "clump": np.concatenate([rng.uniform(0, 4e-9, (100, 2)), [[1.0, 1.0]]]),
    }


@pytest.mark.parametrize("kind", sorted(point_sets()))
def test_closest_and_farthest_pair_of_all(spark, monkeypatch, kind):
    """Against all pairs: copies, ties, points on a circle, one spot with most points, pairs too close to count, nulls."""
    monkeypatch.setattr(PAIRS, "DRAWN", 3)
    rows = [(900 - i, float(a), float(b)) for i, (a, b) in enumerate(point_sets()[kind])] + [(1, None, 0.0), (2, 50.0, None)]
    df = spark.createDataFrame(rows, "record_id long, x double, y double").repartition(3)
    pairs = all_pairs(rows)
    d, a, b = min(t for t in pairs if t[0] > 1e-8)
    near = N.closest_pair(df).first()
    assert (near["a"], near["b"]) == (a, b) and near["distance"] == pytest.approx(d, rel=1e-12)
    d = max(t[0] for t in pairs)
    far = N.farthest_pair(df).first()
    assert far["distance"] == pytest.approx(d, rel=1e-12)
    ties = [(a, b) for t, a, b in pairs if t >= d * (1 - 1e-12)]
    assert (far["a"], far["b"]) in ties and (kind == "circle" or (far["a"], far["b"]) == min(ties))


def test_pairs_of_few_points(spark):
    few = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 1e-9)], "record_id long, x double, y double")
    assert N.closest_pair(few).count() == N.closest_pair(few.limit(0)).count() == N.closest_pair(few.limit(1)).count() == 0
    assert N.farthest_pair(few.limit(1)).count() == N.farthest_pair(few.limit(0)).count() == 0
    assert tuple(N.farthest_pair(few).first()) == (1, 3, 1e-9)


def test_metrics_have_one_rule_for_coincident_centroids(spark):
    """In three dimensions, with many clusters, two of which share their centroid."""
    rows = [(k, k // 2, float(k // 2 % 40), float(k // 2 // 40), float(k % 2)) for k in range(400)] + [(900, 500, 3.0, 1.0, 0.5)]
    df = spark.createDataFrame(rows, "record_id long, label int, x double, y double, z double")
    assert V.metrics(df, ["x", "y", "z"]).first()["min_centroid_distance"] == 0.0
    assert V.metrics(df.where("record_id < 900"), ["x", "y", "z"]).first()["min_centroid_distance"] == 1.0


@pytest.mark.parametrize("n, p, part_rows, cell_rows", [(60, 5, 16, 512), (900, 2, 40, 60), (500, 8, 4096, 50), (3, 2, 10, 10)])
def test_knn_graph_exact(spark, monkeypatch, n, p, part_rows, cell_rows):
    """Against all pairs, with ties, a third of the points on one spot, and rings cut into parts."""
    monkeypatch.setattr(METRIC, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(METRIC, "VISIT_ROWS", 100)
    v = np.random.default_rng(2).normal(size=(n, p)).round(1)
    v[: n // 3] = v[0]
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id long, vec array<double>")
    got = {(r["id"], r["rank"], r["neighbor"], round(r["distance"], 9)) for r in N.knn_graph(df, 4, part_rows=part_rows).collect()}
    want = set()
    for i in range(n):
        d = np.sqrt(((v - v[i]) ** 2).sum(1))
        near = [j for j in np.lexsort((np.arange(n), d)) if j != i][: min(4, n - 1)]
        want |= {(i, k, int(j), round(float(d[j]), 9)) for k, j in enumerate(near, 1)}
    assert got == want


def test_a_point_visits_only_rings_within_its_bound():
    """In the plane most rings are ruled out, and none that holds a neighbour."""
    rng = np.random.default_rng(3)
    v, pivots = rng.uniform(size=(4000, 2)), rng.uniform(size=(40, 2))
    d = np.sqrt(((v[:, None] - pivots[None]) ** 2).sum(2))
    cell = d.argmin(1)
    own = d[np.arange(len(v)), cell]
    ring = (own > np.array([np.median(own[cell == c]) for c in range(40)])[cell]).astype(int)
    keys = [(c, r) for c in range(40) for r in range(2)]
    rows = [{"cell": c, "parts": 1, "least": own[(cell == c) & (ring == r)].min(), "greatest": own[(cell == c) & (ring == r)].max()} for c, r in keys]
    low = METRIC.Rings(pivots, rows).bounds(v[:300])
    apart = np.sqrt(((v[:300, None] - v[None]) ** 2).sum(2))
    for k, (c, r) in enumerate(keys):
        assert (low[:, k] <= apart[:, (cell == c) & (ring == r)].min(1)).all()
    assert (low <= np.sort(apart, 1)[:, 5][:, None]).mean() < 0.15


def test_pca_grade_and_three_variables(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=200)
    rows = [(i, float(a[i]), float(2 * a[i] + rng.normal() * 0.1), float(rng.normal())) for i in range(200)]
    df = spark.createDataFrame(rows, "record_id long, a double, b double, c double")
    res = M.pca(df, ["a", "b", "c"], "mean")
    z = np.array([[r[1], r[2], r[3]] for r in rows])
    z = (z - z.mean(0)) / z.std(0)
    vals = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    assert res.explained[0] == pytest.approx(vals[0] / vals.sum())
    assert M.pca_grade(res.explained) == "high"
    assert M.pca_grade([0.5, 0.15]) == "moderate" and M.pca_grade([0.3, 0.2]) == "low"


@pytest.mark.parametrize("seed", [3, 4])
def test_dbscan_dense_cells_match_sequential_scan(spark, seed):
    # dense blobs: many full cells whose neighbours only partly overlap, so
    # the quadtree refinement decides which dense cells touch
    rng = np.random.default_rng(seed)
    centres = rng.uniform(0, 3, size=(3, 2))
    xy = np.concatenate([c + rng.normal(scale=0.1, size=(300, 2)) for c in centres] +
                        [rng.uniform(0, 3, size=(60, 2))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)],
                               "record_id long, x double, y double")
    got = labels(D.dbscan(df, 0.05, 5))
    want = brute_dbscan(xy, 0.05, 5)
    assert [got[i] for i in range(len(xy))] == want


def test_dbscan_of_a_cell_that_holds_a_third(spark, monkeypatch):
    """Copies and near copies in one cell; its neighbours come from sparse cells in chunks."""
    monkeypatch.setattr(D, "CHUNK_ROWS", 20)
    rng = np.random.default_rng(8)
    xy = np.concatenate([np.full((200, 2), 0.51), 0.5 + rng.uniform(0, 0.01, size=(100, 2)), rng.uniform(0, 2, size=(300, 2))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "record_id long, x double, y double")
    got = labels(D.dbscan(df, 0.12, 6))
    assert [got[i] for i in range(len(xy))] == brute_dbscan(xy, 0.12, 6)


def test_cells_touch_if_any_of_their_points_do(spark):
    """Against all pairs of points; lattices give distances that equal the radius."""
    rng = np.random.default_rng(6)
    rows = []
    for cell in range(24):
        centre = rng.integers(0, 4, 2) * 1.0
        kind = cell % 3
        p = centre + (rng.integers(0, 8, (60, 2)) / 8 if kind == 0 else rng.uniform(0, 1, (200, 2)) if kind == 1 else np.zeros((50, 2)))
        rows += [(cell, float(a), float(b)) for a, b in p]
    at = {c: np.array([r[1:] for r in rows if r[0] == c]) for c in range(24)}
    pairs = [(a, b) for a in range(24) for b in range(a)]
    radius2 = 0.25
    want = {(a, b) for a, b in pairs if (((at[a][:, None] - at[b][None]) ** 2).sum(2) <= radius2).any()}
    got = CELLS.touching(spark.createDataFrame(rows, "cell long, x double, y double"), spark.createDataFrame(pairs, "a long, b long"), radius2)
    assert {(r.a, r.b) for r in got.collect()} == want and 0 < len(want) < len(pairs)


def test_closest_pair_stacked_points(spark):
    # almost every point on one x value: the y split at the next level applies
    rng = np.random.default_rng(9)
    xy = np.stack([np.round(rng.uniform(size=6000) * 0.001, 6), rng.uniform(size=6000) * 100], axis=1)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "record_id long, x double, y double")
    near = N.closest_pair(df).first()
    order = np.argsort(xy[:, 1])
    s = xy[order]
    best = np.inf
    for k in range(1, 40):
        d = np.hypot(s[k:, 0] - s[:-k, 0], s[k:, 1] - s[:-k, 1])
        d = d[d > 1e-8]
        if len(d):
            best = min(best, d.min())
    assert near["distance"] == pytest.approx(best)


def test_single_link_gives_exactly_k_groups(spark):
    square = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 0.0), (4, 1.0, 1.0)], "record_id long, x double, y double")
    got = {r["record_id"]: r["label"] for r in D.single_link(square, 3).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 2}  # four edges of one length: the first by index joins
    same = spark.createDataFrame([(i, 2.0, 2.0) for i in range(1, 5)] + [(9, 5.0, 5.0)], "record_id long, x double, y double")
    assert {r["record_id"]: r["label"] for r in D.single_link(same, 3).collect()} == {1: 0, 2: 0, 3: 0, 4: 1, 9: 2}


def test_largest_cluster_of_enough_points(spark):
    rows = [(i, 0 if i < 25 else 1 if i < 50 else -1) for i in range(100)]
    df = spark.createDataFrame(rows, "record_id long, label int")
    got = {tuple(r) for r in V.largest_cluster(df).collect()}
    assert got == {(i, 0) for i in range(25)}  # of two equal ones the first; noise is none
    assert V.largest_cluster(df.where("record_id < 19")).count() == 0
    assert V.largest_cluster(df.where("record_id % 2 = 0")).count() == 0  # no cluster has 20 members


def test_visits_come_in_bounded_batches(monkeypatch):
    """Points that visit every ring of many leave a task in batches whose size does not grow with the rings."""
    monkeypatch.setattr(METRIC, "VISIT_ROWS", 50)
    rng = np.random.default_rng(4)
    pivots = rng.normal(size=(40, 8))
    rows = [{"cell": c, "parts": 1, "least": 0.0, "greatest": 9.0} for c in range(40)]
    rings = METRIC.Rings(pivots, rows)
    points = rng.normal(size=(30, 8)).astype(np.float32)
    batch = pa.RecordBatch.from_arrays([pa.array(range(30)), pa.array(points.tolist(), pa.list_(pa.float32())), pa.array([0] * 30, pa.int32()),
                                        pa.array([0] * 30, pa.int32()), pa.array([np.inf] * 30)], ["id", "vec", "ring", "part", "bound"])
    out = list(METRIC._visits(rings, 0, 40)([batch]))
    assert max(b.num_rows for b in out) <= 50 and sum(b.num_rows for b in out) == 30 * 39
    assert sum(b.column(1).to_numpy().sum() for b in METRIC._visitors(rings, 0, 40)([batch])) == 30 * 39


def test_nearest_of_equal_distances_holds_few_differences(monkeypatch):
    """Copies: every pair of a block is a candidate, its differences are formed in slices."""
    monkeypatch.setattr(METRIC, "BLOCK", 64)
    ids, spot = np.arange(40), np.ones((40, 16))
    i, j, d = METRIC.nearest(ids, spot, np.full(40, np.inf), ids, spot, 3)
    assert (d == 0).all() and all(sorted(j[i == x]) == [y for y in range(40) if y != x][:3] for x in range(40))


def test_affinities_of_lists_of_unequal_length(spark):
    """Several slices, against one calibration at a time."""
    rng = np.random.default_rng(5)
    rows = [(i, int(j), r, float(d)) for i in range(2300) for r, (j, d) in enumerate(zip(rng.choice(np.arange(3000, 4000), 2 + i % 4, False), np.sort(rng.uniform(1, 2, 2 + i % 4))), 1)]
    got = {(r["i"], r["j"]): r["p"] for r in N.neighbor_affinity(spark.createDataFrame(rows, "id long, neighbor long, rank int, distance double"), 2300, 2.0).collect()}
    for i in (0, 1, 1023, 1024, 2299):
        own = [(j, d) for x, j, _, d in rows if x == i]
        p = N._calibrate(np.array([[d * d for _, d in own]]), np.ones((1, len(own)), bool), np.log(2.0))[0]
        for (j, _), share in zip(own, p):
            assert got[i, j] == pytest.approx(share / 4600) and got[j, i] == got[i, j]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_knn_of_points_that_no_bound_tells_apart_does_not_move_them(spark, monkeypatch, kind):
    """They would visit most rings; parts meet instead, and what a visit finds is not shuffled. With copies, and an id that comes twice."""
    def travelled(*_):
        raise AssertionError("points travelled to rings")

    monkeypatch.setattr(METRIC, "_searched", travelled)
    monkeypatch.setattr(METRIC, "CELL_ROWS", 25)
    monkeypatch.setattr(METRIC, "MEET_ROWS", 15)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    x[40:70] = x[40]
    ids = np.arange(400) * 7 - 50
    x[399], ids[399] = x[398], ids[398]
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], f"id long, vec array<{kind}>")
    got = {}
    for r in N.knn_graph(df, 5, part_rows=16).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbor"], r["distance"]))
    x = x.astype(float)
    for a, v in zip(ids, x):
        d = np.sqrt(((x - v) ** 2).sum(1))
        copies = 2 if a == ids[398] else 1  # each of its rows finds the same
        want = sorted((d[b], ids[b]) for b in range(400) for _ in range(copies) if ids[b] != a)[:5]
        assert [g[:2] for g in got[a]] == [(r, b) for r, (_, b) in enumerate(want, 1)]
        assert [g[2] for g in got[a]] == pytest.approx([c for c, _ in want], abs=1e-12)


def test_points_that_bounds_tell_apart_still_travel(spark, monkeypatch):
    """On a line few rings are near to a point, so parts do not meet all others."""
    def met(*_):
        raise AssertionError("parts met")

    monkeypatch.setattr(METRIC, "_met", met)
    monkeypatch.setattr(METRIC, "CELL_ROWS", 25)
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(400)], "id long, vec array<double>")
    got = {(r["id"], r["neighbor"]) for r in N.knn_graph(df, 2, part_rows=25).collect()}
    assert got == {(i, j) for i in range(400) for j in ((i - 1, i + 1) if 0 < i < 399 else (1, 2) if i == 0 else (397, 398))}


def test_affinities_of_a_pair_are_summed_once(spark):
    """Both directions of a pair, one that only one side has, and a point that is its own neighbour."""
    rows = [(1, 2, 1, 1.0), (2, 1, 1, 1.0), (3, 1, 1, 2.0), (4, 4, 1, 0.0)]
    got = sorted((r["i"], r["j"], r["p"]) for r in N.neighbor_affinity(spark.createDataFrame(rows, "id long, neighbor long, rank int, distance double"), 4, 2.0).collect())
    assert got == [(1, 2, 0.25), (1, 3, 0.125), (2, 1, 0.25), (3, 1, 0.125), (4, 4, 0.25)]
