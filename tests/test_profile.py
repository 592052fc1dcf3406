import pytest

from cohortlens.operators import profile as PR
from cohortlens.operators import relate as RL


def test_pearson_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (3.0, 6.0)], "a double, b double")
    r = RL.pearson(df, "a", "b").first()
    assert r["n"] == 2 and r["r"] == pytest.approx(1.0)
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "a double, b double")
    assert RL.pearson(const, "a", "b").first()["r"] is None
    one = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    assert RL.pearson(one, "a", "b").first()["r"] is None


def test_profile_std_zero_and_missing(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    p = PR.column_profile(df, ["x"]).first()
    assert p["std"] == 0.0 and p["missing"] == 1 and p["type"] == "numeric"
    assert p["skewness"] is None and p["unique"] == 1


def test_floor_rank_quartiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    q = PR.quartiles(df, ["x"]).first()
    assert (q["q1"], q["q3"], q["median"], q["n"]) == (2.0, 10.0, 2.5, 4)


def test_quartiles_many_partitions(spark):
    import random
    random.seed(3)
    vals = [float(random.randint(0, 50)) for _ in range(2001)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    q = PR.quartiles(df, ["x"]).first()
    s = sorted(vals)
    n = len(s)
    assert q["q1"] == s[n // 4] and q["q3"] == s[(3 * n) // 4] and q["median"] == s[n // 2]


def test_infer_types_rule(spark):
    df = spark.createDataFrame([("1", "a", None), ("2", "b", None), ("x", "3", None), ("4", "c", None)],
                               "p string, q string, r string")
    t = {r["column"]: r["type"] for r in PR.infer_types(df).collect()}
    # 3 of 4 parse (75 %, not above): categorical; all-missing: categorical
    assert t == {"p": "categorical", "q": "categorical", "r": "categorical"}
    df2 = spark.createDataFrame([("1",), ("2",), ("3",), ("4",), ("x",)], "p string")
    assert PR.infer_types(df2).first()["type"] == "numeric"


def test_top_values_and_entropy(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "b", "a", "10", "2", "c"]], "v string")
    top = PR.top_values(PR.frequencies(df, ["v"])).orderBy("rank").collect()
    # ties: integer-like keys first (ascending), then text
    assert [r["value"] for r in top] == ["a", "b", "2", "10", "c"]
    ent = PR.entropy(PR.frequencies(df, ["v"])).first()["entropy"]
    assert ent == pytest.approx(-(2 * (2 / 7) * __import__("math").log2(2 / 7) + 3 * (1 / 7) * __import__("math").log2(1 / 7)))


def test_item_groups():
    cols = ["bw_gdt_2", "bw_gdt_1", "gdt_total", "bfi_2_xs_1", "bfi_2_xs_3", "has_1", "has_2", "alone_1"]
    groups = PR.item_groups(cols)
    assert [g["name"] for g in groups] == ["BFI", "GDT"]
    gdt = groups[1]
    assert gdt["items"] == ["bw_gdt_1", "bw_gdt_2"] and gdt["total_col"] == "gdt_total"


def test_rank_stats_by_radix_selection(spark):
    """Few and many values, signs, both zeros, neighbouring doubles, powers far apart, copies, nulls, and a column without values."""
    import math
    import random
    import struct

    random.seed(11)
    near = struct.unpack("<d", struct.pack("<q", struct.unpack("<q", struct.pack("<d", 1.0))[0] + 1))[0]
    columns = {
        "few": [float(random.randint(-3, 30)) for _ in range(3001)],
        "many": [random.gauss(0, 1) for _ in range(3001)],
        "far": [random.choice([-1, 1]) * 10.0 ** random.randint(-300, 300) for _ in range(3001)],
        "near": [random.choice([1.0, near, -0.0, 0.0]) for _ in range(3001)],
        "hot": [7.25 if i % 3 else random.random() for i in range(3001)],
        "gaps": [random.random() if random.random() < 0.1 else None for _ in range(3001)],
        "one": [None] * 3000 + [5.0],
        "none": [None] * 3001,
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    got = {r["column"]: r for r in PR.rank_stats(df, list(columns)).collect()}
    assert set(got) == set(columns) - {"none"}
    for c in got:
        v = sorted(x for x in columns[c] if x is not None)
        n = len(v)
        want = (n, (v[(n - 1) // 2] + v[n // 2]) / 2, v[math.floor(n / 4)], v[math.floor(3 * n / 4)])
        assert (got[c]["n"], got[c]["median"], got[c]["q1"], got[c]["q3"]) == want, c
    assert PR.rank_stats(df.limit(0), ["few"]).count() == 0


def test_correlation_gram_matches_aggregates(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    n = 400
    a = rng.normal(size=n) * 1000 + 5e5
    b = a * 0.3 + rng.normal(size=n) * 50
    c = rng.normal(size=n)
    d = np.where(np.arange(n) % 3 == 0, 7.0, rng.normal(size=n))  # constant where e is present
    e = np.where(np.arange(n) % 3 == 0, 1.0, np.nan)
    rows = []
    for i in range(n):
        vals = [None if (i % 5 == 0) else float(a[i]), float(b[i]), None if i % 7 == 0 else float(c[i]),
                float(d[i]), None if np.isnan(e[i]) else float(e[i])]
        rows.append(tuple(vals))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(4)
    cols = ["a", "b", "c", "d", "e"]
    agg = {(r["x"], r["y"]): r for r in RL.correlation_matrix(df, cols, method="aggregate").collect()}
    gram = {(r["x"], r["y"]): r for r in RL.correlation_matrix(df, cols, method="gram").collect()}
    assert set(agg) == set(gram)
    for k, r in agg.items():
        g = gram[k]
        assert r["n"] == g["n"], k
        if r["r"] is None:
            assert g["r"] is None, (k, g["r"])
        else:
            assert g["r"] == pytest.approx(r["r"], rel=1e-9, abs=1e-12), k


def test_correlations_of_a_vector_of_variables_take_two_passes(spark, monkeypatch):
    """19 columns: the Gram form, with the r of the pairwise aggregates."""
    from cohortlens.operators import relate

    rows = [tuple(float((i * (c + 3)) % (7 + c)) if (i + c) % 5 else None for c in range(19)) for i in range(60)]
    cols = [f"v{c}" for c in range(19)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    want = {(r["x"], r["y"]): r for r in relate.correlation_matrix(df, cols, False, "aggregate").collect()}
    monkeypatch.setattr(relate, "_pair_aggs", None)  # not to be called
    got = relate.correlation_matrix(df, cols, False).collect()
    assert len(got) == len(want) == 19 * 18
    for r in got:
        w = want[r["x"], r["y"]]
        assert r["n"] == w["n"] and (r["r"] is None) == (w["r"] is None) and (r["r"] is None or abs(r["r"] - w["r"]) < 1e-9)
