from pyspark.sql import functions as F

from cohortlens.operators import interpret as IN
from cohortlens.operators import privacy as PV
from cohortlens.sources.rowindex import with_row_index

FEATURES = ["num_platforms", "num_telemetry_platforms", "telem_nocturnal_sessions", "telem_total_sessions",
            "promis_total", "wemwbs_total", "gdt_total", "bangs_total", "timeuse_gaming_entries",
            "timeuse_num_days"]
BASE = dict(num_platforms=1, num_telemetry_platforms=1, telem_nocturnal_sessions=5, telem_total_sessions=20,
            promis_total=20, wemwbs_total=25, gdt_total=3, bangs_total=60, timeuse_gaming_entries=5,
            timeuse_num_days=5)
GROUPS = [("multi", {"num_platforms": 9, "num_telemetry_platforms": 8}),
          ("base", {}),
          ("intensity", {"telem_nocturnal_sessions": 600, "telem_total_sessions": 1200}),
          ("risk", {"promis_total": 80, "wemwbs_total": 3, "gdt_total": 18, "bangs_total": 120,
                    "timeuse_gaming_entries": 90, "timeuse_num_days": 40})]


def profile_rows(spark):
    rows = []
    for name, over in GROUPS:
        for i in range(12):
            vals = {k: float(over.get(k, v)) + (0.01 * i if k in over else 0.0) for k, v in BASE.items()}
            rows.append((f"{name}-{i}", *[vals[f] for f in FEATURES]))
    return spark.createDataFrame(rows, "record_id string, " + ", ".join(f"{f} double" for f in FEATURES))


def test_official_run_canonical_names(spark):
    run = IN.official_run(profile_rows(spark), FEATURES)
    lab = {r["record_id"]: r["label"] for r in run.labels.collect()}
    assert lab["multi-0"] == 0 and lab["base-0"] == 1 and lab["intensity-0"] == 2 and lab["risk-0"] == 3
    assert sorted(r["count"] for r in run.clusters.collect()) == [12, 12, 12, 12]
    again = IN.official_run(profile_rows(spark), FEATURES)
    assert {r["record_id"]: r["label"] for r in again.labels.collect()} == lab
    assert IN.run_matches(run.manifest, profile_rows(spark), run.features)


def test_rare_suppression_and_publish(spark):
    rows = [(i, "pid%d" % i, 21.0 + i % 9, "A" if i < 10 else "B", " X " if i < 9 else "Y") for i in range(19)]
    rows.append((19, "pid19", None, "", None))
    df = spark.createDataFrame(rows, "record_id long, pid string, age double, gender string, country string")
    out = PV.publish(df.withColumn("cohort", F.lit("c"))).orderBy("record_id").collect()
    assert "pid" not in out[0].asDict() and "cohort" not in out[0].asDict()
    g = [r["gender"] for r in out]
    assert g[:10] == ["A"] * 10 and g[10:19] == ["Other"] * 9 and g[19] is None
    c = [r["country"] for r in out]
    assert c[:9] == ["Other"] * 9 and c[9:19] == ["Y"] * 10 and c[19] is None
    assert out[19]["age"] is None and out[0]["age"] == 20.0
    assert [r["record_id"] for r in out] == list(range(1, 21))


def test_published_numbers_follow_a_keyed_hash(spark):
    import hashlib

    df = spark.createDataFrame([(i, f"p{i}", float(i)) for i in range(1, 31)], "record_id long, pid string, height double")
    df = df.withColumn("kept", F.col("record_id") * 10)
    out = PV.publish(df, shuffle_key="k")
    assert out.columns == ["record_id", "kept"]
    order = sorted(range(1, 31), key=lambda i: hashlib.sha256(f"k:{i}".encode()).hexdigest())
    assert {r["record_id"]: r["kept"] for r in out.collect()} == {n: i * 10 for n, i in enumerate(order, 1)}
    assert order != sorted(order) and order != sorted(range(1, 31), key=lambda i: hashlib.sha256(f"other:{i}".encode()).hexdigest())


def test_row_index_dense_in_order(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("v"))
    out = with_row_index(df, "ri", order_by=["v"]).orderBy("v").collect()
    assert [r["ri"] for r in out] == list(range(1, 1001))
