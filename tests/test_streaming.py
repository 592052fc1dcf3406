import os
import tempfile

from cohortlens.operators import integrate as I
from cohortlens.streaming import telemetry as ST


def test_streaming_session_features_equal_batch(spark):
    rows = [("p1", "10", "2024-01-01T23:10:00", "a"), ("p1", "NA", "2024-01-01T02:00:00", None),
            ("p2", "5.5", "2024-01-01T12:00:00", "b"), ("p1", "20", "2024-01-02T08:00:00", "b"),
            ("p2", "", "bad", "b"), ("p3", "x", "2024-01-03T22:30:00", "")]
    df = spark.createDataFrame(rows, ST.RAW_SCHEMA)
    base = tempfile.mkdtemp(prefix="stream-src-")
    df.limit(3).coalesce(1).write.mode("overwrite").option("header", True).csv(os.path.join(base, "a"))
    df.subtract(df.limit(3)).coalesce(1).write.mode("overwrite").option("header", True).csv(os.path.join(base, "b"))
    folder = os.path.join(base, "all")
    os.makedirs(folder)
    n = 0
    for sub in ("a", "b"):
        for f in os.listdir(os.path.join(base, sub)):
            if f.endswith(".csv"):
                os.rename(os.path.join(base, sub, f), os.path.join(folder, f"part{n}.csv"))
                n += 1
    ckpt = tempfile.mkdtemp(prefix="stream-ckpt-")
    got = ST.run_to_table(spark, folder, os.path.join(base, "out"), ckpt, "xbox", max_files_per_batch=1)
    latest = {r["pid"]: r.asDict() for r in got.collect()}
    want = {r["pid"]: r.asDict() for r in I.session_features(df, "xbox").collect()}
    assert set(latest) == set(want)
    for pid, w in want.items():
        g = latest[pid]
        for k, v in w.items():
            assert g[k] == v, (pid, k, g[k], v)
