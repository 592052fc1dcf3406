import gzip
import io
import os
import tempfile
import zipfile

from cohortlens.sources import readers as RD
from cohortlens.sources import sinks as SK


def test_detect_file_type():
    assert [RD.detect_file_type(n) for n in ["a.ZIP", "b.csv.gz", "c.CSV", "d.txt"]] == ["zip", "csv.gz", "csv", None]


def test_archive_ingest_skips_bad_members(spark):
    folder = tempfile.mkdtemp(prefix="zip-")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("data/survey_daily_raw.csv", "pid,played24hr\np1,1\n\np2,TRUE\n")
        zf.writestr("data/timeuse_raw.csv.gz", gzip.compress(b"pid,date,activity\np1,2024-01-01,Gaming\n"))
        zf.writestr("data/broken.csv.gz", b"not gzip at all")
        zf.writestr("notes.txt", "ignored")
    with open(os.path.join(folder, "bundle.zip"), "wb") as f:
        f.write(buf.getvalue())
    tables, errors = RD.read_archive(spark, folder)
    assert sorted(tables) == ["survey_daily_raw.csv", "timeuse_raw.csv.gz"]
    daily = sorted(tuple(r) for r in tables["survey_daily_raw.csv"].collect())
    assert daily == [("p1", "1"), ("p2", "TRUE")]
    assert tables["timeuse_raw.csv.gz"].columns == ["pid", "date", "activity"]
    errs = errors.collect()
    assert len(errs) == 1 and errs[0]["member"] == "broken.csv.gz"


def test_csv_sink_and_record_id_backfill(spark):
    folder = tempfile.mkdtemp(prefix="csv-")
    df = spark.createDataFrame([("a,b", 1.0), ('say "hi"', None), ("", 2.5)], "t string, v double")
    SK.write_csv(df.coalesce(1), os.path.join(folder, "out"))
    text = "".join(open(os.path.join(folder, "out", f)).read() for f in os.listdir(os.path.join(folder, "out"))
                   if f.endswith(".csv"))
    assert text.splitlines() == ["t,v", '"a,b",1.0', '"say ""hi""",', ",2.5"]
    back = RD.read_csv_with_record_id(spark, os.path.join(folder, "out"))
    assert back.columns == ["record_id", "t", "v"]
    assert [r["record_id"] for r in back.orderBy("record_id").collect()] == [1, 2, 3]


def test_folder_listing(spark):
    folder = tempfile.mkdtemp(prefix="dir-")
    for name in ["x.csv", "y.csv.gz", "z.txt"]:
        data = b"pid\np1\n"
        with open(os.path.join(folder, name), "wb") as f:
            f.write(gzip.compress(data) if name.endswith(".gz") else data)
    tables = RD.read_folder(spark, folder)
    assert sorted(tables) == ["x.csv", "y.csv.gz"]
    assert tables["y.csv.gz"].collect()[0]["pid"] == "p1"


def test_fingerprinted_cache(spark):
    folder = tempfile.mkdtemp(prefix="cache-")
    src = os.path.join(folder, "in.csv")
    with open(src, "w") as f:
        f.write("pid,v\np1,1\n")
    key = RD.fingerprint(spark, [src])
    calls = []

    def build():
        calls.append(1)
        return RD.read_csv(spark, src)

    a = RD.cached_table(spark, build, os.path.join(folder, "store"), key)
    b = RD.cached_table(spark, build, os.path.join(folder, "store"), key)
    assert a.count() == b.count() == 1 and len(calls) == 1
    with open(src, "w") as f:
        f.write("pid,v\np1,1\np2,2\n")
    assert RD.fingerprint(spark, [src]) != key


def test_kmeans_best_of(spark):
    from cohortlens.operators import cluster as C
    df = spark.createDataFrame([(i, float(i % 2) * 10 + i * 0.01, 0.0) for i in range(20)],
                               "record_id long, x double, y double")
    best = C.kmeans_best_of(df, ["x", "y"], 2, n_init=3, seed=1)
    assert sorted(best.counts.tolist()) == [10, 10]


def test_file_order_across_files_and_splits(spark):
    folder = tempfile.mkdtemp(prefix="order-")
    expected = []
    for f in range(3):
        lines = ["k,v"] + [f"f{f}_{i},{i}" for i in range(2000)]
        expected += [ln.split(",")[0] for ln in lines[1:]]
        with open(os.path.join(folder, f"part{f}.csv"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many splits per file
    try:
        df = RD.read_csv(spark, folder)
        got = [r["k"] for r in RD.with_file_order(df, "n").orderBy("n").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == expected


def test_source_inventory_counts(spark):
    from cohortlens.operators import integrate as I
    a = spark.createDataFrame([("p1",), ("p2",)], "pid string")
    b = spark.createDataFrame([("p1",)], "pid string")
    inv = {r["block"]: (r["rows"], r["used"]) for r in I.source_inventory({"intake": a, "extra": b}).collect()}
    assert inv == {"intake": (2, True), "extra": (1, False)}


def test_row_index_is_dense_over_many_partitions(spark):
    from cohortlens.sources.rowindex import with_row_index

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        wide = spark.range(1_000_000).selectExpr("id", "md5(cast(id as string)) a", "sha1(cast(id as string)) b", "repeat('x', 40) c")
        got = with_row_index(wide, order_by=["a"])
        row = got.selectExpr("count(*) n", "count(row_index) filled", "count(distinct row_index) d", "min(row_index) lo", "max(row_index) hi").first()
        assert tuple(row) == (1_000_000, 1_000_000, 1_000_000, 1, 1_000_000)
        first = [r["a"] for r in got.where("row_index <= 50").orderBy("row_index").collect()]
        assert first == [r["a"] for r in wide.orderBy("a").limit(50).collect()]
        assert with_row_index(wide.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_gzip_rows_keep_file_order_when_spread(spark, tmp_path):
    import gzip

    from cohortlens.sources.readers import read_csv_with_record_id

    path = tmp_path / "x.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("a\n" + "".join(f"v{k}\n" for k in range(500)))
    rows = read_csv_with_record_id(spark, str(path), partitions=4)
    assert rows.rdd.getNumPartitions() == 4
    assert sorted((r["record_id"], r["a"]) for r in rows.collect()) == [(k + 1, f"v{k}") for k in range(500)]
