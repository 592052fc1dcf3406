from cohortlens.operators import filters as FL


def fixture(spark):
    return spark.createDataFrame(
        [(1, 20.0, "A"), (2, 30.0, "A"), (3, None, "A"), (4, 25.0, "B")],
        "record_id int, age double, group string")


def ids(df):
    return sorted(r[0] for r in df.select("record_id").collect())


def test_combined_filter_with_selection(spark):
    df = fixture(spark)
    sel = spark.createDataFrame([(2,), (4,)], "id int")
    f = {"age": FL.ColumnFilter(min=21, max=30, include_missing=False),
         "group": FL.ColumnFilter(values=["A"])}
    assert ids(FL.filter_rows(df, f, selected=sel)) == [2]


def test_missing_passes_range_unless_excluded(spark):
    df = fixture(spark)
    assert ids(FL.filter_rows(df, {"age": FL.ColumnFilter(min=21, max=30)})) == [2, 3, 4]
    assert ids(FL.filter_rows(df, {"age": FL.ColumnFilter(min=21, max=30, include_missing=False)})) == [2, 4]


def test_missing_skips_category_when_range_set(spark):
    df = fixture(spark)
    f = {"age": FL.ColumnFilter(min=0, max=100, values=["30"])}
    # row 3 is missing: it passes the range test and skips the category test
    assert ids(FL.filter_rows(df, f)) == [2, 3]


def test_complete_cases_and_preview(spark):
    df = fixture(spark)
    assert ids(FL.complete_cases(df, ["age"])) == [1, 2, 4]
    page = FL.preview_page(df, page=1, size=2)
    assert [r["record_id"] for r in page.collect()] == [3, 4]


def test_participant_detail(spark):
    df = fixture(spark)
    out = FL.participant_detail(df, 3, {"main": ["age", "group"]}).collect()
    assert [(r["field"], r["value"]) for r in out] == [("group", "A")]
