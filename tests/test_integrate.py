from cohortlens.operators import integrate as I


def test_cohort_filter_and_daily_counts(spark):
    intake = spark.createDataFrame(
        [("p1", "TRUE", "30", "f", "ES"), ("p2", "FALSE", "40", "m", "ES"), ("p3", "1", "", "", "")],
        "pid string, qualified string, age string, gender string, country string")
    daily = spark.createDataFrame([("p1", "1", "TRUE"), ("p1", "0", "1"), ("p2", "1", "1"), ("zz", "1", "1")],
                                  "pid string, played24hr string, had_stress string")
    wide = I.integrate({"intake": intake, "daily": daily})
    rows = {r["pid"]: r for r in wide.collect()}
    assert sorted(rows) == ["p1", "p3"]
    assert rows["p1"]["daily_num_responses"] == 2 and rows["p1"]["daily_played_days"] == 1
    assert rows["p1"]["daily_stress_days"] == 2
    assert rows["p3"]["daily_num_responses"] is None and rows["p3"]["has_daily"] == 0
    assert rows["p3"]["age"] is None and rows["p3"]["gender"] is None
    assert sorted(r["record_id"] for r in rows.values()) == [1, 2]
    # absent source -> absent columns
    assert "xbox_total_sessions" not in wide.columns


def test_duplicate_pid_last_row_wins(spark):
    intake = spark.createDataFrame([("p1", "TRUE", "30", 1), ("p2", "TRUE", "20", 2), ("p1", "1", "50", 3)],
                                   "pid string, qualified string, age string, row_index long")
    out = {r["pid"]: r for r in I.intake_rows(intake, row_index="row_index").collect()}
    assert out["p1"]["age"] == 50.0 and out["p1"]["record_id"] == 1 and out["p2"]["record_id"] == 2


def test_first_wave_ties_and_count(spark):
    bw = spark.createDataFrame([("p", "2", 1, "a"), ("p", "0", 2, "b"), ("p", "2", 3, "c"), ("q", "", 4, "d")],
                               "pid string, wave string, row_index long, v string")
    out = {r["pid"]: r for r in I.first_wave(bw).collect()}
    assert out["p"]["v"] == "a" and out["p"]["num_waves"] == 3
    assert out["q"]["v"] == "d"


def test_scale_totals_threshold(spark):
    def row(pid, answered):
        vals = ["1"] * answered + [""] * (18 - answered)
        return (pid, "1", 1, *vals, "1", "2", "3", "4")
    cols = ", ".join(f"bangs_{i} string" for i in range(1, 19))
    bw = spark.createDataFrame([row("a", 17), row("b", 15), row("c", 14)],
                               f"pid string, wave string, row_index long, {cols}, gdt_1 string, gdt_2 string, gdt_3 string, gdt_4 string")
    out = {r["pid"]: r for r in I.biweekly_features(bw).collect()}
    assert out["a"]["bangs_total"] == 17.0 and out["b"]["bangs_total"] == 15.0
    assert out["c"]["bangs_total"] is None
    assert out["a"]["gdt_total"] == 10.0 and out["a"]["promis_total"] is None


def test_present_but_empty_rule(spark):
    s = spark.createDataFrame([("p", "NA", "2024-01-01T23:00:00", None), ("p", "x", "2024-01-01T10:00:00", "g")],
                              "pid string, duration string, session_start string, title_id string")
    r = I.session_features(s, "xbox").first()
    assert r["xbox_total_sessions"] == 0 and r["xbox_total_duration_min"] == 0.0
    assert r["xbox_mean_session_min"] is None and r["xbox_max_session_min"] is None
    # nocturnal counts rows even with an invalid duration; '' counts as a title
    assert r["xbox_nocturnal_sessions"] == 1 and r["xbox_unique_games"] == 2


def test_dictionary_rules(spark):
    wide = spark.createDataFrame([(1, "a", None, 2.0)], "record_id long, pid string, bw_gdt_1 double, xbox_total_sessions double")
    d = {r["variable"]: r for r in I.data_dictionary(wide).collect()}
    assert d["bw_gdt_1"]["original_column"] == "gdt_1" and d["bw_gdt_1"]["aggregation"] == "first_wave"
    assert d["bw_gdt_1"]["missing_values"] == 1
    assert d["xbox_total_sessions"]["source_file"] == "telemetry_xbox_raw.csv.gz"
    assert d["pid"]["aggregation"] == "direct"


def test_cohort_filter_holds_for_large_key_sets(spark):
    from cohortlens.operators.integrate import restrict_to_cohort

    rows, keys = spark.range(100).selectExpr("cast(id % 10 as string) pid", "id"), spark.createDataFrame([("1",), ("2",)], "pid string")
    small, large = (restrict_to_cohort(rows, keys, broadcastable=b).orderBy("id").collect() for b in (True, False))
    assert small == large and len(small) == 20


def test_cells_go_through_joins_in_arrays(spark):
    """Only items that the table has are carried and parsed, in one array; intake cells are parsed after the last row is known."""
    bw = spark.createDataFrame([("p", "1", 1, "2", "never"), ("p", "2", 2, "3", "often")], "pid string, wave string, row_index long, gdt_1 string, life_sat string")
    rows, columns = I._packed_biweekly(bw, "pid", "wave", "row_index", None)
    assert rows.columns == ["pid", "_items", "bw_num_waves"] and rows.first()["_items"] == [2.0, 0.0]
    assert len(columns) == len(I.BIWEEKLY_COLUMNS) + 1 + len(I.SCALE_ITEMS) + len(I.THRESHOLD_SCALES)
    out = I.biweekly_features(bw).first()
    assert (out["bw_gdt_1"], out["bw_life_sat"], out["bw_gdt_2"], out["gdt_total"], out["bangs_total"], out["bw_num_waves"]) == (2.0, 0.0, None, None, None, 2)
    intake = spark.createDataFrame([("p", "1", "31", "never", "", 1), ("q", "TRUE", "x", " Often", "f", 2)], "pid string, qualified string, age string, life_sat string, gender string, row_index long")
    packed, _ = I._packed_intake(intake, "pid", "row_index", None)
    assert {r["pid"]: r["_cells"] for r in packed.collect()} == {"p": [31.0, 0.0], "q": [None, 3.0]}
    wide = {r["pid"]: r for r in I.integrate({"intake": intake, "biweekly": bw}, intake_row_index="row_index").collect()}
    assert (wide["p"]["intake_life_sat"], wide["p"]["gender"], wide["q"]["gender"], wide["q"]["bw_gdt_1"], wide["q"]["bw_num_waves"], wide["q"]["has_biweekly"]) == (0.0, None, "f", None, None, 0)


def test_wide_table_is_materialised_with_the_columns_read(spark, monkeypatch):
    """Analyses stage what they read; the catalogue of names stages no rows."""
    from cohortlens.plans import q_catalog, q_integration

    staged = []
    monkeypatch.setattr(q_integration, "sources", lambda spark, sf_dir: {})
    monkeypatch.setattr(q_integration.I, "integrate", lambda *a, **k: spark.createDataFrame([(1, 2.0, 3.0, "x")], "record_id long, bw_gdt_1 double, bw_gdt_2 double, pid string"))
    monkeypatch.setattr(q_integration, "cut_lineage", lambda df: staged.append(df.columns) or df)
    assert q_integration.wide_table(spark, "", columns=["record_id", "pid", "absent"]).columns == ["record_id", "pid"]
    assert q_integration.wide_table(spark, "").columns == ["record_id", "bw_gdt_1", "bw_gdt_2", "pid"]
    assert staged == [["record_id", "pid"], ["record_id", "bw_gdt_1", "bw_gdt_2", "pid"]]
    q_catalog.item_groups(spark, "").collect()
    assert len(staged) == 2


def _answered(spark):
    """Two persons with the items of three totals and one without; as a plan, and materialised."""
    from cohortlens.session import cut_lineage

    items = [f"{p}_{i}" for p, n in (("gdt", 4), ("promis", 8), ("wemwbs", 7)) for i in range(1, n + 1)]
    bw = spark.createDataFrame([("p1", "1", 1, *"1" * 19), ("p2", "1", 2, *"2" * 18, "")], "pid string, wave string, row_index long, " + ", ".join(f"{c} string" for c in items))
    intake = spark.createDataFrame([("p1", "TRUE", "31", "f", 1), ("p2", "1", "44", "f", 2), ("p3", "1", "", " ", 3)], "pid string, qualified string, age string, gender string, row_index long")
    wide = I.integrate({"intake": intake, "biweekly": bw}, intake_row_index="row_index")
    return wide, cut_lineage(wide)


def _plan_constraints(df):
    return df._jdf.queryExecution().optimizedPlan().validConstraints().size()


def test_totals_add_few_plan_constraints_to_readiness(spark):
    """A total of n items once gave the plan 2^n constraints when the wide table was materialised."""
    from cohortlens.operators import quality as QA

    wide, cut = _answered(spark)
    assert _plan_constraints(wide) < 2 * len(wide.columns)
    rows = {r["pid"]: (r["gdt_total"], r["promis_total"], r["wemwbs_total"], r["bangs_total"]) for r in cut.collect()}
    assert rows == {"p1": (4.0, 8.0, 7.0, None), "p2": (8.0, 16.0, None, None), "p3": (None, None, None, None)}
    out = QA.readiness(cut.select("age", "gender", "gdt_total", "bw_gdt_1")).first()
    assert (out["columns"], out["numeric"], out["categorical"], out["top_missing"], out["ready"]) == (4, 3, 1, "", False)


def test_types_of_a_materialised_table_with_totals(spark):
    """What infer_types reads has few plan constraints, and its rows are those of the plan."""
    from cohortlens.operators import profile as PR

    wide, cut = _answered(spark)
    assert _plan_constraints(wide) < 2 * len(wide.columns)
    types = {r["column"]: (r["non_missing"], r["numeric_values"], r["type"]) for r in PR.infer_types(cut).collect()}
    assert len(types) == len(wide.columns)
    assert types["gdt_total"] == (2, 2, "numeric") and types["wemwbs_total"] == (1, 1, "numeric")
    assert types["bangs_total"] == (0, 0, "categorical") and types["pid"] == (3, 0, "categorical") and types["age"] == (2, 2, "numeric")


def test_publish_of_a_table_with_totals(spark):
    """Publishing works from a plan with few constraints, and drops, renumbers and generalises as before."""
    from cohortlens.operators import privacy as PV

    wide, cut = _answered(spark)
    assert _plan_constraints(wide) < 2 * len(wide.columns)
    out = PV.publish(cut, shuffle_key="k")
    assert not set(out.columns) & set(PV.REMOVED_COLUMNS)
    rows = {r["promis_total"]: (r["age"], r["gender"]) for r in out.collect()}
    assert rows == {8.0: (30, "Other"), 16.0: (45, "Other"), None: (None, None)}
    assert sorted(r["record_id"] for r in out.collect()) == [1, 2, 3]


def test_release_note_of_a_table_with_totals(spark):
    """The note is counted from the published table, and its plan has few constraints."""
    from cohortlens.operators import privacy as PV

    wide, cut = _answered(spark)
    assert _plan_constraints(wide) < 2 * len(wide.columns)
    note = PV.release_note(PV.publish(cut, shuffle_key="k")).first()
    removed = [c for c in wide.columns if c in PV.REMOVED_COLUMNS]
    assert removed and (note["final_rows"], note["final_columns"]) == (3, len(wide.columns) - len(removed))
