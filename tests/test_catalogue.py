from cohortlens.functions import catalogue as CT
from cohortlens.operators import integrate as I
from cohortlens.operators import privacy as PV


def test_family_members_and_questions(spark):
    cat = CT.catalogue(spark, ["age", "bw_gdt_1", "intake_wemwbs_6", "has_xbox", "num_telemetry_platforms",
                               "xbox_total_sessions", "other"])
    fam = {(r["family"], r["column"]) for r in CT.family_members(cat).collect()}
    assert ("gaming disorder items", "bw_gdt_1") in fam
    assert ("availability flags", "has_xbox") in fam and ("availability flags", "num_telemetry_platforms") in fam
    assert not any(c == "other" for _, c in fam)
    q = {r["column"]: r["measure"] for r in CT.question_info(cat).collect()}
    assert q["bw_gdt_1"] == "Gaming Disorder Test" and q["intake_wemwbs_6"] == "WEMWBS" and q["age"] is None
    assert [r["column"] for r in CT.search_columns(cat, "XBOX").collect()] == ["has_xbox", "xbox_total_sessions"]


def test_vector_choice_and_groups():
    types = {"a": "numeric", "b": "numeric", "c": "categorical", "r1": "numeric", "r2": "numeric"}
    assert CT.effective_vector(["a", "c", "b"], types, list(types), ["r2", "r1"]) == ["a", "b"]
    assert CT.effective_vector(["a"], types, list(types), ["r2", "zz", "r1"]) == ["r2", "r1"]
    assert CT.add_group(["a", "g1"], ["g1", "g2"], "gt") == ["a", "g1", "g2", "gt"]


def test_round_output_and_release_note(spark):
    df = spark.createDataFrame([(1, 1.23456, 2)], "record_id long, v double, n int")
    r = I.round_output(df).first()
    assert r["v"] == 1.235 and r["n"] == 2
    note = PV.release_note(df).first()
    assert note["final_rows"] == 1 and note["final_columns"] == 3 and note["rare_category_threshold"] == 10
