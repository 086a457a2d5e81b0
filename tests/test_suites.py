"""Whole runs from a configuration."""

from pyspark.sql import functions as F

from twinledger.plans.suites import run_csv, run_models, run_views, settings_from

DEFAULTS = {"diff_threshold_pct": 0.5, "sample_rows": 5, "skip_blocked": ["REMOVAL"]}


def test_models(spark):
    rows = spark.range(400).select(
        F.col("id").alias("ID"), F.lit("a").alias("client_name"), F.lit("EU").alias("client_region"), F.lit("x").alias("V")
    )
    gone = rows.withColumn("client_name", F.when(F.col("ID") < 100, F.lit("left us")).otherwise(F.lit("a")))
    tables = {("P", "SAME"): rows, ("U", "SAME"): rows, ("P", "TENANTS"): gone, ("U", "TENANTS"): gone.where("client_name = 'a'"),
              ("P", "OPEN"): gone, ("U", "OPEN"): gone.where("client_name = 'a'"), ("P", "LATE"): rows}
    cfg = {
        "environments": {"prod_db": "P", "uat_db": "U", "schema": "BI",
                         "active_tenants": spark.createDataFrame([("a", "EU")], "client_name string, client_region string")},
        "defaults": DEFAULTS,
        "tables": [
            {"name": "SAME", "grain": ["ID"], "expected_blocked": ["GRAIN"]},
            {"name": "TENANTS", "grain": ["ID"]},
            {"name": "OPEN", "grain": ["ID"], "tenant_join": False},
            {"name": "OLD", "grain": ["ID"], "expected_blocked": ["removal"]},
            {"name": "LATE", "grain": ["ID"]},
        ],
    }
    out = run_models(spark, cfg, open_side=lambda side, t: tables.get((side, t)))
    got = [(r.view, r.verdict) for r in out.views.collect()]
    assert got == [("SAME", "PASS"), ("TENANTS", "PASS"), ("OPEN", "DIFFS FOUND"), ("OLD", "BLOCKED"), ("LATE", "BLOCKED")]
    notes = {r.view: r.notes for r in out.views.collect()}
    assert "REMOVAL" in notes["OLD"][0] and notes["LATE"] == ["absent on the right"]
    only = run_models(spark, cfg, tables="same", open_side=lambda side, t: tables.get((side, t)))
    assert [r.view for r in only.views.collect()] == ["SAME"]


def test_views(spark):
    rows = spark.range(10).select(F.col("id").alias("ID"), F.lit("x").alias("NOTE"))
    other = rows.withColumn("NOTE", F.lit("y"))
    cfg = {
        "dwi": {"prod_db": "P.S", "uat_db": "U.S", "schema": "S"}, "defaults": {},
        "views": [{"name": "one", "grain": ["id"], "accepted_columns": [{"column": "note", "reason": "format"}]},
                  {"name": "dwi_two", "grain": [], "clients": ["x"]}],
    }
    tables = {("P.S", "DWI_ONE"): rows, ("U.S", "DWI_ONE"): other, ("P.S", "DWI_TWO"): rows, ("U.S", "DWI_TWO"): rows}
    out = run_views(spark, cfg, open_side=lambda side, t: tables.get((side, t)))
    assert [(r.view, r.verdict) for r in out.views.collect()] == [
        ("DWI_ONE", "PASS (DIFFS ACCEPTED)"), ("DWI_TWO", "PASS (NO GRAIN)"),
    ]


def test_csv(spark, tmp_path):
    def put(path, text="ID,client_name,status\n1,uat1,active\n2,uat1,yes\n"):
        f = tmp_path / path
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(text)

    for view in ("enrolment", "mine_only", "syd_uat1"):
        put(f"left/uat1/20260729132200/{view}.csv")
    put("right/uat1/20260729224500/enrolment.csv", "id,client_name,status\n1,uat1,active\n2,uat1,TRUE\n")
    put("right/uat1/20260729224500/syd_uat1.csv", "id,client_name,status\n1,uat1,active\n2,uat1,other\n")
    put("left/locked/20260729132200/enrolment.csv.pgp")
    put("right/locked/20260729224500/enrolment.csv")
    cfg = {
        "defaults": {"sample_rows": 5},
        "csv": {"left_base": f"file:{tmp_path}/left", "right_base": f"file:{tmp_path}/right", "clients": ["uat1", "locked", "nobody"],
                "default_grain": ["id"], "normalisation": {"trim_text": True}},
        "views": [{"name": "enrolment"}, {"name": "DWI_SYD_UAT1", "clients": ["UAT1"]}, {"name": "syd_sonder", "clients": ["sonder"]},
                  {"name": "phantom", "absent_note": "no such view"}],
    }
    out = run_csv(spark, cfg)
    got = {(r.tenant, r.view): (r.verdict, r.notes) for r in out.views.collect()}
    assert {k: v[0] for k, v in got.items()} == {
        ("uat1", "enrolment"): "PASS", ("uat1", "mine_only"): "BLOCKED", ("uat1", "syd_uat1"): "DIFFS FOUND",
        ("uat1", "phantom"): "BLOCKED", ("locked", "(all)"): "BLOCKED", ("nobody", "(all)"): "BLOCKED",
    }
    assert got["uat1", "phantom"][1] == ["no such view"] and "encrypted" in got["locked", "(all)"][1][0]
    named = run_csv(spark, cfg, views="dwi_enrolment", tenants="UAT1")
    assert [(r.tenant, r.view) for r in named.views.collect()] == [("uat1", "enrolment")]


def test_settings():
    s = settings_from("C", {"diff_threshold_pct": None, "sample_rows": 7, "csv_sample_columns": 3}, {"numeric_scale": 2})
    assert (s.threshold_pct, s.sample_rows, s.sample_columns, s.cell_rules.numeric_scale) == (0.0, 7, 3, 2)
