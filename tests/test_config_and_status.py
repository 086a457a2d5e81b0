"""Configuration rows, status rules and gates."""

import pytest
from pyspark.sql import functions as F

from twinledger.plans import wording, config as config_ops
from twinledger.plans import status as status_ops
from twinledger.plans.gates import may_run
from twinledger.plans.ladders import ViewSpec

VIEWS = [
    {"name": "dwi_Learning", "grain": ["Id", "Region"], "accepted_columns": ["Plain", {"column": "X", "reason": "r", "where": "w"}],
     "exclude_columns": [{"column": "Y"}], "accept_diff": {"D2": "late", "D9": True}},
    {"name": "per_tenant", "clients": ["UAT1"], "accept_diff": True, "expected_blocked": ["removal", "grain"]},
    {"name": "none", "grain": [], "accept_diff": "d3"},
    {"name": "listed", "accept_diff": ["D1", {"tier": "d4", "reason": "known"}], "absent_note": "no such view"},
]


@pytest.fixture
def views(spark):
    return config_ops.config_rows(spark, VIEWS, default_grain=["id"])


def test_rows(views):
    rows = {r.view: r for r in views.collect()}
    assert rows["dwi_Learning"].grain == ["Id", "Region"] and rows["per_tenant"].grain == ["id"] and rows["none"].grain == []
    assert [tuple(a) for a in rows["dwi_Learning"].accepted_columns] == [("Plain", "", None), ("X", "r", "w")]


def test_expansion(views):
    rows = {(r.mode, r.view): r for r in config_ops.expand_views(views).collect()}
    assert len(rows) == 8
    csv, dwi = rows["csv", "learning"], rows["dwi", "DWI_LEARNING"]
    assert csv.grain == ["id", "region"] and dwi.grain == ["ID", "REGION"]
    assert csv.accepted_columns[1].column == "x" and dwi.accepted_columns[1].column == "X"
    assert rows["csv", "per_tenant"].clients == ["UAT1"] and rows["dwi", "DWI_PER_TENANT"].clients is None


def test_own_list_wins(views):
    own = views.where("view = 'none'").withColumn("mode", F.lit("csv"))
    rows = config_ops.expand_views(views, own).collect()
    assert sorted(r.view for r in rows if r.mode == "csv") == ["none"] and sum(r.mode == "dwi" for r in rows) == 4


def test_overrides(views):
    got = sorted((r.view, r.tier, r.reason or "", r.known) for r in config_ops.accept_overrides(views, "D").collect())
    assert got == [
        ("dwi_Learning", "D2", "late", True), ("dwi_Learning", "D9", "", False),
        ("listed", "D1", "", True), ("listed", "D4", "known", True), ("none", "D3", "", True),
        *[("per_tenant", f"D{n}", "", True) for n in range(1, 5)],
    ]


def test_scope(views):
    got = {(r.tenant, r.view) for r in config_ops.scoped_views(views, ["uat1", "other"]).collect()}
    assert ("uat1", "per_tenant") in got and ("other", "per_tenant") not in got and len(got) == 7
    named = config_ops.scoped_views(views, ["uat1"], "learning, none").collect()
    assert sorted(r.view for r in named) == ["dwi_Learning", "none"]


def test_skipping(views):
    got = {r.view: r.blocked_by for r in config_ops.skip_blocked(views, ["REMOVAL"]).collect()}
    assert got["per_tenant"] == ["REMOVAL"] and got["none"] is None
    assert not any(r.skipped for r in config_ops.skip_blocked(views, ["REMOVAL"], run_all=True).collect())
    assert not config_ops.skip_blocked(views, ["REMOVAL"], "per_tenant").first().skipped


def test_marks(views):
    got = {(r.view, r.column, r.kind) for r in config_ops.column_marks(views).collect()}
    assert got == {("dwi_Learning", "Plain", "accepted"), ("dwi_Learning", "X", "accepted"), ("dwi_Learning", "Y", "excluded")}


def test_spec_from_config():
    spec = ViewSpec.from_config({**VIEWS[0], "normalisation": {"numeric_scale": 2}}, cell_options={"trim_text": False})
    assert spec.grain == ("Id", "Region") and spec.where == {"X": "w"} and spec.excluded_names == {"Y"}
    assert spec.cell_rules.numeric_scale == 2 and not spec.cell_rules.trim_text
    assert ViewSpec.from_config({"name": "a"}, ["id"]).grain == ("id",)


@pytest.mark.parametrize(
    "count, base, pct, expected",
    [(0, 10, 50, "PASS"), (1, 10, 10, "ACCEPTED"), (2, 10, 10, "FAIL"), (1, 10, 0, "FAIL"), (1, 0, 50, "FAIL"), (None, 1, 1, "PASS")],
)
def test_count_status(spark, count, base, pct, expected):
    df = spark.createDataFrame([(count, base)], "n long, d long")
    assert df.select(status_ops.count_status(F.col("n"), F.col("d"), pct)).first()[0] == expected


@pytest.mark.parametrize(
    "verdict, bucket",
    [
        (None, "none"), ("PASS", "PASS"), ("BLOCKED", "BLOCKED"), ("DRY", "DRY"), ("PASS (NO GRAIN)", "NOGRAIN"),
        ("PASS (DIFFS ACCEPTED, NO GRAIN)", "NOGRAIN"), ("PASS (DIFFS ACCEPTED)", "ACC"), ("T0 DRIFT", "DRIFT"),
        ("HEADER DRIFT", "DRIFT"), ("ERROR", "ERROR"), ("DIFFS FOUND", "DIFFS"),
    ],
)
def test_buckets(spark, verdict, bucket):
    df = spark.createDataFrame([(verdict,)], "v string")
    assert df.select(status_ops.verdict_bucket(F.col("v"))).first()[0] == bucket


@pytest.mark.parametrize(
    "statuses, accepted, no_grain, expected",
    [
        (["PASS", "SKIPPED"], False, False, "PASS"), (["PASS", "SKIPPED"], False, True, "PASS (NO GRAIN)"),
        (["ACCEPTED"], False, True, "PASS (DIFFS ACCEPTED, NO GRAIN)"), (["PASS"], True, False, "PASS (DIFFS ACCEPTED)"),
        (["ACCEPTED", "FAIL"], True, True, "DIFFS FOUND"), (["FAIL", "ERROR"], False, False, "ERROR"),
        (["DRY", "SKIPPED"], False, False, "DRY"),
    ],
)
def test_verdicts(spark, statuses, accepted, no_grain, expected):
    tiers = spark.createDataFrame([("v", f"C{i + 2}", s) for i, s in enumerate(statuses)], "view string, tier string, status string")
    views = spark.createDataFrame([("v", accepted, no_grain)], "view string, has_accepted boolean, no_grain boolean")
    assert status_ops.verdicts(tiers, views, ["view"]).first().verdict == expected


def test_gate_answers_match_the_table(spark):
    flags = {"present": True, "has_grain": True, "usable": True, "always": False}
    assert may_run(spark, "C", "C5", flags, {"C2": "PASS", "C3": "PASS", "C4": "SKIPPED"}) == (True, None)
    runs, why = may_run(spark, "C", "C5", flags, {"C2": "ACCEPTED", "C3": "PASS", "C4": "PASS"})
    assert not runs and why == wording.TOLERATED
    assert may_run(spark, "C", "C5", {**flags, "always": True}, {"C2": "FAIL"})[0]
    assert may_run(spark, "T", "T3", {**flags, "has_grain": False}, {}) == (False, wording.NO_KEYS)


def test_attention_and_coverage(spark):
    rows = spark.createDataFrame(
        [("csv", "a", "PASS", False), ("csv", "b", "ERROR", None), ("dwi", "c", "D0 DRIFT", None), ("dwi", "d", "PASS (NO GRAIN)", True)],
        "mode string, view string, verdict string, no_grain boolean",
    )
    assert sorted(r.view for r in status_ops.attention_list(rows).collect()) == ["b", "c"]
    assert {tuple(r) for r in status_ops.grain_coverage(rows).collect()} == {("csv", 0, 2), ("dwi", 1, 2)}
