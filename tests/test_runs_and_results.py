"""Run folders on a real file system, results written and read back, history."""

import json

from pyspark.sql import functions as F

from twinledger.plans import status as status_ops
from twinledger.plans.ladders import TIER_SCHEMA, Settings, ViewSpec, gather, run_tables
from twinledger.sources import results as result_ops
from twinledger.sources import runs as run_ops
from twinledger.sources.extracts import read_extract


def lay_out(base, *paths):
    for p in paths:
        f = base / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("id,status\n1,A\n")


def files(spark, tmp_path):
    out = None
    for side in ("left", "right"):
        base = f"file:{tmp_path / side}"
        part = run_ops.run_files(run_ops.list_paths(spark, base), side, base)
        out = part if out is None else out.unionByName(part)
    return out


def latest(spark, tmp_path, **kw):
    return {(r.side, r.tenant): r for r in run_ops.latest_run(files(spark, tmp_path), **kw).collect()}


def test_encrypted_run_falls_back_to_an_older_one(spark, tmp_path):
    lay_out(
        tmp_path, "left/uat1/20260728223000/v.csv", "left/uat1/20260729223000/v.csv.pgp",
        "left/uat1/20260729223000/marker.json", "left/uat1/notes/v.csv", "right/uat1/20260729224500/v.csv",
    )
    runs = latest(spark, tmp_path)
    assert runs["left", "uat1"].ts == "20260728223000" and not runs["left", "uat1"].encrypted_only
    pinned = latest(spark, tmp_path, pinned={"left": "20260729223000"})
    assert pinned["left", "uat1"].encrypted_only


def test_processed_folder_keeps_the_newest_run(spark, tmp_path):
    lay_out(
        tmp_path, "left/uat1/20260728223000/v.csv", "left/uat1/20260729223000/v.csv.pgp",
        "left/processed/uat1/20260729223000/v.csv", "right/uat1/20260729224500/v.csv.pgp",
        "right/processed/uat1/20260729224500/v.csv",
    )
    runs = latest(spark, tmp_path)
    left = runs["left", "uat1"]
    assert (left.ts, left.processed, left.encrypted_only) == ("20260729223000", True, False)
    assert runs["right", "uat1"].encrypted_only  # only the left side keeps processed originals
    found = files(spark, tmp_path)
    chosen = run_ops.chosen_files(found, run_ops.latest_run(found)).collect()
    assert [r.path.rsplit("left/", 1)[1] for r in chosen] == ["processed/uat1/20260729223000/v.csv"]
    pair = run_ops.run_pairs(run_ops.latest_run(found)).first()
    assert pair.verdict == "BLOCKED" and "right run" in pair.note


def test_coverage_and_parts(spark, tmp_path):
    lay_out(
        tmp_path, "left/uat1/20260729223000/Both.CSV000", "left/uat1/20260729223000/both.csv001",
        "left/uat1/20260729223000/mine.csv", "left/uat1/20260729223000/readme.txt",
        "right/uat1/20260729224500/both.csv", "right/uat1/20260729224500/yours.csv",
    )
    found = files(spark, tmp_path)
    chosen = run_ops.chosen_files(found, run_ops.latest_run(found))
    wanted = spark.createDataFrame(
        [("uat1", "both", None), ("uat1", "nobody", "no such view"), ("uat1", "never", None)],
        "tenant string, view string, absent_note string",
    )
    rows = {r.view: r for r in run_ops.view_coverage(chosen, wanted).collect()}
    assert {v: r.coverage for v, r in rows.items()} == {
        "both": "shared", "mine": "left_only", "yours": "right_only", "nobody": "absent", "never": "absent",
    }
    assert rows["both"].verdict is None and rows["nobody"].note == "no such view"
    assert rows["never"].verdict == "BLOCKED" and rows["never"].note.startswith("Configured")
    parts = [r.path for r in chosen.where("side = 'left' and view = 'both'").collect()]
    assert len(parts) == 2 and read_extract(spark, parts).df.count() == 2


def test_file_kinds(spark):
    names = ["a.csv", "A.CSV", "a.csv000", "a.csv.pgp", "MARKER.json", "a.txt", "x.csv.gz"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select(run_ops.file_kind(F.col("n")), run_ops.view_name(F.col("n"))).collect()
    assert [r[0] for r in got] == ["plain", "plain", "plain", "encrypted", "marker", "other", "plain"]
    assert [r[1] for r in got][:3] == ["a", "a", "a"]


def test_results_and_samples_round_trip(spark, tmp_path):
    left = spark.range(50).select("id", F.lit("a").alias("v"))
    right = left.withColumn("v", F.when(F.col("id") < 5, F.lit("b")).otherwise(F.col("v")))
    run = gather(
        spark, [run_tables(spark, "T", ViewSpec("my view", grain=("id",)), left, right, Settings(samples_per_column=3))]
    )
    folder = str(tmp_path / "results_20260801_1200")
    result_ops.write_results(run.tiers, folder)
    back = result_ops.read_results(spark, folder, TIER_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, run.tiers.collect()))
    result_ops.write_samples(run.samples, folder)
    rows = spark.read.option("header", True).csv(f"{folder}/samples").collect()
    assert len(rows) == 3 and {(r.view, r.tier, r.column) for r in rows} == {("my view", "T3", "v")}
    result_ops.write_report(run.tiers, run.columns, run.views, folder, "Run", ["T0", "T1", "T2", "T3", "T4"])
    lines = [r.value for r in spark.read.text(f"{folder}/summary").collect()]
    assert lines[:2] == ["# Run", "| View | T0 | T1 | T2 | T3 | T4 | Verdict | Notes |"]
    assert lines[3] == "| my view | PASS | PASS | PASS | FAIL | SKIPPED | DIFFS FOUND |  |"
    assert lines[4:] == [
        "## Grain coverage", "## Details", "### my view - DIFFS FOUND", "- T2 row counts: 50 vs 50 (diff +0)",
        "- T2 one-sided: 0 left, 0 right", "- T3 `v`=5 [FAIL]",
    ]


def test_history_of_all_payload_shapes(spark, tmp_path):
    def put(name, text):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "results.json").write_text(text)

    row = {"client": "uat1", "view": "v", "tiers": {"C0": {"status": "PASS"}}, "verdict": "PASS", "notes": []}
    put("results_20260101_0100", json.dumps({"generated": "x", "dry_run": False, "csv": [row], "dwi": [
        {"view": "DWI_V", "mode": "dwi", "verdict": "D0 DRIFT"}]}, indent=2))
    put("results_20260102_0100", json.dumps({"dry_run": True, "csv": [{**row, "verdict": "DIFFS FOUND"}], "dwi": []}))
    put("results_20260103_0100", json.dumps([{"table": "T", "verdict": "PASS (DIFFS ACCEPTED)", "runtime_seconds": 12.4}]))
    put("results_20260104_0100", "{ not json")
    put("results_20260105_0100", json.dumps({"csv": [], "dwi": []}))
    put("other_20260106_0100", json.dumps([{"table": "T", "verdict": "PASS"}]))
    rows = {(r.run, r.id): r for r in result_ops.history(spark, str(tmp_path)).collect()}
    assert {k: r.verdict for k, r in rows.items()} == {
        ("results_20260101_0100", "csv:uat1/v"): "PASS",
        ("results_20260101_0100", "dwi:DWI_V"): "D0 DRIFT",
        ("results_20260102_0100", "csv:uat1/v"): "DIFFS FOUND",
        ("results_20260103_0100", "bi:T"): "PASS (DIFFS ACCEPTED)",
    }
    assert rows["results_20260102_0100", "csv:uat1/v"].dry_run
    matrix = status_ops.history_matrix(result_ops.history(spark, str(tmp_path)))
    got = {r["id"]: r.asDict() for r in matrix.collect()}
    assert got["csv:uat1/v"]["results_20260102_0100"] == "DIFFS" and got["bi:T"]["results_20260101_0100"] == "none"
    assert got["dwi:DWI_V"]["results_20260101_0100"] == "DRIFT"


def test_only_the_named_tenants_are_listed(spark, tmp_path):
    run = "20250105060000"
    lay_out(
        tmp_path, f"left/north/{run}/orders.csv", f"left/processed/north/{run}/orders.csv", f"left/north east/{run}/part.csv",
        f"left/{{odd,one}}/{run}/part.csv", f"left/south/{run}/orders.csv", f"left/processed/south/{run}/orders.csv",
    )
    base = f"file:{tmp_path / 'left'}"

    def found(*tenants):
        listed = run_ops.run_files(run_ops.list_paths(spark, base, tenants), "left", base)
        return sorted((r.tenant, r.processed) for r in listed.collect())

    assert found("north") == [("north", False), ("north", True)]
    assert found("{odd,one}", "south") == [("south", False), ("south", True), ("{odd,one}", False)]
    assert found("west") == []


def test_newest_paths_lead_to_the_same_runs(spark, tmp_path):
    lay_out(
        tmp_path, "left/a/20260728223000/v.csv", "left/a/20260729223000/v.csv.pgp", "left/a/20260730223000/marker.json",
        "left/b/20260728223000/v.csv", "left/b/20260729223000/v.csv.pgp", "left/processed/b/20260729223000/sub/v.csv000",
        "left/c/20260728223000/v.csv.pgp", "left/c/20260727223000/w.csv.pgp", "left/d/notes/v.csv", "left/e/20260101000000/V.CSV",
        "left/e/20260201000000/_hidden.csv", "left/other/20260101000000/v.csv",
    )
    base, tenants = f"file:{tmp_path / 'left'}", ["a", "b", "c", "d", "e", "nobody"]
    for pinned in (None, "20260728223000"):
        pins = {"left": pinned} if pinned else None
        every = run_ops.run_files(run_ops.list_paths(spark, base, tenants), "left", base)
        some = run_ops.run_files(run_ops.newest_paths(spark, base, tenants, pinned, processed=True), "left", base)
        got, want = (sorted(map(tuple, run_ops.latest_run(f, pins).collect())) for f in (some, every))
        assert got == want and len(got) >= 3
        chosen = [sorted(r.path for r in run_ops.chosen_files(f, run_ops.latest_run(f, pins)).collect()) for f in (some, every)]
        assert chosen[0] == chosen[1]


def test_old_runs_are_not_listed(spark, tmp_path, monkeypatch):
    lay_out(tmp_path, *[f"left/t/{20240101000000 + i}/v.csv" for i in range(500)], "left/t/20250101000000/v.csv.pgp")
    listed, children = [], run_ops._children
    monkeypatch.setattr(run_ops, "_children", lambda spark, folder: listed.append(folder) or children(spark, folder))
    found = run_ops.newest_paths(spark, f"file:{tmp_path / 'left'}", ["t"])
    assert sorted(r.path.split("/")[-2] for r in found.collect()) == ["20240101000499", "20250101000000"]
    assert len(listed) == 3  # the tenant's folder and two runs
