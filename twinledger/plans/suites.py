"""Whole runs from one configuration mapping: all models, all warehouse views, all extracts.

A configuration is what its YAML file holds: ``environments``, ``defaults`` and ``tables`` for ladder T; ``dwi``,
``csv``, ``defaults`` and one shared list of ``views`` for ladders D and C.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from twinledger.functions.normalise import CellRules
from twinledger.plans import config as config_ops
from twinledger.plans.ladders import Job, LadderRun, Settings, ViewRun, ViewSpec, gather, run_all, run_extracts, run_tables
from twinledger.sources import runs as run_ops
from twinledger.sources.extracts import read_extract
from twinledger.sources.tables import open_table, table_name

# Fixed value: columns that name a tenant.
TENANT_COLUMNS = ("client_name", "client_region")

# Opens a table of a side: (side as configured, table) -> DataFrame, or None if it is not there.
Opener = Callable[[str, str], DataFrame | None]


def settings_from(ladder: str, defaults: Mapping | None, cell_options: Mapping | None = None) -> Settings:
    """Run settings from the ``defaults`` section; extracts may have sample limits of their own, else those of tables."""
    d = dict(defaults or {})
    rows = int(d.get("sample_rows", 25))
    # How many columns and rows of each are shown where nothing is configured, for models and for views.
    columns, each = (10, 5) if ladder == "T" else (20, 15)
    columns, each = d.get("t3_sample_columns", columns), d.get("t3_samples_per_column", each)
    if ladder == "C":
        columns, each = d.get("csv_sample_columns", columns), d.get("csv_samples_per_column", each)
    return Settings(
        threshold_pct=float(d.get("diff_threshold_pct") or 0),
        sample_rows=rows,
        full_row_sample_rows=int(d.get("full_row_sample_rows", rows)),
        sample_columns=int(columns),
        samples_per_column=int(each),
        always_fingerprint=bool(d.get("always_fingerprint", False)),
        nullif_text=bool(d.get("nullif_text", True)),
        trim_text=bool(d.get("trim_text", False)),
        cell_rules=CellRules.from_options(cell_options),
    )


def blocked_view(spark: SparkSession, ladder: str, name: str, note: str, tenant: str | None = None, tier: str | None = None):
    """A view that is not compared but still reported."""
    run = ViewRun(spark, ladder, name, ViewSpec(name), Settings(), tenant)
    run.notes.append(note)
    if tier:
        run.record(tier, "FAIL")
    return run


def _opener(spark: SparkSession, default_schema: str) -> Opener:
    return lambda side, table: open_table(spark, table_name(side, default_schema, table))


def _chosen(entries: list[Mapping], names: str | None) -> list[Mapping]:
    wanted = config_ops.name_filter(names)
    return [e for e in entries if e and e.get("name") and (not wanted or str(e["name"]).lower() in wanted)]


def _table_jobs(spark, ladder, entries, sides, open_side, settings, active, default_grain=()):
    def job(entry):
        spec = ViewSpec.from_config(entry, default_grain)
        left, right = [open_side(side, spec.name) for side in sides]
        return run_tables(spark, ladder, spec, left, right, settings, active if spec.tenant_columns else None)

    return [Job(ladder, str(e["name"]), lambda e=e: job(e)) for e in entries]


def run_models(
    spark: SparkSession,
    cfg: Mapping,
    *,
    tables: str | None = None,
    skip_blocked: list[str] | None = None,
    ignore_blocked: bool = False,
    open_side: Opener | None = None,
    at_once: int = 4,
) -> LadderRun:
    """Ladder T over the configured tables, in configured order.

    Tables with a block type in ``skip_blocked`` (by default the configured ones) are reported as BLOCKED;
    ``ignore_blocked`` runs them too, and tables asked for by name are never skipped.
    """
    env = cfg["environments"]
    open_side = open_side or _opener(spark, env["schema"])
    settings = settings_from("T", cfg.get("defaults"))
    entries = _chosen(cfg["tables"], tables)
    skip = skip_blocked if skip_blocked is not None else (cfg.get("defaults") or {}).get("skip_blocked") or []
    judged = config_ops.skip_blocked(config_ops.config_rows(spark, entries), [str(s) for s in skip], tables, ignore_blocked)
    # One row per configured table.
    blocked = {r.view: r.blocked_by for r in judged.where("skipped").select("view", "blocked_by").collect()}
    active = spark.table(env["active_tenants"]) if isinstance(env.get("active_tenants"), str) else env.get("active_tenants")
    jobs = []
    for e in entries:
        name = str(e["name"])
        if name in blocked:
            note = f"Skipped by configuration, blocked: {', '.join(blocked[name])}."
            jobs.append(lambda n=name, t=note: blocked_view(spark, "T", n, t))
            continue
        own = {} if e.get("tenant_join", True) is False or active is None else {"tenant_columns": TENANT_COLUMNS}
        jobs += _table_jobs(
            spark, "T", [{**own, **e}], (env["prod_db"], env["uat_db"]), open_side, settings, active
        )
    return run_all(spark, jobs, at_once)


def _mode_entries(cfg: Mapping, mode: str) -> list[Mapping]:
    """A mode's own list, or the shared one spelled as the mode spells names."""
    own = (cfg.get(mode) or {}).get("views")
    if own:
        return [v for v in own if v and v.get("name")]
    case = str.upper if mode == "dwi" else str.lower

    def cased(items):
        return [{**i, "column": case(str(i["column"]))} if isinstance(i, Mapping) else case(str(i)) for i in items]

    out = []
    for v in cfg.get("views") or []:
        if not v or not v.get("name"):
            continue
        bare = config_ops.name_filter(str(v["name"]))
        name = next(n for n in bare if not n.startswith("dwi_"))
        entry = {**v, "name": f"DWI_{name.upper()}" if mode == "dwi" else name}
        entry |= {"grain": [case(str(c)) for c in v["grain"]]} if v.get("grain") else {}
        entry |= {k: cased(v[k]) for k in ("accepted_columns", "exclude_columns") if v.get(k)}
        if mode == "dwi":
            entry.pop("clients", None)
        out.append(entry)
    return out


def run_views(
    spark: SparkSession, cfg: Mapping, *, views: str | None = None, open_side: Opener | None = None, at_once: int = 4
) -> LadderRun:
    """Ladder D over the configured warehouse views; tenants are only restricted where configured."""
    dwi = cfg.get("dwi") or {}
    open_side = open_side or _opener(spark, dwi["schema"])
    active = spark.table(dwi["active_tenants"]) if isinstance(dwi.get("active_tenants"), str) else dwi.get("active_tenants")
    entries = []
    for e in _chosen(_mode_entries(cfg, "dwi"), views):
        joined = active is not None and e.get("tenant_join", dwi.get("tenant_join", False)) is not False
        entries.append({**({"tenant_columns": TENANT_COLUMNS} if joined else {}), **e})
    jobs = _table_jobs(
        spark, "D", entries, (dwi["prod_db"], dwi["uat_db"]), open_side, settings_from("D", cfg.get("defaults")), active,
        dwi.get("default_grain") or (),
    )
    return run_all(spark, jobs, at_once)


def run_csv(
    spark: SparkSession,
    cfg: Mapping,
    *,
    views: str | None = None,
    tenants: str | None = None,
    left_run: str | None = None,
    right_run: str | None = None,
    at_once: int = 4,
) -> LadderRun:
    """Ladder C over the newest (or pinned) run of every configured tenant.

    A tenant without a usable run, a view only one side unloaded and a configured view nobody unloaded are
    reported as BLOCKED.
    """
    csv = cfg.get("csv") or {}
    wanted = {t.strip().lower() for t in tenants.split(",")} if tenants else None
    clients = [str(c) for c in csv.get("clients") or [] if not wanted or str(c).lower() in wanted]
    if not clients:
        return gather(spark, [])
    bases = {
        "left": csv.get("left_base") or csv["redshift_base"], "right": csv.get("right_base") or csv["snowflake_base"],
    }
    pinned = {side: ts for side, ts in (("left", left_run), ("right", right_run)) if ts}
    listed = {
        side: run_ops.newest_paths(spark, base, clients, pinned.get(side), processed=side == "left") for side, base in bases.items()
    }
    files = reduce(DataFrame.unionByName, [run_ops.run_files(paths, side, bases[side]) for side, paths in listed.items()])
    latest = run_ops.latest_run(files, pinned)
    entries = _chosen(_mode_entries(cfg, "csv"), views)
    rows = config_ops.config_rows(spark, entries, csv.get("default_grain"))
    configured = config_ops.scoped_views(rows, clients).select("tenant", F.lower("view").alias("view"), "absent_note")

    # From here on one row per tenant, view or file of the chosen runs: names, not data.
    pairs = {r.tenant: r for r in run_ops.run_pairs(latest).collect()}
    usable = [c for c in clients if c in pairs and pairs[c].verdict is None]
    jobs = []
    for c in clients:
        if c not in usable:
            note = pairs[c].note if c in pairs else "no run folders on either side"
            jobs.append(lambda t=c, n=note: blocked_view(spark, "C", "(all)", n, t))
    chosen = run_ops.chosen_files(files, latest).where(F.col("tenant").isin(usable))
    paths: dict[tuple[str, str], dict[str, list[str]]] = {}
    for r in chosen.collect():
        paths.setdefault((r.tenant, r.view), {}).setdefault(r.side, []).append(r.path)
    coverage = run_ops.view_coverage(chosen, configured.where(F.col("tenant").isin(usable)))
    picked = config_ops.name_filter(views)
    if picked:
        coverage = coverage.where(F.col("view").isin(picked))
    by_name = {str(e["name"]).lower(): e for e in entries}
    options = dict(csv.get("normalisation") or {})
    settings = settings_from("C", cfg.get("defaults"), options)
    reading = {k: csv[k] for k in ("encoding", "delimiter", "multi_line") if csv.get(k) is not None}
    for r in coverage.orderBy("tenant", "view").collect():
        if r.coverage != "shared":
            jobs.append(lambda r=r: blocked_view(spark, "C", r.view, r.note, r.tenant, "C0"))
            continue
        entry = by_name.get(r.view, {"name": r.view})
        spec = ViewSpec.from_config({**entry, "name": r.view}, csv.get("default_grain") or (), options)

        own = {"multi_line": bool(entry["multi_line"])} if "multi_line" in entry else {}

        def job(spec=spec, r=r, own=own):
            sides = [read_extract(spark, paths[r.tenant, r.view][side], **(reading | own)) for side in ("left", "right")]
            return run_extracts(spark, spec, *sides, settings, r.tenant)

        jobs.append(Job("C", r.view, job, r.tenant))
    return run_all(spark, jobs, at_once)
