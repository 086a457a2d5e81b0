"""Run folders, pairing and view coverage over a listing with a path per order and side."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.queries.registry import INPUT_SQL, query
from twinledger.sources import runs as run_ops

LEFT_BASE, RIGHT_BASE = "s3://lake/left", "s3://lake/right"

_FILES = """SELECT CASE WHEN path LIKE 's3://lake/left/%' THEN 'left' ELSE 'right' END AS side,
  regexp_extract(path, '(t[0-9]+)/[0-9]{14}/', 1) AS tenant, regexp_extract(path, '/([0-9]{14})/', 1) AS ts,
  CASE WHEN path LIKE '%/processed/%' THEN 1 ELSE 0 END AS processed,
  regexp_extract(path, '([^/]+)$', 1) AS name, path
 FROM {paths} p WHERE regexp_matches(path, '/[0-9]{14}/[^/]+$')"""
_KINDS = f"""SELECT *, CASE WHEN lower(name) LIKE '%.pgp' THEN 'encrypted' WHEN lower(name) = 'marker.json' THEN 'marker'
   WHEN contains(lower(name), '.csv') THEN 'plain' ELSE 'other' END AS kind FROM ({_FILES}) f"""
_VIEWED = f"""SELECT *, CASE WHEN kind = 'plain' THEN split_part(lower(name), '.csv', 1) END AS view FROM ({_KINDS}) k"""
_RUNS = f"""SELECT side, tenant, ts, bool_or(processed = 0) AS listed, bool_or(processed = 0 AND kind = 'plain') AS plain,
   bool_or(processed = 0 AND kind = 'encrypted') AS enc, bool_or(processed = 1 AND kind = 'plain') AS kept
  FROM ({_KINDS}) k GROUP BY 1, 2, 3"""
_LATEST = f"""SELECT side, tenant, ts, CASE WHEN from_processed THEN 1 ELSE 0 END AS processed,
   CASE WHEN plain OR from_processed THEN 0 ELSE 1 END AS encrypted_only FROM (
   SELECT *, row_number() OVER (PARTITION BY side, tenant
     ORDER BY CASE WHEN plain OR from_processed THEN 2 WHEN enc THEN 1 ELSE 0 END DESC, ts DESC) AS rn
   FROM (SELECT *, NOT plain AND enc AND kept AND side = 'left' AS from_processed FROM ({_RUNS}) r WHERE listed) x) y
  WHERE rn = 1"""
_PAIRS = f"""SELECT tenant, l.ts AS left_ts, l.processed AS left_processed, l.encrypted_only AS left_encrypted,
   r.ts AS right_ts, r.processed AS right_processed, r.encrypted_only AS right_encrypted,
   CASE WHEN l.ts IS NULL THEN 'no run folders on the left' WHEN r.ts IS NULL THEN 'no run folders on the right'
     WHEN l.encrypted_only = 1 THEN 'left run holds only encrypted files'
     WHEN r.encrypted_only = 1 THEN 'right run holds only encrypted files' END AS note,
   CASE WHEN l.ts IS NULL OR r.ts IS NULL OR l.encrypted_only = 1 OR r.encrypted_only = 1 THEN 'BLOCKED' END AS verdict
  FROM (SELECT * FROM ({_LATEST}) a WHERE side = 'left') l
  FULL JOIN (SELECT * FROM ({_LATEST}) a WHERE side = 'right') r USING (tenant)"""
_CHOSEN = f"""SELECT v.side, v.tenant, v.ts, v.view, v.path FROM ({_VIEWED}) v JOIN ({_LATEST}) c
  ON v.side = c.side AND v.tenant = c.tenant AND v.ts = c.ts AND v.processed = c.processed
  WHERE v.kind = 'plain' AND c.encrypted_only = 0"""

# Views each tenant is configured for: some of the order priorities.
INPUT_SQL["configured_views"] = " UNION ALL ".join(
    f"""SELECT 't' || CAST(c_custkey AS STRING) AS tenant, '{view}' AS view,
  CASE WHEN c_custkey % 2 = 0 THEN 'named for segment ' || c_mktsegment END AS absent_note
  FROM {{customer}} WHERE c_custkey % 5 <> {n}"""
    for n, view in enumerate(("1-urgent", "2-high", "3-medium", "5-low", "6-none"))
)


def _files(i):
    paths = i["paths"]
    return run_ops.run_files(paths, "left", LEFT_BASE).unionByName(run_ops.run_files(paths, "right", RIGHT_BASE))


@query("run_listing", _FILES)
def run_listing(i):
    return _files(i).drop("kind", "view")


@query("run_file_kinds", f"SELECT path, kind, view FROM ({_VIEWED}) v")
def run_file_kinds(i):
    return _files(i).select("path", "kind", "view")


@query("latest_run", _LATEST)
def latest_run(i):
    return run_ops.latest_run(_files(i))


@query(
    "latest_run_pinned",
    _LATEST.replace("WHERE listed)", "WHERE listed AND (side <> 'left' OR ts = '19970101000000'))"),
)
def latest_run_pinned(i):
    return run_ops.latest_run(_files(i), pinned={"left": "19970101000000"})


@query("run_pairs", _PAIRS)
def run_pairs(i):
    return run_ops.run_pairs(run_ops.latest_run(_files(i)))


@query("chosen_files", _CHOSEN)
def chosen_files(i):
    files = _files(i)
    return run_ops.chosen_files(files, run_ops.latest_run(files)).select("side", "tenant", "ts", "view", "path")


@query(
    "view_coverage",
    f"""WITH f AS (SELECT tenant, view, bool_or(side = 'left') AS l, bool_or(side = 'right') AS r FROM ({_CHOSEN}) c GROUP BY 1, 2),
 j AS (SELECT tenant, view, COALESCE(l, false) AS l, COALESCE(r, false) AS r, absent_note FROM f
   FULL JOIN {{configured_views}} w USING (tenant, view))
 SELECT tenant, view, CASE WHEN l AND r THEN 'shared' WHEN l THEN 'left_only' WHEN r THEN 'right_only' ELSE 'absent' END AS coverage,
   CASE WHEN NOT (l AND r) THEN 'BLOCKED' END AS verdict,
   CASE WHEN l AND r THEN NULL WHEN l THEN 'Only present on the left side.' WHEN r THEN 'Only present on the right side.'
     ELSE COALESCE(absent_note, 'Configured but not found in either run folder.') END AS note FROM j""",
)
def view_coverage(i):
    files = _files(i)
    chosen = run_ops.chosen_files(files, run_ops.latest_run(files))
    return run_ops.view_coverage(chosen, i["configured_views"])


@query(
    "runs_per_tenant",
    f"SELECT side, tenant, count(DISTINCT ts) AS runs FROM ({_FILES}) f WHERE processed = 0 GROUP BY 1, 2",
)
def runs_per_tenant(i):
    """How many run folders each tenant has."""
    listed = _files(i).where(~F.col("processed")).select("side", "tenant", "ts").distinct()
    return listed.groupBy("side", "tenant").agg(F.count(F.lit(1)).alias("runs"))
