"""Configuration operators over a configured view per part."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.plans import config as config_ops
from twinledger.queries.registry import query

_NAME = """CASE p_partkey % 3 WHEN 0 THEN 'DWI_' WHEN 1 THEN 'dwi_' ELSE '' END || p_type || '_' || CAST(p_partkey AS STRING)"""
_VIEWS = f"""SELECT CAST(p_partkey AS INT) AS position, {_NAME} AS view, p_partkey, p_size, p_brand,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'Id,Client_Name,' || replace(p_brand, '#', '') END AS grain_text,
  CASE WHEN p_partkey % 5 = 0 THEN 'T1,t2' WHEN p_partkey % 5 = 1 THEN 't3' END AS clients_text,
  CASE p_partkey % 6 WHEN 0 THEN 'removal' WHEN 1 THEN 'IMPORT,Removal' WHEN 2 THEN 'GRAIN' ELSE '' END AS blocked_text
  FROM {{part}}"""


def _views(i):
    """The views as configuration rows."""
    rows = i.sql(_VIEWS)

    def listed(name):
        return F.when(F.length(name) > 0, F.split(name, ",")).otherwise(F.array().cast("array<string>"))

    def marks(entries):
        struct = F.array(
            *[F.struct(c.alias("column"), r.alias("reason"), w.alias("where")) for c, r, w in entries]
        )
        return struct

    none = F.lit(None).cast("string")
    overrides = (
        F.when(F.col("p_partkey") % 7 == 0, F.array(F.struct(F.lit("*").alias("tier"), none.alias("reason"))))
        .when(
            F.col("p_partkey") % 7 == 1,
            F.array(
                F.struct(F.lit("d2").alias("tier"), F.lit("timing").alias("reason")),
                F.struct(F.lit("D0").alias("tier"), none.alias("reason")),
            ),
        )
        .otherwise(F.array().cast("array<struct<tier: string, reason: string>>"))
    )
    return rows.select(
        "position", "view",
        listed("grain_text").alias("grain"),
        F.when(F.length("clients_text") > 0, F.split("clients_text", ",")).alias("clients"),
        listed("blocked_text").alias("expected_blocked"),
        marks([(F.col("p_brand"), F.lit("format"), F.when(F.col("p_size") > 25, F.lit("prod_value is null")))]).alias(
            "accepted_columns"
        ),
        marks([(F.lit("Loaded_At"), F.lit(""), none)]).alias("exclude_columns"),
        overrides.alias("accept_diff"),
        none.alias("absent_note"),
    )


_BARE = "lower(regexp_replace(view, '^[dD][wW][iI]_', ''))"


@query(
    "expanded_views",
    f"""SELECT m.mode, CASE WHEN m.mode = 'dwi' THEN 'DWI_' || upper({_BARE}) ELSE {_BARE} END AS view,
   CASE WHEN m.mode = 'dwi' THEN upper(grain_text) ELSE lower(grain_text) END AS grain,
   CASE WHEN m.mode = 'csv' THEN clients_text END AS clients,
   CASE WHEN m.mode = 'dwi' THEN upper(p_brand) ELSE lower(p_brand) END AS accepted_column,
   CASE WHEN m.mode = 'dwi' THEN 'LOADED_AT' ELSE 'loaded_at' END AS excluded_column
  FROM ({_VIEWS}) v JOIN (SELECT 'csv' AS mode UNION ALL SELECT 'dwi') m ON true""",
)
def expanded_views(i):
    return config_ops.expand_views(_views(i)).select(
        "mode", "view", "grain", "clients",
        F.col("accepted_columns")[0]["column"].alias("accepted_column"),
        F.col("exclude_columns")[0]["column"].alias("excluded_column"),
    )


@query(
    "expanded_views_own_list",
    f"""SELECT 'csv' AS mode, {_BARE} AS view FROM ({_VIEWS}) v
  UNION ALL SELECT 'dwi', 'OWN_' || CAST(s_suppkey AS STRING) FROM {{supplier}}""",
)
def expanded_views_own_list(i):
    """A mode with a list of its own keeps it as written and ignores the shared one."""
    shared = _views(i)
    own = i.sql("SELECT CASE WHEN s_suppkey >= 0 THEN 'dwi' END AS mode, 'OWN_' || CAST(s_suppkey AS STRING) AS view FROM {supplier}")
    missing = [f for f in shared.schema.fields if f.name != "view"]
    own = own.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    return config_ops.expand_views(shared, own).select("mode", "view")


# Column metadata: each view lacks one of four columns or none.
_COLUMNS = " UNION ALL ".join(
    f"SELECT {_NAME} AS view, '{column}' AS column_name FROM {{part}} WHERE p_partkey % 10 <> {lacking}"
    for column, lacking in (("ID", 0), ("client_name", 1), ("BRAND1", 2), ("brand2", 2))
)


@query(
    "grain_resolution",
    f"""WITH g AS (SELECT v.view, u.pos, u.name, c.column_name AS found FROM ({_VIEWS}) v
   JOIN LATERAL (SELECT unnest(string_split(grain_text, ',')) AS name, generate_subscripts(string_split(grain_text, ','), 1) AS pos) u ON true
   LEFT JOIN ({_COLUMNS}) c ON c.view = v.view AND lower(c.column_name) = lower(u.name) WHERE u.name <> '')
  SELECT v.view, COALESCE(string_agg(found, ',' ORDER BY pos) FILTER (WHERE found IS NOT NULL), '') AS present,
    COALESCE(string_agg(name, ',' ORDER BY pos) FILTER (WHERE found IS NULL AND name IS NOT NULL), '') AS missing,
    CASE WHEN count(found) = 0 THEN 1 ELSE 0 END AS no_grain
  FROM ({_VIEWS}) v LEFT JOIN g ON g.view = v.view GROUP BY v.view""",
)
def grain_resolution(i):
    return config_ops.grain_resolution(_views(i), i.sql(_COLUMNS))


@query(
    "scope_filter",
    f"""SELECT v.view, t.tenant FROM ({_VIEWS}) v JOIN (SELECT 't1' AS tenant UNION ALL SELECT 't2' UNION ALL SELECT 'T3'
   UNION ALL SELECT 't4') t ON clients_text IS NULL OR list_contains(string_split(lower(clients_text), ','), lower(t.tenant))""",
)
def scope_filter(i):
    return config_ops.scoped_views(_views(i), ["t1", "t2", "T3", "t4"]).select("view", "tenant")


@query(
    "skip_blocked",
    f"""SELECT view, CASE WHEN upper(blocked_text) LIKE '%REMOVAL%' OR upper(blocked_text) LIKE '%IMPORT%' THEN 1 ELSE 0 END AS skipped,
   CASE WHEN upper(blocked_text) LIKE '%IMPORT%' AND upper(blocked_text) LIKE '%REMOVAL%' THEN 'IMPORT,REMOVAL'
     WHEN upper(blocked_text) LIKE '%IMPORT%' THEN 'IMPORT' WHEN upper(blocked_text) LIKE '%REMOVAL%' THEN 'REMOVAL' END AS blocked_by
  FROM ({_VIEWS}) v""",
)
def skip_blocked(i):
    return config_ops.skip_blocked(_views(i), ["removal", "IMPORT"]).select("view", "skipped", "blocked_by")


@query(
    "override_entries",
    f"""SELECT view, t.tier, NULL AS reason, 1 AS known FROM ({_VIEWS}) v
   JOIN (SELECT 'D1' AS tier UNION ALL SELECT 'D2' UNION ALL SELECT 'D3' UNION ALL SELECT 'D4') t ON true WHERE p_partkey % 7 = 0
  UNION ALL SELECT view, 'D2', 'timing', 1 FROM ({_VIEWS}) v WHERE p_partkey % 7 = 1
  UNION ALL SELECT view, 'D0', NULL, 0 FROM ({_VIEWS}) v WHERE p_partkey % 7 = 1""",
)
def override_entries(i):
    return config_ops.accept_overrides(_views(i), "D")


@query(
    "column_marks",
    f"""SELECT view, 'Loaded_At' AS col_name, 'excluded' AS kind, '' AS reason, NULL AS cond FROM ({_VIEWS}) v
  UNION ALL SELECT view, p_brand, 'accepted', 'format', CASE WHEN p_size > 25 THEN 'prod_value is null' END FROM ({_VIEWS}) v""",
)
def column_marks(i):
    return config_ops.column_marks(_views(i)).withColumnsRenamed({"column": "col_name", "where": "cond"})
