"""Schema, header and presence comparison over catalogs derived from the tables: a table per order."""

from __future__ import annotations

from twinledger.operators import schema as schema_ops
from twinledger.queries.registry import query
from twinledger.sources.tables import presence

_JOINED = """WITH p AS (SELECT * FROM {catalog_left} a), u AS (SELECT * FROM {catalog_right} b),
 j AS (SELECT COALESCE(p.table_name, u.table_name) AS table_name, COALESCE(p.column_name, u.column_name) AS column_name,
   p.column_name AS pcol, u.column_name AS ucol, p.ordinal AS pord, u.ordinal AS uord, p.data_type AS ptype,
   u.data_type AS utype, p.len AS plen, u.len AS ulen, p.prec AS pprec, u.prec AS uprec, p.scale AS pscale,
   u.scale AS uscale, p.nullable AS pnull, u.nullable AS unull
   FROM p FULL JOIN u ON p.table_name = u.table_name AND p.column_name = u.column_name)"""
# Tables one side does not list have no columns there either.
_SHARED = _JOINED.replace(
    "SELECT * FROM {catalog_left} a", "SELECT a.* FROM {catalog_left} a JOIN {tables_left} v USING (table_name)"
).replace(
    "SELECT * FROM {catalog_right} b", "SELECT b.* FROM {catalog_right} b JOIN {tables_right} v USING (table_name)"
).replace(
    "AND p.column_name = u.column_name)",
    """AND p.column_name = u.column_name WHERE COALESCE(p.table_name, u.table_name) IN
   (SELECT a.table_name FROM {tables_left} a JOIN {tables_right} b ON a.table_name = b.table_name))""",
)
_RESIZED = "(plen IS DISTINCT FROM ulen OR pprec IS DISTINCT FROM uprec OR pscale IS DISTINCT FROM uscale)"
_DRIFTED = f"(pcol IS NULL OR ucol IS NULL OR ptype <> utype OR {_RESIZED} OR pnull <> unull OR pord <> uord)"


@query(
    "schema_drift",
    _JOINED
    + """SELECT table_name, column_name, pord AS left_ord, uord AS right_ord, ptype AS left_type, utype AS right_type,
  COALESCE(pord, uord) AS ord FROM j WHERE pcol IS NULL OR ucol IS NULL OR pord <> uord OR ptype <> utype""",
)
def schema_drift(i):
    return schema_ops.schema_drift(i["catalog_left"], i["catalog_right"])


@query(
    "schema_status",
    _JOINED
    + """, d AS (SELECT table_name, count(*) AS n FROM j
    WHERE pcol IS NULL OR ucol IS NULL OR pord <> uord OR ptype <> utype GROUP BY 1)
  SELECT t.table_name, COALESCE(d.n, 0) AS drifted, CASE WHEN d.n > 0 THEN 'FAIL' ELSE 'PASS' END AS status
  FROM {tables_wanted} t LEFT JOIN d ON t.table_name = d.table_name""",
)
def schema_status(i):
    return schema_ops.schema_status(schema_ops.schema_drift(i["catalog_left"], i["catalog_right"]), i["tables_wanted"])


@query(
    "schema_side_counts",
    """SELECT 'LEFT' AS side, count(*) AS tables FROM {tables_left} a
       UNION ALL SELECT 'RIGHT', count(*) FROM {tables_right} b""",
)
def schema_side_counts(i):
    return schema_ops.side_table_counts(i["tables_left"], i["tables_right"])


@query(
    "schema_objects_diff",
    """SELECT COALESCE(p.table_name, u.table_name) AS table_name,
         CASE WHEN p.table_name IS NULL THEN 'MISSING IN LEFT' ELSE 'MISSING IN RIGHT' END AS issue
       FROM {tables_left} p FULL JOIN {tables_right} u ON p.table_name = u.table_name
       WHERE p.table_name IS NULL OR u.table_name IS NULL""",
)
def schema_objects_diff(i):
    return schema_ops.objects_diff(i["tables_left"], i["tables_right"])


@query(
    "schema_drift_detail",
    _SHARED
    + f"""SELECT table_name, column_name, CASE WHEN pcol IS NULL THEN 'COLUMN ONLY IN RIGHT'
    WHEN ucol IS NULL THEN 'COLUMN ONLY IN LEFT' WHEN ptype <> utype THEN 'TYPE CHANGED'
    WHEN {_RESIZED} THEN 'PRECISION CHANGED' WHEN pnull <> unull THEN 'NULLABILITY CHANGED'
    ELSE 'POSITION CHANGED' END AS issue,
    pord AS left_ordinal, uord AS right_ordinal, ptype AS left_data_type, utype AS right_data_type, plen AS left_len,
    ulen AS right_len, pprec AS left_prec, uprec AS right_prec, pscale AS left_scale, uscale AS right_scale,
    pnull AS left_nullable, unull AS right_nullable FROM j WHERE {_DRIFTED}""",
)
def schema_drift_detail(i):
    return schema_ops.catalog_drift(i["catalog_left"], i["catalog_right"], i["tables_left"], i["tables_right"])


@query(
    "schema_drift_rollup",
    _SHARED
    + f"""SELECT table_name, count(pcol) AS left_cols, count(ucol) AS right_cols,
    count(*) FILTER (WHERE pcol IS NULL) AS only_in_right, count(*) FILTER (WHERE ucol IS NULL) AS only_in_left,
    count(*) FILTER (WHERE ptype <> utype) AS type_changed,
    count(*) FILTER (WHERE pcol IS NOT NULL AND ucol IS NOT NULL AND ptype = utype AND {_RESIZED}) AS precision_changed,
    count(*) FILTER (WHERE pnull <> unull) AS nullability_changed,
    count(*) FILTER (WHERE pord <> uord) AS position_changed,
    CASE WHEN count(*) FILTER (WHERE {_DRIFTED}) = 0 THEN 'PASS' ELSE 'DRIFT' END AS verdict
  FROM j GROUP BY table_name""",
)
def schema_drift_rollup(i):
    return schema_ops.catalog_rollup(i["catalog_left"], i["catalog_right"], i["tables_left"], i["tables_right"])


_HEADERS = "WITH l AS (SELECT * FROM {headers_left} a), r AS (SELECT * FROM {headers_right} b)"
_HEADER_DRIFT = """SELECT l.view, l.column_name, l.ordinal AS left_ord,
   CASE WHEN r.column_name IS NOT NULL THEN
     (SELECT min(x.ordinal) FROM r x WHERE x.view = l.view AND x.column_name = l.column_name) END AS right_ord,
   r.column_name AS right_column_at_position
 FROM l LEFT JOIN r ON l.view = r.view AND l.ordinal = r.ordinal WHERE r.column_name IS DISTINCT FROM l.column_name
 UNION ALL
 SELECT r.view, r.column_name, NULL, r.ordinal, NULL FROM r
 LEFT JOIN (SELECT view, max(ordinal) AS width FROM l GROUP BY 1) w ON r.view = w.view
 WHERE r.ordinal > COALESCE(w.width, 0)"""


@query("header_drift", f"{_HEADERS} {_HEADER_DRIFT}")
def header_drift(i):
    return schema_ops.header_drift(i["headers_left"], i["headers_right"])


@query(
    "header_summary",
    f"""{_HEADERS}, d AS ({_HEADER_DRIFT}), n AS (SELECT view, count(*) AS n FROM d GROUP BY 1),
 s AS (SELECT v.view, COALESCE(n.n, 0) AS drifted,
   (SELECT count(*) FROM l WHERE l.view = v.view AND l.column_name NOT IN (SELECT x.column_name FROM r x WHERE x.view = v.view)) AS only_left,
   (SELECT count(*) FROM r WHERE r.view = v.view AND r.column_name NOT IN (SELECT x.column_name FROM l x WHERE x.view = v.view)) AS only_right
   FROM (SELECT view FROM l UNION SELECT view FROM r) v LEFT JOIN n ON v.view = n.view)
 SELECT view, drifted, only_left, only_right,
   CASE WHEN drifted > 0 AND only_left = drifted AND only_right = drifted THEN 1 ELSE 0 END AS looks_like_rename,
   CASE WHEN drifted > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM s""",
)
def header_summary(i):
    return schema_ops.header_summary(i["headers_left"], i["headers_right"])


@query(
    "presence_verdict",
    """SELECT w.table_name, CASE WHEN p.table_name IS NULL THEN 0 ELSE 1 END AS in_left,
    CASE WHEN u.table_name IS NULL THEN 0 ELSE 1 END AS in_right,
    CASE WHEN p.table_name IS NULL OR u.table_name IS NULL THEN 'BLOCKED' END AS verdict,
    CASE WHEN p.table_name IS NULL AND u.table_name IS NULL THEN 'absent on both sides'
      WHEN u.table_name IS NULL THEN 'absent on the right' WHEN p.table_name IS NULL THEN 'absent on the left' END AS note
  FROM {tables_wanted} w LEFT JOIN {tables_left} p ON w.table_name = p.table_name
  LEFT JOIN {tables_right} u ON w.table_name = u.table_name""",
)
def presence_verdict(i):
    return presence(i["tables_left"], i["tables_right"], i["tables_wanted"])
