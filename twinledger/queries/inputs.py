"""Inputs derived from the given tables: second copies with planted differences, catalogs, run listings.

The texts are read by Spark and by the SQL the results are checked with.
"""

from __future__ import annotations

from twinledger.queries.registry import INPUT_SQL

# -- second copies ---------------------------------------------------------------------------------

INPUT_SQL["orders_right"] = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 211 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 53 = 0 THEN o_totalprice + 0.25 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 71 = 0 THEN NULLIF(o_orderdate, o_orderdate) ELSE o_orderdate END AS o_orderdate,
  o_orderpriority
FROM {orders} WHERE o_orderkey % 101 <> 0
UNION ALL
SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM {orders} WHERE o_orderkey % 103 = 0"""

INPUT_SQL["lineitem_right"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_orderkey % 97 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM {lineitem} WHERE l_orderkey % 211 <> 0"""

INPUT_SQL["customer_left"] = """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS c_region, c_name, c_acctbal,
  c_mktsegment FROM {customer}"""
INPUT_SQL["customer_right"] = """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS c_region, c_name,
  CASE WHEN c_custkey % 20 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM {customer}"""

# Half of all rows share one key: what pairing every copy with every copy would not survive at scale.
INPUT_SQL["hot_left"] = """
SELECT CASE WHEN l_linenumber <= 3 THEN 0 ELSE l_orderkey END AS k, l_returnflag AS flag,
  CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_linestatus END AS state,
  CAST(l_quantity AS BIGINT) AS quantity, l_shipdate AS shipped
FROM {lineitem}"""
INPUT_SQL["hot_right"] = """
SELECT CASE WHEN l_linenumber <= 3 THEN 0 ELSE l_orderkey END AS k,
  CASE WHEN l_orderkey % 31 = 0 THEN 'X' ELSE l_returnflag END AS flag, l_linestatus AS state,
  CAST(l_quantity AS BIGINT) + CASE WHEN l_orderkey % 29 = 0 THEN 1 ELSE 0 END AS quantity, l_shipdate AS shipped
FROM {lineitem}"""

INPUT_SQL["padded_orders"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '  ' || o_orderpriority || ' ' WHEN o_orderkey % 11 = 0 THEN '   '
  ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderstatus END AS o_orderstatus, o_custkey, o_totalprice
FROM {orders}"""

INPUT_SQL["active_tenants"] = """
SELECT o_orderpriority, o_orderstatus FROM {orders}
WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') GROUP BY o_orderpriority, o_orderstatus
UNION ALL
SELECT o_orderpriority, o_orderstatus FROM {orders}
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' GROUP BY o_orderpriority, o_orderstatus"""

# -- renderings of one value, as extracts carry them -----------------------------------------------------

INPUT_SQL["rendered_cells"] = """
SELECT o_orderkey,
  CASE o_orderkey % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'n' WHEN 2 THEN ' Yes ' WHEN 3 THEN 'f' WHEN 4 THEN '1' ELSE '0' END
    AS flag,
  CASE o_orderkey % 5 WHEN 0 THEN 'NULL' WHEN 1 THEN chr(92) || 'N' WHEN 2 THEN '   ' WHEN 3 THEN '' ELSE o_orderstatus END
    AS status,
  CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS STRING) || '.5000'
    WHEN 1 THEN '-' || CAST(o_custkey AS STRING) || '.000' WHEN 2 THEN '00' || CAST(o_custkey AS STRING) || '.125'
    ELSE CAST(o_custkey AS STRING) || 'e1' END AS amount,
  CAST(o_orderdate AS STRING) || CASE o_orderkey % 5 WHEN 0 THEN '.000+00:00' WHEN 1 THEN 'Z' WHEN 2 THEN '.500Z'
    WHEN 3 THEN '+0000' ELSE '' END AS modified,
  o_orderpriority AS priority
FROM {orders}"""

# -- catalogs: a table per order, a column per line ------------------------------------------------------

INPUT_SQL["catalog_left"] = """
SELECT 'V' || CAST(l_orderkey AS STRING) AS table_name, 'C' || CAST(l_linenumber AS STRING) AS column_name,
  l_linenumber AS ordinal,
  CASE max(l_returnflag) WHEN 'A' THEN 'TEXT' WHEN 'N' THEN 'NUMBER' ELSE 'DATE' END AS data_type,
  CASE WHEN max(l_returnflag) = 'A' THEN 16777216 END AS len,
  CASE WHEN max(l_returnflag) = 'N' THEN 38 END AS prec,
  CASE WHEN max(l_returnflag) = 'N' THEN 2 END AS scale,
  CASE WHEN max(l_linestatus) = 'O' THEN 'YES' ELSE 'NO' END AS nullable
FROM {lineitem} GROUP BY l_orderkey, l_linenumber"""
INPUT_SQL["catalog_right"] = """
SELECT 'V' || CAST(l_orderkey AS STRING) AS table_name, 'C' || CAST(l_linenumber AS STRING) AS column_name,
  CASE WHEN l_orderkey % 53 = 0 THEN l_linenumber + 1 ELSE l_linenumber END AS ordinal,
  CASE WHEN (l_orderkey + l_linenumber) % 41 = 0 THEN 'BOOLEAN'
    ELSE CASE max(l_returnflag) WHEN 'A' THEN 'TEXT' WHEN 'N' THEN 'NUMBER' ELSE 'DATE' END END AS data_type,
  CASE WHEN max(l_returnflag) = 'A' THEN CASE WHEN l_orderkey % 61 = 0 THEN 255 ELSE 16777216 END END AS len,
  CASE WHEN max(l_returnflag) = 'N' THEN 38 END AS prec,
  CASE WHEN max(l_returnflag) = 'N' THEN CASE WHEN l_orderkey % 43 = 0 THEN 4 ELSE 2 END END AS scale,
  CASE WHEN (max(l_linestatus) = 'O') = (l_orderkey % 47 <> 0) THEN 'YES' ELSE 'NO' END AS nullable
FROM {lineitem} WHERE (l_orderkey + l_linenumber) % 37 <> 0 GROUP BY l_orderkey, l_linenumber
UNION ALL
SELECT 'V' || CAST(l_orderkey AS STRING), 'NEW', 99, 'TEXT', 10, NULL, NULL, 'YES'
FROM {lineitem} WHERE l_orderkey % 59 = 0 GROUP BY l_orderkey"""
INPUT_SQL["tables_left"] = """
SELECT DISTINCT 'V' || CAST(l_orderkey AS STRING) AS table_name FROM {lineitem} WHERE l_orderkey % 101 <> 0"""
INPUT_SQL["tables_right"] = """
SELECT DISTINCT 'V' || CAST(l_orderkey AS STRING) AS table_name FROM {lineitem} WHERE l_orderkey % 103 <> 0"""
INPUT_SQL["tables_wanted"] = """
SELECT 'V' || CAST(o_orderkey AS STRING) AS table_name FROM {orders}"""

INPUT_SQL["headers_left"] = """
SELECT 'V' || CAST(k AS STRING) AS view, CAST(row_number() OVER (PARTITION BY k ORDER BY n) AS INT) AS ordinal,
  'c' || CAST(n AS STRING) AS column_name
FROM (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM {lineitem}) t"""
INPUT_SQL["headers_right"] = """
SELECT 'V' || CAST(k AS STRING) AS view,
  CAST(row_number() OVER (PARTITION BY k ORDER BY CASE WHEN k % 5 = 0 THEN -n ELSE n END) AS INT) AS ordinal,
  'c' || CAST(n AS STRING) || CASE WHEN (k + n) % 11 = 0 THEN 'x' ELSE '' END AS column_name
FROM (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM {lineitem}
      UNION SELECT o_orderkey, 9 FROM {orders} WHERE o_orderkey % 13 = 0) t
WHERE (k + n) % 7 <> 0"""

# -- run folders: two sides of files derived from orders -------------------------------------------------

INPUT_SQL["paths"] = """
SELECT 's3://lake/left/' || CASE WHEN o_orderkey % 13 = 0 THEN 'processed/' ELSE '' END
    || 't' || CAST(o_custkey AS STRING) || '/' || substr(CAST(o_orderdate AS STRING), 1, 4) || '0101000000'
    || CASE WHEN o_orderkey % 17 = 0 THEN 'x' ELSE '' END || '/'
    || CASE o_orderkey % 7 WHEN 0 THEN o_orderpriority || '.CSV' WHEN 1 THEN o_orderpriority || '.csv000'
         WHEN 2 THEN 'marker.json' WHEN 3 THEN o_orderpriority || '.txt' ELSE o_orderpriority || '.csv.pgp' END AS path
FROM {orders}
UNION ALL
SELECT 's3://lake/right/t' || CAST(o_custkey AS STRING) || '/' || substr(CAST(o_orderdate AS STRING), 1, 4)
    || '0202000000/' || o_orderpriority || CASE WHEN o_custkey % 4 = 0 THEN '.csv.pgp' ELSE '.csv' END
FROM {orders} WHERE o_orderkey % 3 <> 0"""

# -- outcomes of tiers per view: a view per customer -----------------------------------------------------

INPUT_SQL["slices"] = """
SELECT o_custkey AS c, count(*) AS n,
  sum(CASE WHEN o_orderkey % 53 = 0 THEN 1 ELSE 0 END) AS n53, sum(CASE WHEN o_orderkey % 71 = 0 THEN 1 ELSE 0 END) AS n71,
  sum(CASE WHEN o_orderkey % 89 = 0 THEN 1 ELSE 0 END) AS n89, sum(CASE WHEN o_orderkey % 101 = 0 THEN 1 ELSE 0 END) AS n101,
  sum(CASE WHEN o_orderkey % 211 = 0 THEN 1 ELSE 0 END) AS n211, sum(CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END) AS n19
FROM {orders} GROUP BY o_custkey"""
INPUT_SQL["outcomes"] = """
SELECT 'v' || CAST(c AS STRING) AS view, n % 7 <> 0 AS present, n % 5 <> 0 AS has_grain,
  n % 5 <> 0 AND n89 < 2 AS usable, n % 11 = 0 AS always, n % 3 = 0 AS has_accepted,
  CASE WHEN n211 > 0 THEN 'FAIL' WHEN n101 > 0 AND n53 > 0 THEN 'ERROR' ELSE 'PASS' END AS s0,
  CASE WHEN n89 > 1 THEN 'FAIL' WHEN n89 = 1 THEN 'ACCEPTED' ELSE 'PASS' END AS s1,
  CASE WHEN n53 > 1 THEN 'FAIL' WHEN n53 = 1 THEN 'ACCEPTED' ELSE 'PASS' END AS s2,
  CASE WHEN n71 > 1 THEN 'FAIL' WHEN n71 = 1 THEN 'ACCEPTED' ELSE 'PASS' END AS s3,
  CASE WHEN n101 > 1 THEN 'FAIL' WHEN n101 = 1 THEN 'ACCEPTED' WHEN n19 > 2 THEN 'ERROR' ELSE 'PASS' END AS s4,
  CASE WHEN n19 > 1 THEN 'FAIL' ELSE 'PASS' END AS s5
FROM {slices} s"""
# Tier rows of ladder D as a run stores them: drifted views stop early, some views have no rows at all.
INPUT_SQL["tier_rows"] = """
SELECT 'dwi' AS mode, view, 'D0' AS tier, s0 AS status FROM {outcomes} o WHERE present
UNION ALL SELECT 'dwi', view, 'D1', CASE WHEN has_grain THEN s1 ELSE 'SKIPPED' END FROM {outcomes} o
  WHERE present AND s0 = 'PASS'
UNION ALL SELECT 'dwi', view, 'D2', CASE WHEN has_grain THEN s2 ELSE 'SKIPPED' END FROM {outcomes} o
  WHERE present AND s0 = 'PASS'
UNION ALL SELECT 'dwi', view, 'D3', CASE WHEN usable THEN s3 ELSE 'SKIPPED' END FROM {outcomes} o
  WHERE present AND s0 = 'PASS'
UNION ALL SELECT 'dwi', view, 'D4', s5 FROM {outcomes} o WHERE present AND s0 = 'PASS'
UNION ALL SELECT 'bi', view, 'T0', s0 FROM {outcomes} o WHERE present
UNION ALL SELECT 'bi', view, 'T2', s2 FROM {outcomes} o WHERE present AND s0 = 'PASS'
UNION ALL SELECT 'csv', view, 'C0', CASE WHEN present THEN 'PASS' ELSE 'FAIL' END FROM {outcomes} o
UNION ALL SELECT 'csv', view, 'C1', s0 FROM {outcomes} o WHERE present
UNION ALL SELECT 'csv', view, 'C2', s4 FROM {outcomes} o WHERE present AND s0 = 'PASS'"""
INPUT_SQL["judged_views"] = " UNION ALL ".join(
    f"SELECT '{mode}' AS mode, view, has_accepted, NOT has_grain AS no_grain FROM {{outcomes}} o"
    for mode in ("dwi", "bi", "csv")
)

# Verdicts of three runs, a run per order status.
INPUT_SQL["run_results"] = """
SELECT 'results_20240' || CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END || '01_0000' AS run,
  'dwi:v' || CAST(o_custkey AS STRING) AS id, 'dwi' AS mode,
  max(CASE o_orderkey % 11 WHEN 0 THEN 'DIFFS FOUND' WHEN 1 THEN 'D0 DRIFT' WHEN 2 THEN 'BLOCKED' WHEN 3 THEN 'ERROR'
    WHEN 4 THEN 'PASS (NO GRAIN)' WHEN 5 THEN 'PASS (DIFFS ACCEPTED)' WHEN 6 THEN 'PASS (DIFFS ACCEPTED, NO GRAIN)'
    WHEN 7 THEN 'DRY' WHEN 8 THEN 'HEADER DRIFT' WHEN 9 THEN '' ELSE 'PASS' END) AS verdict,
  max(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) = 1 AS no_grain
FROM {orders} GROUP BY 1, 2, 3"""

# Column counts per view: orders of a customer compared between both copies.
INPUT_SQL["column_counts"] = """
SELECT 'v' || CAST(c AS STRING) AS view, 'price' AS col_name, 0 AS ordinal, n AS shared, n53 AS mismatches,
  CASE WHEN n53 > 1 THEN n53 - 1 ELSE 0 END AS residual FROM {slices} s
UNION ALL SELECT 'v' || CAST(c AS STRING), 'date', 1, n, n71, CAST(NULL AS BIGINT) FROM {slices} s
UNION ALL SELECT 'v' || CAST(c AS STRING), 'status', 2, n, n89 + n101, CAST(NULL AS BIGINT) FROM {slices} s
UNION ALL SELECT 'v' || CAST(c AS STRING), 'flag', 3, n, n19, n19 FROM {slices} s"""
INPUT_SQL["accepted_columns"] = """
SELECT 'v' || CAST(c AS STRING) AS view, 'price' AS col_name, '' AS reason, 'uat_value is null' AS cond FROM {slices} s
UNION ALL SELECT 'v' || CAST(c AS STRING), 'date', 'timing', NULL FROM {slices} s WHERE n % 2 = 0
UNION ALL SELECT 'v' || CAST(c AS STRING), 'flag', 'known', 'prod_value = 1' FROM {slices} s"""
