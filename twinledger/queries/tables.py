"""Counts, keys, rows, columns and fingerprints over two copies of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.functions.normalise import projection
from twinledger.operators import columns as col_ops
from twinledger.operators import keys as key_ops
from twinledger.operators import rows as row_ops
from twinledger.operators.fingerprint import fingerprint, fingerprint_compare
from twinledger.operators.tenants import active_rows, tenant_row_counts
from twinledger.plans.status import column_tier_status, count_status
from twinledger.queries.registry import query

ORDER_KEY = ["o_orderkey"]
ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_GRAIN = ["l_orderkey", "l_linenumber", "l_partkey"]
TENANT = ["o_orderpriority", "o_orderstatus"]


def mismatches_sql(columns, text=(), where=None, null_explains=True):
    """Select list of a wide count over ``p`` and ``u`` turned tall, for checking column counts."""
    parts = []
    for i, c in enumerate(columns):
        p, u = (f"NULLIF(p.{c}, '')", f"NULLIF(u.{c}, '')") if c in text else (f"p.{c}", f"u.{c}")
        differs = f"{p} IS DISTINCT FROM {u}"
        rest = "CAST(NULL AS BIGINT)"
        if c in (where or {}):
            known = f"COALESCE({where[c].replace('$p', p).replace('$u', u)}, {str(null_explains).lower()})"
            rest = f"CAST(count(*) FILTER (WHERE {differs} AND NOT ({known})) AS BIGINT)"
        parts.append(
            f"SELECT '{c}' AS col_name, {i} AS ordinal, CAST(count(*) AS BIGINT) AS shared, "
            f"CAST(count(*) FILTER (WHERE {differs}) AS BIGINT) AS mismatches, {rest} AS residual FROM j"
        )
    return " UNION ALL ".join(parts)


def pairs_sql(left, right, keys, columns, null_safe=False, **options):
    """Column counts by really joining both sides."""
    same = "IS NOT DISTINCT FROM" if null_safe else "="
    on = " AND ".join(f"p.{k} {same} u.{k}" for k in keys)
    tall = mismatches_sql(columns, **options).replace("FROM j", f"FROM p JOIN u ON {on}")
    return f"WITH p AS (SELECT * FROM {left} a), u AS (SELECT * FROM {right} b) {tall}"


def tall(counts):
    return counts.withColumnRenamed("column", "col_name")


# -- projections and counts --------------------------------------------------------------------------


@query(
    "normalised_projection",
    """SELECT o_orderkey, NULLIF(TRIM(o_orderpriority), '') AS o_orderpriority,
       NULLIF(TRIM(o_orderstatus), '') AS o_orderstatus, o_custkey FROM {padded_orders} t""",
)
def normalised_projection(i):
    return projection(i["padded_orders"], drop=["o_totalprice"], trim_text=True)


@query(
    "projection_blank_only",
    """SELECT o_orderkey, o_orderpriority, NULLIF(o_orderstatus, '') AS o_orderstatus, o_custkey, o_totalprice
       FROM {padded_orders} t""",
)
def projection_blank_only(i):
    return projection(i["padded_orders"])


@query(
    "projection_override",
    """SELECT o_orderkey, upper(trim(o_orderpriority)) AS priority, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
       FROM {padded_orders} t""",
)
def projection_override(i):
    return projection(
        i["padded_orders"],
        override=["o_orderkey", "upper(trim(o_orderpriority)) AS priority", "cast(round(o_totalprice * 100) as bigint) AS cents"],
    )


@query(
    "row_counts",
    """SELECT p.n AS left_rows, u.n AS right_rows, p.n - u.n AS diff
       FROM (SELECT count(*) AS n FROM {orders}) p, (SELECT count(*) AS n FROM {orders_right} t) u""",
)
def row_counts(i):
    return key_ops.row_counts(i["orders"], i["orders_right"])


@query(
    "row_count_by_tenant",
    """WITH p AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM {orders} GROUP BY 1, 2),
       u AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM {orders_right} t GROUP BY 1, 2)
       SELECT COALESCE(p.o_orderpriority, u.o_orderpriority) AS o_orderpriority,
         COALESCE(p.o_orderstatus, u.o_orderstatus) AS o_orderstatus, COALESCE(p.n, 0) AS left_rows,
         COALESCE(u.n, 0) AS right_rows, COALESCE(p.n, 0) - COALESCE(u.n, 0) AS diff
       FROM p FULL JOIN u ON p.o_orderpriority = u.o_orderpriority AND p.o_orderstatus = u.o_orderstatus
       WHERE COALESCE(p.n, 0) <> COALESCE(u.n, 0)
       ORDER BY abs(COALESCE(p.n, 0) - COALESCE(u.n, 0)) DESC, 1, 2 LIMIT 25""",
)
def row_count_by_tenant(i):
    return tenant_row_counts(i["orders"], i["orders_right"], TENANT, 25)


@query(
    "active_tenant_rows",
    """SELECT t.* FROM {orders} t JOIN {active_tenants} act
       ON t.o_orderpriority = act.o_orderpriority AND t.o_orderstatus = act.o_orderstatus""",
)
def active_tenant_rows(i):
    return active_rows(i["orders"], i["active_tenants"], TENANT)


@query(
    "active_tenant_row_counts",
    """WITH act AS (SELECT * FROM {active_tenants} a)
       SELECT p.n AS left_rows, u.n AS right_rows, p.n - u.n AS diff FROM
       (SELECT count(*) AS n FROM {orders} t JOIN act USING (o_orderpriority, o_orderstatus)) p,
       (SELECT count(*) AS n FROM {orders_right} t JOIN act USING (o_orderpriority, o_orderstatus)) u""",
)
def active_tenant_row_counts(i):
    act = i["active_tenants"]
    return key_ops.row_counts(active_rows(i["orders"], act, TENANT), active_rows(i["orders_right"], act, TENANT))


# -- keys --------------------------------------------------------------------------------------------


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM {lineitem} GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_keys(i):
    return key_ops.duplicate_keys(i["lineitem"], LINE_KEY)


@query(
    "top_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM {lineitem} GROUP BY 1, 2 HAVING count(*) > 1
       ORDER BY n DESC, 1, 2 LIMIT 100""",
)
def top_duplicate_keys(i):
    return key_ops.duplicate_keys(i["lineitem"], LINE_KEY, 100)


def _grain_sql(label, keys):
    k = ", ".join(keys)
    return f"""SELECT '{label}' AS grain, p.rows AS left_rows, u.rows AS right_rows, p.dups AS left_dup_keys,
      u.dups AS right_dup_keys, p.extra AS left_extra_rows, u.extra AS right_extra_rows,
      CASE WHEN greatest(p.dups, u.dups) = 0 THEN 'PASS'
        WHEN 100.0 * greatest(p.dups, u.dups) / greatest(p.rows, u.rows) <= 0.1 THEN 'ACCEPTED' ELSE 'FAIL' END AS status,
      CASE WHEN greatest(p.dups, u.dups) = 0
        OR 100.0 * greatest(p.dups, u.dups) / greatest(p.rows, u.rows) <= 0.1 THEN 1 ELSE 0 END AS grain_usable
    FROM (SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS dups,
            CAST(sum(n - 1) AS BIGINT) AS extra FROM (SELECT count(*) AS n FROM {{lineitem}} GROUP BY {k}) a) p,
         (SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS dups,
            CAST(sum(n - 1) AS BIGINT) AS extra FROM (SELECT count(*) AS n FROM {{lineitem_right}} t GROUP BY {k}) a) u"""


GRAINS = {
    "order_line_part": LINE_GRAIN,
    "order_line": LINE_KEY,
    "order_part_supplier": ["l_orderkey", "l_partkey", "l_suppkey"],
}


@query("grain_check", " UNION ALL ".join(_grain_sql(label, keys) for label, keys in GRAINS.items()))
def grain_check(i):
    out = None
    for label, keys in GRAINS.items():
        s = key_ops.key_summary(key_ops.key_profile(i["lineitem"], i["lineitem_right"], keys), keys)
        status = count_status(
            F.greatest("left_dup_keys", "right_dup_keys"), F.greatest("left_rows", "right_rows"), 0.1
        )
        s = s.select(
            F.lit(label).alias("grain"), "left_rows", "right_rows", "left_dup_keys", "right_dup_keys",
            "left_extra_rows", "right_extra_rows", status.alias("status"),
            status.isin("PASS", "ACCEPTED").alias("grain_usable"),
        )
        out = s if out is None else out.unionByName(s)
    return out


_KEY_DIFF = """SELECT '{label}' AS side_pair,
  (SELECT count(*) FROM (SELECT {k} FROM {l} a EXCEPT SELECT {k} FROM {r} b) x) AS left_only,
  (SELECT count(*) FROM (SELECT {k} FROM {r} a EXCEPT SELECT {k} FROM {l} b) x) AS right_only,
  (SELECT count(*) FROM (SELECT {k} FROM {l} a INTERSECT SELECT {k} FROM {r} b) x) AS shared_keys,
  (SELECT count(*) FROM (SELECT DISTINCT {k} FROM {l} a) x) AS left_keys,
  (SELECT count(*) FROM (SELECT DISTINCT {k} FROM {r} a) x) AS right_keys"""


def _key_diff_sql(label, left, right, keys):
    text = _KEY_DIFF
    for name, value in (("label", label), ("k", ", ".join(keys)), ("l", "{%s}" % left), ("r", "{%s}" % right)):
        text = text.replace("{" + name + "}", value)
    return text


KEY_PAIRS = {
    "orders": ("orders", "orders_right", ORDER_KEY),
    "lineitem": ("lineitem", "lineitem_right", LINE_KEY),
    "customer": ("customer_left", "customer_right", ["c_custkey", "c_region"]),
    "hot": ("hot_left", "hot_right", ["k"]),
}


@query("key_diff", " UNION ALL ".join(_key_diff_sql(n, *v) for n, v in KEY_PAIRS.items()))
def key_diff(i):
    out = None
    for name, (left, right, keys) in KEY_PAIRS.items():
        s = key_ops.key_summary(key_ops.key_profile(i[left], i[right], keys), keys).select(
            F.lit(name).alias("side_pair"), "left_only", "right_only", "shared_keys", "left_keys", "right_keys"
        )
        out = s if out is None else out.unionByName(s)
    return out


@query(
    "key_diff_samples",
    """SELECT * FROM (SELECT 'in_left_not_right' AS direction, l_orderkey, l_linenumber FROM
         (SELECT l_orderkey, l_linenumber FROM {lineitem} EXCEPT SELECT l_orderkey, l_linenumber FROM {lineitem_right} b) x
         ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST LIMIT 25) a
       UNION ALL SELECT * FROM (SELECT 'in_right_not_left', l_orderkey, l_linenumber FROM
         (SELECT l_orderkey, l_linenumber FROM {lineitem_right} b EXCEPT SELECT l_orderkey, l_linenumber FROM {lineitem}) x
         ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST LIMIT 25) b""",
)
def key_diff_samples(i):
    return key_ops.key_samples(key_ops.key_profile(i["lineitem"], i["lineitem_right"], LINE_KEY), LINE_KEY, 25)


@query(
    "shared_keys",
    """SELECT c_custkey, c_region FROM {customer_left} a INTERSECT SELECT c_custkey, c_region FROM {customer_right} b""",
)
def shared_keys(i):
    keys = ["c_custkey", "c_region"]
    return key_ops.shared_keys(key_ops.key_profile(i["customer_left"], i["customer_right"], keys), keys)


@query(
    "first_row_per_key",
    """SELECT k, flag, state, quantity, CAST(shipped AS STRING) AS shipped FROM (SELECT *, row_number() OVER (
         PARTITION BY k ORDER BY shipped, quantity, flag, COALESCE(state, '')) AS rn FROM {hot_left} t) x WHERE rn = 1""",
)
def first_row_per_key(i):
    first = key_ops.first_rows(
        i["hot_left"], ["k"], ["shipped", "quantity", "flag", F.coalesce("state", F.lit(""))]
    )
    return first.withColumn("shipped", F.col("shipped").cast("string"))


# -- whole rows ----------------------------------------------------------------------------------------


_ROW_DIFF = """SELECT 'in_left_not_right' AS direction, count(*) AS n FROM (SELECT * FROM {l} a {op} SELECT * FROM {r} b) x
 UNION ALL SELECT 'in_right_not_left', count(*) FROM (SELECT * FROM {r} a {op} SELECT * FROM {l} b) x"""


def _row_diff_sql(left, right, op="EXCEPT"):
    return _ROW_DIFF.replace("{l}", left).replace("{r}", right).replace("{op}", op)


_ORDERS_TEXT = """(SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, '') AS o_orderstatus, o_totalprice, o_orderdate,
  NULLIF(o_orderpriority, '') AS o_orderpriority FROM {%s} t)"""


@query("row_diff", _row_diff_sql(_ORDERS_TEXT % "orders", _ORDERS_TEXT % "orders_right"))
def row_diff(i):
    return row_ops.row_diff(row_ops.row_profile(projection(i["orders"]), projection(i["orders_right"])))


@query("row_diff_keyless_clean", _row_diff_sql("{events}", "{events}"))
def row_diff_keyless_clean(i):
    return row_ops.row_diff(row_ops.row_profile(i["events"], i["events"]))


_TEXTS = "(SELECT doc_id, text, lang, source, n_chars FROM {documents})"
_MARKED = "(SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN text || ' ' ELSE text END AS text, lang, source, n_chars FROM {documents})"


@query("row_diff_documents", _row_diff_sql(_TEXTS, _MARKED))
def row_diff_documents(i):
    """Whole texts as part of the row; some differ by one blank at the end."""
    return row_ops.row_diff(row_ops.row_profile(i["documents"], i.sql(f"SELECT * FROM {_MARKED} t")))


# A third of the rows once more on the left, and those of one line number on the right.
_TWICE = "(SELECT * FROM {%s} a UNION ALL SELECT * FROM {%s} b WHERE %s)"
_LINES_TWICE = _TWICE % ("lineitem", "lineitem", "l_orderkey % 3 = 0")
_RIGHT_TWICE = _TWICE % ("lineitem_right", "lineitem_right", "l_linenumber = 2")


@query("row_diff_multiset", _row_diff_sql(_LINES_TWICE, _RIGHT_TWICE, "EXCEPT ALL"))
def row_diff_multiset(i):
    sides = [i.sql(f"SELECT * FROM {side} t") for side in (_LINES_TWICE, _RIGHT_TWICE)]
    return row_ops.row_diff(row_ops.row_profile(*sides), distinct=False)


_SHARED = """WITH sk AS (SELECT {k} FROM {L} a INTERSECT SELECT {k} FROM {R} b),
 l AS (SELECT {cols} FROM {L} t JOIN sk ON {on}), r AS (SELECT {cols} FROM {R} t JOIN sk ON {on})
 SELECT 'in_left_not_right' AS direction, count(*) AS n FROM (SELECT * FROM l EXCEPT SELECT * FROM r) x
 UNION ALL SELECT 'in_right_not_left', count(*) FROM (SELECT * FROM r EXCEPT SELECT * FROM l) x"""


def _shared_sql(left, right, keys, cols):
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM sk.{k}" for k in keys)
    out = _SHARED
    for name, value in (("k", ", ".join(keys)), ("L", "{%s}" % left), ("R", "{%s}" % right), ("cols", cols), ("on", on)):
        out = out.replace("{" + name + "}", value)
    return out


@query("row_diff_shared_keys", _shared_sql("lineitem", "lineitem_right", LINE_KEY, "t.*"))
def row_diff_shared_keys(i):
    return row_ops.shared_row_diff(i["lineitem"], i["lineitem_right"], LINE_KEY)


@query(
    "row_diff_shared_keys_hot",
    _shared_sql("hot_left", "hot_right", ["k", "flag"], "t.k, NULLIF(t.state, '') AS state, t.quantity, t.shipped"),
)
def row_diff_shared_keys_hot(i):
    """A text key that the projection drops, and one key value with half of all rows."""
    return row_ops.shared_row_diff(i["hot_left"], i["hot_right"], ["k", "flag"], drop=["flag"])


_ROW_SAMPLES = """SELECT 'in_left_not_right' AS direction, * FROM (SELECT * FROM (SELECT * FROM {l} a EXCEPT SELECT * FROM {r} b) x
   ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 100) y
 UNION ALL SELECT 'in_right_not_left', * FROM (SELECT * FROM (SELECT * FROM {r} a EXCEPT SELECT * FROM {l} b) x
   ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 100) y"""
@query("row_diff_samples", _ROW_SAMPLES.replace("{l}", _ORDERS_TEXT % "orders").replace("{r}", _ORDERS_TEXT % "orders_right"))
def row_diff_samples(i):
    profile = row_ops.row_profile(projection(i["orders"]), projection(i["orders_right"]))
    return row_ops.row_samples(profile, 100)


# -- columns -------------------------------------------------------------------------------------------


@query(
    "column_diff",
    pairs_sql("{orders}", "{orders_right}", ORDER_KEY, ORDER_COLUMNS, text=["o_orderstatus", "o_orderpriority"]),
)
def column_diff(i):
    return tall(col_ops.column_diff(col_ops.compare(i["orders"], i["orders_right"], ORDER_KEY)))


ORDER_WHERE = {
    "o_orderdate": "uat_value::date <= '1998-01-01'",
    "o_totalprice": "round(prod_value, 0) = round(uat_value, 0)",
    "o_orderstatus": "prod_value = 'F' or uat_value is not null",
    "o_custkey": "uat_value between 100 and 900 and not prod_value::string = '300'",
}
ORDER_WHERE_SQL = {
    "o_orderdate": "CAST($u AS DATE) <= DATE '1998-01-01'",
    "o_totalprice": "floor($p + 0.5) = floor($u + 0.5)",
    "o_orderstatus": "$p = 'F' OR $u IS NOT NULL",
    "o_custkey": "$u BETWEEN 100 AND 900 AND NOT CAST($p AS VARCHAR) = '300'",
}


def _residual_sql(null_explains):
    return pairs_sql(
        "{orders}", "{orders_right}", ORDER_KEY, ORDER_COLUMNS, text=["o_orderstatus", "o_orderpriority"],
        where=ORDER_WHERE_SQL, null_explains=null_explains,
    )


@query("column_diff_residual", _residual_sql(True))
def column_diff_residual(i):
    return tall(col_ops.column_diff(col_ops.compare(i["orders"], i["orders_right"], ORDER_KEY, where=ORDER_WHERE)))


@query("column_diff_residual_null_unexplained", _residual_sql(False))
def column_diff_residual_null_unexplained(i):
    c = col_ops.compare(i["orders"], i["orders_right"], ORDER_KEY, where=ORDER_WHERE, null_explains=False)
    return tall(col_ops.column_diff(c))


LINE_COLUMNS = [
    "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(
    "column_diff_fan_out",
    pairs_sql(
        "{lineitem}", "{lineitem_right}", LINE_KEY, ["l_partkey", *LINE_COLUMNS], text=["l_returnflag", "l_linestatus"],
        where={
            "l_quantity": "$p > 20 OR floor($p) = floor($u)",
            "l_returnflag": "$p = 'A'",
            "l_linestatus": "$u = 'O' AND $p IS NOT NULL",
            "l_tax": "$p < $u",
        },
    ),
)
def column_diff_fan_out(i):
    """Keys with several rows on both sides: the join's pair counts without its pairs."""
    c = col_ops.compare(
        i["lineitem"], i["lineitem_right"], LINE_KEY,
        where={
            "l_quantity": "prod_value > 20 or round(prod_value) = round(uat_value)",
            "l_returnflag": "prod_value = 'A'",
            "l_linestatus": "uat_value = 'O' and prod_value is not null",
            "l_tax": "prod_value < uat_value",
        },
    )
    return tall(col_ops.column_diff(c))


# Pair counts of the hot key from value counts; joining its rows would pair half the table with half the table.
_HOT_EQUAL = " UNION ALL ".join(
    f"""SELECT '{c}' AS col_name, {i} AS ordinal, CAST(sum(s.pairs) AS BIGINT) AS shared,
    CAST(sum(s.pairs - COALESCE(e.pairs, 0)) AS BIGINT) AS mismatches FROM
    (SELECT a.k, a.n * b.n AS pairs FROM (SELECT k, count(*) AS n FROM l GROUP BY k) a
       JOIN (SELECT k, count(*) AS n FROM r GROUP BY k) b ON a.k = b.k) s
    LEFT JOIN (SELECT a.k, sum(a.n * b.n) AS pairs FROM (SELECT k, {c}, count(*) AS n FROM l GROUP BY 1, 2) a
       JOIN (SELECT k, {c}, count(*) AS n FROM r GROUP BY 1, 2) b ON a.k = b.k AND a.{c} IS NOT DISTINCT FROM b.{c}
       GROUP BY a.k) e ON s.k = e.k"""
    for i, c in enumerate(["flag", "state", "quantity", "shipped"])
)


@query(
    "column_diff_hot_key",
    f"WITH l AS (SELECT * FROM {{hot_left}} t), r AS (SELECT * FROM {{hot_right}} t) {_HOT_EQUAL}",
)
def column_diff_hot_key(i):
    c = col_ops.compare(i["hot_left"], i["hot_right"], ["k"])
    return tall(col_ops.column_diff(c)).drop("residual")


@query(
    "column_diff_hot_equal_rows",
    "WITH l AS (SELECT k, flag FROM {hot_left} t), r AS (SELECT k, flag FROM {hot_right} t) " + _HOT_EQUAL.split(" UNION ALL ")[0],
)
def column_diff_hot_equal_rows(i):
    """One key with half of all rows, most of which are equal to very many others."""
    sides = [i[name].select("k", "flag") for name in ("hot_left", "hot_right")]
    return tall(col_ops.column_diff(col_ops.compare(*sides, ["k"]))).drop("residual")


@query(
    "column_diff_distance_hot",
    """WITH l AS (SELECT k, quantity AS v, quantity / 8.0 AS w, count(*) AS n FROM {hot_left} t GROUP BY 1, 2, 3),
 r AS (SELECT k, quantity AS v, quantity / 8.0 AS w, count(*) AS n FROM {hot_right} t GROUP BY 1, 2, 3),
 j AS (SELECT l.v AS a, r.v AS b, l.w AS c, r.w AS d, l.n * r.n AS n FROM l JOIN r ON l.k = r.k)
 SELECT 'quantity' AS col_name, 0 AS ordinal, CAST(sum(n) AS BIGINT) AS shared,
   CAST(sum(CASE WHEN a IS DISTINCT FROM b THEN n ELSE 0 END) AS BIGINT) AS mismatches,
   CAST(sum(CASE WHEN a IS DISTINCT FROM b AND NOT COALESCE(abs(a - b) <= 2 OR a > 45, true) THEN n ELSE 0 END) AS BIGINT) AS residual FROM j
 UNION ALL SELECT 'eighths', 1, CAST(sum(n) AS BIGINT), CAST(sum(CASE WHEN c IS DISTINCT FROM d THEN n ELSE 0 END) AS BIGINT),
   CAST(sum(CASE WHEN c IS DISTINCT FROM d AND NOT COALESCE(abs(c - d) < 0.25, true) THEN n ELSE 0 END) AS BIGINT) FROM j""",
)
def column_diff_distance_hot(i):
    """Distances between the values of one key with half of all rows, counted over ranges: no pair is formed."""
    sides = [i[name].select("k", "quantity", (F.col("quantity") / F.lit(8.0)).alias("eighths")) for name in ("hot_left", "hot_right")]
    where = {"quantity": "abs(prod_value - uat_value) <= 2 or prod_value > 45", "eighths": "abs(prod_value - uat_value) < 0.25"}
    return tall(col_ops.column_diff(col_ops.compare(*sides, ["k"], where=where)))


_CUSTOMER = ["c_name", "c_acctbal", "c_mktsegment"]


@query(
    "column_diff_null_keys",
    pairs_sql("{customer_left}", "{customer_right}", ["c_custkey", "c_region"], _CUSTOMER, text=["c_name", "c_mktsegment"]),
)
def column_diff_null_keys(i):
    c = col_ops.compare(i["customer_left"], i["customer_right"], ["c_custkey", "c_region"])
    return tall(col_ops.column_diff(c))


@query(
    "column_diff_null_safe",
    pairs_sql(
        "{customer_left}", "{customer_right}", ["c_custkey", "c_region"], _CUSTOMER, True, text=["c_name", "c_mktsegment"]
    ),
)
def column_diff_null_safe(i):
    c = col_ops.compare(i["customer_left"], i["customer_right"], ["c_custkey", "c_region"], null_safe=True)
    return tall(col_ops.column_diff(c))


_COUNTS = pairs_sql(
    "{orders}", "{orders_right}", ORDER_KEY, ORDER_COLUMNS, text=["o_orderstatus", "o_orderpriority"],
    where={k: ORDER_WHERE_SQL[k] for k in ("o_orderdate", "o_totalprice")},
)
_RANKED = f"""SELECT col_name, ordinal, mismatches, residual, position FROM (SELECT *, row_number() OVER (
  ORDER BY CASE WHEN residual IS NOT NULL THEN 0 ELSE 1 END, COALESCE(residual, mismatches) DESC, ordinal) AS position
  FROM ({_COUNTS}) c WHERE mismatches > 0) x WHERE residual IS NOT NULL OR position <= 3"""
TWO_WHERE = {k: ORDER_WHERE[k] for k in ("o_orderdate", "o_totalprice")}


@query("ranked_columns", _RANKED)
def ranked_columns(i):
    c = col_ops.compare(i["orders"], i["orders_right"], ORDER_KEY, where=TWO_WHERE)
    return tall(col_ops.ranked_columns(col_ops.column_diff(c), 3)).drop("shared")


def _sample_sql(c, text, where, per=5):
    p, u = (f"NULLIF(p.{c}, '')", f"NULLIF(u.{c}, '')") if text else (f"p.{c}", f"u.{c}")
    known = f"AND NOT COALESCE({where.replace('$p', p).replace('$u', u)}, true)" if where else ""
    return f"""SELECT * FROM (SELECT '{c}' AS col_name, row_number() OVER (ORDER BY p.o_orderkey) AS sample,
      CAST(p.o_orderkey AS VARCHAR) AS o_orderkey, CAST({p} AS VARCHAR) AS left_value, CAST({u} AS VARCHAR) AS right_value
      FROM p JOIN u ON p.o_orderkey = u.o_orderkey WHERE {p} IS DISTINCT FROM {u} {known}) s WHERE sample <= {per}"""


@query(
    "column_samples",
    "WITH p AS (SELECT * FROM {orders}), u AS (SELECT * FROM {orders_right} t) "
    + " UNION ALL ".join(
        _sample_sql(c, c in ("o_orderstatus", "o_orderpriority"), {k: ORDER_WHERE_SQL[k] for k in TWO_WHERE}.get(c))
        for c in ("o_orderdate", "o_totalprice", "o_orderstatus")
    ),
)
def column_samples(i):
    """Samples of the three columns ranked highest."""
    c = col_ops.compare(i["orders"], i["orders_right"], ORDER_KEY, where=TWO_WHERE)
    aligned = col_ops.align_unique(c)
    ranked = col_ops.ranked_columns(col_ops.mismatch_counts(c, aligned), 3)
    return tall(col_ops.column_samples(c, aligned, 5, ranked))


# -- first row per key, as the extract ladder compares -------------------------------------------------------


_FIRST = """WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
   ORDER BY l_partkey, l_suppkey, l_extendedprice, l_tax) AS rn, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
   FROM {lineitem}) x WHERE rn = 1),
 r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
   ORDER BY l_partkey, l_suppkey, l_extendedprice, l_tax) AS rn, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
   FROM {lineitem_right} t) x WHERE rn = 1)"""
_PLACE = ["l_partkey", "l_suppkey", "l_extendedprice", "l_tax"]


def _first_comparison(i):
    place = [F.col(c).alias(f"o_{c}") for c in _PLACE]
    c = col_ops.compare(
        i["lineitem"], i["lineitem_right"], LINE_KEY, ["l_partkey", *LINE_COLUMNS], nullif_text=False, null_safe=True,
        null_explains=False, where={"l_quantity": "prod_value > 20"}, carry=place,
    )
    return c, col_ops.align_first(c, [f"o_{x}" for x in _PLACE])


@query(
    "csv_key_diff",
    _FIRST
    + """SELECT (SELECT CAST(sum(n) AS BIGINT) FROM l) AS left_rows, (SELECT CAST(sum(n) AS BIGINT) FROM r) AS right_rows,
  (SELECT count(*) FROM l) AS left_keys, (SELECT count(*) FROM r) AS right_keys,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM l) AS left_extra_rows,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM r) AS right_extra_rows,
  (SELECT count(*) FROM l ANTI JOIN r USING (l_orderkey, l_linenumber)) AS left_only,
  (SELECT count(*) FROM r ANTI JOIN l USING (l_orderkey, l_linenumber)) AS right_only,
  (SELECT count(*) FROM l JOIN r USING (l_orderkey, l_linenumber)) AS shared_keys""",
)
def csv_key_diff(i):
    c, aligned = _first_comparison(i)
    wide, counts = col_ops.first_row_counts(c, aligned)
    return wide.select(*counts)


@query(
    "csv_column_diff",
    _FIRST
    + mismatches_sql(["l_partkey", *LINE_COLUMNS], where={"l_quantity": "$p > 20"}, null_explains=False).replace(
        "FROM j", "FROM l p JOIN r u ON p.l_orderkey = u.l_orderkey AND p.l_linenumber = u.l_linenumber"
    ),
)
def csv_column_diff(i):
    c, aligned = _first_comparison(i)
    wide, _ = col_ops.first_row_counts(c, aligned)
    return tall(col_ops.tall_counts(c, wide))


_WHOLE = ", ".join([*LINE_KEY, "l_partkey", *LINE_COLUMNS])
_DIFFER = f"""EXISTS (SELECT {_WHOLE} FROM l EXCEPT ALL SELECT {_WHOLE} FROM r)
      OR EXISTS (SELECT {_WHOLE} FROM r EXCEPT ALL SELECT {_WHOLE} FROM l)"""


@query(
    "csv_fingerprint",
    _FIRST + f"SELECT CASE WHEN {_DIFFER} THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN {_DIFFER} THEN 2 ELSE 1 END AS distinct_fingerprints",
)
def csv_fingerprint(i):
    """First rows of all keys, over all columns."""
    c, aligned = _first_comparison(i)
    at = {name: n for n, name in enumerate(c.columns)}
    sides = [
        aligned.where(F.col(n) > 0).select("k0", "k1", *[F.col(f"{side}{at[x]}").alias(x) for x in c.columns])
        for side, n in (("l", key_ops.LEFT_N), ("r", key_ops.RIGHT_N))
    ]
    return fingerprint_compare(*sides)


# -- fingerprints ----------------------------------------------------------------------------------------


_CENTS = """SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, '') AS o_orderstatus,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(o_orderdate AS STRING) AS day FROM {orders_right} t"""
_ENCODED = " || ".join(
    f"COALESCE(CAST(length(CAST({c} AS STRING)) AS STRING) || ':' || CAST({c} AS STRING), '-')"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "cents", "day")
)


@query(
    "fingerprint",
    f"""SELECT count(*) AS rows, CAST(sum(CAST(CAST('0x' || substr(h, 1, 15) AS BIGINT) AS DECIMAL(38, 0))) AS VARCHAR) AS lane_1,
  CAST(sum(CAST(CAST('0x' || substr(h, 17, 15) AS BIGINT) AS DECIMAL(38, 0))) AS VARCHAR) AS lane_2
  FROM (SELECT md5({_ENCODED}) AS h FROM ({_CENTS}) c) x""",
)
def fingerprint_orders(i):
    return fingerprint(i.sql(_CENTS))


@query(
    "fingerprint_compare",
    """SELECT 'events' AS pair, 1 AS distinct_fingerprints, 'PASS' AS status
  UNION ALL SELECT 'orders', n, CASE WHEN n = 1 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT CASE WHEN
    EXISTS (SELECT * FROM {orders} EXCEPT ALL SELECT * FROM {orders_right} t) OR
    EXISTS (SELECT * FROM {orders_right} t EXCEPT ALL SELECT * FROM {orders}) THEN 2 ELSE 1 END AS n) x
  UNION ALL SELECT 'documents', n, CASE WHEN n = 1 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT CASE WHEN
    EXISTS (SELECT lang, text FROM {documents} EXCEPT ALL SELECT lang, trim(text) FROM {documents})
    THEN 2 ELSE 1 END AS n) x""",
)
def fingerprint_pairs(i):
    """The same rows in another order, a drifted copy, and whole texts before and after trimming."""
    events, docs = i["events"], i["documents"].select("lang", "text")
    pairs = {
        "events": (events, events.repartition("event_type")),
        "orders": (i["orders"], i["orders_right"]),
        "documents": (docs, docs.withColumn("text", F.trim("text"))),
    }
    out = None
    for name, (left, right) in pairs.items():
        s = fingerprint_compare(left, right).withColumn("pair", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out


@query(
    "column_tier_status",
    f"""SELECT count(*) FILTER (WHERE mismatches > 0) AS mismatched_columns,
  CASE WHEN count(*) FILTER (WHERE mismatches > 0) = 0 THEN 'PASS'
    WHEN count(*) FILTER (WHERE mismatches > 0 AND 100.0 * mismatches / shared > 1.5) > 0 THEN 'FAIL'
    ELSE 'ACCEPTED' END AS status FROM ({_COUNTS}) c""",
)
def column_tier(i):
    c = col_ops.compare(i["orders"], i["orders_right"], ORDER_KEY)
    counts = col_ops.column_diff(c).where(F.col("mismatches") > 0)
    return column_tier_status(
        counts.withColumn("status", count_status(F.col("mismatches"), F.col("shared"), 1.5))
    )
