"""Status, gate and verdict rules over views derived from orders: a view per customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.functions.display import percent_text, shown_value
from twinledger.plans import status as status_ops, wording
from twinledger.plans.gates import tier_gates
from twinledger.queries.registry import query

_WITHIN = "{n} > 0 AND {d} > 0 AND 100.0 * {n} / {d} <= {t}"


def _count_status_sql(n, d, t):
    return f"CASE WHEN {n} = 0 THEN 'PASS' WHEN {_WITHIN.format(n=n, d=d, t=t)} THEN 'ACCEPTED' ELSE 'FAIL' END"


@query(
    "threshold_status",
    f"""SELECT c, n, n53, {_count_status_sql('n53', 'n', 10)} AS at_ten, {_count_status_sql('n53', 'n', 0)} AS never,
  CASE WHEN {_WITHIN.format(n='n53', d='n', t=10)} THEN 1 ELSE 0 END AS within_ten,
  {_count_status_sql('n53', '(n % 2)', 100)} AS without_base FROM {{slices}} s""",
)
def threshold_status(i):
    n, base = F.col("n53"), F.col("n")
    return i["slices"].select(
        "c", "n", "n53",
        status_ops.count_status(n, base, 10.0).alias("at_ten"),
        status_ops.count_status(n, base, 0).alias("never"),
        status_ops.within(n, base, 10.0).alias("within_ten"),
        status_ops.count_status(n, base % 2, 100.0).alias("without_base"),
    )


_COLUMN_STATUS = f"""SELECT k.view, k.col_name, k.ordinal, k.shared, k.mismatches, k.residual,
  CASE WHEN a.cond IS NOT NULL THEN CASE WHEN rest = 0 THEN 'ACCEPTED_MARKED'
      WHEN 100.0 * rest / shared <= 10 THEN 'ACCEPTED_THRESHOLD' ELSE 'FAIL' END
    WHEN a.view IS NOT NULL THEN 'ACCEPTED_MARKED'
    WHEN 100.0 * mismatches / shared <= 10 THEN 'ACCEPTED_THRESHOLD' ELSE 'FAIL' END AS status,
  CASE WHEN a.cond IS NOT NULL THEN base || '{wording.COVERS}' || (mismatches - rest) || '{wording.OF}' || mismatches
      || CASE WHEN rest = 0 THEN ')' WHEN 100.0 * rest / shared <= 10 THEN '{wording.TOLERABLE}' ELSE '{wording.OPEN}' END
    WHEN a.view IS NOT NULL THEN base END AS reason
 FROM (SELECT *, COALESCE(residual, mismatches) AS rest FROM {{column_counts}} q) k
 LEFT JOIN (SELECT *, CASE WHEN reason = '' THEN '{wording.LISTED}' ELSE reason END AS base
   FROM {{accepted_columns}} q) a ON k.view = a.view AND k.col_name = a.col_name WHERE mismatches > 0"""


def _column_rows(i):
    counts = i["column_counts"].withColumnRenamed("col_name", "column")
    accepted = i["accepted_columns"].withColumnsRenamed({"col_name": "column", "cond": "where"})
    return status_ops.column_status(counts, accepted, 10.0, on=["view"])


@query("column_status", _COLUMN_STATUS)
def column_status(i):
    return _column_rows(i).withColumnRenamed("column", "col_name")


@query(
    "column_tier_by_view",
    f"""SELECT view, count(*) AS mismatched_columns, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' ELSE 'ACCEPTED' END AS status
  FROM ({_COLUMN_STATUS}) c GROUP BY view""",
)
def column_tier_by_view(i):
    return status_ops.column_tier_status(_column_rows(i), ["view"])


@query(
    "worst_column",
    f"""SELECT view, count(*) AS mismatched_columns, count(*) FILTER (WHERE status = 'FAIL') AS failing,
   count(*) FILTER (WHERE status <> 'FAIL') AS accepted, CAST(max(shared) AS BIGINT) AS shared,
   first(col_name ORDER BY mismatches DESC, ordinal) AS worst_column, CAST(max(mismatches) AS BIGINT) AS worst_mismatches,
   regexp_replace(printf('%d.%03d', CAST((200000 * max(mismatches) + max(shared)) // (2 * max(shared)) // 1000 AS BIGINT),
     CAST((200000 * max(mismatches) + max(shared)) // (2 * max(shared)) % 1000 AS BIGINT)), '\\.?0+$', '') || '%' AS share
  FROM ({_COLUMN_STATUS}) c GROUP BY view""",
)
def worst_column(i):
    worst = status_ops.worst_column(_column_rows(i), ["view"])
    return worst.withColumn("share", percent_text(F.col("worst_mismatches"), F.col("shared")))


@query(
    "shown_values",
    """SELECT doc_id, CASE WHEN v IS NULL THEN 'NULL' WHEN v = '' THEN '(blank)'
    WHEN length(v) > 120 THEN substr(v, 1, 120) || '...' ELSE v END AS shown FROM (
    SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '' ELSE text END AS v FROM {documents}) d""",
)
def shown_values(i):
    values = i.sql(
        """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '' ELSE text END AS v
           FROM {documents}"""
    )
    return values.select("doc_id", shown_value(F.col("v")).alias("shown"))


# -- overrides ---------------------------------------------------------------------------------------------

_OVERRIDES = """SELECT view, 'D2' AS tier, 'timing' AS reason FROM {outcomes} o WHERE has_accepted
  UNION ALL SELECT view, 'D4', NULL FROM {outcomes} o WHERE usable
  UNION ALL SELECT view, 'T2', '' FROM {outcomes} o WHERE always"""


@query(
    "accept_overrides",
    f"""SELECT t.mode, t.view, t.tier, CASE WHEN hit THEN 'ACCEPTED' ELSE t.status END AS status,
   CASE WHEN hit THEN 1 ELSE 0 END AS accepted_via_config,
   CASE WHEN hit THEN t.tier || ': ' || CASE WHEN t.status = 'FAIL' THEN '{wording.ACCEPTED_BY_CONFIG}' ELSE '{wording.TOLERATED_ANYWAY}' END
      || CASE WHEN reason <> '' THEN ': ' || reason ELSE '' END END AS note
 FROM (SELECT a.*, o.reason, o.view IS NOT NULL AND a.status IN ('FAIL', 'ACCEPTED') AS hit FROM {{tier_rows}} a
   LEFT JOIN ({_OVERRIDES}) o ON a.view = o.view AND a.tier = o.tier) t""",
)
def accept_overrides(i):
    return status_ops.apply_overrides(i["tier_rows"], i.sql(_OVERRIDES))


# -- gates -------------------------------------------------------------------------------------------------

_CLEAN = "('PASS', 'SKIPPED')"


def _rows(rows):
    return " UNION ALL ".join(
        f"SELECT view, '{tier}' AS tier, {status} AS status, {reason} AS reason FROM {source} WHERE {when}"
        for tier, status, reason, when, source in rows
    )


_T_GATES = "WITH o AS (SELECT *, CASE WHEN has_grain AND usable THEN s3 ELSE s2 END AS content FROM {outcomes} q) " + _rows(
    [
        ("T0", "s0", "NULL", "present", "o"),
        ("T1", "CASE WHEN has_grain THEN s1 ELSE 'SKIPPED' END", f"CASE WHEN NOT has_grain THEN '{wording.NO_KEYS}' END",
         "present AND s0 = 'PASS'", "o"),
        ("T2", "s2", "NULL", "present AND s0 = 'PASS'", "o"),
        ("T3", "CASE WHEN has_grain AND usable THEN s3 ELSE 'SKIPPED' END",
         f"CASE WHEN NOT has_grain THEN '{wording.NO_KEYS}' WHEN NOT usable THEN '{wording.KEYS_UNUSABLE}' END",
         "present AND s0 = 'PASS'", "o"),
        ("T4", "CASE WHEN always OR content = 'PASS' THEN s4 ELSE 'SKIPPED' END",
         f"""CASE WHEN always OR content = 'PASS' THEN NULL
            WHEN content = 'ACCEPTED' THEN '{wording.TOLERATED}' ELSE '{wording.DIFFERS}' END""", "present AND s0 = 'PASS'", "o"),
    ]
)
_D_GATES = (
    """WITH o AS (SELECT *, CASE WHEN has_grain THEN s2 ELSE 'SKIPPED' END AS k,
       CASE WHEN has_grain AND usable THEN s3 ELSE 'SKIPPED' END AS m FROM {outcomes} q) """
    + _rows(
        [
            ("D0", "s0", "NULL", "present", "o"),
            ("D1", "CASE WHEN has_grain THEN s1 ELSE 'SKIPPED' END", f"CASE WHEN NOT has_grain THEN '{wording.NO_KEYS}' END",
             "present AND s0 = 'PASS'", "o"),
            ("D2", "k", f"CASE WHEN NOT has_grain THEN '{wording.NO_KEYS}' END", "present AND s0 = 'PASS'", "o"),
            ("D3", "m", f"CASE WHEN NOT (has_grain AND usable) THEN '{wording.KEYS_UNUSABLE}' END",
             "present AND s0 = 'PASS'", "o"),
            ("D4", f"CASE WHEN always OR (k IN {_CLEAN} AND m IN {_CLEAN}) THEN s4 ELSE 'SKIPPED' END",
             f"""CASE WHEN always OR (k IN {_CLEAN} AND m IN {_CLEAN}) THEN NULL
                WHEN 'FAIL' IN (k, m) THEN '{wording.DIFFERS}' ELSE '{wording.TOLERATED}' END""",
             "present AND s0 = 'PASS'", "o"),
        ]
    )
)
_C_GATES = (
    """WITH o AS (SELECT *, CASE WHEN has_grain THEN s3 ELSE 'SKIPPED' END AS k,
       CASE WHEN has_grain THEN s4 ELSE 'SKIPPED' END AS m FROM {outcomes} q) """
    + _rows(
        [
            ("C0", "CASE WHEN present THEN 'PASS' ELSE 'FAIL' END", "NULL", "true", "o"),
            ("C1", "s0", "NULL", "present", "o"),
            ("C2", "s2", "NULL", "present AND s0 = 'PASS'", "o"),
            ("C3", "k", f"CASE WHEN NOT has_grain THEN '{wording.NO_KEYS}' END", "present AND s0 = 'PASS'", "o"),
            ("C4", "m", f"CASE WHEN NOT has_grain THEN '{wording.NO_KEYS}' END",
             "present AND s0 = 'PASS'", "o"),
            ("C5", f"CASE WHEN always OR (s2 = 'PASS' AND k IN {_CLEAN} AND m IN {_CLEAN}) THEN s5 ELSE 'SKIPPED' END",
             f"""CASE WHEN always OR (s2 = 'PASS' AND k IN {_CLEAN} AND m IN {_CLEAN}) THEN NULL
                WHEN 'FAIL' IN (s2, k, m) THEN '{wording.DIFFERS}' ELSE '{wording.TOLERATED}' END""",
             "present AND s0 = 'PASS'", "o"),
        ]
    )
)


def _outcomes(i, names):
    return i["outcomes"].select(
        "view", "present", "has_grain", "usable", "always", *[F.col(s).alias(t) for t, s in names.items()]
    )


@query("tier_gates_t", _T_GATES)
def tier_gates_t(i):
    return tier_gates(_outcomes(i, {"T0": "s0", "T1": "s1", "T2": "s2", "T3": "s3", "T4": "s4"}), "T", ["view"])


@query("tier_gates_d", _D_GATES)
def tier_gates_d(i):
    return tier_gates(_outcomes(i, {"D0": "s0", "D1": "s1", "D2": "s2", "D3": "s3", "D4": "s4"}), "D", ["view"])


@query("tier_gates_c", _C_GATES)
def tier_gates_c(i):
    rows = _outcomes(i, {"C1": "s0", "C2": "s2", "C3": "s3", "C4": "s4", "C5": "s5"})
    rows = rows.withColumn("C0", F.when(F.col("present"), F.lit("PASS")).otherwise(F.lit("FAIL")))
    return tier_gates(rows, "C", ["view"])


# -- verdicts ----------------------------------------------------------------------------------------------

_VERDICTS = """SELECT v.mode, v.view, v.has_accepted, v.no_grain, CASE
   WHEN s.view IS NULL OR absent THEN 'BLOCKED'
   WHEN drift AND v.mode = 'dwi' THEN 'D0 DRIFT' WHEN drift AND v.mode = 'bi' THEN 'T0 DRIFT'
   WHEN drift THEN 'HEADER DRIFT' WHEN idle THEN 'DRY' WHEN err THEN 'ERROR' WHEN bad THEN 'DIFFS FOUND'
   WHEN acc OR v.has_accepted THEN 'PASS (DIFFS ACCEPTED' || CASE WHEN v.no_grain AND v.mode <> 'bi' THEN ', NO GRAIN)' ELSE ')' END
   WHEN v.no_grain AND v.mode <> 'bi' THEN 'PASS (NO GRAIN)' ELSE 'PASS' END AS verdict
  FROM {judged_views} v LEFT JOIN (SELECT mode, view, bool_or(tier = 'C0' AND status = 'FAIL') AS absent,
    bool_or(tier IN ('D0', 'T0', 'C1') AND status = 'FAIL') AS drift, bool_or(status = 'ERROR') AS err,
    bool_or(status = 'FAIL') AS bad, bool_or(status = 'ACCEPTED') AS acc,
    bool_and(status IN ('DRY', 'SKIPPED')) AS idle FROM {tier_rows} t GROUP BY 1, 2) s USING (mode, view)"""
_ATTENTION = "('DIFFS FOUND', 'HEADER DRIFT', 'T0 DRIFT', 'D0 DRIFT', 'ERROR')"


def _results(i):
    return status_ops.verdicts(i["tier_rows"], i["judged_views"], ["mode", "view"])


_FLAGS = "CASE WHEN has_accepted THEN 1 ELSE 0 END AS has_accepted, CASE WHEN no_grain THEN 1 ELSE 0 END AS no_grain"


@query("verdicts", f"SELECT mode, view, {_FLAGS}, verdict FROM ({_VERDICTS}) x")
def verdicts(i):
    return _results(i)


def _bucket_sql(v):
    return f"""CASE WHEN {v} IS NULL OR {v} = '' THEN 'none' WHEN {v} IN ('PASS', 'BLOCKED', 'DRY') THEN {v}
    WHEN {v} LIKE '%NO GRAIN%' THEN 'NOGRAIN' WHEN {v} LIKE 'PASS (%' THEN 'ACC' WHEN {v} LIKE '%DRIFT%' THEN 'DRIFT'
    WHEN {v} = 'ERROR' THEN 'ERROR' ELSE 'DIFFS' END"""


@query("verdict_kpis", f"SELECT mode, {_bucket_sql('verdict')} AS bucket, count(*) AS views FROM ({_VERDICTS}) x GROUP BY 1, 2")
def verdict_kpis(i):
    return status_ops.verdict_kpis(_results(i), ["mode"])


@query("attention_list", f"SELECT mode, view, verdict FROM ({_VERDICTS}) x WHERE verdict IN {_ATTENTION}")
def attention_list(i):
    return status_ops.attention_list(_results(i)).select("mode", "view", "verdict")


@query(
    "grain_coverage",
    "SELECT mode, count(*) FILTER (WHERE no_grain) AS no_grain, count(*) AS views FROM {judged_views} v GROUP BY mode",
)
def grain_coverage(i):
    return status_ops.grain_coverage(i["judged_views"])


@query("views_without_grain", "SELECT mode, view FROM {judged_views} v WHERE no_grain")
def views_without_grain(i):
    return status_ops.views_without_grain(i["judged_views"]).select("mode", "view")


@query(
    "tier_matrix",
    """SELECT view, """
    + ", ".join(f"max(CASE WHEN tier = 'D{n}' THEN status END) AS d{n}" for n in range(5))
    + " FROM {tier_rows} t WHERE mode = 'dwi' GROUP BY view",
)
def tier_matrix(i):
    wide = status_ops.tier_matrix(i["tier_rows"].where("mode = 'dwi'"), ["view"], "D")
    return wide.withColumnsRenamed({f"D{n}": f"d{n}" for n in range(5)})


@query(
    "history_matrix",
    "SELECT id, "
    + ", ".join(
        f"COALESCE(max(CASE WHEN run = 'results_20240{n}01_0000' THEN {_bucket_sql('verdict')} END), 'none') "
        f"AS results_20240{n}01_0000"
        for n in (1, 2, 3)
    )
    + " FROM {run_results} r GROUP BY id",
)
def history_matrix(i):
    return status_ops.history_matrix(i["run_results"])
