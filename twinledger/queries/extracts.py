"""Cell rules, predicates, and the extract path over CSV files written from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.functions.normalise import CellRules, cell_projection
from twinledger.functions.predicates import explained, usable
from twinledger.plans.ladders import Settings, ViewSpec, gather, run_all, run_extracts, run_tables
from twinledger.queries.registry import query
from twinledger.sources.extracts import extract_counts, read_extract
from twinledger.sources.storage import new_path

# -- cell rules ----------------------------------------------------------------------------------------------

# DuckDB forms of the rules, written independently of the Spark expressions.
_TRIM = "trim({v}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))"


def _cell_sql(c, flagged=False, blank_as_null=True, case=False, booleans=True, timestamps=True, trim=True, scale=None):
    s = _TRIM.replace("{v}", c) if trim else c
    v = s
    if timestamps:
        v = f"regexp_replace({s}, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}})(\\.0+)?(\\+00:?00|Z)?$', '\\1')"
    number = f"regexp_matches({v}, '^-?[0-9]+(\\.[0-9]+)?$')"
    out = f"CASE WHEN {number} AND contains({v}, '.') THEN rtrim(rtrim({v}, '0'), '.') ELSE {v} END"
    if case:
        out = f"lower({out})"
    if scale is not None:
        out = f"CASE WHEN {number} THEN printf('%.{scale}f', round_even(CAST({v} AS DOUBLE), {scale})) ELSE {out} END"
    if booleans:
        yes, no = "'true', 't', 'yes', 'y'", "'false', 'f', 'no', 'n'"
        if flagged:
            yes, no = yes + ", '1'", no + ", '0'"
        out = f"CASE WHEN lower({v}) IN ({yes}) THEN 'true' WHEN lower({v}) IN ({no}) THEN 'false' ELSE {out} END"
    token = f"lower({s}) IN ('', 'null', chr(92) || 'n')"
    return f"CASE WHEN {token} THEN {'NULL' if blank_as_null else s} ELSE {out} END AS {c}"


CELLS = ["flag", "status", "amount", "modified", "priority"]


@query(
    "cell_normalise",
    "SELECT o_orderkey, "
    + ", ".join(_cell_sql(c, flagged=c == "flag") for c in CELLS)
    + " FROM {rendered_cells} t",
)
def cell_normalise(i):
    rules = CellRules(boolean_columns=("FLAG",))
    return cell_projection(i["rendered_cells"], rules, CELLS, ["o_orderkey"])


@query(
    "cell_normalise_options",
    "SELECT o_orderkey, "
    + ", ".join(_cell_sql(c, blank_as_null=False, case=True, booleans=False, timestamps=False) for c in CELLS)
    + " FROM {rendered_cells} t",
)
def cell_normalise_options(i):
    rules = CellRules(blank_as_null=False, case_insensitive=True, normalise_booleans=False, normalise_timestamps=False)
    return cell_projection(i["rendered_cells"], rules, CELLS, ["o_orderkey"])


@query(
    "cell_numeric_scale",
    """SELECT o_orderkey, CASE WHEN k = 0 THEN CAST(n AS VARCHAR) || '.00'
    WHEN k = 1 THEN '-' || CAST(n AS VARCHAR) || CASE WHEN n % 2 = 0 THEN '.12' ELSE '.13' END
    WHEN k = 2 THEN CAST(n AS VARCHAR) || '.13' ELSE 'x' || CAST(n AS VARCHAR) || '.125' END AS amount
  FROM (SELECT o_orderkey, o_orderkey % 4 AS k, o_custkey AS n FROM {orders}) t""",
)
def cell_numeric_scale(i):
    """Halves go to the even digit, whatever follows further behind decides, text stays as it is."""
    cells = i.sql(
        """SELECT o_orderkey, CASE WHEN k = 0 THEN '0' || CAST(n AS STRING)
             WHEN k = 1 THEN '-' || CAST(n AS STRING) || CASE WHEN n % 2 = 0 THEN '.125' ELSE '.1250000000000000000000000001' END
             WHEN k = 2 THEN CAST(n AS STRING) || '.134999999999999999999999999999' ELSE 'x' || CAST(n AS STRING) || '.125' END
             AS amount FROM (SELECT o_orderkey, o_orderkey % 4 AS k, o_custkey AS n FROM {orders}) t"""
    )
    return cell_projection(cells, CellRules(numeric_scale=2), ["amount"], ["o_orderkey"])


@query(
    "cell_normalise_texts",
    """SELECT conv_id, turn, nullif("""
    + _TRIM.replace("{v}", "text")
    + """, '') AS text, CASE WHEN role IN ('y', 'n') THEN NULL ELSE role END AS role FROM {conversations}""",
)
def cell_normalise_texts(i):
    """Whole conversation texts through the cell rules."""
    t = i["conversations"].select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "text", "role")
    out = cell_projection(t, CellRules())
    return out.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "text", "role")


# -- predicates ----------------------------------------------------------------------------------------------

# (predicate, column, its DuckDB form with NULL as unexplained)
PREDICATES = {
    "either_end": ("prod_value::date < '1993-02-01' or uat_value::date > '1998-05-31'", "o_orderdate",
                   "$p::DATE < DATE '1993-02-01' OR $u::DATE > DATE '1998-05-31'"),
    "moved_later": ("date(uat_value) > date(prod_value) AND date(prod_value) <> '1994-04-04'", "o_orderdate",
                    "$u::DATE > $p::DATE AND $p::DATE <> DATE '1994-04-04'"),
    "second_quarter": ("uat_value is not null and prod_value::date between '1995-04-01' and '1995-06-30'", "o_orderdate",
                       "$u IS NOT NULL AND $p::DATE BETWEEN DATE '1995-04-01' AND DATE '1995-06-30'"),
    "same_year": ("year(prod_value) = year(uat_value)", "o_orderdate", "year($p) = year($u)"),
    "rounded_down": ("round(prod_value) > prod_value", "o_totalprice", "floor($p + 0.5) > $p"),
    "near": ("abs(prod_value - uat_value) <= 0.1", "o_totalprice", "abs($p - $u) <= 0.1"),
    "missing": ("uat_value is null", "o_orderstatus", "$u IS NULL"),
    "text": ("uat_value::string = 'F' or length(prod_value) > 1", "o_orderstatus", "$u = 'F' OR length($p) > 1"),
    "starts": ("startswith(prod_value, 'O') and not contains(uat_value, 'P')", "o_orderstatus",
               "starts_with($p, 'O') AND NOT contains($u, 'P')"),
    "blank": ("isblank(uat_value)", "o_orderstatus", "$u IS NULL OR $u = ''"),
    "forbidden": ("java_method('java.lang.System', 'exit') = 'x'", "o_orderstatus", "false"),
    "broken": ("this is no predicate", "o_orderstatus", "false"),
}


@query(
    "accepted_predicates",
    "WITH j AS (SELECT p.o_orderdate AS pd, u.o_orderdate AS ud, p.o_totalprice AS pt, u.o_totalprice AS ut, "
    "p.o_orderstatus AS ps, NULLIF(u.o_orderstatus, '') AS us FROM {orders} p JOIN {orders_right} u USING (o_orderkey)) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS predicate, count(*) FILTER (WHERE {sql.replace('$p', 'p' + at).replace('$u', 'u' + at)}) "
        "AS explained FROM j"
        for name, (_, column, sql) in PREDICATES.items()
        for at in [{"o_orderdate": "d", "o_totalprice": "t", "o_orderstatus": "s"}[column]]
    ),
)
def accepted_predicates(i):
    """How many shared rows each predicate explains, all in one pass; unusable ones explain none."""
    from twinledger.operators.columns import align_unique, compare

    columns = ["o_orderdate", "o_totalprice", "o_orderstatus"]
    c = compare(i["orders"], i["orders_right"], ["o_orderkey"], columns)
    aligned = align_unique(c)
    found = []
    for name, (text, column, _) in PREDICATES.items():
        at = columns.index(column)
        predicate, _ = usable(text, c.left.schema[f"l{at}"].dataType, aligned, f"l{at}", f"r{at}")
        found.append(F.count_if(explained(predicate, f"l{at}", f"r{at}", False)).alias(name))
    wide = aligned.agg(*found)
    return wide.unpivot([], list(PREDICATES), "predicate", "explained")


# -- extracts ------------------------------------------------------------------------------------------------

_LEFT_CELLS = """SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS customer,
  COALESCE(o_orderstatus, '') AS status, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS STRING) || '.5000' AS cents,
  COALESCE(CAST(o_orderdate AS STRING), '') AS day, o_orderpriority AS priority FROM {orders}"""
_RIGHT_CELLS = """SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS customer,
  CASE WHEN o_orderstatus = '' THEN 'NULL' ELSE o_orderstatus END AS status,
  CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS STRING) || '.5' AS cents,
  COALESCE(CAST(o_orderdate AS STRING) || '.000+00:00', chr(92) || 'N') AS day, o_orderpriority AS priority
  FROM {orders_right} t"""


def _written(i, sql, view):
    """Write cells as the part files of one extract and give back their folder."""
    folder = new_path(i.spark, "extract") + f"/{view}.csv"
    # Quoted only where needed, blanks as nothing: what an unload writes.
    i.sql(sql).write.option("header", True).option("emptyValue", "").csv(folder)
    return folder


@query("csv_extract_scan", f"SELECT id, customer, NULLIF(status, '') AS status, cents, NULLIF(day, '') AS day, priority FROM ({_LEFT_CELLS}) t")
def csv_extract_scan(i):
    extract = read_extract(i.spark, _written(i, _LEFT_CELLS, "orders"))
    return extract.df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in extract.columns])


# Line breaks in cells read as LF, whichever they were written as.
_LF = "replace(replace({0}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


@query("csv_extract_texts", f"SELECT CAST(doc_id AS STRING) AS doc_id, lang, {_LF.format('text')} AS text FROM {{documents}}")
def csv_extract_texts(i):
    """Whole texts with quotes, delimiters and line breaks through a CSV file and back."""
    folder = new_path(i.spark, "extract") + "/documents.csv"
    texts = i.sql("SELECT CAST(doc_id AS STRING) AS doc_id, lang, text FROM {documents}")
    texts.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(folder)
    return read_extract(i.spark, folder).df.select("doc_id", "lang", "text")


_ENDINGS = "CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), chr(13) || chr(10)) ELSE text END"


@query(
    "csv_line_endings",
    f"SELECT CAST(doc_id AS STRING) AS doc_id, {_LF.format(_ENDINGS)} AS text, lang, n FROM "
    "(SELECT *, CASE WHEN doc_id % 3 = 0 THEN chr(10) || chr(10) ELSE '' END AS n FROM {documents}) t",
)
def csv_line_endings(i):
    """Records that end in CRLF, with cells that hold any line break, blank lines among them; read in splits."""
    folder = new_path(i.spark, "extract")
    cell = "'\"' || replace({0}, '\"', '\"\"') || '\"'".format
    lines = i.sql(
        f"SELECT CAST(doc_id AS STRING) || ',' || {cell(_ENDINGS)} || ',' || lang || ',' || "
        "CASE WHEN doc_id % 3 = 0 THEN '\"' || chr(10) || chr(10) || '\"' ELSE '' END AS value FROM {documents}"
    )
    i.spark.range(1).selectExpr("'doc_id,text,lang,n' AS value").write.option("lineSep", "\r\n").text(f"{folder}/a")
    lines.write.option("lineSep", "\r\n").text(f"{folder}/b")
    return read_extract(i.spark, [f"{folder}/a", f"{folder}/b"]).df.select("doc_id", "text", "lang", "n")


_RAW = {"header": True, "quote": "", "sep": "\x01", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_BLANKS = """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN chr(9) || chr(9) WHEN 1 THEN ' ' || chr(9) || '  ' || chr(9)
    WHEN 2 THEN chr(9) ELSE CAST(o_orderkey AS STRING) || chr(9) || o_orderstatus || chr(9) || o_orderpriority END AS value FROM {orders}"""


@query(
    "csv_blank_rows_tab",
    """SELECT CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN '' ELSE CAST(o_orderkey AS STRING) END AS id,
  CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN '' ELSE o_orderstatus END AS status,
  CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 5 = 2 THEN 1 ELSE 0 END AS ragged FROM {orders}""",
)
def csv_blank_rows_tab(i):
    """A tab file in which most rows hold nothing but blanks and tabs: each is a row with as many cells as it has."""
    folder = new_path(i.spark, "extract") + "/blank.csv"
    i.sql(_BLANKS).select(F.col("value").alias("id\tstatus\tpriority")).write.options(**_RAW).csv(folder)
    return read_extract(i.spark, folder, delimiter="\t").df.select("id", "status", "priority", F.col("__ragged").alias("ragged"))


@query(
    "csv_parts_mixed_headers",
    """SELECT CAST(o_orderkey AS STRING) AS id, CASE WHEN o_orderkey % 3 <> 1 THEN COALESCE(o_orderstatus, '') END AS status,
  o_orderpriority AS priority, CASE WHEN o_orderkey % 3 = 1 THEN COALESCE(CAST(o_custkey AS STRING), '') END AS customer FROM {orders}""",
)
def csv_parts_mixed_headers(i):
    """Parts of one view with their own headers, in other orders and with other columns, and parts without any."""
    folder = new_path(i.spark, "extract")
    parts = (
        ("a", 0, "CAST(o_orderkey AS STRING) AS ID, o_orderstatus AS Status, o_orderpriority AS priority", True),
        ("b", 1, "o_orderpriority AS priority, CAST(o_custkey AS STRING) AS customer, CAST(o_orderkey AS STRING) AS id", True),
        ("c", 2, "CAST(o_orderkey AS STRING) AS x, o_orderstatus AS y, o_orderpriority AS z", False),
    )
    for name, n, columns, header in parts:
        rows = i.sql(f"SELECT {columns} FROM {{orders}} WHERE o_orderkey % 3 = {n}")
        rows.write.option("header", header).option("emptyValue", "").csv(f"{folder}/{name}")
    return read_extract(i.spark, [f"{folder}/{name}" for name, *_ in parts]).df.select("id", "status", "priority", "customer")


_LINES = """SELECT CASE o_orderkey % 10
    WHEN 0 THEN CAST(o_orderkey AS STRING) || ',' || o_orderstatus
    WHEN 1 THEN CAST(o_orderkey AS STRING) || ',' || o_orderstatus || ',' || o_orderpriority || ',extra'
    WHEN 2 THEN CAST(o_orderkey AS STRING) || ',"' || o_orderstatus || ',",' || o_orderpriority
    ELSE CAST(o_orderkey AS STRING) || ',' || o_orderstatus || ',' || o_orderpriority END AS value FROM {orders}"""


def _ragged(i):
    """Lines of uneven width, each part file with its header, as two folders of one view."""
    folder = new_path(i.spark, "extract") + "/ragged.csv"
    # One text column named like the header line: the writer puts that line in front of every part file.
    lines = i.sql(_LINES).withColumnRenamed("value", "id,status,priority")
    raw = {"header": True, "quote": "", "sep": "\x01"}
    for n in range(2):
        part = lines.where(F.crc32(F.col("`id,status,priority`")) % 2 == n)
        part.write.options(**raw).csv(f"{folder}{n:03d}")
    return read_extract(i.spark, [f"{folder}{n:03d}" for n in range(2)])


@query(
    "csv_ragged_count",
    "SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderkey % 10 < 2) AS ragged FROM {orders}",
)
def csv_ragged_count(i):
    return extract_counts(_ragged(i).df)


@query(
    "csv_ragged_rows",
    """SELECT CAST(o_orderkey AS STRING) AS id, o_orderstatus || CASE WHEN o_orderkey % 10 = 2 THEN ',' ELSE '' END AS status,
  CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 10 < 2 THEN 1 ELSE 0 END AS ragged FROM {orders}""",
)
def csv_ragged_rows(i):
    return _ragged(i).df.select("id", "status", "priority", F.col("__ragged").alias("ragged"))


# -- ladders -------------------------------------------------------------------------------------------------

SETTINGS = Settings(threshold_pct=0.1, sample_rows=25)


@query(
    "ladder_csv",
    """WITH p AS (SELECT * FROM {orders}), u AS (SELECT * FROM {orders_right} t),
 n AS (SELECT (SELECT count(*) FROM p) AS l, (SELECT count(*) FROM u) AS r,
   (SELECT count(*) FROM p ANTI JOIN u USING (o_orderkey)) AS lo, (SELECT count(*) FROM u ANTI JOIN p USING (o_orderkey)) AS ro,
   (SELECT count(*) FROM p JOIN u USING (o_orderkey)) AS s)
 SELECT 'C0' AS tier, 'PASS' AS status, NULL AS left_rows, NULL AS right_rows, NULL AS left_only, NULL AS right_only, NULL AS shared
 UNION ALL SELECT 'C1', 'PASS', NULL, NULL, NULL, NULL, NULL
 UNION ALL SELECT 'C2', CASE WHEN l = r THEN 'PASS' WHEN 100.0 * abs(l - r) / greatest(l, r) <= 0.1 THEN 'ACCEPTED' ELSE 'FAIL' END,
   l, r, NULL, NULL, NULL FROM n
 UNION ALL SELECT 'C3', CASE WHEN greatest(lo, ro) = 0 THEN 'PASS' WHEN 100.0 * greatest(lo, ro) / greatest(l, r) <= 0.1 THEN 'ACCEPTED'
   ELSE 'FAIL' END, NULL, NULL, lo, ro, s FROM n
 UNION ALL SELECT 'C4', 'FAIL', NULL, NULL, NULL, NULL, s FROM n
 UNION ALL SELECT 'C5', 'SKIPPED', NULL, NULL, NULL, NULL, NULL""",
)
def ladder_csv(i):
    """Both copies of orders, rendered differently and written as CSV, through the whole extract ladder."""
    sides = [
        read_extract(i.spark, _written(i, sql, "orders")) for sql in (_LEFT_CELLS, _RIGHT_CELLS)
    ]
    run = run_extracts(i.spark, ViewSpec("orders", grain=("id",)), *sides, SETTINGS, "t1")
    return gather(i.spark, [run]).tiers.select(
        "tier", "status", "left_rows", "right_rows", "left_only", "right_only", "shared"
    )


@query(
    "ladder_csv_columns",
    "WITH p AS (SELECT * FROM {orders}), u AS (SELECT * FROM {orders_right} t), "
    "j AS (SELECT p.o_custkey AS a1, u.o_custkey AS b1, p.o_orderstatus AS a2, NULLIF(u.o_orderstatus, '') AS b2, "
    "round(p.o_totalprice * 100) AS a3, round(u.o_totalprice * 100) AS b3, p.o_orderdate AS a4, u.o_orderdate AS b4 "
    "FROM p JOIN u USING (o_orderkey)) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, count(*) AS shared, count(*) FILTER (WHERE a{n} IS DISTINCT FROM b{n}) AS mismatches FROM j"
        for n, c in ((1, "customer"), (2, "status"), (3, "cents"), (4, "day"))
    ),
)
def ladder_csv_columns(i):
    """What is left of the differences once both renderings are normalised."""
    sides = [read_extract(i.spark, _written(i, sql, "orders")) for sql in (_LEFT_CELLS, _RIGHT_CELLS)]
    run = run_extracts(i.spark, ViewSpec("orders", grain=("id",)), *sides, SETTINGS, "t1")
    return gather(i.spark, [run]).columns.select(F.col("column").alias("col_name"), "shared", "mismatches")


TABLE_VIEWS = {
    "orders": ("orders", "orders_right", ("o_orderkey",)),
    "lineitem": ("lineitem", "lineitem_right", ("l_orderkey", "l_linenumber")),
    "events": ("events", "events", ()),
    "documents": ("documents", "documents", ("doc_id",)),
    "customer": ("customer_left", "customer_right", ("c_custkey",)),
}

_EXPECTED = """WITH o AS (SELECT count(*) AS l FROM {orders}), r AS (SELECT count(*) AS r FROM {orders_right} t)
 SELECT 'orders' AS view, 'DIFFS FOUND' AS verdict UNION ALL SELECT 'lineitem', 'DIFFS FOUND'
 UNION ALL SELECT 'events', '%s' UNION ALL SELECT 'documents', 'PASS'
 UNION ALL SELECT 'customer', CASE WHEN EXISTS (SELECT * FROM {customer_left} a JOIN {customer_right} b USING (c_custkey)
   WHERE a.c_acctbal <> b.c_acctbal) THEN 'DIFFS FOUND' ELSE 'PASS' END"""


def _table_run(i, ladder):
    jobs = [
        lambda l=left, r=right, g=grain, n=name: run_tables(i.spark, ladder, ViewSpec(n, grain=g), i[l], i[r], SETTINGS)
        for name, (left, right, grain) in TABLE_VIEWS.items()
    ]
    return run_all(i.spark, jobs)


@query("ladder_models", _EXPECTED % "PASS")
def ladder_models(i):
    """Five table pairs through the model ladder: verdicts."""
    return _table_run(i, "T").views.select("view", "verdict")


@query("ladder_views", _EXPECTED % "PASS (NO GRAIN)")
def ladder_views(i):
    """The same pairs through the warehouse-view ladder, where a missing grain is no clean pass."""
    return _table_run(i, "D").views.select("view", "verdict")


@query("ladder_model_tiers")
def ladder_model_tiers(i):
    """Tier rows of the model ladder with all their counts."""
    return _table_run(i, "T").tiers.drop("mode", "tenant")


def _tiers_sql(left, right, keys, columns):
    """Tier rows of ladder T for a pair with a usable grain, threshold 0.1 percent."""
    k = ", ".join(keys)
    differs = " OR ".join(f"p.{c} IS DISTINCT FROM u.{c}" for c in columns)
    worst = ", ".join(f"count(*) FILTER (WHERE p.{c} IS DISTINCT FROM u.{c})" for c in columns)

    def judged(n, base):
        return f"CASE WHEN {n} = 0 THEN 'PASS' WHEN 100.0 * {n} / {base} <= 0.1 THEN 'ACCEPTED' ELSE 'FAIL' END"

    return f"""WITH p AS (SELECT * FROM {left} a), u AS (SELECT * FROM {right} b),
 n AS (SELECT *, greatest(l, r) AS base FROM (SELECT (SELECT count(*) FROM p) AS l, (SELECT count(*) FROM u) AS r,
   (SELECT count(*) FROM (SELECT {k} FROM p GROUP BY {k} HAVING count(*) > 1) x) AS ld,
   (SELECT count(*) FROM (SELECT {k} FROM u GROUP BY {k} HAVING count(*) > 1) x) AS rd,
   (SELECT count(*) FROM (SELECT {k} FROM p EXCEPT SELECT {k} FROM u) x) AS lo,
   (SELECT count(*) FROM (SELECT {k} FROM u EXCEPT SELECT {k} FROM p) x) AS ro,
   (SELECT count(*) FROM (SELECT {k} FROM p INTERSECT SELECT {k} FROM u) x) AS s) m),
 j AS (SELECT count(*) AS pairs, count(*) FILTER (WHERE {differs}) AS bad, greatest({worst}) AS worst FROM p JOIN u USING ({k}))
 SELECT 'T0' AS tier, 'PASS' AS status, NULL AS left_rows, NULL AS right_rows, NULL AS left_only, NULL AS right_only,
   NULL AS shared, NULL AS left_dups, NULL AS right_dups, NULL AS denominator
 UNION ALL SELECT 'T1', {judged('greatest(ld, rd)', 'base')}, NULL, NULL, NULL, NULL, NULL, ld, rd, base FROM n
 UNION ALL SELECT 'T2', {judged('greatest(lo, ro)', 'base')}, l, r, lo, ro, s, NULL, NULL, base FROM n
 UNION ALL SELECT 'T3', {judged('worst', 'pairs')}, NULL, NULL, NULL, NULL, pairs, NULL, NULL, NULL FROM j
 UNION ALL SELECT 'T4', CASE WHEN bad > 0 THEN 'SKIPPED' END, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM j"""


def _tiers(i, left, right, keys):
    run = run_tables(i.spark, "T", ViewSpec("v", grain=keys), i[left], i[right], SETTINGS)
    return gather(i.spark, [run]).tiers.select(
        "tier", "status", "left_rows", "right_rows", "left_only", "right_only", "shared", "left_dups", "right_dups",
        "denominator",
    )


_ORDERS = """(SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, '') AS o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority FROM {%s} t)"""


@query(
    "ladder_model_orders",
    _tiers_sql(
        _ORDERS % "orders", _ORDERS % "orders_right", ("o_orderkey",),
        ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    ),
)
def ladder_model_orders(i):
    """Tier rows of a pair with a unique grain."""
    return _tiers(i, "orders", "orders_right", ("o_orderkey",))


# A grain that some keys repeat, few enough to be accepted.
_LINES_GRAIN = ("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "ladder_model_repeated_keys",
    _tiers_sql(
        "{lineitem}", "{lineitem_right}", _LINES_GRAIN,
        ("l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
    ),
)
def ladder_model_repeated_keys(i):
    """Tier rows of a pair whose grain repeats within the threshold: the column tier counts pairs."""
    return _tiers(i, "lineitem", "lineitem_right", _LINES_GRAIN)
