"""Schema metadata, and the catalog sheet with one planted drift per table."""

from twinledger.operators import schema as schema_ops

COLUMNS = "table_name string, column_name string, ordinal int, data_type string, len int, prec int, scale int, nullable string"
ID = ("ID", 1, "NUMBER", None, 38, 0, "YES")
CLIENT = ("CLIENT_NAME", 2, "TEXT", 16777216, None, None, "YES")
STATUS = ("STATUS", 3, "TEXT", 16777216, None, None, "YES")
BASE = [ID, CLIENT, STATUS]


def moved(column, at):
    return (column[0], at, *column[2:])


LEFT = {
    "CLEAN": BASE, "TYPE": BASE, "EXTRA": [*BASE, ("NEW_COL", 4, "TEXT", 10, None, None, "YES")], "ORDER": BASE,
    "PREC": [ID, ("AMOUNT", 2, "NUMBER", None, 38, 2, "YES")],
    "NULL": [ID, ("NAME", 2, "TEXT", 10, None, None, "NO")], "ONLY_LEFT": BASE,
}
RIGHT = {
    "CLEAN": BASE, "TYPE": [ID, CLIENT, ("STATUS", 3, "NUMBER", None, 38, 0, "YES")], "EXTRA": BASE,
    "ORDER": [ID, moved(CLIENT, 3), moved(STATUS, 2)], "PREC": [ID, ("AMOUNT", 2, "NUMBER", None, 38, 4, "YES")],
    "NULL": [ID, ("NAME", 2, "TEXT", 10, None, None, "YES")],
}


def sheet(spark):
    sides = [
        spark.createDataFrame([(t, *c) for t, cols in side.items() for c in cols], COLUMNS) for side in (LEFT, RIGHT)
    ]
    lists = [spark.createDataFrame([(t,) for t in side], "table_name string") for side in (LEFT, RIGHT)]
    return *sides, *lists


def test_objects_and_counts(spark):
    _, _, lt, rt = sheet(spark)
    assert [tuple(r) for r in schema_ops.objects_diff(lt, rt).collect()] == [("ONLY_LEFT", "MISSING IN RIGHT")]
    assert dict(map(tuple, schema_ops.side_table_counts(lt, rt).collect())) == {"LEFT": 7, "RIGHT": 6}


def test_drift_classes(spark):
    found = sorted((r.table_name, r.column_name, r.issue) for r in schema_ops.catalog_drift(*sheet(spark)).collect())
    assert found == [
        ("EXTRA", "NEW_COL", "COLUMN ONLY IN LEFT"), ("NULL", "NAME", "NULLABILITY CHANGED"),
        ("ORDER", "CLIENT_NAME", "POSITION CHANGED"), ("ORDER", "STATUS", "POSITION CHANGED"),
        ("PREC", "AMOUNT", "PRECISION CHANGED"), ("TYPE", "STATUS", "TYPE CHANGED"),
    ]


def test_rollup_counts_each_kind_once(spark):
    rows = {r.table_name: r for r in schema_ops.catalog_rollup(*sheet(spark)).collect()}
    assert "ONLY_LEFT" not in rows and rows["CLEAN"].verdict == "PASS"
    assert [t for t, r in rows.items() if r.verdict == "PASS"] == ["CLEAN"]
    assert (rows["TYPE"].type_changed, rows["TYPE"].precision_changed) == (1, 0)
    assert rows["ORDER"].position_changed == 2 and rows["PREC"].precision_changed == 1
    assert rows["NULL"].nullability_changed == 1 and rows["EXTRA"].only_in_left == 1


def test_structure_tier_ignores_size_and_nullability(spark):
    left, right, _, _ = sheet(spark)
    drift = schema_ops.schema_drift(left, right).where("table_name <> 'ONLY_LEFT'")
    assert {r.table_name for r in drift.collect()} == {"TYPE", "EXTRA", "ORDER"}


def test_metadata_of_dataframes(spark):
    df = spark.sql("select 1 as id, cast(2 as decimal(12,3)) as amount, 'a' as name, timestamp'2024-01-01' as at")
    rows = {r.column_name: r for r in schema_ops.schema_columns(spark, {"t": df}).collect()}
    assert [rows[c].ordinal for c in ("id", "amount", "name", "at")] == [1, 2, 3, 4]
    assert (rows["amount"].data_type, rows["amount"].prec, rows["amount"].scale) == ("decimal", 12, 3)
    assert rows["name"].data_type == "string" and rows["id"].nullable == "NO"


def test_declared_lengths(spark, tmp_path):
    spark.sql(f"create table sized (c char(5), v varchar(9), s string) using parquet location '{tmp_path}/sized'")
    try:
        rows = {r.column_name: r for r in schema_ops.schema_columns(spark, {"t": spark.table("sized")}).collect()}
        assert (rows["c"].len, rows["v"].len, rows["s"].len) == (5, 9, None)
        assert rows["v"].data_type == "string"
    finally:
        spark.sql("drop table sized")


def test_decimal_size_is_no_base_type(spark):
    left = schema_ops.schema_columns(spark, {"t": spark.sql("select cast(1 as decimal(10,2)) as a")})
    right = schema_ops.schema_columns(spark, {"t": spark.sql("select cast(1 as decimal(12,4)) as a")})
    assert schema_ops.schema_drift(left, right).count() == 0
    tables = spark.createDataFrame([("t",)], "table_name string")
    assert schema_ops.catalog_drift(left, right, tables, tables).first().issue == "PRECISION CHANGED"


def test_headers(spark):
    def header(*names):
        return spark.createDataFrame([("v", i, n) for i, n in enumerate(names, 1)], "view string, ordinal int, column_name string")

    swapped = schema_ops.header_drift(header("a", "b", "c"), header("a", "c", "b")).orderBy("left_ord").collect()
    assert [(r.column_name, r.left_ord, r.right_ord, r.right_column_at_position) for r in swapped] == [
        ("b", 2, 3, "c"), ("c", 3, 2, "b"),
    ]
    longer = schema_ops.header_drift(header("a"), header("a", "z")).collect()
    assert [(r.column_name, r.left_ord, r.right_ord) for r in longer] == [("z", None, 2)]
    shorter = schema_ops.header_drift(header("a", "z"), header("a")).collect()
    assert [(r.column_name, r.left_ord, r.right_ord) for r in shorter] == [("z", 2, None)]
    renamed = schema_ops.header_summary(header("a", "old"), header("a", "new")).first()
    assert renamed.looks_like_rename and renamed.status == "FAIL"
    assert not schema_ops.header_summary(header("a", "b"), header("b", "a")).first().looks_like_rename
    assert schema_ops.header_drift(header("a", "b"), header("a", "b")).count() == 0


def test_empty_header_against_full_one(spark):
    empty = spark.createDataFrame([], "view string, ordinal int, column_name string")
    full = spark.createDataFrame([("v", 1, "a")], "view string, ordinal int, column_name string")
    assert schema_ops.header_drift(empty, full).count() == schema_ops.header_drift(full, empty).count() == 1
