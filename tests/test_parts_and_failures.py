"""CSV parts of any make, predicates on text with junk, failing views, and fingerprints by value."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from twinledger.functions.display import percent_text
from twinledger.functions.predicates import read
from twinledger.operators.fingerprint import fingerprint_compare
from twinledger.plans.ladders import Job, Settings, ViewSpec, run_all, run_tables
from twinledger.sources import storage
from twinledger.sources.extracts import cells, extract_counts, read_extract


def parts(tmp_path, *texts):
    paths = []
    for i, text in enumerate(texts):
        path = tmp_path / f"part{i}.csv"
        path.write_bytes(text.encode())
        paths.append(str(path))
    return paths


def rows(extract):
    return sorted(tuple(r) for r in cells(extract).collect())


def test_a_part_without_header_loses_no_row(spark, tmp_path):
    found = read_extract(spark, parts(tmp_path, "id,a\n1,x\n", "2,y\n3,z\n"))
    assert rows(found) == [("1", "x"), ("2", "y"), ("3", "z")]


def test_columns_of_parts_are_matched_by_name(spark, tmp_path):
    found = read_extract(spark, parts(tmp_path, "id,a,b\n1,x,y\n", "id,b,a\n2,Y,X\n", "id,a,b,c\n3,p,q,r\n"))
    assert found.columns == ["id", "a", "b", "c"]
    assert sorted(cells(found).collect()) == [("1", "x", "y", None), ("2", "X", "Y", None), ("3", "p", "q", "r")]


def test_blank_lines_are_rows(spark, tmp_path):
    found = read_extract(spark, parts(tmp_path, "id\n1\n\n2\n\n"))
    assert tuple(extract_counts(found.df).first()) == (4, 2)


def test_line_ends_in_cells_read_alike(spark, tmp_path):
    unix, other = parts(tmp_path, 'id,a\n1,"x\r\ny"\n', 'id,a\r\n1,"x\r\ny"\r\n')
    assert rows(read_extract(spark, unix)) == rows(read_extract(spark, other)) == [("1", "x\ny")]


@pytest.mark.parametrize(
    "text",
    ["prod_value between 1 and 5", "prod_value in (5, 6)", "abs(prod_value) = 5", "prod_value + 1 = uat_value",
     "abs(prod_value - uat_value) <= 1", "prod_value not between 1 and 3"],
)
def test_junk_cells_never_fail_a_predicate(spark, text):
    df = spark.createDataFrame([("5", "6"), ("abc", "6"), ("", None)], "l string, r string")
    found = [r[0] for r in df.select(F.expr(read(text, text_values=True).sql("l", "r"))).collect()]
    assert found == [True, None, None]


def test_a_failing_view_is_one_error_row(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")

    def fails():
        raise OSError("no such bucket")

    good = lambda: run_tables(spark, "T", ViewSpec("good", grain=("id",)), df, df, Settings())
    run = run_all(spark, [Job("C", "bad", fails, "t1"), good, fails])
    verdicts = {r.view: r.verdict for r in run.views.collect()}
    assert verdicts["good"] == "PASS" and "ERROR" in verdicts["bad"] and "ERROR" in verdicts["(unnamed)"]
    tiers = [tuple(r) for r in run.tiers.where("view = 'bad'").select("tier", "status").collect()]
    assert tiers == [("C0", "ERROR")]


def test_equal_decimals_of_other_scale_have_one_fingerprint(spark):
    left = spark.createDataFrame([(Decimal("1.5"),), (None,)], "x decimal(10,1)")
    right = spark.createDataFrame([(Decimal("1.50"),), (None,)], "x decimal(12,2)")
    assert fingerprint_compare(left, right).first().status == "PASS"


def test_percent_of_numbers_beyond_64_bits(spark):
    n = F.lit("30000000000000000000000000").cast("decimal(38,0)")
    assert spark.range(1).select(percent_text((n / 3).cast("decimal(38,0)"), n)).first()[0] == "33.333%"


def test_tenants_restrict_only_the_left_side_of_the_column_tier(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, "a", "x")], "id int, client string, v string")
    right = spark.createDataFrame([(1, "gone", "x"), (2, "a", "x")], "id int, client string, v string")
    active = spark.createDataFrame([("a",)], "client string")
    spec = ViewSpec("moved", grain=("id",), tenant_columns=("client",))
    run = run_tables(spark, "T", spec, left, right, Settings(threshold_pct=60), active)
    assert {c["column"]: c["mismatches"] for c in run.columns} == {"client": 1}


def test_storage_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="share"):
        storage.shared_folder(Session())
