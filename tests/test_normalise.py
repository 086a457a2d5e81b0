"""Cell and table value rules."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from twinledger.functions.display import percent_text, shown_value
from twinledger.functions.normalise import CellRules, cell_projection, projection


def cells(spark, values, rules=CellRules(), column="c"):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    out = cell_projection(df.withColumnRenamed("v", column), rules, [column], ["i"]).orderBy("i").collect()
    return [r[0] for r in out]


# Cells and what they become under the default rules.
DEFAULTS = {
    "  a ": "a", "NULL": None, "\\N": None, "": None, None: None,
    "2026-07-29 10:00:00.000+00:00": "2026-07-29 10:00:00", "2026-07-29T10:00:00Z": "2026-07-29T10:00:00",
    "2026-07-29 10:00:00.5Z": "2026-07-29 10:00:00.5Z", "TRUE": "true", "y": "true", "N": "false", "t": "true",
    "1": "1", "0": "0", "45.6357000": "45.6357", "100.00": "100", "0.000": "0", "-0.0": "-0", "007.50": "007.5",
    "1e5": "1e5", "+5": "+5", "\tx\t": "x", " x　\n": "x", "100": "100", "Null ": None,
}


def test_default_rules(spark):
    assert cells(spark, list(DEFAULTS)) == list(DEFAULTS.values())


def test_flags_only_in_named_columns(spark):
    rules = CellRules(boolean_columns=("Is_Active",))
    assert cells(spark, ["1", "0", "10", "1.0"], rules, "is_active") == ["true", "false", "10", "1"]
    assert cells(spark, ["1", "0"], rules, "id") == ["1", "0"]


def test_all_rules_off(spark):
    rules = CellRules(
        trim_text=False, blank_as_null=False, normalise_booleans=False, normalise_timestamps=False, null_tokens=()
    )
    values = ["", " a ", "TRUE", "1", "null", "2026-07-29 10:00:00.0Z"]
    assert cells(spark, values, rules) == values


def test_tokens_kept_when_blanks_count(spark):
    rules = CellRules(blank_as_null=False, case_insensitive=True)
    assert cells(spark, ["", "NULL", "AbC", " null "], rules) == ["", "NULL", "abc", "null"]


@pytest.mark.parametrize("scale", [0, 2, 5])
def test_quantise_like_decimal(spark, scale):
    values = [
        "41.1675", "41.1", "-0.001", "0.125", "0.135", "2.5", "3.5", "-2.5", "7", "007.5", "-0", "x1.5", "1e5",
        "0.12500000000000000000000000000000000000001", "123456789012345678901234567890.5", "9" * 26 + ".999999",
    ]

    def expected(v):
        import decimal
        import re

        if not re.match(r"^-?\d+(\.\d+)?$", v):
            return v
        try:
            return str(Decimal(v).quantize(Decimal(1).scaleb(-scale)))
        except decimal.InvalidOperation:
            return v

    assert cells(spark, values, CellRules(numeric_scale=scale)) == [expected(v) for v in values]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t -0123456789.TtrueNnoZ:\\", max_size=8), min_size=30, max_size=60))
def test_rules_settle_after_one_pass(spark, values):
    """A value in comparison form stays what it is."""
    once = cells(spark, values)
    assert cells(spark, once) == once


def test_projection(spark):
    df = spark.sql("select 1 as id, ' a ' as `Full Name`, '' as blank, cast(null as string) as n, 2.5 as x")
    row = projection(df, drop=["x"], trim_text=True).first().asDict()
    assert row == {"id": 1, "Full Name": "a", "blank": None, "n": None}
    assert projection(df, nullif_text=False).first().blank == ""
    assert projection(df, override=["upper(`Full Name`) as u"]).columns == ["u"]


def test_percentages(spark):
    df = spark.createDataFrame([(1, 3), (1, 8), (0, 5), (5, 5), (1, 0), (10**12, 3 * 10**12), (1, 200000)], "n long, d long")
    got = [r[0] for r in df.select(percent_text(F.col("n"), F.col("d"))).collect()]
    assert got == ["33.333%", "12.5%", "0%", "100%", None, "33.333%", "0.001%"]


def test_shown_values(spark):
    df = spark.createDataFrame([(None,), ("",), ("x" * 121,), ("ok",)], "v string")
    assert [r[0] for r in df.select(shown_value(F.col("v"))).collect()] == ["NULL", "(blank)", "x" * 120 + "...", "ok"]
