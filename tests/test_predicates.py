"""Accepted-difference predicates: what they may say and what they mean."""

import pytest
from pyspark.sql import functions as F, types as T

from twinledger.functions.predicates import RejectedPredicate, explained, read, usable


def holds(spark, text, left, right, kind="string", null_explains=False, half_even=False):
    df = spark.createDataFrame([(left, right)], f"l {kind}, r {kind}")
    predicate, note = usable(text, df.schema["l"].dataType, df, "l", "r", half_even)
    return df.select(explained(predicate, "l", "r", null_explains) if predicate else F.lit(False)).first()[0]


@pytest.mark.parametrize(
    "text, left, right, expected",
    [
        ("left_value = 'O'", "O", "F", True),
        ("prod_value == 'O' and uat_value is None", "O", None, True),
        ('redshift_value = "P"', "P", "F", True),
        ("snowflake_value is not null", "O", "F", True),
        ("date(uat_value) = '1996-02-29'", None, "1996-02-29 23:59:59", True),
        ("date(uat_value) = '1996-02-29'", None, "1996-02-30", False),
        ("uat_value::date > '1998-08-02' or prod_value::date < '1992-01-01'", "1991-12-31 08:00:00", None, True),
        ("prod_value::date between '1994-01-01' and '1994-03-31'", "1994-03-31", "?", True),
        ("prod_value::date between '1994-01-01' and '1994-03-31'", "1994-04-01", "?", False),
        ("right_value::date > '1994-01-01'", "1995-01-01", "soon", False),
        ("prod_value::int = 12", "12", None, True),
        ("prod_value::int = 12", "a dozen", None, False),
        ("prod_value::string = 'Clerk#7'", "Clerk#7", None, True),
        ("year(uat_value) > 1996", None, "1997-03-09", True),
        ("year(uat_value) > 1996", None, "later", False),
        ("round(uat_value, 2) = 17.26", "0", "17.2649", True),
        ("round(uat_value, 2) = 17.26", "0", "17.2651", False),
        ("abs(num(uat_value) - num(prod_value)) <= 2", "901.5", "903.5", True),
        ("abs(num(uat_value) - num(prod_value)) <= 2", "901.5", "n/a", False),
        ("uat_value < 100", None, "99.99", True),
        ("uat_value < 100", None, "cheap", False),
        ("startswith(uat_value, 'Clerk#') and contains(prod_value, 'temp')", "a temp", "Clerk#1", True),
        ("isblank(prod_value)", "", "Clerk#1", True),
        ("isblank(prod_value)", "x", None, False),
        ("isblank(uat_value)", "Clerk#1", None, True),
        ("len(uat_value) = 5", "", "14-AB", True),
        ("uat_value in ('1-URGENT', '2-HIGH')", None, "2-HIGH", True),
        ("uat_value not in ('1-URGENT', '2-HIGH')", None, "5-LOW", True),
        ("not (prod_value = 'F' or uat_value = 'F')", "O", "P", True),
        ("prod_value = 'clerk''s'", "clerk's", None, True),
        ("prod_value = 'C:\\tmp'", "C:\\tmp", None, True),
    ],
)
def test_meaning(spark, text, left, right, expected):
    assert holds(spark, text, left, right) is expected


@pytest.mark.parametrize(
    "text",
    [
        "__import__('os').system('echo hi')",
        "this is not python",
        "java_method('java.lang.System', 'exit')",
        "reflect('a', 'b') = 'c'",
        "exists (select 1)",
        "prod_value = other_column",
        "prod_value::binary = 'a'",
        "prod_value = 'a",
        "(prod_value = 'a'",
        "prod_value = 'a')",
        "prod_value = 'a'; drop table t",
        "prod_value",
        "prod_value = 'a' -- comment and more",
        "raise_error('x') = 1",
    ],
)
def test_anything_else_explains_nothing(spark, text):
    assert holds(spark, text, "a", "b") is False
    df = spark.createDataFrame([("a", "b")], "l string, r string")
    assert usable(text, T.StringType(), df, "l", "r")[1].startswith("predicate")


def test_unknown_outcome_is_read_as_the_ladder_says(spark):
    assert holds(spark, "uat_value <= 'm'", "a", None, null_explains=True) is True
    assert holds(spark, "uat_value <= 'm'", "a", None, null_explains=False) is False


def test_halves(spark):
    assert holds(spark, "round(prod_value) = 2", "2.5", None, half_even=True) is True
    assert holds(spark, "round(prod_value) = 3", "2.5", None, half_even=False) is True


def test_rejection_names_the_word():
    with pytest.raises(RejectedPredicate, match="reflect"):
        read("reflect('a') = 'b'")
