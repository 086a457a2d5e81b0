"""Column counts against really joining rows, on small random tables with repeated and NULL keys."""

import random

import pytest
from pyspark.sql import functions as F

from twinledger.functions.predicates import read
from twinledger.operators import columns as col_ops
from twinledger.operators import joins

SCHEMA = "k1 int, k2 string, num double, txt string, day date, amount decimal(10,2)"
WHERE = {
    "num": "prod_value > 3 or round(prod_value) = round(uat_value) and not uat_value between 1 and 2",
    "txt": "uat_value is null or prod_value = 'a'",
    "day": "date(prod_value) = date(uat_value) or date(uat_value) >= '2024-01-03'",
    "amount": "prod_value <= uat_value",
}


def table(spark, seed, n=160):
    import datetime
    from decimal import Decimal

    rnd = random.Random(seed)

    def maybe(v):
        return None if rnd.random() < 0.15 else v

    rows = [
        (
            maybe(rnd.choice([0, 0, 0, 1, 2, 3, *range(4, 40)])),
            maybe(rnd.choice("xy")),
            maybe(rnd.choice([0.0, -0.0, 1.4, 1.6, 3.5, 4.25, float("nan")])),
            maybe(rnd.choice(["", "a", "b", " a"])),
            maybe(datetime.date(2024, 1, rnd.randint(1, 5))),
            maybe(Decimal(rnd.randint(0, 4)) / 4),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def joined_counts(c):
    pairs = col_ops.align_unique(c)  # with repeated keys this is every pair
    return sorted(map(tuple, col_ops.mismatch_counts(c, pairs).collect()))


ORDERED = {
    "num": "prod_value < uat_value and prod_value <> 1.4",
    "txt": "uat_value >= prod_value or prod_value is null",
    "day": "not prod_value > uat_value or date(uat_value) = '2024-01-02'",
    "amount": "prod_value <> uat_value and uat_value > 0.25",
}
# Conditions that only pairs of values can answer.
FARTHER = {"num": "abs(prod_value - uat_value) <= 1", "amount": "prod_value = uat_value or prod_value < uat_value"}


# Distances between values, all counted over ranges.
DISTANCES = [
    {"num": "abs(prod_value - uat_value) < 0.1", "amount": "0.25 >= abs(uat_value - prod_value) and uat_value <> 0.5"},
    {"num": "prod_value > 1 or not abs(prod_value - uat_value) > 2.75", "amount": "abs(prod_value - uat_value) >= 0.5"},
    {"num": "abs(prod_value - uat_value) <= 0", "amount": "abs(prod_value - uat_value) < 0.750 or uat_value is null"},
]


@pytest.mark.parametrize("where", [ORDERED, FARTHER, *DISTANCES])
def test_comparisons_across_the_sides(spark, where):
    c = col_ops.compare(table(spark, 7), table(spark, 8), ["k1"], where=where, null_safe=True)
    assert not c.notes
    got = sorted(map(tuple, col_ops.column_diff(c).collect()))
    assert got == joined_counts(c) and sum(r[4] or 0 for r in got) > 0


def test_distances_round_as_pairs_do(spark):
    """Doubles whose differences lie on either side of the bound only by their rounding, and none that is no number."""
    rnd = random.Random(4)
    near = [0.1 * i + d for i in range(12) for d in (0.0, 2**-55, -(2**-54), 1e-16)] + [1e17, 1e17 + 16, -1e-300, 5e-324, 1e308, -1e308]
    near += [float("inf"), float("-inf"), float("nan"), None]
    sides = [
        spark.createDataFrame([(1, rnd.choice(near)) for _ in range(250)] + [(2, x) for x in near], "k int, v double") for _ in range(2)
    ]
    for bound in ("0.1", "16"):
        for sign in ("<=", "<"):
            c = col_ops.compare(*sides, ["k"], where={"v": f"abs(prod_value - uat_value) {sign} {bound}"})
            assert not c.notes and sorted(map(tuple, col_ops.column_diff(c).collect())) == joined_counts(c)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("null_explains", [False, True])
def test_repeated_keys_count_like_the_join(spark, null_safe, null_explains):
    c = col_ops.compare(
        table(spark, 1), table(spark, 2), ["k1", "k2"], where=WHERE, null_safe=null_safe, null_explains=null_explains
    )
    assert not c.notes
    got = sorted(map(tuple, col_ops.column_diff(c).collect()))
    assert got == joined_counts(c)
    assert sum(r[3] for r in got) > 0


@pytest.mark.parametrize("few, listed, where", [(1, 0, ORDERED), (4, 100, DISTANCES[1])])
def test_formed_and_counted_pairs_add_up(spark, monkeypatch, few, listed, where):
    """Whatever the number of copies above which pairs are counted, and the number of keys above which rows are marked."""
    monkeypatch.setattr(col_ops, "FEW", few)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", listed)
    c = col_ops.compare(table(spark, 9, 90), table(spark, 10, 90), ["k1"], where=where, null_safe=few == 1)
    got = sorted(map(tuple, col_ops.column_diff(c).collect()))
    assert got == joined_counts(c) and sum(r[3] for r in got) > 0


def test_pairs_of_few_copies_are_formed(spark, monkeypatch):
    """No row per cell, and no grouping of values, for keys with a few copies."""
    left = spark.range(300).select((F.col("id") % 100).alias("k"), (F.col("id") % 7).alias("v"))
    c = col_ops.compare(left, left.withColumn("v", F.col("v") % 5), ["k"], where={"v": "prod_value < uat_value"})
    monkeypatch.delattr(col_ops, "pair_counts")
    assert sorted(map(tuple, col_ops.column_diff(c).collect())) == joined_counts(c)


def test_values_are_counted_of_copious_keys_only(spark, monkeypatch):
    """One key with half of all rows, the others with a few: only its rows become cells, and no row is marked."""
    left = spark.range(400).select(F.when(F.col("id") < 200, -1).otherwise(F.col("id") % 90).alias("k"), (F.col("id") % 7).alias("v"))
    c = col_ops.compare(left, left.withColumn("v", F.col("v") + 1), ["k"], where={"v": "abs(prod_value - uat_value) <= 2"})
    seen, cells = [], col_ops._cells
    monkeypatch.setattr(col_ops, "_cells", lambda c, df, prefix: seen.append(df) or cells(c, df, prefix))
    assert sorted(map(tuple, col_ops.column_diff(c).collect())) == joined_counts(c)
    assert [{r.k0 for r in df.collect()} for df in seen] == [{-1}, {-1}]
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in seen]
    assert all("BroadcastHashJoin" in p and "__salt" not in p for p in plans)


def test_hot_keys_spread_over_salts(spark, monkeypatch):
    monkeypatch.setattr(joins, "SALTS", 4)
    left = table(spark, 3, 60).withColumn("k1", F.lit(7))
    c = col_ops.compare(left, table(spark, 4, 60).withColumn("k1", F.lit(7)), ["k1"], ["num", "txt"])
    dups = col_ops.duplicated(c)
    counted = dups.select("k0", (F.col("left_n") + F.col("right_n")).alias("n"))
    marked = joins.mark_keys(c.left, counted, ["k0"], False)
    assert marked.count() == 60 and marked.where("__listed").select("__salt").distinct().count() > 1
    assert sorted(map(tuple, col_ops.column_diff(c).collect())) == joined_counts(c)


def test_equal_rows_of_a_hot_key_spread(spark):
    rows = spark.range(0, 8000, 1, 8).select(F.lit(7).alias("k0"), F.lit("a").alias("l0"))
    counted = rows.groupBy("k0").agg(F.count("*").alias("n"))
    marked = joins.mark_keys(rows, counted, ["k0"], False).where("__listed")
    sizes = [r["count"] for r in marked.groupBy("__salt").count().collect()]
    assert sum(sizes) == 8000 and max(sizes) <= 4000


def test_no_pairs_of_a_repeated_key_in_the_plan(spark):
    """2 x 3000 rows of one key: counting must not take 9 million pairs."""
    left = spark.range(3000).select(F.lit(1).alias("k"), (F.col("id") % 5).alias("v"))
    c = col_ops.compare(left, left, ["k"])
    row = col_ops.column_diff(c).first()
    assert (int(row.shared), int(row.mismatches)) == (9_000_000, 9_000_000 - 5 * 600 * 600)


def test_unique_keys_join_plainly(spark):
    left = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    right = left.withColumn("v", F.when(F.col("k") < 3, F.lit(None).cast("string")).otherwise(F.lit("a")))
    row = col_ops.column_diff(col_ops.compare(left, right, ["k"])).first()
    assert (int(row.shared), int(row.mismatches), row.residual) == (100, 3, None)


def test_wide_tables_are_counted_by_chunks(spark, monkeypatch):
    wide = [f"c{i}" for i in range(130)]
    left = spark.range(60).select(F.col("id").alias("k"), *[((F.col("id") + i) % 7).alias(n) for i, n in enumerate(wide)])
    right = left.where("k < 50").withColumns(
        {"c0": F.lit(None).cast("bigint"), "c101": F.when(F.col("k") < 5, 9).otherwise(F.col("c101")), "c129": F.col("c129") + 1}
    )
    where = {"c0": "prod_value > 3", "c129": "uat_value > prod_value", "c7": "prod_value = 1"}
    c = col_ops.compare(left, right, ["k"], where=where)
    got = sorted(map(tuple, col_ops.column_diff(c).collect()))
    monkeypatch.setattr(col_ops, "CHUNK", 1000)
    assert got == joined_counts(c) and len(got) == 130 and sum(1 for r in got if r[3]) == 3
    monkeypatch.setattr(col_ops, "CHUNK", 100)
    assert {tuple(r)[2:] for r in col_ops.column_diff(col_ops.compare(left.limit(0), right, ["k"])).collect()} == {(0, 0, None)}


def test_no_columns_to_compare(spark):
    left = spark.range(3).withColumnRenamed("id", "k")
    assert col_ops.column_diff(col_ops.compare(left, left, ["k"])).count() == 0


def test_decimals_of_other_scale_and_nested_values(spark):
    left = spark.sql("select 1 as k, cast(1.5 as decimal(4,1)) as d, array(1, 2) as a, map('x', 1) as m")
    right = spark.sql("select 1 as k, cast(1.5 as decimal(6,3)) as d, array(1, 3) as a, map('x', 1) as m")
    got = {r.column: int(r.mismatches) for r in col_ops.column_diff(col_ops.compare(left, right, ["k"])).collect()}
    assert got == {"d": 0, "a": 1, "m": 0}


def test_awkward_column_names(spark):
    left = spark.sql("select 1 as `Contract ID`, 'a' as `a.b`, 'x' as `it``s`")
    right = spark.sql("select 1 as `Contract ID`, 'b' as `a.b`, 'x' as `it``s`")
    c = col_ops.compare(left, right, ["Contract ID"])
    assert {r.column: int(r.mismatches) for r in col_ops.column_diff(c).collect()} == {"a.b": 1, "it`s": 0}
    sample = col_ops.column_samples(c, col_ops.align_unique(c), 5).first()
    assert sample["Contract ID"] == "1" and (sample.left_value, sample.right_value) == ("a", "b")


def test_sides_swapped_mirror(spark):
    a, b = table(spark, 5), table(spark, 6)
    counts = [
        {r.column: (int(r.shared), int(r.mismatches)) for r in col_ops.column_diff(col_ops.compare(x, y, ["k1"])).collect()}
        for x, y in ((a, b), (b, a))
    ]
    assert counts[0] == counts[1]


def test_samples_are_limited_before_the_shuffle(spark):
    left = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    c = col_ops.compare(left, left.withColumn("v", F.lit(2)), ["k"])
    samples = col_ops.column_samples(c, col_ops.align_unique(c), 5)
    assert [r.k for r in samples.orderBy("sample").collect()] == ["0", "1", "2", "3", "4"]
    plan = samples._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ranking_puts_predicate_columns_first(spark):
    counts = spark.createDataFrame(
        [("a", 0, 10, 5, None), ("b", 1, 10, 9, None), ("c", 2, 10, 2, 1), ("d", 3, 10, 4, 3), ("e", 4, 10, 0, 0)],
        "column string, ordinal int, shared int, mismatches int, residual int",
    )
    assert [r.column for r in col_ops.ranked_columns(counts, 3).orderBy("position").collect()] == ["d", "c", "b"]
    assert [r.column for r in col_ops.ranked_columns(counts, 1, True).orderBy("position").collect()] == ["d", "c", "e"]


def test_conditions_know_their_sides():
    p = read("(prod_value = 'a' or uat_value is null) and date(prod_value) = date(uat_value)")
    assert [sorted(c.sides) for c in p.conditions] == [["left"], ["right"], ["left", "right"]]
    assert p.conditions[2].compares[0] == "="
    assert [c.sql for c in read("prod_value between 1 and 2 and not uat_value = 3").conditions] == [
        "\x01 between 1 and 2", "\x02 = 3",
    ]


def test_not_a_number_is_a_key_like_any_other(spark):
    left = spark.createDataFrame([(float("nan"), 1), (2.0, 1), (None, 1)], "k double, v int")
    row = col_ops.column_diff(col_ops.compare(left, left.withColumn("v", F.lit(2)), ["k"])).first()
    assert (int(row.shared), int(row.mismatches)) == (2, 2)
