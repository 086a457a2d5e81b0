"""Row counts, key uniqueness and key-set differences.

All of them come from one *key profile*: both sides tagged, put together and grouped by key.  That is
one shuffle of key columns for both sides; the counts combine before it, so a key that holds a third
of all rows arrives as one row per task.  Grouping treats NULL keys as equal, as set operators do.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from twinledger.functions.normalise import quoted

LEFT_N, RIGHT_N = "left_n", "right_n"


def side_counts(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per distinct value of ``columns`` over both sides, with how often each side has it."""
    cols = [quoted(c) for c in columns]
    both = left.select(*cols, F.lit(True).alias("__left")).unionByName(
        right.select(*cols, F.lit(False).alias("__left"))
    )
    return both.groupBy(*cols).agg(
        F.count_if(quoted("__left")).alias(LEFT_N), F.count_if(~quoted("__left")).alias(RIGHT_N)
    )


def key_profile(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key over both sides: key columns, ``left_n``, ``right_n``."""
    return side_counts(left, right, keys)


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [quoted(k).isNull() for k in keys])


def key_summary(profile: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with every count the grain and key tiers need."""
    l, r = F.col(LEFT_N), F.col(RIGHT_N)

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return profile.agg(
        total(l).alias("left_rows"),
        total(r).alias("right_rows"),
        F.count_if(l > 0).alias("left_keys"),
        F.count_if(r > 0).alias("right_keys"),
        F.count_if(l > 1).alias("left_dup_keys"),
        F.count_if(r > 1).alias("right_dup_keys"),
        total(F.greatest(l - 1, F.lit(0))).alias("left_extra_rows"),
        total(F.greatest(r - 1, F.lit(0))).alias("right_extra_rows"),
        F.count_if(r == 0).alias("left_only"),
        F.count_if(l == 0).alias("right_only"),
        F.count_if((l > 0) & (r > 0)).alias("shared_keys"),
        total(F.when(any_null(keys), l + r).otherwise(0)).alias("null_key_rows"),
    )


def row_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row count of each side and the signed difference, from one pass over a tagged union."""
    both = left.select(F.lit(1).alias("l")).unionByName(right.select(F.lit(0).alias("l")))
    l, r = F.count_if(F.col("l") == 1), F.count_if(F.col("l") == 0)
    return both.agg(l.alias("left_rows"), r.alias("right_rows"), (l - r).alias("diff"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Keys that occur more than once, most frequent first when limited to a sample."""
    cols = [quoted(k) for k in keys]
    dups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return dups if limit is None else dups.orderBy(F.desc("n"), *_nulls_first(keys)).limit(limit)


def shared_keys(profile: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys present on both sides; NULL equals NULL."""
    return profile.where((F.col(LEFT_N) > 0) & (F.col(RIGHT_N) > 0)).select(*[quoted(k) for k in keys])


def one_sided_keys(profile: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """Distinct keys only the ``left`` or only the ``right`` side has."""
    missing = RIGHT_N if side == "left" else LEFT_N
    return profile.where(F.col(missing) == 0).select(*[quoted(k) for k in keys])


def _nulls_first(keys: Sequence[str]) -> list[Column]:
    return [quoted(k).asc_nulls_first() for k in keys]


def key_samples(profile: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """The first ``limit`` one-sided keys of each direction in key order, NULLs first."""

    def part(side: str, direction: str) -> DataFrame:
        return (
            one_sided_keys(profile, keys, side)
            .orderBy(*_nulls_first(keys))
            .limit(limit)
            .withColumn("direction", F.lit(direction))
        )

    return part("left", "in_left_not_right").unionByName(part("right", "in_right_not_left"))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in the given order, by aggregation rather than by sorting each key's rows."""
    cols = [quoted(k) for k in keys]
    rest = [c for c in df.columns if c not in set(keys)]
    picked = df.groupBy(*cols).agg(
        F.min_by(F.struct(*[quoted(c) for c in rest]), F.struct(*order)).alias("__row")
    )
    return picked.select(*cols, *[F.col("__row")[c].alias(c) for c in rest])
