"""Joins that stay even when one key holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from twinledger.functions.normalise import quoted

# A key with more than this share of all counted rows is hot; there can be at most 1/share of them.
HOT_SHARE = 1e-4
# A list of at most this many rows is broadcast; a longer one is joined by shuffle, spread over salts.
BROADCAST_ROWS = 100_000
SALTS = 256


def join_on(a: DataFrame, b: DataFrame, keys: Sequence[str], null_safe: bool, how: str) -> DataFrame:
    """Equi join that keeps one copy of the keys; with ``null_safe`` NULL equals NULL."""
    if not null_safe:
        return a.join(b, list(keys), how)
    renamed = b.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [quoted(k).eqNullSafe(quoted(f"__{k}")) for k in keys]
    return a.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def _salt(df: DataFrame) -> Column:
    """A row's salt by what it holds and the partition it is in: equal rows spread too, and a task run again repeats it."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[quoted(c) for c in df.columns]), F.lit(SALTS)).cast("int")


def mark_keys(df: DataFrame, counted: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Rows of ``df`` with ``__listed``, whether their key is in ``counted``, and the salt ``__salt``.

    ``counted`` has each key once, with its number of rows ``n``.  Hot keys, of which there are fewer than
    ``1 / HOT_SHARE``, are recognised by a broadcast; their rows get salts and spread over ``SALTS`` tasks, all
    others have salt 0.  So the rows of a hot key never meet in one task, and rows of unlisted keys can be
    joined further on keys and salt without another shuffle.
    """
    columns = [quoted(k) for k in keys]
    limit = counted.agg(F.sum("n") * F.lit(HOT_SHARE)).scalar()
    hot = counted.where(F.col("n") > limit).select(*columns, F.lit(True).alias("__hot"))
    spread = _salt(df)
    salted = (
        join_on(df, F.broadcast(hot), keys, null_safe, "left")
        .withColumn("__salt", F.when(F.col("__hot"), spread).otherwise(F.lit(0)))
        .drop("__hot")
    )
    salts = F.when(F.col("n") > limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    listed = counted.select(*columns, F.explode(salts).alias("__salt"), F.lit(True).alias("__listed"))
    marked = join_on(salted, listed, [*keys, "__salt"], null_safe, "left")
    return marked.withColumn("__listed", F.coalesce("__listed", F.lit(False)))


def split_keys(
    left: DataFrame, right: DataFrame, counted: DataFrame, keys: Sequence[str], null_safe: bool
) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """The inner join of the rows whose keys are not in ``counted``, and the rows of both sides whose keys are.

    ``counted`` has each key once, with its number of rows ``n``.  A list of proven size is broadcast, so that listed rows
    stay where they are and the others are shuffled once; by a longer one rows are marked (``mark_keys``).
    """
    sides = (left, right)
    if counted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        listed = F.broadcast(counted.select(*[quoted(k) for k in keys]))
        rest = [join_on(side, listed, keys, null_safe, "left_anti") for side in sides]
        return join_on(*rest, keys, null_safe, "inner"), tuple(join_on(side, listed, keys, null_safe, "left_semi") for side in sides)
    marked = [mark_keys(side, counted, keys, null_safe) for side in sides]
    # Rows of unlisted keys all have salt 0, so their shuffle is kept.
    rest = [side.where(~F.col("__listed")).drop("__listed") for side in marked]
    return (
        join_on(*rest, [*keys, "__salt"], null_safe, "inner").drop("__salt"),
        tuple(side.where("__listed").drop("__listed", "__salt") for side in marked),
    )


def join_list(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join with a list that is usually short; only its key columns are used.

    A list of proven size is broadcast.  A longer one is repeated per salt and joined by shuffle, so the
    rows of a dominating key spread over ``SALTS`` tasks.
    """
    listed = listed.select(*[quoted(k) for k in keys])
    columns = [quoted(c) for c in df.columns]
    if listed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(listed), list(keys), "inner").select(*columns)
    salted = df.withColumn("__salt", _salt(df))
    repeated = listed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*keys, "__salt"], "inner").select(*columns)
