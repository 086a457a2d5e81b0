"""Sides of a table comparison: tables of a catalog database, or Parquet folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def split_side(spec: str, default_schema: str) -> tuple[str, str]:
    """``DB`` or ``DB.SCHEMA``; the schema defaults to the configured one."""
    database, _, schema = str(spec).partition(".")
    return database, schema or default_schema


def table_name(spec: str, default_schema: str, table: str) -> str:
    return ".".join(f"`{part}`" for part in (*split_side(spec, default_schema), table))


def open_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The named table, or None when the side does not have it."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def open_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def evaluation_error(df: DataFrame, side: str) -> str | None:
    """Does a side evaluate at all?  Tells which side an error comes from."""
    try:
        df.limit(1).collect()
        return None
    except Exception as e:  # whatever the side raises is the finding
        return f"{side} side fails to evaluate: {type(e).__name__}: {str(e).splitlines()[0][:200]}"


def presence(left_tables: DataFrame, right_tables: DataFrame, wanted: DataFrame) -> DataFrame:
    """For every wanted table: is it on both sides, and if not, which verdict and why.

    All inputs have ``table_name``.
    """
    l = left_tables.select("table_name", F.lit(True).alias("in_left"))
    r = right_tables.select("table_name", F.lit(True).alias("in_right"))
    j = wanted.select("table_name").join(l, "table_name", "left").join(r, "table_name", "left")
    in_left, in_right = [F.coalesce(c, F.lit(False)) for c in ("in_left", "in_right")]
    note = (
        F.when(~in_left & ~in_right, F.lit("absent on both sides"))
        .when(~in_right, F.lit("absent on the right"))
        .when(~in_left, F.lit("absent on the left"))
    )
    return j.select(
        "table_name",
        in_left.alias("in_left"),
        in_right.alias("in_right"),
        F.when(in_left & in_right, F.lit(None).cast("string")).otherwise(F.lit("BLOCKED")).alias("verdict"),
        note.alias("note"),
    )


def table_names(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "table_name string")
