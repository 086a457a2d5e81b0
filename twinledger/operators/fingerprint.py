"""Table fingerprints that do not depend on row order but do on duplicates.

Every row is hashed and the hashes are summed, so a fingerprint is a plain aggregate: partial sums
per task, one row per task over the network.  A sum and not XOR, under which equal pairs cancel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from twinledger.functions.normalise import groupable, quoted


def cell_text(col: Column, dtype: T.DataType) -> Column:
    """Text with which two values of one type agree exactly when the values do."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return (col + F.lit(0.0).cast(dtype)).cast("string")  # -0.0 becomes 0.0
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col).cast("string")  # clock text repeats when clocks are put back
    return col.cast("string")


def shown_text(col: Column, dtype: T.DataType) -> Column:
    """Text of a value for people."""
    return F.hex(col) if isinstance(dtype, T.BinaryType) else col.cast("string")


def _tagged(text: Column) -> Column:
    # The length in front keeps neighbouring cells apart whatever they contain; NULL has no length.
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_text(df: DataFrame) -> Column:
    return F.concat(*[_tagged(cell_text(quoted(f.name), f.dataType)) for f in df.schema.fields])


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: ``rows`` and two sums over 60-bit lanes of the row hashes, as text."""
    df = groupable(df)
    digest = df.select(F.md5(row_text(df)).alias("h"))

    def lane(start: int) -> Column:
        number = F.conv(F.substring("h", start, 15), 16, 10).cast(T.DecimalType(28, 0))
        return F.coalesce(F.sum(number), F.lit(0).cast(T.DecimalType(38, 0))).cast("string")

    return digest.agg(F.count(F.lit(1)).alias("rows"), lane(1).alias("lane_1"), lane(17).alias("lane_2"))


def same_scale(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with one decimal type for decimal columns in the same place."""
    if len(left.columns) != len(right.columns):
        return left, right
    common = []
    for a, b in zip(left.schema.fields, right.schema.fields):
        types = [f.dataType for f in (a, b)]
        if types[0] == types[1] or not all(isinstance(t, T.DecimalType) for t in types):
            common.append(None)
            continue
        scale = max(t.scale for t in types)
        whole = max(t.precision - t.scale for t in types)
        common.append(T.DecimalType(min(38, whole + scale), min(scale, max(0, 38 - whole))))

    def side(df: DataFrame) -> DataFrame:
        return df.select(*[quoted(n) if t is None else quoted(n).cast(t).alias(n) for n, t in zip(df.columns, common)])

    return side(left), side(right)


def fingerprint_compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: number of distinct fingerprints of the two sides; one means equal.

    Decimal columns in the same place are read with the digits of both, so that equal values agree.
    """
    left, right = same_scale(left, right)
    both = fingerprint(left).unionByName(fingerprint(right)).distinct()
    n = F.count(F.lit(1))
    return both.agg(
        n.alias("distinct_fingerprints"), F.when(n == 1, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status")
    )
