"""What the operators share: reading, Arrow batches in tasks, splitting by training fold, order over the whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Bytes of one Arrow batch: very long texts make a batch of few rows instead of a large one.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python task holds at once by bytes, not only by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base`` behind as many underscores as it takes to clash with no column, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def columns_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """Run ``work`` over a partition's Arrow batches; it yields columns by name, in any order, as lists or Arrow arrays."""
    small_batches(df.sparkSession)
    kind: StructType = _parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def array(values, kind):
        return values if isinstance(values, pa.Array) and values.type == kind else pa.array(values, kind)

    def run(batches):
        for found in work(batches):
            yield pa.RecordBatch.from_arrays([array(found[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def held_out(doc_id: int | None) -> bool:
    """Rows of the fold no model learns from: crc32 of the id as text, modulo 4, is 2. A null id counts as held out."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 4 == 2


def held_out_column(doc_id: str = "doc_id"):
    key = F.col(doc_id).cast("string")
    return F.coalesce(F.pmod(F.crc32(key.cast("binary")), F.lit(4)) == 2, F.lit(True))


#: Most ranges that a table is cut into; what reaches the driver about ranges is bounded by it.
BUCKETS = 100_000


def cut_points(keys: DataFrame, key: str, rows_per_bucket: int) -> list[int]:
    """Ascending values of ``key`` that cut it into ranges of about so many rows, or more if they would be too many."""
    rows = keys.count()
    buckets = min(BUCKETS, -(-rows // rows_per_bucket))
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = keys.agg(F.percentile_approx(key, shares, max(10_000, 20 * buckets)).alias("cuts")).first()["cuts"]
    return sorted({c for c in found or [] if c is not None})


def with_bucket(df: DataFrame, key: str, cuts: list[int], name: str) -> DataFrame:
    """Number of cut points at or below the key; null keys come first. Only the key goes through Arrow."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    places = np.array(cuts, "int64")

    @F.pandas_udf("int")
    def bucket(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, keys.to_numpy("int64"), "right").astype("int32"))

    # Nulls would make 64-bit numbers doubles: a value below every cut stands for them.
    return df.withColumn(name, bucket(F.coalesce(F.col(key), F.lit(int(places[0]) - 1)).cast("long")))


def running_start(sums: DataFrame, outer: str, inner: str, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows before, by (outer, inner); only one row per ``outer`` meets in one window."""
    totals = sums.groupBy(outer).agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy(outer).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(outer, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(outer).orderBy(inner).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return sums.withColumn("_own", own).join(starts, outer).withColumn(name, F.col("_own") + F.col("_start")).drop("_own", "_start")
