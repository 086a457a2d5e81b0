"""Tenant restriction and row counts per tenant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from twinledger.functions.normalise import quoted
from twinledger.operators.joins import join_list
from twinledger.operators.keys import LEFT_N, RIGHT_N, side_counts


def active_rows(df: DataFrame, active: DataFrame, tenant: Sequence[str]) -> DataFrame:
    """Rows of active tenants: an inner join, so a tenant listed twice doubles its rows."""
    return join_list(df, active, tenant)


def repeated_tenants(active: DataFrame, tenant: Sequence[str]) -> DataFrame:
    """Tenants listed more than once, whose rows the restriction would multiply."""
    return active.groupBy(*[quoted(c) for c in tenant]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def tenant_row_counts(
    left: DataFrame, right: DataFrame, tenant: Sequence[str], limit: int | None = None
) -> DataFrame:
    """Tenants whose row counts differ; the largest differences first when limited to a sample."""
    counts = side_counts(left, right, tenant).where(F.col(LEFT_N) != F.col(RIGHT_N))
    out = counts.select(
        *[quoted(c) for c in tenant],
        F.col(LEFT_N).alias("left_rows"),
        F.col(RIGHT_N).alias("right_rows"),
        (F.col(LEFT_N) - F.col(RIGHT_N)).alias("diff"),
    )
    if limit is None:
        return out
    return out.orderBy(F.abs("diff").desc(), *[quoted(c).asc_nulls_first() for c in tenant]).limit(limit)
