"""Full-row differences, for tables whose key cannot align rows.

``EXCEPT`` in both directions is one grouping of both sides by the whole row: duplicates combine
before the shuffle and there is no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from twinledger.functions.normalise import groupable, is_text, projection_columns, quoted
from twinledger.operators.joins import mark_keys
from twinledger.operators.keys import LEFT_N, RIGHT_N, side_counts
from twinledger.sources.storage import stored

DIRECTIONS = ("in_left_not_right", "in_right_not_left")


def row_profile(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per distinct row over both sides, with how often each side has it."""
    left, right = groupable(left), groupable(right)
    return side_counts(left, right, left.columns)


def _direction_counts(profile: DataFrame, left_n, right_n) -> DataFrame:
    counts = profile.agg(left_n.alias(DIRECTIONS[0]), right_n.alias(DIRECTIONS[1]))
    return counts.unpivot([], list(DIRECTIONS), "direction", "n")


def row_diff(profile: DataFrame, distinct: bool = True) -> DataFrame:
    """Rows only one side has, per direction; ``distinct=False`` counts surplus copies as well."""
    l, r = F.col(LEFT_N), F.col(RIGHT_N)
    if distinct:
        return _direction_counts(profile, F.count_if(r == 0), F.count_if(l == 0))

    def surplus(a, b):
        return F.coalesce(F.sum(F.greatest(a - b, F.lit(0))), F.lit(0)).cast("bigint")

    return _direction_counts(profile, surplus(l, r), surplus(r, l))


def row_samples(profile: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` one-sided distinct rows of each direction, ordered by all columns."""
    cols = [c for c in profile.columns if c not in (LEFT_N, RIGHT_N)]

    def part(missing: str, direction: str) -> DataFrame:
        return (
            profile.where(F.col(missing) == 0)
            .select(F.lit(direction).alias("direction"), *[quoted(c) for c in cols])
            .orderBy(*[quoted(c).asc_nulls_first() for c in cols])
            .limit(limit)
        )

    return part(RIGHT_N, DIRECTIONS[0]).unionByName(part(LEFT_N, DIRECTIONS[1]))


def _keyed(df: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Projected rows next to their raw key values ``__k0``, ``__k1`` and so on."""
    raw = [quoted(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    return groupable(df.select(*raw, *projection_columns(df, **options)))


def shared_row_profile(left: DataFrame, right: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Row profile over rows whose key both sides have; ``options`` are those of the projection.

    Rows are grouped before they meet the shared keys, so each distinct row is looked up once.
    """
    raw = [f"__k{i}" for i in range(len(keys))]
    keyed_left, keyed_right = _keyed(left, keys, **options), _keyed(right, keys, **options)
    rows = side_counts(keyed_left, keyed_right, keyed_left.columns)
    l, r = F.col(LEFT_N), F.col(RIGHT_N)
    shared = stored(
        rows.groupBy(*raw)
        .agg(F.max(l > 0).alias("in_left"), F.max(r > 0).alias("in_right"), F.count(F.lit(1)).alias("n"))
        .where("in_left and in_right")
        .select(*raw, "n"),
        "shared-keys",
    )
    kept = mark_keys(rows, shared, raw, null_safe=True).where("__listed")
    cols = [quoted(c) for c in keyed_left.columns[len(keys):]]
    return kept.groupBy(*cols).agg(F.sum(LEFT_N).alias(LEFT_N), F.sum(RIGHT_N).alias(RIGHT_N))


def shared_row_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Distinct rows only one side has, per direction, among rows whose key both sides have."""
    dropped = set(options.get("drop", ()))
    kept_as_is = not options.get("override") and all(
        f.name not in dropped and not is_text(f.dataType)
        for f in left.schema.fields
        if f.name in set(keys)
    )
    if not kept_as_is:
        return row_diff(shared_row_profile(left, right, keys, **options))
    # The projection carries the raw key, so the key's rows can be summed up without joining:
    # distinct rows first, then one row per key, both combining before their shuffle.
    rows = row_profile(
        left.select(*projection_columns(left, **options)), right.select(*projection_columns(right, **options))
    )
    l, r = F.col(LEFT_N), F.col(RIGHT_N)
    per_key = rows.groupBy(*[quoted(k) for k in keys]).agg(
        F.count_if(r == 0).alias("left_only"),
        F.count_if(l == 0).alias("right_only"),
        F.max(l > 0).alias("in_left"),
        F.max(r > 0).alias("in_right"),
    )

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    return _direction_counts(per_key.where("in_left and in_right"), total("left_only"), total("right_only"))
