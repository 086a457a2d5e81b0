"""Per-column mismatch counts over shared keys, residuals after accepted predicates, samples.

Three ways to align rows, chosen by what the grain check found:

* unique keys, and keys with few copies: a plain inner join, a few pairs per row at most;
* keys with many copies in the table ladders: the join would pair every copy with every copy, so the pairs
  are *counted* from grouped values instead of being formed;
* CSV ladder: the first row of each key, by one grouping of both sides.

Columns travel under short internal names: keys ``k0..``, values ``l0..`` and ``r0..``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from twinledger.functions.normalise import groupable, quoted, table_value
from twinledger.functions.predicates import Predicate, explained, usable
from twinledger.operators.fingerprint import cell_text, shown_text
from twinledger.operators.joins import join_on, split_keys
from twinledger.operators.keys import LEFT_N, RIGHT_N, any_null, side_counts
from twinledger.operators.residuals import PAIRS, pair_counts
from twinledger.sources.storage import stored


def compared_columns(left: DataFrame, right: DataFrame, keys: Iterable[str], excluded: Iterable[str] = ()) -> list[str]:
    """Columns of both sides that are neither key nor excluded, in left order."""
    skip = set(keys) | set(excluded)
    return [c for c in left.columns if c in set(right.columns) and c not in skip]


def _names(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """Type both decimals fit in; other types are compared as they are."""
    if a != b and isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        return T.DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + scale), scale)
    return None


@dataclass(frozen=True)
class Comparison:
    """Both sides reduced to key and comparison values under internal names."""

    left: DataFrame  # k0.., l0..
    right: DataFrame  # k0.., r0..
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    predicates: dict[int, Predicate]  # by position in ``columns``
    has_where: frozenset  # positions of columns with a predicate text, usable or not
    notes: tuple[str, ...]
    null_safe: bool
    null_explains: bool

    @property
    def key_names(self) -> list[str]:
        return _names("k", len(self.keys))


def compare(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    where: Mapping[str, str] | None = None,
    nullif_text: bool = True,
    trim_text: bool = False,
    null_safe: bool = False,
    null_explains: bool = True,
    half_even: bool = False,
    carry: Sequence[Column] = (),
) -> Comparison:
    """Prepare a comparison; ``where`` maps columns to predicates of accepted differences.

    With ``null_safe`` a NULL key equals a NULL key; without it rows with a NULL key align with
    nothing.  ``carry`` adds further columns to both sides, such as the order of rows.
    """
    columns = list(columns if columns is not None else compared_columns(left, right, keys))
    left, right = _plain(left, keys, columns), _plain(right, keys, columns)

    def side(df: DataFrame, other: DataFrame, prefix: str) -> DataFrame:
        values = []
        for i, c in enumerate(columns):
            dtype, shared = df.schema[c].dataType, _common_type(df.schema[c].dataType, other.schema[c].dataType)
            value = table_value(quoted(c), dtype, nullif_text, trim_text)
            values.append((value.cast(shared) if shared else value).alias(f"{prefix}{i}"))
        out = df.select(*[quoted(k).alias(f"k{i}") for i, k in enumerate(keys)], *values, *carry)
        return out if null_safe else out.where(~any_null(_names("k", len(keys))))

    l, r = side(left, right, "l"), side(right, left, "r")
    predicates, notes = {}, []
    values = [f for d, p in ((l, "l"), (r, "r")) for f in d.schema.fields if f.name in set(_names(p, len(columns)))]
    both = left.sparkSession.createDataFrame([], T.StructType(values))  # to check predicates against
    texts = {i: where[c] for i, c in enumerate(columns) if (where or {}).get(c)}
    for i, text in texts.items():
        predicate, note = usable(text, l.schema[f"l{i}"].dataType, both, f"l{i}", f"r{i}", half_even)
        if predicate is None:
            notes.append(f"{columns[i]}: {note}")
        else:
            predicates[i] = predicate
    return Comparison(
        l, r, tuple(keys), tuple(columns), predicates, frozenset(texts), tuple(notes), null_safe, null_explains
    )


def _plain(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Nested values as JSON text, everything else untouched and every other column still available."""
    rendered = {f.name: c for f, c in zip(df.schema.fields, groupable(df).schema.fields) if f.dataType != c.dataType}
    wanted = [c for c in rendered if c in set(keys) | set(columns)]
    return df.withColumns({c: F.to_json(quoted(c)) for c in wanted}) if wanted else df


def align_unique(c: Comparison) -> DataFrame:
    """Inner join on the key, for keys known to be unique on both sides: k.., l.., r.. ."""
    return join_on(c.left, c.right, c.key_names, c.null_safe, "inner")


def mismatch(i: int) -> Column:
    return ~F.col(f"l{i}").eqNullSafe(F.col(f"r{i}"))


def unexplained(c: Comparison, i: int) -> Column:
    found = explained(c.predicates.get(i), f"l{i}", f"r{i}", c.null_explains)
    return mismatch(i) & ~found if i in c.has_where else mismatch(i)


#: Columns above which a table is counted by chunks of so many.
CHUNK = 100


def mismatch_counts(c: Comparison, aligned: DataFrame) -> DataFrame:
    """Tall counts ``(column, ordinal, shared, mismatches, residual)`` from aligned rows, in one pass.

    ``residual`` is NULL for columns without a predicate.
    """
    n = len(c.columns)
    if n > CHUNK:
        return _wide_counts(c, aligned)
    aggs = [F.count(F.lit(1)).cast(PAIRS).alias("shared")]
    aggs += [F.count_if(mismatch(i)).cast(PAIRS).alias(f"m{i}") for i in range(n)]
    aggs += [F.count_if(unexplained(c, i)).cast(PAIRS).alias(f"u{i}") for i in sorted(c.has_where)]
    return _tall(c, aligned.agg(*aggs))


def _wide_counts(c: Comparison, aligned: DataFrame) -> DataFrame:
    """As ``mismatch_counts``: a row tells which of its columns differ, chunk by chunk, and these are counted.

    A chunk that is equal on both sides is left without a look at its columns.
    """
    nothing = F.array().cast("array<struct<ordinal:int,open:boolean>>")

    def chunk(start: int) -> Column:
        at = range(start, min(start + CHUNK, len(c.columns)))
        cells = [
            F.when(mismatch(i), F.struct(F.lit(i).alias("ordinal"), (unexplained(c, i) if i in c.has_where else F.lit(False)).alias("open")))
            for i in at
        ]
        sides = [F.struct(*[F.col(f"{side}{i}").alias(f"v{i}") for i in at]) for side in "lr"]
        same = sides[0].eqNullSafe(sides[1])
        return F.when(same, nothing).otherwise(F.array_compact(F.array(*cells)))

    marker = F.array(F.struct(F.lit(-1).alias("ordinal"), F.lit(False).alias("open")))  # each aligned row once
    told = aligned.select(F.inline(F.concat(marker, *[chunk(i) for i in range(0, len(c.columns), CHUNK)])))
    counts = told.groupBy("ordinal").agg(F.count("*").cast(PAIRS).alias("n"), F.count_if("open").cast(PAIRS).alias("open"))
    shared = counts.where("ordinal = -1").select(F.col("n").alias("shared"))
    names = [(name, i, i in c.has_where) for i, name in enumerate(c.columns)]
    rows = aligned.sparkSession.createDataFrame(names, "column string, ordinal int, ruled boolean")
    zero = F.lit(0).cast(PAIRS)
    found = rows.join(counts, "ordinal", "left").join(shared, F.lit(True), "left")  # one row of ``shared`` at most
    residual = F.when(F.col("ruled"), F.coalesce("open", zero))
    return found.select(
        "column", "ordinal", F.coalesce("shared", zero).alias("shared"), F.coalesce("n", zero).alias("mismatches"), residual.alias("residual")
    )


def _tall(c: Comparison, wide: DataFrame) -> DataFrame:
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(i).alias("ordinal"),
            F.col("shared").alias("shared"),
            F.col(f"m{i}").alias("mismatches"),
            (F.col(f"u{i}") if i in c.has_where else F.lit(None).cast(PAIRS)).alias("residual"),
        )
        for i, name in enumerate(c.columns)
    ]
    if not cells:
        schema = "column string, ordinal int, shared decimal(38,0), mismatches decimal(38,0), residual decimal(38,0)"
        return wide.sparkSession.createDataFrame([], schema)
    return wide.select(F.inline(F.array(*cells)))


# -- duplicated keys -----------------------------------------------------------------------------


def duplicated(c: Comparison) -> DataFrame:
    """Keys both sides have and at least one has more than once, with their row counts."""
    profile = side_counts(c.left, c.right, c.key_names)
    l, r = F.col(LEFT_N), F.col(RIGHT_N)
    return profile.where((l > 0) & (r > 0) & ((l > 1) | (r > 1)))


def _cells(c: Comparison, df: DataFrame, prefix: str) -> DataFrame:
    """Rows as (key, column position, value text)."""
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"), cell_text(F.col(f"{prefix}{i}"), df.schema[f"{prefix}{i}"].dataType).alias("v")
            )
            for i in range(len(c.columns))
        ]
    )
    return df.select(*c.key_names, F.inline(cells))


def _split(c: Comparison, keys: DataFrame) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """Inner join of the rows whose keys are not among these, and the rows of either side whose keys are."""
    counted = keys.select(*c.key_names, (F.col(LEFT_N) + F.col(RIGHT_N)).alias("n"))
    return split_keys(c.left, c.right, counted, c.key_names, c.null_safe)


#: Copies of a key on either side up to which the join forms its pairs: ``FEW / 2`` per row at most, which takes less
#: than a row per cell, its shuffle and the grouping of its values would.
FEW = 32


def copious(dups: DataFrame) -> DataFrame:
    """Of the duplicated keys those with more than ``FEW`` rows on a side: their pairs are counted, not formed."""
    return dups.where(F.greatest(LEFT_N, RIGHT_N) > FEW)


def fan_out_counts(c: Comparison, many: DataFrame) -> DataFrame:
    """Counts of the join that pairs all rows of equal key, for keys that may repeat; ``many`` are the copious ones.

    All other keys are joined.  For copious keys the number of pairs is the product of both
    row counts and the number of equal pairs follows from how often each value occurs on each side,
    so no pair is formed, however many rows a key has.  Residuals follow likewise (``residuals``).
    """
    rest, (left, right) = _split(c, many)
    single = mismatch_counts(c, rest)
    values = side_counts(_cells(c, left, "l"), _cells(c, right, "r"), [*c.key_names, "i", "v"])
    if c.has_where:
        # Comparisons across the sides look at the values again.
        values = stored(values, "fan-out-values")
    counted = pair_counts(c, values)
    out = single.join(counted, "ordinal", "left")

    def plus(name: str) -> Column:
        total = F.col(name) + F.coalesce(F.col(f"{name}2"), F.lit(0).cast(PAIRS))
        return total.cast(PAIRS).alias(name)

    return out.select("column", "ordinal", plus("shared"), plus("mismatches"), plus("residual"))


def column_diff(c: Comparison, dups: DataFrame | None = None) -> DataFrame:
    """Tall mismatch counts over shared keys: ``(column, ordinal, shared, mismatches, residual)``.

    ``dups`` are the stored duplicated keys; left open, a pass over the key columns finds them.
    """
    many = stored(copious(duplicated(c)), "copious-keys") if dups is None else copious(dups)
    return mismatch_counts(c, align_unique(c)) if many.isEmpty() else fan_out_counts(c, many)


# -- first row per key ---------------------------------------------------------------------------


def align_first(c: Comparison, order: Sequence[str], flag: str | None = None) -> DataFrame:
    """Both sides grouped by key in one shuffle: first row of each side and how many rows it has.

    Keeps keys of one side only; their other side's count is 0.  ``order`` names the carried columns
    that define which row comes first; a carried ``flag`` is counted per side as well.
    """
    n = len(c.columns)

    def tagged(df: DataFrame, prefix: str, is_left: bool) -> DataFrame:
        values = F.struct(F.lit(0).alias("z"), *[F.col(f"{prefix}{i}").alias(f"v{i}") for i in range(n)])
        return df.select(
            *c.key_names,
            F.lit(is_left).alias("is_left"),
            (F.col(flag) if flag else F.lit(False)).alias("flag"),
            values.alias("row"),
            F.struct(*order).alias("place"),
        )

    both = tagged(c.left, "l", True).unionByName(tagged(c.right, "r", False))

    def first(is_left: bool) -> Column:
        mine = F.col("is_left") == F.lit(is_left)
        return F.min_by(F.when(mine, F.col("row")), F.when(mine, F.col("place")))

    grouped = both.groupBy(*c.key_names).agg(
        F.count_if("is_left").alias(LEFT_N),
        F.count_if(~F.col("is_left")).alias(RIGHT_N),
        F.count_if(F.col("is_left") & F.col("flag")).alias("left_flagged"),
        F.count_if(~F.col("is_left") & F.col("flag")).alias("right_flagged"),
        first(True).alias("l"),
        first(False).alias("r"),
    )
    return grouped.select(
        *c.key_names,
        LEFT_N,
        RIGHT_N,
        *(["left_flagged", "right_flagged"] if flag else []),
        *[F.col("l")[f"v{i}"].alias(f"l{i}") for i in range(n)],
        *[F.col("r")[f"v{i}"].alias(f"r{i}") for i in range(n)],
    )


def first_row_counts(c: Comparison, aligned: DataFrame) -> tuple[DataFrame, list[str]]:
    """One row with all key counts and all column counts of ``align_first`` rows, and the key count names."""
    l, r = F.col(LEFT_N), F.col(RIGHT_N)
    both = (l > 0) & (r > 0)

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(x), F.lit(0)).cast("bigint")

    counts = {
        "left_rows": total(l),
        "right_rows": total(r),
        "left_keys": F.count_if(l > 0),
        "right_keys": F.count_if(r > 0),
        "left_extra_rows": total(F.greatest(l - 1, F.lit(0))),
        "right_extra_rows": total(F.greatest(r - 1, F.lit(0))),
        "left_only": F.count_if(r == 0),
        "right_only": F.count_if(l == 0),
        "shared_keys": F.count_if(both),
    }
    if "left_flagged" in aligned.columns:
        counts |= {"left_flagged": total(F.col("left_flagged")), "right_flagged": total(F.col("right_flagged"))}
    columns = [F.count_if(both & mismatch(i)).cast(PAIRS).alias(f"m{i}") for i in range(len(c.columns))]
    columns += [F.count_if(both & unexplained(c, i)).cast(PAIRS).alias(f"u{i}") for i in sorted(c.has_where)]
    shared = F.count_if(both).cast(PAIRS).alias("shared")
    return aligned.agg(*[v.alias(k) for k, v in counts.items()], shared, *columns), list(counts)


def tall_counts(c: Comparison, wide: DataFrame) -> DataFrame:
    """Column counts of a one-row aggregate as ``(column, ordinal, shared, mismatches, residual)``."""
    return _tall(c, wide)


def on_both_sides(aligned: DataFrame) -> DataFrame:
    return aligned.where((F.col(LEFT_N) > 0) & (F.col(RIGHT_N) > 0))


# -- ranking and samples -------------------------------------------------------------------------


def ranked_columns(counts: DataFrame, cap: int, keep_clean_where: bool = False) -> DataFrame:
    """Columns worth showing, best first: those with a predicate by residual, then the rest by mismatches.

    Columns with a predicate are always kept; the others fill up to ``cap``.  ``keep_clean_where`` also
    lists predicate columns without mismatches, as the CSV ladder does.
    """
    has_where = F.col("residual").isNotNull()
    shown = (F.col("mismatches") > 0) | (has_where & F.lit(keep_clean_where))
    # One row per column of a table: this window never sees table rows.
    order = Window.orderBy(has_where.desc(), F.coalesce("residual", "mismatches").desc(), "ordinal")
    return (
        counts.where(shown)
        .withColumn("position", F.row_number().over(order))
        .where(has_where | (F.col("position") <= cap))
    )


def column_samples(
    c: Comparison, aligned: DataFrame, per_column: int, picked: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """Up to ``per_column`` unexplained differences of each column in key order.

    ``picked`` limits the columns shown: names, or the frame of ``ranked_columns``.  The row limit works
    before the shuffle (``WindowGroupLimit``), so a column that differs in every row stays cheap.
    """
    names = list(picked) if isinstance(picked, (list, tuple)) else list(c.columns)
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                unexplained(c, i).alias("differs"),
                shown_text(F.col(f"l{i}"), aligned.schema[f"l{i}"].dataType).alias("left_value"),
                shown_text(F.col(f"r{i}"), aligned.schema[f"r{i}"].dataType).alias("right_value"),
            )
            for i, name in enumerate(c.columns)
            if name in set(names)
        ]
    )
    tall = aligned.select(*c.key_names, F.inline(F.filter(cells, lambda x: x["differs"])))
    if isinstance(picked, DataFrame):
        # As many rows as the table has columns at most.
        tall = tall.join(F.broadcast(picked.select("column")), "column", "left_semi")
    order = [F.col(k).asc_nulls_first() for k in c.key_names]
    order += [F.col("left_value").asc_nulls_first(), F.col("right_value").asc_nulls_first()]
    numbered = tall.withColumn("sample", F.row_number().over(Window.partitionBy("column").orderBy(*order)))
    return numbered.where(F.col("sample") <= per_column).select(
        "column",
        "sample",
        *[F.col(k).cast("string").alias(name) for k, name in zip(c.key_names, c.keys)],
        "left_value",
        "right_value",
    )


def align_samples(c: Comparison, dups: DataFrame) -> DataFrame:
    """Aligned rows to draw samples from: of a repeated key only the least row of each side."""
    if dups.isEmpty():
        return align_unique(c)
    rest, (left, right) = _split(c, dups)

    def least(df: DataFrame, prefix: str) -> DataFrame:
        values = _names(prefix, len(c.columns))
        grouped = df.groupBy(*c.key_names).agg(F.min(F.struct(*values)).alias("row"))
        return grouped.select(*c.key_names, *[F.col("row")[v].alias(v) for v in values])

    return rest.unionByName(join_on(least(left, "l"), least(right, "r"), c.key_names, c.null_safe, "inner"))
