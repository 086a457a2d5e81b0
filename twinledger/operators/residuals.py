"""Pair counts of repeated keys: all pairs, differing ones, and those that no predicate explains, without forming pairs.

A predicate of one-sided conditions depends only on their outcomes, so values of a key fall into a few signatures and
pairs are products of signature counts: one grouping by key and column serves all columns.  One comparison across the
sides is counted apart: pairs are first counted as if it held for none and then corrected by the pairs it holds for.
Equal terms meet in one grouping by term, ordered terms are counted by running counts over ranges, and a distance
``abs(l - r) <= n`` is the count up to ``r + n`` less the count below ``r - n``.  Only a predicate with several different
comparisons across the sides pairs the distinct values of a key.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from twinledger.functions.predicates import Condition, Piece, Predicate, explained
from twinledger.operators.fingerprint import cell_text
from twinledger.operators.joins import join_on
from twinledger.operators.keys import LEFT_N, RIGHT_N
from twinledger.sources.storage import stored

PAIRS = T.DecimalType(38, 0)  # numbers of row pairs outgrow 64 bits
ROWS = T.DecimalType(19, 0)
# Comparison: the relation counted for it, and what the comparison comes to where that holds or fails.
_COUNTED = {
    "=": ("=", "true", "false"), "<>": ("=", "false", "true"), "<": ("<", "true", "false"),
    "<=": ("<=", "true", "false"), ">": ("<=", "false", "true"), ">=": ("<", "false", "true"),
}
_OUTCOMES = ("false", "true", "null")
#: Signatures of one side above which values are paired instead.
_MOST = 27


def _typed(text: Column, dtype: T.DataType) -> Column:
    """Inverse of the text a value was grouped by."""
    if isinstance(dtype, T.BinaryType):
        return F.unhex(text)
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    return text.cast(dtype)


@dataclass(frozen=True)
class _Across:
    """One comparison of a left with a right term: what is counted for it and how."""

    kind: tuple  # columns of one kind are counted together
    left: Callable[[str], Column]  # term of a value column
    right: tuple[Callable[[str], Column], ...]  # the term, or the upper and the lower end of a range
    relations: tuple[str, ...]  # one per right term; the first is added, the second taken off
    holds: str
    fails: str
    empty: tuple[Callable[[str], Column], Callable[[str], Column]]  # whether the terms are NULL, left and right


@dataclass(frozen=True)
class _Ruled:
    """A column with a predicate text, usable or not."""

    i: int
    dtype: T.DataType
    predicate: Predicate | None
    across: _Across | None
    null_explains: bool

    @property
    def value(self) -> str:
        return f"v{self.i}"

    def conditions(self, side: str) -> list[Condition]:
        return [p for p in (self.predicate.conditions if self.predicate else []) if p.sides == frozenset({side})]

    def signatures(self, side: str) -> int:
        return 3 ** len(self.conditions(side))

    def signature(self, side: str) -> Column:
        """Outcomes of a side's conditions for a value, as digits of a number in base 3."""
        code = F.lit(0)
        for n, p in enumerate(self.conditions(side)):
            code = code + F.coalesce(F.expr(p.on(self.value, self.value)).cast("int"), F.lit(2)) * (3**n)
        return code

    def unexplained(self, left: int, right: int, compared: str | None) -> Column:
        """Whether a pair of these signatures stays unexplained, given the outcome of the comparison across."""
        codes, sql = {"left": left, "right": right}, []
        for p in self.predicate.parts if self.predicate else ():
            if not isinstance(p, Condition) or not p.sides:
                sql.append(p.sql)
            elif len(p.sides) == 1:
                (side,) = p.sides
                codes[side], outcome = divmod(codes[side], 3)
                sql.append(_OUTCOMES[outcome])
            else:
                sql.append(compared or "null")
        outcome = F.expr(" ".join(sql)) if sql else F.lit(False)
        return ~F.coalesce(outcome, F.lit(self.null_explains))


def _two_sum(a: Column, b: Column) -> tuple[Column, Column]:
    """The sum of two doubles, and exactly what its rounding left off."""
    s = a + b
    added = s - a
    return s, (a - (s - added)) + (b - added)


def _end(r: Column, bound: float, half: float) -> Column:
    """``r + bound + half`` as a sum of two doubles that sorts as the exact value does."""
    s, left_off = _two_sum(r, F.lit(bound))
    high, low = _two_sum(s, left_off + F.lit(half))
    return F.struct((high + 0.0).alias("high"), (low + 0.0).alias("low"))


def _distance(sign: str, left: Piece, right: Piece, number: str, kinds: tuple[T.DataType, T.DataType]) -> _Across | None:
    """Left terms within a distance of a right one form a range; none for types whose ends are not exact."""
    relation, holds, fails = _COUNTED[sign]

    def across(kind, l, upper, lower, ends_count: bool):
        relations = ("<=", "<") if ends_count else ("<", "<=")
        empty = tuple(lambda v, p=p: F.expr(p.on(v, v)).isNull() for p in (left, right))
        return _Across(("within", *kind, ends_count), l, (upper, lower), relations, holds, fails, empty)

    if all(isinstance(k, (T.IntegralType, T.DecimalType)) for k in kinds):
        scales = [k.scale if isinstance(k, T.DecimalType) else 0 for k in kinds]
        scale = max(*scales, len(number.partition(".")[2]))
        digits = max(k.precision - k.scale if isinstance(k, T.DecimalType) else 19 for k in kinds)
        if max(digits, len(number.partition(".")[0])) + 1 + scale > 38:
            return None
        exact = T.DecimalType(38, scale)
        bound = F.lit(Decimal(number)).cast(exact)

        def term(piece: Piece, v: str) -> Column:
            return F.expr(piece.on(v, v)).cast(exact)

        return across(
            ("decimal", scale), lambda v: term(left, v), lambda v: (term(right, v) + bound).cast(exact),
            lambda v: (term(right, v) - bound).cast(exact), relation == "<=",
        )
    if not all(isinstance(k, T.DoubleType) for k in kinds):
        return None
    bound = float(number)
    if relation == "<":  # below a number is up to the one before it
        if bound <= 0:
            return None
        bound = math.nextafter(bound, 0)
    # Differences round to the bound or less up to half a step above it, that end included if the bound is even.
    half = math.ulp(bound) / 2
    even = not struct.unpack("<q", struct.pack("<d", bound))[0] & 1

    def finite(piece: Piece, v: str) -> Column:
        """No distance from or to infinity, or what is no number, is within a bound."""
        x = F.expr(piece.on(v, v))
        return F.when(F.abs(x) < F.lit(math.inf), x + 0.0)

    return across(
        ("double",), lambda v: F.when(finite(left, v).isNotNull(), F.struct(finite(left, v).alias("high"), F.lit(0.0).alias("low"))),
        lambda v: F.when(finite(right, v).isNotNull(), _end(finite(right, v), bound, half)),
        lambda v: F.when(finite(right, v).isNotNull(), _end(finite(right, v), -bound, -half)), even or half == 0,
    )


def _ruled(c, i: int) -> tuple[_Ruled, bool]:
    """The column's rule, and whether its pairs can be counted."""
    predicate = c.predicates.get(i)
    dtype = c.left.schema[f"l{i}"].dataType
    across = [p for p in (predicate.conditions if predicate else []) if len(p.sides) == 2]

    def kind(piece: Piece) -> T.DataType:
        return c.left.select(F.expr(piece.on(f"l{i}", f"l{i}"))).schema[0].dataType

    found = None
    if across and len({p.sql for p in across}) == 1:
        if across[0].compares:
            sign, *terms = across[0].compares
            relation, holds, fails = _COUNTED[sign]
            # The type in which the two terms are compared.
            both = c.left.select(F.expr(f"coalesce({terms[0].on(f'l{i}', f'l{i}')}, {terms[1].on(f'l{i}', f'l{i}')})")).schema[0].dataType
            left, right = (lambda v, t=t: F.expr(t.on(v, v)).cast(both) for t in terms)
            empty = tuple(lambda v, of=of: of(v).isNull() for of in (left, right))
            if relation == "=":
                as_text = lambda of: lambda v: cell_text(of(v), both)
                found = _Across(("=",), as_text(left), (as_text(right),), ("=",), holds, fails, empty)
            else:
                found = _Across((relation, both.simpleString()), left, (right,), (relation,), holds, fails, empty)
        elif across[0].within:
            sign, left, right, number = across[0].within
            found = _distance(sign, left, right, number, (kind(left), kind(right)))
    rule = _Ruled(i, dtype, predicate, found, c.null_explains)
    counted = bool(found or not across) and max(rule.signatures("left"), rule.signatures("right")) <= _MOST
    return rule, counted


def _with_values(rules: list[_Ruled], values: DataFrame) -> DataFrame:
    """Rows of these columns, with the typed value of each in a column of its own."""
    rows = values.where(F.col("i").isin([r.i for r in rules]))
    return rows.select("*", *[F.when(F.col("i") == r.i, _typed(F.col("v"), r.dtype)).alias(r.value) for r in rules])


def _by_column(rules: list[_Ruled], of: Callable[[_Ruled], Column]) -> Column:
    return reduce(lambda so_far, r: so_far.when(F.col("i") == r.i, of(r)), rules[1:], F.when(F.col("i") == rules[0].i, of(rules[0])))


def pair_counts(c, values: DataFrame) -> DataFrame:
    """``(ordinal, shared2, mismatches2, residual2)`` of all columns, from value counts (key, ``i``, ``v``, both row counts)."""
    rules = [_ruled(c, i) for i in sorted(c.has_where)]
    counted, paired = [r for r, ok in rules if ok], [r for r, ok in rules if not ok]
    l, r = F.col(LEFT_N).cast(ROWS), F.col(RIGHT_N).cast(ROWS)
    sums = {"ln": F.sum(l).cast(ROWS), "rn": F.sum(r).cast(ROWS), "equal": F.sum((l * r).cast(PAIRS))}
    residual = F.lit(None).cast(PAIRS)
    rows = values
    if counted:
        typed = [F.when(F.col("i") == x.i, _typed(F.col("v"), x.dtype)).alias(x.value) for x in counted]
        rows = values.select("*", *typed)
        codes = [_by_column(counted, lambda x, side=side: x.signature(side)).alias(f"{side}_code") for side in ("left", "right")]
        nulls = [
            _by_column(counted, lambda x, n=n: x.across.empty[n](x.value) if x.across else F.lit(False)).alias(name)
            for n, name in enumerate(("left_null", "right_null"))
        ]
        same = _by_column(counted, lambda x: explained(x.predicate, x.value, x.value, c.null_explains)).alias("same")
        rows = rows.select(*c.key_names, "i", LEFT_N, RIGHT_N, *codes, *nulls, same)
        for side, n in (("left", l), ("right", r)):
            for code, null in product(range(max(x.signatures(side) for x in counted)), (False, True)):
                mine = (F.col(f"{side}_code") == code) & (F.col(f"{side}_null") == null)
                sums[f"{side}_{code}_{int(null)}"] = F.coalesce(F.sum(F.when(mine, n)), F.lit(0)).cast(ROWS)
        sums["known"] = F.coalesce(F.sum(F.when(~F.col("same"), (l * r).cast(PAIRS))), F.lit(0)).cast(PAIRS)
        residual = _by_column(counted, _unexplained_pairs).cast(PAIRS)
    per_cell = rows.groupBy(*c.key_names, "i").agg(*[v.alias(k) for k, v in sums.items()])
    pairs = (F.col("ln") * F.col("rn")).cast(PAIRS)
    out = per_cell.groupBy(F.col("i").alias("ordinal")).agg(
        F.sum(pairs).alias("shared2"), F.sum((pairs - F.col("equal")).cast(PAIRS)).alias("mismatches2"),
        F.sum(residual).cast(PAIRS).alias("residual2"),
    )
    more = _corrections(c, counted, values) + [_paired(c, values, x) for x in paired]
    if not more:
        return out
    more = reduce(DataFrame.unionByName, more).groupBy("ordinal").agg(F.sum("n").cast(PAIRS).alias("_more"))
    added = F.coalesce("residual2", F.when(F.col("_more").isNotNull(), F.lit(0).cast(PAIRS))) + F.coalesce("_more", F.lit(0).cast(PAIRS))
    return out.join(more, "ordinal", "left").withColumn("residual2", added.cast(PAIRS)).drop("_more")


def _unexplained_pairs(x: _Ruled) -> Column:
    """Unexplained pairs of one key if the comparison across held for none, less pairs of equal values among them."""
    total = -F.col("known")
    sizes = range(x.signatures("left")), range(x.signatures("right"))
    nulls = (0, 1) if x.across else (0,)
    for a, b, left_null, right_null in product(*sizes, nulls, nulls):
        compared = x.across.fails if x.across and not (left_null or right_null) else None
        n = (F.col(f"left_{a}_{left_null}") * F.col(f"right_{b}_{right_null}")).cast(PAIRS)
        total = total + F.when(x.unexplained(a, b, compared), n).otherwise(F.lit(0).cast(PAIRS))
    return total


def _change(x: _Ruled, left: int, right: int) -> Column:
    """What a pair adds to the unexplained ones because the comparison holds for it."""
    return x.unexplained(left, right, x.across.holds).cast("int") - x.unexplained(left, right, x.across.fails).cast("int")


def _corrections(c, rules: list[_Ruled], values: DataFrame) -> list[DataFrame]:
    """``(ordinal, n)``: the changes by pairs for which the comparison across the sides holds, one frame per kind of it."""
    kinds: dict[tuple, list[_Ruled]] = {}
    for x in rules:
        if x.across:
            kinds.setdefault(x.across.kind, []).append(x)
    out = []
    for kind, some in kinds.items():
        rows = _with_values(some, values)
        key = [*c.key_names, "i"]

        def side(name: str, count: str, n: str, term: Callable[[_Ruled], Column], some=some, rows=rows) -> DataFrame:
            code = _by_column(some, lambda x: x.signature(name)).alias(f"{name}_code")
            found = rows.where(F.col(count) > 0).select(*key, code, _by_column(some, term).alias("term"), F.col(count).alias(n))
            return found.where(F.col("term").isNotNull())

        def changes(met: DataFrame, sign: int, some=some) -> DataFrame:
            def of(x: _Ruled) -> Column:
                sizes = product(range(x.signatures("left")), range(x.signatures("right")))
                at = lambda a, b: (F.col("left_code") == a) & (F.col("right_code") == b)
                return reduce(lambda so_far, ab: so_far.when(at(*ab), _change(x, *ab)), sizes, F.when(F.lit(False), F.lit(0)))

            n = (F.col("ln").cast(ROWS) * F.col("rn").cast(ROWS)).cast(PAIRS) * _by_column(some, of) * sign
            return met.groupBy(F.col("i").alias("ordinal")).agg(F.sum(n.cast(PAIRS)).cast(PAIRS).alias("n"))

        left = side("left", LEFT_N, "ln", lambda x: x.across.left(x.value))
        if kind[0] == "=":
            right = side("right", RIGHT_N, "rn", lambda x: x.across.right[0](x.value))
            out.append(_equal_terms(key, some, left, right))
            continue
        left = left.groupBy(*[n for n in left.columns if n != "ln"]).agg(F.sum("ln").cast(ROWS).alias("ln"))
        for end, sign in zip(range(len(some[0].across.right)), (1, -1)):
            right = side("right", RIGHT_N, "rn", lambda x, end=end: x.across.right[end](x.value))
            right = right.groupBy(*[n for n in right.columns if n != "rn"]).agg(F.sum("rn").cast(ROWS).alias("rn"))
            met = _below(key, c.null_safe, left, right, or_equal=some[0].across.relations[end] == "<=")
            out.append(changes(met, sign))
    return out


def _equal_terms(key: list[str], rules: list[_Ruled], left: DataFrame, right: DataFrame) -> DataFrame:
    """Changes by pairs of equal terms: one grouping by key and term, in which signatures of both sides are counted."""
    both = left.unionByName(right, allowMissingColumns=True)
    sums = [
        F.coalesce(F.sum(F.when(F.col(f"{side}_code") == code, F.col(n))), F.lit(0)).cast(ROWS).alias(f"{side}_{code}")
        for side, n in (("left", "ln"), ("right", "rn"))
        for code in range(max(x.signatures(side) for x in rules))
    ]

    def of(x: _Ruled) -> Column:
        pairs = product(range(x.signatures("left")), range(x.signatures("right")))
        parts = [(F.col(f"left_{a}") * F.col(f"right_{b}")).cast(PAIRS) * _change(x, a, b) for a, b in pairs]
        return reduce(lambda a, b: (a + b).cast(PAIRS), [p.cast(PAIRS) for p in parts])

    met = both.groupBy(*key, "term").agg(*sums)
    return met.groupBy(F.col("i").alias("ordinal")).agg(F.sum(_by_column(rules, of)).cast(PAIRS).alias("n"))


def _below(key: list[str], null_safe: bool, left: DataFrame, right: DataFrame, or_equal: bool) -> DataFrame:
    """Right groups with ``ln``, how many left rows of their key have a smaller (or equal) term.

    One row per right group and signature of the left side.  The running count is taken over ranges of (key, signature,
    term), each a bounded part of all rows, plus what lies in earlier ranges of the same key, so a key with very many
    terms spreads over many tasks.
    """
    asked = join_on(right, left.select(*key, "left_code").distinct(), key, null_safe, "inner")
    group = [*key, "left_code"]
    both = left.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    # Written once, so that the ranges stay the same for the two uses below.
    ranged = stored(both.repartitionByRange(*group, "term").withColumn("part", F.spark_partition_id()), "ranges")
    in_order = Window.partitionBy("part", *group).orderBy("term")
    counted = F.coalesce(F.sum("ln").over(in_order.rangeBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    here = F.coalesce(F.sum("ln").over(Window.partitionBy("part", *group, "term")), F.lit(0))
    inside = ranged.withColumn("inside", counted if or_equal else counted - here).where("asks")
    # One row per key and range it reaches into.
    sizes = ranged.groupBy(*group, "part").agg(F.coalesce(F.sum("ln"), F.lit(0)).alias("size"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    found = join_on(inside.drop("ln"), sizes, [*group, "part"], True, "inner")
    count = (F.col("before") + F.col("inside")).cast(ROWS)
    return found.select(*group, "right_code", "rn", count.alias("ln"))


def _paired(c, values: DataFrame, x: _Ruled) -> DataFrame:
    """``(ordinal, n)`` of a predicate that no signature tells apart: distinct values of a key, pair by pair."""
    rows = values.where(F.col("i") == x.i).select(*c.key_names, _typed(F.col("v"), x.dtype).alias("v"), LEFT_N, RIGHT_N)
    left = rows.where(F.col(LEFT_N) > 0).select(*c.key_names, F.col("v").alias("l"), F.col(LEFT_N).cast(ROWS).alias("ln"))
    right = rows.where(F.col(RIGHT_N) > 0).select(*c.key_names, F.col("v").alias("r"), F.col(RIGHT_N).cast(ROWS).alias("rn"))
    met = join_on(left, right, c.key_names, c.null_safe, "inner").where(~F.col("l").eqNullSafe(F.col("r")))
    open_ = met.where(~explained(x.predicate, "l", "r", c.null_explains))
    n = F.coalesce(F.sum((F.col("ln") * F.col("rn")).cast(PAIRS)), F.lit(0)).cast(PAIRS)
    return open_.agg(n.alias("n")).select(F.lit(x.i).alias("ordinal"), "n")
