"""When do two rendered values count as the same?

Tables: text is optionally trimmed and blank text becomes NULL, every other type is compared raw.
CSV cells: all text, so a list of switchable rules folds the renderings of one value together.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The words a text flag may be spelled with.
TRUE_WORDS = ("true", "t", "yes", "y")
FALSE_WORDS = ("false", "f", "no", "n")
# Cells that stand for "no value".
NULL_TOKENS = ("", "null", "\\n")

# Which cells count as plain numbers and as UTC timestamps; results differ wherever this grammar does.
NUMBER = r"^-?\d+(\.\d+)?$"
WHOLE_UTC_TIMESTAMP = r"^(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2})(\.0+)?(\+00:?00|Z)?$"
# Fixed value: characters that count as white space around a cell; SQL trim removes spaces only.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + (
    "\u2028\u2029\u202f\u205f\u3000"
)

# Digits a quantised number may have before it is left as it was.
MAX_DIGITS = 28


def quoted(name: str) -> Column:
    """Column by exact name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def table_value(col: Column, dtype: T.DataType, nullif_text: bool = True, trim_text: bool = False) -> Column:
    """Comparison form of one table value."""
    if not is_text(dtype):
        return col
    if trim_text:
        col = F.trim(col)
    return F.nullif(col, F.lit("")) if nullif_text else col


def projection_columns(
    df: DataFrame,
    *,
    drop: Iterable[str] = (),
    nullif_text: bool = True,
    trim_text: bool = False,
    override: Iterable[str] | None = None,
) -> list[Column]:
    """Normalised row-level projection; ``override`` replaces it by caller-supplied SQL expressions."""
    if override:
        return [F.expr(e) for e in override]
    dropped = set(drop)
    return [
        table_value(quoted(f.name), f.dataType, nullif_text, trim_text).alias(f.name)
        for f in df.schema.fields
        if f.name not in dropped
    ]


def projection(df: DataFrame, **options) -> DataFrame:
    return df.select(*projection_columns(df, **options))


def groupable(df: DataFrame) -> DataFrame:
    """Maps, arrays and structs as JSON text, so that rows can be grouped and compared."""
    nested = (T.MapType, T.ArrayType, T.StructType, T.VariantType)
    return df.select(
        *[
            F.to_json(quoted(f.name)).alias(f.name) if isinstance(f.dataType, nested) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


@dataclass(frozen=True)
class CellRules:
    """Switches of the CSV cell rules."""

    trim_text: bool = True
    blank_as_null: bool = True
    null_tokens: tuple[str, ...] = NULL_TOKENS
    numeric_scale: int | None = None
    normalise_booleans: bool = True
    normalise_timestamps: bool = True
    case_insensitive: bool = False
    boolean_columns: tuple[str, ...] = ()

    @classmethod
    def from_options(cls, options: Mapping | None) -> "CellRules":
        known = {f.name for f in fields(cls)}
        picked = {k: v for k, v in (options or {}).items() if k in known}
        for name in ("null_tokens", "boolean_columns"):
            if name in picked:
                picked[name] = tuple(str(v) for v in (picked[name] or ()))
        return cls(**picked)


def _quantised(text: Column, scale: int) -> Column:
    """Fixed-scale text, half to even; numbers too long to quantise stay as they are."""
    # Digits past the first one after the scale only matter as "zero or not": keep one as a marker,
    # so that any number of decimals rounds exactly.
    keep = scale + 1
    # "$11" is group 1 followed by the digit 1, as the pattern has only one group.
    short = F.regexp_replace(text, rf"^(-?\d+\.\d{{{keep}}})\d*[1-9]\d*$", "$11")
    short = F.regexp_replace(short, rf"^(-?\d+\.\d{{{keep}}})0+$", "$1")
    number = short.try_cast(T.DecimalType(38, scale + 2))
    rounded = F.bround(number, scale).cast(T.DecimalType(38, scale)).cast("string")
    signed = F.when(
        text.startswith("-") & ~rounded.startswith("-"), F.concat(F.lit("-"), rounded)
    ).otherwise(rounded)
    digits = F.length(F.regexp_replace(rounded, r"^-?0*\.?0*|\.|-", ""))
    return F.when(rounded.isNull() | (digits > MAX_DIGITS), text).otherwise(signed)


def _without_utc(s: Column) -> Column:
    """Timestamps without a zero fraction and UTC suffix; shorter text cannot be one."""
    return F.when(F.length(s) >= 19, F.regexp_replace(s, WHOLE_UTC_TIMESTAMP, "$1")).otherwise(s)


def _compared(s: Column, v: Column, column: str, rules: CellRules) -> Column:
    """The rules after trimming (``s``) and timestamps (``v``), in their fixed order."""
    token = F.lower(s).isin([t.lower() for t in rules.null_tokens]) if rules.null_tokens else F.lit(False)
    plain = F.when(v.contains(".") & v.rlike(NUMBER), F.regexp_replace(v, r"\.?0+$", "")).otherwise(v)
    if rules.case_insensitive:
        plain = F.lower(plain)
    if rules.numeric_scale is not None:
        plain = F.when(v.rlike(NUMBER), _quantised(v, int(rules.numeric_scale))).otherwise(plain)
    if rules.normalise_booleans:
        flagged = column.lower() in {c.lower() for c in rules.boolean_columns}
        yes, no = (TRUE_WORDS + ("1",), FALSE_WORDS + ("0",)) if flagged else (TRUE_WORDS, FALSE_WORDS)
        word = F.lower(v)
        plain = F.when(word.isin(*yes), F.lit("true")).when(word.isin(*no), F.lit("false")).otherwise(plain)
    if rules.blank_as_null:
        return F.when(~token, plain)
    return F.when(token, s).otherwise(plain)


def cell_projection(
    df: DataFrame, rules: CellRules = CellRules(), columns: Iterable[str] | None = None, carry: Iterable[str] = ()
) -> DataFrame:
    """Cells of an extract in comparison form, next to the columns in ``carry`` as they are.

    Trimming and timestamps are steps of their own, so their results are computed once per cell although
    the later rules look at them several times.
    """
    names = list(columns if columns is not None else df.columns)
    kept = [quoted(c) for c in carry]
    at = range(len(names))
    trimmed = df.select(
        *[(F.btrim(quoted(c), F.lit(BLANKS)) if rules.trim_text else quoted(c)).alias(f"s{i}") for i, c in enumerate(names)],
        *kept,
    )
    if rules.normalise_timestamps:
        trimmed = trimmed.select("*", *[_without_utc(F.col(f"s{i}")).alias(f"v{i}") for i in at])
    values = [F.col(f"v{i}" if rules.normalise_timestamps else f"s{i}") for i in at]
    return trimmed.select(
        *[_compared(F.col(f"s{i}"), values[i], c, rules).alias(c) for i, c in enumerate(names)], *kept
    )
