"""Accepted-difference predicates: ``where`` texts over ``prod_value`` and ``uat_value``.

A text may only use the two values, literals, comparisons, boolean words and the functions listed
here, so it cannot reach anything else in the session.  Casts become their ``try_`` forms: one bad
cell must not fail the job.  The result is Spark SQL, which Spark parses; a text that does not pass
explains nothing.

A predicate is kept as a list of conditions joined by boolean words, each condition knowing which
side it looks at.  That lets duplicated keys be counted without forming their row pairs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from twinledger.functions.normalise import is_text

# The names a predicate may use for each side.
LEFT_NAMES = {"prod_value", "left_value", "redshift_value"}
RIGHT_NAMES = {"uat_value", "right_value", "snowflake_value"}
# Words, casts and functions a predicate may use.
WORDS = {"and", "or", "not", "is", "null", "between", "in", "like", "true", "false", "none"}
CASTS = {"date": "date", "int": "bigint", "string": "string"}
CALLS = {"date", "year", "num", "round", "abs", "length", "len", "startswith", "contains", "isblank", "coalesce"}

_TOKEN = re.compile(
    r"\s*(?:(?P<text>'(?:[^']|'')*'|\"[^\"']*\")|(?P<number>\d+(?:\.\d+)?)|(?P<word>[A-Za-z_]\w*)"
    r"|(?P<sign>::|==|<=|>=|<>|!=|[=<>+\-*/(),]))"
)
_NUMBER = re.compile(r"\d+(?:\.\d+)?")
_COMPARES = {"=", "==", "<", ">", "<=", ">=", "<>", "!="}
# Comparisons, and what they read like with both sides exchanged.
_MIRRORED = {"=": "=", "<>": "<>", "<": ">", "<=": ">=", ">": "<", ">=": "<="}
_L, _R = "\x01", "\x02"  # stand for the two values until their columns are known


class RejectedPredicate(ValueError):
    """The text uses something outside the allow-list."""


@dataclass(frozen=True)
class Piece:
    """SQL of one value, operator or condition, and the sides it looks at."""

    sql: str
    sides: frozenset = frozenset()
    joins: bool = False  # a boolean word or a bracket around conditions
    gap: tuple[Piece, Piece] | None = None  # of ``abs(left term - right term)`` the two terms

    def on(self, left: str, right: str) -> str:
        return self.sql.replace(_L, left).replace(_R, right)


@dataclass(frozen=True)
class Condition(Piece):
    """A condition between boolean words.

    ``compares`` is set for ``left term <operator> right term``: the operator, seen from the left, and both terms.
    ``within`` is set for ``abs(left term - right term) <operator> number``, as (operator, left term, right term, number).
    """

    compares: tuple[str, Piece, Piece] | None = None
    within: tuple[str, Piece, Piece, str] | None = None


@dataclass(frozen=True)
class Predicate:
    parts: tuple[Piece, ...]

    def sql(self, left: str, right: str) -> str:
        return " ".join(p.on(left, right) for p in self.parts)

    @property
    def conditions(self) -> list[Condition]:
        return [p for p in self.parts if isinstance(p, Condition)]


def _tokens(text: str) -> list[tuple[str, str]]:
    if _L in text or _R in text:
        raise RejectedPredicate("control characters")
    out, at = [], 0
    while text[at:].strip():
        m = _TOKEN.match(text, at)
        if not m:
            raise RejectedPredicate(f"unexpected text at {text[at:at + 20].strip()!r}")
        out.append((m.lastgroup, m.group(m.lastgroup)))
        at = m.end()
    return out


def _call(name: str, inner: list[Piece], text_values: bool, half_even: bool) -> Piece:
    args = " ".join(p.sql for p in inner)
    sides = frozenset().union(*[p.sides for p in inner])
    value, _, digits = args.partition(" , ")
    if text_values:
        value = f"try_cast({value} as decimal(38,10))"
    sql = {
        "date": f"try_to_date({args})",
        "year": f"year(try_to_date({args}))",
        "num": f"try_cast({args} as double)",
        "isblank": f"({args} is null or {args} = '')",
        "round": f"{'bround' if half_even else 'round'}({value}, {digits or 0})",
        "len": f"length({args})",
        "": f"({args})",
    }.get(name, f"{name}({args})")
    gap = None
    if name == "abs" and len(inner) == 3 and inner[1].sql == "-" and not text_values:
        ends = {p.sides: p for p in (inner[0], inner[2])}
        if ends.keys() == {frozenset({"left"}), frozenset({"right"})}:
            gap = ends[frozenset({"left"})], ends[frozenset({"right"})]
    return Piece(sql, sides, gap=gap)


ARITHMETIC = ("+", "-", "*", "/", "%")


def _in_arithmetic(tokens: list[tuple[str, str]], i: int, open_calls: list[str]) -> bool:
    """Is the name at ``i`` used as a number: next to an operator, in ``abs``, or before numbers in a range or list?"""

    def at(j: int) -> tuple[str, str]:
        return (tokens[j][0], tokens[j][1].lower()) if 0 <= j < len(tokens) else ("", "")

    if at(i - 1)[1] in ARITHMETIC or at(i + 1)[1] in ARITHMETIC or "abs" in open_calls:
        return True
    j = i + 2 if at(i + 1)[1] == "not" else i + 1
    if at(j)[1] == "between":
        return at(j + 1)[0] == "number" or at(j + 1)[1] == "-"
    return at(j)[1] == "in" and (at(j + 2)[0] == "number" or at(j + 2)[1] == "-")


def read(text: str, text_values: bool = False, half_even: bool = False) -> Predicate:
    """Check a text against the allow-list and turn it into conditions.

    ``text_values`` says that both values are strings, so numbers in them are read with ``try_cast``;
    ``half_even`` makes ``round`` round half to even, as the CSV ladder does.
    """
    tokens = _tokens(text)
    open_calls: list[str] = []
    levels: list[list[Piece]] = [[]]
    in_between = [False]
    for i, (kind, tok) in enumerate(tokens):
        low = tok.lower()
        before = tokens[i - 1][1].lower() if i else ""
        after = tokens[i + 1][1] if i + 1 < len(tokens) else ""
        here = levels[-1]
        if before == "::":
            if low not in CASTS or not here:
                raise RejectedPredicate(f"cast to {tok!r}")
            here[-1] = Piece(f"try_cast({here[-1].sql} as {CASTS[low]})", here[-1].sides)
        elif kind == "text":
            body = tok[1:-1].replace("\\", "\\\\") if tok[0] == "'" else tok[1:-1].replace("\\", "\\\\")
            here.append(Piece(f"'{body}'"))
        elif kind == "number":
            here.append(Piece(tok))
        elif kind == "word" and after == "(" and low not in WORDS:
            if low not in CALLS:
                raise RejectedPredicate(f"function {tok!r}")
        elif kind == "word" and low in LEFT_NAMES | RIGHT_NAMES:
            mark, side = (_L, "left") if low in LEFT_NAMES else (_R, "right")
            beside = {
                tokens[i + 2 * d][0] for d in (-1, 1)
                if 0 <= i + 2 * d < len(tokens) and tokens[i + d][1] in _COMPARES
            }
            numeric = "number" in beside or _in_arithmetic(tokens, i, open_calls)
            sql = f"try_cast({mark} as double)" if text_values and numeric else mark
            here.append(Piece(sql, frozenset({side})))
        elif kind == "word":
            if low not in WORDS:
                raise RejectedPredicate(f"name {tok!r}")
            in_condition = (low == "and" and in_between[-1]) or (
                low == "not" and bool(here) and not here[-1].joins
            )
            if low == "between":
                in_between[-1] = True
            elif low == "and":
                in_between[-1] = False
            joins = low in ("and", "or", "not") and not in_condition
            here.append(Piece("null" if low == "none" else low, joins=joins))
        elif tok == "(":
            open_calls.append(before if i and tokens[i - 1][0] == "word" and before in CALLS else "")
            levels.append([])
            in_between.append(False)
        elif tok == ")":
            if not open_calls:
                raise RejectedPredicate("unbalanced brackets")
            inner, call = levels.pop(), open_calls.pop()
            in_between.pop()
            if not call and any(p.joins for p in inner):
                levels[-1] += [Piece("(", joins=True), *inner, Piece(")", joins=True)]
            else:
                levels[-1].append(_call(call, inner, text_values, half_even))
        elif tok != "::":
            here.append(Piece({"==": "=", "!=": "<>"}.get(tok, tok)))
    if open_calls:
        raise RejectedPredicate("unbalanced brackets")
    return Predicate(tuple(_conditions(levels[0])))


def _within(run: list[Piece]) -> tuple[str, Piece, Piece, str] | None:
    """A distance between both sides compared with a number, whichever stands first."""
    if len(run) != 3 or run[1].sql not in ("<", "<=", ">", ">="):
        return None
    gap, sign, number = (run[0], run[1].sql, run[2]) if run[0].gap else (run[2], _MIRRORED[run[1].sql], run[0])
    return (sign, *gap.gap, number.sql) if gap.gap and _NUMBER.fullmatch(number.sql) else None


def _conditions(pieces: list[Piece]) -> list[Piece]:
    out: list[Piece] = []
    run: list[Piece] = []

    def close() -> None:
        if run:
            sides = frozenset().union(*[p.sides for p in run])
            terms = None
            if len(run) == 3 and run[1].sql in _MIRRORED and {run[0].sides, run[2].sides} == {
                frozenset({"left"}), frozenset({"right"})
            }:
                first, sign, second = run[0], run[1].sql, run[2]
                terms = (sign, first, second) if "left" in first.sides else (_MIRRORED[sign], second, first)
            out.append(Condition(" ".join(p.sql for p in run), sides, compares=terms, within=_within(run)))
            run.clear()

    for p in pieces:
        if p.joins:
            close()
            out.append(p)
        else:
            run.append(p)
    close()
    return out


def usable(text: str, dtype: T.DataType, df: DataFrame, left: str, right: str, half_even: bool = False):
    """``(predicate, None)``, or ``(None, note)`` for a text that cannot be used on these two columns."""
    try:
        predicate = read(text, is_text(dtype), half_even)
        result = df.select(F.expr(predicate.sql(f"`{left}`", f"`{right}`"))).schema[0].dataType
        if not isinstance(result, T.BooleanType):
            raise RejectedPredicate("not a condition")
    except Exception as e:  # Spark's parse and analysis errors as well
        return None, f"predicate {text!r} not usable: {str(e).splitlines()[0][:120]}"
    return predicate, None


def explained(predicate: Predicate | None, left: str, right: str, null_explains: bool) -> Column:
    """Condition "this difference is explained" over two columns.

    ``null_explains`` is the ladder's reading of a predicate that is NULL for a pair: the table
    ladders count it as explained, the CSV ladder as unexplained.
    """
    if predicate is None:
        return F.lit(False)
    return F.coalesce(F.expr(predicate.sql(f"`{left}`", f"`{right}`")), F.lit(null_explains))
