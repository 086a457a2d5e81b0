"""CSV extracts: all cells are text, rows may be ragged, one view may come in several part files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from twinledger.functions.normalise import quoted

RAGGED = "__ragged"
FILE, BLOCK, LINE = "__file", "__block", "__line"
# Row order of an extract: file, then block within it, then position; ids grow within a block.
ORDER = (FILE, BLOCK, LINE)


@dataclass(frozen=True)
class Extract:
    """A view's rows with the normalised header; ``df`` also has ``__ragged`` and the order columns."""

    header: tuple[str, ...]
    df: DataFrame

    @property
    def columns(self) -> list[str]:
        """Header names once each; of equal names the last column counts."""
        return list(dict.fromkeys(self.header))


def clean_header(cells: Sequence[str | None]) -> tuple[str, ...]:
    return tuple((c or "").strip().lstrip("﻿").lower() for c in cells)


def _options(delimiter: str) -> dict:
    return {
        "sep": delimiter,
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "__raw",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


#: Encodings in which a line end is the byte of a line end, so that files can be read in splits.
SPLITTABLE = ("utf-8", "us-ascii", "iso-8859-1")
#: Charsets that ``decode`` knows without the setting for those of the JVM.
KNOWN = (*SPLITTABLE, "utf-16be", "utf-16le", "utf-16", "utf-32")


def _decoded(spark: SparkSession, value: Column, source: DataFrame, encoding: str) -> DataFrame:
    """``source`` with its bytes read in the encoding; the JVM's other charsets are allowed for this expression only."""
    setting = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(setting, None)
    if encoding not in KNOWN:
        spark.conf.set(setting, "true")
    try:
        return source.withColumn("value", F.decode(value.cast("binary"), encoding))
    finally:
        if encoding not in KNOWN:
            spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def read_lines(spark: SparkSession, paths: Sequence[str], encoding: str) -> DataFrame:
    """Every physical line (``value``) of the files once, with its place; CR, LF and CRLF end a line."""
    name = encoding.lower().replace("_", "-")
    place = [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)]
    if name in SPLITTABLE:
        lines = spark.read.text(list(paths)).select("value", *place)
        if name != "utf-8":
            lines = _decoded(spark, F.col("value"), lines, name)
    else:
        whole = _decoded(spark, F.col("value"), spark.read.text(list(paths), wholetext=True).select("value", *place), name)
        # What ends the last line begins no other.
        pieces = F.split(F.regexp_replace("value", "(?:\r\n|\r|\n)$", ""), "\r\n|\r|\n")
        lines = whole.where(F.length("value") > 0).select(F.explode(pieces).alias("value"), FILE, BLOCK)
    return lines.withColumn(LINE, F.monotonically_increasing_id())


def _rest_after_fields(text: Column, delimiter: str) -> Column:
    """What is left of a text without doubled quotes once all complete cells are taken off: nothing, or an open cell."""
    stop = re.escape(delimiter)
    cell = rf"(?:(?!{stop}).)*+" if len(delimiter) > 1 else rf"[^{stop}]*+"
    return F.regexp_replace(text, rf'(?s)\G(?:"[^"]*+"{cell}|(?!"){cell})(?:{stop}|\z)', "")


def _ends_open(value: Column, delimiter: str) -> tuple[Column, Column]:
    """Whether a quote is open behind a line: if none was before it, and if one was.

    A doubled quote changes nothing wherever it stands, and a quote counts only where a cell begins or to end a quoted
    one.  Most lines hold no quote and leave things as they are.
    """
    single = F.replace(value, F.lit('""'), F.lit(""))
    stop = re.escape(delimiter)
    cell = rf"(?:(?!{stop}).)*+" if len(delimiter) > 1 else rf"[^{stop}]*+"
    closed = F.regexp_replace(single, rf'(?s)^[^"]*+"{cell}(?:{stop}|\z)', "")
    has = value.contains('"')
    outside = F.when(has, _rest_after_fields(single, delimiter) != "").otherwise(False)
    inside = F.when(has & single.contains('"'), _rest_after_fields(closed, delimiter) != "").otherwise(True)
    return outside, inside


def _whole_records(lines: DataFrame, delimiter: str) -> DataFrame:
    """Lines put together where cells hold line breaks: ``value`` of a record has its lines, joined by LF.

    What a line does to an open quote is known without what comes before it, so that every split is looked at on its
    own.  A split's lines come down to one change, and changes of the splits before it tell whether it starts inside a
    cell.  Only the lines of records that span several are grouped.  A quote that is never closed makes one record of
    the rest of its file.
    """
    outside, inside = _ends_open(F.col("value"), delimiter)
    by_line = Window.partitionBy(FILE, BLOCK).orderBy(LINE)
    so_far = by_line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips, fixes = (F.col("__out") & ~F.col("__in")).cast("int"), F.col("__out") == F.col("__in")
    seen = lines.withColumn("__out", outside).withColumn("__in", inside).withColumn("__flips", F.sum(flips).over(so_far))
    fixed = F.when(fixes, F.struct(LINE, F.col("__out").cast("int").alias("to"), F.col("__flips").alias("flips")))
    seen = seen.withColumn("__fixed", F.max(fixed).over(so_far)).drop("__out", "__in")

    def after(start: Column) -> Column:
        since = F.when(F.col("__fixed").isNull(), start + F.col("__flips")).otherwise(
            F.col("__fixed.to") + F.col("__flips") - F.col("__fixed.flips")
        )
        return since % 2

    # One row per split: whether it fixes the outcome, and the outcome if none is open at its start.
    splits = seen.groupBy(FILE, BLOCK).agg(F.max(F.struct(LINE, F.col("__fixed").isNotNull().alias("fixes"), after(F.lit(0)).alias("to"))).alias("last"))
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when(~F.col("last.fixes"), F.col("last.to")).otherwise(0)
    splits = splits.withColumn("turns", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    known = F.when(F.col("last.fixes"), F.struct(F.col("last.to").alias("to"), F.col("turns").alias("turns")))
    splits = splits.withColumn("known", F.last(known, ignorenulls=True).over(before))
    start = (F.coalesce(F.col("known.to") - F.col("known.turns"), F.lit(0)) + F.col("turns")) % 2
    opened = seen.join(splits.select(FILE, BLOCK, start.alias("__start")), [FILE, BLOCK])
    opened = opened.withColumn("__after", after(F.col("__start"))).drop("__flips", "__fixed")
    opened = opened.withColumn("__before", F.coalesce(F.lag("__after").over(by_line), F.col("__start")))
    begins = F.when(F.col("__before") == 0, F.struct(BLOCK, LINE))
    opened = opened.withColumn("__record", F.last(begins, ignorenulls=True).over(so_far)).drop("__start")
    # A record that began in an earlier split.
    last = opened.groupBy(FILE, BLOCK).agg(F.max("__record").alias("__last")).withColumn("__earlier", F.last("__last", ignorenulls=True).over(before))
    opened = opened.join(last.select(FILE, BLOCK, "__earlier"), [FILE, BLOCK])
    alone = (F.col("__before") == 0) & (F.col("__after") == 0)
    single = opened.where(alone).select("value", FILE, BLOCK, LINE)
    spread = opened.where(~alone).withColumn("__record", F.coalesce("__record", "__earlier"))
    parts = F.array_sort(F.collect_list(F.struct(BLOCK, LINE, "value")))
    joined = spread.groupBy(FILE, "__record").agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("value"))
    return single.unionByName(joined.select("value", FILE, F.col(f"__record.{BLOCK}").alias(BLOCK), F.col(f"__record.{LINE}").alias(LINE)))


def read_extract(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    delimiter: str = ",",
    encoding: str = "utf-8",
    multi_line: bool | None = None,
) -> Extract:
    """Read all part files of a view: every line, or every record of several lines, is a row.

    Every part may have its own header: columns are matched by name, a column that only some parts have is
    NULL elsewhere, and a first line that shares no name with the first part's header is data.  Short rows are
    padded with NULL, long ones cut to the header, and both are marked; a line without a character is a row without
    cells, any other line has cells, be they blank.  An empty cell within a row is blank text, a missing one is NULL.
    Line breaks in cells are read as LF.  With ``multi_line`` left open, the pass that finds the first lines also tells
    whether cells hold line breaks; then lines are put together.  Files are read in splits either way, unless the
    encoding has line ends of several bytes.
    """
    paths = [paths] if isinstance(paths, str) else sorted(paths)
    lines = read_lines(spark, paths, encoding)
    open_ = F.lit(bool(multi_line)) if multi_line is not None else _ends_open(F.col("value"), delimiter)[0]
    # One row per part file.
    start = F.min(F.when(F.col(BLOCK) == 0, F.col(LINE)))
    firsts = lines.groupBy(FILE).agg(start.alias(LINE), F.max(open_).alias("open")).orderBy(FILE).collect()
    if any(r["open"] for r in firsts):
        lines = _whole_records(lines, delimiter)
    tops = _first_records(lines, [r[LINE] for r in firsts], delimiter)
    header: tuple[str, ...] = ()
    groups: dict[tuple[str, ...] | None, list[str]] = {}  # header (none where the first line is data) and its files
    skipped = []
    for file, line in [(r[FILE], r[LINE]) for r in firsts]:
        own = clean_header(tops[line])
        header = header or own
        known = bool(set(own) & set(header))
        header += tuple(n for n in own if known and n not in header)
        groups.setdefault(own if known else None, []).append(file)
        if known:
            skipped.append(line)
    if not header:
        empty = T.StructType(
            [T.StructField(RAGGED, T.BooleanType()), T.StructField(FILE, T.StringType())]
            + [T.StructField(c, T.LongType()) for c in (BLOCK, LINE)]
        )
        return Extract((), spark.createDataFrame([], empty))
    names = tuple(dict.fromkeys(header))
    first = next(iter(groups))  # its header is the one that parts without a header follow
    rows = lines.where(~F.col(LINE).isin(skipped))
    kinds = [(own or first, files) for own, files in groups.items()]
    number = [(file, i) for i, (_, files) in enumerate(kinds) for file in files]  # one row per part file
    if len(kinds) > 1:
        rows = rows.join(F.broadcast(spark.createDataFrame(number, f"{FILE} string, __kind int")), FILE)
    for i, (own, _) in enumerate(kinds):
        record = F.from_csv("value", _schema(len(own)), _options(delimiter))
        rows = rows.withColumn(f"__cells{i}", record if len(kinds) == 1 else F.when(F.col("__kind") == i, record))
    ragged = F.coalesce(*[F.col(f"__cells{i}.__raw") for i in range(len(kinds))]).isNotNull() | (F.col("value") == "")
    cells = [_cell(name, [own for own, _ in kinds], delimiter).alias(name) for name in names]
    return Extract(header, rows.select(*cells, ragged.alias(RAGGED), FILE, BLOCK, LINE))


def _schema(width: int) -> str:
    return ", ".join([*[f"c{i} string" for i in range(width)], "__raw string"])


def _cell(name: str, headers: list[tuple[str, ...]], delimiter: str) -> Column:
    """A record's cell under the header of its part: ``__cells0`` and so on are NULL for records of other headers."""

    def under(n: int, header: tuple[str, ...]) -> Column | None:
        if name not in header:
            return None
        i = max(at for at, other in enumerate(header) if other == name)
        text, raw = F.col(f"__cells{n}.c{i}"), F.col(f"__cells{n}.__raw")
        there = F.col(f"__cells{n}").isNotNull() & (F.col("value") != "")
        blank = text.isNull() & there & (F.coalesce(_width(raw, delimiter), F.lit(i + 1)) > i)
        return F.when(blank, F.lit("")).otherwise(text)

    found = [c for n, header in enumerate(headers) if (c := under(n, header)) is not None]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def _first_records(lines: DataFrame, ids: list[int], delimiter: str) -> dict[int, list[str | None]]:
    """Cells of the first record of every part file, by the number of its first line; a blank line has none."""
    found = {r[LINE]: r for r in lines.where(F.col(LINE).isin(ids)).select(LINE, "value", _width(F.col("value"), delimiter).alias("n")).collect()}
    most = max((r["n"] for r in found.values()), default=0)
    if not most:
        return {}
    spark = lines.sparkSession
    texts = spark.createDataFrame([(k, r["value"]) for k, r in found.items()], f"{LINE} long, value string")
    read = texts.select(LINE, F.from_csv("value", _schema(most), _options(delimiter)).alias("c")).collect()
    return {r[LINE]: list(r["c"])[: found[r[LINE]]["n"]] if found[r[LINE]]["value"] else [] for r in read}


def _width(raw: Column, delimiter: str) -> Column:
    """Number of cells of a ragged row: delimiters outside quotes, plus one; NULL for regular rows."""
    # Without doubled quotes a quoted cell is one run of other characters, which no stack has to hold.
    outside = F.regexp_replace(F.replace(raw, F.lit('""'), F.lit("")), r'"[^"]*+"', "")
    without = F.replace(outside, F.lit(delimiter), F.lit(""))
    return ((F.length(outside) - F.length(without)) / F.lit(len(delimiter))).cast("int") + 1


def header_rows(spark: SparkSession, view: str, header: Sequence[str]) -> DataFrame:
    """``(view, ordinal, column_name)`` rows of one header."""
    return spark.createDataFrame(
        [(view, i, name) for i, name in enumerate(header, start=1)], "view string, ordinal int, column_name string"
    )


def extract_counts(df: DataFrame) -> DataFrame:
    """One row: ``rows`` of an extract and how many of them were padded or cut, as ``ragged``."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(RAGGED).alias("ragged"))


def cells(extract: Extract) -> DataFrame:
    return extract.df.select(*[quoted(c) for c in extract.columns])
