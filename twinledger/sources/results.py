"""Results: writing runs and samples, reading back the history of runs.

A run is a folder ``results_YYYYMMDD_HHMM``.  Runs written here are Parquet/JSON rows; ``history`` also reads
the one-document ``results.json`` payloads of earlier runs: an object with ``csv`` and ``dwi`` lists, or a
bare list from the model ladder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

RUN_NAME = r"results_[0-9]{8}_[0-9]{4}"

# What history needs of a result; fields it does not name are ignored.
_RESULT = "struct<view: string, `table`: string, client: string, mode: string, verdict: string, notes: array<string>>"
_PAYLOAD = f"struct<dry_run: boolean, csv: array<{_RESULT}>, dwi: array<{_RESULT}>>"


def write_results(tiers: DataFrame, folder: str) -> None:
    """Tier rows of a run as JSON lines."""
    tiers.write.mode("errorifexists").json(f"{folder.rstrip('/')}/tiers")


def read_results(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(f"{folder.rstrip('/')}/tiers")


def write_samples(samples: DataFrame, folder: str) -> None:
    """Samples as CSV, one folder per view, tier and column."""
    by = ["view", "tier", "column"]
    # A folder holds at most the sample limit, so one file each; columns spread over the tasks.
    samples.repartition(*by).write.mode("errorifexists").partitionBy(*by).option("header", True).csv(
        f"{folder.rstrip('/')}/samples"
    )


def report_lines(tiers: DataFrame, columns: DataFrame, views: DataFrame, names: list[str]) -> DataFrame:
    """Lines of a Markdown report ``(section, position, line, value)``: matrix, views without grain, details.

    ``views`` has one row per view with ``position``, ``verdict``, ``no_grain`` and ``notes``; all lines follow the
    configured order of views.
    """
    by = ["mode", "tenant", "view"]
    at = views.select(*by, "position")
    label = F.concat(F.col("view"), F.when(F.length("tenant") > 0, F.concat(F.lit(" ("), "tenant", F.lit(")"))).otherwise(F.lit("")))

    def lines(df: DataFrame, section: int, line: int, value) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"), "position", F.lit(line).alias("line"), value.alias("value")
        ).where(F.col("value").isNotNull())

    wide = tiers.groupBy(*by).pivot("tier", names).agg(F.first("status"))
    matrix = views.join(wide, by, "left")
    cells = [label, *[F.coalesce(n, F.lit("-")) for n in names], F.col("verdict"), F.array_join("notes", "; ")]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    without = views.where(F.coalesce("no_grain", F.lit(False)))
    each = tiers.join(at, by)

    def number(c: str):
        return F.format_number(F.col(c).cast("decimal(38,0)"), 0)

    counted = each.where(F.col("left_rows").isNotNull())
    rows = F.concat(
        F.lit("- "), "tier", F.lit(" row counts: "), number("left_rows"), F.lit(" vs "), number("right_rows"),
        F.lit(" (diff "), F.format_string("%+,d", F.col("left_rows") - F.col("right_rows")), F.lit(")"),
    )
    keyed = each.where(F.col("left_only").isNotNull())
    keys = F.concat(
        F.lit("- "), "tier", F.lit(" one-sided: "), number("left_only"), F.lit(" left, "), number("right_only"), F.lit(" right")
    )
    mark = F.when(F.col("residual").isNotNull(), F.concat(F.lit(" (residual "), number("residual"), F.lit(")"))).otherwise(F.lit(""))
    why = F.when(F.col("reason").isNotNull(), F.concat(F.lit(": "), "reason")).otherwise(F.lit(""))
    column = F.concat(
        F.lit("- "), "tier", F.lit(" `"), "column", F.lit("`="), number("mismatches"), mark, F.lit(" ["), "status", F.lit("]"), why
    )
    noted = views.select("position", F.explode("notes").alias("note"))
    return reduce(
        DataFrame.unionByName,
        [
            lines(matrix, 1, 0, row),
            lines(without, 2, 0, F.concat(F.lit("- no grain: "), label)),
            lines(views, 3, 0, F.concat(F.lit("### "), label, F.lit(" - "), "verdict")),
            lines(counted, 3, 1, rows),
            lines(keyed, 3, 2, keys),
            lines(columns.join(at, by), 3, 3, column),
            lines(noted, 3, 4, F.concat(F.lit("- ! "), "note")),
        ],
    )


def write_report(
    tiers: DataFrame, columns: DataFrame, views: DataFrame, folder: str, title: str, names: list[str]
) -> None:
    """The report as text below ``folder``; ``names`` are the tiers shown."""
    head = ["View", *names, "Verdict", "Notes"]
    top = [
        (0, 0, 0, f"# {title}"), (0, 0, 1, "| " + " | ".join(head) + " |"), (0, 0, 2, "|" + "---|" * len(head)),
        (2, -1, 0, "## Grain coverage"), (3, -1, 0, "## Details"),
    ]
    fixed = views.sparkSession.createDataFrame(top, "section int, position int, line int, value string")
    ordered = fixed.unionByName(report_lines(tiers, columns, views, names)).orderBy("section", "position", "line", "value")
    ordered.select("value").write.mode("errorifexists").text(f"{folder.rstrip('/')}/summary")


def history(spark: SparkSession, base: str) -> DataFrame:
    """Results of all runs below ``base``: ``(run, mode, client, view, id, verdict, dry_run)``.

    Folders with another name, files that are no JSON and runs without results are left out.
    """
    text = spark.read.text(base, wholetext=True, pathGlobFilter="results.json", recursiveFileLookup=True)
    files = text.select("value", F.col("_metadata.file_path").alias("path"))
    return history_rows(files)


def history_rows(files: DataFrame) -> DataFrame:
    """The same from ``(path, value)`` rows, one document each."""
    run = F.regexp_extract("path", rf"/({RUN_NAME})/results\.json$", 1)
    docs = files.select(run.alias("run"), F.trim("value").alias("value")).where(F.length("run") > 0)
    docs = docs.where(F.try_parse_json("value").isNotNull())
    is_list = F.col("value").startswith("[")
    listed = docs.where(is_list).select(
        "run",
        F.lit(False).alias("dry_run"),
        F.lit("bi").alias("listed_as"),
        F.explode(F.from_json("value", f"array<{_RESULT}>")).alias("r"),
    )
    parsed = docs.where(~is_list).withColumn("p", F.from_json("value", _PAYLOAD))

    def part(name: str) -> DataFrame:
        return parsed.select(
            "run",
            F.coalesce("p.dry_run", F.lit(False)).alias("dry_run"),
            F.lit(name).alias("listed_as"),
            F.explode(f"p.{name}").alias("r"),
        )

    rows = listed.unionByName(part("csv")).unionByName(part("dwi"))
    view, mode = F.coalesce("r.view", "r.table"), F.coalesce("r.mode", "listed_as")
    client = F.when(F.length("r.client") > 0, F.concat("r.client", F.lit("/"))).otherwise(F.lit(""))
    return rows.select(
        "run",
        mode.alias("mode"),
        F.col("r.client").alias("client"),
        view.alias("view"),
        F.concat(mode, F.lit(":"), client, view).alias("id"),
        F.col("r.verdict").alias("verdict"),
        "dry_run",
    )
