"""Extract runs: ``{base}/{tenant}/{14-digit run}/{view}.csv...`` folders on each side.

Everything works on a frame of paths, so listings of any size are parsed, classified, paired and compared
by grouping; only ``list_paths`` and ``newest_paths`` touch the file system.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PLAIN, ENCRYPTED, MARKER, OTHER = "plain", "encrypted", "marker", "other"
# Fixed value: file that marks a finished run.
MARKER_NAME = "marker.json"


def list_paths(spark: SparkSession, base: str, tenants: Sequence[str] | None = None) -> DataFrame:
    """Every file path below ``base``; contents are not read.

    With ``tenants`` only their folders (and those of like names), there and below ``processed``, are listed; none of
    them there, no paths.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if tenants is None:
        return files.load(base).select("path")
    # A character with a meaning in patterns is matched by any character: a folder too many does no harm.
    names = [re.sub(r"[\\{}\[\]*?,^]", "?", t) for t in tenants]
    folders = ",".join(names + [f"processed/{n}" for n in names])
    try:
        return files.load(f"{base.rstrip('/')}/{{{folders}}}").select("path")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")


def _children(spark: SparkSession, folder: str) -> list[tuple[str, str, bool]]:
    """(name, path, is it a folder) of what lies directly in a folder; nothing if it is not there."""
    files = spark._jvm.org.apache.hadoop.fs
    path = files.Path(folder)
    try:
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() == "java.io.FileNotFoundException":
            return []
        raise
    named = [(f.getPath().getName(), f.getPath().toString(), bool(f.isDirectory())) for f in found]
    return [f for f in named if not f[0].startswith((".", "_"))]  # as Spark's readers pass over them


def _files_below(spark: SparkSession, folder: str) -> list[str]:
    out, todo = [], [folder]
    while todo:
        for _, path, is_folder in _children(spark, todo.pop()):
            (todo if is_folder else out).append(path)
    return out


def newest_paths(
    spark: SparkSession, base: str, tenants: Sequence[str], pinned: str | None = None, processed: bool = False
) -> DataFrame:
    """Paths of the newest runs of each tenant, down to the first that can be used; older ones are not listed.

    Of a tenant's folder only the names are read; a run's files are listed when it is tried, newest first.  A run is
    used if it has plain files or, with ``processed``, encrypted ones whose originals lie below ``processed``.  What is
    returned leads ``latest_run`` to the same run as all paths would.
    """
    base = base.rstrip("/")
    out: list[str] = []
    for tenant in dict.fromkeys(tenants):
        names = [n for n, _, is_folder in _children(spark, f"{base}/{tenant}") if is_folder and re.fullmatch("[0-9]{14}", n)]
        for ts in sorted((n for n in names if pinned in (None, n)), reverse=True):
            found = _files_below(spark, f"{base}/{tenant}/{ts}")
            low = [path.rsplit("/", 1)[1].lower() for path in found]
            out += found
            if any(".csv" in n and not n.endswith(".pgp") for n in low):
                break
            if processed and any(n.endswith(".pgp") for n in low):
                kept = _files_below(spark, f"{base}/processed/{tenant}/{ts}")
                out += kept
                if any(".csv" in n and not n.endswith(".pgp") for n in (path.rsplit("/", 1)[1].lower() for path in kept)):
                    break
    return spark.createDataFrame([(path,) for path in out], "path string")


def file_kind(name: Column) -> Column:
    low = F.lower(name)
    return (
        F.when(low.endswith(".pgp"), F.lit(ENCRYPTED))
        .when(low == MARKER_NAME, F.lit(MARKER))
        .when(low.contains(".csv"), F.lit(PLAIN))
        .otherwise(F.lit(OTHER))
    )


def view_name(name: Column) -> Column:
    """Text before the first ``.csv``, in lower case."""
    return F.substring_index(F.lower(name), ".csv", 1)


def run_files(paths: DataFrame, side: str, base: str) -> DataFrame:
    """Files of run folders below ``base``: ``(side, tenant, ts, processed, name, kind, view, path)``.

    Folders whose name is not 14 digits are no runs.  ``processed`` files lie below ``base/processed``.
    """
    pattern = rf"^{re.escape(base.rstrip('/'))}/(processed/)?([^/]+)/([0-9]{{14}})/(?:.*/)?([^/]+)$"
    path = F.col("path")

    def part(i: int) -> Column:
        return F.regexp_extract(path, pattern, i)

    files = paths.where(path.rlike(pattern)).select(
        F.lit(side).alias("side"),
        part(2).alias("tenant"),
        part(3).alias("ts"),
        (F.length(part(1)) > 0).alias("processed"),
        part(4).alias("name"),
        path,
    )
    kind = file_kind(F.col("name"))
    return files.withColumns({"kind": kind, "view": F.when(kind == PLAIN, view_name(F.col("name")))})


def latest_run(files: DataFrame, pinned: Mapping[str, str] | None = None, processed_sides=("left",)) -> DataFrame:
    """One run per side and tenant: ``(side, tenant, ts, processed, encrypted_only)``.

    The newest run with plain files wins; an encrypted run counts as plain when its files still lie in
    the processed folder (for ``processed_sides``).  Without any, the newest encrypted run stands for the
    tenant.  A pinned side takes its run as it is.
    """
    for side, ts in (pinned or {}).items():
        files = files.where((F.col("side") != side) | (F.col("ts") == ts))
    is_plain, in_place = F.col("kind") == PLAIN, ~F.col("processed")
    per_run = files.groupBy("side", "tenant", "ts").agg(
        F.max(in_place).alias("listed"),
        F.max(in_place & is_plain).alias("plain"),
        F.max(in_place & (F.col("kind") == ENCRYPTED)).alias("encrypted"),
        F.max(~in_place & is_plain).alias("kept"),
    )
    from_processed = ~F.col("plain") & F.col("encrypted") & F.col("kept") & F.col("side").isin(*processed_sides)
    usable = F.col("plain") | from_processed
    # One struct orders the runs of a tenant, so choosing is a max and combines before the shuffle.
    rank = F.when(usable, 2).when(F.col("encrypted"), 1).otherwise(0)
    best = (
        per_run.where("listed")
        .groupBy("side", "tenant")
        .agg(F.max(F.struct(rank.alias("rank"), "ts", from_processed.alias("processed"))).alias("best"))
    )
    return best.select(
        "side",
        "tenant",
        F.col("best.ts").alias("ts"),
        F.col("best.processed").alias("processed"),
        (F.col("best.rank") < 2).alias("encrypted_only"),
    )


def run_pairs(latest: DataFrame) -> DataFrame:
    """Left and right run of every tenant; BLOCKED when one is missing or has only encrypted files."""

    def side(name: str) -> DataFrame:
        return latest.where(F.col("side") == name).select(
            "tenant",
            F.col("ts").alias(f"{name}_ts"),
            F.col("processed").alias(f"{name}_processed"),
            F.col("encrypted_only").alias(f"{name}_encrypted"),
        )

    pairs = side("left").join(side("right"), "tenant", "full_outer")
    missing = [F.col(f"{s}_ts").isNull() for s in ("left", "right")]
    encrypted = [F.coalesce(f"{s}_encrypted", F.lit(False)) for s in ("left", "right")]
    problem = (
        F.when(missing[0], F.lit("no run folders on the left"))
        .when(missing[1], F.lit("no run folders on the right"))
        .when(encrypted[0], F.lit("left run holds only encrypted files"))
        .when(encrypted[1], F.lit("right run holds only encrypted files"))
    )
    return pairs.withColumn("note", problem).withColumn(
        "verdict", F.when(F.col("note").isNotNull(), F.lit("BLOCKED"))
    )


def chosen_files(files: DataFrame, latest: DataFrame) -> DataFrame:
    """Plain files of the chosen runs; a view unloaded in parts has one row per part."""
    runs = latest.where(~F.col("encrypted_only")).select("side", "tenant", "ts", "processed")
    return files.where(F.col("kind") == PLAIN).join(runs, ["side", "tenant", "ts", "processed"], "left_semi")


def view_coverage(chosen: DataFrame, configured: DataFrame | None = None) -> DataFrame:
    """Where each view of a tenant was unloaded: shared, left_only, right_only or absent.

    ``configured`` has ``(tenant, view, absent_note)``; a configured view nobody unloaded is reported as
    absent.  All but shared views are BLOCKED.
    """
    found = chosen.groupBy("tenant", "view").agg(
        F.max(F.col("side") == "left").alias("left"), F.max(F.col("side") == "right").alias("right")
    )
    if configured is not None:
        wanted = configured.select("tenant", "view", "absent_note", F.lit(True).alias("is_configured"))
        found = found.join(wanted, ["tenant", "view"], "full_outer").fillna(False, ["left", "right"])
    else:
        found = found.withColumn("absent_note", F.lit(None).cast("string"))
    coverage = (
        F.when(F.col("left") & F.col("right"), F.lit("shared"))
        .when(F.col("left"), F.lit("left_only"))
        .when(F.col("right"), F.lit("right_only"))
        .otherwise(F.lit("absent"))
    )
    note = (
        F.when(F.col("coverage") == "left_only", F.lit("Only present on the left side."))
        .when(F.col("coverage") == "right_only", F.lit("Only present on the right side."))
        .when(
            F.col("coverage") == "absent",
            F.when(F.length("absent_note") > 0, F.col("absent_note")).otherwise(
                F.lit("Configured but not found in either run folder.")
            ),
        )
    )
    return found.withColumn("coverage", coverage).select(
        "tenant",
        "view",
        "coverage",
        F.when(F.col("coverage") != "shared", F.lit("BLOCKED")).alias("verdict"),
        note.alias("note"),
    )
