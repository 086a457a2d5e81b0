"""Configuration as DataFrames: one row per view, lists as arrays.

``config_rows`` reads the mapping a YAML file holds.  Everything after it works on rows, whatever their
number: expanding the shared list into both modes, resolving grains, scoping, overrides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from twinledger.plans.status import OVERRIDABLE

CONFIG_SCHEMA = (
    "position int, view string, grain array<string>, clients array<string>, expected_blocked array<string>, "
    "accepted_columns array<struct<column: string, reason: string, where: string>>, "
    "exclude_columns array<struct<column: string, reason: string, where: string>>, "
    "accept_diff array<struct<tier: string, reason: string>>, absent_note string"
)
ALL_TIERS = "*"


def _spelled(raw, name: str) -> Iterator[Mapping]:
    """Whatever spelling the configuration uses, as mappings with the key ``name``: word, mapping, or list of either."""
    match raw:
        case None | False | "":
            return
        case True:
            yield {name: ALL_TIERS}
        case Mapping() if name in raw:
            yield raw
        case Mapping():
            yield from ({name: key, "reason": text} for key, text in raw.items())
        case list() | tuple():
            for part in raw:
                yield from _spelled(part, name)
        case _:
            yield {name: str(raw)}


def column_entries(raw) -> list[tuple[str, str, str | None]]:
    """Configured columns as ``(column, reason, where)``; a later entry for a column wins."""
    return list({e["column"]: (e["column"], e.get("reason") or "", e.get("where")) for e in _spelled(raw, "column")}.values())


def override_entries(raw) -> list[tuple[str, str | None]]:
    """Configured tier acceptances as ``(tier, reason)``; ``true`` is all tiers, a later entry for a tier wins."""
    reasons = {str(e["tier"]).upper(): e.get("reason") for e in _spelled(raw, "tier")}
    return [(tier, text if isinstance(text, str) else None) for tier, text in reasons.items()]


def config_rows(spark: SparkSession, views: Sequence[Mapping], default_grain: Sequence[str] | None = None) -> DataFrame:
    """Configured views as rows; a view that does not mention a grain gets the default one."""
    rows = [
        (
            i,
            str(v["name"]),
            list((v["grain"] if "grain" in v else default_grain) or []),
            [str(c) for c in v["clients"]] if v.get("clients") else None,
            [str(b) for b in v.get("expected_blocked") or []],
            column_entries(v.get("accepted_columns")),
            column_entries(v.get("exclude_columns")),
            override_entries(v.get("accept_diff")),
            v.get("absent_note"),
        )
        for i, v in enumerate(views)
        if v and v.get("name")
    ]
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


def bare_name(name: Column) -> Column:
    """View name without its warehouse prefix, in lower case."""
    return F.lower(F.regexp_replace(name, "(?i)^dwi_", ""))


def expand_views(shared: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """The shared list as one row per mode and view, spelled as that mode spells names.

    A mode that brings views of its own (``own`` has a ``mode`` column) ignores the shared list.  Client
    scoping only means something for extracts.
    """
    modes = shared.where(F.length("view") > 0).withColumn("mode", F.explode(F.array(F.lit("csv"), F.lit("dwi"))))
    if own is not None:
        modes = modes.join(own.select("mode").distinct(), "mode", "left_anti")
    is_dwi = F.col("mode") == "dwi"

    def cased(c: Column) -> Column:
        return F.when(is_dwi, F.upper(c)).otherwise(F.lower(c))

    def recased(name: str) -> Column:
        return F.transform(F.col(name), lambda x: x.withField("column", cased(x["column"])))

    changed = {
        "view": F.when(is_dwi, F.concat(F.lit("DWI_"), F.upper(bare_name(F.col("view"))))).otherwise(
            bare_name(F.col("view"))
        ),
        "grain": F.transform("grain", cased),
        "clients": F.when(~is_dwi, F.col("clients")),
        "accepted_columns": recased("accepted_columns"),
        "exclude_columns": recased("exclude_columns"),
    }
    out = modes.withColumns({k: v for k, v in changed.items() if k in modes.columns})
    return out if own is None else out.unionByName(own.select(*out.columns))


def grain_resolution(views: DataFrame, columns: DataFrame) -> DataFrame:
    """Grain columns each view really has, in order and in the view's own spelling, and those it lacks.

    ``columns`` are metadata rows ``(view, column_name)``; names match whatever their case.
    """
    wanted = views.select("view", F.posexplode_outer("grain").alias("at", "grain_column")).withColumn(
        "name", F.lower("grain_column")
    )
    available = columns.groupBy("view", F.lower("column_name").alias("name")).agg(
        F.max("column_name").alias("found")
    )
    resolved = wanted.join(available, ["view", "name"], "left").groupBy("view").agg(
        F.array_sort(F.collect_list(F.when(F.col("found").isNotNull(), F.struct("at", "found")))).alias("present"),
        F.array_sort(
            F.collect_list(F.when(F.col("found").isNull() & F.col("grain_column").isNotNull(), F.struct("at", "grain_column")))
        ).alias("missing"),
    )
    return resolved.select(
        "view",
        F.transform("present", lambda x: x["found"]).alias("present"),
        F.transform("missing", lambda x: x["grain_column"]).alias("missing"),
        (F.size("present") == 0).alias("no_grain"),
    )


def name_filter(names: str | None) -> list[str] | None:
    """A comma-separated list of views; each name is accepted with and without the warehouse prefix."""
    if not names:
        return None
    bare = {re.sub("^dwi_", "", n.strip().lower()) for n in names.split(",") if n.strip()}
    return sorted(bare | {f"dwi_{n}" for n in bare})


def scoped_views(views: DataFrame, tenants: Sequence[str] | Column, names: str | None = None) -> DataFrame:
    """One row per tenant and view in that tenant's scope; views without scope belong to every tenant.

    ``tenants`` is a list, or an array column of ``views``.
    """
    wanted = name_filter(names)
    picked = views.where(F.lower("view").isin(wanted)) if wanted else views
    every = tenants if isinstance(tenants, Column) else F.array(*[F.lit(str(t)) for t in tenants])
    lowered = F.transform("clients", lambda c: F.lower(c))
    open_to_all = F.col("clients").isNull() | (F.size("clients") == 0)
    own = F.filter(every, lambda t: open_to_all | F.array_contains(lowered, F.lower(t)))
    return picked.withColumn("tenant", F.explode(own))


def skip_blocked(views: DataFrame, skip: Sequence[str], names: str | None = None, run_all: bool = False) -> DataFrame:
    """Views with ``skipped`` and the block types behind it; views asked for by name are never skipped."""
    wanted = name_filter(names)
    if wanted:
        views = views.where(F.lower("view").isin(wanted))
    types = F.array(*[F.lit(s.strip().upper()) for s in skip if s.strip()]).cast("array<string>")
    hit = F.array_sort(F.array_intersect(F.transform("expected_blocked", lambda b: F.upper(b)), types))
    blocked_by = F.lit(None).cast("array<string>") if wanted or run_all else F.when(F.size(hit) > 0, hit)
    return views.withColumn("blocked_by", blocked_by).withColumn("skipped", F.col("blocked_by").isNotNull())


def accept_overrides(views: DataFrame, ladder: str) -> DataFrame:
    """``(view, tier, reason, known)`` of all overrides; unknown tiers, which do nothing, have ``known`` false."""
    tiers = F.array(*[F.lit(t) for t in OVERRIDABLE[ladder]])
    entries = views.select("view", F.explode("accept_diff").alias("o")).select(
        "view", F.upper("o.tier").alias("tier"), F.col("o.reason").alias("reason")
    )
    each = F.when(F.col("tier") == ALL_TIERS, tiers).otherwise(F.array("tier"))
    return entries.withColumn("tier", F.explode(each)).withColumn("known", F.array_contains(tiers, F.col("tier")))


def column_marks(views: DataFrame) -> DataFrame:
    """``(view, column, kind, reason, where)`` of all excluded and accepted columns."""

    def part(name: str, kind: str) -> DataFrame:
        return views.select("view", F.explode(name).alias("e")).select(
            "view", "e.column", F.lit(kind).alias("kind"), "e.reason", "e.where"
        )

    return part("exclude_columns", "excluded").unionByName(part("accepted_columns", "accepted"))
