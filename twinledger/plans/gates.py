"""Which tiers run, given the earlier ones, as data.

Each ladder is a table of ``(tier, condition to run, reasons when it does not)`` over one row per view
with the flags ``present``, ``has_grain``, ``usable``, ``always`` and one status column per tier, which
holds what the tier came to (or would come to).  The ladders ask the same tables before they start a
tier, with statuses known so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from twinledger.plans.status import TIERS
from twinledger.plans.wording import DIFFERS, KEYS_UNUSABLE, NO_KEYS, TOLERATED

_CLEAN = "('PASS', 'SKIPPED')"

# (tier, SQL condition to run it, [(SQL condition, reason), ...] first match wins)
GATES: dict[str, list[tuple[str, str, list[tuple[str, str]]]]] = {
    "T": [
        ("T0", "present", []),
        ("T1", "has_grain", [("true", NO_KEYS)]),
        ("T2", "true", []),
        (
            "T3",
            "has_grain and usable",
            [("has_grain", KEYS_UNUSABLE), ("true", NO_KEYS)],
        ),
        (
            "T4",
            f"always or (case when has_grain and usable then T3 else T2 end) in {_CLEAN}",
            [
                (
                    "(case when has_grain and usable then T3 else T2 end) = 'ACCEPTED'",
                    TOLERATED,
                ),
                ("true", DIFFERS),
            ],
        ),
    ],
    "D": [
        ("D0", "present", []),
        ("D1", "has_grain", [("true", NO_KEYS)]),
        ("D2", "has_grain", [("true", NO_KEYS)]),
        ("D3", "has_grain and usable", [("true", KEYS_UNUSABLE)]),
        (
            "D4",
            f"always or (D2 in {_CLEAN} and D3 in {_CLEAN})",
            [
                (
                    "not (D2 = 'FAIL' or D3 = 'FAIL')",
                    TOLERATED,
                ),
                ("true", DIFFERS),
            ],
        ),
    ],
    "C": [
        ("C0", "true", []),
        ("C1", "present", []),
        ("C2", "true", []),
        ("C3", "has_grain", [("true", NO_KEYS)]),
        ("C4", "has_grain", [("true", NO_KEYS)]),
        (
            "C5",
            f"always or (C2 in {_CLEAN} and C3 in {_CLEAN} and C4 in {_CLEAN})",
            [
                (
                    "not (C2 = 'FAIL' or C3 = 'FAIL' or C4 = 'FAIL')",
                    TOLERATED,
                ),
                ("true", DIFFERS),
            ],
        ),
    ],
}

# Tier whose failure ends the ladder, and the tier (if any) still reported for an absent table.
STRUCTURE = {"T": "T0", "D": "D0", "C": "C1"}


def tier_gates(views: DataFrame, ladder: str, by: list[str]) -> DataFrame:
    """``(by.., tier, status, reason)`` of the tiers each view gets, statuses of withheld tiers SKIPPED.

    Input statuses are taken after overrides.  Tiers after a failed structure tier, or of a view that is
    missing on a side, get no row.
    """
    gated = views
    for tier, runs, reasons in GATES[ladder]:
        why = F.lit(None).cast("string")
        for condition, reason in reversed(reasons):
            why = F.when(F.expr(condition), F.lit(reason)).otherwise(why)
        runs_now = F.coalesce(F.expr(runs), F.lit(False))
        gated = gated.withColumns(
            {
                tier: F.when(runs_now, F.col(tier)).otherwise(F.lit("SKIPPED")),
                f"{tier}_reason": F.when(~runs_now, why),
            }
        )
    first = TIERS[ladder][0]
    stop = STRUCTURE[ladder]
    broken = F.coalesce(F.col(stop).isin("FAIL", "ERROR"), F.lit(False))
    structural = [t for t in TIERS[ladder] if t <= stop]
    rows = []
    for tier in TIERS[ladder]:
        shown = F.lit(True) if tier in structural else ~broken
        if not (ladder == "C" and tier == first):
            shown = shown & F.col("present")
        rows.append(
            F.struct(
                F.lit(tier).alias("tier"),
                F.col(tier).alias("status"),
                F.col(f"{tier}_reason").alias("reason"),
                shown.alias("shown"),
            )
        )
    tall = gated.select(*by, F.inline(F.array(*rows)))
    return tall.where("shown").drop("shown")


def may_run(spark: SparkSession, ladder: str, tier: str, flags: dict, statuses: dict) -> tuple[bool, str | None]:
    """Ask the gate table about one tier of one view, with the statuses known so far."""
    known = {**flags, **{t: statuses.get(t) for t in TIERS[ladder]}}
    _, runs, reasons = next(g for g in GATES[ladder] if g[0] == tier)
    why = "".join(f"when {condition} then '{reason}' " for condition, reason in reasons)
    # Everything in this statement is a constant, so it is answered without a job.
    row = ", ".join(f"cast(:{name} as {'boolean' if name in flags else 'string'}) as {name}" for name in known)
    out = spark.sql(
        f"select coalesce({runs}, false) as runs, case {why}end as why from (select {row})"
        if why
        else f"select coalesce({runs}, false) as runs, cast(null as string) as why from (select {row})",
        args=known,
    ).first()
    return out.runs, None if out.runs else out.why
