"""Text forms used in reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: characters of a sample value shown in a report.
SHOWN_CHARACTERS = 120


def percent_text(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, three decimals, trailing zeros removed; NULL without a whole."""
    # Thousandths of a percent in whole numbers, so that ties do not depend on binary fractions.
    # Counts of pairs outgrow 64 bits: 32 digits leave room for the factor within the 38 of a decimal.
    part, whole = part.cast("decimal(32,0)"), whole.cast("decimal(32,0)")
    doubled = (part * F.lit(200000).cast("decimal(6,0)") + whole).cast("decimal(38,0)")
    of = F.nullif((whole * F.lit(2).cast("decimal(1,0)")).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    q = ((doubled - doubled % of) / of).cast("decimal(38,0)")
    thousandths = (q % F.lit(1000).cast("decimal(4,0)")).cast("int")
    whole_part = ((q - thousandths.cast("decimal(38,0)")) / F.lit(1000).cast("decimal(4,0)")).cast("decimal(35,0)")
    text = F.concat(whole_part.cast("string"), F.lit("."), F.lpad(thousandths.cast("string"), 3, "0"))
    return F.when(whole != 0, F.concat(F.regexp_replace(text, r"\.?0+$", ""), F.lit("%")))


def shown_value(value: Column) -> Column:
    """Sample value as shown: NULL and blank named, long text cut."""
    return (
        F.when(value.isNull(), F.lit("NULL"))
        .when(value == "", F.lit("(blank)"))
        .when(F.length(value) > SHOWN_CHARACTERS, F.concat(F.substring(value, 1, SHOWN_CHARACTERS), F.lit("...")))
        .otherwise(value)
    )
