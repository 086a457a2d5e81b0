"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Every source gets its weight's part of the budget, but at most ``epochs`` times what it holds.  Sources above that are
clamped and their excess goes to the others by weight, until none is above: a round takes two sums, so the list of
sources stays distributed.  A target is then so many whole repetitions of all documents of its source and one more of
some of them.  Which ones, a seeded order decides: digit by digit of the documents' keys the place is narrowed down up
to which the missing words reach, so no source's documents are ever sorted or gathered.

All of it is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from twinledger.sources.storage import stored

#: White space is U+0020 and U+0009 to U+000D; everything else belongs to words.
WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the keys looked at per round: at most 16^DIGITS sums per source and round.
DIGITS = 3
#: A list of sources of at most this many rows is broadcast; documents meet a longer one by shuffle, over salts.
BROADCAST_ROWS, SALTS = 100_000, 64
EXACT = "decimal(38,0)"


def words(text: str = "text") -> Column:
    """Words of a text; none if it is null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def places(sources: DataFrame) -> DataFrame:
    """Rows of distinct ``source`` with their ``place`` from 0 by code point, null last; no window spans all of them."""
    order = F.col("source").asc_nulls_last()
    ranged = stored(sources.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "source-ranges")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    # One row per range: as many as shuffle partitions.
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = ranged.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = ranged.withColumn("_in", inside).join(starts, "_part")
    return placed.select(*sources.columns, (F.col("_in") + F.col("_before") - 1).alias("place"))


def _clamped(epochs: int, share: Fraction, level: tuple[int, int] | None) -> Column:
    """Whether a source's part is at or above its cap, compared in whole numbers."""
    if level is None:
        return F.lit(False)
    left, weights = (F.lit(x).cast(EXACT) for x in level)
    cap = F.col("source_size").cast(EXACT) * epochs
    return cap * weights * share.denominator <= F.col("weight").cast(EXACT) * left


def targets(sources: DataFrame, share: Fraction, epochs: int) -> DataFrame:
    """``sources`` (``source_size``, whole ``weight`` of at least 1) with ``target``, in words, as a double.

    The targets sum to ``share`` of all sizes, or to ``epochs`` times all sizes if that is less.
    """
    cap = F.col("source_size").cast(EXACT) * epochs
    zero = F.lit(0).cast(EXACT)
    total = sources.agg(F.coalesce(F.sum(F.col("source_size").cast(EXACT)), zero)).first()[0]
    level = None  # words (times the denominator) for the sources not clamped, and the sum of their weights
    while True:
        clamped = _clamped(epochs, share, level)
        held, weights = sources.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), zero), F.coalesce(F.sum(F.when(~clamped, F.col("weight").cast(EXACT))), zero)
        ).first()
        now = (int(total) * share.numerator - int(held) * share.denominator, int(weights))
        if now == level or not weights:
            break
        level = now
    if not weights:  # all are clamped, or there is no source
        return sources.withColumn("target", cap.cast("double"))
    part = F.col("weight") * F.lit(level[0] / share.denominator) / F.lit(float(level[1]))
    return sources.withColumn("target", F.when(clamped, cap.cast("double")).otherwise(part))


def with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Every row with the columns of its source; a source may hold any share of the rows."""
    other = sources.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    if sources.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(other), same).drop("_source")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
    repeated = other.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, same & (F.col("_salt") == F.col("_of"))).drop("_source", "_salt", "_of")


def _boundary(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with the key ``_prefix`` up to which ``_rest`` words reach and the words ``_before`` it.

    The row with that prefix, one per source at the end, is the last that may be taken.
    """
    state = sources.withColumn("_prefix", F.lit("")).withColumn("_before", F.lit(0).cast("long"))
    digits = 0
    while True:
        digits += DIGITS
        at = with_sources(rows.where("size > 0"), state.select("source", "_prefix", "_before", "_rest"))
        at = at.where(F.col("_key").startswith(F.col("_prefix")))
        sums = at.groupBy("source", F.substring("_key", 1, digits).alias("_next")).agg(
            F.sum("size").alias("_sum"), F.count("*").alias("_n"), F.first("_rest").alias("_rest"), F.first("_before").alias("_start")
        )
        up_to = Window.partitionBy("source").orderBy("_next").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("_end", F.col("_start") + F.sum("_sum").over(up_to))
        # The least prefix with words beyond the rest; if rounding puts the rest at the end, the last one.
        last = F.min_by(
            F.struct("_next", (F.col("_end") - F.col("_sum")).alias("_before"), "_n"),
            F.struct((F.col("_end") <= F.col("_rest")).alias("a"), F.when(F.col("_end") <= F.col("_rest"), -F.col("_end")).alias("b"), "_next"),
        )
        found = stored(sums.groupBy("source").agg(last.alias("_at")), "mix-boundary")
        named = found.withColumnRenamed("source", "_source")  # not there for sources without a word
        joined = sources.join(named, F.col("source").eqNullSafe(F.col("_source")), "left")
        start = F.col("_at._next").alias("_prefix"), F.col("_at._before").alias("_before")
        state = stored(joined.select(*sources.columns, *start), "mix-state")
        most = found.agg(F.max("_at._n")).first()[0]
        if most is None or most == 1 or digits >= 48:
            return state


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: Fraction = Fraction(3, 2), epochs: int = 2, seed: int = 11,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Rows of ``docs`` (``doc_id``, ``text``, ``source``), each with how often the mix takes it.

    Returns the ``keep`` columns, ``source``, ``size`` (words), ``source_size``, ``weight``, ``target`` (words of its
    source), ``copies`` (from 0 to ``epochs``) and ``taken`` (words).  Sources by code point, null last as a source of
    its own, weigh ``weights``, repeating.  A source's taken words differ from its target by at most half of one of its
    documents.  Null and empty texts have no words and are taken as often as all of their source.  Order within a source
    is the MD5 of seed, id and text; repeated rows are told apart by number, so some copies may be taken once more than
    others, and which ones cannot be seen in the result.  Columns not kept play no part, whatever their names.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    number = F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")
    rows = docs.select(*keep, F.col("source"), words().alias("size"), F.concat(key, number).alias("_key"))
    rows = stored(rows, "mix-rows")
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    given = F.array(*[F.lit(int(w)) for w in weights])
    weighed = places(sizes).withColumn("weight", F.element_at(given, (F.col("place") % len(weights) + 1).cast("int")))
    aimed = targets(stored(weighed.select("source", "source_size", "weight"), "weighed"), share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = aimed.withColumn("_whole", whole.cast("int"))
    sources = stored(sources.withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")), "targets")
    placed = with_sources(rows, _boundary(rows, sources))
    ahead = F.substring("_key", 1, F.length("_prefix"))
    half = F.col("_rest") - F.col("_before") >= F.col("size") / 2
    more = F.when((F.col("_rest") > 0) & ((ahead < F.col("_prefix")) | ((ahead == F.col("_prefix")) & half)), 1).otherwise(0)
    copies = F.col("_whole") + more
    return placed.withColumn("copies", copies.cast("int")).select(
        *keep, *(["source"] if "source" not in keep else []), "size", "source_size", "weight", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row of ``mix`` as often as it is taken, with ``copy`` from 0; rows not taken are gone."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
