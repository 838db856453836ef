"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size in words. The words of the mix are shared by weight; a
source that would be read more than the allowed number of times is clamped there, and what it
leaves is shared again among the others, until none is above its clamp. A source then gives all
its documents as often as its target holds it whole, and once more a seeded random part of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from threadmill.sources.tables import stage

EPOCHS, PATTERN, SEED = 3, (5, 2, 1), "mix"
#: Blank characters of the word count: space and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
_HASH_DIGITS, _FINE = 15, 1 << 10
_BITS = 4 * _HASH_DIGITS


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blanks; a null text has none.

    Every word becomes one letter, with the blanks behind it, so that nothing larger than the
    text itself is held and the time is linear in it.
    """
    letters = F.regexp_replace(text, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.coalesce(F.length(F.ltrim(letters, F.lit(BLANKS))), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str) -> Column:
    """Seeded place of a document in the random order of its source, 60 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, _HASH_DIGITS), 16, 10).cast("long")


def repeating_weights(sources: DataFrame, pattern: tuple[float, ...] = PATTERN) -> DataFrame:
    """``sources`` with a ``weight``: the pattern over and over, by code point, a null source last.

    One row per source meets in one task: sources are what a recipe names, not documents.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*(F.lit(float(w)) for w in pattern))
    return sources.withColumn("weight", weights[F.pmod(place - 1, F.lit(len(pattern)))])


def water_level(sources: DataFrame, budget: float, epochs: float) -> tuple[float, float, float]:
    """Clamp the sources that are full at the level, raise the level by what they leave, repeat.

    Returns the level (words per unit of weight at and below which a source is clamped), and the
    words and the weight that the rest share. A round is one aggregate over ``sources``; three
    numbers come back. The level only rises, so the clamped sources only grow and it ends.
    """
    level, clamped_before = -1.0, -1
    cap = F.col("source_size") * F.lit(float(epochs))
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        clamped, held, weight = sources.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        left = max(budget - held, 0.0)
        if clamped == clamped_before or not weight:
            return level, left, weight
        clamped_before, level = clamped, max(level, left / weight)


def targets(sources: DataFrame, budget: float | None = None, epochs: float = EPOCHS) -> DataFrame:
    """``sources`` (source, source_size, weight) with their ``target`` in words.

    The targets add up to ``budget``, by default all words, or to all clamps if these hold less.
    A source without weight, or without words, gets nothing.
    """
    if budget is None:
        budget = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, left, weight = water_level(sources, float(budget), epochs)
    cap = F.col("source_size") * F.lit(float(epochs))
    share = F.col("weight") * F.lit(left) / F.lit(weight) if weight else F.lit(0.0)
    clamped = (cap <= F.lit(level) * F.col("weight")) | F.lit(not weight)
    return sources.withColumn("target", F.when(clamped, cap).otherwise(share))


def _filled(sums: DataFrame, place: str) -> DataFrame:
    """Of every source the place at which its need is filled, and the words in front of it."""
    before = F.coalesce(
        F.sum("words").over(W.partitionBy("source").orderBy(place).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    summed = sums.withColumn("before", F.col("before") + before)
    inside = (F.col("need") > F.col("before")) & (F.col("need") <= F.col("before") + F.col("words"))
    return summed.where(inside).select("source", F.col(place).alias(f"edge_{place}"), "before")


def _of_source(rows: DataFrame, sources: DataFrame, **places: str) -> DataFrame:
    """Null-safe join of rows and one row per source; ``places``: columns that must be equal, too."""
    one = sources.withColumnRenamed("source", "_source")
    on = F.col("source").eqNullSafe(F.col("_source"))
    for mine, other in places.items():
        on &= F.col(mine) == F.col(other)
    return rows.join(one, on).drop("_source")


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    epochs: int = EPOCHS,
    budget: float | None = None,
    seed: str = SEED,
    text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, whole, part, taken.

    ``weights`` (source, weight) names the weights; without it they follow ``PATTERN``. ``whole``
    is how often the document is taken from start to end, ``part`` the number of leading words
    that are taken once more, ``taken`` the words in all. A source takes its target rounded to
    whole words, exactly: in the seeded order of its documents the first are taken once more, and
    the one at which the target is reached gives only its first words. No document is
    taken more than ``epochs`` times, which must be a whole number of 1 or more.

    A null or empty text has no words and gives none; a null source is a source; a source that
    ``weights`` does not name is not taken. Rows with equal doc_id share their place in the order and
    are taken by size; equal rows are taken one by one. An empty table gives an empty result.

    Texts are read once; all else reads (doc_id, source, size, place) from a written table. The
    place at which a target is reached is found by sums over 2^10 ranges of the random order, then over 2^10
    ranges of that one, so that no task sees a large source; only the last 2^-20 of a source is sorted.
    """
    if epochs < 1 or epochs != int(epochs):
        raise ValueError("epochs must be a whole number of 1 or more")
    place = draw(F.col("doc_id"), seed)
    rows = docs.select("doc_id", "source", word_count(F.col(text)).alias("size"), place.alias("place"))
    coarse = F.shiftright("place", _BITS - 10).cast("int")
    fine = F.pmod(F.shiftright("place", _BITS - 20), F.lit(_FINE)).cast("int")
    rows = stage(rows.withColumns({"coarse": coarse, "fine": fine}), "sized")
    ranges = stage(rows.groupBy("source", "coarse").agg(F.sum("size").alias("words")), "sized-ranges")

    sources = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    if weights is None:
        sources = repeating_weights(sources)
    else:
        named = weights.groupBy("source").agg(F.sum("weight").cast("double").alias("weight"))
        sources = _of_source(sources, named)
    plan = targets(stage(sources, "sources"), budget, epochs).where("weight > 0 AND source_size > 0")
    want = F.floor(F.col("target") + F.lit(0.5))
    plan = stage(
        plan.withColumn("whole", F.floor(want / F.col("source_size")).cast("int"))
        .withColumn("need", want - F.col("whole") * F.col("source_size")),
        "plan",
    )
    needs = plan.select("source", "need").where("need > 0").withColumn("before", F.lit(0).cast("long"))
    at_coarse = stage(_filled(_of_source(ranges, needs), "coarse"), "edges")
    inner = _of_source(rows, at_coarse, coarse="edge_coarse").groupBy("source", "fine").agg(F.sum("size").alias("words"))
    started = _of_source(at_coarse, needs.select("source", "need"))
    at_fine = _filled(_of_source(inner, started), "fine")
    edges = _of_source(at_fine, at_coarse.select("source", "edge_coarse"))
    plan = stage(
        plan.join(edges.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
        .drop("_source"),
        "plan",
    )

    joined = rows.join(
        plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left"
    ).drop("_source")
    mine, edge = F.struct("coarse", "fine"), F.struct("edge_coarse", "edge_fine")
    at_edge = F.coalesce(mine == edge, F.lit(False)) & F.col("edge_coarse").isNotNull()
    order = W.partitionBy("source").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    gone = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    last = joined.where(at_edge).withColumn("part", F.greatest(F.lit(0), F.least("size", F.col("need") - gone)))
    first = F.col("edge_coarse").isNotNull() & (mine < edge)
    rest = joined.where(~at_edge).withColumn("part", F.when(first, F.col("size")).otherwise(0))
    whole = F.coalesce("whole", F.lit(0))
    return rest.unionByName(last).select(
        "doc_id", "source", "size",
        F.coalesce("source_size", F.lit(0)).alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        whole.alias("whole"),
        F.col("part").cast("long").alias("part"),
        (whole * F.col("size") + F.col("part")).cast("long").alias("taken"),
    )
