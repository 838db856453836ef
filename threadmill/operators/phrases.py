"""Substring lookup of very many phrases with priorities, without pairing texts and phrases.

Texts are searched for the few phrases that come first; one that has any of these is settled. For the other
texts every phrase waits under its rarest piece of three characters. A text looks up its own pieces, and
only the phrases found that way are searched for in it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.tables import stage

PIECE = 3
#: So many of the first phrases are searched for in every text, where there are more than that.
EARLY = 64


def pieces(text: Column, length: int) -> Column:
    """All different substrings of that length, found in one pass over the text."""
    every = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{length}}}))"), F.lit(1))
    return F.array_distinct(every)


def phrase_table(spark: SparkSession, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """(phrase, value, priority) from an ordered mapping of values to their phrases."""
    rows = [(p, value, n) for n, (value, phrases) in enumerate(rules.items()) for p in phrases]
    return spark.createDataFrame(rows, "phrase string, value string, priority int")


def _rules(phrases: DataFrame) -> DataFrame:
    """(phrase, value, priority) in lower case; of equal phrases only the first counts."""
    rules = phrases.select(F.lower("phrase").alias("phrase"), "value", "priority").where("phrase <> ''")
    first = F.min_by(F.struct("value", "priority"), F.struct("priority", "value"))
    return stage(rules.groupBy("phrase").agg(first.alias("rule")).select("phrase", "rule.*"), "phrases")


def _settled(lower: Column, rules: DataFrame, early: int = EARLY) -> Column | None:
    """A struct with the value of the first phrase if it is among the first ``early``, else NULL.

    Any later phrase comes after these, so it need not be looked for. None if there are no later phrases.
    """
    few = rules.orderBy("priority", "phrase").limit(early + 1).collect()
    if len(few) <= early:
        return None
    settled = F.lit(None).cast("struct<value:string>")
    for r in reversed(few[:early]):
        value = F.struct(F.lit(r["value"]).cast("string").alias("value"))
        settled = F.when(F.contains(lower, F.lit(r["phrase"])), value).otherwise(settled)
    return settled


def first_phrase(texts: DataFrame, text: str, phrases: DataFrame, piece: int = PIECE) -> DataFrame:
    """(text, value): of every different text the value of the first phrase that occurs in it.

    ``phrases`` has phrase, value and priority; the smallest priority is first, ties go to the smaller
    phrase. Case is ignored. Texts without any phrase, null and empty texts are not in the result;
    null and empty phrases occur nowhere.
    """
    rules = _rules(phrases)
    settled = _settled(F.col("text"), rules)
    if settled is None:
        return _by_pieces(texts.select(F.col(text).alias("text")), rules, piece)
    known = texts.select(F.lower(text).alias("text")).withColumn("_settled", settled)
    found = known.where("_settled IS NOT NULL").select("text", "_settled.value").distinct()
    return found.union(_by_pieces(known.where("_settled IS NULL"), rules, piece))


def _by_pieces(texts: DataFrame, rules: DataFrame, piece: int) -> DataFrame:
    """As ``first_phrase``, for texts that nothing is known of.

    A phrase shorter than a piece is looked up as it is. A piece is rare if few texts have it; phrases with a
    piece that no text has are out at once. The texts' pieces are counted and joined; phrase and text meet on
    a common piece only.
    """
    lower = texts.select(F.lower("text").alias("text")).where("text <> ''").distinct()
    lower = stage(lower, "texts")
    rules = rules.withColumn("length", F.least(F.length("phrase"), F.lit(piece)))
    lengths = sorted(r[0] for r in rules.select("length").distinct().collect())
    if not lengths:
        return lower.limit(0).withColumn("value", F.lit(None).cast("string"))

    def all_pieces(column: str, only: Column | None = None) -> Column:
        parts = []
        for n in lengths:
            found = pieces(F.col(column), n)
            parts.append(found if only is None else F.when(only == n, found).otherwise(F.array().cast("array<string>")))
        return F.concat(*parts)

    of_texts = lower.select("text", F.explode(all_pieces("text")).alias("piece"))
    of_phrases = rules.select("phrase", F.explode(all_pieces("phrase", F.col("length"))).alias("piece"))
    asked = of_phrases.select("piece").distinct()
    # Pieces that no phrase has are not counted; a piece is counted by task before it moves.
    counts = of_texts.select("piece").join(asked, "piece", "left_semi").groupBy("piece").agg(F.count("*").alias("n"))
    n_pieces = F.col("n_pieces")
    ranked = of_phrases.join(counts, "piece", "left").groupBy("phrase").agg(
        F.min_by("piece", F.struct(F.coalesce("n", F.lit(0)), "piece")).alias("piece"),
        F.min(F.coalesce("n", F.lit(0))).alias("n_pieces"),
    )
    index = stage(ranked.where(n_pieces > 0).drop("n_pieces").join(rules.drop("length"), "phrase"), "phrase-index")
    met = of_texts.join(index, "piece").where(F.contains("text", "phrase"))
    return met.groupBy("text").agg(F.min_by("value", F.struct("priority", "phrase")).alias("value"))


def with_first_phrase(
    df: DataFrame, text: str, phrases: DataFrame, out: str, otherwise: str | None = None
) -> DataFrame:
    """Add ``out``: the value of the first phrase in ``text``, ``otherwise`` without one, NULL for no text.

    Different texts are looked up by pieces once, however often they occur.
    """
    rules = _rules(phrases)
    settled = _settled(F.lower(text), rules)
    known = df.withColumn("_settled", F.lit(None).cast("struct<value:string>") if settled is None else settled)
    unknown = known.where("_settled IS NULL").select(F.col(text).alias("text"))
    found = stage(_by_pieces(unknown, rules, PIECE), "found").select(F.col("text").alias("_text"), F.col("value").alias("_value"))
    joined = known.join(found, F.lower(text) == F.col("_text"), "left")
    blank = F.col(text).isNull() | (F.col(text) == "")
    value = F.coalesce("_settled.value", "_value", F.lit(otherwise))
    return joined.withColumn(out, F.when(~blank, value)).drop("_text", "_value", "_settled")
