"""Benchmark passages in training documents, found with spaced seeds.

A seed is a fixed mask over successive words: only the words under a 1 are hashed, so a replaced
word under a 0 does not matter. Hashes of documents and benchmark items are joined, and around each
hit the two texts are compared word by word over all that they overlap there, which tolerates replaced
words everywhere; the best stretch counts. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Every stretch of 12 words or more with 4 of 5 equal has a common seed of one of these; tested by enumeration.
MASKS = ("110111", "110010101")
LEAST, SHARE, SHORTEST = 12, (4, 5), 6
SMALL, CHUNK = 1_000_000, 1024
_FACTOR = 1_000_000_000


def _split(text: str) -> Column:
    return F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}_]+")


def _hashed(split: Column) -> Column:
    return F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))


def words_of(text: str) -> Column:
    """Hashes of the runs of letters, numbers and underscores in lower case; none for null.

    Words are compared by these 64 bits from here on, which makes rows and seeds small.
    """
    return _hashed(_split(text))


def seeds(table: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """Columns of ``table`` and, per position and mask that fits, ``at`` (in ``words``), mask, hash, and
    ``before``, the hash one position earlier if there is one.

    ``table`` needs an array ``words``; with columns ``lead`` and ``count``, seeds begin at the ``count`` words
    behind the first ``lead`` only. The positions are exploded first, so that the hashes are compiled column
    expressions.
    """
    own = F.slice("words", F.col("lead") + 1, F.col("count")) if "lead" in table.columns else F.col("words")
    before = F.col("lead") if "lead" in table.columns else F.lit(0)
    placed = table.select("*", F.posexplode(own).alias("_at", "_word")).withColumn("at", F.col("_at") + before)

    def hashed(k: int, mask: str, begin: Column) -> Column:
        return F.xxhash64(F.lit(k), *(F.get("words", begin + o) for o, bit in enumerate(mask) if bit == "1"))

    rows = []
    for k, mask in enumerate(masks):
        fits = F.col("at") + len(mask) <= F.size("words")
        rows.append(F.struct(
            F.lit(k).alias("mask"), F.when(fits, hashed(k, mask, F.col("at"))).alias("hash"),
            F.when(F.col("at") > 0, hashed(k, mask, F.col("at") - 1)).alias("before"),
        ))
    return placed.select(*table.columns, "at", F.inline(F.array(*rows))).where(F.col("hash").isNotNull())


def chunks(docs: DataFrame, margin: int, size: int = CHUNK) -> DataFrame:
    """(doc_id, words, lead, count): texts cut into ``size`` words, each with ``margin`` words around it.

    ``lead`` words stand before the ``count`` words that are the chunk's own. A very long text so becomes many
    small rows; what is made of one row at a time stays small. The filter that drops empty words at the ends
    is not compiled, which keeps the rows of one text from being expanded all at once.
    """
    split = docs.select("doc_id", _split("text").alias("words"))
    starts = split.select("*", F.explode(F.sequence(F.lit(0), F.size("words") - 1, F.lit(size))).alias("start"))
    lead = F.least("start", F.lit(margin))
    cut = starts.select(
        "doc_id", F.slice("words", F.col("start") - lead + 1, lead + size + margin).alias("words"),
        lead.alias("lead"), F.least(F.lit(size), F.size("words") - F.col("start")).alias("count"),
    )
    # An empty word can stand at the front of the first chunk and at the end of the last only: there it is no seed's
    # first word, or it is behind all others.
    empty_front = (F.get("words", F.lit(0)) == "").cast("int")
    first = (F.col("lead") == 0).cast("int") * empty_front
    return cut.select(
        "doc_id", _hashed(F.col("words")).alias("words"),
        F.greatest(F.col("lead") - (F.col("lead") > 0).cast("int") * empty_front, F.lit(0)).alias("lead"),
        (F.col("count") - first).alias("count"),
    )


def _best_stretch(least: int, share: tuple[int, int]) -> Column:
    """Score and length of the best stretch of the words ``mine`` against ``theirs``, as one number; null without a good one.

    ``theirs`` is what overlaps of an item of ``n`` words. A stretch has ``least`` words or more. An equal word
    scores what is missing from the share, another one loses the share, so a score of 0 or more is
    a good stretch. One pass: the lowest sum so far, of those ``least`` words back, is what a
    stretch that ends here begins behind. Items shorter than ``least`` must be there as a whole.
    """
    part, whole = share
    same = F.zip_with("mine", "theirs", lambda a, b: a == b)
    sums = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("at"))

    def step(state: Column, equal: Column) -> Column:
        total = state["now"]["sum"] + F.when(equal, whole - part).otherwise(-part)
        now = F.struct(total.alias("sum"), (state["now"]["at"] + 1).alias("at"))
        due = F.size(state["late"]) == least
        low = F.when(due, F.least(F.coalesce(state["low"], F.get(state["late"], F.lit(0))), F.get(state["late"], F.lit(0))))
        late = F.concat(F.when(due, F.slice(state["late"], 2, least - 1)).otherwise(state["late"]), F.array(now))
        score = total - low["sum"]
        found = F.when(score >= 0, score.cast("long") * _FACTOR + now["at"] - low["at"])
        return F.struct(
            now.alias("now"), late.alias("late"), low.alias("low"), F.greatest(state["best"], found).alias("best")
        )

    start = F.struct(
        sums.alias("now"), F.array(sums).alias("late"), F.lit(None).cast("struct<sum:int,at:int>").alias("low"),
        F.lit(None).cast("long").alias("best"),
    )
    n = F.col("n")
    entire = F.when(
        (F.size("mine") == n) & F.forall(same, lambda x: x), (n * (whole - part)).cast("long") * _FACTOR + n
    )
    return F.when(n < least, entire).otherwise(F.aggregate(same, start, step, lambda state: state["best"]))


def leaked_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    least: int = LEAST,
    share: tuple[int, int] = SHARE,
    shortest: int = SHORTEST,
    small: int = SMALL,
) -> DataFrame:
    """``(doc_id, item_id, matched, compared)`` for documents that hold a passage of an item.

    A document is reported if, aligned at a common seed, some stretch of ``least`` words or more has ``share`` of
    its words equal: whole items, parts of them, and runs in the middle of both. An item shorter than that is
    reported if all its words are there in order; items under ``shortest`` words are too common to be
    evidence. The row tells of the best stretch: the one with most equal words to spare, then the
    longest. Null and empty texts, null ids and repeated rows cause no special case: a repeated row
    adds nothing, a null doc_id or item_id is reported as null.

    The seeds of the benchmark are counted: up to ``small`` they and the items are broadcast, and documents
    are only scanned. Beyond, both sides are joined by shuffled hashes, ids and positions alone, and
    the texts are fetched for the hits. Of a run of hits on one alignment only the first is compared, so a
    document of one repeated word costs one comparison per alignment.
    """
    texts = docs.select("doc_id", words_of("text").alias("words"))
    items = benchmark.select("item_id", words_of("text").alias("words")).where(F.size("words") >= shortest).distinct()
    items = items.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words")
    known = seeds(items, masks).select(
        "item", "mask", "hash", F.col("at").alias("item_at"), F.col("before").alias("item_before")
    )
    # Of a run of hits on one alignment the first one stays: the seeds before it differ.
    first = ~F.coalesce(F.col("before") == F.col("item_before"), F.lit(False))
    own = items.select("item", "item_id", F.col("words").alias("item_words"))
    if known.count() <= small:
        longest = items.agg(F.coalesce(F.max(F.size("words")), F.lit(0))).first()[0]
        placed = seeds(chunks(docs, max([longest, *map(len, masks)])), masks)
        hits = placed.join(F.broadcast(known), ["mask", "hash"]).where(first).join(F.broadcast(own), "item")
    else:
        narrow = seeds(texts, masks).drop("words").join(known, ["mask", "hash"]).where(first).drop("mask", "hash")
        hits = narrow.join(texts, narrow.doc_id.eqNullSafe(texts.doc_id)).drop(texts.doc_id).join(own, "item")
    # The overlap alone goes on, and equal ones, as repetitive texts have them, once. It is exploded from
    # an array of one, because a plain projection would be merged with the comparison, which is not compiled.
    shift = F.col("at") - F.col("item_at")
    skipped = F.greatest(F.lit(0), -shift)
    size = F.least(F.size("item_words"), F.size("words") - shift) - skipped
    overlap = F.struct(
        F.size("item_words").alias("n"), F.slice("words", shift + skipped + 1, size).alias("mine"),
        F.slice("item_words", skipped + 1, size).alias("theirs"),
    )
    met = hits.select("doc_id", "item_id", F.inline(F.array(overlap)))
    # A plain distinct would be left out, as the maximum that follows does not need it.
    met = met.groupBy(*met.columns).agg(F.count("*").alias("times")).where("times > 0")
    compared = met.select("doc_id", "item_id", _best_stretch(least, share).alias("stretch"))
    best = compared.groupBy("doc_id", "item_id").agg(F.max("stretch").alias("best")).where(F.col("best").isNotNull())
    size = F.col("best") % _FACTOR
    score = F.floor(F.col("best") / _FACTOR)
    part, whole = share
    return best.select(
        "doc_id", "item_id", ((score + part * size) / whole).cast("int").alias("matched"), size.cast("int").alias("compared")
    )


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage; rows without a doc_id stay."""
    leaked = leaked_passages(docs, benchmark).select("doc_id").distinct()
    return docs.join(leaked, "doc_id", "left_anti").select(docs.columns)
