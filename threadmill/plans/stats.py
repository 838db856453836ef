"""Sanity report over threads and posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.measures import level_glyph
from ..functions.text import preview
from ..operators.ordering import sample_key, top_counts


def threads_per_kind(threads: DataFrame) -> DataFrame:
    return top_counts(threads, "kind")


def total_posts(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count("*").alias("posts"))


def hiring_months(threads: DataFrame) -> DataFrame:
    """First and last month with a hiring thread."""
    hiring = threads.filter((F.col("kind") == "hiring") & F.col("month").isNotNull())
    return hiring.agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))


def posts_per_month(threads: DataFrame, posts: DataFrame) -> DataFrame:
    """Posts per hiring month, months without posts included, with a bar level.

    Posts are counted per thread before they meet the threads, so a thread with very
    many posts is one row in the join.
    """
    hiring = threads.filter((F.col("kind") == "hiring") & F.col("month").isNotNull())
    per_thread = posts.groupBy(F.col("thread_id").alias("id")).agg(F.count("id").alias("_n"))
    months = (
        hiring.select("id", "month")
        .join(per_thread, "id", "left")
        .groupBy("month")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
    )
    return with_level(months).orderBy("month")


def with_level(months: DataFrame) -> DataFrame:
    """Add ``level``, next to the largest month. One row per month: a window over all is small."""
    return months.withColumn("level", level_glyph(F.col("n"), F.max("n").over(W.partitionBy())))


def sample_posts(posts: DataFrame, n: int = 3, seed: str = "") -> DataFrame:
    """``n`` posts in a reproducible random order, as readable previews."""
    chosen = (
        posts.filter(F.col("raw_html").isNotNull())
        .select("id", "author", "created_at", "raw_html")
        .orderBy(sample_key(F.col("id"), seed), "id")
        .limit(n)
    )
    return chosen.select(
        "id",
        "author",
        F.substring("created_at", 1, 10).alias("date"),
        preview(F.col("raw_html")).alias("preview"),
    )


def stats(threads: DataFrame, posts: DataFrame) -> DataFrame:
    """Kinds, total, range and months in one long table: section, key, n."""

    def section(name: str, rows: DataFrame, key, n) -> DataFrame:
        return rows.select(F.lit(name).alias("section"), key.alias("key"), n.cast("long").alias("n"))

    nothing = F.lit(None)
    months = hiring_months(threads)
    return (
        section("kind", threads_per_kind(threads), F.col("kind"), F.col("n"))
        .unionByName(section("posts", total_posts(posts), F.lit("total"), F.col("posts")))
        .unionByName(section("first_month", months, F.col("first_month"), nothing))
        .unionByName(section("last_month", months, F.col("last_month"), nothing))
        .unionByName(section("month", posts_per_month(threads, posts), F.col("month"), F.col("n")))
    )
