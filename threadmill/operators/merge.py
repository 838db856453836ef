"""Keyed merges: upserts, replace on key, fetch marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest row of every key.

    Spark puts a group limit in front of the shuffle for ``row_number() = 1``, so every
    task sends one row per key on and a key with very many rows does not pile up.
    """
    window = W.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def replace_on_key(target: DataFrame, updates: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """``target`` with the rows of ``updates`` put in, whole rows, by key.

    ``seq`` is the column of ``updates`` that orders its rows; of equal keys the last
    one wins. Only the keys of the updates meet the target, which is not shuffled as
    long as they are small enough to broadcast.
    """
    newest = latest_per_key(updates, keys, [F.col(seq).desc()]).select(target.columns)
    return target.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest)


def upsert_threads(threads: DataFrame, updates: DataFrame) -> DataFrame:
    """Insert or overwrite threads by id, but keep when their posts were fetched.

    ``updates`` has one row per id. A NULL in it overwrites; a new thread is unfetched.
    """
    new = updates.withColumn("_new", F.lit(True)).alias("u")
    old = threads.alias("t")
    fields = ("title", "kind", "month", "created_at", "num_comments")
    return old.join(new, F.col("t.id") == F.col("u.id"), "full_outer").select(
        F.coalesce("u.id", "t.id").alias("id"),
        *(F.when(F.col("u._new"), F.col(f"u.{f}")).otherwise(F.col(f"t.{f}")).alias(f) for f in fields),
        F.col("t.fetched_at").alias("fetched_at"),
    )


def mark_fetched(threads: DataFrame, fetched: DataFrame) -> DataFrame:
    """Set ``fetched_at`` of the threads in ``fetched`` (id, fetched_at)."""
    marks = fetched.select(F.col("id"), F.col("fetched_at").alias("_fetched_at"))
    return (
        threads.join(marks, "id", "left")
        .withColumn("fetched_at", F.coalesce("_fetched_at", "fetched_at"))
        .select(threads.columns)
    )
