"""What is left to do: threads to fetch, posts to extract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import is_blank
from .ordering import id_range, running_total_before


def threads_of_kind(threads: DataFrame, kind: str = "hiring") -> DataFrame:
    return threads.filter(F.col("kind") == kind).orderBy(F.asc_nulls_first("month"), "id")


def thread_by_id(threads: DataFrame, thread_id: int) -> DataFrame:
    """Lookup of one thread, whatever its kind."""
    return threads.filter(F.col("id") == thread_id)


def unknown_threads(requested: DataFrame, threads: DataFrame) -> DataFrame:
    """Requested ids that are in no thread list yet and have to be landed first."""
    return requested.join(threads.select("id"), "id", "left_anti")


def threads_to_fetch(threads: DataFrame, force: bool = False) -> DataFrame:
    return threads if force else threads.filter(is_blank(F.col("fetched_at")))


def posts_to_extract(
    posts: DataFrame,
    threads: DataFrame,
    ledger: DataFrame,
    version: str = "v1",
    month: str | None = None,
    force: bool = False,
    retry_errors: bool = False,
) -> DataFrame:
    """Posts of hiring threads that the ledger has no row for, with their month.

    Any ledger row keeps a post out, errors too, unless ``retry_errors`` is set. The joins see
    ids only; the HTML is fetched for the posts that are left, usually few. ``posts`` has one
    row per id.
    """
    hiring = threads.filter(F.col("kind") == "hiring")
    if month:
        hiring = hiring.filter(F.col("month") == month)
    queue = posts.select("id", "thread_id").join(hiring.select(F.col("id").alias("thread_id"), "month"), "thread_id")
    if not force:
        done = ledger.filter(F.col("prompt_version") == version)
        if retry_errors:
            done = done.filter(F.col("status") != "error")
        queue = queue.join(done.select(F.col("post_id").alias("id")), "id", "left_anti")
    bodies = posts.select("id", "raw_html", "is_deleted", "is_dead")
    return bodies.join(queue.select("id", "month"), "id").select("id", "month", "raw_html", "is_deleted", "is_dead")


def newest_first(queue: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest month first, then by id; posts without a month last. No or zero limit: all.

    The result is sorted for every limit. The limit is taken by position, counted per month and
    id range, so that no task holds all chosen posts.
    """
    order = (F.desc_nulls_last("month"), F.asc("id"))
    if not limit:
        return queue.orderBy(*order)
    counted = queue.withColumn("_one", F.lit(1).cast("long"))
    ranges = {"_month": F.coalesce("month", F.lit("")), "_range": id_range("id")}
    placed = running_total_before(
        counted, "_one", "_position", ranges, [F.col("id")], descending=["_month"]
    )
    return placed.filter(F.col("_position") < limit).drop("_position", "_one").orderBy(*order)
