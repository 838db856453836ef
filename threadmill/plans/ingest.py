"""Ingest: thread list, posts of unfetched threads, fetch marks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.merge import latest_per_key, mark_fetched, replace_on_key, upsert_threads
from ..operators.ordering import ID_RANGE, id_range, running_total_before
from ..operators.queue import thread_by_id, threads_of_kind, threads_to_fetch
from ..sources.landed import thread_hits, thread_posts, thread_stories, with_landing
from ..sources.snapshots import Snapshot, TableStore
from ..sources.tables import stage
from .stats import stats


def ingest_threads(threads: DataFrame, pages: DataFrame) -> DataFrame:
    """The thread table after a landed thread list. Of a thread listed twice the last one counts."""
    hits = latest_per_key(thread_hits(with_landing(pages)), ["id"], [F.desc("_landed")])
    return upsert_threads(threads, hits.drop("_landed"))


@dataclass(frozen=True)
class PostIngest:
    threads: DataFrame
    posts: DataFrame
    new_posts: DataFrame


def ingest_posts(
    threads: DataFrame,
    posts: DataFrame,
    items: DataFrame,
    run_ts: str,
    kind: str = "hiring",
    thread_id: int | None = None,
    force: bool = False,
) -> PostIngest:
    """Tables after landing the documents of the threads that are due.

    A single thread is taken whatever its kind, and added when the list lacks it.
    Documents of other threads are left alone. Of a post that landed twice the last one stays.
    """
    threads, new_posts = _landed_posts(threads, items, run_ts, kind, thread_id, force)
    return PostIngest(
        threads=threads,
        posts=replace_on_key(posts, new_posts, ["id"], "_landed"),
        new_posts=new_posts.drop("_landed"),
    )


def ingest_posts_into(
    store: TableStore,
    items: DataFrame,
    run_ts: str,
    kind: str = "hiring",
    thread_id: int | None = None,
    force: bool = False,
    ids_per_part: int = ID_RANGE,
) -> Snapshot:
    """The same for stored tables ``threads`` and ``posts``: only parts of the posts with landed ids are rewritten.

    The threads are marked after their posts are in; a failure between leaves them due.
    """
    threads, new_posts = _landed_posts(store.read("threads"), items, run_ts, kind, thread_id, force)
    threads = stage(threads, "threads")
    store_posts(store, new_posts, [F.desc("_landed")], ids_per_part)
    return store_threads(store, threads)


def store_posts(
    store: TableStore, posts: DataFrame, newest_first: Sequence[Column], ids_per_part: int = ID_RANGE
) -> Snapshot:
    """Merge posts by id. Ids grow with time, so new posts fall in the last parts."""
    return store.merge("posts", posts, ["id"], id_range("id", ids_per_part), newest_first)


def store_threads(store: TableStore, threads: DataFrame) -> Snapshot:
    """Threads are few: one part, replaced as a whole."""
    return store.merge("threads", threads, ["id"], F.lit("all"), [F.desc("fetched_at")])


def _landed_posts(
    threads: DataFrame, items: DataFrame, run_ts: str, kind: str, thread_id: int | None, force: bool
) -> tuple[DataFrame, DataFrame]:
    """Threads with the marks of this run, and the landed posts with ``_landed``."""
    items = with_landing(items)
    if thread_id is None:
        chosen = threads_of_kind(threads, kind)
    else:
        stories = thread_stories(items.filter(F.col("id") == thread_id))
        stories = stories.join(threads.select("id"), "id", "left_anti")
        newest = latest_per_key(stories, ["id"], [F.desc("_landed")])
        threads = upsert_threads(threads, newest.drop("_landed"))
        chosen = thread_by_id(threads, thread_id)
    due = threads_to_fetch(chosen, force).select("id")
    landed = items.join(due, "id", "left_semi")
    new_posts = thread_posts(landed, run_ts)
    fetched = landed.select("id").distinct().withColumn("fetched_at", F.lit(run_ts))
    return mark_fetched(threads, fetched), new_posts


def fetch_totals(new_posts: DataFrame, threads: DataFrame) -> DataFrame:
    """Posts per fetched thread, and the running total in the order of month and id."""
    counts = new_posts.groupBy("thread_id").agg(F.count("*").alias("n"))
    named = counts.join(threads.select(F.col("id").alias("thread_id"), "month"), "thread_id")
    ranges = {"_month": F.coalesce("month", F.lit("")), "_range": id_range("thread_id")}
    totals = running_total_before(named, "n", "_before", ranges, [F.col("thread_id")])
    return totals.select("thread_id", "month", "n", (F.col("_before") + F.col("n")).alias("running_total"))


def ingest_all(
    threads: DataFrame, posts: DataFrame, pages: DataFrame, items: DataFrame, run_ts: str
) -> tuple[PostIngest, DataFrame]:
    """Thread list, posts of the threads that are due, and the statistics after that.

    The new thread table is staged, since posts and statistics both start from it.
    """
    run = ingest_posts(stage(ingest_threads(threads, pages), "threads"), posts, items, run_ts)
    return run, stats(run.threads, run.posts)
