"""Landed JSON payloads: thread lists, thread documents, the golden set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pyspark.errors import AnalysisException

from ..functions.text import is_blank
from ..functions.titles import classify_kind, month_prefix, parse_month
from ..schemas import GOLDEN, THREAD_ITEMS, THREAD_PAGES


def read_thread_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the thread list, one JSON document per line."""
    return spark.read.schema(THREAD_PAGES).json(path)


def read_thread_items(spark: SparkSession, path: str) -> DataFrame:
    """Thread documents with their children, one JSON document per line."""
    return spark.read.schema(THREAD_ITEMS).json(path)


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GOLDEN).json(path)


def with_landing(df: DataFrame) -> DataFrame:
    """Add ``_landed``, which sorts rows as they came in: by time and name of the file, then place.

    Batches of a stream bring the file along, see ``with_file``. Frames that are not read from
    files are taken in the order of their rows.
    """
    if "_landed" in df.columns:
        return df
    if "_file" not in df.columns:
        try:
            df = with_file(df)
        except AnalysisException:
            df = df.withColumn("_file", F.lit(None).cast("string"))
    landed = F.struct("_file", F.monotonically_increasing_id().alias("place"))
    return df.withColumn("_landed", landed).drop("_file")


def with_file(df: DataFrame) -> DataFrame:
    """Add ``_file``: time, name and part of the file each row is read from; also for streams."""
    parts = ("file_modification_time", "file_path", "file_block_start")
    return df.select("*", F.struct(*(F.col(f"_metadata.{p}") for p in parts)).alias("_file"))


def _or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def thread_columns(df: DataFrame) -> DataFrame:
    title, created_at = F.col("title"), F.col("created_at")
    return df.select(
        "id",
        title,
        classify_kind(title).alias("kind"),
        parse_month(title, month_prefix(created_at)).alias("month"),
        created_at,
        "num_comments",
        *(c for c in df.columns if c == "_landed"),
    )


def thread_hits(pages: DataFrame) -> DataFrame:
    """One row per listed thread, and ``_landed`` with its place if the pages have it."""
    landed = "_landed" in pages.columns
    hits = pages.select(*["_landed"] * landed, F.posexplode("hits").alias("_pos", "hit")).select(
        *[F.struct("_landed", "_pos").alias("_landed")] * landed,
        F.col("hit.objectID").cast("long").alias("id"),
        _or_empty(F.col("hit.title")).alias("title"),
        _or_empty(F.col("hit.created_at")).alias("created_at"),
        F.col("hit.num_comments").alias("num_comments"),
    )
    return thread_columns(hits)


def thread_stories(items: DataFrame) -> DataFrame:
    """Thread rows taken from thread documents: for threads that are not listed yet."""
    stories = items.select(
        "id",
        _or_empty(F.col("title")).alias("title"),
        _or_empty(F.col("created_at")).alias("created_at"),
        "num_comments",
        *(c for c in items.columns if c == "_landed"),
    )
    return thread_columns(stories)


def thread_posts(items: DataFrame, run_ts: str | Column) -> DataFrame:
    """Top-level children as posts. Null children are dropped, deleted and dead ones kept.

    Items with ``_landed`` give posts with it, which sorts them by document and place in it.
    """
    landed = "_landed" in items.columns
    fetched_at = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    children = items.select(
        *["_landed"] * landed, F.col("id").alias("thread_id"), F.posexplode("children").alias("_pos", "c")
    )

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False)).cast("int")

    return children.filter(F.col("c").isNotNull()).select(
        F.col("c.id").alias("id"),
        "thread_id",
        F.col("c.author").alias("author"),
        F.when(is_blank(F.col("c.created_at")), fetched_at)
        .otherwise(F.col("c.created_at"))
        .alias("created_at"),
        F.col("c.text").alias("raw_html"),
        flag("c.deleted").alias("is_deleted"),
        flag("c.dead").alias("is_dead"),
        fetched_at.alias("fetched_at"),
        *[F.struct("_landed", "_pos").alias("_landed")] * landed,
    )
