"""Resumable ingest and extraction as streams over landed files.

Both write one partition of a log table per run and micro-batch; a run is a checkpoint. A
batch that is replayed after a failure overwrites its own partition, so nothing is counted
twice, and another checkpoint never touches it. The merged tables are the newest rows of the logs.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as V
from ..operators.infer import Extractor, prepare, run_extractor
from ..operators.merge import latest_per_key
from ..operators.queue import posts_to_extract
from ..schemas import LEDGER, LEDGER_LOG, POSTS, POSTS_LOG, THREAD_ITEMS
from ..sources.landed import thread_posts, with_file, with_landing
from ..sources.tables import append_batch
from .compaction import FAN, clear_merged, compact_log, read_log


def _start(stream: DataFrame, handle, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _run_id(spark: SparkSession) -> str:
    """Id of the query a batch belongs to: kept in its checkpoint, new with a new checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def ingest_stream(
    spark: SparkSession, landing: str, log: str, checkpoint: str, run_ts: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Posts of all thread documents that landed since the last run; of equal ids in a batch the last."""
    items = (
        spark.readStream.schema(THREAD_ITEMS).option("maxFilesPerTrigger", files_per_batch).json(landing)
    )

    def ingest_batch(landed: DataFrame, batch_id: int) -> None:
        posts = thread_posts(with_landing(landed), run_ts)
        newest = latest_per_key(posts, ["id"], [F.desc("_landed")])
        landed_at = F.col("_landed").cast(POSTS_LOG["landed"].dataType)
        newest = newest.withColumn("landed", landed_at).drop("_landed")
        append_batch(newest, log, batch_id, _run_id(landed.sparkSession))

    return _start(with_file(items), ingest_batch, checkpoint)


def extract_stream(
    spark: SparkSession,
    posts_log: str,
    threads: DataFrame,
    ledger_log: str,
    checkpoint: str,
    extractor: Extractor,
    prompt: str,
    run_ts: str,
    version: str = "v1",
    model: str = V.DEFAULT_MODEL,
    files_per_batch: int = 1000,
    sleep: Callable[[float], Any] = time.sleep,
) -> StreamingQuery:
    """Extraction of posts as they come in; posts the ledger already has are left out.

    Of the ledger log a batch reads the partitions of its version, and of their files those with
    ids between the smallest and the largest of the batch.
    """
    posts = (
        spark.readStream.schema(POSTS).option("maxFilesPerTrigger", files_per_batch).parquet(posts_log)
    )

    def extract_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = _run_id(session)
        newest = latest_per_key(with_landing(batch), ["id"], [F.desc("fetched_at"), F.desc("_landed")])
        low, high = batch.agg(F.min("id"), F.max("id")).first()
        # A replayed batch must not see its own earlier rows.
        own = (F.col("run") == run) & (F.col("batch_id") >= batch_id)
        done = read_log(session, ledger_log, LEDGER_LOG).filter(~own & F.col("post_id").between(low, high))
        queue = posts_to_extract(newest, threads, done, version)
        rows = run_extractor(prepare(queue), extractor, prompt, version, run_ts, model, sleep=sleep)
        rows = rows.withColumn("landed", F.lit(time.time_ns() // 1000))
        append_batch(rows, ledger_log, batch_id, run, ("prompt_version",))

    return _start(with_file(posts), extract_batch, checkpoint)


def _newest(seen: str):
    """Newest first. Runs may have the time of an earlier one: then what landed last is newer."""
    return [F.desc(seen), F.desc_nulls_last("landed"), F.desc("run"), F.desc("batch_id")]


def merged_posts(spark: SparkSession, log: str) -> DataFrame:
    """The posts table: of every post the row that landed last."""
    return latest_per_key(read_log(spark, log, POSTS_LOG), ["id"], _newest("fetched_at")).select(POSTS.names)


def merged_ledger(spark: SparkSession, log: str) -> DataFrame:
    """The ledger: of every post and version the last answer; of runs with one time the later run's."""
    keys = ["post_id", "prompt_version"]
    return latest_per_key(read_log(spark, log, LEDGER_LOG), keys, _newest("created_at")).select(LEDGER.names)


def compact_posts(spark: SparkSession, log: str, fan: int = FAN) -> int:
    return compact_log(spark, log, POSTS_LOG, ["id"], _newest("fetched_at"), fan)


def compact_ledger(spark: SparkSession, log: str, fan: int = FAN) -> int:
    return compact_log(spark, log, LEDGER_LOG, ["post_id", "prompt_version"], _newest("created_at"), fan)
