"""Extraction: queue, gate, model calls, ledger, counters."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from ..functions.measures import token_cost
from ..functions.answers import document_check
from ..operators.infer import Check, Extractor, error_rate, prepare, run_counters, run_extractor
from ..operators.merge import latest_per_key, replace_on_key
from ..operators.ordering import ID_RANGE, id_range
from ..operators.queue import newest_first, posts_to_extract
from ..schemas import LEDGER
from ..sources.snapshots import Snapshot, TableStore
from ..sources.tables import append_durably, read_or_empty, stage

_KEY = ["post_id", "prompt_version"]


class TooManyErrors(RuntimeError):
    """The share of failed posts of a run is over the allowed rate."""


@dataclass(frozen=True)
class Extraction:
    rows: DataFrame
    ledger: DataFrame
    counters: DataFrame


def extract(
    posts: DataFrame,
    threads: DataFrame,
    ledger: DataFrame,
    extractor: Extractor,
    prompt: str,
    run_ts: str,
    version: str = "v1",
    model: str = V.DEFAULT_MODEL,
    month: str | None = None,
    limit: int | None = None,
    force: bool = False,
    retry_errors: bool = False,
    partitions: int | None = None,
    sleep: Callable[[float], Any] = time.sleep,
    check: Check | None = document_check(),
    journal: str | None = None,
    calls_per_commit: int = 200,
) -> Extraction:
    """Run the extractor over the queue; rows of the run, the new ledger, and counters.

    The rows are written to the scratch folder first: counters and ledger read them
    back, and no model call is made twice for them. With ``journal``, a folder of this run, they are
    written there in chunks of ``calls_per_commit`` posts, and a chunk counts as soon as it is written: after a
    failure the same call goes on with the posts that no finished chunk has. Errors count as answers, too.
    """
    queue = posts_to_extract(posts, threads, ledger, version, month, force, retry_errors)
    if limit:
        queue = newest_first(queue, limit)

    def answers(rows: DataFrame, tasks: int | None) -> DataFrame:
        return run_extractor(prepare(rows), extractor, prompt, version, run_ts, model, tasks, sleep, check)

    if journal is None:
        rows = stage(answers(queue, partitions), "extraction")
    else:
        done = journal_rows(queue.sparkSession, journal).select(F.col("post_id").alias("id"))
        left = stage(queue.join(done, "id", "left_anti"), "queue")
        chunks = -(-left.count() // calls_per_commit)
        if chunks:
            append_durably(answers(left, max(chunks, partitions or 1)), journal)
        rows = journal_rows(queue.sparkSession, journal)
    return Extraction(
        rows=rows,
        ledger=replace_on_key(ledger, rows, _KEY, "created_at"),
        counters=run_counters(rows),
    )


def journal_rows(spark: SparkSession, journal: str) -> DataFrame:
    """Answers of all finished chunks of a run, one per post: a chunk that ran twice counts once."""
    return latest_per_key(read_or_empty(spark, journal, LEDGER), _KEY, [F.desc("created_at"), F.asc("status")])


def store_answers(store: TableStore, rows: DataFrame, ids_per_part: int = ID_RANGE) -> Snapshot:
    """Merge ledger rows into the stored table ``ledger`` by post and version.

    Parts are versions and ranges of posts; of a version that a run does not touch no file is read or written.
    """
    part = F.concat_ws("-", "prompt_version", id_range("post_id", ids_per_part))
    return store.merge("ledger", rows, _KEY, part, [F.desc("created_at")])


def check_error_rate(rows: DataFrame) -> None:
    """Raise when more than 5 % of a run failed. Brings one row to the driver."""
    rate = error_rate(rows).first()
    if rate["failed"]:
        raise TooManyErrors(f"{rate['errors']} of {rate['n']} posts failed")


def with_cost(counters: DataFrame, prices: DataFrame) -> DataFrame:
    """Add ``cost`` in USD to rows with a model and token counts; unknown models cost 0."""
    return (
        counters.join(prices, "model", "left")
        .withColumn(
            "cost",
            token_cost(
                F.col("input_tokens"), F.col("output_tokens"), F.col("input_per_1m"), F.col("output_per_1m")
            ),
        )
        .drop("input_per_1m", "output_per_1m")
    )


def ledger_cost(ledger: DataFrame, prices: DataFrame) -> DataFrame:
    """Tokens and cost per version and model."""
    tokens = ledger.groupBy("prompt_version", "model").agg(
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
    )
    return with_cost(tokens, prices)


def dry_run(queue: DataFrame, prices: DataFrame, model: str = V.DEFAULT_MODEL) -> DataFrame:
    """Posts in the queue and what extracting them will cost, without a call."""
    n = queue.agg(F.count("*").alias("posts")).select(
        F.lit(model).alias("model"),
        "posts",
        (F.col("posts") * V.DRY_RUN_INPUT_TOKENS).alias("input_tokens"),
        (F.col("posts") * V.DRY_RUN_OUTPUT_TOKENS).alias("output_tokens"),
    )
    return with_cost(n, prices)
