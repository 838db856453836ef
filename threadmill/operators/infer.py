"""Batch extraction through a callable the caller brings along."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions.answers import document_check
from ..functions.text import is_skipped, is_truncated, py_strip, truncate, with_plain_text
from ..schemas import LEDGER

# (text, prompt) -> (document, input tokens, output tokens); may raise.
Extractor = Callable[[str, str], tuple[dict[str, Any], int, int]]
# Returns the document as it is stored; raises for one that does not fit.
Check = Callable[[Any], dict[str, Any]]

_ANSWER = "raw_json string, input_tokens long, output_tokens long, status string, error string"


class RateLimited(Exception):
    """Raised by an extractor that was turned away; ``retry_after`` in seconds if known."""

    def __init__(self, message: str = "", retry_after: float | None = None):
        super().__init__(message)
        self.retry_after = retry_after


def attempt(
    extract: Extractor,
    text: str,
    prompt: str,
    sleep: Callable[[float], Any] = time.sleep,
    check: Check | None = None,
):
    """One ledger answer. Waits double from try to try; a failure is recorded, not raised.

    A turned-away call waits as long as it was told to, after the last try as well, and
    leaves no error text of its own. An answer that ``check`` raises for is a failed try.
    """
    wait, error = V.FIRST_BACKOFF_SECONDS, None
    for left in reversed(range(V.ATTEMPTS)):
        try:
            document, tokens_in, tokens_out = extract(text, prompt)
            if check is not None:
                document = check(document)
            return json.dumps(document), tokens_in, tokens_out, "ok", None
        except RateLimited as e:
            told = float(e.retry_after or wait)
            sleep(told)
            wait = max(2 * wait, told)
        except Exception as e:
            error = str(e)
            if left:
                sleep(wait)
                wait *= 2
    return "{}", None, None, "error", error


def prepare(queue: DataFrame) -> DataFrame:
    """id, text, skipped, truncated: the input of the model call, all but the last in the JVM."""
    texts = with_plain_text(queue.select("id", "is_deleted", "is_dead", "raw_html"), "raw_html")
    return texts.select(
        "id",
        is_skipped(F.col("text"), F.col("is_deleted"), F.col("is_dead")).alias("skipped"),
        is_truncated(F.col("text")).alias("truncated"),
        truncate(F.col("text")).alias("text"),
    )


def run_extractor(
    prepared: DataFrame,
    extract: Extractor,
    prompt: str,
    version: str,
    run_ts: str,
    model: str = V.DEFAULT_MODEL,
    partitions: int | None = None,
    sleep: Callable[[float], Any] = time.sleep,
    check: Check | None = document_check(),
) -> DataFrame:
    """Ledger rows for prepared posts; skipped posts get theirs without a call.

    Only answers that pass ``check`` are ``ok``; one that fails uses up a try, and after the last
    the row is an ``error`` with what is wrong. ``None`` takes any answer. ``partitions`` spreads the calls evenly over that many tasks. The number of tasks
    running at a time, and with it of concurrent calls, is the number of executor cores.
    """
    rows = prepared.select("id", F.when(~F.col("skipped"), F.col("text")).alias("text"))
    if partitions:
        rows = rows.repartition(partitions)

    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                ("{}", None, None, "skipped_empty", None)
                if text is None
                else attempt(extract, text, prompt, sleep, check)
                for text in batch["text"]
            ]
            answer = pd.DataFrame(
                found, columns=["raw_json", "input_tokens", "output_tokens", "status", "error"]
            ).astype({"input_tokens": "Int64", "output_tokens": "Int64"})
            answer.insert(0, "id", batch["id"].to_numpy())
            yield answer

    ledger = rows.mapInPandas(answers, f"id long, {_ANSWER}").select(
        F.col("id").alias("post_id"),
        F.lit(version).alias("prompt_version"),
        F.lit(V.SCHEMA_VERSION).alias("schema_version"),
        F.lit(model).alias("model"),
        "raw_json", "input_tokens", "output_tokens", "status", "error",
        F.lit(run_ts).alias("created_at"),
    )
    return ledger.select(LEDGER.names)


def extract_documents(
    posts: DataFrame,
    extract: Extractor,
    prompt: str,
    sleep: Callable[[float], Any] = time.sleep,
    check: Check | None = document_check(),
) -> DataFrame:
    """(post_id, raw_json) for evaluation: never part of the ledger.

    Whole texts, no gate on flags and a single try; short texts, failures and answers that do not
    pass ``check`` give ``{}``.
    """
    texts = with_plain_text(posts.select("id", "raw_html"), "raw_html").select(
        "id", F.when(F.length(py_strip(F.col("text"))) >= V.MIN_TEXT_CHARS, F.col("text")).alias("text")
    )

    def one(text: str | None) -> str:
        try:
            if text is None:
                return "{}"
            document = extract(text, prompt)[0]
            return json.dumps(document if check is None else check(document))
        except Exception:
            return "{}"

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"post_id": batch["id"], "raw_json": [one(t) for t in batch["text"]]})

    return texts.mapInPandas(documents, "post_id long, raw_json string")


def run_counters(rows: DataFrame) -> DataFrame:
    """Totals of one run, over its written ledger rows."""
    return rows.agg(
        F.count("*").alias("n"),
        *(F.count_if(F.col("status") == s).alias(s) for s in V.LEDGER_STATUSES),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
    )


def error_rate(rows: DataFrame) -> DataFrame:
    """Share of failed posts, skipped ones included in the base, and whether it is too high."""
    rate = F.col("errors") / F.greatest("n", F.lit(1))
    return rows.agg(
        F.count_if(F.col("status") == "error").alias("errors"), F.count("*").alias("n")
    ).select("errors", "n", rate.alias("error_rate"), (rate > V.MAX_ERROR_RATE).alias("failed"))
