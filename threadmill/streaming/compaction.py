"""Logs of stream batches and their compaction in tiers.

A log has one partition per run and batch. When enough batches have come together, their rows are
merged by key into one part of the first tier; when a tier has enough parts, these become one
part of the next. A state file names the parts and the last merged batch of every run: readers take the parts and
the batches after those. Merged batches stay in place for streams that read the log until they are cleared.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.merge import latest_per_key
from ..sources.manifest import StateLog
from ..sources.tables import read_or_empty

_BATCH = [StructField("run", StringType()), StructField("batch_id", LongType())]
_EMPTY = {"parts": [], "merged": {}}
#: So many batches, or parts of a tier, are merged into one.
FAN = 8


def _states(spark: SparkSession, log: str) -> StateLog:
    # Folders with an underscore are no part of the log for Spark's readers.
    return StateLog(spark, f"{log.rstrip('/')}/_states")


def _after(merged: dict[str, int]) -> Column:
    """Batches that no part holds, as a condition on the partition columns alone."""
    if not merged:
        return F.lit(True)
    last = F.create_map(*(F.lit(v) for run in sorted(merged) for v in (run, int(merged[run]))))
    return F.col("batch_id") > F.coalesce(F.try_element_at(last, F.col("run")), F.lit(-1))


def _live_batches(spark: SparkSession, log: str, schema: StructType, merged: dict[str, int]) -> DataFrame:
    return read_or_empty(spark, log, StructType([*schema.fields, *_BATCH])).filter(_after(merged))


def _parts(spark: SparkSession, log: str, schema: StructType, parts: Sequence[dict[str, Any]]) -> DataFrame:
    folders = [f"{log.rstrip('/')}/_parts/{p['folder']}" for p in parts]
    return spark.read.schema(StructType([*schema.fields, *_BATCH])).parquet(*folders)


def read_log(spark: SparkSession, log: str, schema: StructType) -> DataFrame:
    """Rows of a log with ``run`` and ``batch_id``; an empty table where there is none yet.

    Of merged batches only the rows that were newest of their key are left.
    """
    _, state = _states(spark, log).load()
    state = state or _EMPTY
    live = _live_batches(spark, log, schema, state["merged"])
    return live.unionByName(_parts(spark, log, schema, state["parts"])) if state["parts"] else live


def compact_log(
    spark: SparkSession,
    log: str,
    schema: StructType,
    keys: Sequence[str],
    newest_first: Sequence[Column],
    fan: int = FAN,
) -> int:
    """Merge batches, and parts of a tier, where ``fan`` or more of them are there; the parts after that.

    A read then opens fewer than ``fan`` batches and fewer than ``fan`` parts of every tier, and a row is
    rewritten once per tier. ``newest_first`` must order rows of all runs. To be called when no batch is being
    written. After a failure, or if another compaction came first, the log reads as before.
    """
    states = _states(spark, log)
    number, state = states.load()
    state = state or _EMPTY
    parts, merged = list(state["parts"]), dict(state["merged"])
    ends = _live_batches(spark, log, schema, merged).select("run", "batch_id").distinct()
    ends = ends.groupBy("run").agg(F.max("batch_id").alias("last"), F.count("*").alias("n")).collect()
    changed = sum(r["n"] for r in ends) >= fan
    if changed:
        rows = _live_batches(spark, log, schema, merged)
        parts.append(_merged(rows, log, keys, newest_first, 1))
        merged |= {r["run"]: r["last"] for r in ends}
    tier = 1
    while any(p["tier"] >= tier for p in parts):
        of_tier = [p for p in parts if p["tier"] == tier]
        if len(of_tier) >= fan:
            one = _merged(_parts(spark, log, schema, of_tier), log, keys, newest_first, tier + 1)
            parts = [p for p in parts if p["tier"] != tier] + [one]
            changed = True
        tier += 1
    if changed:
        states.store(number, {"parts": parts, "merged": merged})
    return len(parts)


def _merged(rows: DataFrame, log: str, keys: Sequence[str], newest_first: Sequence[Column], tier: int) -> dict[str, Any]:
    folder = uuid.uuid4().hex
    latest_per_key(rows, keys, newest_first).write.parquet(f"{log.rstrip('/')}/_parts/{folder}")
    return {"folder": folder, "tier": tier}


def clear_merged(spark: SparkSession, log: str) -> int:
    """Delete batches and parts that later parts have replaced; their number.

    To be called when no stream that reads the log is behind them, and no reader has an older state.
    """
    states = _states(spark, log)
    _, state = states.load()
    state = state or _EMPTY
    files = StateLog(spark, log)
    used = {p["folder"] for p in state["parts"]}
    gone = [("_parts", name) for name in files.list("_parts") if name not in used]
    gone += _merged_batches(files, (), state["merged"], None)
    for names in gone:
        files.delete(*names)
    return len(gone)


def _merged_batches(files: StateLog, under: tuple[str, ...], merged: dict[str, int], run: str | None):
    """Folders of merged batches; a run may lie below other partition columns."""
    found = []
    for name in files.list(*under):
        key, _, value = name.partition("=")
        if key == "batch_id" and run in merged and int(value) <= merged[run]:
            found.append((*under, name))
        elif value and key != "batch_id" and not name.startswith("_"):
            found += _merged_batches(files, (*under, name), merged, value if key == "run" else run)
    return found
