"""Stored tables: reading, writing, batch logs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_SCRATCH_KEY = "spark.checkpoint.dir"
_local_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``.

    Where the setting is missing a local session gets one temporary folder per application;
    on a cluster that would not be shared, so the call fails there.
    """
    base = spark.conf.get(_SCRATCH_KEY, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"{_SCRATCH_KEY} is not set to a folder shared by the cluster")
        application = spark.sparkContext.applicationId
        if application not in _local_scratch:
            _local_scratch[application] = tempfile.mkdtemp(prefix="threadmill-")
        base = _local_scratch[application]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Everything built on the result starts from files, so neither a second action nor a
    lost executor repeats the work before it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a whole table. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Replace those partitions ``df`` has rows for, and leave the others."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append_durably(df: DataFrame, path: str) -> None:
    """Append ``df`` such that the rows of every finished task stay, whatever becomes of the job.

    A task moves its file into the table when it commits, not when the job does. A failed job
    leaves what its finished tasks wrote, and a task that is run again after that may leave
    its rows twice: readers take one row per key. Needs a file system that renames files.
    """
    df.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table with this schema; without rows where there is no such folder yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def keep_schema(df: DataFrame, path: str, partition_by: str) -> None:
    """Leave a file without rows in a partitioned table that has no file, so that it can be read."""
    try:
        df.sparkSession.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        folder = f"{path.rstrip('/')}/{partition_by}=__HIVE_DEFAULT_PARTITION__"
        df.sparkSession.createDataFrame([], df.drop(partition_by).schema).write.mode("overwrite").parquet(folder)


def append_batch(
    df: DataFrame, path: str, batch_id: int, run: str = "0", partition_by: tuple[str, ...] = ()
) -> None:
    """Add one batch of a run to a log table; a replayed batch overwrites only itself.

    ``run`` names the stream that counts the batches: two streams never share a partition. A
    merge by key costs the size of the batch this way. ``merge.latest_per_key`` over the log,
    newest rows first, gives the merged table.
    """
    batch = df.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
    replace_partitions(batch, path, (*partition_by, "run", "batch_id"))


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Catalog table bucketed and sorted by ``key``.

    With posts by ``id`` and the ledger by ``post_id`` in the same number of buckets,
    joining them moves no rows.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
