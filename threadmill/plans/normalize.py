"""Normalization: ledger documents -> jobs, locations, technologies, classifications."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..operators import documents as D
from ..sources.dims import Dimensions
from ..sources.snapshots import Snapshot, TableStore
from ..sources.tables import keep_schema, replace_partitions, replace_table, stage


@dataclass(frozen=True)
class NormalizedTables:
    jobs: DataFrame
    job_locations: DataFrame
    job_technologies: DataFrame
    post_classification: DataFrame

    def items(self):
        return vars(self).items()


def normalize(
    ledger: DataFrame,
    posts: DataFrame,
    threads: DataFrame,
    dims: Dimensions,
    version: str = "v1",
    region_rules: Mapping[str, Sequence[str]] = V.REMOTE_REGION_RULES,
    only_job_postings: bool = False,
    staged: bool = True,
) -> NormalizedTables:
    """The four tables of one prompt version, with dense job ids.

    Documents are decoded once and staged, and staged again with their ids, so that the
    ids are counted once and the four tables are plain passes over files.
    """
    decoded = D.decoded_posts(D.extracted_posts(ledger, posts, threads, version))
    if staged:
        decoded = stage(decoded, "decoded")
    return tables_from(decoded, dims, region_rules, only_job_postings, staged)


def tables_from(
    decoded: DataFrame,
    dims: Dimensions,
    region_rules: Mapping[str, Sequence[str]] = V.REMOTE_REGION_RULES,
    only_job_postings: bool = False,
    staged: bool = False,
) -> NormalizedTables:
    if only_job_postings:
        # Other posts stay for the classification, but take no ids.
        n_jobs = F.when(D.post_type() == "job_posting", F.col("n_jobs")).otherwise(0)
        decoded = decoded.withColumn("n_jobs", n_jobs)
    classified = D.with_first_job_id(decoded)
    if staged:
        classified = stage(classified, "numbered")
    numbered = classified.filter("n_jobs > 0") if only_job_postings else classified
    return NormalizedTables(
        jobs=D.jobs(numbered, dims, region_rules),
        job_locations=D.job_locations(numbered, dims),
        job_technologies=D.job_technologies(numbered, dims),
        post_classification=D.post_classification(classified),
    )


def write_tables(tables: NormalizedTables, folder: str, keep_other_versions: bool = False) -> None:
    """Replace the four tables; only this version is left unless the others are kept.

    They are partitioned by ``prompt_version`` either way, so both calls can be mixed.
    """
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        if keep_other_versions:
            replace_partitions(df, path, ("prompt_version",))
        else:
            replace_table(df, path, ("prompt_version",))
        keep_schema(df, path, "prompt_version")


def publish_tables(tables: NormalizedTables, store: TableStore, keep_versions: Sequence[str] | None = ()) -> Snapshot:
    """Replace the four tables in one step; until its end, and after a failure, readers see the old ones.

    Other versions are dropped but for those in ``keep_versions`` (``None``: all), whose files stay where
    they are.
    """
    return store.replace(dict(tables.items()), "prompt_version", keep_versions)
