"""Published datasets: monthly series, leaderboards, comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.measures import percent, year_bucket
from ..operators.ordering import first_rows_per_group


def _count(weight: Column | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def technologies_per_month(technologies: DataFrame, weight: Column | None = None) -> DataFrame:
    return technologies.groupBy("month", "tech").agg(_count(weight).alias("n"))


def leaderboard(rows: DataFrame, key: str, k: int = 20, weight: Column | None = None) -> DataFrame:
    """The ``k`` most frequent values of every year with their rank; equal counts share a rank.

    Counts come first, so the ranking sees one row per year and value.
    """
    counts = (
        rows.filter(F.col(key).isNotNull())
        .groupBy(year_bucket(F.col("month")).alias("year"), F.col(key).alias("name"))
        .agg(_count(weight).alias("n"))
    )
    order = [F.desc("n"), F.asc("name")]
    first = first_rows_per_group(counts, ["year"], order, k, F.col("name"))
    place = F.rank().over(W.partitionBy("year").orderBy(F.desc("n")))
    return first.select("year", place.alias("place"), "name", "n")


def roles_per_month(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("month", "title_normalized").agg(F.count("*").alias("n"))


def remote_share(jobs: DataFrame) -> DataFrame:
    counts = jobs.groupBy("month").agg(
        F.count("*").alias("jobs"), F.count_if(F.col("workplace_policy") == "remote").alias("remote")
    )
    return counts.withColumn("pct", percent(F.col("remote"), F.col("jobs")))


def compare_technologies(
    technologies: DataFrame, names: Sequence[str], weight: Column | None = None
) -> DataFrame:
    """One row per month and one count column per technology, 0 where it is not named."""
    if not 2 <= len(names) <= 5:
        raise ValueError("compare 2 to 5 technologies")
    one = F.lit(1) if weight is None else weight
    counts = (F.coalesce(F.sum(F.when(F.col("tech") == n, one)), F.lit(0)).alias(n) for n in names)
    return technologies.groupBy("month").agg(*counts)


def export_json(dataset: DataFrame, path: str) -> None:
    dataset.write.mode("overwrite").json(path)
