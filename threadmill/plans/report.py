"""Reports over the normalized tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.measures import null_label, percent
from ..functions.text import py_strip
from ..operators.ordering import top_counts
from ..sources.tables import stage
from .stats import with_level


def of_version(df: DataFrame, version: str) -> DataFrame:
    return df.filter(F.col("prompt_version") == version)


def with_share(counts: DataFrame) -> DataFrame:
    """Add ``pct`` of the total. The window runs over grouped rows, one per value."""
    return counts.withColumn("pct", percent(F.col("n"), F.sum("n").over(W.partitionBy())))


def ledger_status(ledger: DataFrame, version: str = "v1") -> DataFrame:
    return of_version(ledger, version).groupBy("status").agg(F.count("*").alias("n"))


def post_types(classification: DataFrame, version: str = "v1") -> DataFrame:
    return with_share(top_counts(of_version(classification, version), "post_type"))


def jobs_total(jobs: DataFrame, version: str = "v1") -> DataFrame:
    return of_version(jobs, version).agg(F.count("*").alias("jobs"))


def salary_coverage(jobs: DataFrame, version: str = "v1") -> DataFrame:
    """Jobs with a minimum salary; a maximum alone does not count."""
    counts = of_version(jobs, version).agg(
        F.count("*").alias("jobs"), F.count("salary_min").alias("with_salary")
    )
    return counts.withColumn("pct", percent(F.col("with_salary"), F.col("jobs")))


def visa_sponsorship(jobs: DataFrame, version: str = "v1") -> DataFrame:
    counts = with_share(top_counts(of_version(jobs, version), "visa_sponsorship"))
    return counts.select(null_label(F.col("visa_sponsorship")).alias("visa_sponsorship"), "n", "pct")


def of_jobs(rows: DataFrame, jobs: DataFrame, version: str = "v1") -> DataFrame:
    """Rows of a job-level table whose job is in this version; rows without a job drop out.

    Only needed for tables that lack a ``prompt_version`` of their own.
    """
    ids = of_version(jobs, version).select("job_id")
    return rows.join(ids, "job_id", "left_semi")


def top_technologies(
    technologies: DataFrame, k: int | None = 20, weight: Column | None = None
) -> DataFrame:
    return top_counts(technologies, "tech", k, weight)


def top_technologies_by_post(technologies: DataFrame, k: int | None = 20) -> DataFrame:
    """Variant that counts every post once per technology, however many roles it has."""
    once = technologies.select("post_id", "tech").distinct()
    return top_counts(once, "tech", k)


def top_cities(locations: DataFrame, k: int | None = 20, weight: Column | None = None) -> DataFrame:
    return top_counts(locations.filter(F.col("city").isNotNull()), "city", k, weight)


def top_titles(jobs: DataFrame, version: str = "v1", k: int | None = 10) -> DataFrame:
    titled = of_version(jobs, version).filter(F.col("title_normalized").isNotNull())
    return top_counts(titled, "title_normalized", k)


def jobs_per_month(jobs: DataFrame, version: str = "v1") -> DataFrame:
    months = of_version(jobs, version).groupBy("month").agg(F.count("*").alias("n"))
    return with_level(months).orderBy("month")


def unmapped_as_written(
    technologies: DataFrame, k: int | None = 20, weight: Column | None = None
) -> DataFrame:
    return top_counts(technologies.filter("aliased = 0"), "tech_raw", k, weight)


def unmapped_cleaned(
    technologies: DataFrame, k: int | None = 20, weight: Column | None = None
) -> DataFrame:
    unmapped = technologies.filter("aliased = 0").withColumn("cleaned", F.lower(py_strip(F.col("tech_raw"))))
    return top_counts(unmapped, "cleaned", k, weight)


def _first(counts: DataFrame, k: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), F.asc("key")).limit(k)


def report(
    ledger: DataFrame,
    classification: DataFrame,
    jobs: DataFrame,
    locations: DataFrame,
    technologies: DataFrame,
    version: str = "v1",
) -> DataFrame:
    """All sections in one long table: section, key, n, pct.

    Every table is read once for its counts: the jobs sections come from one pass with
    grouping sets, and so do the two technology sections. These counts are staged, and the
    sections read the files. Without ledger rows of the
    version the result is empty, as the tables hold nothing of that version.
    """

    def section(name: str, rows: DataFrame, pct: Column | None = None) -> DataFrame:
        share = F.lit(None).cast("double") if pct is None else pct
        return rows.select(F.lit(name).alias("section"), F.col("key"), F.col("n"), share.alias("pct"))

    def share(total: str) -> Column:
        return percent(F.col("n"), F.col(total))

    status = ledger_status(ledger, version).withColumnRenamed("status", "key")
    types = post_types(classification, version).withColumnRenamed("post_type", "key")

    title, month, visa = (F.col(c) for c in ("title_normalized", "month", "visa_sponsorship"))
    counted = (
        of_version(jobs, version)
        .groupingSets([[title], [month], [visa], []], title, month, visa)
        .agg(
            F.grouping_id().alias("_set"),
            F.count("*").alias("n"),
            F.count("salary_min").alias("with_salary"),
        )
    )
    counted = stage(counted, "job-counts")
    # Bits of the set, left to right: title, month, visa; 0 marks the grouped column.
    everything = counted.filter((F.col("_set") == 7) & (F.col("n") > 0)).withColumn("jobs", F.col("n"))
    by_title = counted.filter((F.col("_set") == 3) & title.isNotNull()).withColumn("key", title)
    by_month = counted.filter(F.col("_set") == 5).withColumn("key", month)
    by_visa = counted.filter(F.col("_set") == 6).withColumn("key", null_label(visa))
    by_visa = by_visa.withColumn("jobs", F.sum("n").over(W.partitionBy()))

    tech, raw, aliased = F.col("tech"), F.col("tech_raw"), F.col("aliased")
    named = (
        of_version(technologies, version)
        .groupingSets([[tech], [raw, aliased]], tech, raw, aliased)
        .agg(F.grouping_id().alias("_set"), F.count("*").alias("n"))
    )
    named = stage(named, "technology-counts")
    by_tech = named.filter(F.col("_set") == 3).withColumn("key", tech)
    unmapped = named.filter((F.col("_set") == 4) & (aliased == 0)).withColumn("key", raw)
    cities = top_cities(of_version(locations, version)).withColumnRenamed("city", "key")

    parts = [
        section("extraction_status", status),
        section("post_type", types, F.col("pct")),
        section("jobs", everything.withColumn("key", F.lit("total"))),
        section(
            "jobs",
            everything.withColumn("key", F.lit("with_salary")).withColumn("n", F.col("with_salary")),
            share("jobs"),
        ),
        section("visa_sponsorship", by_visa, share("jobs")),
        section("technology", _first(by_tech, 20)),
        section("city", cities),
        section("title", _first(by_title, 10)),
        section("month", by_month),
        section("unmapped_technology", _first(unmapped, 20)),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
