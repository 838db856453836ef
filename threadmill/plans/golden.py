"""Golden set: stratified sample, label files, accuracy."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import fixed_values as V
from ..functions.measures import year_bucket
from ..functions.text import py_strip
from ..operators.documents import decodable
from ..operators.infer import Extractor, extract_documents
from ..operators.ordering import first_rows_per_group, sample_key
from ..schemas import DOCUMENT
from ..sources.tables import stage

ACCURACY_FIELDS = (
    "post_type", "company_name", "workplace_policy", "visa_sponsorship",
    "salary_min", "salary_max", "roles_count", "title_guess",
)


def golden_pool(posts: DataFrame, threads: DataFrame) -> DataFrame:
    """Posts that may be labelled: of hiring threads, alive, with more than a line of HTML."""
    alive = posts.filter(
        (F.col("is_deleted") == 0)
        & (F.col("is_dead") == 0)
        & (F.length("raw_html") > V.MIN_GOLDEN_HTML_CHARS)
    )
    hiring = threads.filter(F.col("kind") == "hiring").select(F.col("id").alias("thread_id"), "month")
    return alive.join(hiring, "thread_id").select("id", "month", "raw_html")


def stratified_ids(pool: DataFrame, n: int, seed: str = "") -> DataFrame:
    """(id, month, year): at most ``max(1, n // years)`` posts per year, ``n`` in all.

    A year with fewer posts is not made up for by others. The random order is that of a
    hash, so the sample is the same every time. The pool is read once: the first ``n`` of every year
    are kept, and these few rows tell the number of years.
    """
    keyed = pool.select(
        "id", "month", year_bucket(F.col("month")).alias("year"), sample_key(F.col("id"), seed).alias("_key")
    )
    order = [F.col("_key"), F.col("id")]
    kept = first_rows_per_group(keyed, ["year"], order, max(1, n), F.col("id"))
    years = F.size(F.collect_set("year").over(W.partitionBy(F.lit(0))))
    chosen = kept.withColumn("_years", years).filter(F.col("rank") <= F.greatest(F.lit(1), F.floor(F.lit(n) / F.col("_years"))))
    return chosen.orderBy(*order).limit(n).select("id", "month", "year")


def stratified_sample(pool: DataFrame, n: int = 30, seed: str = "") -> DataFrame:
    """The sampled posts with their HTML, fetched for the chosen ids only."""
    ids = stratified_ids(pool, n, seed)
    return pool.join(ids.select("id", "year"), "id")


def golden_skeletons(
    sample: DataFrame, existing: DataFrame, extractor: Extractor, prompt: str
) -> DataFrame:
    """Label records for sampled posts that have none: expected starts as the model output.

    The outputs are staged, so that a second action on the result makes no second call.
    """
    new = sample.join(existing.select(F.col("post_id").alias("id")), "id", "left_anti")
    outputs = stage(decodable(extract_documents(new, extractor, prompt)), "outputs")
    return new.join(outputs, new["id"] == outputs["post_id"]).select(
        "post_id", "month", "raw_html", F.col("doc").alias("llm_output"), F.col("doc").alias("expected")
    )


def append_skeletons(skeletons: DataFrame, path: str) -> None:
    """Add label records as JSON, one per line; existing files stay as they are."""
    skeletons.write.mode("append").option("ignoreNullFields", "false").json(path)


def labelled(golden: DataFrame, include_unchanged: bool = False) -> DataFrame:
    """Records whose expected document is filled in and differs from the model output."""
    empty = F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in DOCUMENT))
    filled = golden.filter(F.col("expected").isNotNull() & ~F.col("expected").eqNullSafe(empty))
    if include_unchanged:
        return filled
    return filled.filter(~F.col("expected").eqNullSafe(F.col("llm_output")))


def predict(golden: DataFrame, extractor: Extractor, prompt: str) -> DataFrame:
    """(post_id, prediction) for golden posts; staged, so that every model call is made once."""
    posts = golden.select(F.col("post_id").alias("id"), "raw_html")
    return stage(decodable(extract_documents(posts, extractor, prompt)), "predictions").withColumnRenamed(
        "doc", "prediction"
    )


def _compared(doc: str) -> dict[str, Column]:
    """The compared values, as the document has them: only the first role, nothing normalized."""
    role = F.try_element_at(f"{doc}.roles", F.lit(1))
    return {
        "post_type": F.col(f"{doc}.post_type"),
        "company_name": F.col(f"{doc}.company.name"),
        "workplace_policy": F.col(f"{doc}.workplace.policy"),
        "visa_sponsorship": F.col(f"{doc}.visa_sponsorship"),
        "salary_min": role["salary"]["min"],
        "salary_max": role["salary"]["max"],
        "roles_count": F.greatest(F.coalesce(F.size(f"{doc}.roles"), F.lit(0)), F.lit(1)),
        "title_guess": role["title_guess"],
    }


def canonical_tech(names: Column, aliases: dict[str, str] | None = None) -> Column:
    """Distinct canonical names of a technology list.

    The list is mapped in place with a literal map, so a record stays one row. The map is
    written as JSON, which is folded into a literal when the query is planned.
    """
    table = F.from_json(F.lit(json.dumps(aliases or V.TECH_ALIASES)), "map<string, string>")

    def canonical(name: Column) -> Column:
        cleaned = F.lower(py_strip(name))
        return F.coalesce(F.try_element_at(table, cleaned), cleaned)

    return F.array_distinct(F.transform(F.coalesce(names, F.array().cast("array<string>")), canonical))


def scored(
    golden: DataFrame,
    predictions: DataFrame,
    aliases: dict[str, str] | None = None,
    keys: Sequence[str] = ("post_id",),
) -> DataFrame:
    """Per record: a match flag for every field, and technology precision and recall.

    Records without a prediction are compared with an empty one. Two missing values match.
    """
    pairs = golden.join(predictions, list(keys), "left")
    got, want = _compared("prediction"), _compared("expected")
    sets = pairs.select(
        *keys,
        *(got[f].eqNullSafe(want[f]).cast("double").alias(f) for f in ACCURACY_FIELDS),
        canonical_tech(F.col("prediction.technologies_raw"), aliases).alias("_got"),
        canonical_tech(F.col("expected.technologies_raw"), aliases).alias("_want"),
    )
    common = F.size(F.array_intersect("_got", "_want"))
    both_empty = (F.size("_got") == 0) & (F.size("_want") == 0)

    def ratio(of: str) -> Column:
        return F.when(both_empty, 1.0).otherwise(common / F.greatest(F.size(of), F.lit(1)))

    return sets.select(
        *keys,
        *ACCURACY_FIELDS,
        ratio("_got").alias("tech_precision"),
        ratio("_want").alias("tech_recall"),
    )


def accuracy(scores: DataFrame, version: str = "v1") -> DataFrame:
    """(prompt_version, field, score, n): means over the scored records."""
    fields = (*ACCURACY_FIELDS, "tech_precision", "tech_recall")
    means = scores.agg(F.count("*").alias("n"), *(F.avg(f).alias(f) for f in fields))
    rows = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("score")) for f in fields))
    return means.filter("n > 0").select(F.lit(version).alias("prompt_version"), F.inline(rows), "n")


_MEASURES = (*ACCURACY_FIELDS, "tech_precision", "tech_recall")


def predict_versions(golden: DataFrame, versions: Mapping[str, tuple[Extractor, str]]) -> DataFrame:
    """(post_id, prompt_version, prediction) for golden posts by several extractors and prompts."""
    parts = [
        predict(golden, extractor, prompt).withColumn("prompt_version", F.lit(version))
        for version, (extractor, prompt) in versions.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def scored_versions(
    golden: DataFrame, predictions: DataFrame, versions: Sequence[str], aliases: dict[str, str] | None = None
) -> DataFrame:
    """As ``scored``, per record and version: one join over all versions.

    ``predictions`` has a ``prompt_version``; a record that a version has no prediction for is compared with
    an empty one there, so every version is judged by the same records.
    """
    asked = F.explode(F.array(*(F.lit(v) for v in versions)))
    return scored(golden.withColumn("prompt_version", asked), predictions, aliases, ("post_id", "prompt_version"))


def accuracy_of_versions(scores: DataFrame) -> DataFrame:
    """(prompt_version, field, score, n) for all versions in one aggregation."""
    means = scores.groupBy("prompt_version").agg(F.count("*").alias("n"), *(F.avg(f).alias(f) for f in _MEASURES))
    rows = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("score")) for f in _MEASURES))
    return means.select("prompt_version", F.inline(rows), "n")


def version_changes(scores: DataFrame, base: str) -> DataFrame:
    """(prompt_version, field, n, gained, lost, base_score, score) of every other version against ``base``.

    Records are paired: ``gained`` counts those that score more than under the base, ``lost`` those that score
    less. Two versions with equal means may differ in many records, which only these counts show. A record is
    one row with the scores of its versions; there is no join.
    """
    measures = F.struct(*_MEASURES)
    by_record = scores.groupBy("post_id").agg(
        F.max(F.when(F.col("prompt_version") == base, measures)).alias("old"),
        F.collect_list(F.when(F.col("prompt_version") != base, F.struct("prompt_version", measures.alias("new")))).alias("others"),
    )
    pairs = by_record.where(F.col("old").isNotNull()).select("old", F.inline("others"))
    long = F.array(
        *(F.struct(F.lit(f).alias("field"), F.col(f"old.{f}").alias("before"), F.col(f"new.{f}").alias("after")) for f in _MEASURES)
    )
    return pairs.select("prompt_version", F.inline(long)).groupBy("prompt_version", "field").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("after") > F.col("before")).alias("gained"),
        F.count_if(F.col("after") < F.col("before")).alias("lost"),
        F.avg("before").alias("base_score"),
        F.avg("after").alias("score"),
    )
