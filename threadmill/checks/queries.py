"""One registered query per operator, over the derived job-thread tables."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.answers import document_check
from ..functions.text import preview, with_plain_text
from ..operators import documents as D
from .. import fixed_values as V
from ..operators import infer, merge, quality, queue
from ..operators.phrases import phrase_table, with_first_phrase
from ..plans import datasets, golden, ingest, normalize, report, stats
from ..plans import extract as extraction
from ..schemas import THREAD_ITEMS
from ..sources import landed
from ..sources.adapters import RUN_TS, JobThreads
from ..sources.dims import built_in_dimensions, built_in_prices, read_dimensions, read_prices
from ..sources.snapshots import TableStore
from ..sources.tables import read_table, replace_table, scratch_path, stage
from ..streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LATER, LATEST = "2025-02-01T00:00:00+00:00", "2025-03-01T00:00:00+00:00"
COMPARED = ("python", "go", "zig")
SAMPLE_SIZE, SEED = 30, "7:"


def query(build: Callable[[JobThreads], DataFrame]) -> Callable[[JobThreads], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(JobThreads(spark, sf_dir))
    return build


def test_extractor(text: str, prompt: str):
    """Stands in for a model: the answer depends on the length of the text, and some fail."""
    n = len(text)
    if n % 37 == 0:
        raise ValueError(f"no answer for {n} characters")
    if n % 41 == 0:
        raise infer.RateLimited()
    return {"post_type": "job_posting", "hiring_count_hint": str(n)}, n // 4, n % 50


def no_wait(seconds: float) -> None:
    """Test calls fail on purpose; nothing is gained by waiting for them."""


def _decoded(j: JobThreads, *fields: str, version: str = "v1") -> DataFrame:
    extracted = D.extracted_posts(j.ledger(), j.posts(), j.threads(), version)
    return D.decoded_posts(extracted, fields or None)


def _dims(j: JobThreads):
    return built_in_dimensions(j.spark)


def _jobs(j: JobThreads) -> DataFrame:
    return D.jobs(_decoded(j, "company", "workplace", "visa_sponsorship", "roles"), _dims(j))


def _technologies(j: JobThreads) -> DataFrame:
    return D.post_technologies(_decoded(j, "roles", "technologies_raw"), _dims(j))


def _locations(j: JobThreads) -> DataFrame:
    return D.post_locations(_decoded(j, "roles", "locations"), _dims(j))




# --- threads and posts ----------------------------------------------------------------------


def _landed(j: JobThreads, payloads: DataFrame, name: str) -> str:
    path = scratch_path(j.spark, name)
    payloads.write.text(path)
    return path


@query
def thread_pages_source(j):
    path = _landed(j, j.landed_pages(), "thread-pages")
    return landed.thread_hits(landed.read_thread_pages(j.spark, path))


@query
def thread_items_source(j):
    path = _landed(j, j.landed_items(), "thread-items")
    return landed.thread_posts(landed.read_thread_items(j.spark, path), RUN_TS)


@query
def thread_kinds_and_months(j):
    return j.threads().select("id", "kind", "month")


@query
def threads_upsert(j):
    known = j.threads().filter("id % 5 <> 0")
    updates = j.threads().filter("id % 3 <> 1").select(
        "id",
        F.concat("title", F.lit(" (edited)")).alias("title"),
        "kind",
        "month",
        "created_at",
        F.expr("case when id % 2 = 0 then num_comments + 1 end").alias("num_comments"),
    )
    return merge.upsert_threads(known, updates)


@query
def threads_ingest(j):
    known = j.threads().filter("id % 5 <> 0")
    path = _landed(j, j.landed_pages(), "thread-pages")
    return ingest.ingest_threads(known, landed.read_thread_pages(j.spark, path))


def _stored_posts(j: JobThreads) -> DataFrame:
    return j.posts().filter("id % 4 <> 0")


@query
def posts_replace(j):
    def update(share: int, author: str, seen: str) -> DataFrame:
        rows = j.posts().filter(F.col("id") % share == 0)
        return rows.withColumn("author", F.lit(author)).withColumn("fetched_at", F.lit(seen))

    updates = update(2, "second", LATER).unionByName(update(6, "third", LATEST))
    merged = merge.replace_on_key(_stored_posts(j), updates, ["id"], "fetched_at")
    return merged.select("id", "thread_id", "author", "created_at", "raw_html", "fetched_at")


@query
def posts_merged_in_parts(j):
    """As posts_replace, in a stored table of which each merge rewrites only the parts it has rows for."""
    store = TableStore(j.spark, scratch_path(j.spark, "store"))
    ingest.store_posts(store, _stored_posts(j), [F.desc("fetched_at")], ids_per_part=100)
    for share, author, seen in ((2, "second", LATER), (6, "third", LATEST)):
        rows = j.posts().filter(F.col("id") % share == 0)
        rows = rows.withColumn("author", F.lit(author)).withColumn("fetched_at", F.lit(seen))
        ingest.store_posts(store, rows, [F.desc("fetched_at")], ids_per_part=100)
    return store.read("posts").select("id", "thread_id", "author", "created_at", "raw_html", "fetched_at")


@query
def posts_ingested_into_store(j):
    """As posts_ingest, into stored tables."""
    store = TableStore(j.spark, scratch_path(j.spark, "store"))
    ingest.store_threads(store, j.threads())
    ingest.store_posts(store, _stored_posts(j).withColumn("author", F.lit("first")), [F.desc("fetched_at")], 1000)
    items = landed.read_thread_items(j.spark, _landed(j, j.landed_items(), "thread-items"))
    ingest.ingest_posts_into(store, items, LATER, ids_per_part=1000)
    marks = store.read("threads").select(F.col("id").alias("thread_id"), F.col("fetched_at").alias("thread_fetched_at"))
    return store.read("posts").select("id", "thread_id", "author", "fetched_at").join(marks, "thread_id", "left")


@query
def ledger_merged_in_parts(j):
    """As ledger_replace, in a stored table."""
    store = TableStore(j.spark, scratch_path(j.spark, "store"))
    extraction.store_answers(store, j.ledger(), ids_per_part=500)
    rerun = j.ledger().filter("status = 'error'").withColumn("status", F.lit("ok"))
    rerun = rerun.withColumn("error", F.lit(None).cast("string")).withColumn("created_at", F.lit(LATER))
    extraction.store_answers(store, rerun, ids_per_part=500)
    return store.read("ledger").select("post_id", "prompt_version", "status", "error", "created_at")


@query
def ledger_replace(j):
    rerun = (
        j.ledger()
        .filter("status = 'error'")
        .withColumn("status", F.lit("ok"))
        .withColumn("error", F.lit(None).cast("string"))
        .withColumn("created_at", F.lit(LATER))
    )
    merged = merge.replace_on_key(j.ledger(), rerun, ["post_id", "prompt_version"], "created_at")
    return merged.select("post_id", "prompt_version", "status", "error", "created_at")


@query
def threads_mark_fetched(j):
    run = j.posts().filter("is_dead = 1").select(F.col("thread_id").alias("id")).distinct()
    marked = merge.mark_fetched(j.threads(), run.withColumn("fetched_at", F.lit(LATER)))
    return marked.select("id", "fetched_at")


def _ingested(j: JobThreads) -> ingest.PostIngest:
    stored = _stored_posts(j).withColumn("author", F.lit("first"))
    path = _landed(j, j.landed_items(), "thread-items")
    items = landed.read_thread_items(j.spark, path)
    return ingest.ingest_posts(j.threads(), stored, items, LATER)


@query
def posts_ingest(j):
    return _ingested(j).posts.select("id", "thread_id", "author", "is_deleted", "is_dead", "fetched_at")


@query
def posts_ingest_marks(j):
    return _ingested(j).threads.select("id", "fetched_at")


@query
def ingest_and_stats(j):
    known = j.threads().filter("id % 5 <> 0")
    pages = landed.read_thread_pages(j.spark, _landed(j, j.landed_pages(), "thread-pages"))
    items = landed.read_thread_items(j.spark, _landed(j, j.landed_items(), "thread-items"))
    return ingest.ingest_all(known, _stored_posts(j), pages, items, LATER)[1]


@query
def fetch_totals(j):
    hiring = j.threads().filter("kind = 'hiring'")
    return ingest.fetch_totals(j.posts(), hiring)


@query
def threads_of_kind(j):
    return queue.threads_of_kind(j.threads(), "seekers").select("id", "title", "month")


@query
def thread_lookup(j):
    return queue.thread_by_id(j.threads(), 5)


@query
def unknown_threads(j):
    requested = j.table("conversations").select(F.col("conv_id").alias("id")).distinct()
    return queue.unknown_threads(requested, j.threads())


@query
def threads_to_fetch(j):
    return queue.threads_to_fetch(queue.threads_of_kind(j.threads())).select("id", "month")


@query
def orphan_rows(j):
    posts, threads = j.posts(), j.threads()
    decoded = _decoded(j, "roles", "technologies_raw")
    jobs = decoded.select("post_id").filter("post_id % 7 <> 0")
    named = D.post_technologies(decoded, _dims(j)).select("post_id")
    return (
        quality.orphans(posts, "thread_id", threads, "id", "posts.thread_id")
        .unionByName(quality.orphans(j.ledger(), "post_id", posts, "id", "ledger.post_id"))
        .unionByName(quality.orphans(named, "post_id", jobs, "post_id", "technologies.post_id"))
    )


# --- text -------------------------------------------------------------------------------------


@query
def html_text_of_pages(j):
    return with_plain_text(j.table("pages"), "html").select("page_id", "text")


@query
def html_text_of_pages_clean(j):
    return with_plain_text(j.table("pages"), "html", clean=True).select("page_id", "text")


@query
def html_text_of_posts(j):
    return with_plain_text(j.posts(), "raw_html").select("id", "text")


@query
def page_previews(j):
    return j.table("pages").select("page_id", preview(F.col("html")).alias("preview"))


@query
def extraction_gate(j):
    gated = infer.prepare(j.posts())
    return gated.select("id", "skipped", "truncated", F.length("text").cast("long").alias("chars"))


# --- extraction -------------------------------------------------------------------------------


def _queue(j: JobThreads, **options) -> DataFrame:
    return queue.posts_to_extract(j.posts(), j.threads(), j.ledger(), **options)


@query
def extraction_queue(j):
    return _queue(j).select("id", "month")


@query
def extraction_queue_of_month(j):
    return _queue(j, month="2017-01", version="v2").select("id", "month")


@query
def extraction_queue_retrying_errors(j):
    return _queue(j, retry_errors=True).select("id", "month")


@query
def extraction_queue_head(j):
    return queue.newest_first(_queue(j), 25).select("id", "month")


def _run(j: JobThreads) -> DataFrame:
    prepared = infer.prepare(_queue(j, version="v3"))
    return infer.run_extractor(prepared, test_extractor, "prompt", "v3", RUN_TS, sleep=no_wait)


@query
def batch_inference(j):
    return _run(j)


def uneven_extractor(text: str, prompt: str):
    """Answers of which many do not fit the schema; the length of the text says which."""
    n = len(text)
    answers = {
        0: {},
        1: {"roles": [{"title_guess": "qa"}]},
        2: {"company": {"name": "Acme", "stage": "series_z"}, "visa_sponsorship": None},
        3: {"roles": [{"title_raw": "Cook", "salary": {"min": "lots", "period": "year"}}]},
        4: {"locations": "Oslo", "technologies_raw": ["Go", None]},
        5: None,
        6: {"roles": [{"title_raw": "Cook", "salary": {"max": "120.5"}}], "mood": "good"},
        7: {"workplace": None, "hiring_count_hint": n},
    }
    return answers.get(n % 11, {"post_type": "seeking_work", "hiring_count_hint": str(n)}), n // 4, n % 50


@query
def checked_inference(j):
    """Answers that fail the check end as errors; the others are stored whole, with all defaults."""
    prepared = infer.prepare(_queue(j, version="v3"))
    rows = infer.run_extractor(
        prepared, uneven_extractor, "prompt", "v3", RUN_TS, sleep=no_wait, check=document_check(complete=True)
    )
    role = F.try_element_at("doc.roles", F.lit(1))
    return D.decode(stage(rows, "checked")).select(
        "post_id", "status", "error", "input_tokens",
        F.when(F.col("status") == "ok", F.size("doc.roles")).cast("int").alias("roles"),
        F.col("doc.post_type").alias("post_type"), F.col("doc.company.stage").alias("stage"),
        F.col("doc.hiring_count_hint").alias("hint"), role["title_guess"].alias("title_guess"),
        role["salary"]["max"].alias("salary_max"), role["salary"]["period"].alias("salary_period"),
    )


def second_extractor(text: str, prompt: str):
    return {"hiring_count_hint": "second"}, 2, 2


@query
def resumed_extraction(j):
    """A run that ended after a third of its posts, started again: those keep their first answers."""
    journal, ledger = scratch_path(j.spark, "journal"), j.ledger()
    some = j.posts().filter("id % 3 = 1")
    extraction.extract(
        some, j.threads(), ledger, test_extractor, "prompt", RUN_TS, "v3", sleep=no_wait,
        journal=journal, calls_per_commit=50,
    )
    run = extraction.extract(
        j.posts(), j.threads(), ledger, second_extractor, "prompt", RUN_TS, "v3", sleep=no_wait,
        journal=journal, calls_per_commit=50,
    )
    return run.ledger.filter("prompt_version = 'v3'").select("post_id", "status", "input_tokens", "created_at")


@query
def extraction_counters(j):
    return extraction.extract(
        j.posts(), j.threads(), j.ledger(), test_extractor, "prompt", RUN_TS, "v3", sleep=no_wait
    ).counters


@query
def extraction_error_rate(j):
    return infer.error_rate(report.of_version(j.ledger(), "v1"))


@query
def extraction_dry_run(j):
    return extraction.dry_run(_queue(j), built_in_prices(j.spark))


@query
def ledger_cost(j):
    return extraction.ledger_cost(j.ledger(), built_in_prices(j.spark))


@query
def in_memory_inference(j):
    return infer.extract_documents(j.posts(), test_extractor, "prompt")


# --- normalization ----------------------------------------------------------------------------


@query
def decodable_extractions(j):
    good = j.ledger().filter("prompt_version = 'v1' and status = 'ok'")
    return quality.undecodable(D.decode(good))


@query
def jobs(j):
    return _jobs(j).drop("salary_capped")


@query
def jobs_of_postings_only(j):
    fields = ("post_type", "company", "workplace", "visa_sponsorship", "roles")
    rows = D.jobs(_decoded(j, *fields), _dims(j), only_job_postings=True)
    return rows.select("post_id", "role_pos", "title_raw")


@query
def job_locations(j):
    return D.per_job(_locations(j)).select("post_id", "role_pos", "city", "region", "country")


@query
def job_technologies(j):
    return D.per_job(_technologies(j)).select("post_id", "role_pos", "tech_raw", "tech", "aliased")


@query
def post_classification(j):
    return D.post_classification(_decoded(j, "post_type", "ai_signals"))


@query
def job_ids(j):
    decoded = D.with_first_job_id(stage(_decoded(j, "roles"), "decoded"), width=100)
    ids = decoded.select("post_id", "first_job_id", F.posexplode_outer("doc.roles").alias("pos", "role"))
    pos = F.coalesce("pos", F.lit(0))
    return ids.select((F.col("first_job_id") + pos).alias("job_id"), "post_id", pos.alias("role_pos"))


@query
def normalized_rebuild(j):
    """Rebuild for v1, then for v2 at the same place: only v2 is left."""
    folder = scratch_path(j.spark, "normalized")
    for version in ("v1", "v2"):
        tables = normalize.normalize(j.ledger(), j.posts(), j.threads(), _dims(j), version)
        normalize.write_tables(tables, folder)
    names = ("jobs", "job_locations", "job_technologies", "post_classification")
    counts = [
        read_table(j.spark, f"{folder}/{name}")
        .groupBy("prompt_version")
        .agg(F.count("*").alias("n"))
        .select(F.lit(name).alias("table_name"), "prompt_version", "n")
        for name in names
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query
def versions_side_by_side(j):
    """Published for v1, then v2 next to it, then v2 alone; the tables as of each of the three states."""
    store = TableStore(j.spark, scratch_path(j.spark, "published"))
    steps = [("v1", ()), ("v2", None), ("v2", ())]
    counts = []
    for step, (version, kept) in enumerate(steps):
        tables = normalize.normalize(j.ledger(), j.posts(), j.threads(), _dims(j), version)
        state = normalize.publish_tables(tables, store, kept)
        counts += [
            store.read(name, at=state).groupBy("prompt_version").agg(F.count("*").alias("n"))
            .select(F.lit(step).alias("step"), F.lit(name).alias("table_name"), "prompt_version", "n")
            for name, _ in tables.items()
        ]
    return reduce(DataFrame.unionByName, counts)


@query
def technology_aliases(j):
    return _technologies(j).groupBy("tech_raw", "tech", "aliased").agg(F.count("*").alias("n"))


def _alias_files(j: JobThreads) -> str:
    """The alias tables as files of ``key: value`` lines, one of them with two sections."""
    folder = scratch_path(j.spark, "aliases")

    def lines(aliases, indent=""):
        return [f'{indent}"{k}": "{v}"  # {n}' for n, (k, v) in enumerate(aliases.items())]

    city = ["# cities", "aliases:", *lines(V.CITY_ALIASES, "  "), "", "city_country:", *lines(V.CITY_COUNTRIES, "  ")]
    files = {"tech": lines(V.TECH_ALIASES), "city": city, "country": lines(V.COUNTRY_ALIASES), "currency": lines(V.CURRENCY_ALIASES)}
    for name, content in files.items():
        j.spark.createDataFrame([("\n".join(content),)], "value string").coalesce(1).write.text(f"{folder}/{name}")
    return folder


@query
def places_by_alias_files(j):
    places = D.post_locations(_decoded(j, "roles", "locations"), read_dimensions(j.spark, _alias_files(j)))
    return places.groupBy("city", "region", "country").agg(F.sum("n_jobs").alias("n"))


@query
def technology_aliases_by_file(j):
    named = D.post_technologies(_decoded(j, "roles", "technologies_raw"), read_dimensions(j.spark, _alias_files(j)))
    return named.groupBy("tech_raw", "tech", "aliased").agg(F.count("*").alias("n"))


@query
def ledger_cost_by_price_file(j):
    path = scratch_path(j.spark, "prices")
    prices = {m: {"input_per_1m": a, "output_per_1m": b} for m, a, b in V.MODEL_PRICES}
    j.spark.createDataFrame([(json.dumps(prices, indent=2),)], "value string").coalesce(1).write.text(path)
    return extraction.ledger_cost(j.ledger(), read_prices(j.spark, path))


@query
def field_mismatches(j):
    """Documents in which one field got a value of another kind, chosen by the post."""
    changes = (
        ('"post_type":"', '"post_type":7,"was":"'), ('"min":', '"min":"much","was":'), ('"locations":[', '"locations":{"a":1},"was":['),
        ('"company":{', '"company":"Acme","was":{'), ('"technologies_raw":["', '"technologies_raw":[true,null,"'),
    )
    changed = F.col("raw_json")
    for n, (old, new) in enumerate(changes):
        changed = F.when(F.col("post_id") % 6 == n, F.replace("raw_json", F.lit(old), F.lit(new))).otherwise(changed)
    rows = j.ledger().filter("prompt_version = 'v1' and status = 'ok'")
    return quality.field_mismatches(rows.select(changed.alias("raw_json"))).filter("mismatches > 0")


@query
def places(j):
    return _locations(j).groupBy("city", "region", "country").agg(F.sum("n_jobs").alias("n"))


@query
def salary_rules(j):
    return _jobs(j).select(
        "post_id", "role_pos", "salary_period", "salary_min", "salary_max", "salary_capped"
    )


@query
def currencies(j):
    return _jobs(j).groupBy("salary_currency").agg(F.count("*").alias("n"))


@query
def remote_regions(j):
    return _jobs(j).groupBy("remote_region").agg(F.count("*").alias("n"))


@query
def remote_regions_by_table(j):
    """As remote_regions, with the phrases of the rules in a table."""
    roles = _decoded(j, "roles", "workplace")
    raw = roles.select("n_jobs", F.col("doc.workplace.remote_region_raw").alias("raw"))
    rules = phrase_table(j.spark, V.REMOTE_REGION_RULES)
    named = with_first_phrase(raw, "raw", rules, "remote_region", "other")
    return named.groupBy("remote_region").agg(F.sum("n_jobs").alias("n"))


@query
def first_phrases(j):
    """One phrase of every tenth document, looked up in all documents; the first by id counts."""
    phrase = F.expr("substring(text, 7, cast(2 + doc_id % 40 as int))")
    rules = j.table("documents").filter("doc_id % 10 = 0").select(
        phrase.alias("phrase"), F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("value"),
        F.col("doc_id").alias("priority"),
    )
    found = with_first_phrase(j.table("documents"), "text", rules, "value", "none")
    return found.select("doc_id", "value")


# --- stats and reports ------------------------------------------------------------------------


@query
def threads_per_kind(j):
    return stats.threads_per_kind(j.threads())


@query
def total_posts(j):
    return stats.total_posts(j.posts())


@query
def hiring_months(j):
    return stats.hiring_months(j.threads())


@query
def posts_per_month(j):
    return stats.posts_per_month(j.threads(), j.posts())


@query
def sample_posts(j):
    return stats.sample_posts(j.posts(), 3, SEED)


@query
def stats_summary(j):
    return stats.stats(j.threads(), j.posts())


@query
def ledger_status(j):
    return report.ledger_status(j.ledger())


@query
def post_types(j):
    return report.post_types(D.post_classification(_decoded(j, "post_type", "ai_signals")))


@query
def jobs_total(j):
    return report.jobs_total(_jobs(j))


@query
def salary_coverage(j):
    return report.salary_coverage(_jobs(j))


@query
def visa_sponsorship(j):
    return report.visa_sponsorship(_jobs(j))


@query
def top_technologies(j):
    return report.top_technologies(_technologies(j), weight=F.col("n_jobs"))


@query
def top_technologies_by_post(j):
    return report.top_technologies_by_post(_technologies(j))


@query
def top_technologies_of_jobs(j):
    """Over job-level tables that know their version through the job only."""
    decoded = D.with_first_job_id(stage(_decoded(j), "decoded"))
    named = D.job_technologies(decoded, _dims(j)).select("job_id", "tech")
    return report.top_technologies(report.of_jobs(named, D.jobs(decoded, _dims(j))))


@query
def top_cities(j):
    return report.top_cities(_locations(j), weight=F.col("n_jobs"))


@query
def top_titles(j):
    return report.top_titles(_jobs(j))


@query
def jobs_per_month(j):
    return report.jobs_per_month(_jobs(j))


@query
def unmapped_technologies_as_written(j):
    return report.unmapped_as_written(_technologies(j), weight=F.col("n_jobs"))


@query
def unmapped_technologies_cleaned(j):
    return report.unmapped_cleaned(_technologies(j), weight=F.col("n_jobs"))


@query
def full_report(j):
    tables = normalize.normalize(j.ledger(), j.posts(), j.threads(), _dims(j))
    folder = scratch_path(j.spark, "normalized")
    normalize.write_tables(tables, folder)
    names = ("post_classification", "jobs", "job_locations", "job_technologies")
    stored = [read_table(j.spark, f"{folder}/{name}") for name in names]
    return report.report(j.ledger(), *stored)


# --- golden set -------------------------------------------------------------------------------


def _predictions(j: JobThreads) -> DataFrame:
    rows = j.ledger().filter("prompt_version = 'v1' and status = 'ok'").select("post_id", "raw_json")
    return D.decodable(rows).withColumnRenamed("doc", "prediction")


@query
def golden_pool(j):
    return golden.golden_pool(j.posts(), j.threads()).select("id", "month")


@query
def stratified_sample(j):
    return golden.stratified_ids(golden.golden_pool(j.posts(), j.threads()), SAMPLE_SIZE, SEED)


@query
def golden_skeletons(j):
    pool = golden.golden_pool(j.posts(), j.threads())
    sample = golden.stratified_sample(pool, SAMPLE_SIZE, SEED)
    skeletons = golden.golden_skeletons(sample, j.golden(), test_extractor, "prompt")
    path = scratch_path(j.spark, "golden")
    golden.append_skeletons(skeletons, path)
    return landed.read_golden(j.spark, path).select(
        "post_id", "month", "raw_html", F.col("expected.hiring_count_hint").alias("expected_hint")
    )


@query
def golden_source(j):
    path = scratch_path(j.spark, "golden")
    records = j.golden().join(j.posts().select(F.col("id").alias("post_id"), "raw_html"), "post_id")
    golden.append_skeletons(records.withColumn("month", F.lit("2024-01")), path)
    stored = landed.read_golden(j.spark, path)
    return stored.select(
        "post_id",
        F.col("llm_output.company.name").alias("llm_company"),
        F.col("expected.company.name").alias("expected_company"),
        F.length("raw_html").cast("long").alias("chars"),
    )


@query
def labelled_golden(j):
    return golden.labelled(j.golden()).select("post_id")


@query
def golden_scores(j):
    return golden.scored(golden.labelled(j.golden()), _predictions(j))


@query
def golden_accuracy(j):
    scores = golden.accuracy(golden.scored(golden.labelled(j.golden()), _predictions(j)))
    return scores.withColumn("score", F.round("score", 6))


@query
def golden_accuracy_with_unchanged(j):
    chosen = golden.labelled(j.golden(), include_unchanged=True)
    scores = golden.accuracy(golden.scored(chosen, _predictions(j)))
    return scores.withColumn("score", F.round("score", 6))


def first_draft(text: str, prompt: str):
    """A version whose answers depend on the length of the text."""
    n = len(text)
    kinds = ("job_posting", "seeking_work", "meta_or_other")
    return {
        "post_type": kinds[n % 3], "company": {"name": f"Company {n % 37}"}, "visa_sponsorship": ("yes", "no", "unstated")[n % 3],
        "technologies_raw": ["Python", " golang "] if n % 2 else [],
    }, 1, 1


def second_draft(text: str, prompt: str):
    n = len(text)
    return {"post_type": "job_posting", "technologies_raw": ["Python"], "roles": [{"title_raw": "x"}] * (n % 4)}, 1, 1


def _draft_scores(j: JobThreads) -> DataFrame:
    records = j.golden().join(j.posts().select(F.col("id").alias("post_id"), "raw_html"), "post_id")
    drafts = {"draft 1": (first_draft, "p"), "draft 2": (second_draft, "p")}
    predictions = golden.predict_versions(records, drafts)
    return stage(golden.scored_versions(golden.labelled(records), predictions, list(drafts)), "scores")


@query
def golden_versions(j):
    """Two drafts predict the golden posts and are scored over the same records."""
    return golden.accuracy_of_versions(_draft_scores(j)).withColumn("score", F.round("score", 6))


@query
def golden_version_changes(j):
    changes = golden.version_changes(_draft_scores(j), "draft 1")
    return changes.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


# --- data quality -----------------------------------------------------------------------------


@query
def domain_violations(j):
    return quality.domain_violations(_decoded(j))


@query
def missing_required(j):
    roles = quality.missing_role_titles(_decoded(j, "roles"))
    columns = ["title", "kind", "month", "num_comments"]
    return roles.unionByName(quality.missing_required(j.threads(), columns))


@query
def capped_salaries(j):
    return quality.capped_salaries(_decoded(j, "roles"))


@query
def truncated_posts(j):
    return quality.truncated_posts(infer.prepare(j.posts()))


# --- datasets ---------------------------------------------------------------------------------


@query
def technologies_per_month(j):
    return datasets.technologies_per_month(_technologies(j), F.col("n_jobs"))


@query
def company_leaderboard(j):
    return datasets.leaderboard(_jobs(j), "company_name", 5)


@query
def city_leaderboard(j):
    return datasets.leaderboard(_locations(j), "city", 5, F.col("n_jobs"))


@query
def technology_leaderboard(j):
    return datasets.leaderboard(_technologies(j), "tech", 5, F.col("n_jobs"))


@query
def roles_per_month(j):
    return datasets.roles_per_month(_jobs(j))


@query
def remote_share(j):
    return datasets.remote_share(_jobs(j))


@query
def compared_technologies(j):
    return datasets.compare_technologies(_technologies(j), COMPARED, F.col("n_jobs"))


@query
def exported_dataset(j):
    path = scratch_path(j.spark, "dataset")
    datasets.export_json(datasets.remote_share(_jobs(j)), path)
    return j.spark.read.schema("month STRING, jobs LONG, remote LONG, pct DOUBLE").json(path)


# --- streams ----------------------------------------------------------------------------------


def _files_each(j: JobThreads, batches: int) -> int:
    """Files that each of so many batches lands in: more for larger tables, so that no file grows with them."""
    return max(1, math.ceil(j.table("documents").rdd.getNumPartitions() / batches))


def _posts_log(j: JobThreads) -> str:
    """Two streaming runs over the same landing folder; the second one finds nothing new."""
    files = 2 * _files_each(j, 4)
    landing = _landed(j, j.landed_items().repartition(2 * files), "thread-items")
    log, checkpoint = scratch_path(j.spark, "posts-log"), scratch_path(j.spark, "posts-checkpoint")
    for _ in range(2):
        incremental.ingest_stream(j.spark, landing, log, checkpoint, RUN_TS, files_per_batch=files).awaitTermination()
    return log


@query
def posts_stream(j):
    log = _posts_log(j)
    return incremental.merged_posts(j.spark, log)


@query
def posts_of_two_runs(j):
    """Two runs with one time; the second one lands other authors for a third of the threads.

    Their log is merged in tiers between and after them, so rows come from parts and from batches.
    """
    items = j.spark.read.schema(THREAD_ITEMS).json(_landed(j, j.landed_items(), "thread-items"))
    late = items.filter("id % 3 = 0").withColumn(
        "children", F.transform("children", lambda c: F.when(c.isNotNull(), c.withField("author", F.lit("late"))))
    )
    log = scratch_path(j.spark, "posts-log")
    for rows, batches, fan in ((items, 5, 3), (late, 2, 3)):
        files = _files_each(j, batches)
        landing = scratch_path(j.spark, "thread-items")
        rows.repartition(batches * files).write.option("ignoreNullFields", "false").json(landing)
        checkpoint = scratch_path(j.spark, "posts-checkpoint")
        incremental.ingest_stream(j.spark, landing, log, checkpoint, RUN_TS, files_per_batch=files).awaitTermination()
        incremental.compact_posts(j.spark, log, fan)
    return incremental.merged_posts(j.spark, log).select("id", "thread_id", "author", "fetched_at")


@query
def ledger_stream(j):
    posts_log, files = scratch_path(j.spark, "posts"), 2 * _files_each(j, 4)
    replace_table(j.posts().repartition(2 * files), posts_log)
    threads = stage(j.threads(), "threads")
    log, checkpoint = scratch_path(j.spark, "ledger-log"), scratch_path(j.spark, "ledger-checkpoint")
    for _ in range(2):
        incremental.extract_stream(
            j.spark, posts_log, threads, log, checkpoint, test_extractor, "prompt", RUN_TS,
            files_per_batch=files, sleep=no_wait,
        ).awaitTermination()
    return incremental.merged_ledger(j.spark, log)


@query
def posts_table_scan(j):
    path = scratch_path(j.spark, "posts")
    replace_table(j.posts(), path)
    return read_table(j.spark, path, None).filter("is_dead = 1").select("id", "thread_id", "author")


