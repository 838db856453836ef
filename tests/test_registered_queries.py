"""A cut through the registered queries at the smallest scale; ``compare.py`` runs them all."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from compare import as_rows, database

FOLDER = "/root/testdata/sf0.001"
CHOSEN = (
    "thread_pages_source", "threads_upsert", "posts_replace", "posts_ingest", "fetch_totals",
    "html_text_of_pages", "html_text_of_posts", "page_previews", "extraction_queue", "batch_inference",
    "jobs", "job_ids", "job_locations", "job_technologies", "stats_summary", "top_technologies",
    "stratified_sample", "golden_scores", "domain_violations", "compared_technologies", "posts_stream",
)

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return database(FOLDER)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_gives_what_the_sql_gives(spark, tables, name):
    df = entry_points.queries()[name](spark, FOLDER)
    cursor = tables.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert as_rows(df.columns, df.collect()) == as_rows(columns, cursor.fetchall())


def test_every_query_has_its_sql():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    without_sql = set(entry_points.queries()) - set(entry_points.oracle_sql())
    assert without_sql <= set(entry_points.CORPUS_QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
