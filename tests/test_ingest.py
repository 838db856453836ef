import json

import pytest
from pyspark.sql import functions as F

from threadmill.operators import merge, queue
from threadmill.plans import ingest
from threadmill.schemas import POSTS, THREADS
from threadmill.sources import landed
from threadmill.sources.tables import append_batch, save_bucketed, scratch_path

RUN = "2025-01-01T00:00:00+00:00"
HIRING = "Ask HN: Who is hiring? (%s 2020)"


def _json_lines(path, documents):
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


@pytest.fixture()
def pages(spark, tmp_path):
    hits = [
        {"objectID": "1", "title": HIRING % "May", "created_at": "2020-05-01T15:00:00Z", "num_comments": 7},
        {"objectID": "2", "title": None, "created_at": "2020-06-01T15:00:00Z"},
        {"objectID": "3", "created_at": None, "title": "Who wants to be hired? (Smarch 2020)"},
    ]
    path = _json_lines(tmp_path / "pages.json", [{"hits": hits[:2], "nbPages": 2}, {"hits": hits[2:], "nbPages": 2}])
    return landed.read_thread_pages(spark, path)


def test_thread_list(pages):
    got = landed.thread_hits(pages).orderBy("id").collect()
    assert [tuple(r) for r in got] == [
        (1, HIRING % "May", "hiring", "2020-05", "2020-05-01T15:00:00Z", 7),
        (2, "", "other", "2020-06", "2020-06-01T15:00:00Z", None),
        (3, "Who wants to be hired? (Smarch 2020)", "seekers", None, "", None),
    ]


def test_upsert_keeps_fetch_times_and_overwrites_with_null(spark, pages):
    old = spark.createDataFrame(
        [(2, "old", "hiring", "2020-01", "x", 5, RUN), (9, "kept", "other", None, "y", 1, None)], THREADS
    )
    got = {r.id: r for r in ingest.ingest_threads(old, pages).collect()}
    assert set(got) == {1, 2, 3, 9}
    assert (got[2].title, got[2].num_comments, got[2].fetched_at) == ("", None, RUN)
    assert got[1].fetched_at is None and got[9].title == "kept"
    again = ingest.ingest_threads(ingest.ingest_threads(old, pages), pages)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got.values()))


@pytest.fixture()
def items(spark, tmp_path):
    reply = {"id": 900, "text": "reply", "children": []}
    documents = [
        {
            "id": 1,
            "title": HIRING % "May",
            "created_at": "2020-05-01T15:00:00Z",
            "children": [
                {"id": 10, "author": "a", "created_at": "2020-05-01", "text": "<p>hi", "children": [reply]},
                None,
                {"id": 11, "author": None, "created_at": "", "text": None, "deleted": True},
                {"id": 12, "author": "c", "created_at": None, "text": "x", "dead": True},
            ],
        },
        {"id": 2, "title": "other", "created_at": "2020-06-01", "children": [{"id": 20, "text": "y"}]},
        {"id": 5, "title": HIRING % "July", "created_at": "2020-07-01", "children": []},
    ]
    return landed.read_thread_items(spark, _json_lines(tmp_path / "items.json", documents))


def test_children_become_posts(items):
    got = landed.thread_posts(items.filter("id = 1"), RUN).orderBy("id").collect()
    assert [tuple(r) for r in got] == [
        (10, 1, "a", "2020-05-01", "<p>hi", 0, 0, RUN),
        (11, 1, None, RUN, None, 1, 0, RUN),
        (12, 1, "c", RUN, "x", 0, 1, RUN),
    ]


@pytest.fixture()
def stored(spark):
    threads = spark.createDataFrame(
        [
            (1, HIRING % "May", "hiring", "2020-05", "2020-05-01", 3, None),
            (2, "other", "other", "2020-06", "2020-06-01", 1, ""),
            (5, HIRING % "July", "hiring", "2020-07", "2020-07-01", 0, "earlier"),
        ],
        THREADS,
    )
    posts = spark.createDataFrame([(10, 1, "old", "", "old", 0, 0, "earlier")], POSTS)
    return threads, posts


def test_posts_of_due_threads_only(stored, items):
    run = ingest.ingest_posts(*stored, items, RUN)
    assert {r.id: r.raw_html for r in run.posts.collect()} == {10: "<p>hi", 11: None, 12: "x"}
    assert {r.id: r.fetched_at for r in run.threads.collect()} == {1: RUN, 2: "", 5: "earlier"}
    # A second run has nothing to do and leaves the tables as they are.
    again = ingest.ingest_posts(run.threads, run.posts, items, "later")
    assert again.new_posts.count() == 0
    assert sorted(map(repr, again.posts.collect())) == sorted(map(repr, run.posts.collect()))
    forced = ingest.ingest_posts(run.threads, run.posts, items, "later", force=True)
    assert {r.id: r.fetched_at for r in forced.threads.collect()} == {1: "later", 2: "", 5: "later"}


def test_single_thread_of_any_kind_known_or_not(spark, stored, items):
    run = ingest.ingest_posts(*stored, items, RUN, thread_id=2)
    assert {r.id for r in run.posts.collect()} == {10, 20}
    threads, posts = stored
    run = ingest.ingest_posts(threads.filter("id <> 1"), posts, items, RUN, thread_id=1)
    added = {r.id: r for r in run.threads.collect()}[1]
    assert (added.kind, added.month, added.fetched_at) == ("hiring", "2020-05", RUN)
    asked = spark.createDataFrame([(1,), (77,)], "id long")
    assert [r.id for r in queue.unknown_threads(asked, threads).collect()] == [77]


def test_last_write_wins(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id long, v string, seq long")
    updates = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "id long, v string, seq long")
    got = merge.replace_on_key(target, updates, ["id"], "seq")
    assert {(r.id, r.v) for r in got.collect()} == {(1, "a"), (2, "d"), (3, "e")}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    log = str(tmp_path / "log")
    for batch, rows in ((0, [(1, "a")]), (1, [(2, "b")]), (1, [(2, "b"), (1, "c")])):
        append_batch(spark.createDataFrame(rows, "id long, v string"), log, batch)
    latest = merge.latest_per_key(spark.read.parquet(log), ["id"], [F.desc("batch_id")])
    assert {(r.id, r.v) for r in latest.collect()} == {(1, "c"), (2, "b")}


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, key in (("bucketed_posts", "id"), ("bucketed_ledger", "post_id")):
            save_bucketed(spark.range(100).select(F.col("id").alias(key)), name, key, 4)
        joined = spark.table("bucketed_posts").join(spark.table("bucketed_ledger"), F.expr("id = post_id"))
        assert joined.count() == 100
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_posts", "bucketed_ledger"):
            spark.sql(f"drop table if exists {name}")


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_listed_again_the_last_one_counts(spark, tmp_path):
    hit = {"objectID": "5", "title": "Who is hiring? (June 2020)", "created_at": "2020-06-01"}
    pages = [{"hits": [{**hit, "num_comments": n}], "nbPages": 3} for n in (10, 20, 30)]
    (tmp_path / "pages.json").write_text("\n".join(map(json.dumps, pages)))
    empty = spark.createDataFrame([], THREADS)
    got = ingest.ingest_threads(empty, landed.read_thread_pages(spark, str(tmp_path)))
    assert [(r.id, r.num_comments) for r in got.collect()] == [(5, 30)]
