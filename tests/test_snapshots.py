import os

import pytest
from pyspark.sql import functions as F

from threadmill.plans import extract, ingest
from threadmill.plans.normalize import NormalizedTables, publish_tables
from threadmill.schemas import LEDGER, POSTS, THREADS
from threadmill.sources import snapshots
from threadmill.sources.manifest import Conflict, StateLog
from threadmill.sources.snapshots import TableStore

NAMES = ("jobs", "job_locations", "job_technologies", "post_classification")


def _tables(spark, version, mark):
    def table(name):
        return spark.createDataFrame([(f"{name}-{mark}", version)], "value string, prompt_version string")

    return NormalizedTables(*(table(n) for n in NAMES))


def _contents(store, at=None):
    return {n: sorted(tuple(r) for r in store.read(n, at=at).collect()) for n in NAMES}


def _want(*marks):
    return {n: [(f"{n}-{m}", v) for m, v in marks] for n in NAMES}


def test_versions_side_by_side(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(KeyError):
        store.read("jobs")
    first = publish_tables(_tables(spark, "v1", "a"), store)
    assert _contents(store) == _want(("a", "v1"))
    both = publish_tables(_tables(spark, "v2", "b"), store, keep_versions=None)
    assert _contents(store) == _want(("a", "v1"), ("b", "v2"))
    # The kept version was not copied.
    assert first.parts["jobs"]["v1"] == both.parts["jobs"]["v1"]
    publish_tables(_tables(spark, "v1", "c"), store, keep_versions=["v2"])
    assert _contents(store) == _want(("b", "v2"), ("c", "v1"))
    publish_tables(_tables(spark, "v2", "d"), store)
    assert _contents(store) == _want(("d", "v2"))
    # Older states stay readable until their folders are cleared.
    assert _contents(store, first) == _want(("a", "v1"))
    gone = store.vacuum(keep=1)
    assert len(gone) == 12 and _contents(store) == _want(("d", "v2")) and store.vacuum(keep=1) == []


def test_a_rebuild_that_breaks_leaves_the_old_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    publish_tables(_tables(spark, "v1", "a"), store)
    broken = _tables(spark, "v1", "b")
    fails = broken.job_technologies.withColumn("value", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception):
        publish_tables(NormalizedTables(broken.jobs, broken.job_locations, fails, broken.post_classification), store)
    assert len(os.listdir(tmp_path / "data")) >= 6  # two tables were written already
    assert _contents(store) == _want(("a", "v1")) and store.snapshot().number == 1
    publish_tables(broken, store)
    assert _contents(store) == _want(("b", "v1"))


def test_tables_without_rows_can_be_read(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    empty = {n: df.limit(0) for n, df in _tables(spark, "v1", "a").items()}
    publish_tables(NormalizedTables(**empty), store)
    assert _contents(store) == {n: [] for n in NAMES}


def test_of_two_writers_one_is_told(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    base = store.snapshot()
    publish_tables(_tables(spark, "v1", "a"), store)
    with pytest.raises(Conflict):
        store.replace(dict(_tables(spark, "v1", "b").items()), "prompt_version", base=base)
    assert _contents(store) == _want(("a", "v1"))
    log = StateLog(spark, str(tmp_path / "log"))
    assert log.load() == (0, {}) and log.store(0, {"a": 1}) == 1 and log.load() == (1, {"a": 1})
    with pytest.raises(Conflict):
        log.store(0, {"a": 2})
    assert log.load() == (1, {"a": 1}) and log.list() == ["000000000001.json"]


def _posts(spark, ids, author, seen):
    return spark.createDataFrame([(i, 1, author, "", "x", 0, 0, seen) for i in ids], POSTS)


def _files(folder):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")
    }


def test_a_merge_touches_only_parts_with_new_keys(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    newest = [F.desc("fetched_at")]
    ingest.store_posts(store, _posts(spark, range(1000), "a", "1"), newest, ids_per_part=100)
    before, files = store.snapshot(), _files(tmp_path / "data")
    update = _posts(spark, [5, 7, 7, 1001], "b", "2").unionByName(_posts(spark, [7], "c", "3"))
    after = ingest.store_posts(store, update, newest, ids_per_part=100)
    changed = {p for p in after.parts["posts"] if after.parts["posts"][p] != before.parts["posts"].get(p)}
    assert changed == {"0", "10"}
    # No old file was changed, and the new ones hold the rows of two parts only.
    now = _files(tmp_path / "data")
    assert {f: t for f, t in now.items() if f in files} == files
    new = [f for f in now if f not in files]
    assert spark.read.parquet(*new).count() == 101
    got = {r.id: r.author for r in store.read("posts").collect()}
    assert got == {**{i: "a" for i in range(1000)}, 5: "b", 7: "c", 1001: "b"} and store.read("posts").count() == 1001
    assert store.read("posts", ["10", "77"]).count() == 1 and store.read("posts", at=before).count() == 1000


def test_ledger_parts_follow_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))

    def rows(version, ids, status):
        return spark.createDataFrame([(i, version, 1, "m", "{}", 1, 1, status, None, status) for i in ids], LEDGER)

    extract.store_answers(store, rows("v1", range(300), "error"), ids_per_part=100)
    before = extract.store_answers(store, rows("v2", range(50), "error"), ids_per_part=100)
    after = extract.store_answers(store, rows("v1", [120, 900], "ok"), ids_per_part=100)
    changed = {p for p in after.parts["ledger"] if after.parts["ledger"][p] != before.parts["ledger"].get(p)}
    assert changed == {"v1-1", "v1-9"}
    ok = {(r.post_id, r.prompt_version) for r in store.read("ledger").filter("status = 'ok'").collect()}
    assert ok == {(120, "v1"), (900, "v1")} and store.read("ledger").count() == 351


def test_a_merge_goes_on_top_of_another_commit(spark, tmp_path):
    store, other = TableStore(spark, str(tmp_path)), TableStore(spark, str(tmp_path))
    newest = [F.desc("fetched_at")]
    ingest.store_posts(store, _posts(spark, range(10), "a", "1"), newest)
    load, raced = store._states.load, []

    def raced_load(number=None):
        found = load(number)
        if number is None and not raced:
            raced.append(True)
            ingest.store_posts(other, _posts(spark, [1, 2], "b", "2"), newest)
        return found

    store._states.load = raced_load
    ingest.store_posts(store, _posts(spark, [2, 3], "c", "3"), newest)
    got = {r.id: r.author for r in other.read("posts").collect()}
    assert got == {**{i: "a" for i in range(10)}, 1: "b", 2: "c", 3: "c"}


def test_ingest_into_store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    threads = [(1, "t", "hiring", "2020-01", "", None, None), (2, "t", "seekers", "2020-01", "", None, None)]
    ingest.store_threads(store, spark.createDataFrame(threads, THREADS))
    ingest.store_posts(store, _posts(spark, [1, 500], "old", "0"), [F.desc("fetched_at")], 100)
    children = "array<struct<id:long,author:string,created_at:string,text:string,deleted:boolean,dead:boolean>>"
    items = spark.createDataFrame(
        [(1, "t", "", 2, [(1, "new", "", "x", None, None), (2, "new", "", "x", True, None)]), (2, "t", "", 1, [(9, "n", "", "x", None, None)])],
        f"id long, title string, created_at string, num_comments long, children {children}",
    )
    ingest.ingest_posts_into(store, items, "1", ids_per_part=100)
    assert {r.id: r.author for r in store.read("posts").collect()} == {1: "new", 2: "new", 500: "old"}
    assert {r.id: r.fetched_at for r in store.read("threads").collect()} == {1: "1", 2: None}
    state = store.snapshot().number
    ingest.ingest_posts_into(store, items, "2", ids_per_part=100)
    assert {r.id: r.fetched_at for r in store.read("threads").collect()} == {1: "1", 2: None}
    assert store.snapshot().number > state and store.read("posts").filter("fetched_at = '2'").count() == 0


def test_first_rows_of_a_table_are_written_once(spark, tmp_path, monkeypatch):
    staged, stage = [], snapshots.stage
    monkeypatch.setattr(snapshots, "stage", lambda rows, name: staged.append(name) or stage(rows, name))
    store = TableStore(spark, str(tmp_path))
    rows = [[(1, "a", 1), (1, "b", 2), (250, "c", 1), (None, "d", 1)], [(1, "e", 1), (300, "f", 2)]]
    for part in rows:
        df = spark.createDataFrame(part, "id long, v string, seen int")
        store.merge("t", df, ["id"], F.floor(F.col("id") / 100), [F.desc("seen")])
    assert staged == ["updates"]
    assert {tuple(r) for r in store.read("t").select("id", "v").collect()} == {(1, "e"), (250, "c"), (300, "f"), (None, "d")}
    names = [n for _, _, files in os.walk(tmp_path / "data") for n in files if n.endswith(".parquet")]
    assert names and all(n.endswith(".zstd.parquet") for n in names)
