import json
import os

import pytest
from pyspark.sql import functions as F

from threadmill.checks import queries as Q
from threadmill.schemas import LEDGER, LEDGER_LOG, POSTS, POSTS_LOG, THREADS
from threadmill.sources.adapters import JobThreads
from threadmill.sources.manifest import StateLog
from threadmill.sources.tables import append_batch
from threadmill.streaming import incremental as I

RUN = "2025-01-01T00:00:00+00:00"


def _land(folder, name, thread, *posts):
    children = [{"id": i, "author": a, "created_at": "2020", "text": a * 60} for i, a in posts]
    (folder / name).write_text(json.dumps({"id": thread, "title": "t", "created_at": "2020", "children": children}))


def test_ingest_stream(spark, tmp_path):
    landing, log, state = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "state")
    landing.mkdir()
    _land(landing, "a.json", 1, (10, "a"), (11, "b"))
    _land(landing, "b.json", 2, (20, "c"))

    def run():
        I.ingest_stream(spark, str(landing), log, state, RUN, files_per_batch=1).awaitTermination()
        return {r.id: r.author for r in I.merged_posts(spark, log).collect()}

    assert run() == {10: "a", 11: "b", 20: "c"}
    rows = spark.read.parquet(log).count()
    assert run() == {10: "a", 11: "b", 20: "c"} and spark.read.parquet(log).count() == rows
    _land(landing, "c.json", 1, (11, "new"), (12, "d"))
    assert run() == {10: "a", 11: "new", 12: "d", 20: "c"}


def answer(text, prompt):
    return {"post_type": "job_posting"}, len(text), 1


def test_extract_stream(spark, tmp_path):
    posts_log, ledger_log, state = (str(tmp_path / n) for n in ("posts", "ledger", "state"))
    threads = spark.createDataFrame([(1, "t", "hiring", "2020-01", "", None, None)], THREADS)

    def batch(number, *ids):
        rows = [(i, 1, "a", "", "x" * 60, 0, 0, RUN) for i in ids]
        append_batch(spark.createDataFrame(rows, POSTS), posts_log, number)

    def run():
        I.extract_stream(
            spark, posts_log, threads, ledger_log, state, answer, "p", RUN, files_per_batch=1
        ).awaitTermination()
        return sorted(r.post_id for r in I.read_log(spark, ledger_log, LEDGER).collect())

    batch(0, 1, 2)
    assert run() == [1, 2]
    assert run() == [1, 2]
    batch(1, 2, 3)
    assert run() == [1, 2, 3]
    assert I.merged_ledger(spark, ledger_log).filter(F.col("status") == "ok").count() == 3


def _extract(spark, posts_log, threads, ledger_log, state, version, calls):
    def counted(text, prompt):
        calls.append(1)
        return answer(text, prompt)

    I.extract_stream(
        spark, posts_log, threads, ledger_log, state, counted, "p", RUN, version=version
    ).awaitTermination()


def test_streams_do_not_touch_rows_of_another_checkpoint(spark, tmp_path):
    posts_log, ledger_log = str(tmp_path / "posts"), str(tmp_path / "ledger")
    threads = spark.createDataFrame([(1, "t", "hiring", "2020-01", "", None, None)], THREADS)
    rows = [(i, 1, "a", "", "x" * 60, 0, 0, RUN) for i in (1, 2, 3)]
    append_batch(spark.createDataFrame(rows, POSTS), posts_log, 0)

    def versions():
        found = I.merged_ledger(spark, ledger_log).collect()
        return sorted((r.prompt_version, r.post_id) for r in found)

    for version, state in (("v1", "s1"), ("v2", "s2")):
        _extract(spark, posts_log, threads, ledger_log, str(tmp_path / state), version, [])
    both = [(v, i) for v in ("v1", "v2") for i in (1, 2, 3)]
    assert versions() == both
    # A lost checkpoint: all posts come again, but the ledger has them.
    _extract(spark, posts_log, threads, ledger_log, str(tmp_path / "s3"), "v1", [])
    assert versions() == both
    assert I.read_log(spark, ledger_log, LEDGER).count() == 6


def test_the_post_that_lands_last_stays(spark, tmp_path):
    landing, log = tmp_path / "in", str(tmp_path / "log")
    landing.mkdir()
    _land(landing, "a.json", 1, (10, "first"), (10, "second"), (11, "x"))
    _land(landing, "b.json", 1, (11, "y"))
    for name, time in (("a.json", 2_000_000_000), ("b.json", 1_900_000_000)):
        os.utime(landing / name, (time, time))
    I.ingest_stream(spark, str(landing), log, str(tmp_path / "state"), RUN).awaitTermination()
    assert {r.id: r.author for r in I.merged_posts(spark, log).collect()} == {10: "second", 11: "x"}


def test_log_that_does_not_exist_yet(spark, tmp_path):
    assert I.merged_posts(spark, str(tmp_path / "none")).count() == 0


def test_of_runs_with_one_time_the_later_one_counts(spark, tmp_path):
    """The later run has one batch, the earlier one three; the order of their random ids does not matter."""
    log = str(tmp_path / "log")
    for turn in range(3):
        landing = tmp_path / f"in{turn}"
        landing.mkdir()
        for name in "abc" if turn == 0 else "a":
            _land(landing, f"{name}.json", 1, (ord(name), f"run{turn}"), (10, f"run{turn}{name}"))
            os.utime(landing / f"{name}.json", (2_000_000_000 + 10 * turn + ord(name) % 10, 2_000_000_000 + 10 * turn + ord(name) % 10))
        I.ingest_stream(spark, str(landing), log, str(tmp_path / f"state{turn}"), RUN, files_per_batch=1).awaitTermination()
        got = {r.id: r.author for r in I.merged_posts(spark, log).collect()}
        last = "run0c" if turn == 0 else f"run{turn}a"
        assert got == {10: last, 97: f"run{turn}", 98: "run0", 99: "run0"}
        I.compact_posts(spark, log, fan=2)
        assert {r.id: r.author for r in I.merged_posts(spark, log).collect()} == got


def _post_batches(spark, log, first, n):
    """Batches in which post 0 comes each time and two posts are new."""
    for number in range(first, first + n):
        rows = [(i, 1, f"b{number}", "", "x", 0, 0, RUN, ((None, number), 0)) for i in (0, 2 * number + 1, 2 * number + 2)]
        append_batch(spark.createDataFrame(rows, POSTS_LOG).coalesce(1), log, number, "run-a")


def _opened(folder):
    return len([1 for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")])


def test_compaction_bounds_what_a_read_opens(spark, tmp_path):
    log = str(tmp_path / "log")
    assert I.compact_posts(spark, log) == 0
    for turn in range(5):
        _post_batches(spark, log, 4 * turn, 4)
        parts = I.compact_posts(spark, log, fan=4)
        # One part of tier 1 per turn; four of them become one of tier 2.
        assert parts == (turn % 4 + 1 if turn < 3 else turn - 2)
    _post_batches(spark, log, 20, 1)

    def rows():
        return sorted((r.id, r.author) for r in I.merged_posts(spark, log).collect())

    want = sorted([(0, "b20")] + [(i, f"b{(i - 1) // 2}") for i in range(1, 43)])
    assert rows() == want
    # Merged batches are not opened: rubbish in their files does no harm. Nor is it once they are cleared.
    merged = [d for d in (tmp_path / "log" / "run=run-a").iterdir() if d.name != "batch_id=20"]
    assert len(merged) == 20
    for folder in merged:
        for file in folder.glob("*.parquet"):
            file.write_bytes(b"rubbish")
            (folder / f".{file.name}.crc").unlink(missing_ok=True)
    assert rows() == want
    assert I.clear_merged(spark, log) == 20 + 4
    assert _opened(log) == 3 and rows() == want
    # The log goes on as before.
    _post_batches(spark, log, 21, 3)
    assert I.compact_posts(spark, log, fan=4) == 3 and len(rows()) == 49


def test_compaction_that_breaks_changes_nothing(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    _post_batches(spark, log, 0, 5)
    want = sorted(map(str, I.merged_posts(spark, log).collect()))

    def broken(self, base, state):
        raise OSError("broken")

    with monkeypatch.context() as m:
        m.setattr(StateLog, "store", broken)
        with pytest.raises(OSError):
            I.compact_posts(spark, log, fan=2)
    assert sorted(map(str, I.merged_posts(spark, log).collect())) == want
    assert I.compact_posts(spark, log, fan=2) == 1
    assert sorted(map(str, I.merged_posts(spark, log).collect())) == want


def test_ledger_log_is_compacted_by_post_and_version(spark, tmp_path):
    posts_log, log = str(tmp_path / "posts"), str(tmp_path / "ledger")
    threads = spark.createDataFrame([(1, "t", "hiring", "2020-01", "", None, None)], THREADS)
    append_batch(spark.createDataFrame([(i, 1, "a", "", "x" * 60, 0, 0, RUN) for i in (1, 2)], POSTS), posts_log, 0)
    for version in ("v1", "v2"):
        _extract(spark, posts_log, threads, log, str(tmp_path / version), version, [])
    assert I.compact_ledger(spark, log, fan=2) == 1 and I.clear_merged(spark, log) == 2
    _extract(spark, posts_log, threads, log, str(tmp_path / "again"), "v1", [])
    found = sorted((r.prompt_version, r.post_id) for r in I.merged_ledger(spark, log).collect())
    assert found == [("v1", 1), ("v1", 2), ("v2", 1), ("v2", 2)]
    assert I.read_log(spark, log, LEDGER_LOG).count() == 4


def test_files_of_the_streams_do_not_grow_with_the_tables(spark, tmp_path, monkeypatch):
    docs = spark.range(40).selectExpr("id as doc_id", "repeat(cast(id as string), 60) as text")
    docs.repartition(40).write.parquet(f"{tmp_path}/documents.parquet")
    j, landed, write = JobThreads(spark, str(tmp_path)), [], Q._landed
    monkeypatch.setattr(Q, "_landed", lambda j, rows, name: landed.append(rows.rdd.getNumPartitions()) or write(j, rows, name))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for size in (was, "1k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found.append(sorted(map(str, Q.posts_stream(j).collect())))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert found[0] == found[1] and len(found[0]) > 30
    assert landed[1] >= 40 and landed[1] > landed[0]
