import random

from pyspark.sql import functions as F

from threadmill.operators import merge, queue
from threadmill.operators import ordering as O
from threadmill.plans.ingest import fetch_totals


def test_running_total_before(spark):
    rng = random.Random(1)
    rows = [(i, rng.randint(0, 5)) for i in rng.sample(range(5000), 700)]
    df = spark.createDataFrame(rows, "id long, n long")
    got = O.running_total_before(df, "n", "before", {"_r": O.id_range("id", 64)}, [F.col("id")]).collect()
    total, want = 0, {}
    for i, n in sorted(rows):
        want[i] = total
        total += n
    assert {r.id: r.before for r in got} == want


def test_no_step_brings_all_rows_together(spark):
    df = spark.createDataFrame([(1, 1)], "id long, n long")
    ranged = O.running_total_before(df, "n", "before", {"_r": O.id_range("id", 64)}, [F.col("id")])
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    single = plan.index("Exchange SinglePartition")
    assert plan.count("SinglePartition") == 1
    # What meets in one task is already summed per range.
    assert "HashAggregate(keys=[_r" in plan[single:]


def test_first_rows_per_group_with_a_hot_group(spark):
    rng = random.Random(2)
    rows = [(i, "hot" if i % 3 else f"g{i % 7}", rng.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    got = O.first_rows_per_group(df, ["g"], [F.col("x")], 20, F.col("id")).collect()
    for group in {g for _, g, _ in rows}:
        want = [i for i, g, x in sorted(rows, key=lambda r: r[2]) if g == group][:20]
        assert [r.id for r in sorted(got, key=lambda r: r["rank"]) if r.g == group] == want


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id long, v string, seq long")
    latest = merge.latest_per_key(df, ["id"], [F.desc("seq")])
    assert {(r.id, r.v) for r in latest.collect()} == {(1, "b"), (2, "c")}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > 0 and "Partial" in plan


def test_newest_first_is_sorted_for_every_limit(spark):
    rng = random.Random(4)
    months = [None, "2019-12", "2020-01", "2020-02"]
    rows = [(i, rng.choice(months)) for i in range(0, 900_000, 3000)]
    df = spark.createDataFrame(rows, "id long, month string")
    want = [r[0] for r in sorted(rows, key=lambda r: (-(int((r[1] or "0").replace("-", ""))), r[0]))]
    assert [r.id for r in queue.newest_first(df).collect()] == want
    assert [r.id for r in queue.newest_first(df, 0).collect()] == want
    assert [r.id for r in queue.newest_first(df, 77).collect()] == want[:77]


def test_top_counts_break_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [(r.k, r.n) for r in O.top_counts(df, "k", 2).collect()] == [("c", 2), ("a", 1)]


def test_fetch_totals(spark):
    threads = spark.createDataFrame([(1, "2020-02"), (2, "2020-01"), (3, None), (4, "2020-01")], "id long, month string")
    posts = spark.createDataFrame([(t,) for t in (1, 1, 1, 2, 3, 3, 4)], "thread_id long")
    got = fetch_totals(posts, threads).orderBy("running_total").collect()
    assert [(r.thread_id, r.n, r.running_total) for r in got] == [(3, 2, 2), (2, 1, 3), (4, 1, 4), (1, 3, 7)]
