import json

import pytest
from pyspark.sql import functions as F

from threadmill.operators import ordering as O
from threadmill.operators.quality import field_mismatches
from threadmill.plans import golden as G
from threadmill.schemas import GOLDEN
from threadmill.shipping import ship_package


def _records(spark, wanted):
    rows = [(i, "2020-01", "<p>" + f"number {i} " * 10, None, json.dumps(d)) for i, d in wanted.items()]
    df = spark.createDataFrame(rows, "post_id long, month string, raw_html string, llm_output string, expected string")
    return df.withColumns({c: F.from_json(c, GOLDEN[c].dataType) for c in ("llm_output", "expected")})


def test_versions_are_compared_record_by_record(spark):
    ship_package(spark)
    wanted = {i: {"post_type": "job_posting" if i % 2 else "seeking_work", "technologies_raw": ["go"]} for i in range(1, 7)}
    golden = _records(spark, wanted)

    def old(text, prompt):
        return {"post_type": "job_posting", "technologies_raw": ["go"]}, 1, 1

    def new(text, prompt):
        if "number 5 " in text:
            raise ValueError("no answer")
        return {"post_type": "seeking_work", "technologies_raw": ["golang", "rust"]}, 1, 1

    predictions = G.predict_versions(golden, {"old": (old, "p"), "new": (new, "p"), "none": (new, "q")}).filter(
        "prompt_version <> 'none'"
    )
    scores = G.scored_versions(golden, predictions, ["old", "new", "none"])
    assert scores.count() == 18
    means = {(r.prompt_version, r.field): (r.score, r.n) for r in G.accuracy_of_versions(scores).collect()}
    # Three records each are right: the means are equal although no record is right in both.
    assert means["old", "post_type"] == means["new", "post_type"] == (0.5, 6)
    assert means["none", "post_type"] == (0.0, 6) and means["none", "company_name"] == (1.0, 6)
    changes = {(r.prompt_version, r.field): r for r in G.version_changes(scores, "old").collect()}
    post_type = changes["new", "post_type"]
    assert (post_type.n, post_type.gained, post_type.lost, post_type.base_score, post_type.score) == (6, 3, 3, 0.5, 0.5)
    precision = changes["new", "tech_precision"]
    assert (precision.gained, precision.lost) == (0, 6) and precision.score == pytest.approx(5 * 0.5 / 6)
    assert changes["new", "tech_recall"].lost == 1 and changes["none", "post_type"].lost == 3
    assert changes["new", "company_name"].gained == changes["new", "company_name"].lost == 0
    # The same version alone scores as before.
    alone = G.scored(golden, predictions.filter("prompt_version = 'new'").drop("prompt_version"))
    assert sorted(map(str, alone.collect())) == sorted(
        map(str, scores.filter("prompt_version = 'new'").drop("prompt_version").collect())
    )
    assert G.version_changes(scores.filter("prompt_version = 'new'"), "old").count() == 0


def test_mismatches_by_field(spark):
    texts = [
        '{"post_type": 5, "company": [], "locations": [{"city": 1}, "x", null], "roles": [{"salary": {"min": "a", "max": 3}}]}',
        '{"post_type": "job_posting", "roles": [{"salary": []}, {"title_raw": true, "salary": {"min": 1.5, "max": false}}], "extra": 1}',
        '{"technologies_raw": ["a", 1, null, {}], "workplace": null, "hiring_count_hint": null}',
        "{}", "[]", "no json", None, '{"post_type": 5} trailing', '{"post_type": 5', '"text"',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "raw_json string")
    found = field_mismatches(df)
    got = {r.field: r.mismatches for r in found.collect()}
    assert {f: n for f, n in got.items() if n} == {
        "post_type": 2, "company": 1, "locations": 1, "locations.city": 1, "roles.salary": 1, "roles.salary.min": 1,
        "roles.salary.max": 1, "roles.title_raw": 1, "technologies_raw": 2,
    }
    assert "application.email" in got and "roles.salary.equity" in got
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1


def test_mismatches_of_an_empty_table(spark):
    assert field_mismatches(spark.createDataFrame([], "raw_json string")).count() == 0


def test_running_totals_read_their_input_twice(spark, tmp_path):
    spark.range(1000).selectExpr("id", "1L as n").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    before = O.running_total_before(df, "n", "before", {"_r": O.id_range("id", 64)}, [F.col("id")])
    plan = before._jdf.queryExecution().optimizedPlan().toString()
    # Once in the plan itself, and once for the sums per range, which are written before.
    assert plan.count("Relation [id#") == 1
    assert {r.id: r.before for r in before.collect()} == {i: i for i in range(1000)}


def test_stratified_sample_reads_its_pool_once(spark, tmp_path):
    months = [f"20{10 + i % 3}-01" for i in range(300)] + [None, "2019-05"]
    rows = [(i, m, "<p>x") for i, m in enumerate(months)]
    spark.createDataFrame(rows, "id long, month string, raw_html string").write.parquet(str(tmp_path / "pool"))
    ids = G.stratified_ids(spark.read.parquet(str(tmp_path / "pool")), 20, "s")
    assert ids._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    counts = {r["year"]: r["n"] for r in ids.groupBy("year").agg(F.count("*").alias("n")).collect()}
    # Five years of which three have more than four posts; nothing is topped up.
    assert counts == {"2010": 4, "2011": 4, "2012": 4, "2019": 1, "0000": 1}
    assert G.stratified_ids(spark.read.parquet(str(tmp_path / "pool")).limit(0), 20).count() == 0
    assert G.stratified_ids(spark.read.parquet(str(tmp_path / "pool")), 3).count() == 3
