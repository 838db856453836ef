import pytest
from pyspark.sql import functions as F

from threadmill.plans import datasets, golden, report, stats
from threadmill.schemas import DOCUMENT, GOLDEN, POSTS, THREADS

JOBS = (
    "job_id long, post_id long, prompt_version string, title_normalized string, salary_min double, "
    "visa_sponsorship string, workplace_policy string, company_name string, month string"
)


@pytest.fixture(scope="module")
def jobs(spark):
    rows = [
        (1, 1, "v1", "backend", 1.0, "yes", "remote", "A", "2020-01"),
        (2, 1, "v1", "backend", None, None, "onsite", "A", "2020-01"),
        (3, 2, "v1", None, None, "", "remote", None, "2020-02"),
        (4, 3, "v1", "qa", None, "yes", None, "B", "2021-01"),
        (5, 3, "v2", "qa", 1.0, "no", None, "B", "2021-01"),
    ]
    return spark.createDataFrame(rows, JOBS)


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_job_reports(jobs):
    assert _rows(report.salary_coverage(jobs)) == [(4, 1, 25.0)]
    assert sorted(_rows(report.visa_sponsorship(jobs))) == [("null", 1, 25.0), ("null", 1, 25.0), ("yes", 2, 50.0)]
    assert _rows(report.top_titles(jobs)) == [("backend", 2), ("qa", 1)]
    assert _rows(report.jobs_per_month(jobs)) == [("2020-01", 2, "█"), ("2020-02", 1, "▄"), ("2021-01", 1, "▄")]
    assert _rows(report.salary_coverage(jobs, "v9")) == [(0, 0, 0.0)]


def test_job_level_rows_follow_their_job(spark, jobs):
    named = spark.createDataFrame([(1, "go"), (1, "go"), (5, "go"), (77, "go"), (4, "zig")], "job_id long, tech string")
    assert _rows(report.top_technologies(report.of_jobs(named, jobs))) == [("go", 2), ("zig", 1)]


def test_datasets(jobs, spark):
    v1 = report.of_version(jobs, "v1")
    assert sorted(_rows(datasets.remote_share(v1))) == [
        ("2020-01", 2, 1, 50.0), ("2020-02", 1, 1, 100.0), ("2021-01", 1, 0, 0.0),
    ]
    assert sorted(_rows(datasets.leaderboard(v1, "company_name", 1))) == [("2020", 1, "A", 2), ("2021", 1, "B", 1)]
    named = spark.createDataFrame([("2020-01", "go"), ("2020-01", "go"), ("2020-02", "zig")], "month string, tech string")
    got = datasets.compare_technologies(named, ["go", "zig", "c"]).orderBy("month")
    assert _rows(got) == [("2020-01", 2, 0, 0), ("2020-02", 0, 1, 0)]
    with pytest.raises(ValueError):
        datasets.compare_technologies(named, ["go"])


def test_report_totals_agree(spark, jobs):
    ledger = spark.createDataFrame([("v1", "ok"), ("v1", "error"), ("v1", "ok")], "prompt_version string, status string")
    classes = spark.createDataFrame([("v1", "job_posting")] * 3, "prompt_version string, post_type string")
    tech = spark.createDataFrame(
        [("v1", "go", "go", 1), ("v1", "Zig", "zig", 0), ("v1", "zig", "zig", 0), ("v2", "x", "x", 0)],
        "prompt_version string, tech_raw string, tech string, aliased int",
    )
    places = spark.createDataFrame([("v1", "Oslo"), ("v1", None), ("v1", "")], "prompt_version string, city string")
    rows = report.report(ledger, classes, jobs, places, tech).collect()

    def section(name):
        return {r.key: r.n for r in rows if r.section == name}

    assert section("extraction_status") == {"ok": 2, "error": 1}
    assert section("jobs") == {"total": 4, "with_salary": 1}
    assert sum(section("month").values()) == 4 == sum(r.n for r in rows if r.section == "visa_sponsorship")
    assert section("technology") == {"zig": 2, "go": 1}
    assert section("unmapped_technology") == {"Zig": 1, "zig": 1}
    assert section("city") == {"Oslo": 1, "": 1}
    assert report.report(ledger, classes, jobs, places, tech, "v9").count() == 0


def test_stats(spark):
    threads = spark.createDataFrame(
        [
            (1, "", "hiring", "2020-01", "", None, None), (2, "", "hiring", "2020-02", "", None, None),
            (3, "", "hiring", None, "", None, None), (4, "", "other", "2019-01", "", None, None),
        ],
        THREADS,
    )
    posts = spark.createDataFrame([(i, t, "a", "2020-01-05T", "<p>x", 0, 0, "") for i, t in enumerate((1, 1, 3, 4, 9))], POSTS)
    assert _rows(stats.posts_per_month(threads, posts)) == [("2020-01", 2, "█"), ("2020-02", 0, "▁")]
    assert _rows(stats.hiring_months(threads)) == [("2020-01", "2020-02")]
    first = _rows(stats.sample_posts(posts, 2, "s"))
    assert first == _rows(stats.sample_posts(posts.repartition(3), 2, "s")) and len(first) == 2
    assert first[0][1:] == ("a", "2020-01-05", "x")


# --- golden set ---------------------------------------------------------------------------


def _document(**fields):
    return tuple(fields.get(name) for name in DOCUMENT.names)


def _role(title=None, low=None, high=None):
    return (None, title, None, None, (low, high, None, None, None))


def _golden(spark, *pairs):
    return spark.createDataFrame([(i, None, None, got, want) for i, (got, want) in enumerate(pairs)], GOLDEN)


def _scores(spark, prediction, expected):
    golden_rows = _golden(spark, (None, expected))
    predictions = golden_rows.select("post_id").withColumn("prediction", F.lit(None).cast(DOCUMENT))
    if prediction is not None:
        predictions = spark.createDataFrame([(0, prediction)], f"post_id long, prediction {DOCUMENT.simpleString()}")
    return golden.scored(golden_rows, predictions).first().asDict()


def test_labelled_records(spark):
    same, other = _document(post_type="a"), _document(post_type="b")
    rows = _golden(spark, (same, other), (same, same), (same, None), (same, _document()), (None, other))
    assert [r.post_id for r in golden.labelled(rows).orderBy("post_id").collect()] == [0, 4]
    assert [r.post_id for r in golden.labelled(rows, include_unchanged=True).orderBy("post_id").collect()] == [0, 1, 4]


def test_scores(spark):
    want = _document(
        post_type="job_posting", visa_sponsorship="no", roles=[_role("qa", 1.0, 2.0), _role("cto")],
        technologies_raw=["Golang", "go", "Zig"],
    )
    got = _document(
        post_type="job_posting", visa_sponsorship="yes", roles=[_role("qa", 1.0, 3.0)],
        technologies_raw=["go", "k8s", "rust"],
    )
    s = _scores(spark, got, want)
    assert (s["post_type"], s["visa_sponsorship"], s["company_name"], s["salary_min"]) == (1.0, 0.0, 1.0, 1.0)
    assert (s["salary_max"], s["roles_count"], s["title_guess"]) == (0.0, 0.0, 1.0)
    assert s["tech_precision"] == pytest.approx(1 / 3) and s["tech_recall"] == 0.5


def test_scores_of_empty_documents(spark):
    s = _scores(spark, _document(roles=[]), _document(post_type="x", roles=[_role()]))
    assert (s["roles_count"], s["post_type"], s["tech_precision"], s["tech_recall"]) == (1.0, 0.0, 1.0, 1.0)
    s = _scores(spark, None, _document(technologies_raw=["go"]))
    assert (s["tech_precision"], s["tech_recall"], s["post_type"]) == (0.0, 0.0, 1.0)


def test_accuracy_has_a_row_per_field(spark):
    scores = golden.scored(_golden(spark, (None, _document(post_type="x"))), _golden(spark).select("post_id", F.col("expected").alias("prediction")))
    rows = {r.field: (r.prompt_version, r.score, r.n) for r in golden.accuracy(scores, "v2").collect()}
    assert len(rows) == 10 and rows["post_type"] == ("v2", 0.0, 1)
    assert golden.accuracy(scores.filter("false")).count() == 0


def test_stratified_sample(spark):
    months = ["2019-01"] * 50 + ["2020-05"] * 2 + [None] * 30
    pool = spark.createDataFrame([(i, m) for i, m in enumerate(months)], "id long, month string")
    got = golden.stratified_ids(pool, 10, "s").collect()
    per_year = {y: sum(r.year == y for r in got) for y in ("2019", "2020", "0000")}
    # 10 // 3 per year, and a small year is not made up for.
    assert per_year == {"2019": 3, "2020": 2, "0000": 3}
    assert got == golden.stratified_ids(pool.repartition(5), 10, "s").collect()
    assert golden.stratified_ids(pool, 2, "s").count() == 2


def answer(text, prompt):
    if "fail" in text:
        raise ValueError
    return {"post_type": "job_posting", "hiring_count_hint": text[:4]}, 1, 1


def test_skeletons_are_added_once(spark, tmp_path):
    path = str(tmp_path / "golden")
    html = ["some text " * 12, "fail text " * 12, "more text " * 12]
    pool = spark.createDataFrame([(i, "2020-01", h) for i, h in enumerate(html)], "id long, month string, raw_html string")
    from threadmill.sources.landed import read_golden

    existing = spark.createDataFrame([], GOLDEN)
    golden.append_skeletons(golden.golden_skeletons(pool.filter("id < 2"), existing, answer, "p"), path)
    golden.append_skeletons(golden.golden_skeletons(pool, read_golden(spark, path), answer, "p"), path)
    rows = {r.post_id: r for r in read_golden(spark, path).collect()}
    assert sorted(rows) == [0, 1, 2]
    assert rows[0].llm_output == rows[0].expected and rows[0].expected.hiring_count_hint == "some"
    assert rows[1].expected == DOCUMENT_OF_NULLS or rows[1].expected.post_type is None
    assert golden.labelled(read_golden(spark, path)).count() == 0
    predictions = golden.predict(read_golden(spark, path), answer, "p").collect()
    assert {p.post_id for p in predictions} == {0, 1, 2}


DOCUMENT_OF_NULLS = _document()
