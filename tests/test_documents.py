import json

import pytest
from pyspark.sql import functions as F

from threadmill.operators import documents as D
from threadmill.operators import quality
from threadmill.plans import normalize as N
from threadmill.sources.dims import built_in_dimensions
from threadmill.sources.tables import read_table

GOOD = {
    "{}": True,
    '{"roles":[]}': True,
    ' {"post_type": "meta_or_other"} ': True,
    '{"post_type": "a", "post_type": "b"}': True,
    '{"roles":[{"title_raw":"x","salary":{"min":"150","max":NaN}}]}': True,
    '{"roles": {}}': True,
    '{"roles":[{"salary":{"min":"low"}},{"title_raw":"second"}], "visa_sponsorship": "yes"}': True,
    "not json": False,
    "[]": False,
    "[{}]": False,
    "null": False,
    "3": False,
    '"text"': False,
    "": False,
    "{} trailing": False,
    '{"a":1}{"b":2}': False,
    "{'post_type': 'x'}": False,
    '{"post_type": "x"': False,
}


def _posts(spark, documents, months=None):
    rows = [
        (i, "v1", (months or {}).get(i, "2020-01"), d if isinstance(d, str) else json.dumps(d))
        for i, d in enumerate(documents)
    ]
    return spark.createDataFrame(rows, "post_id long, prompt_version string, month string, raw_json string")


def test_what_counts_as_a_document(spark):
    got = D.decode(_posts(spark, list(GOOD))).select("raw_json", "doc").collect()
    assert {r.raw_json: r.doc is not None for r in got} == GOOD


def test_wrong_types_are_null_and_counted(spark):
    documents = ['{"roles":[{"salary":{"min":"low"}},{"title_raw":"second"}],"visa_sponsorship":"yes"}', "{}", "[]"]
    decoded = D.decode(_posts(spark, documents))
    doc = decoded.filter("post_id = 0").first().doc
    assert doc.roles[0].salary.min is None and doc.roles[1].title_raw == "second"
    assert doc.visa_sponsorship == "yes"
    assert tuple(quality.undecodable(decoded).first()) == (3, 1, 1)


def test_documents_are_parsed_once(spark):
    decoded = D.decoded_posts(_posts(spark, ["{}"]))
    tables = D.jobs(decoded, built_in_dimensions(spark)).filter("month = '2020-01'")
    plan = tables._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(doc,StructType(StructField(post_type") == 1


@pytest.fixture(scope="module")
def three_posts(spark):
    documents = [
        {},
        {
            "post_type": "seeking_work",
            "company": {"name": "Acme", "stage": "seed", "is_yc": "no"},
            "locations": [{"city": "sf", "region": "CA", "country_raw": None}, None, {"country_raw": "uk"}],
            "workplace": {"policy": "remote", "remote_region_raw": "EU only"},
            "visa_sponsorship": "no",
            "roles": [
                {"title_raw": "Dev", "title_guess": "backend", "salary": {"min": 90, "max": 80, "period": "year", "currency_raw": "€"}},
                {"title_raw": "Ops", "salary": None},
            ],
            "technologies_raw": ["Golang", "golang", "Zig"],
            "ai_signals": {"company_builds_ai": "yes"},
        },
        {"post_type": None, "roles": [{"title_raw": "QA"}], "technologies_raw": ["k8s"], "locations": None},
    ]
    return D.decoded_posts(_posts(spark, [json.dumps(d) for d in documents])).cache()


def test_jobs(spark, three_posts):
    jobs = D.jobs(D.with_first_job_id(three_posts), built_in_dimensions(spark)).orderBy("job_id").collect()
    assert [(j.job_id, j.post_id, j.role_pos, j.title_raw) for j in jobs] == [
        (1, 0, 0, None), (2, 1, 0, "Dev"), (3, 1, 1, "Ops"), (4, 2, 0, "QA"),
    ]
    dev = jobs[1]
    assert (dev.salary_min, dev.salary_max, dev.salary_currency) == (80_000.0, 90_000.0, "EUR")
    assert (dev.company_name, dev.remote_region, dev.title_normalized) == ("Acme", "eu_only", "backend")
    assert jobs[2].company_name == "Acme" and jobs[2].salary_period is None


def test_locations_and_technologies_repeat_per_job(spark, three_posts):
    dims = built_in_dimensions(spark)
    places = D.job_locations(three_posts, dims).filter("post_id = 1").collect()
    assert sorted((p.role_pos, p.city or "", p.country) for p in places) == [
        (0, "", "GB"), (0, "San Francisco", "US"), (1, "", "GB"), (1, "San Francisco", "US"),
    ]
    named = D.job_technologies(D.with_first_job_id(three_posts), dims).collect()
    assert sorted((t.job_id, t.tech_raw, t.tech, t.aliased) for t in named) == [
        (2, "Golang", "go", 1), (2, "Zig", "zig", 0), (2, "golang", "go", 1),
        (3, "Golang", "go", 1), (3, "Zig", "zig", 0), (3, "golang", "go", 1),
        (4, "k8s", "kubernetes", 1),
    ]


def test_classification_and_posting_filter(spark, three_posts):
    rows = D.post_classification(three_posts).orderBy("post_id").collect()
    assert [r.post_type for r in rows] == ["job_posting", "seeking_work", "job_posting"]
    assert rows[1].ai_builds == "yes" and rows[1].ai_skills is None
    only = D.jobs(three_posts, built_in_dimensions(spark), only_job_postings=True)
    assert {r.post_id for r in only.collect()} == {0, 2}


def test_quality_counts(spark, three_posts):
    found = {r.field: r.violations for r in quality.domain_violations(three_posts).collect()}
    assert sum(found.values()) == 0 and len(found) == 13
    bad = [
        {"post_type": "advert", "company": {"stage": "series_z"}, "visa_sponsorship": "perhaps"},
        {"roles": [{"title_raw": None, "seniority": "guru", "salary": {"period": "decade", "min": 9e9}}, {"title_raw": "x"}]},
        {"roles": [{"salary": {"period": "year", "max": 3_000_000}}], "ai_signals": {"company_builds_ai": "maybe"}},
    ]
    decoded = D.decoded_posts(_posts(spark, bad))
    found = {r.field: r.violations for r in quality.domain_violations(decoded).collect() if r.violations}
    assert found == {
        "post_type": 1, "company.stage": 1, "visa_sponsorship": 1, "roles.seniority": 1,
        "roles.salary.period": 1, "ai_signals.company_builds_ai": 1,
    }
    assert quality.missing_role_titles(decoded).first().missing == 2
    assert quality.capped_salaries(decoded).first().capped_salaries == 1


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert quality.orphans(child, "k", parent, "id", "x").first().orphans == 2


@pytest.fixture(scope="module")
def raw_tables(spark):
    threads = spark.createDataFrame(
        [(1, "t", "hiring", "2020-01", "", None, None), (2, "t", "hiring", None, "", None, None)],
        "id long, title string, kind string, month string, created_at string, num_comments long, fetched_at string",
    )
    posts = spark.createDataFrame([(i, 1 + i % 2) for i in range(10)] + [(99, 7)], "id long, thread_id long")
    rows = []
    for version in ("v1", "v2"):
        for i in [*range(10), 50, 99]:
            doc = {"roles": [{"title_raw": str(r)} for r in range(i % 3)], "technologies_raw": [version]}
            status = "error" if i == 4 else "ok"
            rows.append((i, version, "broken" if i == 5 else json.dumps(doc), status))
    ledger = spark.createDataFrame(rows, "post_id long, prompt_version string, raw_json string, status string")
    return ledger, posts, threads


def test_normalize_is_repeatable_and_replaces(spark, raw_tables, tmp_path):
    dims = built_in_dimensions(spark)
    folder = str(tmp_path / "tables")

    def run(version, **options):
        N.write_tables(N.normalize(*raw_tables, dims, version), folder, **options)
        return {
            name: sorted(map(repr, read_table(spark, f"{folder}/{name}").collect()))
            for name in ("jobs", "job_locations", "job_technologies", "post_classification")
        }

    first = run("v1")
    assert run("v1") == first
    # 8 posts have a thread, an ok row and a document; posts 2 and 8 have two roles.
    assert len(first["post_classification"]) == 8
    assert len(first["jobs"]) == 10
    jobs = read_table(spark, f"{folder}/jobs").orderBy("job_id").collect()
    assert [j.job_id for j in jobs] == list(range(1, 11))
    assert [(j.post_id, j.role_pos) for j in jobs] == sorted((j.post_id, j.role_pos) for j in jobs)
    assert {j.month for j in jobs} == {"2020-01", "unknown"}
    run("v2")
    assert {r.prompt_version for r in read_table(spark, f"{folder}/jobs").collect()} == {"v2"}


def test_versions_side_by_side(spark, raw_tables, tmp_path):
    dims = built_in_dimensions(spark)
    for version in ("v1", "v2", "v2"):
        tables = N.normalize(*raw_tables, dims, version)
        N.write_tables(tables, str(tmp_path), keep_other_versions=True)
    counts = read_table(spark, str(tmp_path / "jobs")).groupBy("prompt_version").count().collect()
    assert {(r.prompt_version, r["count"]) for r in counts} == {("v1", 10), ("v2", 10)}


def test_plain_rebuild_and_versions_mix(spark, raw_tables, tmp_path):
    dims = built_in_dimensions(spark)
    for version, keep in (("v1", False), ("v2", True)):
        N.write_tables(N.normalize(*raw_tables, dims, version), str(tmp_path), keep_other_versions=keep)
    counts = read_table(spark, str(tmp_path / "jobs")).groupBy("prompt_version").count().collect()
    assert {(r.prompt_version, r["count"]) for r in counts} == {("v1", 10), ("v2", 10)}
    N.write_tables(N.normalize(*raw_tables, dims, "v1"), str(tmp_path))
    assert {r.prompt_version for r in read_table(spark, str(tmp_path / "jobs")).collect()} == {"v1"}


def test_only_whole_json_objects_are_documents(spark):
    texts = {
        '{"post_type":"a"}': "a",
        ' {"post_type":"a"} ': "a",
        '{"post_type":"a"},"y":1': None,
        '{},"doc":{"post_type":"evil"}': None,
        '{"post_type":NaN},"doc":{"post_type":"evil"}': None,
        '{"post_type":"a"} tail': None,
        '{"post_type":"a"}}, {"x":1': None,
        '{"post_type":"a"}} {"x":1': None,
        '{"post_type":"a"},"end":1} ': None,
        "[]": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame(list(enumerate(texts)), "id int, raw_json string")
    got = {r.id: r.doc for r in D.decode(df).collect()}
    assert [got[i] and got[i].post_type for i in range(len(texts))] == list(texts.values())


def test_ids_of_postings_only_stay_dense(spark, raw_tables):
    dims = built_in_dimensions(spark)
    ledger, posts, threads = raw_tables
    meta = ledger.selectExpr(
        "post_id", "prompt_version",
        """if(post_id = 2, '{"post_type":"meta_or_other","roles":[{},{}]}', raw_json) as raw_json""", "status",
    )
    tables = N.normalize(meta, posts, threads, dims, only_job_postings=True)
    assert sorted(r.job_id for r in tables.jobs.collect()) == list(range(1, 9))
    assert tables.post_classification.count() == 8
