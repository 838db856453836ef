import json
import os
import time

import pytest
from py4j.protocol import Py4JJavaError

from threadmill.functions.answers import BadAnswer, compile_check, document_check
from threadmill.operators import infer
from threadmill.plans import extract as E
from threadmill.schemas import DOCUMENT, LEDGER, POSTS, THREADS, struct, TEXT, REAL, LONG
from threadmill.shipping import ship_package

RUN = "2025-01-01T00:00:00+00:00"

GOOD = {
    "post_type": "job_posting", "company": {"name": None, "stage": "seed", "industry_tags": ["a"]},
    "roles": [{"title_raw": "Cook", "title_guess": "qa", "salary": {"min": 1, "max": 2.5, "period": "year"}}],
    "technologies_raw": [], "locations": [{"city": "Oslo"}],
}


def test_good_answers_stay_as_they_are():
    assert document_check()(GOOD) == GOOD
    assert document_check()({"x": 1}) == {"x": 1}
    assert document_check()({}) == {}


def test_completed_answers_have_all_fields_and_no_other():
    full = document_check(complete=True)({**GOOD, "mood": "good"})

    def names(kind, value):
        if hasattr(kind, "fields"):
            assert set(value) == set(kind.names)
            for f in kind.fields:
                names(f.dataType, value[f.name])
        elif hasattr(kind, "elementType"):
            for v in value:
                names(kind.elementType, v)

    names(DOCUMENT, full)
    assert full["company"]["is_yc"] == "unstated" and full["roles"][0]["seniority"] == "unstated"
    assert full["roles"][0]["salary"] == {"min": 1, "max": 2.5, "currency_raw": None, "period": "year", "equity": "unstated"}
    empty = document_check(complete=True)({})
    assert empty["post_type"] == "job_posting" and empty["roles"] == [] and empty["company"]["name"] is None
    # Defaults are not shared between answers.
    empty["roles"].append(1)
    assert document_check(complete=True)({})["roles"] == []


@pytest.mark.parametrize(
    "answer, fault",
    [
        (None, "answer: null instead of an object"),
        ([], "answer: list instead of an object"),
        ("{}", "answer: text instead of an object"),
        ({"post_type": "advert"}, "post_type: 'advert' is not allowed"),
        ({"post_type": None}, "post_type: null instead of text"),
        ({"post_type": True}, "post_type: flag instead of text"),
        ({"roles": [GOOD["roles"][0], {}]}, "roles[1].title_raw: missing"),
        ({"roles": [{"title_raw": None}]}, "roles[0].title_raw: null instead of text"),
        ({"roles": {}}, "roles: object instead of a list"),
        ({"roles": [None]}, "roles[0]: null instead of an object"),
        ({"roles": [{"title_raw": "a", "salary": {"min": "1k"}}]}, "roles[0].salary.min: text instead of a number"),
        ({"roles": [{"title_raw": "a", "salary": {"max": float("nan")}}]}, "roles[0].salary.max: number instead of a number"),
        ({"technologies_raw": ["a", 1]}, "technologies_raw[1]: number instead of text"),
        ({"ai_signals": None, "company": {"is_yc": "Yes"}}, "company.is_yc: 'Yes' is not allowed; ai_signals: null instead of an object"),
    ],
)
def test_faults(answer, fault):
    for complete in (False, True):
        with pytest.raises(BadAnswer) as raised:
            document_check(complete)(answer)
        assert str(raised.value) == fault


def test_numbers():
    check = compile_check(struct(x=REAL), {})
    assert check({"x": "12.5"}) == {"x": 12.5} and check({"x": 3})["x"] == 3 and check({"x": None}) == {"x": None}
    with pytest.raises(TypeError):
        compile_check(struct(x=LONG), {})
    assert compile_check(struct(x=TEXT), {}, ["x"])({"x": ""}) == {"x": ""}


def test_a_bad_answer_uses_up_a_try():
    waits, answers = [], [({"post_type": "advert"}, 1, 1), ({"post_type": "job_posting"}, 2, 3)]
    got = infer.attempt(lambda t, p: answers.pop(0), "t", "p", waits.append, document_check())
    assert got == ('{"post_type": "job_posting"}', 2, 3, "ok", None) and waits == [2.0]
    got = infer.attempt(lambda t, p: (None, 1, 1), "t", "p", waits.append, document_check())
    assert got == ("{}", None, None, "error", "answer: null instead of an object")
    assert infer.attempt(lambda t, p: ([1], 1, 1), "t", "p")[:1] == ("[1]",)


def test_answers_for_evaluation_are_checked(spark):
    ship_package(spark)
    posts = spark.createDataFrame([(1, "good " * 20), (2, "bad " * 20)], "id long, raw_html string")
    extract = lambda text, prompt: ({"post_type": "job_posting" if "good" in text else "x"}, 1, 1)
    got = {r.post_id: r.raw_json for r in infer.extract_documents(posts, extract, "p").collect()}
    assert got == {1: '{"post_type": "job_posting"}', 2: "{}"}


# --- answers of finished chunks stay ----------------------------------------------------------


def _tables(spark, n):
    threads = spark.createDataFrame([(1, "t", "hiring", "2020-01", "", None, None)], THREADS)
    text = "a job for somebody who reads long posts, number {} of the list"
    posts = spark.createDataFrame([(i, 1, "a", "", text.format(i), 0, 0, "") for i in range(n)], POSTS)
    return posts, threads, spark.createDataFrame([], LEDGER)


class Noted:
    """Notes every call in a file; one post ends the worker until the file ``healed`` is there."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, text, prompt):
        number = text.split("number ")[1].split()[0]
        if number == "77" and not os.path.exists(f"{self.folder}/healed"):
            time.sleep(4)  # the other tasks go on meanwhile
            os._exit(1)
        with open(f"{self.folder}/calls", "a") as f:
            f.write(number + "\n")
        return {"hiring_count_hint": number}, 1, 1

    def calls(self):
        with open(f"{self.folder}/calls") as f:
            return [int(line) for line in f]


def test_a_broken_run_goes_on_where_it_ended(spark, tmp_path):
    ship_package(spark)
    tables, calls, journal = _tables(spark, 200), Noted(tmp_path), str(tmp_path / "journal")

    def run():
        return E.extract(*tables, calls, "p", RUN, sleep=lambda s: None, journal=journal, calls_per_commit=8)

    with pytest.raises(Py4JJavaError):
        run()
    finished = {r.post_id for r in E.journal_rows(spark, journal).collect()}
    assert 50 < len(finished) < 200 and 77 not in finished
    before = calls.calls()
    (tmp_path / "healed").touch()
    rows = {r.post_id: r for r in run().rows.collect()}
    again = calls.calls()[len(before):]
    assert set(again) == set(range(200)) - finished and len(again) == len(set(again))
    assert set(rows) == set(range(200))
    assert all(json.loads(r.raw_json) == {"hiring_count_hint": str(i)} for i, r in rows.items())
    total = len(calls.calls())
    done = run()
    assert len(calls.calls()) == total and done.ledger.count() == 200 and done.counters.first().ok == 200


def test_a_chunk_written_twice_counts_once(spark, tmp_path):
    tables, journal = _tables(spark, 30), str(tmp_path / "journal")
    extract = lambda text, prompt: ({}, 1, 1)
    ship_package(spark)
    E.extract(*tables, extract, "p", RUN, journal=journal)
    spark.read.parquet(journal).write.mode("append").parquet(journal + "-copy")
    spark.read.parquet(journal + "-copy").write.mode("append").parquet(journal)
    run = E.extract(*tables, extract, "p", RUN, journal=journal)
    assert run.rows.count() == 30 and run.counters.first().n == 30
