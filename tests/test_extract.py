import json

import pytest
from pyspark.sql import functions as F

from threadmill.operators import infer, queue
from threadmill.plans import extract as E
from threadmill.schemas import LEDGER, POSTS, THREADS
from threadmill.sources.dims import built_in_prices

RUN = "2025-01-01T00:00:00+00:00"


class Calls:
    """An extractor that plays back outcomes and notes the waits."""

    def __init__(self, *outcomes):
        self.outcomes, self.waits, self.texts = list(outcomes), [], []

    def __call__(self, text, prompt):
        self.texts.append((text, prompt))
        outcome = self.outcomes.pop(0)
        if isinstance(outcome, Exception):
            raise outcome
        return outcome

    def run(self):
        return infer.attempt(self, "text", "prompt", self.waits.append)


OK = ({"a": 1}, 5, 7)


@pytest.mark.parametrize(
    "outcomes, answer, waits",
    [
        ([OK], ('{"a": 1}', 5, 7, "ok", None), []),
        ([ValueError("x"), OK], ('{"a": 1}', 5, 7, "ok", None), [2.0]),
        ([ValueError("x"), ValueError("y"), ValueError("z")], ("{}", None, None, "error", "z"), [2.0, 4.0]),
        ([infer.RateLimited(), infer.RateLimited(), OK], ('{"a": 1}', 5, 7, "ok", None), [2.0, 4.0]),
        ([infer.RateLimited("", 30), ValueError("x"), OK], ('{"a": 1}', 5, 7, "ok", None), [30.0, 30.0]),
        ([infer.RateLimited()] * 3, ("{}", None, None, "error", None), [2.0, 4.0, 8.0]),
        ([ValueError("x"), infer.RateLimited("", 1), infer.RateLimited()], ("{}", None, None, "error", "x"), [2.0, 1.0, 8.0]),
    ],
)
def test_attempts(outcomes, answer, waits):
    calls = Calls(*outcomes)
    assert calls.run() == answer
    assert calls.waits == waits


def by_length(text, prompt):
    if "fail" in text:
        raise ValueError("told to")
    return {"hiring_count_hint": prompt + str(len(text))}, len(text), 1


def never(text, prompt):
    raise AssertionError("called")


LONG = "good text " * 10


@pytest.fixture(scope="module")
def tables(spark):
    threads = spark.createDataFrame(
        [
            (1, "t", "hiring", "2020-01", "", None, None),
            (2, "t", "hiring", "2020-02", "", None, None),
            (3, "t", "seekers", "2020-03", "", None, None),
            (4, "t", "hiring", None, "", None, None),
        ],
        THREADS,
    )
    posts = [
        (1, 1, LONG, 0, 0), (2, 2, LONG, 0, 0), (3, 3, LONG, 0, 0), (4, 4, LONG, 0, 0), (5, 2, "short", 0, 0),
        (6, 2, LONG, 1, 0), (7, 2, None, 0, 0), (8, 2, "fail " + LONG, 0, 0), (9, 1, "<p>" + "x" * 30_000, 0, 0),
        (10, 1, LONG, 0, 0), (11, 1, LONG, 0, 0), (12, 9, LONG, 0, 0),
    ]
    posts = spark.createDataFrame([(i, t, "a", "", h, d, k, "") for i, t, h, d, k in posts], POSTS)
    ledger = spark.createDataFrame(
        [
            (10, "v1", 1, "m", "{}", None, None, "error", "x", ""),
            (11, "v1", 1, "m", "{}", 1, 1, "ok", None, ""),
            (1, "v0", 1, "m", "{}", 1, 1, "ok", None, ""),
        ],
        LEDGER,
    )
    return posts, threads, ledger


def _ids(df):
    return [r.id for r in df.collect()]


def test_queue(tables):
    queued = queue.posts_to_extract(*tables)
    assert _ids(queue.newest_first(queued)) == [2, 5, 6, 7, 8, 1, 9, 4]
    assert sorted(_ids(queue.posts_to_extract(*tables, retry_errors=True))) == [1, 2, 4, 5, 6, 7, 8, 9, 10]
    assert sorted(_ids(queue.posts_to_extract(*tables, force=True))) == [1, 2, 4, 5, 6, 7, 8, 9, 10, 11]
    assert sorted(_ids(queue.posts_to_extract(*tables, month="2020-01"))) == [1, 9]
    assert sorted(_ids(queue.posts_to_extract(*tables, version="v0"))) == [2, 4, 5, 6, 7, 8, 9, 10, 11]


def _sleepless(seconds):
    pass


def test_extraction_run(spark, tables):
    run = E.extract(*tables, by_length, "p", RUN, sleep=_sleepless, partitions=3)
    rows = {r.post_id: r for r in run.rows.collect()}
    assert {i: r.status for i, r in rows.items()} == {
        1: "ok", 2: "ok", 4: "ok", 5: "skipped_empty", 6: "skipped_empty", 7: "skipped_empty", 8: "error", 9: "ok",
    }
    assert json.loads(rows[1].raw_json) == {"hiring_count_hint": f"p{len(LONG.strip())}"}
    assert rows[9].input_tokens == 24_000
    assert (rows[8].raw_json, rows[8].error, rows[5].input_tokens) == ("{}", "told to", None)
    counters = run.counters.first()
    assert (counters.n, counters.ok, counters.error, counters.skipped_empty) == (8, 4, 1, 3)
    assert counters.input_tokens == sum(r.input_tokens or 0 for r in rows.values())
    assert run.ledger.count() == 11
    with pytest.raises(E.TooManyErrors, match="1 of 8"):
        E.check_error_rate(run.rows)
    E.check_error_rate(run.rows.filter("status <> 'error'"))
    E.check_error_rate(run.rows.filter("false"))
    # Nothing is left, so nothing is called.
    again = E.extract(tables[0], tables[1], run.ledger, never, "p", RUN, sleep=_sleepless)
    assert again.rows.count() == 0 and again.ledger.count() == 11


def test_limit_takes_the_newest(tables):
    run = E.extract(*tables, by_length, "p", RUN, limit=3, sleep=_sleepless)
    assert sorted(r.post_id for r in run.rows.collect()) == [2, 5, 6]


def test_rerun_of_one_version_replaces_its_rows(tables):
    run = E.extract(*tables, by_length, "p", RUN, force=True, version="v0", sleep=_sleepless)
    keys = [(r.post_id, r.prompt_version) for r in run.ledger.collect()]
    assert len(keys) == len(set(keys)) == 12
    assert run.ledger.filter("post_id = 1 and prompt_version = 'v0'").first().created_at == RUN


def test_skipped_posts_are_never_sent(spark, tables):
    prepared = infer.prepare(tables[0]).filter("skipped")
    rows = infer.run_extractor(prepared, never, "p", "v1", RUN).collect()
    assert {r.status for r in rows} == {"skipped_empty"} and len(rows) == 3


def test_in_memory_documents(spark, tables):
    got = {r.post_id: r.raw_json for r in infer.extract_documents(tables[0], by_length, "p").collect()}
    assert got[5] == got[7] == got[8] == "{}"
    # Flags and length limits of the ledger run do not apply.
    assert json.loads(got[9])["hiring_count_hint"] == "p30000" and got[6] != "{}"


def test_costs(spark, tables):
    prices = built_in_prices(spark)
    estimate = E.dry_run(queue.posts_to_extract(*tables), prices).first()
    assert (estimate.posts, estimate.input_tokens, estimate.output_tokens) == (8, 4000, 1600)
    assert estimate.cost == pytest.approx(4000 / 1e6 * 0.15 + 1600 / 1e6 * 0.6)
    costs = E.ledger_cost(tables[2].withColumn("model", F.lit("gpt-4o")), prices).orderBy("prompt_version").collect()
    assert [c.cost for c in costs] == [pytest.approx(12.5e-6)] * 2
    assert E.ledger_cost(tables[2], prices).first().cost == 0.0
