import random
import re

from pyspark.sql import functions as F

from threadmill import fixed_values as V
from threadmill.functions.rules import remote_region
from threadmill.operators import phrases
from threadmill.operators.phrases import first_phrase, phrase_table, with_first_phrase


def _plainly(texts, rules):
    ordered = sorted(((n, p.lower(), v) for p, v, n in rules if p))
    return {t: next((v for _, p, v in ordered if p in t.lower()), None) for t in texts if t}


def test_ten_thousand_phrases_equal_the_plain_search(spark):
    rng = random.Random(3)
    syllables = ["ka", "lo", "mi", "ner", "tu", "sha", "öl", "re", "x", "den", "É", " "]
    word = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    rules = [(word(rng.randint(1, 7)), f"v{i}", rng.randrange(3000)) for i in range(10_000)]
    rules += [("", "empty", 0), ("z", "one", 5), ("zz", "two", 4), (".*", "no pattern", 1)]
    texts = [word(rng.randint(0, 12)) for _ in range(800)] + ["z", "azzb", "a.*b", "", "q", "MINER LOKA", "\n\nka\n"]
    # Equal priorities go to the smaller phrase, equal phrases to the smaller value.
    table = spark.createDataFrame(rules, "phrase string, value string, priority int")
    want = _plainly(texts, sorted(rules, key=lambda r: (r[2], r[0].lower(), r[1])))
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = {r.t: r.v for r in with_first_phrase(df, "t", table, "v").collect()}
    assert {t: v for t, v in got.items() if t} == want and got[None] is None and got[""] is None


def test_phrases_and_texts_meet_on_a_piece_only(spark):
    df = spark.createDataFrame([("t", "abcd"), ("t", "abcd")], "x string, t string")
    table = phrase_table(spark, {"a": ["bcd"], "b": ["abc", "nowhere"], "c": []})
    plan = first_phrase(df, "t", table)
    assert [tuple(r) for r in plan.collect()] == [("abcd", "a")]
    joins = [line for line in plan._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in line]
    assert len(joins) == 1 and re.search(r"piece#\d+ = piece#\d+", joins[0]) and "Contains(" in joins[0]
    assert with_first_phrase(df, "t", table.limit(0), "v", "other").select("v").distinct().collect() == [("other",)]
    assert with_first_phrase(df.limit(0), "t", table, "v").count() == 0


def test_region_rules_as_a_table(spark):
    phrases = [p for group in V.REMOTE_REGION_RULES.values() for p in group]
    texts = [f"remote, {p.upper()} ok" for p in phrases] + ["", None, "mars", "usa or europe, worldwide"]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    table = phrase_table(spark, V.REMOTE_REGION_RULES)
    by_table = with_first_phrase(df, "raw", table, "region", "other").collect()
    by_chain = df.withColumn("region", remote_region(F.col("raw"), V.REMOTE_REGION_RULES)).collect()
    assert sorted(map(str, by_table)) == sorted(map(str, by_chain))


def test_texts_with_one_of_the_first_phrases_are_not_cut_into_pieces(spark, monkeypatch):
    rules = [(f"early{i}", f"e{i}", i // 2) for i in range(150)] + [("late", "l", 900), ("None", None, 1), (None, "x", 0)]
    table = spark.createDataFrame(rules, "phrase string, value string, priority int")
    texts = [f"Early{i % 60}. and late, number {i}" for i in range(200)] + ["late one", "early140", "NONE late", "none", "", None]
    df = spark.createDataFrame([(t,) for t in texts * 2], "t string")
    cut, stage = [], phrases.stage

    def counted(rows, name):
        rows = stage(rows, name)
        cut.extend([rows.count()] * (name == "texts"))
        return rows

    monkeypatch.setattr(phrases, "stage", counted)
    got = with_first_phrase(df, "t", table, "v", "other").collect()
    assert cut == [1] and len(got) == len(texts) * 2
    ordered = sorted(((n, p.lower(), v) for p, v, n in rules if p))
    want = {t: next((v for _, p, v in ordered if p in t.lower()), None) for t in texts if t}
    assert {r.t: r.v for r in got} == {t: v or "other" for t, v in want.items()} | {"": None, None: None}
    found = [(r.text, r.value) for r in first_phrase(df, "t", table).collect()]
    assert sorted(found, key=str) == sorted(((t.lower(), v) for t, v in want.items()), key=str)
