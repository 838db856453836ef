import math
import random
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from threadmill.llm import language, quality, urls

WORDS = {"aa": "the river and that ship with them", "bb": "der Fluss und das Schiff ist nicht hier"}


def _docs(docs_of, n=60):
    rng = np.random.default_rng(3)
    rows, langs = [], {}
    for i in range(n):
        lang = "aa" if i % 2 else "bb"
        rows.append((i, " ".join(rng.choice(WORDS[lang].split(), 12))))
        langs[i] = lang
    return rows, langs


def test_languages_are_learnt_and_texts_without_letters_unknown(docs_of):
    rows, langs = _docs(docs_of)
    rows += [(1000, None), (1001, ""), (1002, "12 !!"), (1003, "the ship " * 60_000), (1003, "the ship")]
    got = language.identify(docs_of(rows, langs)).toPandas()
    assert len(got) == len(rows)
    by_id = got.drop_duplicates("doc_id").set_index("doc_id")
    assert by_id.lang_pred[[1000, 1001, 1002]].tolist() == ["und"] * 3
    assert by_id.lang_pred[1003] == "aa"
    assert all(by_id.lang_pred[i] == lang for i, lang in langs.items())
    assert got.score.between(0, 1).all()
    assert by_id.held_out.any() and not by_id.held_out.all()


def test_language_stage_keeps_columns_and_fills_lang(docs_of):
    rows, langs = _docs(docs_of)
    langs.pop(3)
    langs[20] = "aa"  # stated wrongly, and held out of the training
    docs = docs_of([*rows, (900, "123")], langs)
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    found = {r.doc_id: r.lang for r in kept.collect()}
    assert 900 not in found and found[3] == "aa" and found[20] == "bb" and len(found) == len(rows)
    assert all(found[i] == ("aa" if i % 2 else "bb") for i, _ in rows)


def test_no_labels_and_empty_tables(docs_of, shipped):
    labels = shipped.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = docs_of([(1, "a text"), (2, None)])
    assert {r.lang_pred for r in language.identify(docs).collect()} == {"und"}
    assert language.identify(docs_of([])).count() == 0
    assert {r.score for r in quality.score_quality(docs, quality.train(docs, labels)).collect()} == {0.5}
    assert language.keep_identified(docs).count() == 1


def test_the_sample_of_language_id_is_held_once():
    rng = np.random.default_rng(6)
    marks = rng.integers(0, 256, (600, language.WIDTH // 8), np.uint8) & 0x11
    tracemalloc.start()
    presence = language.unpacked([row.tobytes() for row in marks])
    model = language.fit(presence, ["aa"] * 300 + ["bb"] * 300, landmarks=512)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    vectors = language._normalised(np.unpackbits(marks, axis=1).astype(np.float32))
    assert np.array_equal(presence, vectors)
    found = (vectors @ model.weights).argmax(axis=1)
    assert (found == np.repeat([0, 1], 300)).mean() > 0.9
    assert peak < 4 * language.WIDTH * (600 + 512) * 1.25


def test_quality_separates_noise(docs_of, shipped):
    rng = np.random.default_rng(4)
    good = [(i, " ".join(rng.choice(WORDS["aa"].split(), 20))) for i in range(80)]
    bad = [(i, " ".join(rng.choice(["&&&", "|#", "BUY!!", "x1%"], 20))) for i in range(80, 120)]
    docs = docs_of([*good, *bad, (500, None), (501, "")])
    labels = shipped.createDataFrame(
        [(i, int(i < 80), 0) for i in range(120)] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    got = quality.score_quality(docs, quality.train(docs, labels)).toPandas().set_index("doc_id")
    assert (got.predicted[:80].loc[range(80)] == 1).mean() > 0.95
    assert (got.predicted.loc[range(80, 120)] == 0).mean() > 0.95
    assert got.score.between(0, 1).all() and got.score[500] == got.score[501]


def test_hosts_are_split_by_likelihood():
    word = {"news": 50, "paper": 40, "newspaper": 1, "s": 1}
    part = "newspapers"
    matches = [(i + 1, n, word[part[i : i + n]]) for i in range(10) for n in range(1, 11) if part[i : i + n] in word and i + n <= 10]
    assert urls.viterbi(part, matches, 5.0) == ["news", "paper", "s"]
    assert urls.viterbi("ab", [], 5.0) == ["a", "b"]


def test_url_rules_and_parts(shipped):
    rows = [
        (1, "https://A.Example.org/es/x?q#f"), (2, "http://example.org/en/12"), (3, "http://b.org"), (4, None), (5, "no url"),
        (6, "x://www.good.com/fr/1"), (7, "x://bad.com/de/2"), (8, "x://notexample.org/es/1"), (9, "x://good.net/fr/1"), (9, "x://good.net/fr/1"),
    ]
    pages = shipped.createDataFrame([(i, u, "<p>good bad news</p>", "x") for i, u in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    assert [got[i].rule for i in range(1, 9)] == [
        "example.org/es/", "example.org/en/1", None, None, None, "com/fr/", "com/de/", "org/",
    ]
    assert (got[1].host, got[1].path) == ("a.example.org", "/es/x")
    assert (got[3].host, got[3].path, got[4].host, got[5].path) == ("b.org", "", "", "")
    assert got[1].verdict == "block" and got[8].verdict == "allow" and got[9].verdict in ("allow", "block")
    assert urls.judge_urls(pages).count() == len(rows)
    assert urls.judge_urls(pages.limit(0)).count() == 0


def _split_plainly(part, counts, total):
    """Best way to cut a part into words, by trying all."""
    from functools import cache

    @cache
    def best(end):
        if not end:
            return 0.0, ()
        score, words = best(end - 1)
        found = (score + math.log(0.1 / (total + 1)), (*words, part[end - 1 : end]))
        for begin in range(end):
            if part[begin:end] in counts:
                score, words = best(begin)
                score += math.log(counts[part[begin:end]] / (total + 1))
                if score > found[0]:
                    found = score, (*words, part[begin:end])
        return found

    return best(len(part))


def test_segmentation_against_all_splits(shipped):
    rng = random.Random(5)
    syllables = ["ab", "ba", "c", "abc", "da", "xyx"]
    counts = {"".join(rng.choices(syllables, k=rng.randint(1, 3))): rng.randint(1, 40) for _ in range(40)}
    giant = "donaudampfschifffahrtsgesellschaften"
    counts |= {giant: 3, giant[:30]: 2, "dampf": 9}
    parts = ["".join(rng.choices(syllables, k=rng.randint(1, 9))) for _ in range(60)] + [giant, "my" + giant + "abc", giant[:34], "z" * 1500]
    hosts = shipped.createDataFrame([(f"{p}.org",) for p in sorted(set(parts))], "host string")
    words = shipped.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.host: r.host_words for r in urls.segment_hosts(hosts, words).collect()}
    total = sum(counts.values())
    for part in set(parts):
        words = got[f"{part}.org"][:-1]
        assert "".join(words) == part
        if len(part) > urls.LABEL:
            assert words == [part]
            continue
        score = sum(math.log(counts[w] / (total + 1)) if w in counts else math.log(0.1 / (total + 1)) for w in words)
        assert math.isclose(score, _split_plainly(part, counts, total)[0], rel_tol=1e-12)
    assert giant in got[f"{giant}.org"] and got[f"my{giant}abc.org"][2] == giant


def test_naive_bayes_against_plain_counts(shipped):
    rng = random.Random(6)
    rows = [([rng.randrange(6) + (3 if block else 0) for _ in range(rng.randint(0, 5))], "block" if block else "allow") for block in rng.choices([0, 1], k=50)]
    model = urls.train(shipped.createDataFrame(rows, "buckets array<int>, verdict string"), buckets=16)
    block, allow = Counter(b for w, v in rows if v == "block" for b in w), Counter(b for w, v in rows if v == "allow" for b in w)
    seen = set(block) | set(allow)
    for b in range(16):
        want = 0.0
        if b in seen:
            want = math.log((block[b] + 1) / (sum(block.values()) + len(seen))) - math.log((allow[b] + 1) / (sum(allow.values()) + len(seen)))
        assert math.isclose(model.odds[b], want, abs_tol=1e-12)
    blocked = sum(v == "block" for _, v in rows)
    assert math.isclose(model.prior, math.log((blocked + 0.5) / (len(rows) - blocked + 0.5)))


def test_long_words_of_the_pages_stay_whole(shipped):
    long = "rindfleischetikettierungsueberwachung"
    rows = [(i, f"https://{long if i else 'x'}.net/a", f"<p>{long} und mehr</p>") for i in range(6)]
    pages = shipped.createDataFrame(rows, "page_id long, url string, html string")
    assert urls.page_words(pages).where(F.col("word") == long).first().n == 6
    hosts = urls.segment_hosts(shipped.createDataFrame([(f"{long}.net",)], "host string"), urls.page_words(pages))
    assert hosts.first().host_words == [long, "net"]
    plan = urls.judge_urls(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "html" not in plan  # the text is not read again for the verdicts
