import re

import corpus_pipeline
import __spark_entry__ as entry_points
from threadmill.llm import personal

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "é a@b.c_d@e.f.g x@y a@b.c.@d.e @a.b", "1.2.3.4.5.6.7.8 256.1.1.1 007.08.9.255 1.2.3", "4539 1488 0343 6467, 4539148803436467 4539148803436468",
    "+1 (988) 555-2485 +1 2 +44-20.7946 0958 tail", "x" * 4000 + "@" + "y" * 4000, "9" * 30_000, "a@b.cc " * 300, "token = \"c5a1f4aa0e9feb9c\" version 3.",
    "🙂 a@b.cc +12345678 1.1.1.1", "call +1 (988) 555-2485 4539148803436467", "twice a@b.cc", "twice a@b.cc",
]


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_exact_kinds_match_the_plain_patterns(docs_of):
    rows = list(enumerate(TEXTS))
    found = personal.personal_spans(docs_of(rows))
    for r in found.collect():
        base = [(s.kind, s.start, s.stop) for s in r.spans if s.kind != personal.OTHER]
        assert base == _plain_spans(TEXTS[r.doc_id])
        for s in r.spans:
            assert s.kind in PLAIN or not any(s.start < b and a < s.stop for _, a, b in base)
    assert {r.doc_id: r.n_email for r in personal.span_digests(found).collect()}[8] == 300


def test_masking(docs_of):
    docs = docs_of(list(enumerate(TEXTS)))
    got = {r.doc_id: r for r in personal.mask_documents(docs).collect()}
    assert personal.mask_documents(docs).columns == docs.columns
    assert got[0].text is None and got[1].text == ""
    # The phone pattern takes spaces and dots, so it covers the address behind it.
    assert got[10].text == "🙂 [EMAIL] [PHONE]" and got[10].n_chars == len(got[10].text)
    assert not _plain_spans(got[11].text)
    assert personal.mask_documents(docs_of([])).count() == 0


def test_reliable_votes_win():
    belief = personal.reliabilities({"111": 40, "121": 30, "022": 400, "020": 60, "122": 5})
    assert belief["111"] > 0.9 and belief["121"] > 0.9 and belief["022"] < 0.1
    assert personal.reliabilities({}) == {}


def test_truths_cannot_change_places():
    """Most ones stand against zeros of the other labelers: unconstrained, they would become the rare truth's mirror."""
    odd = {"100": 500, "010": 480, "001": 520, "000": 30, "111": 25, "110": 3}
    belief = personal.reliabilities(odd)
    assert belief["111"] >= belief["110"] >= belief["000"] and belief["111"] == max(belief.values())
    for flipped in ({"011": 900, "100": 900}, {"111": 1, "000": 5000, "122": 2500}):
        belief = personal.reliabilities(flipped)
        for p in belief:
            for k in range(3):
                for q in belief:
                    if q == p[:k] + "1" + p[k + 1 :] and p[k] == "0":
                        assert belief[q] >= belief[p]
    ratio = personal._log_ratios(dict.fromkeys("012", 1.0) | {"1": 0.1}, dict.fromkeys("012", 1.0) | {"0": 0.1})
    assert ratio["1"] == 0.0 and ratio["0"] == 0.0


def test_guards_are_necessary_conditions(docs_of):
    """Whatever a pattern matches passes its guard: odd texts give the same spans as plain patterns, and candidates stay."""
    texts = ["PASSWORD: Hunter2x", "Tel:+4412345678", "Mr. Quill Smith", "name Ünal", "José García", "x AKIA12345678ABCD y", "sk-abcdefgh12345678",
             "1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6", "4539 1488 0343 6467", "1.22.333.44", "Übung 3.4.5 SECRET=abc", "plain words only"]
    docs = docs_of(list(enumerate(texts)))
    for r in personal.personal_spans(docs).collect():
        assert [(s.kind, s.start, s.stop) for s in r.spans if s.kind != personal.OTHER] == _plain_spans(texts[r.doc_id])
    words = [[texts[i][c.start : c.stop] for c in r["_candidates"]] for i, r in enumerate(personal.with_spans(docs).collect())]
    assert words[0] == ["Hunter2x"] and words[2] == ["Quill"] and words[3] == ["Ünal"] and "García" in words[4]
    assert words[5] == ["AKIA12345678ABCD"] and words[6] == ["sk-abcdefgh12345678"] and words[10] == ["3.4.5", "abc"] and words[11] == []


def test_pipeline_keeps_columns_and_drops_the_right_rows(shipped, folder):
    docs = shipped.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(shipped, before, folder)
        assert after.columns == docs.columns, name
        before = after
    ids = {r.doc_id for r in before.select("doc_id").collect()}
    packed = corpus_pipeline.run(shipped, folder).select("doc_id").distinct().collect()
    assert {r.doc_id for r in packed} == ids and 0 < len(ids) < docs.count()


def test_all_operators_are_registered():
    names = set(entry_points.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_words_without_blanks_and_without_digits_are_candidates(docs_of):
    secret = "04db1c5a1f4aa0e9feb9c88d2e61b7f3"
    rows = [
        (1, f'{{"email":"a@b.com","token":"{secret}"}}'), (2, f"a@b.com,{secret},10.0.0.1"), (3, "password: correcthorse"),
        (4, f"id=7;access_token={secret}"), (5, "password=p:assw0rd,next"), (6, "please contact us or call me about the secret garden"),
        (7, "name: Anna"), (8, "wrote to Mrs Quill today"),
    ]
    docs = docs_of(rows)
    second = personal.with_spans(docs).collect()[1]["_candidates"]
    assert [rows[1][1][c.start : c.stop] for c in second] == [secret]
    got = {r.doc_id: r.text for r in personal.mask_documents(docs).collect()}
    assert got[1] == '{"email":"[EMAIL]","token":"[OTHER]"}'
    assert got[3] == "password: [OTHER]"
    assert got[4] == "id=7;access_token=[OTHER]"
    assert got[5] == "password=[OTHER],next"
    assert got[6] == rows[5][1]
    assert got[7] == "name: [OTHER]" and got[8] == "wrote to Mrs [OTHER] today"
