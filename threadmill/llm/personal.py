"""Personal data in texts: four exact kinds, and more by weak supervision.

The exact kinds are patterns with checks. What is left of the text is cut at blanks, quotes, brackets,
commas, ``=`` and ``:``; words with a digit or an at sign, words behind an announcing word and words of a
gazetteer are candidates: a pattern labeler, a gazetteer labeler and a context labeler vote on each, expectation-maximisation
over the votes of the whole corpus estimates how reliable each labeler is, and the resulting soft
labels train a naive Bayes classifier of spans, which decides. DataFrame operations only; the
driver sees counts of vote patterns and of feature combinations, both of fixed number.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from threadmill.sources.tables import stage

KINDS = ("email", "ip", "card", "phone")
OTHER = "other"

# Patterns in a form that never tries a place twice: possessive, and begun only where a run of
# characters begins or the last match ended. They match what the plain patterns match.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?+[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Where texts are cut. A value behind an announcing word may hold = and : itself.
_ENDS = r"\s\"'`\u2018\u2019\u201c\u201d\u00ab\u00bb()\[\]{}<>,;"
_CUTS = _ENDS + "=:"
_BETWEEN = r"[\s\"'`\u2018\u2019\u201c\u201d\u00ab\u00bb:=>\\.#*-]"

# Words that announce or rule out personal data, and prefixes of issued keys.
ANNOUNCING = "password passwd pwd token secret key login user mail email phone tel call contact card account iban passport ssn"
RULING_OUT = "version license licensed cc page chapter section article figure table vol no year"
KEY_PREFIXES = "AKIA ASIA ghp_ gho_ xoxb- xoxp- sk- pk_ AIza eyJ"
MAIL_WORDS = "mail gmail yahoo outlook hotmail icloud proton"
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Señor Señora Monsieur Madame Name name"
GIVEN_NAMES = (
    "James Robert Michael William Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Andrew Joshua Kenneth Kevin "
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Sandra Ashley Emily Michelle Laura "
    "Hans Klaus Jürgen Wolfgang Günther Stefan Andreas Ursula Monika Petra Sabine Anna Maria José Juan Carlos Javier Miguel "
    "Carmen Isabel Lucía Pierre Jean Jacques François Philippe Nicolas Camille Chloé Mohammed Ahmed Fatima Wei Priya Olga Ivan"
)


def found(text: Column, pattern: str, guard: Column) -> Column:
    """Matches with places in code points: array of (start, stop, text); empty for no match.

    ``guard`` is a cheap condition that holds wherever the pattern matches: most texts fail it, and
    the pattern never runs on them.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,stop:int,text:string>>")

    # Gap and match come paired, so that the patterns run once per text and not once per match.
    pairs = F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("own")))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        stop = start + F.length(pair["own"])
        span = F.struct(start.alias("start"), stop.alias("stop"), pair["own"].alias("text"))
        return F.struct(stop.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    walk = F.aggregate(
        F.filter(pairs, lambda p: p["own"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        step,
        lambda state: state["out"],
    )
    return F.when(guard & text.rlike(pattern), walk).otherwise(empty)


def _contains_any(text: Column, words: str) -> Column:
    return reduce(or_, [text.contains(w) for w in words.split()])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _small(part: Column) -> Column:
    plain = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(plain) <= 3) & (F.substring(plain, 1, 3).cast("int") <= 255)


def base_spans(text: Column) -> dict[str, Column]:
    """The exact kinds of a non-null text, failing matches dropped."""
    return {
        "email": found(text, _EMAIL, text.contains("@")),
        "ip": F.filter(found(text, _IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]")), lambda m: F.forall(F.split(m["text"], r"\."), _small)),
        "card": F.filter(
            # Matches with fewer digits fail their check.
            found(text, _CARD, text.rlike(r"[0-9](?:[\x20-]?+[0-9]){15}")),
            lambda m: F.when(F.length(_digits(m["text"])).between(16, 19), _luhn(_digits(m["text"]))).otherwise(False),
        ),
        "phone": F.filter(found(text, _PHONE, text.contains("+")), lambda m: F.length(_digits(m["text"])).between(8, 15)),
    }


def _any(words: str) -> str:
    return "(?:" + "|".join(w.replace(".", r"\.") for w in words.split()) + ")"


def _words(words: str) -> str:
    return rf"(?<![\p{{L}}\p{{N}}]){_any(words)}"


_ANNOUNCED = rf"{_words(ANNOUNCING)}{_BETWEEN}"
_TITLED = rf"{_words(TITLES + ' ' + GIVEN_NAMES)}[\s:=\"'.]{{1,4}}"
_VALUE = rf"(?i)(?:{_ANNOUNCED}{{1,6}}+)+[^{_ENDS}]++"
_VALUE_BEGINS = rf"(?i)^(?:{_ANNOUNCED}{{1,6}}+)+(?=[^{_ENDS}])"
_LISTED = rf"{_any(GIVEN_NAMES)}(?![\p{{L}}\p{{N}}])[^{_CUTS}]*+|{_any(KEY_PREFIXES)}[A-Za-z0-9]{{8,}}[^{_CUTS}]*+"
_NAMED = rf"{_TITLED}\p{{Lu}}[^{_CUTS}]*+"
_NAMED_BEGINS = rf"^{_TITLED}(?=\p{{Lu}})"
_WORD = rf"(?<![^{_CUTS}])(?:[^{_CUTS}0-9@]*+[0-9@][^{_CUTS}]*+|{_LISTED})"


def _votes_and_features(text: Column, span: Column) -> Column:
    """Votes of the three labelers (1 personal, 0 not, 2 none) and the features of one candidate."""
    word = span["text"]
    cased = F.substring(text, F.greatest(span["start"] - 23, F.lit(1)), F.least(span["start"], F.lit(24)))
    before = F.lower(cased)
    digits = F.length(_digits(word))
    letters = ~word.rlike("[0-9@]")
    assigned = before.rlike(rf"{_words(ANNOUNCING)}{_BETWEEN}{{0,5}}[:=]{_BETWEEN}{{0,5}}$")
    # A word of letters behind nothing but a blank, as in "contact us", is not announced.
    announced = F.when(letters, assigned).otherwise(before.rlike(rf"{_ANNOUNCED}{{1,6}}$"))
    listed = word.rlike(rf"^{_any(GIVEN_NAMES)}(?![\p{{L}}\p{{N}}])")
    titled = letters & word.rlike(r"^\p{Lu}") & cased.rlike(rf"{_TITLED}$")
    ruled_out = before.rlike(rf"\b{_any(RULING_OUT)}\W{{0,3}}$")
    issued = word.rlike(rf"(?:^|[^A-Za-z0-9]){_any(KEY_PREFIXES)}[A-Za-z0-9]{{8,}}")
    mailed = F.lower(word).rlike(rf"@[a-z0-9.-]*{_any(MAIL_WORDS)}")
    shape = (
        F.when(word.contains("@"), "at")
        .when(letters & (listed | titled), "name")
        .when(letters & assigned, "given")
        .when(letters & issued, "issued")
        .when(letters, "letters")
        .when(word.rlike("[A-Z][A-Z0-9]{15}"), "upper")
        .when(word.rlike("(?<![0-9a-f])(?=[0-9]*+[a-f])[0-9a-f]{16}"), "hex")
        .when(digits >= 9, "long")
        .when(word.rlike(r"^\W*[0-9]{1,4}\W*$"), "short")
        .when(word.rlike(r"^\W*+[0-9]++(?:[.,:/-][0-9]++)++\W*+$"), "decimal")
        .otherwise("mixed")
    )
    strong = shape.isin("upper", "hex") | word.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")
    weak = shape.isin("short", "decimal", "letters") | word.rlike(r"^[0-9\W]+$")
    one, zero, none = F.lit("1"), F.lit("0"), F.lit("2")
    votes = F.concat(
        F.when(strong, one).when(weak, zero).otherwise(none),
        F.when(issued | mailed | listed, one).otherwise(none),
        F.when(announced | titled, one).when(ruled_out, zero).otherwise(none),
    )
    size = F.least(F.floor(F.log2(F.length(word))), F.lit(7)).cast("string")
    context = F.when(announced | titled, "a").when(ruled_out, "r").otherwise("n")
    return F.struct(
        span["start"].alias("start"), span["stop"].alias("stop"), votes.alias("votes"),
        F.concat_ws("|", shape, size, context).alias("features"),
    )


def _without(text: Column, spans: Column) -> Column:
    """Text with every span replaced by commas of the same length, so that words end there."""

    def step(state: Column, s: Column) -> Column:
        start = F.greatest(s["start"], state["at"])
        stop = F.greatest(s["stop"], state["at"])
        piece = F.concat(F.substring(text, state["at"] + 1, start - state["at"]), F.repeat(F.lit(","), stop - start))
        return F.struct(stop.alias("at"), F.concat(state["out"], piece).alias("out"))

    cut = F.aggregate(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def _has_listed(text: Column) -> Column:
    """Whether a name or prefix of the gazetteer is in the text; those with a capital by one pattern."""
    words = (GIVEN_NAMES + " " + KEY_PREFIXES).split()
    capital = " ".join(w for w in words if w[0].isupper())
    return text.rlike(rf"(?=\p{{Lu}}){_any(capital)}") | _contains_any(text, " ".join(w for w in words if not w[0].isupper()))


def _behind(text: Column, pattern: str, begins: str, guard: Column) -> Column:
    """As ``found``, each match without what ``begins`` matches at its front."""

    def behind(m: Column) -> Column:
        n = F.length(F.regexp_extract(m["text"], begins, 0))
        own = F.substring(m["text"], n + 1, F.length(m["text"]))
        return F.struct((m["start"] + n).alias("start"), m["stop"].alias("stop"), own.alias("text"))

    return F.transform(found(text, pattern, guard), behind)


def _bound(value: Column, function) -> Column:
    """``function`` of a lambda variable that holds an array. As a plain column the optimizer may inline
    the patterns behind it, which would then run once per use."""
    return F.flatten(F.transform(F.array(value), function))


def _free_words(text: Column, base: Column) -> Column:
    """Candidates of the text between the exact spans: announced values, names behind titles, other words."""
    rest = lambda left, spans: F.array(_without(left, spans))

    def others(left: Column, own: Column) -> Column:
        words = lambda t: found(t, _WORD, t.rlike("[0-9@]") | _has_listed(t))
        return F.concat(own, F.flatten(F.transform(rest(left, own), words)))

    def named(left: Column) -> Column:
        guard = _contains_any(left, TITLES) | _has_listed(left)
        return _bound(_behind(left, _NAMED, _NAMED_BEGINS, guard), lambda own: others(left, own))

    def announced(left: Column) -> Column:
        return _bound(
            _behind(left, _VALUE, _VALUE_BEGINS, _contains_any(F.lower(left), ANNOUNCING)),
            lambda own: F.concat(own, F.flatten(F.transform(rest(left, own), named))),
        )

    return _bound(base, lambda spans: F.flatten(F.transform(rest(text, spans), announced)))


def _add_spans(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the exact kinds as ``_email`` and so on, and ``_candidates`` that touch none."""
    rows = rows.select("*", *[c.alias(f"_{k}") for k, c in base_spans(F.col(text)).items()])
    free = _free_words(F.col(text), F.concat(*[f"_{k}" for k in KINDS]))
    by_start = F.array_sort(free)
    return rows.withColumn("_candidates", F.transform(by_start, lambda c: _votes_and_features(F.col(text), c)))


_SPANS = [f"_{k}" for k in KINDS] + ["_candidates"]


def with_spans(docs: DataFrame) -> DataFrame:
    """``_candidates`` with their votes and features, per row of ``docs``; null texts are empty."""
    return _add_spans(docs.select(F.coalesce("text", F.lit("")).alias("text")), "text").select("_candidates")


def decided(spanned: DataFrame, chosen: list[str], name: str) -> DataFrame:
    """Rows with spans and candidates; in their place the column ``name`` with all spans (kind, start, stop)."""
    parts = [F.transform(f"_{k}", _span(k)) for k in KINDS]
    kept = F.filter("_candidates", lambda c: c["features"].isin(chosen) if chosen else F.lit(False))
    parts.append(F.transform(kept, _span(OTHER)))
    return spanned.withColumn(name, F.concat(*parts)).drop(*_SPANS)


def reliabilities(patterns: dict[str, int], rounds: int = 50) -> dict[str, float]:
    """Probability of personal data for every vote pattern, by expectation-maximisation.

    ``patterns`` counts the candidates per pattern of votes (1, 0 or 2 for none). Each labeler has
    a distribution of votes for either truth; the start is the majority of the votes.
    """
    labelers = len(next(iter(patterns), ""))
    belief = {}
    for p in patterns:
        ones, zeros = p.count("1"), p.count("0")
        belief[p] = 0.5 if ones == zeros == 0 else (ones + 0.1) / (ones + zeros + 0.2)
        if ones == zeros == 0:
            belief[p] = 0.1
    for _ in range(rounds):
        total = sum(patterns.values())
        prior = (sum(n * belief[p] for p, n in patterns.items()) + 1) / (total + 2)
        rates = []
        for k in range(labelers):
            yes, no = defaultdict(lambda: 0.01), defaultdict(lambda: 0.01)
            for p, n in patterns.items():
                yes[p[k]] += n * belief[p]
                no[p[k]] += n * (1 - belief[p])
            rates.append(_log_ratios(yes, no))
        for p in patterns:
            odds = math.log(prior) - math.log(1 - prior) + sum(rates[k][p[k]] for k in range(labelers))
            belief[p] = 1 / (1 + math.exp(-max(min(odds, 50), -50)))
    return belief


def _log_ratios(yes: dict[str, float], no: dict[str, float]) -> dict[str, float]:
    """What a labeler's vote says for personal data, from its weights of votes for either truth.

    A labeler is no worse than chance: a one never speaks against personal data and a zero never for
    it, whatever the votes of an odd corpus suggest. So the two truths cannot change places.
    """
    for v in "012":
        yes[v], no[v] = yes[v], no[v]
    y, n = sum(yes.values()), sum(no.values())
    ratio = {v: math.log(yes[v] / y) - math.log(no[v] / n) for v in "012"}
    return ratio | {"1": max(ratio["1"], 0.0), "0": min(ratio["0"], 0.0)}


def train(spans: DataFrame) -> list[str]:
    """Feature combinations that the final classifier takes for personal data.

    Votes and features have a fixed number of values, so the counts are bounded. The classifier is
    naive Bayes over shape, length and context with the beliefs as soft labels.
    """
    counts = (
        spans.select(F.inline("_candidates")).groupBy("votes", "features").agg(F.count("*").alias("n")).collect()
    )
    patterns: dict[str, int] = defaultdict(int)
    for r in counts:
        patterns[r.votes] += r.n
    if not patterns:
        return []
    belief = reliabilities(patterns)
    totals = [1.0, 1.0]
    tables = [defaultdict(lambda: [0.1, 0.1]) for _ in range(3)]
    for r in counts:
        for truth, share in ((1, belief[r.votes]), (0, 1 - belief[r.votes])):
            totals[truth] += r.n * share
            for table, value in zip(tables, r.features.split("|")):
                table[value][truth] += r.n * share
    chosen = []
    for features in sorted({r.features for r in counts}):
        odds = math.log(totals[1] / totals[0])
        for table, value in zip(tables, features.split("|")):
            odds += math.log(table[value][1] / totals[1]) - math.log(table[value][0] / totals[0])
        if odds > 0:
            chosen.append(features)
    return chosen


def personal_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` per row of ``docs``: spans of (kind, start, stop), base and other.

    Ordered by kind (email, ip, card, phone, other), then start; places count code points, the
    stop is exclusive. Repeated rows give the same spans, other columns are ignored. Texts are
    scanned once: their exact spans and candidates are written, the votes of the whole corpus are counted
    from these, and they are decided from these. Nothing but counts is shuffled.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spanned = stage(_add_spans(rows, "text").select("doc_id", *_SPANS), "spans")
    return decided(spanned, train(spanned), "spans")


def _span(kind: str):
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop"))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def span_digests(found_spans: DataFrame) -> DataFrame:
    """Counts of the exact kinds, checksum of their places, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] != OTHER)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found_spans.select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """Text with every span replaced by its kind in brackets; touching spans of two kinds by the first."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    )

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        piece = F.concat(
            F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")
        )
        return F.struct(
            F.greatest(state["at"], s["stop"]).alias("at"),
            F.concat(state["out"], F.when(fresh, piece).otherwise(F.lit(""))).alias("out"),
        )

    return F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))),
    )


def mask_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced and ``n_chars`` following; null stays null."""
    spanned = stage(_add_spans(docs.withColumn("_text", F.coalesce("text", F.lit(""))), "_text"), "spans")
    rows = decided(spanned, train(spanned), "_spans")
    changed = F.size("_spans") > 0
    rows = rows.withColumn("_masked", F.when(changed, masked(F.col("_text"), F.col("_spans"))).otherwise(F.col("text")))
    fields = {
        "text": F.col("_masked"),
        "n_chars": F.when(changed, F.length("_masked").cast("long")).otherwise(F.col("n_chars")),
    }
    return rows.select(*[fields[c].alias(c) if c in fields else F.col(c) for c in docs.columns])
