"""Verdicts on urls: rules first, then host word segmentation and naive Bayes.

Concatenated host names are split into words by a unigram Viterbi search over the words of the
pages themselves. A multinomial naive Bayes model over the words of host and path, learnt from
the urls that a rule decides, judges the others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from threadmill.sources.tables import stage

RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
#: Words up to this length are looked up as whole substrings, longer ones by their first letters, then compared.
WHOLE = 24
#: A run of more letters is no name of a host, whose labels have 63 characters at most; it is not split.
LABEL = 1000
BUCKETS = 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host behind the first ``://`` in lower case, and the path; both empty without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_column(rules: dict[str, str], host: str = "host", path: str = "path") -> Column:
    """The longest rule that fits, null where none does. Rules are a short list of settings."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, slash, prefix = rule.partition("/")
        fits = (F.col(host) == domain) | F.col(host).endswith("." + domain)
        out = F.when(fits & F.col(path).startswith(slash + prefix), F.lit(rule)).otherwise(out)
    return out


def page_words(pages: DataFrame) -> DataFrame:
    """``(word, n)``: letters-only words of the visible text of all pages, with their counts."""
    visible = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<[^>]*+>", " ")
    words = F.explode(F.split(F.lower(visible), r"[^\p{L}]+"))
    return (
        pages.select(words.alias("word"))
        .where("word <> ''")
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def segment_hosts(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """``(host, host_words)`` for distinct hosts: every dot or sign separated part in words.

    All substrings of a part meet the word counts in a join, so no dictionary is held in memory;
    a part then needs only its own matches. Words may have any length. Parts of other characters, and letters
    that no word covers, stay as they are; so do runs of more than ``LABEL`` letters. The last label of
    a host is not split.
    """
    every = F.split("host", r"[^\p{L}]+")
    parts = (
        hosts.select("host", F.size(every).alias("n_parts"), F.posexplode(every).alias("at", "part"))
        .where(F.col("part") != "")
        .withColumn("last", F.col("at") == F.col("n_parts") - 1)
    )
    names = parts.where(~F.col("last") & (F.length("part") <= LABEL)).select("part").distinct()
    cuts = F.expr(
        f"flatten(transform(sequence(1, length(part)), i -> transform(sequence(1, least({WHOLE}, "
        "length(part) - i + 1)), n -> struct(i AS begin, n AS size, substring(part, i, n) AS word))))"
    )
    pieces = names.select("part", F.inline(cuts))
    short = pieces.join(words.where(F.length("word") <= WHOLE), "word").select("part", "begin", "size", "n")
    long = words.where(F.length("word") > WHOLE).select(
        F.substring("word", 1, WHOLE).alias("front"), F.col("word").alias("whole"), F.col("n").alias("count")
    )
    size = F.length("whole")
    long = pieces.where(F.col("size") == WHOLE).join(long, F.col("word") == F.col("front")).where(
        F.substring("part", F.col("begin"), size) == F.col("whole")
    ).select("part", "begin", size.alias("size"), F.col("count").alias("n"))
    matches = short.unionByName(long).groupBy("part").agg(F.collect_list(F.struct("begin", "size", "n")).alias("matches"))
    total = float(words.agg(F.sum("n")).first()[0] or 1)
    split = matches.select("part", _viterbi_column(total)("part", "matches").alias("found"))
    return (
        parts.join(split, "part", "left")
        .withColumn("found", F.when(F.col("last"), F.array("part")).otherwise(F.coalesce("found", F.array("part"))))
        .groupBy("host")
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "found"))), lambda x: x["found"])).alias("host_words"))
    )


def viterbi(part: str, matches: list[tuple[int, int, int]], total: float) -> list[str]:
    """Most likely words of a part; ``matches`` are (first position from 1, length, count).

    A letter that no match covers costs as much as a tenth of a word seen once.
    """
    size = len(part)
    unknown = math.log(0.1 / (total + 1))
    ends: dict[int, list[tuple[int, float]]] = {}
    for begin, n, count in matches:
        ends.setdefault(begin - 1 + n, []).append((begin - 1, math.log(count / (total + 1))))
    best, came = [0.0] * (size + 1), [0] * (size + 1)
    for end in range(1, size + 1):
        value, start = best[end - 1] + unknown, end - 1
        for begin, weight in sorted(ends.get(end, ())):
            if best[begin] + weight > value:
                value, start = best[begin] + weight, begin
        best[end], came[end] = value, start
    out, end = [], size
    while end:
        out.append(part[came[end] : end])
        end = came[end]
    return out[::-1]


def _viterbi_column(total: float):
    @F.pandas_udf("array<string>")
    def split(parts: pd.Series, matches: pd.Series) -> pd.Series:
        return pd.Series(
            [viterbi(p, [(m["begin"], m["size"], m["n"]) for m in found], total) for p, found in zip(parts, matches)]
        )

    return split


def path_words(path: str = "path") -> Column:
    """Words of a path in lower case; a number counts by its length in digits."""
    shaped = F.transform(
        F.split(F.lower(path), r"[^\p{L}\p{N}]+"),
        lambda w: F.when(w.rlike(r"^\p{N}+$"), F.concat(F.lit("#"), F.length(w).cast("string"))).otherwise(w),
    )
    return F.filter(shaped, lambda w: w != "")


@dataclass
class Model:
    """Log odds of ``block`` per bucket of words, and before any word."""

    odds: np.ndarray
    prior: float


def train(labelled: DataFrame, buckets: int = BUCKETS) -> Model:
    """Multinomial naive Bayes from ``(words as buckets, verdict)`` of all rows a rule decides.

    Words are hashed into a fixed number of buckets, so that the counts that reach the driver are
    bounded: two per bucket. With one class only, or none, the prior decides (allow if none).
    """
    counts = (
        labelled.select(F.explode("buckets").alias("bucket"), (F.col("verdict") == "block").alias("block"))
        .groupBy("bucket")
        .agg(F.sum(F.col("block").cast("long")).alias("block"), F.count("*").alias("n"))
        .toPandas()
    )
    rows = labelled.agg(F.count("*"), F.coalesce(F.sum((F.col("verdict") == "block").cast("long")), F.lit(0))).first()
    block = counts["block"].to_numpy(np.float64) + 1
    allow = counts["n"].to_numpy(np.float64) - block + 2
    odds = np.zeros(buckets)  # words that no labelled url has say nothing
    odds[counts["bucket"].to_numpy(np.int64)] = np.log(block / block.sum()) - np.log(allow / allow.sum())
    n, blocked = rows
    return Model(odds, math.log((blocked + 0.5) / (n - blocked + 0.5)) if n else -1.0)


def judge_urls(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, score (probability of block).

    Null urls and urls without ``://`` have empty host and path, no words, and the verdict of the
    prior. Repeated rows are judged each. Counts cover all pages; hosts are segmented once each
    and joined back, an ordinary join that adaptive execution splits at a hot host. The text of the pages is
    read once, for the counts of its words; these, the segmented hosts and the words of the urls are written,
    and training and verdicts start from there.
    """
    host, path = host_and_path("url")
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("rule", rule_column(rules))
    vocabulary = stage(page_words(pages), "page-words")
    hosts = stage(segment_hosts(urls.select("host").distinct(), vocabulary), "hosts")
    words = F.concat(F.coalesce("host_words", F.array().cast("array<string>")), path_words())
    buckets = F.transform(words, lambda w: (F.crc32(w.cast("binary")) % BUCKETS).cast("int"))
    urls = urls.join(hosts, "host", "left").select("page_id", "host", "path", "rule", buckets.alias("buckets"))
    verdict = F.lit(None).cast("string")
    for rule, given in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(given)).otherwise(verdict)
    urls = stage(urls.withColumn("verdict", verdict), "urls")
    model = train(urls.where(F.col("rule").isNotNull()).select("buckets", "verdict"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(found: pd.Series) -> pd.Series:
        m = shared.value
        odds = np.array([m.prior + m.odds[np.asarray(b, np.int64)].sum() for b in found], np.float64)
        return pd.Series(1 / (1 + np.exp(-odds)))

    return (
        urls.withColumn("score", probability("buckets"))
        .withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow")))
        .select("page_id", "host", "path", "rule", "verdict", "score")
    )
