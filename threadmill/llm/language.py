"""Language identification with string kernels.

Blended-spectrum presence kernel: for n = 1..4 two texts share the share of their distinct
character n-grams, each spectrum normalised by its size, and the four are averaged. Nyström
landmarks are a part of the training texts; one-versus-rest kernel ridge regression is solved on
them. As the kernel is an inner product of presence vectors, the regression over landmarks folds
into one weight per n-gram and language, so texts are scored by matrix products of batches of
presence vectors with that one matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from threadmill.llm.textarrays import code_points, letter_table, mixed

ORDERS, BUCKETS = 4, 1 << 13
WIDTH = ORDERS * BUCKETS
SAMPLE, PER_LANGUAGE, LANDMARKS = 2048, 300, 512
UNKNOWN = "und"
_SLICE = 1 << 20
_ROWS, _COLUMNS = 64, 1 << 11


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # WIDTH x languages
    sharpness: float = 12.0


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 2 by 4."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def mark_ngrams(text: str, row: np.ndarray) -> bool:
    """Set the hashed n-grams of a text in a presence vector; False if it has no letter.

    Letters are lower-cased; every run of other characters counts as one blank, also at the ends.
    """
    points = code_points(text.lower())
    letters = letter_table()[points]
    if not letters.any():
        return False
    x = np.where(letters, points, 32)
    keep = np.append(True, letters[1:] | letters[:-1])
    x = np.concatenate([[32], x[keep], [32]]).astype(np.uint64) + np.uint64(1)
    for begin in range(0, len(x), _SLICE):
        part = x[begin : begin + _SLICE + ORDERS - 1]
        h = np.zeros(len(part), np.uint64)
        for n in range(ORDERS):
            m = len(part) - n
            if m <= 0:
                break
            h = h[:m] * np.uint64(0x100000001B3) + part[n:]
            row[n * BUCKETS + (mixed(h) >> np.uint64(51)).astype(np.int64)] = 1
    return True


def _normalised(presence: np.ndarray) -> np.ndarray:
    """Each spectrum of each row divided by the root of its size and of the number of spectra."""
    blocks = presence.reshape(len(presence), ORDERS, BUCKETS)
    sizes = np.maximum(blocks.sum(axis=2, keepdims=True), 1)
    blocks /= np.sqrt(sizes * ORDERS)
    return presence


def unpacked(rows: list[bytes]) -> np.ndarray:
    """Presence vectors from rows of packed marks, filled in slice by slice, so that there is one copy."""
    out = np.empty((len(rows), WIDTH), np.float32)
    for begin in range(0, len(rows), _ROWS):
        packed = np.frombuffer(b"".join(rows[begin : begin + _ROWS]), np.uint8).reshape(-1, WIDTH // 8)
        out[begin : begin + _ROWS] = np.unpackbits(packed, axis=1)
    return out


def fit(presence: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = 1e-2) -> Model:
    """Kernel ridge regression on the landmarks; ``presence`` are rows of marked n-grams, normalised in place.

    Landmarks are taken evenly from the rows; these come sorted by language, so every language gives its share.
    Beside the rows and the landmarks nothing of their width is held as a whole.
    """
    languages = sorted(set(langs))
    x = _normalised(presence)
    z = x[np.linspace(0, len(x) - 1, min(landmarks, len(x))).astype(int)]
    between, among = (x @ z.T).astype(np.float64), (z @ z.T).astype(np.float64)
    targets = np.array([[1.0 if l == c else -1.0 for c in languages] for l in langs])
    # Balanced: rare languages weigh as much as frequent ones.
    share = np.array([1 / langs.count(l) for l in langs])[:, None] * len(langs) / len(languages)
    system = between.T @ (share * between) + ridge * len(x) / 100 * among + 1e-6 * np.eye(len(z))
    alpha = np.linalg.solve(system, between.T @ (share * targets))
    weights = [(z[:, begin : begin + _COLUMNS].T @ alpha).astype(np.float32) for begin in range(0, WIDTH, _COLUMNS)]
    return Model(languages, np.concatenate(weights))


def score(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Predicted languages and their scores (0 to 1) for a batch of texts."""
    names = np.array(model.languages, object)
    langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    for begin in range(0, len(texts), _ROWS):
        part = texts[begin : begin + _ROWS]
        presence = np.zeros((len(part), WIDTH), np.float32)
        known = np.array([bool(t) and mark_ngrams(t, presence[i]) for i, t in enumerate(part)])
        if not known.any() or not len(names):
            continue
        # The spectra are normalised after the product, which is the same and touches less.
        products = np.zeros((len(part), len(names)), np.float32)
        for n in range(ORDERS):
            block = slice(n * BUCKETS, (n + 1) * BUCKETS)
            sizes = np.maximum(presence[:, block].sum(axis=1, keepdims=True), 1)
            products += presence[:, block] @ model.weights[block] / np.sqrt(sizes * ORDERS)
        odds = np.exp(model.sharpness * (products - products.max(axis=1, keepdims=True)).astype(np.float64))
        odds /= odds.sum(axis=1, keepdims=True)
        at = np.flatnonzero(known)
        best = odds[at].argmax(axis=1)
        langs[begin + at], scores[begin + at] = names[best], odds[at, best]
    return langs.tolist(), scores


def training_sample(docs: DataFrame, per_language: int, total: int) -> DataFrame:
    """Bounded sample of labelled rows that may be learnt from: text and lang.

    Up to ``per_language`` rows of each language, ``total`` in all, lowest hashes of the id first.
    The rows are chosen by id alone; only the bounded list of chosen ids is broadcast to fetch
    their texts.
    """
    order = F.xxhash64(F.col("doc_id"), F.lit(17))
    chosen = (
        docs.where(F.col("lang").isNotNull() & ~held_out())
        .select("doc_id", "lang", order.alias("h"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
        .where(F.col("rank") <= per_language)
        .orderBy("rank", "h", "doc_id")
        .limit(total)
        .select("doc_id", "lang")
    )
    return docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, total: int = SAMPLE) -> Model:
    """Learn from at most ``total`` labelled rows; their n-grams reach the driver, not their texts.

    Without any labelled text the model knows no language and predicts ``und``.
    """

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lang, text in zip(batch["lang"], batch["text"]):
                row = np.zeros(WIDTH, np.uint8)
                if text and mark_ngrams(text, row):
                    out.append((lang, np.packbits(row).tobytes()))
            yield pd.DataFrame(out, columns=["lang", "bits"])

    sample = training_sample(docs, per_language, total)
    rows = sorted(tuple(r) for r in sample.mapInPandas(marked, "lang string, bits binary").limit(total).collect())
    if not rows:
        return Model([], np.zeros((WIDTH, 0), np.float32))
    return fit(unpacked([bits for _, bits in rows]), [lang for lang, _ in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score, replacing columns of these names.

    ``und`` with score 0 for null texts and texts without a letter. Map-only; each row is judged
    by its text alone, so repeated rows get the same answer.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores = score(shared.value, texts.tolist())
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return (
        docs.drop("lang_pred", "score", "_judged")
        .withColumn("_judged", judge("text"))
        .select(*[c for c in docs.columns if c not in ("lang_pred", "score", "_judged")], "_judged.*")
    )


def identify(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score, learnt from the same table."""
    needed = docs.select("doc_id", "text", "lang")
    return predict(needed, train(needed)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Rows whose text has a language, with the language found in place of ``lang``.

    Rejected are null texts and texts without a letter. A stated language is a label to learn from; what the
    text is found to be is what counts afterwards. Without any label ``lang`` stays as it is.
    """
    model = train(docs.select("doc_id", "text", "lang"))
    # Exploding an array of nothing or one keeps the rejection behind the model; a filter would be
    # pushed below it and run it twice.
    judged = predict(docs, model)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    answer = F.when(F.col("lang_pred") == UNKNOWN, F.array().cast("array<string>")).otherwise(F.array("lang_pred"))
    known = judged.select(*[c for c in docs.columns if c in judged.columns], F.explode(answer).alias("_found"))
    return known.withColumn("lang", F.col("_found")).select(docs.columns)
