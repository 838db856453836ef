"""Quality scores from supervised subword embeddings.

Every word and every character 2- and 3-gram of a text is hashed to a row of a table of learned
vectors; a document is the mean of its rows, and a softmax over a linear layer gives its class.
The table and the layer are trained together by stochastic gradient descent in numpy. For scoring
the layer is folded into the table: one number per row, averaged per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from threadmill.llm.language import held_out
from threadmill.llm.textarrays import code_points, mixed, space_table, word_hashes

BUCKETS, DIM, EPOCHS, SAMPLE, THRESHOLD = 1 << 16, 16, 12, 4000, 0.7
_SLICE = 1 << 20


@dataclass
class Model:
    table: np.ndarray  # logit of label 1 against 0 per bucket
    bias: float


def features(text: str | None) -> Iterator[np.ndarray]:
    """Bucket numbers of a text, in slices of bounded size: words, then 2- and 3-grams.

    Case, signs and line breaks are kept; a null or empty text has none.
    """
    if not text:
        return
    points = code_points(text)
    for begin in range(0, len(points), _SLICE):
        part = points[begin : begin + _SLICE]
        yield _bucket(word_hashes(part, ~space_table()[part]), 1)
        x = part.astype(np.uint64) + np.uint64(1)
        if len(x) > 1:
            pairs = x[:-1] * np.uint64(0x1000193) + x[1:]
            yield _bucket(mixed(pairs), 2)
            if len(x) > 2:
                yield _bucket(mixed(pairs[:-1] * np.uint64(0x1000193) + x[2:]), 3)


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return ((hashes ^ np.uint64(kind)) % np.uint64(BUCKETS)).astype(np.int64)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Model:
    """Train on bags (buckets, shares that sum to 1) by SGD with per-row adaptive steps.

    Both labels weigh the same in total, so that a rare one is learnt too.
    """
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    weights = len(labels) / (2.0 * np.maximum(np.bincount(labels, minlength=2), 1))
    seen, seen_layer = np.full(BUCKETS, 1e-8, np.float32), 1e-4
    for epoch in range(epochs):
        for i in rng.permutation(len(bags)):
            rows, shares = bags[i]
            mean = shares @ table[rows]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            p *= weights[labels[i]]
            step = layer @ p
            seen_layer += float(p @ p)
            rate = 0.5 / np.sqrt(seen_layer)
            layer -= rate * np.outer(mean, p)
            bias -= rate * p
            pull = shares * np.sqrt(step @ step)
            seen[rows] += pull * pull
            table[rows] -= (0.05 * shares / np.sqrt(seen[rows]))[:, None] * step
    return Model((table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def score(model: Model, text: str | None) -> float:
    """Probability of label 1; a text without features gets that of the bias alone."""
    total, n = 0.0, 0
    for rows in features(text):
        total += float(model.table[rows].sum(dtype=np.float64))
        n += len(rows)
    return float(1 / (1 + np.exp(-(model.bias + total / max(n, 1)))))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled rows, lowest hashes of the id first.

    Held-out rows, null labels and labels other than 0 and 1 are not learnt from; a document with
    two labels is learnt with each. Only the bounded list of chosen labels is broadcast, and
    only bags of bucket counts reach the driver. Without any label every score is 0.5.
    """
    order = F.xxhash64(F.col("doc_id"), F.lit(23))
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .distinct()
        .orderBy(order, "doc_id", "quality")
        .limit(sample)
    )

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for quality, text in zip(batch["quality"], batch["text"]):
                counts = np.zeros(BUCKETS, np.float32)
                for rows in features(text):
                    counts += np.bincount(rows, minlength=BUCKETS)
                rows = np.flatnonzero(counts)
                out.append((quality, rows.astype("<u2").tobytes(), counts[rows].astype("<f4").tobytes()))
            yield pd.DataFrame(out, columns=["quality", "rows", "counts"])

    found = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .mapInPandas(bags, "quality int, rows binary, counts binary")
        .limit(sample)
        .collect()
    )
    found = sorted((bytes(r.rows), bytes(r.counts), r.quality) for r in found if r.rows)
    if not found:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    learnt = []
    for rows, counts, _ in found:
        weights = np.frombuffer(counts, "<f4")
        learnt.append((np.frombuffer(rows, "<u2").astype(np.int64), weights / weights.sum()))
    return fit(learnt, np.array([q for *_, q in found]))


def score_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on).

    Whole texts, map-only; null and empty texts get the score of the bias alone. Repeated rows
    get the same score; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([score(shared.value, t) for t in texts], dtype="float64")

    return (
        docs.select("doc_id", held_out().alias("held_out"), judge("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
