"""Whitening of embeddings on the largest components of their covariance.

Sums and products are exact integers: vectors are scaled and rounded down, and centred by the
rounded mean before they are multiplied; what the rounding leaves is taken off exactly at the end.
The components come from ``feast``, whose input is one matrix of the vectors' width.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from threadmill.llm import feast
from threadmill.sources.tables import stage

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Components from here on are not taken: their scaled values would not be exact in double precision.
LARGEST = float(1 << 40)
_EXACT, _LONG = float(1 << 53), (1 << 63) - 1


@dataclass
class Fit:
    """Exact statistics of the fit list and its components."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit vectors as columns
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)


def usable(embedding: str = "embedding") -> Column:
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST))
    return F.coalesce(e.isNotNull() & (F.size(e) > 0) & finite, F.lit(False))


def common_width(rows: DataFrame) -> int:
    """The most frequent width of the vectors, the larger of equally frequent ones; 0 without vectors."""
    widths = rows.groupBy(F.size("embedding").alias("width")).count()
    first = widths.orderBy(F.desc("count"), F.desc("width")).first()
    return first["width"] if first else 0


def scaled(batch: pd.DataFrame) -> np.ndarray:
    """The integers of a batch of vectors, one row each."""
    x = np.array(batch["embedding"].tolist(), np.float64)
    return np.floor(SCALE * x).astype(np.int64) + SHIFT


def exact_products(y: np.ndarray) -> np.ndarray:
    """``y' y`` of integers as Python numbers, whatever their size; in floating point where that is exact."""
    largest = float(np.abs(y).max(initial=0))
    if not largest:
        return np.zeros((y.shape[1], y.shape[1]), object)
    block = int(_EXACT // (largest * largest))
    if not block:
        wide = y.astype(object)
        return wide.T @ wide
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for a in range(0, len(y), block):
        part = y[a : a + block].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _summed(rows: DataFrame, width: int, work: Callable[[np.ndarray], np.ndarray]) -> dict[tuple[int, int], int]:
    """Sum over all rows of a matrix that ``work`` gives for a batch; ``(row, column) -> sum``.

    A task sends one row per entry on; what comes back depends on the width of the vectors alone.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                found = work(scaled(batch))
                total = found if total is None else total + found
        if total is not None:
            i, j = np.nonzero(np.ones(total.shape, bool))
            yield pd.DataFrame({"i": i, "j": j, "s": [Decimal(int(v)) for v in total[i, j]]})

    sums = rows.select("embedding").mapInPandas(run, "i int, j int, s decimal(38,0)")
    return {(r.i, r.j): int(r.s) for r in sums.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Two passes over usable vectors of one width: their sums, then their centred products."""
    width = common_width(rows)
    if not width:
        return None
    rows = rows.where(F.size("embedding") == width)

    def sums_of(x: np.ndarray) -> np.ndarray:
        counted = np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1).astype(object)
        return counted.sum(axis=0)[None, :]

    found = _summed(rows, width, sums_of)
    n, sums = found[0, width], [found[0, j] for j in range(width)]
    centre = np.array([round(s / n) for s in sums], np.int64)
    products = _summed(rows, width, lambda x: np.triu(exact_products(x - centre)))
    left = [s - n * int(c) for s, c in zip(sums, centre)]
    v = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            v[i, j] = v[j, i] = (n * products[i, j] - left[i] * left[j]) / (n * n)
    values, vectors = feast.largest(v, components)
    return Fit(n, sums, values, vectors, float(np.trace(v)))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of ``(n x - S)^2`` per row, exact; null beyond a long."""
    spread = max(abs(n * int(e) - s) for e, s in [*zip(x.max(axis=0), sums), *zip(x.min(axis=0), sums)])
    if x.shape[1] * spread * spread <= _LONG and n * int(np.abs(x).max(initial=0)) <= _LONG:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = n * x.astype(object) - np.array(sums, object)
    return [v if v <= _LONG else None for v in (d * d).sum(axis=1)]


def whiten(table: DataFrame, model: Fit) -> DataFrame:
    """(vec_id, deviation, z): ``z`` holds the whitened coordinate on every component of the model."""
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        # Integer part of the mean first: the difference to it is exact.
        centre = np.array([s // m.n for s in m.sums], np.int64)
        rest = np.array([(s % m.n) / m.n for s in m.sums])
        onto = m.vectors / np.sqrt(m.values)
        for batch in batches:
            if len(batch):
                x = scaled(batch)
                z = ((x - centre).astype(np.float64) - rest) @ onto
                deviation = pd.array(_deviations(x, m.n, m.sums), "Int64")
                yield pd.DataFrame({"vec_id": batch["vec_id"].array, "deviation": deviation, "z": list(z)})

    rows = table.where(usable() & (F.size("embedding") == model.width)).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding"
    )
    # Ids pass through pandas as texts, as a null would turn a batch of them into floats.
    out = rows.withColumn("vec_id", F.col("vec_id").cast("string")).mapInPandas(
        run, "vec_id string, deviation long, z array<double>"
    )
    return out.withColumn("vec_id", F.col("vec_id").cast("long"))


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``z`` minus the identity, measured over all rows.

    ``covar_pop`` centres before it multiplies and divides by the number of rows.
    """
    pairs = list(combinations_with_replacement(range(components), 2))
    entries = [F.covar_pop(F.col("z")[i], F.col("z")[j]) for i, j in pairs]
    found = whitened.agg(*(e.alias(f"c{k}") for k, e in enumerate(entries))).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


_SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whitened_components(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per usable row of ``table`` (vec_id, embedding) and component, from 1 by falling eigenvalue.

    Columns: vec_id, component, n (rows of the fit list), deviation (sum of ``(n x - S)^2``), whitened,
    explained (share of the variance), identity_error (see there; one value). A vector's integers
    are ``x = floor(1024 c) + 100000``; whitened is ``x`` less the mean, projected on the component, over the
    root of its eigenvalue. The sign of a component is any, and the same for all rows.

    Null vectors, empty ones, and vectors with a null, non-finite or 2^40 and larger component are left out; so
    are vectors of another width than the most frequent. Repeated rows count each; a null vec_id
    stays. Components without variance (an eigenvalue of 10^-12 of the largest row sum or less) cannot be
    whitened and are not returned, so a single row, equal rows and an empty table give no rows. A deviation
    beyond a long is null.
    """
    rows = table.where(usable()).select("vec_id", "embedding")
    model = fit(rows, components)
    if model is None or not len(model.values):
        return table.sparkSession.createDataFrame([], _SCHEMA)
    z = stage(whiten(rows, model), "whitened")
    error = identity_error(z, len(model.values))
    shares = F.array(*(F.lit(float(v) / model.trace) for v in model.values))
    return z.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
