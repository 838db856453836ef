"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by the numbers of its nearest pivots, nearest first. The inverted list of a pivot
holds the vectors that have it in the prefix of their permutation, divided by a second pivot of that
prefix, so that lists stay short. Inside a list only permutations are compared: two vectors are a
candidate if enough of their near pivots are shared, in the first list they have in common. Vectors of
candidates are then fetched and their cosine is computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from threadmill.llm.groups import block_pairs, components, linked_once, per_unit, star_rows
from threadmill.sources.tables import stage

PIVOTS, SAMPLE, NEAREST, PREFIX, SHARED, BLOCK, SIMILARITY, APART = 768, 2048, 8, 6, 3, 384, 0.98, 0.6


def usable(embedding: str = "embedding"):
    """Not null, no null or non-finite component, not all zero."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return e.isNotNull() & finite & F.exists(e, lambda x: x != 0)


def choose_pivots(vectors: DataFrame, sample: int = SAMPLE, pivots: int = PIVOTS, apart: float = APART) -> np.ndarray:
    """Pivots from a bounded sample of the vectors, lowest hashes first, none close to another.

    Without the last condition a large group of near copies would fill the list of pivots with
    itself and its permutations would be noise. A threshold on the hash, from a count, leaves about
    twice the sample before anything is ordered.
    """
    share = min(1.0, 2 * sample / max(vectors.count(), 1))
    hashed = F.xxhash64("rep", F.lit(3))
    few = vectors.where(hashed <= int((2 * share - 1) * (2**63 - 1024)))
    rows = few.orderBy(hashed, "rep").limit(sample).select("embedding").collect()
    if not rows:
        return np.zeros((0, 0))
    width = len(rows[0][0])
    x = _unit(np.array([r[0] for r in rows if len(r[0]) == width], np.float64))
    chosen: list[int] = []
    for i in range(len(x)):
        if len(chosen) < pivots and (not chosen or (x[chosen] @ x[i]).max() < apart):
            chosen.append(i)
    return x[chosen]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, n: int = NEAREST) -> np.ndarray:
    """Numbers of the ``n`` nearest pivots of each row, nearest first, ties by number."""
    distance = -(x @ pivots.T)
    n = min(n, len(pivots))
    return np.argsort(distance, axis=1, kind="stable")[:, :n]


def inverted_lists(
    vectors: DataFrame, pivots: np.ndarray, nearest: int = NEAREST, prefix: int = PREFIX
) -> DataFrame:
    """``(rep, label, v, p, q, near)``: one row per vector and two pivots ``p < q`` of its permutation's prefix.

    ``near`` is the permutation, ``nearest`` numbers of 16 bits, nearest first. A vector of another length than
    the pivots has none and goes to a list of its length.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centers = shared.value
        for batch in batches:
            sizes = batch["embedding"].map(len).to_numpy()
            for size in np.unique(sizes):
                part = batch[sizes == size]
                about = part[["rep", "label", "v"]].reset_index(drop=True)
                if size != centers.shape[1] or len(centers) < 2:
                    yield about.assign(p=-int(size), q=-int(size), near=b"")
                    continue
                near = nearest_pivots(_unit(np.array(part["embedding"].tolist(), np.float64)), centers, nearest)
                kept = pd.Series([row.tobytes() for row in near.astype("<u2")])
                first = np.sort(near[:, :prefix], axis=1)
                for a, b in combinations(range(first.shape[1]), 2):
                    yield about.assign(p=first[:, a], q=first[:, b], near=kept)

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.select("rep", "label", "v", "embedding").mapInPandas(
        run, f"rep long, label {label}, v long, p int, q int, near binary"
    )


def candidates(unit: pd.DataFrame, prefix: int = PREFIX, shared: int = SHARED) -> np.ndarray:
    """Which two rows of a unit share ``shared`` near pivots and have no list before this one in common.

    The first list of two vectors is that of the two smallest pivots that both prefixes hold, so the
    permutations tell it; each pair is a candidate in one list only.
    """
    block = unit["block"].to_numpy()
    lo, hi, q = (int(unit[c].iloc[0]) for c in ("lo", "hi", "q"))
    if q < 0:
        return linked_once(np.ones((len(unit), len(unit)), bool), block, lo, hi)
    near = np.stack([np.frombuffer(b, "<u2") for b in unit["near"]])
    values, column = np.unique(near, return_inverse=True)
    column = column.reshape(near.shape)
    row = np.arange(len(near))[:, None]
    holds = np.zeros((len(near), len(values)), np.float32)
    holds[row, column] = 1
    pairs = linked_once(holds @ holds.T >= min(shared, near.shape[1]), block, lo, hi)
    if pairs.any():
        holds[:] = 0
        holds[row, column[:, :prefix]] = 1
        early = holds[:, values <= q]
        pairs &= early @ early.T == 2
    return pairs


def _with_candidates(unit: pd.DataFrame, prefix: int, shared: int) -> pd.DataFrame | None:
    """Rows of a unit that are in a candidate."""
    pairs = candidates(unit, prefix, shared).any(axis=1)
    return unit[pairs] if pairs.any() else None


def _links(unit: pd.DataFrame, similarity: float, prefix: int, shared: int) -> pd.DataFrame | None:
    """Exact comparison of the candidates of one unit."""
    x = np.array(unit["embedding"].tolist(), np.float64)
    norm = np.linalg.norm(x, axis=1)
    near = candidates(unit, prefix, shared)
    near &= x @ x.T / (norm[:, None] * norm[None, :]) >= similarity
    return star_rows(near, unit["rep"].to_numpy(), unit["size"].to_numpy())


def near_vectors(
    table: DataFrame,
    similarity: float = SIMILARITY,
    pivots: int = PIVOTS,
    nearest: int = NEAREST,
    prefix: int = PREFIX,
    shared: int = SHARED,
    block: int = BLOCK,
) -> DataFrame:
    """Per row of ``table`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Only vectors with equal, non-null labels are compared, by cosine in double precision. Null
    vectors, zero vectors and vectors with null or non-finite components link with nothing.
    Equal vectors of a label are one entry of the index, so a large group of copies costs one
    row; a large inverted list is cut into pairs of blocks. Lists hold permutations only, vectors are
    fetched for rows with a candidate. Linked pairs are not written out: a
    unit gives counts and a spanning star for its rows. Repeated rows count as copies, those of one vec_id too.
    """
    rows = table.select("vec_id", "embedding", "label")
    good = rows.where(usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    reps = stage(
        good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
        .withColumn("v", F.xxhash64("label", "embedding")),
        "vectors",
    )
    chosen = choose_pivots(reps, pivots=pivots)
    lists = inverted_lists(reps, chosen, nearest, prefix)
    lists = stage(lists.withColumn("list", F.xxhash64("label", "p", "q")).drop("p"), "lists")
    dealt = block_pairs(lists, "list", "rep", block)
    met = stage(per_unit(dealt, "list", lambda u: _with_candidates(u, prefix, shared), dealt.schema), "candidates")
    stars = stage(
        per_unit(
            met.join(reps.select("rep", "v", "size", "embedding"), ["rep", "v"]), "list", lambda u: _links(u, similarity, prefix, shared),
            "id long, links long, root long",
        ),
        "stars",
    )
    roots = components(stars, "id", "root")
    links = stars.groupBy("id").agg(F.sum("links").alias("links"))
    judged = (
        reps.join(links, reps.rep == links.id, "left").drop("id")
        .join(roots, reps.rep == roots.id, "left")
        .select(
            "label", "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    return good.join(judged, ["label", "embedding"]).select("vec_id", "links", "component").union(
        rows.where(~F.coalesce(usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False)))
        .select("vec_id", F.lit(0).cast("long"), "vec_id")
    ).select(
        "vec_id",
        F.col("links").cast("long").alias("n_links"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"),
    )
