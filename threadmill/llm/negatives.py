"""Hard negatives by coordinate pruning over length buckets, in the manner of LEMP.

Rows are put into buckets of similar length; a bucket holds one sorted list of direction values
per coordinate. For an anchor and a least score, a bucket's greatest length gives the least cosine that
its rows need. That bounds the value of every coordinate: a direction within the angle of the cosine
around the anchor's has its coordinate in a range around the anchor's. The ranges of the anchor's
largest (focus) coordinates are looked up in the sorted lists, their candidates intersected, and
only what is left is multiplied out, exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from threadmill.llm.groups import per_unit
from threadmill.sources.tables import stage

POSITIVES, NEGATIVES, BAND, SCALE = 5, 5, (80, 100), 256
BUCKET, SLICE, ANCHORS, FOCUS = 512, 4096, 2048, 3
#: Scaled components from here on take no part: inner products of up to 2^13 of them fit a long.
LARGEST = 1 << 25
_SLACK, _EXACT = 1e-9, float(1 << 53)


def usable(embedding: str = "embedding") -> Column:
    e = F.col(embedding)
    small = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float(LARGEST // SCALE)))
    return F.coalesce(e.isNotNull() & small, F.lit(False))


@dataclass
class Bucket:
    """Rows of one label and width, of similar length, longest first over all buckets."""

    ids: np.ndarray
    keys: np.ndarray
    x: np.ndarray  # scaled components
    direction: np.ndarray
    order: np.ndarray  # per coordinate: rows by falling-in value
    values: np.ndarray  # per coordinate: the sorted values
    longest: float
    shortest: float

    def candidates(self, q: np.ndarray, length: float, least: float, focus: int = FOCUS) -> np.ndarray | None:
        """Rows that may score ``least`` or more against ``q``; None if none can."""
        everything = np.arange(len(self.ids))
        if least == -np.inf or not length or not self.longest:
            return everything if least <= 0 else None
        of = self.longest if least > 0 else self.shortest
        cosine = least / (length * of) if of else -1.0
        if cosine > 1 + _SLACK:
            return None
        if cosine <= -1:
            return everything
        turn = np.arccos(min(cosine, 1.0))
        unit = np.clip(q / length, -1, 1)
        ranges = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:focus]:
            at = np.arccos(unit[f])
            low = np.cos(min(np.pi, at + turn)) - _SLACK
            high = np.cos(max(0.0, at - turn)) + _SLACK
            a, b = np.searchsorted(self.values[f], low), np.searchsorted(self.values[f], high, "right")
            if a == b:
                return None
            ranges.append((b - a, f, a, b, low, high))
        ranges.sort(key=lambda r: r[0])
        n, f, a, b, _, _ = ranges[0]
        rows = everything if n == len(everything) else self.order[f, a:b]
        for n, f, _, _, low, high in ranges[1:]:
            if n < len(everything):
                v = self.direction[rows, f]
                rows = rows[(v >= low) & (v <= high)]
        return rows if len(rows) else None

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        x = self.x if len(rows) == len(self.x) else self.x[rows]
        if len(q) * np.abs(x).max(initial=0) * np.abs(q).max(initial=0) < _EXACT:
            products = (x @ q).astype(np.int64)
        else:
            products = x.astype(np.int64) @ q.astype(np.int64)
        return products if x is not self.x else products[rows]


def buckets(ids: np.ndarray, keys: np.ndarray, x: np.ndarray, size: int = BUCKET) -> list[Bucket]:
    """Rows of one width cut into buckets by falling length, each with its sorted coordinate lists."""
    lengths = np.linalg.norm(x, axis=1)
    by_length = np.argsort(-lengths, kind="stable")
    made = []
    for begin in range(0, len(by_length), size):
        at = by_length[begin : begin + size]
        direction = x[at] / np.where(lengths[at], lengths[at], 1)[:, None]
        order = np.argsort(direction, axis=0, kind="stable").T
        values = np.take_along_axis(direction.T, order, 1)
        made.append(Bucket(ids[at], keys[at], x[at], direction, order, values, lengths[at[0]], lengths[at[-1]]))
    return made


def _first(k: int, held, scores: np.ndarray, ids: np.ndarray):
    """The first ``k`` of what is held and the new rows: higher scores first, ties by id."""
    scores, ids = np.concatenate([held[0], scores]), np.concatenate([held[1], ids])
    at = np.lexsort((ids, -scores))[:k]
    return scores[at], ids[at]


_NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _matrices(unit: pd.DataFrame):
    """Per width of the vectors: the row numbers and their matrix."""
    widths = unit["v"].map(len).to_numpy()
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        yield at, np.array(unit["v"].iloc[at].tolist(), np.float64).reshape(len(at), width)


def _index(unit: pd.DataFrame) -> dict[tuple[int, int], list[Bucket]]:
    """Buckets of the unit's rows by width and label, a repeated row once."""
    rows = unit[~unit["anchor"]].drop_duplicates("key")
    found = {}
    for at, x in _matrices(rows):
        part, labels = rows.iloc[at], rows["label"].to_numpy()[at]
        ids, keys = part["vec_id"].to_numpy(), part["key"].to_numpy()
        for label in np.unique(labels):
            own = labels == label
            found[x.shape[1], label] = buckets(ids[own], keys[own], x[own])
    return found


def _anchors(unit: pd.DataFrame):
    rows = unit[unit["anchor"]].drop_duplicates("key")
    for at, x in _matrices(rows):
        for row, q in zip(rows.iloc[at].itertuples(), x):
            yield row, q, float(np.linalg.norm(q))


def nearest_of_label(unit: pd.DataFrame, k: int) -> pd.DataFrame | None:
    """Per anchor the first ``k`` other rows of its label in this unit.

    The least score is the lowest of those held, so later buckets, which are shorter, are pruned more.
    """
    index, out = _index(unit), []
    for anchor, q, length in _anchors(unit):
        held = _NOTHING
        for bucket in index.get((len(q), anchor.label), ()):
            least = held[0][-1] if len(held[0]) == k else -np.inf
            rows = bucket.candidates(q, length, least)
            if rows is None:
                continue
            rows = rows[bucket.keys[rows] != anchor.key]
            held = _first(k, held, bucket.scores(rows, q), bucket.ids[rows])
        if len(held[0]):
            out.append(pd.DataFrame({"key": anchor.key, "anchor_id": anchor.vec_id, "score": held[0], "other": held[1]}))
    return pd.concat(out, ignore_index=True) if out else None


def banded_negatives(unit: pd.DataFrame, k: int, band: tuple[int, int]) -> pd.DataFrame | None:
    """Per anchor and positive the first ``k`` rows of other labels in the band below the positive.

    A positive asks for its band, and for no less than the lowest it holds once it holds ``k``;
    the least of that over the positives is what a bucket's rows must reach.
    """
    index, out = _index(unit), []
    low, full = band
    for anchor, q, length in _anchors(unit):
        tops = [int(s) for s in anchor.positive_scores]
        floors = [-(-low * s // full) for s in tops]
        held = {i: _NOTHING for i, (a, b) in enumerate(zip(floors, tops)) if a <= b}
        for (width, label), own in index.items():
            if width != len(q) or label == anchor.label or not held:
                continue
            for bucket in own:
                leasts = {i: max(floors[i], h[0][-1]) if len(h[0]) == k else floors[i] for i, h in held.items()}
                rows = bucket.candidates(q, length, float(min(leasts.values())))
                if rows is None:
                    continue
                scores = bucket.scores(rows, q)
                for i, least in leasts.items():
                    inside = (scores >= least) & (scores <= tops[i])
                    if inside.any():
                        held[i] = _first(k, held[i], scores[inside], bucket.ids[rows[inside]])
        for i, (scores, ids) in held.items():
            if len(ids):
                out.append(pd.DataFrame({
                    "key": anchor.key, "anchor_id": anchor.vec_id, "positive_id": int(anchor.positive_ids[i]),
                    "positive_score": tops[i], "score": scores, "other": ids,
                }))
    return pd.concat(out, ignore_index=True) if out else None


def _dealt(rows: DataFrame, anchors: DataFrame, slices: int, groups: int) -> DataFrame:
    """Every row in one slice, every anchor in one group, and a unit for each slice and group."""
    slice_, group = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(slices)), F.pmod(F.xxhash64("key", F.lit(2)), F.lit(groups))
    rows = rows.withColumns({
        "anchor": F.lit(False), "slice": slice_, "lo": F.explode(F.sequence(F.lit(0), F.lit(groups - 1))),
    })
    anchors = anchors.withColumns({
        "anchor": F.lit(True), "lo": group, "slice": F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<long>")),
    })
    columns = {"slice": F.col("slice").cast("long"), "lo": F.col("lo").cast("long"), "hi": F.lit(0).cast("long")}
    return rows.withColumns(columns).unionByName(anchors.withColumns(columns), allowMissingColumns=True)


def hard_negatives(
    table: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
    slice_rows: int = SLICE,
    group_rows: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``table``.

    Rows are vec_id, label, embedding; components are scaled by 256 and rounded down, and a score is
    the exact inner product of such integers. An anchor's positives are the first ``positives`` other rows
    of its label, by falling score and then vec_id. For each, the first ``negatives`` rows of
    other labels are returned whose score is at least ``band[0] / band[1]`` of the positive's and not
    above it; a positive with a negative score has none.

    Rows with a null id, label, vector or component, with a component that is not finite or of 2^17 and more,
    take no part. Vectors of different width are not compared. Equal rows count once; different rows of one
    vec_id count each. Zero vectors score 0. An empty table gives an empty result.

    All anchors meet all rows in units of ``slice_rows`` rows and ``group_rows`` anchors, both dealt by
    hash, so no unit depends on how often a label or vector occurs. A unit gives at most the first
    few of each anchor. Positives come from a first pass over the units, negatives from a second.
    """
    chosen = F.col("label") if label is None else label
    good = table.where(usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    rows = good.select(
        F.col("vec_id").cast("long").alias("vec_id"), chosen.cast("long").alias("label"), is_anchor.alias("asks"),
        F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double"))).alias("v"),
    )
    rows = stage(rows.withColumn("key", F.xxhash64("vec_id", "label", "v")), "scaled")
    n, m = rows.agg(F.count("*"), F.count_if("asks")).first()
    slices, groups = max(1, -(-n // slice_rows)), max(1, -(-m // group_rows))
    anchors, rows = rows.where("asks").drop("asks"), rows.drop("asks")

    found = per_unit(
        _dealt(rows, anchors, slices, groups), "slice", lambda u: nearest_of_label(u, positives),
        "key long, anchor_id long, score long, other long",
    )
    best = W.partitionBy("key").orderBy(F.desc("score"), "other")
    nearest = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    lists = stage(
        nearest.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "other", "score"))).alias("first")),
        "positives",
    ).select("key", F.col("first.other").alias("positive_ids"), F.col("first.score").alias("positive_scores"))
    asking = stage(anchors.dropDuplicates(["key"]).join(lists, "key"), "anchors")

    found = per_unit(
        _dealt(rows, asking, slices, groups), "slice", lambda u: banded_negatives(u, negatives, band),
        "key long, anchor_id long, positive_id long, positive_score long, score long, other long",
    )
    best = W.partitionBy("key", "positive_id", "positive_score").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
