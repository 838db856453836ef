"""Large groups cut into pairs of blocks, joins with few keys, and connected components, for the similarity operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from threadmill.sources.tables import stage

WORDS = 1 << 17


def narrowed(rows: DataFrame, key: str, wanted: DataFrame, name: str, words: int = WORDS) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among the ``name`` of ``wanted``; none that is gets lost.

    Keys are whole numbers. A join of many rows with few keys then moves few rows. The hashes of the keys
    are marked in a table of ``words`` numbers of 64 bits, which is all that is broadcast; where it is full,
    all rows stay, and the join moves them as it would have without. ``wanted`` is read once more, so it should be staged.
    """

    word, bit, marked, marks = (f"_{key}_{x}" for x in ("word", "bit", "marked", "marks"))

    def place(column: str) -> tuple[Column, Column]:
        h = F.xxhash64(F.col(column).cast("long"), F.lit(29))
        return F.pmod(h, F.lit(words)).alias(word), F.shiftrightunsigned(h, 40).bitwiseAND(63).cast("int").alias(bit)

    table = (
        wanted.select(*place(name)).groupBy(F.col(word).alias(marked))
        .agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias(marks))
    )
    found = (F.col(word) == F.col(marked)) & F.expr(f"(shiftrightunsigned({marks}, {bit}) & 1L) = 1L")
    return rows.select("*", *place(key)).join(F.broadcast(table), found, "left_semi").drop(word, bit)


def block_pairs(members: DataFrame, key: str, item: str, size: int, count: str | None = None) -> DataFrame:
    """Rows of groups with two or more members, dealt out so that any two of a group meet.

    A group of up to ``size`` rows is one task unit, ``(key, 0, 0)``. A larger one is cut by a
    hash of ``item`` into blocks of about ``size``, and every pair of blocks is a unit; no unit
    grows with its group. ``members`` must have distinct ``(key, item)``. Added columns:
    ``lo``, ``hi`` (the unit) and ``block`` (the row's own block). Where a column ``count`` already has
    the number of members, it is taken, and dropped.
    """
    if count is None:
        counts = members.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
        counted = members.join(counts, key)
    else:
        counted = members.withColumnRenamed(count, "_n").where("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(size)).cast("int")
    return (
        counted
        .withColumn("_blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(item), "_blocks").cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("lo", F.least("block", "_other"))
        .withColumn("hi", F.greatest("block", "_other"))
        .drop("_n", "_blocks", "_other")
    )


def per_unit(
    rows: DataFrame, key: str, work: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str | StructType
) -> DataFrame:
    """Apply ``work`` to the rows of each unit of ``block_pairs``.

    The rows are sorted within tasks and read as a stream, so that very many small units cost
    no group hand-over each. ``work`` sees one unit at a time.
    """
    unit = [key, "lo", "hi"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            starts = _unit_starts(batch, unit)
            yield from _results(batch, starts, work)
            rest = batch.iloc[starts[-1] :] if len(batch) else None
        if rest is not None and len(rest):
            yield from _results(rest, np.array([0, len(rest)]), work)

    return rows.repartition(*unit).sortWithinPartitions(*unit).mapInPandas(run, schema)


def _unit_starts(batch: pd.DataFrame, unit: list[str]) -> np.ndarray:
    new = np.zeros(len(batch), bool)
    if len(batch):
        new[0] = True
        for name in unit:
            values = batch[name].to_numpy()
            new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _results(batch: pd.DataFrame, starts: np.ndarray, work) -> Iterator[pd.DataFrame]:
    """Results of all units but the last, which may go on in the next batch."""
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a > 1 and (found := work(batch.iloc[a:b])) is not None:
            out.append(found)
    if out:
        yield pd.concat(out, ignore_index=True)


def linked_once(adjacent: np.ndarray, block: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Adjacency of one unit without its diagonal, and between blocks only where there are two.

    Pairs inside a block are judged in the unit ``(b, b)``, so that each pair counts once.
    """
    adjacent = adjacent.copy()
    np.fill_diagonal(adjacent, False)
    if lo != hi:
        adjacent &= block[:, None] != block[None, :]
    return adjacent


def local_roots(adjacent: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row the smallest id of its connected component inside the unit."""
    roots = ids.copy()
    top = np.iinfo(ids.dtype).max
    while True:
        least = np.minimum(roots, np.where(adjacent, roots[None, :], top).min(axis=1))
        if np.array_equal(least, roots):
            return roots
        roots = least


def star_rows(adjacent: np.ndarray, ids: np.ndarray, weights: np.ndarray) -> pd.DataFrame | None:
    """For every linked row: its id, the weight of what it is linked to, and its local root."""
    linked = np.flatnonzero(adjacent.any(axis=1))
    if not len(linked):
        return None
    adjacent, ids, weights = adjacent[np.ix_(linked, linked)], ids[linked], weights[linked]
    return pd.DataFrame({"id": ids, "links": adjacent @ weights, "root": local_roots(adjacent, ids)})


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(id, component)`` of every id in an edge; the component is its smallest id.

    Alternating large and small stars: each round hangs all neighbours of a node under the
    smallest of them, until only stars are left, which takes about the logarithm of the longest
    path. Rounds are cut by written tables; only a count and a checksum reach the driver. The
    minima are pre-aggregated and written as well: a join of two written tables is one that adaptive
    execution can split at a frequent node, which it does not do with an aggregate in the same stage.
    """
    e = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("v != u").distinct()
    e = stage(e, "edges")
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("v").alias("id"), F.col("u").alias("component")).union(
                e.select("u", "u").distinct()
            )
        before = now
        both = e.union(e.select("u", "v"))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        least = stage(least, "least")
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = stage(large.where("v != u").distinct(), "large")
        least = stage(large.groupBy("v").agg(F.min("u").alias("m")), "least")
        small = large.join(least, "v").where("u != m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        e = stage(small.union(least.select("v", F.col("m").alias("u"))).distinct(), "edges")
