"""Positions, running totals and per-group top rows without one-task sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.tables import stage

ID_RANGE = 1 << 16
SALTS = 64
# Ranges are grouped this often before their sums meet in one task: of 64-bit ids, 2**15 groups are left.
COARSER = 2


def id_range(col: str, width: int = ID_RANGE) -> Column:
    """Number of the id range a non-NULL id falls in; grows with the id."""
    return F.floor(F.col(col) / width)


def running_total_before(
    df: DataFrame,
    value: str,
    out: str,
    ranges: dict[str, Column],
    order: Sequence[Column],
    descending: Sequence[str] = (),
    coarser: int = COARSER,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows in front of each row.

    ``ranges`` cut the ordered rows into consecutive ranges of bounded size: their
    columns ascend (or descend) in the wanted order and are never NULL, and ``order`` sorts
    the rows inside a range. The last of them is a number and ascends.
    Sums are taken per range first, with map-side aggregation, and the ranges are summed in
    the same way in wider ranges, ``coarser`` times. Only the widest meet in one task, a number
    that does not depend on how sparse the ids are; each range is then summed for itself.

    The sums per range are written once and all wider ones are made from them, so ``df`` is read twice:
    for the sums, and for the rows.
    """
    names = list(ranges)
    ranged = df.select("*", *(c.alias(n) for n, c in ranges.items()))
    sums = stage(ranged.groupBy(*names).agg(F.sum(value).alias("_sum")), "range-sums")
    return _with_totals(ranged, sums, value, out, names, order, descending, coarser)


def _with_totals(
    ranged: DataFrame, sums: DataFrame, value: str, out: str, names: list[str], order: Sequence[Column],
    descending: Sequence[str], coarser: int,
) -> DataFrame:
    if coarser:
        wider = {f"{n}_": F.col(n) for n in names[:-1]} | {f"{names[-1]}_": id_range(names[-1])}
        in_wider = sums.select("*", *(c.alias(n) for n, c in wider.items()))
        wider_sums = in_wider.groupBy(*wider).agg(F.sum("_sum").alias("_sum"))
        summed = _with_totals(
            in_wider, wider_sums, "_sum", "_sum_before", list(wider), [F.asc(names[-1])],
            [f"{n}_" for n in descending], coarser - 1,
        )
        offsets = summed.select(*names, F.col("_sum_before").alias("_offset"))
    else:
        directed = [F.desc(n) if n in descending else F.asc(n) for n in names]
        before = W.orderBy(*directed).rowsBetween(W.unboundedPreceding, -1)
        offsets = sums.select(*names, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy(*names).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, names)
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_inside", "_offset", *names)
    )


def first_rows_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, salt: Column
) -> DataFrame:
    """The first ``n`` rows of every group in the given order, with their ``rank``.

    Every group is cut into ``SALTS`` parts first: the first ``n`` of a group are among
    the first ``n`` of its parts, so no task sorts a whole group.
    """
    part = df.withColumn("_salt", F.pmod(F.hash(salt), F.lit(SALTS)))
    in_part = W.partitionBy(*group, "_salt").orderBy(*order)
    kept = part.withColumn("rank", F.row_number().over(in_part)).filter(F.col("rank") <= n).drop("_salt")
    in_group = W.partitionBy(*group).orderBy(*order)
    return kept.withColumn("rank", F.row_number().over(in_group)).filter(F.col("rank") <= n)


def sample_key(id_col: Column, seed: str = "") -> Column:
    """Reproducible random order of ids: the MD5 of seed and id."""
    return F.md5(F.concat(F.lit(seed), id_col.cast("string")))


def top_counts(
    df: DataFrame, key: str, k: int | None = None, weight: Column | None = None, out: str = "n"
) -> DataFrame:
    """Rows per key, most frequent first, ties by key; ``weight`` counts a row several times."""
    n = F.count("*") if weight is None else F.sum(weight)
    counts = df.groupBy(key).agg(n.alias(out)).orderBy(F.desc(out), F.asc(key))
    return counts if k is None else counts.limit(k)
