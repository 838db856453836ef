"""Salary and remote-region rules as plain column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from .. import fixed_values as V
from .text import is_blank


def salary_bounds(low: Column, high: Column, period: Column) -> tuple[Column, Column, Column]:
    """Normalized (min, max) and a flag telling whether a bound was over the ceiling.

    In this order: yearly amounts under 1000 are thousands; bounds in the wrong order
    are swapped whatever the period; yearly amounts over the ceiling become NULL.
    """
    yearly = F.coalesce(period == "year", F.lit(False))

    def in_full(v: Column) -> Column:
        return F.when(yearly & (v < V.THOUSANDS_BELOW), v * 1000).otherwise(v)

    a, b = in_full(low), in_full(high)
    swapped = a > b
    first, second = F.when(swapped, b).otherwise(a), F.when(swapped, a).otherwise(b)

    def over(v: Column) -> Column:
        return yearly & F.coalesce(v > V.YEARLY_CEILING, F.lit(False))

    return (
        F.when(~over(first), first),
        F.when(~over(second), second),
        over(first) | over(second),
    )


def remote_region(raw: Column, rules: Mapping[str, Sequence[str]] = V.REMOTE_REGION_RULES) -> Column:
    """First region, in the order of ``rules``, with a phrase contained in the text."""
    text = F.lower(raw)
    result = F.when(is_blank(raw), F.lit(None).cast("string"))
    for region, phrases in rules.items():
        if phrases:
            result = result.when(reduce(or_, [text.contains(p) for p in phrases]), region)
    return result.otherwise(V.OTHER_REGION)
