"""Peer-relative scaling: values against the mean of their peers. Shared by features, gates and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def mean(a: Column) -> Column:
    """Mean of an array; 0 for an empty one."""
    return F.when(F.size(a) > 0, total(a) / F.size(a)).otherwise(F.lit(0.0))


def saturate(v: Column, peers: Column) -> Column:
    """v against the mean of its peers, at least a quarter of v: v / (v + mean), within [0, 1]; 0 for v <= 0."""
    base = F.greatest(F.when(F.size(peers) > 0, mean(peers)).otherwise(v), v * 0.25)
    return F.when(v <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / (v + base))))


def spread(a: Column) -> Column:
    """Greatest less least value; the mean where all are equal; 0 for an empty array."""
    width = F.array_max(a) - F.array_min(a)
    return F.when(F.size(a) == 0, F.lit(0.0)).when(width != 0, width).otherwise(mean(a))


def baseline(a: Column) -> Column:
    """Strength of an array of evidence among itself.

    One value: that value, at most 1. One positive value among several: 0.85
    of it, at most 1. Else the greatest saturation of a positive value.
    """
    positive = F.filter(a, lambda x: x > 0)
    first = F.element_at(positive, 1)
    return (
        F.when(F.size(positive) == 0, F.lit(0.0))
        .when((F.size(positive) == 1) & (F.size(a) == 1), F.least(F.lit(1.0), first))
        .when(F.size(positive) == 1, F.least(F.lit(1.0), first * 0.85))
        .otherwise(F.array_max(F.transform(positive, lambda v: saturate(v, a))))
    )


def margin(utility: Column, threshold: Column, uncertainty: Column) -> Column:
    """Evidence margin: utility less the threshold that remains certain."""
    return utility - threshold * (1 - uncertainty)


def clip(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))
