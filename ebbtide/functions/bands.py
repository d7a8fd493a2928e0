"""Banding: a number to an ordered label."""

from collections.abc import Sequence
from dataclasses import dataclass
from math import inf

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv


@dataclass(frozen=True)
class Bands:
    """Ordered bands between edges; outside of all edges there is no band.

    `right_closed` makes them (lo, hi] instead of [lo, hi).
    """

    edges: Sequence[float]
    labels: Sequence[str]
    right_closed: bool = False

    def _pick(self, value: Column, results: Sequence[object]) -> Column:
        first, last = self.edges[0], self.edges[-1]
        below = value <= first if self.right_closed else value < first
        chain = F.when(value.isNull() | below, F.lit(None))
        for hi, result in zip(self.edges[1:], results, strict=True):
            if hi == inf:
                return chain.otherwise(F.lit(result))
            chain = chain.when(value <= hi if self.right_closed else value < hi, F.lit(result))
        return chain

    def label(self, value: Column) -> Column:
        return self._pick(value, self.labels)

    def ord(self, value: Column) -> Column:
        return self._pick(value, range(1, len(self.labels) + 1))


AGE = Bands(fv.AGE_EDGES, fv.AGE_LABELS)
TENURE = Bands(fv.TENURE_EDGES, fv.TENURE_LABELS)
DAY_PART = Bands(fv.DAY_PART_EDGES, fv.DAY_PART_LABELS, right_closed=True)
SCORE = Bands(fv.SCORE_EDGES, fv.SCORE_LABELS)


def tenure_class(months: Column) -> Column:
    """Churn class by tenure; NULL falls in the last class, negatives in the first."""
    chain = F
    for bound, label in zip(fv.TENURE_CLASS_BOUNDS, fv.TENURE_CLASS_LABELS):
        chain = chain.when(months <= bound, F.lit(label))
    return chain.otherwise(F.lit(fv.TENURE_CLASS_LABELS[-1]))


def age_class(years: Column) -> Column:
    """Churn class by age; NULL and negatives fall in the last class."""
    chain = F
    for (lo, hi), label in zip(fv.AGE_CLASS_RANGES, fv.AGE_CLASS_LABELS):
        chain = chain.when(years.between(lo, hi), F.lit(label))
    return chain.otherwise(F.lit(fv.AGE_CLASS_LABELS[-1]))


def score_colour(score: Column) -> Column:
    """Traffic light of a looked-up score; its limits differ from the score bands."""
    chain = F
    for limit, colour in fv.SCORE_COLOURS:
        chain = chain.when(score >= limit, F.lit(colour))
    return chain.otherwise(F.lit(fv.SCORE_COLOUR_ELSE))
