"""Number -> label expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from millrace.schemas import (
    ALT_PRICE_BOUNDS,
    ALT_PRICE_LABELS,
    ALT_PRICE_MISSING,
    PRICE_BOUNDS,
    PRICE_LABELS,
    RATING_GRADES,
    RATING_OTHERWISE,
)


def bucketize(
    c: Column,
    bounds: Sequence[float],
    labels: Sequence[str],
    missing_label: str | None = None,
) -> Column:
    """Half-open buckets: the first bound above the value names the label.

    Without ``missing_label`` NULL and NaN are below no bound and take the last label.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("bucketize needs one label more than bounds")
    if list(bounds) != sorted(bounds):
        raise ValueError("bucketize needs ascending bounds")
    steps = [(c < bound, label) for bound, label in zip(bounds, labels)]
    if missing_label is not None:
        steps.insert(0, (c.isNull() | F.isnan(c), missing_label))
    return _first_match(steps, labels[-1])


def grade(c: Column, floors: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The first floor the value reaches names the label; NULL reaches none, NaN reaches all."""
    return _first_match([(c >= floor, label) for floor, label in floors], otherwise)


def price_category(c: Column) -> Column:
    return bucketize(c, PRICE_BOUNDS, PRICE_LABELS)


def price_category_alt(c: Column) -> Column:
    return bucketize(c, ALT_PRICE_BOUNDS, ALT_PRICE_LABELS, ALT_PRICE_MISSING)


def rating_label(c: Column) -> Column:
    return grade(c, RATING_GRADES, RATING_OTHERWISE)


def _first_match(steps, otherwise: str) -> Column:
    chain = F
    for test, label in steps:
        chain = chain.when(test, label)
    return F.lit(otherwise) if chain is F else chain.otherwise(otherwise)
