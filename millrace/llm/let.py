"""Column expressions that use a value often and compute it once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``. What a lambda names from outside itself is computed for each element; this binds it first."""
    return F.element_at(F.transform(F.array(value), body), 1)
