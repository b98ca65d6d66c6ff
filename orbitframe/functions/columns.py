"""Help with column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out a single time for a row.

    Within a lambda over an array, an outer expression is evaluated anew for each element; bound to
    a lambda's own variable it is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
