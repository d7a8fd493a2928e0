"""A name for an intermediate value inside one column expression."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often `use` refers to it.

    Spark would otherwise repeat a costly expression at every reference.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
