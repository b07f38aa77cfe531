"""Arithmetic on array columns, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_length(vector: Column | str) -> Column:
    """Sum of the squares of the elements, in double precision."""
    squares = F.transform(vector, lambda x: x.cast("double") * x.cast("double"))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)
