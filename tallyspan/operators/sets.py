"""Set operations that shuffle each value once per task, not once per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Copies of one row that a task writes in one go.
_COPIES = 65_536


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in both, once each. One shuffle, of the distinct rows of each task; a plain
    ``intersect`` shuffles all rows of both sides."""
    columns = left.columns
    sides = left.withColumns({"__l": F.lit(True), "__r": F.lit(False)}).unionAll(
        right.toDF(*columns).withColumns({"__l": F.lit(False), "__r": F.lit(True)})
    )
    found = sides.groupBy(*columns).agg(F.bool_or("__l").alias("__l"), F.bool_or("__r").alias("__r"))
    return found.where("__l AND __r").select(*columns)


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` less one copy for each equal row of ``right``, as EXCEPT ALL.

    Both sides are counted per row value before the shuffle. A value may be left over
    very many times, so its copies are made in blocks spread over the tasks.
    """
    columns = left.columns
    change = left.withColumn("__n", F.lit(1)).unionAll(
        right.toDF(*columns).withColumn("__n", F.lit(-1))
    )
    left_over = change.groupBy(*columns).agg(F.sum("__n").alias("__n")).where(F.col("__n") > 0)
    few = left_over.where(F.col("__n") <= _COPIES).withColumn("__size", F.col("__n"))
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1, F.lit(_COPIES).cast("bigint")))
    many = (
        left_over.where(F.col("__n") > _COPIES)
        .withColumn("__from", block)
        .withColumn("__size", F.least(F.col("__n") - F.col("__from"), F.lit(_COPIES)))
        .repartition(*columns, "__from")
        .drop("__from")
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.col("__size").cast("int")))
    return few.unionByName(many).withColumn("__copy", copies).select(*columns)
