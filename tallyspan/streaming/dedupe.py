"""Dropping repeated deliveries from a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators.segments import same
from tallyspan.sources.sinks import write_table

_BATCH, _DAY, _SPAN = "__batch", "__day", "__span"
_MOST_DAYS = 1_000


def spans_before(number: int, fan: int) -> list[tuple[int, int]]:
    """Spans (first, end) of batches, largest first, that hold the batches below ``number``.

    Each is ``fan`` to some power long and starts at a multiple of its length, so there are
    fewer than ``fan`` of each length.
    """
    spans, first, size = [], 0, 1
    while size * fan <= number:
        size *= fan
    while size:
        while first + size <= number:
            spans.append((first, first + size))
            first += size
        size //= fan
    return spans


def first_deliveries(
    stream: DataFrame, keys: Sequence[str], time: str, folder: str, fan: int = 16
) -> DataFrame:
    """One row per key and day of ``time`` out of rows delivered any number of times, however late.

    Processes all input present, adds the rows with new keys to ``folder`` and returns
    all rows there. ``folder`` must be in the shared folder; called with the same one
    again, it goes on after the last finished batch. The copies of a row carry the same
    ``time``; rows of one key on different days are different rows. Rows with a null key
    or time are rows like others. A stream without input gives no rows.

    A batch's copies are dropped first, in the map tasks and then after the shuffle, so
    a row delivered very many times is one row for each task. What is left is compared
    with the keys written before for the same days. The keys of every ``fan`` batches are
    merged into one table by day, those of ``fan`` such tables into the next, and so on: a
    batch lists the tables of its number's digits, fewer than ``fan`` of a length, however
    many batches there were, and reads the folders of its days alone. A second run of
    a batch writes its rows and the tables that end with it anew.
    """
    if fan < 2:
        raise ValueError("fan must be 2 or more")
    keys, spark, schema = list(keys), stream.sparkSession, stream.schema
    rows, merged_keys = f"{folder}/rows", f"{folder}/keys"
    day = F.to_date(time).alias(_DAY)
    key_schema = stream.select(*keys, day).schema
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{rows}/{_BATCH}=-1")

    def span_folder(first: int, end: int) -> str:
        return f"{merged_keys}/{_SPAN}=from-{first}-to-{end}"

    def keys_of(session: SparkSession, spans: list[tuple[int, int]]) -> DataFrame:
        """The keys and days of the spans: of merged tables, or of single batches' rows."""
        single = [f"{rows}/{_BATCH}={first}" for first, end in spans if end - first == 1]
        merged = [span_folder(*span) for span in spans if span[1] - span[0] > 1]
        found = session.read.schema(schema).parquet(*single).select(*keys, day) if single else None
        if merged:
            tables = session.read.schema(key_schema).option("basePath", merged_keys).parquet(*merged)
            tables = tables.select(*keys, _DAY)
            found = tables if found is None else tables.union(found)
        return found

    def add(batch: DataFrame, number: int) -> None:
        dated = batch.withColumn(_DAY, day)
        new = dated.dropDuplicates([*keys, _DAY])
        if number > 0:
            seen = keys_of(batch.sparkSession, spans_before(number, fan)).where(_on_days(dated))
            seen = seen.select(*[F.col(c).alias(f"__r_{c}") for c in (*keys, _DAY)])
            new = new.join(seen, same([*keys, _DAY], "__r_"), "left_anti")
        new.drop(_DAY).write.mode("overwrite").parquet(f"{rows}/{_BATCH}={number}")
        size, end = fan, number + 1
        while end % size == 0:
            parts = [(at, at + size // fan) for at in range(end - size, end, size // fan)]
            write_table(keys_of(spark, parts), span_folder(end - size, end), [_DAY], mode="overwrite")
            size *= fan

    query = (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).option("basePath", rows).parquet(rows).select(*stream.columns)


def _on_days(dated: DataFrame) -> Column:
    """Whether a row's day is one of ``dated``'s; of very many days, all rows may be."""
    days = [r[0] for r in dated.select(_DAY).distinct().limit(_MOST_DAYS + 1).collect()]
    if len(days) > _MOST_DAYS:
        return F.lit(True)
    known = F.col(_DAY).isin([d for d in days if d is not None])
    return known | F.col(_DAY).isNull() if None in days else known
