"""Line dedup by site-relative frequency.

Pages are grouped by host. The pages of a host that contain a line, divided by all pages
of the host, is the line's ratio there; lines above a boilerplate ratio are dropped from
the pages of that host and kept elsewhere. Lines are counted by a digest, once for each
page, with sums made in the map tasks, so that a hot host or line shuffles one short row
for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.tables import cut, few, rows_written

BROADCAST_ROWS = 100_000  # boilerplate lines of about 60 bytes that are sent to every task


def _digests(text: Column) -> Column:
    """An md5 for each line of ``text``, spaces around it trimmed; null for a blank one."""
    return F.transform(F.split(text, "\n"), lambda x: F.when(
        F.trim(x) != "", F.unhex(F.md5(F.encode(F.trim(x), "UTF-8")))))


def boilerplate(
    pages: DataFrame, host: str, text: str = "text", most_ratio: float = 0.1, least_pages: int = 5,
    copies: bool = True,
) -> DataFrame:
    """(host, line, n_pages, host_pages) of the lines above the ratio; line is a digest.

    A line counts once for each page. Without ``copies``, the pages of a host with equal
    texts are one page, so that only lines shared by different pages are boilerplate. Blank lines are no lines. At least ``least_pages``
    pages must have the line: on a host of few pages a line of one page is no sign.
    """
    own = pages.select(F.col(host).alias("host"), F.array_distinct(_digests(F.col(text))).alias("lines"))
    if not copies:  # a digest tells pages apart, and one row of each counts; no text is written
        digest = F.unhex(F.md5(F.encode(F.col(text), "UTF-8"))).alias("page")
        own = rows_written(pages.select(
            F.col(host).alias("host"), F.array_distinct(_digests(F.col(text))).alias("lines"), digest))
        first = cut(own.groupBy("host", "page").agg(F.min("__row").alias("__row")).select("__row"))
        own = own.join(few(first), "__row", "left_semi")
    totals = own.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    each = own.select("host", F.explode("lines").alias("line"))
    counts = each.where("line IS NOT NULL").groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_pages"))
    return counts.where(F.col("n_pages") >= least_pages).alias("c").join(
        totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host"))).where(
        F.col("n_pages") > most_ratio * F.col("host_pages")).select(
        "c.host", "line", "n_pages", "host_pages")


def drop_boilerplate(
    pages: DataFrame, host: str, text: str = "text", most_ratio: float = 0.1, least_pages: int = 5,
    dropped: str = "n_dropped", copies: bool = True,
) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text``, and how many in ``dropped``.

    A host has fewer such lines than its mean number of lines a page divided by the
    ratio, so they are joined to its pages as one array. Up to BROADCAST_ROWS lines in
    all are broadcast and no page is moved; beyond that the join shuffles pages by host,
    and adaptive execution splits a hot one.

    The other lines stay as they were, in order, blank ones included; a text that loses
    every line is empty. Null texts stay null and count as pages of their host; a null
    host is one host; repeated rows are pages of their own, or one page without ``copies``;
    other columns stay, but for one named as ``dropped``, which is replaced; no rows give no rows.
    """
    found = cut(boilerplate(pages, host, text, most_ratio, least_pages, copies))
    by_host = found.groupBy("host").agg(F.collect_list("line").alias("__lines")).withColumnRenamed(
        "host", "__host")
    if found.count() <= BROADCAST_ROWS:
        by_host = F.broadcast(by_host)
    joined = pages.drop(dropped).join(by_host, F.col(host).eqNullSafe(F.col("__host")), "left")
    lines = F.split(F.col(text), "\n")
    marked = F.arrays_zip(lines.alias("line"), _digests(F.col(text)).alias("digest"))
    kept = F.transform(
        F.filter(marked, lambda x: x["digest"].isNull() | ~F.array_contains("__lines", x["digest"])),
        lambda x: x["line"])
    changed = F.col("__lines").isNotNull() & F.col(text).isNotNull()
    gone = F.when(changed, F.size(lines) - F.size(kept)).otherwise(0)
    return joined.withColumn(dropped, gone).withColumn(
        text, F.when(changed, F.array_join(kept, "\n")).otherwise(F.col(text))).select(
        *[c for c in pages.columns if c != dropped], dropped)
