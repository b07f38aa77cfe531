"""Moving between wall-clock times and instants without the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_instant(ts: Column | str) -> Column:
    """A wall-clock time read as UTC. Watermarks need an instant."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ltz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts),
        F.extract(F.lit("SECOND"), ts), F.lit("UTC"),
    )


def as_wall_clock(instant: Column) -> Column:
    """The UTC wall-clock time of an instant."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds)


def day_number(ts: Column | str) -> Column:
    """Whole days since 1970-01-01."""
    return F.unix_date(F.to_date(ts))
