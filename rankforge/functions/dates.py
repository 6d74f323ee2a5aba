"""Date keys, calendar parts and freshness helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankforge.functions._col import as_col

# Fixed value: a missing timestamp counts as the Unix epoch when picking the
# freshest of several timestamps.
EPOCH = "1970-01-01 00:00:00"


def date_key(c) -> Column:
    """Smart integer key ``YYYYMMDD`` of a date (NULL stays NULL)."""
    d = as_col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(c) -> Column:
    """Inverse of :func:`date_key` (strict)."""
    return F.to_date(F.lpad(as_col(c).cast("string"), 8, "0"), "yyyyMMdd")


def epoch_ts() -> Column:
    return F.lit(EPOCH).cast("timestamp")


def freshest(*cols) -> Column:
    """Latest of several timestamps, missing ones counted as the epoch."""
    return F.greatest(*[F.coalesce(as_col(c), epoch_ts()) for c in cols])
