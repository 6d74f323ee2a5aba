"""Calendar tables: day spines and week dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.dates import date_key


def day_spine(bounds: DataFrame, lo: str, hi: str, out: str = "date_day") -> DataFrame:
    """Every day from ``lo`` to ``hi`` inclusive for each bounds row.

    ``bounds`` is normally the one-row result of a global min/max. The spine
    has one row per day of the span, so its size is set by the calendar, not
    by the data volume.
    """
    return bounds.select(
        F.explode(F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias(out))


def with_date_parts(df: DataFrame, day: str, key: str = "date_key", day_part: bool = True) -> DataFrame:
    """Add the integer ``YYYYMMDD`` key and year/month(/day) parts."""
    d = F.col(day)
    cols = [date_key(d).alias(key), d, F.year(d).alias("year"), F.month(d).alias("month")]
    if day_part:
        cols.append(F.dayofmonth(d).alias("day"))
    return df.select(*cols)


def calendar(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """``date_key, date_day, year, month, day`` for each day of the span."""
    return with_date_parts(day_spine(bounds, lo, hi), "date_day")


def week_dimension(dates: DataFrame, date_col: str) -> DataFrame:
    """Distinct dates as weeks: ``week_key, week_date, year, month``."""
    w = (dates.select(F.col(date_col).cast("date").alias("week_date"))
              .where(F.col("week_date").isNotNull()).distinct())
    return with_date_parts(w, "week_date", key="week_key", day_part=False)
