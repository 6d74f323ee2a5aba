"""Week-over-week rank movement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankforge.functions._col import as_col


def previous_rank(last) -> Column:
    """Rank 0 means "not ranked last week": treat it as missing."""
    return F.nullif(as_col(last), F.lit(0))


def rank_delta(rank, last) -> Column:
    """Places climbed since last week (positive = up); NULL without a last rank."""
    prev = previous_rank(last)
    return F.when(prev.isNotNull(), prev - as_col(rank))


def is_new_entry(last, weeks_on_list) -> Column:
    """First week on the list and no last-week rank; unknown counts as False."""
    cond = previous_rank(last).isNull() & (as_col(weeks_on_list) == 1)
    return F.coalesce(cond, F.lit(False))


def rank_change_columns(rank: str = "rank", last: str = "rank_last_week",
                        weeks: str = "weeks_on_list") -> list[Column]:
    """``rank, rank_last_week, weeks_on_list, rank_delta, is_new``."""
    return [
        F.col(rank).alias("rank"),
        previous_rank(last).alias("rank_last_week"),
        F.col(weeks).alias("weeks_on_list"),
        rank_delta(rank, last).alias("rank_delta"),
        is_new_entry(last, weeks).alias("is_new"),
    ]
