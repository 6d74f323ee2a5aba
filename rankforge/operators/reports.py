"""Dashboard read queries over the wide weekly scorecard.

The scorecard is read with a filter on ``published_date`` (pruned when the
table is partitioned by it); no joins happen at read time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators.topn import asc, desc, top_k_per_group


def _week(df: DataFrame, week: str | _dt.date | None) -> DataFrame:
    if week is None:
        return df
    return df.where(F.col("published_date") == F.lit(str(week)).cast("date"))


def top_k_for(scorecard: DataFrame, k: int = 15, week: str | _dt.date | None = None) -> DataFrame:
    """The ``k`` best-ranked books of one week (or of every week when
    ``week`` is None: a per-week top-k)."""
    df = _week(scorecard, week)
    return top_k_per_group(df, ["published_date"], [asc("rank"), asc("book_key")], k)


def movers_up(scorecard: DataFrame, week: str | _dt.date | None = None) -> DataFrame:
    """Books that climbed since last week (``rank_delta > 0``), the largest climbs of a week first."""
    return ordered(_week(scorecard, week).where(F.col("rank_delta") > 0), "published_date", "-rank_delta", "rank", "book_key")


def movers_down(scorecard: DataFrame, week: str | _dt.date | None = None) -> DataFrame:
    """Books that dropped since last week (``rank_delta < 0``), the largest drops of a week first."""
    return ordered(_week(scorecard, week).where(F.col("rank_delta") < 0), "published_date", "rank_delta", "rank", "book_key")


def new_entries(scorecard: DataFrame, week: str | _dt.date | None = None) -> DataFrame:
    """Books entering the list this week, by rank."""
    return ordered(_week(scorecard, week).where(F.col("is_new")), "published_date", "rank", "book_key")


def weekly_kpi(scorecard: DataFrame, week: str | _dt.date | None = None) -> DataFrame:
    """Control and attention KPIs per week (one row per ``published_date``)."""
    df = _week(scorecard, week)
    return df.groupBy("published_date").agg(
        F.count(F.lit(1)).alias("n_books"),
        F.count_if(F.col("is_new")).alias("n_new"),
        F.count_if(F.col("rank_delta") > 0).alias("n_up"),
        F.count_if(F.col("rank_delta") < 0).alias("n_down"),
        F.max("rank_delta").alias("best_climb"),
        F.min("rank_delta").alias("worst_drop"),
        F.sum("views_7d").alias("views_7d_total"),
        F.max("views_7d").alias("views_7d_max"),
        F.count_if(F.col("views_7d") > 0).alias("n_with_views"),
    )


def ordered(df: DataFrame, *keys) -> DataFrame:
    """Presentation sort (for display/export only)."""
    return df.orderBy(*[desc(k[1:]) if isinstance(k, str) and k.startswith("-") else asc(k)
                        for k in keys])
