"""Trailing N-day sums anchored on a set of dates (a range join, planned as
an equi-join)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.casting import total


def expand_anchors(anchors: DataFrame, anchor_date: str, days: int, out: str = "date_day") -> DataFrame:
    """Each anchor row once per day of its window ``[anchor-days+1, anchor]``."""
    offs = F.sequence(F.lit(0), F.lit(days - 1))
    return (anchors.withColumn("__off", F.explode(offs))
                   .withColumn(out, F.date_sub(F.col(anchor_date), F.col("__off")))
                   .drop("__off"))


def trailing_window_sum(facts: DataFrame, anchors: DataFrame, fact_date: str, anchor_date: str,
                        group_keys: Sequence[str], measure: str, days: int = 7,
                        out: str = "value_nd", anchor_cols: Sequence[str] | None = None,
                        pre_aggregate: bool = True, wide: bool = False) -> DataFrame:
    """Sum ``measure`` per (anchor, ``group_keys``) over the ``days`` days
    ending on each anchor date, both ends inclusive.

    Equivalent to ``facts JOIN anchors ON fact_date BETWEEN anchor-days+1
    AND anchor GROUP BY ...`` but never plans a nested-loop join:

    1. facts are pre-aggregated to one row per (group, day) - the sum is
       associative, partial aggregation runs map-side, so hot groups shrink
       before any shuffle (``pre_aggregate=False`` skips this for facts that
       are about that grain already);
    2. each anchor is expanded to its ``days`` dates (anchors x days rows);
    3. the expanded anchors are joined on the date with an equi-join, whose
       strategy Spark picks from run-time sizes;
    4. a final hash aggregate sums per (anchor, group).

    NULL measures stay NULL when every value in a window is NULL. ``wide`` sums
    in 38 digits instead of 64 bits.
    """
    anchor_cols = list(anchor_cols or anchors.columns)
    if pre_aggregate:
        daily = (facts.groupBy(*group_keys, F.col(fact_date).alias("__day"))
                      .agg(total(measure, wide).alias("__v")))
    else:
        daily = facts.select(*group_keys, F.col(fact_date).alias("__day"), F.col(measure).alias("__v"))
    exp = expand_anchors(anchors.select(*anchor_cols), anchor_date, days, out="__day")
    joined = daily.join(exp, "__day", "inner")
    return (joined.groupBy(*anchor_cols, *group_keys)
                  .agg(total("__v", wide).alias(out)))
