"""Top-k / best-record-per-key and in-group numbering.

All of these are ``row_number()`` windows. For ``k``-row filters Catalyst
inserts a partial ``WindowGroupLimit`` *before* the shuffle, so every map task
forwards at most ``k`` rows per key: a key that holds a third of the table
costs no more shuffle than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions._col import as_col


def desc(c) -> Column:
    """Descending, NULLs last (the warehouse's default placement)."""
    return as_col(c).desc_nulls_last()


def asc(c) -> Column:
    """Ascending, NULLs last (the warehouse's default placement)."""
    return as_col(c).asc_nulls_last()


def _window(keys: Sequence, order: Sequence[Column]):
    return Window.partitionBy(*[as_col(k) for k in keys]).orderBy(*order)


def top_k_per_group(df: DataFrame, keys: Sequence, order: Sequence[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """Keep the first ``k`` rows of each group under ``order``.

    ``rank_col`` keeps the 1-based position (int) as a column.
    """
    tmp = rank_col or "__rn"
    out = df.withColumn(tmp, F.row_number().over(_window(keys, order))).where(F.col(tmp) <= k)
    return out if rank_col else out.drop(tmp)


def best_per_key(df: DataFrame, keys: Sequence, order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order`` (append tie-breakers to
    ``order`` for a deterministic winner)."""
    return top_k_per_group(df, keys, order, 1)


def latest_per_key(df: DataFrame, keys: Sequence, ts, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the latest by ``ts`` (NULL times last), then
    ``tiebreak`` - the "latest extraction wins" rule of append-only data."""
    return best_per_key(df, keys, [desc(ts), *tiebreak])


def number_in_group(df: DataFrame, keys: Sequence, order: Sequence[Column],
                    out: str = "n", first_flag: str | None = None) -> DataFrame:
    """Number rows 1..n inside each group (bigint); optionally flag row 1."""
    df = df.withColumn(out, F.row_number().over(_window(keys, order)).cast("bigint"))
    if first_flag:
        df = df.withColumn(first_flag, F.col(out) == 1)
    return df
