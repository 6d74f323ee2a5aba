"""First-available-key joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_first_available(left: DataFrame, right: DataFrame,
                         pairs: Sequence[tuple[str, str]], how: str = "left") -> DataFrame:
    """Join each left row on the first of its keys that is not NULL.

    ``pairs`` is ``[(left_col, right_col), ...]`` in priority order. A row
    whose first ``i`` keys are NULL and key ``i+1`` is set matches right rows
    on pair ``i+1`` only - the disjunctive condition
    ``(l1 is not null and r1 = l1) or (l1 is null and l2 is not null and
    r2 = l2) ...`` - planned as a single equi-join instead of a nested-loop
    join: each left row carries (index of its first set key, that key as
    text); each right row is repeated once per pair as (pair index, its key
    as text). Left rows with every key NULL are kept (``how='left'``) with
    no match. Right column names must not clash with left ones.
    """
    tag, val = "__jfa_tag", "__jfa_val"
    first = None
    for i, (lc, _) in enumerate(pairs):
        cond = F.col(lc).isNotNull()
        first = F.when(cond, F.lit(i)) if first is None else first.when(cond, F.lit(i))
    key_text = F.element_at(F.array(*[F.col(lc).cast("string") for lc, _ in pairs]), first + 1)
    l = left.withColumns({tag: first, val: key_text})
    per_pair = F.explode(F.array(*[
        F.struct(F.lit(i).alias(tag), F.col(rc).cast("string").alias(val))
        for i, (_, rc) in enumerate(pairs)]))
    r = (right.select("*", per_pair.alias("__jfa"))
              .select(*right.columns, F.col("__jfa")[tag].alias(tag), F.col("__jfa")[val].alias(val))
              .where(F.col(val).isNotNull()))
    return l.join(r, [tag, val], how).drop(tag, val)
