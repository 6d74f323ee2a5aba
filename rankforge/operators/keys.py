"""Natural-key consolidation with hashed surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions import blank_to_null, md5_key


def consolidate_keys(frames: Sequence[DataFrame], candidates: Sequence[str],
                     nk: str = "nk", key: str = "key") -> DataFrame:
    """Union key rows from several sources into one row per natural key.

    The natural key is the first non-blank candidate column; each candidate
    column is consolidated with ``max`` over non-blank values; the surrogate
    key is the MD5 of the natural key. Output: ``key, nk, *candidates``.

    A plain hash aggregate: partial ``max`` runs map-side, so a key present
    in a third of the input still shuffles one row per map task.
    """
    cols = list(candidates)
    u = reduce(lambda a, b: a.unionByName(b), [f.select(*cols) for f in frames])
    nat = F.coalesce(*[blank_to_null(c) for c in cols])
    agg = (u.where(nat.isNotNull())
             .groupBy(nat.alias(nk))
             .agg(*[F.max(blank_to_null(c)).alias(c) for c in cols]))
    return agg.select(md5_key(nk).alias(key), nk, *cols)
