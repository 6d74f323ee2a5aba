"""Splitting free-text name lists into one row per name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions._col import as_col
from rankforge.functions.text import normalize_name, zs_trim

# How a byline is cut into names. Each pair is applied in order
# as a case-sensitive literal replacement, then the text is split on commas.
# " And " and " with " are deliberately not separators.
BYLINE_REPLACEMENTS = [(" & ", " and "), (" AND ", " and "), (" and ", ",")]
NAME_DELIMITER = ","


def byline_to_delimited(c, replacements: Sequence[tuple[str, str]] = BYLINE_REPLACEMENTS) -> Column:
    out = as_col(c)
    for old, new in replacements:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def explode_names(df: DataFrame, text_col: str, raw_col: str = "name_raw",
                  norm_col: str = "name_norm", keep: Sequence[str] = (),
                  collapse_ws: bool = False,
                  replacements: Sequence[tuple[str, str]] = BYLINE_REPLACEMENTS) -> DataFrame:
    """One row per non-blank name piece of ``text_col``.

    Output: ``*keep, raw_col`` (trimmed piece), ``norm_col`` (lower-cased,
    trimmed piece). Rows whose text is NULL produce nothing. A row-local
    generator: no shuffle.
    """
    delim = byline_to_delimited(F.col(text_col), replacements)
    pieces = (df.where(F.col(text_col).isNotNull())
                .select(*keep, F.explode(F.split(delim, NAME_DELIMITER)).alias("__piece")))
    return (pieces.where(zs_trim("__piece") != "")
                  .select(*keep,
                          zs_trim("__piece").alias(raw_col),
                          normalize_name("__piece", collapse_ws).alias(norm_col)))
