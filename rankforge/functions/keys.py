"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankforge.functions._col import as_col


def md5_key(c) -> Column:
    """Hashed surrogate key: lower-case hex MD5 of the natural key text."""
    return F.md5(as_col(c).cast("string"))
