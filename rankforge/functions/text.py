"""Text column functions: blank handling, trimming, name normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankforge.functions._col import as_col

# Fixed values that results depend on:
# trimming strips Unicode space separators (category Zs, e.g. U+0020 and
# U+00A0) at both ends, but not tab or newline.
_EDGE_SPACES = r"^\p{Zs}+|\p{Zs}+$"
# Lower-casing is one code point to one code point: the two letters whose
# Java lower case is context-dependent or longer - capital I with dot above
# and capital sigma - are mapped to their simple lower case first.
_SIMPLE_LOWER_FROM = "\u0130\u03a3"
_SIMPLE_LOWER_TO = "i\u03c3"


def zs_trim(c) -> Column:
    """Trim Unicode space separators from both ends (tab/newline are kept)."""
    return F.regexp_replace(as_col(c), _EDGE_SPACES, "")


def blank_to_null(c) -> Column:
    """Empty string means missing: ``''`` -> NULL (no trimming)."""
    c = as_col(c)
    return F.nullif(c, F.lit(""))


def trimmed_or_null(c) -> Column:
    """Trim, then treat the empty result as missing."""
    return F.nullif(zs_trim(c), F.lit(""))


def simple_lower(c) -> Column:
    """Lower case, one code point at a time (no final-sigma or dotted-I rules)."""
    return F.lower(F.translate(as_col(c), _SIMPLE_LOWER_FROM, _SIMPLE_LOWER_TO))


def collapse_spaces(c) -> Column:
    """Collapse every whitespace run to a single space."""
    return F.regexp_replace(as_col(c), r"\s+", " ")


def collapse_literal(c) -> Column:
    """The first backslash with letters ``s`` after it becomes a space: what the
    whitespace pattern, escaped once too often, means to the reference's warehouse."""
    c = as_col(c)
    return F.when(F.contains(c, F.lit("\\")), F.regexp_replace(c, r"(?s)^(.*?)\\s+", "$1 ")).otherwise(c)


def strip_literal_suffix(c) -> Column:
    """Remove a trailing backslash, any one character and zeros: the decimal pattern, likewise."""
    c = as_col(c)
    return F.when(F.contains(c, F.lit("\\")), F.regexp_replace(c, r"\\[^\n]0+\z", "")).otherwise(c)


def strip_decimal_suffix(c) -> Column:
    """Remove a trailing ``.0``, ``.00``, ... from numeric text."""
    return F.regexp_replace(as_col(c), r"\.0+$", "")


def normalize_name(c, collapse_ws: bool = False) -> Column:
    """Lower-case and trim a person name.

    By default whitespace runs inside the name are kept as they are and only a literal
    backslash pattern is replaced (the reference behaviour, see :func:`collapse_literal`).
    ``collapse_ws=True`` collapses them to one space.
    """
    out = zs_trim(simple_lower(c))
    return collapse_spaces(out) if collapse_ws else collapse_literal(out)


def clean_isbn_text(c, strip_decimal: bool = False) -> Column:
    """ISBN text as carried by the ranked list: optionally drop ``.0`` tails, else what the
    reference's pattern drops."""
    c = as_col(c).cast("string")
    return strip_decimal_suffix(c) if strip_decimal else strip_literal_suffix(c)


def strip_chars(c, chars: str) -> Column:
    """Delete every occurrence of each character in ``chars``."""
    return F.translate(as_col(c), chars, "")
