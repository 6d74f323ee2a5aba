"""Safe casts with the semantics the reference's warehouse applies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions._col import as_col


# Integer text forms the warehouse's cast accepts besides plain
# decimals - digit-group underscores between two digits (``1_000``) and
# unsigned, unpadded hexadecimal / binary literals (``0x1F``, ``0b101``).
_BAD_UNDERSCORE = r"(^|[^0-9])_|_([^0-9]|$)"
_HEX = r"^0[xX][0-9a-fA-F]+(_[0-9a-fA-F]+)*$"
_BIN = r"^0[bB][01]+(_[01]+)*$"
_PLAIN_DIGITS = r"\A[0-9]{1,18}\z"


def _digits(c: Column, most: int) -> Column:
    """Digits after a two-character prefix, without underscores and leading zeros; NULL beyond ``most`` of them."""
    d = F.regexp_replace(F.regexp_replace(F.substr(c, F.lit(3)), "_", ""), "^0+(?=.)", "")
    return F.when(F.length(d) <= most, d)


def safe_long(c) -> Column:
    """Text/number -> bigint, NULL when impossible.

    Fractional text rounds half away from zero (``'4.5'`` -> 5,
    ``'-2.5'`` -> -3), exponent text is accepted (``'1e3'`` -> 1000),
    underscores between digits are ignored (``'1_000'``), ``0x``/``0b``
    literals are read in base 16/2, and overflow gives NULL.
    """
    c = as_col(c).cast("string")
    txt = F.when(~c.rlike(_BAD_UNDERSCORE), F.regexp_replace(c, "_", ""))
    dec = F.coalesce(txt.try_cast("bigint"),
                     F.round(txt.try_cast("decimal(38,9)"), 0).try_cast("bigint"))

    def radix(pattern: str, base: int, most: int) -> Column:
        value = F.conv(_digits(c, most), base, 10)
        return F.when(c.rlike(pattern), value.try_cast("decimal(38,0)").try_cast("bigint"))

    # Plain digits, nearly all there are, need none of this.
    return F.when(c.rlike(_PLAIN_DIGITS), c.try_cast("bigint")).otherwise(F.coalesce(radix(_HEX, 16, 16), radix(_BIN, 2, 64), dec))


def long_of(df: DataFrame, name: str) -> Column:
    """:func:`safe_long` of a column; one declared as an integer is only widened."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint")
    return safe_long(name)


def wide_of(df: DataFrame, name: str) -> Column:
    """As :func:`long_of`, in 38 digits; a decimal column keeps values that 64 bits don't hold (fractions round half away from zero)."""
    if isinstance(df.schema[name].dataType, T.DecimalType):
        return F.col(name).try_cast("decimal(38,0)")
    return long_of(df, name).cast("decimal(38,0)")


def int_of(df: DataFrame, name: str) -> Column:
    """As :func:`long_of`, narrowed to int (NULL on overflow)."""
    return long_of(df, name).try_cast("int")


def safe_int(c) -> Column:
    """As :func:`safe_long`, narrowed to int (NULL on overflow)."""
    return safe_long(c).try_cast("int")


def safe_double(c) -> Column:
    """Text/number -> double, NULL when impossible (underscores between
    digits ignored; ``inf``/``nan`` spellings accepted)."""
    c = as_col(c).cast("string")
    plain = F.when(F.contains(c, F.lit("_")), F.when(~c.rlike(_BAD_UNDERSCORE), F.regexp_replace(c, "_", ""))).otherwise(c)
    return plain.try_cast("double")


# The date text forms the warehouse's date cast accepts - a year
# with an optional minus sign, month and day joined by one repeated separator
# (- / \ or a blank), then optionally " (BC)", then blanks or a time of day after a
# space or "T"; or the word "epoch".
_DATE_TEXT = r"^\s*(-?)0*(\d{1,7})([-/\\ ])(\d{1,2})\3(\d{1,2})( \([bB][cC]\))?(\s*|[ T]\d{1,2}:\d{2}.*)$"
_PLAIN_DATE = r"^[1-9]\d{3}-\d{2}-\d{2}$"
_YEARS, _DAYS = 400, 146097  # after so many years the calendar repeats, so many days later
_LAST_DAY = (1 << 31) - 2


def safe_date(c) -> Column:
    """Text -> date, requiring year, month and day.

    Year-only (``'2021'``) and year-month (``'2021-05'``) text give NULL, as
    do mixed separators and impossible days; one-digit parts, short and long years, years BC,
    ``/`` separators, surrounding blanks and a trailing time are accepted.
    """
    c = as_col(c)
    # Plain dates, nearly all there are, need none of the rest, which stands in a lambda: written out in the
    # row's own code it would make a method of more than 8000 bytes, which the JVM never compiles.
    odd = F.element_at(F.transform(F.array(c), _odd_date), 1)
    return (F.when(c.rlike(_PLAIN_DATE), c.try_cast("date"))
             .when(F.lower(c) == "epoch", F.date_from_unix_date(F.lit(0))).when(c.rlike(_DATE_TEXT), odd))


def _odd_date(c: Column) -> Column:
    """The date of a text that :data:`_DATE_TEXT` matches."""
    part = lambda i: F.regexp_extract(c, _DATE_TEXT, i)
    text = part(2).try_cast("int")
    bc = part(6) != ""
    # Years before the first one are 0, -1, ...; "1 (BC)" is 0.
    year = F.when(bc, 1 - text).when(part(1) == "-", -text).otherwise(text)
    alike = F.lit(2000) + F.pmod(year, F.lit(_YEARS))  # a year with the same calendar, near enough for the parser
    day = F.concat(alike.cast("string"), F.lit("-"), F.lpad(part(4), 2, "0"), F.lit("-"), F.lpad(part(5), 2, "0")).try_cast("date")
    days = F.unix_date(day).cast("bigint") + F.floor((year - alike) / F.lit(_YEARS)) * F.lit(_DAYS)
    ok = ~(bc & ((part(1) == "-") | (text == 0))) & (F.abs(days) <= _LAST_DAY)
    return F.when(ok, F.date_from_unix_date(days.cast("int")))


def decimal_to_text(c) -> Column:
    """DECIMAL -> integer text, rounding (``...1.5`` -> ``...2``)."""
    return F.round(as_col(c), 0).cast("bigint").cast("string")


def yyyymmdd_to_date(c) -> Column:
    """``'YYYYMMDDhh'`` (or ``'YYYYMMDD'``) text -> date; invalid -> NULL."""
    return F.try_to_date(F.substring(as_col(c), 1, 8), "yyyyMMdd")


def total(c, wide: bool = False) -> Column:
    """Sum of whole numbers: in 64 bits (beyond them an error), or ``wide``, in 38 digits."""
    return F.sum(as_col(c).cast("decimal(38,0)") if wide else as_col(c))
