"""How source values are read: they arrive as text, blanks of any white space mean absent, and numbers need parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as white space at a value's ends.
BLANKS = " \t\n\r\f\x0b"


def text(c: Column) -> Column:
    return c.cast("string")


def strip(c: Column) -> Column:
    return F.btrim(text(c), F.lit(BLANKS))


def present(c: Column) -> Column:
    """Neither null nor blank; never null itself."""
    return F.coalesce(strip(c) != "", F.lit(False))


def key(c: Column) -> Column:
    """Text without white space at its ends, null as the empty text."""
    return F.coalesce(strip(c), F.lit(""))


def normal(c: Column) -> Column:
    """key() without a trailing `.0`, so that codes written as numbers compare."""
    return F.regexp_replace(key(c), r"\.0+$", "")


def number(c: Column) -> Column:
    """As a double; null if it isn't a number."""
    return strip(c).try_cast("double")


def whole(c: Column) -> Column:
    """As an integer, numbers with a fraction rounded half to even; null if it isn't a number."""
    return F.bround(number(c)).try_cast("int")


def moment(c: Column) -> Column:
    """As a timestamp without zone; null if it can't be read."""
    return c.try_cast("timestamp_ntz")


def seconds(c: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone, with fractions."""
    return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)


def hours_between(start: Column, end: Column) -> Column:
    return (seconds(end) - seconds(start)) / 3600.0


def rounded(c: Column, decimals: int) -> Column:
    """Half to even."""
    return F.bround(c, decimals)


def shown(c: Column) -> Column:
    """As it is reported: null as the empty text."""
    return F.coalesce(text(c), F.lit(""))


def shown_moment(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(""))
