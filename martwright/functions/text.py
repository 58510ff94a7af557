"""Text cleaning with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martwright.functions.numeric import col


# The characters that count as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(value: Column | str) -> Column:
    """Drop any white space at both ends, not spaces alone."""
    return F.btrim(col(value), F.lit(WHITESPACE))


def title_case(value: Column | str) -> Column:
    """Upper-case the first letter of every run of letters: `o'neil` -> `O'Neil`."""
    runs = F.regexp_extract_all(col(value), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    cased = F.transform(runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.lower(F.substring(run, 2, 1 << 30))))
    return F.array_join(cased, "")


def blank(value: Column | str) -> Column:
    """NULL or empty text."""
    return col(value).isNull() | (col(value) == "")
