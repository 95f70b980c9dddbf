"""String cleaning as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space at either end of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts that stand for a missing value.
NULL_TOKENS = ("None", "nan", "<NA>")


def strip(col: Column) -> Column:
    """Remove Unicode white space at both ends; NULL stays NULL."""
    return F.btrim(col, F.lit(WHITESPACE))


def null_tokens_to_null(col: Column, empty_is_null: bool) -> Column:
    """Turn the null tokens (and, if asked, the empty text) into NULL."""
    tokens = NULL_TOKENS + (("",) if empty_is_null else ())
    return F.when(~col.isin(*tokens), col)


def clip(col: Column, length: int) -> Column:
    """First `length` characters of a text."""
    return F.substring(col, 1, length)


def safe_name(name: str) -> str:
    """Column name usable without quoting."""
    return name.replace("-", "_")
