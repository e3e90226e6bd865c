"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts that mean "missing" once trimmed. The match is exact, so "NaN" or
# "null" stay text.
MISSING_TEXTS = ("", "nan", "None")


def strip(col: Column) -> Column:
    """Remove all Unicode whitespace from both ends (Spark's plain trim only knows the space).

    A text that starts and ends with a visible ASCII character has nothing to remove; testing that
    is several times cheaper than trimming with a list of characters.
    """
    bare = F.ascii(col).between(33, 126) & F.ascii(F.substring(col, -1, 1)).between(33, 126)
    return F.when(bare, col).otherwise(F.btrim(col, F.lit(WHITESPACE)))


def missing_to_null(col: Column) -> Column:
    """Turn an already stripped text that means "missing" into NULL."""
    return F.when(~col.isin(*MISSING_TEXTS), col)
