"""Text clean-up as built-in expressions (no Python in the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's ``str.strip()`` removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Drop Unicode white space at both ends. Looks at the ends only, unlike a regex."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def optional_text(text: Column) -> Column:
    """The stripped text; empty or white space alone becomes NULL."""
    return F.nullif(strip(text), F.lit(""))


def ascii_text(text: Column) -> Column:
    """Each run of non-ASCII characters becomes one space, then strip; NULL becomes ``""``."""
    return F.coalesce(strip(F.regexp_replace(text, r"[^\x00-\x7F]+", " ")), F.lit(""))
