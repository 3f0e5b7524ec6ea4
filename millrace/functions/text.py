"""Text expressions that agree with Python's string methods on Unicode text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Python's str.strip() removes.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: a run of letters, numbers and underscores, the Unicode \w of Python.
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def strip(text: Column) -> Column:
    """Trim Unicode whitespace at both ends (plain ``trim`` only knows the blank)."""
    return F.btrim(text, F.lit(STRIP_CHARS))


def words(text: Column) -> Column:
    """Lower-case words in text order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def windows(text: Column, size: int, overlap: int) -> Column:
    """Cut text into windows of ``size`` characters that share ``overlap`` characters.

    Each match eats one step of ``size - overlap`` characters and captures the
    whole window in a lookahead, so a text is walked once however long it is;
    a ``substring`` per window would start again from the first byte each time.
    Empty text gives an empty array and null gives null.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and smaller than size")
    pattern = rf"(?s)(?=(.{{1,{size}}})).{{1,{size - overlap}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
