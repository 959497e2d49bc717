"""Column expressions for words and lines, shared by the operators here.

None of them is a Python UDF. A null text has no words and no lines.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ASCII white space that ends a word, and what may not be
# in an alphanumeric word (all ASCII but digits and letters).
BLANKS = r"[\x09-\x0D\x20]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def _pieces(text: Column, breaks: str) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), breaks, -1), "")


def blank_words(text: Column) -> Column:
    """Runs of anything but ASCII white space, in order."""
    return _pieces(text, BLANKS)


def alnum_words(text: Column) -> Column:
    """Runs of ASCII digits and letters and of non-ASCII characters, in order."""
    return _pieces(text, NOT_ALNUM)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    ``lower`` is much faster than ``translate`` and does the same to a text
    of ASCII characters alone, which has as many bytes as characters.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


def lines(text: Column) -> Column:
    """The text cut at every line feed; a null text has none."""
    return F.when(text.isNull(), F.array().cast("array<string>")) \
        .otherwise(F.split(text, "\n", -1))


def named(column: str) -> Column:
    """The column of that name, whatever characters are in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, so added columns never clash."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name
