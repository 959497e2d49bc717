"""Column expressions shared by the operators.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the token a null becomes when rows are rendered as text.
NULL_TOKEN = "\\N"


def salt_bucket(columns: Sequence[str | Column], buckets: int) -> Column:
    """Bucket ``0..buckets-1`` derived from a hash of ``columns``.

    Deterministic per row, so a re-run task routes every row to the same
    bucket again (a random salt would not survive task retries).
    """
    if buckets < 1:
        raise ValueError(f"buckets must be >= 1, got {buckets}")
    return F.pmod(F.xxhash64(*columns), F.lit(buckets))


def not_null(column: Column, message: str) -> Column:
    """``column`` unchanged, or a task failure with ``message`` on null."""
    return F.coalesce(column, F.raise_error(F.lit(message)))


def _escapes(sep: str) -> list[tuple[str, str]]:
    """What stands for a backslash, a separator and the line breaks."""
    if len(sep) != 1 or sep in "\\\n\rnrN":
        raise ValueError(f"unusable separator {sep!r}")
    return [("\\", "\\\\"), (sep, "\\" + sep), ("\n", "\\n"), ("\r", "\\r")]


def text_line(columns: Sequence[str | Column], sep: str = ",") -> Column:
    """Render columns as one delimited line; ``split_line`` takes it apart.

    A null is ``\\N``. Within a value a backslash precedes itself, the
    separator and the letters ``n`` and ``r`` for line breaks, so no value
    reads as another one, as two fields or as two lines.
    """
    def render(c: str | Column) -> Column:
        value = (F.col(c) if isinstance(c, str) else c).cast("string")
        for plain, escaped in _escapes(sep):
            value = F.replace(value, F.lit(plain), F.lit(escaped))
        return F.coalesce(value, F.lit(NULL_TOKEN))
    return F.concat_ws(sep, *map(render, columns))


def split_line(line: Column, sep: str = ",") -> Column:
    """The fields of a ``text_line``, as an array of strings with nulls."""
    # A field is a run of escaped pairs and of characters that need no escape;
    # one more separator in front makes every field follow one.
    mark = re.escape(sep)
    fields = F.regexp_extract_all(F.concat(F.lit(sep), line),
                                  F.lit(rf"(?s){mark}((?:\\.|[^\\{mark}])*)"), F.lit(1))

    def value(field: Column) -> Column:
        # A line holds no line feed, so one marks what is already unescaped.
        steps = [("\\\\", "\nb"), ("\\n", "\nn"), ("\\r", "\nr"), ("\\" + sep, sep),
                 ("\nb", "\\"), ("\nr", "\r"), ("\nn", "\n")]
        out = field
        for found, new in steps:
            out = F.replace(out, F.lit(found), F.lit(new))
        return F.when(field != NULL_TOKEN, out)
    return F.transform(fields, value)
