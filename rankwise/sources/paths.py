"""Run-date stamping of output paths.

The date is one more path element, put in at a single place: before the leaf
when the leaf names a file, at the end otherwise.
"""
from __future__ import annotations

import datetime as _dt
import re

# A leaf that names a file has a dot inside: neither its first character (a
# dotfile) nor its last.
_FILE_LEAF = re.compile(r"(?!\.)(?=[^/\\]*\.)[^/\\]*[^/\\.]\Z")
_LAST_SEPARATOR = re.compile(r"[/\\](?=[^/\\]*\Z)")


def run_date_text(run_date: str | _dt.date | None = None) -> str:
    """ISO date (YYYY-MM-DD) of the run; today, as of the call, by default.

    A date or an ISO date text is accepted. A point in time or any other text
    is not: it would put a colon or a free-form name into the path.
    """
    if run_date is None:
        run_date = _dt.date.today()
    if isinstance(run_date, str):
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", run_date):
            raise ValueError(f"run date must be YYYY-MM-DD, got {run_date!r}")
        run_date = _dt.date.fromisoformat(run_date)
    if isinstance(run_date, _dt.datetime) or not isinstance(run_date, _dt.date):
        raise ValueError(f"run date must be a date, got {run_date!r}")
    return run_date.isoformat()


def dated_output_path(base: str, run_date: str | _dt.date | None = None) -> str:
    """``base`` with the run date as a path element of its own.

    ``out/`` and ``out`` become ``out/<date>``, ``out/result.parquet`` becomes
    ``out/<date>/result.parquet``; a path written with backslashes keeps them.
    """
    day = run_date_text(run_date)
    if not base.strip():
        raise ValueError("output path must not be empty")
    last = _LAST_SEPARATOR.search(base)
    mark = last.group() if last else "/"
    leaf = last.end() if last else 0
    if leaf == len(base):
        elements = [base[:-1], day]
    elif _FILE_LEAF.match(base, leaf):
        elements = [*([base[:leaf - 1]] if last else []), day, base[leaf:]]
    else:
        elements = [base, day]
    return mark.join(elements)
