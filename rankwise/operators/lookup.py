"""Lookup tables: build one row per key, and enrich rows from it."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: largest lookup (measured bytes, see lookup_size) that is
# broadcast; beyond it the enrichment is a sort-merge join.
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
# Fixed value: bytes of a hashed row besides its key and value: row header and
# field slots, the null-safe key's flag, the hash entry at its load factor, and
# what alignment adds to each.
ROW_OVERHEAD = 160

_KEY = "__lookup_key"


def build_lookup(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key (the largest value wins on duplicates).

    Without it a left join would fan out on a duplicated key.
    """
    return lookup.groupBy(key).agg(F.max(value).alias(value))


def lookup_size(lookup: DataFrame, key: str, value: str) -> tuple[int, int]:
    """(rows, bytes as a hash relation), measured with one aggregate.

    Key and value count with the bytes of their text, the key twice, as a
    null-safe join hashes a second copy of it; every row costs ``ROW_OVERHEAD``.
    """
    def text_bytes(c: str):
        return F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("bigint")
    row = lookup.agg(F.count(F.lit(1)).alias("rows"),
                     F.coalesce(F.sum(2 * text_bytes(key) + text_bytes(value)), F.lit(0))
                     .alias("chars")).first()
    rows = int(row["rows"])
    return rows, rows * ROW_OVERHEAD + int(row["chars"])


def enrich(df: DataFrame, lookup: DataFrame, key: str, value: str, *,
           position: int = 1,
           broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
           size_bound: int | None = None) -> DataFrame:
    """Left lookup join that adds ``value`` at ``position``.

    ``lookup`` must have one row per key (see ``build_lookup``). A missing
    key gives null and keeps the row; a null key matches a null lookup key.
    The lookup is measured first (or ``size_bound`` is given: any upper
    bound of its bytes, e.g. measured on the input before ``build_lookup``)
    and broadcast only when it fits ``broadcast_limit`` -- then the large
    side is not shuffled at all. Otherwise a sort-merge join is requested
    explicitly, so a file-size estimate cannot turn an oversized lookup
    into a broadcast behind the check's back.
    """
    if value in df.columns:
        raise ValueError(f"column {value!r} already exists")
    side = lookup.select(F.col(key).alias(_KEY), F.col(value))
    size = size_bound if size_bound is not None else lookup_size(side, _KEY, value)[1]
    side = F.broadcast(side) if size <= broadcast_limit else side.hint("merge")
    joined = df.join(side, df[key].eqNullSafe(side[_KEY]), "left")
    columns = list(df.columns)
    columns.insert(max(0, min(position, len(columns))), value)
    return joined.select(*columns)
