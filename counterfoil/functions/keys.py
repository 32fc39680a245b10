"""Join keys for rows that cannot match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Only the spread of rows over tasks depends on this number, not the result.
SPREAD = 65_536


def spread(key: Column, fallback: Column) -> Column:
    """A second join key that is equal on both sides whenever `key` is.

    Rows whose key is null match nothing, but an outer join sends all of them to
    the task that holds null. With this key next to the real one they are dealt
    out by `fallback`, a column that differs from row to row.
    """
    return F.pmod(F.xxhash64(F.coalesce(key, fallback)), F.lit(SPREAD))
