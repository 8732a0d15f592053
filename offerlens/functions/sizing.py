"""Size-checked broadcast.

A side is broadcast only when its row count is proven below a bound; beyond
the bound the plain (shuffle) join is kept, so a dimension that grows with
the data never blows up the driver or executor memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 200_000


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if ``df`` has at most ``max_rows`` rows, else ``df``.

    The check reads at most ``max_rows + 1`` rows (a ``limit`` job), so it
    stays cheap even when the side turns out to be large.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
