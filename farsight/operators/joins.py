"""Size-checked broadcast.

A side is broadcast only after its row count has been measured against a
bound; beyond the bound the caller's join stays a shuffle join (AQE may still
split skewed partitions).  The side is first checkpointed to the shared work
folder so that counting it does not recompute it and executor loss cannot
lose it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farsight.session import materialize

# Rows of a narrow key table that are safe to ship to every executor
# (a few tens of MB for two or three narrow columns).
DEFAULT_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       checkpoint: bool = True) -> tuple[DataFrame, bool]:
    """Return (frame, broadcast?) where frame carries the broadcast hint iff
    its measured row count is <= max_rows."""
    if checkpoint:
        df = materialize(df)
    n = df.count()
    if n <= max_rows:
        return F.broadcast(df), True
    return df, False
