"""Broadcast behind a size known before the plan is built.

A join side is broadcast only when its size, a row count times a bound on a
row's bytes, is within a limit in bytes. The counts come from the source
tables (``Sources.sizes``: one small job per ``Sources``, kept there), never
from executing the side itself. Beyond the limit the side is joined by a
shuffle (AQE splits skewed partitions), so a dimension that grows with the
data never floods executor memory. There the shuffle is asked for by a hint: AQE
judges a side by its compressed shuffle files, and would send tables of a million
rows through the driver, several at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest side that is broadcast, as held by an executor.
MAX_BROADCAST_BYTES = 256 << 20
#: Bytes a row of a few fixed-width columns takes in a broadcast hash relation.
ROW_BYTES = 160


def fits(rows: int | None, max_bytes: int = MAX_BROADCAST_BYTES, row_bytes: int = ROW_BYTES) -> bool:
    """Whether so many rows may be broadcast; an unknown number may not."""
    return rows is not None and rows * row_bytes <= max_bytes


def broadcast_if_small(df: DataFrame, rows: int | None, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``df`` has at most ``rows`` rows and these fit, else ``df`` as a side that is shuffled."""
    return F.broadcast(df) if fits(rows, max_bytes) else df.hint("merge")
