"""Broadcasting behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Of a few narrow columns: some ten megabytes in each executor.
BROADCAST_ROWS = 100_000


def broadcast_if_small(rows: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """``rows`` marked for broadcast if it has at most ``max_rows``, else None.

    Spark estimates a filtered table by its files, so it would shuffle a large fact to meet
    a small selection from a large dimension.  Counting the selection reads only the
    columns of its filter, which is little next to that shuffle.
    """
    return F.broadcast(rows) if max_rows and rows.count() <= max_rows else None
