"""What may be sent whole to every executor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def fits_broadcast(
    frame: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a frame, reading at most ``max_rows + 1`` of its rows."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*frame.columns))))
    seen = (
        frame.limit(max_rows + 1)
        .agg(F.count("*").alias("rows"), size.alias("bytes"))
        .first()
    )
    return seen.rows <= max_rows and (seen.bytes or 0) <= max_bytes
