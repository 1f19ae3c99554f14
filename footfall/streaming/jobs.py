"""How a streaming job runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Run ``write`` on each micro-batch; ``every`` is a trigger interval such as ``10 seconds``.

    Without an interval the query takes what is available and ends.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )
