"""Live view of a stream (a notebook ``display`` re-aimed): a second,
independent query on the same plan with its own progress.

Only the first ``num_rows`` rows of a micro-batch ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StreamingQuery


def live_view(df: DataFrame, name: str, num_rows: int = 20, checkpoint: str | None = None,
              trigger: dict | None = None,
              on_preview: Callable[[int, list[Row]], None] | None = None) -> StreamingQuery:
    """Show up to ``num_rows`` rows of each micro-batch: printed, or handed with
    the batch id to ``on_preview``."""
    def preview(batch: DataFrame, batch_id: int) -> None:
        if on_preview is None:
            batch.show(num_rows, truncate=True)
        else:
            on_preview(batch_id, batch.take(num_rows))

    w = df.writeStream.outputMode("append").queryName(name).foreachBatch(preview)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def memory_view_for_tests(df: DataFrame, name: str, trigger: dict | None = None) -> StreamingQuery:
    """Every row in a driver-side table: for small streams in tests only."""
    w = df.writeStream.outputMode("append").queryName(name).format("memory")
    return w.trigger(**trigger).start() if trigger else w.start()
