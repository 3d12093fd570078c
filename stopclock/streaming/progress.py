"""What a streaming query tells of itself."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark and fell out of the query's states, over the
    progress reports it still has (the last hundred, unless
    ``spark.sql.streaming.numRecentProgressUpdates`` says otherwise).

    Aggregations count rows that were added up beforehand, so one may stand for several.
    """
    return sum(
        int(state.numRowsDroppedByWatermark)
        for progress in query.recentProgress
        for state in progress.stateOperators
    )
