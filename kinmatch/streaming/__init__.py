"""Runs the pipeline over arriving declarations, one micro-batch a run.

The pipeline itself has no streaming operator; a stream of declarations is
cut into batches by Structured Streaming and each batch is one run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def run_on_arrival(declarations: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Starts a query that hands every batch of new declarations to ``handle`` and ends when none are left.

    A batch may be handed over again after a failure: ``handle`` should derive
    its run id from the batch id, which makes a repeat replace the first try.
    """
    return declarations.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
