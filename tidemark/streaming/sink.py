"""The change log as a stream: micro-batches applied to a generation, and counts of outcomes.

The sequence of a record orders its mutations, so no watermark is needed: late mutations are stale, repeated ones
overwrite themselves.  A batch that is replayed after a failure leaves the same documents and has the same acknowledgements:
the store keeps those of each stream's last batch under its number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.engine.generation import Generations


def project_stream(
    mutations: DataFrame, store: Generations, checkpoint: str, acknowledged: Callable[[DataFrame, int], None] | None = None, available_now: bool = True
) -> StreamingQuery:
    """Start a query that applies every micro-batch of ``mutations`` to the store's write alias."""

    def one(batch: DataFrame, number: int) -> None:
        acks = store.apply(batch, token=(checkpoint, number))
        if acknowledged is not None:
            acknowledged(acks, number)

    writer = mutations.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()
