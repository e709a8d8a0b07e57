"""Type 2 runs fed by a stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from chronotable.sources.state import HistoryStore
from chronotable.sources.workspace import read_text


def stream_into(
    stream: DataFrame, store: HistoryStore, checkpoint: str, name: str, **trigger: object
) -> StreamingQuery:
    """Apply every micro-batch of ``stream`` to ``store``.

    Each version is tagged with the identity that the checkpoint keeps and the batch number, so a batch that
    is replayed after a failure is not applied twice, while a new checkpoint, or another stream of
    the same name, starts with batches of its own. Rows that it reads again are refused as they equal the open ones.
    ``trigger`` is passed on, by default all that is available is read and the query ends.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            identity = json.loads(read_text(batch.sparkSession, f"{checkpoint.rstrip('/')}/metadata"))["id"]
            store.apply(batch, f"{identity}-{number}")

    return (
        stream.writeStream.queryName(name)
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
