"""Names that arrive in batches: each is classified and linked once, the results added to a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def process_stream(names: DataFrame, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Stateless, so no watermark is needed; a batch that is tried again overwrites its own folder."""

    def one(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return names.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
