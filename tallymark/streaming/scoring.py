"""Master rows as a stream: each micro-batch is matched against a fixed pool and appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def match_stream(s1_stream: DataFrame, match: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """match: a batch of master rows to its results. Each batch has a folder of its own, so a repeated batch replaces itself."""

    def put(batch: DataFrame, number: int) -> None:
        match(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return s1_stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
