"""Incremental summaries from a stream of samples.

Batch rebuilds by dependency digest are in operators.index; this keeps a tile index up to date from
files of samples as they arrive, with late samples dropped behind a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_index(samples: DataFrame, time: str = "ts", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Per event-time window and tile of a stream (ts, face, level, morton, code): n, min_code, max_code."""
    by = [F.window(time, window).alias("window"), "face", "level", "morton"]
    return samples.withWatermark(time, late).groupBy(*by).agg(F.count("code").alias("n"), F.min("code").alias("min_code"), F.max("code").alias("max_code"))


def drain(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that has arrived to Parquet, each window once it is closed, and stop."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
