"""Event-time windows, the same for batch frames and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pump_hourly(
    df: DataFrame,
    key: str,
    ts: str,
    avg_column: str,
    max_column: str,
    window: str = "1 hour",
    delay: str = "10 minutes",
    avg_name: str = "avg_sensor_01_val",
    max_name: str = "max_sensor_02_val",
) -> DataFrame:
    """Mean of one reading and maximum of another per key and tumbling window.

    On a stream, rows behind the watermark (`delay` after the newest event time of earlier
    batches) are dropped; in batch the watermark has no effect. A watermark needs a
    timestamp with time zone, so a zoneless column is read in the session's zone on streams.
    """
    if df.isStreaming:
        if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
            df = df.withColumn(ts, F.col(ts).cast("timestamp"))
        df = df.withWatermark(ts, delay)
    grouped = df.groupBy(F.col(key), F.window(ts, window)).agg(
        F.avg(avg_column).alias(avg_name), F.max(max_column).alias(max_name)
    )
    return grouped.select(
        F.col(key),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        avg_name,
        max_name,
    )
