"""Event time: watermarks and windowed aggregates on streams.

Watermarks need TIMESTAMP; the tables carry TIMESTAMP_NTZ. Times are cast in
(session zone UTC) before ``withWatermark`` and cast back in the result, so values
round-trip unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_event_time(df: DataFrame, col: str) -> DataFrame:
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        df = df.withColumn(col, F.col(col).cast("timestamp"))
    return df


def watermarked(df: DataFrame, col: str, delay: str) -> DataFrame:
    """``WATERMARK col DELAY OF INTERVAL delay``."""
    return to_event_time(df, col).withWatermark(col, delay)


def deduplicated(df: DataFrame, keys, time_col: str, delay: str) -> DataFrame:
    """The first row of each key of a stream, where repeats come within ``delay`` of event time.
    State is kept for that long only: what repeats later, the watermark drops if it is as old
    as the first, and else it is a row of its own. Times come back as they were."""
    kind = df.schema[time_col].dataType
    out = watermarked(df, time_col, delay).dropDuplicatesWithinWatermark([keys] if isinstance(keys, str) else list(keys))
    return out.withColumn(time_col, F.col(time_col).cast(kind))


def window_columns(window: Column | str = "window") -> list[Column]:
    """Flatten a ``window`` struct into NTZ ``window_start`` / ``window_end``."""
    w = F.col(window) if isinstance(window, str) else window
    return [w["start"].cast("timestamp_ntz").alias("window_start"),
            w["end"].cast("timestamp_ntz").alias("window_end")]


def summary_columns(value: str, count_col: str) -> dict[str, Column]:
    """The summary of the sales tables: count, sum, average, min and max of ``value``."""
    return {"total_orders": F.count(F.col(count_col)), "total_sales": F.sum(value),
            "avg_sales": F.avg(value), "min_order_amount": F.min(value),
            "max_order_amount": F.max(value)}


def windowed_aggregate(df: DataFrame, time_col: str, size: str, aggs: dict[str, Column],
                       delay: str | None = None, keys=()) -> DataFrame:
    """Tumbling-window aggregate (batch or stream), window flattened to NTZ start/end.

    With ``delay`` the stream is watermarked, so the state of closed windows is
    dropped and append mode can emit them."""
    df = watermarked(df, time_col, delay) if delay else to_event_time(df, time_col)
    keys = list(keys)
    return (df.groupBy(F.window(time_col, size).alias("window"), *keys)
            .agg(*[c.alias(n) for n, c in aggs.items()])
            .select(*window_columns(), *keys, *aggs.keys()))
