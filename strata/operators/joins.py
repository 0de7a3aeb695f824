"""Joins: dimension lookup, orphan detection, interval join.

How a side travels is left to Spark: the optimizer broadcasts a side whose estimated size
is under ``spark.sql.autoBroadcastJoinThreshold``, AQE does so (or splits skewed
partitions) from measured sizes. Building a join runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a fact (batch or stream) to a static dimension."""
    return fact.join(dim, on, how)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent. NULL keys have no parent and are returned."""
    keys = parent.select(F.col(parent_key).alias("__pk"))
    return child.join(keys, F.col(child_key) == F.col("__pk"), "left_anti")


def interval_join(left: DataFrame, right: DataFrame, on, left_time: str, right_time: str,
                  lower: str, upper: str, how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` (names, or ``(left, right)`` name pairs) plus
    ``right_time BETWEEN left_time + lower AND left_time + upper``.

    On two streams with watermarks, the time bounds let the state of both sides be
    dropped once the watermark passes them."""
    pairs = [(k, k) if isinstance(k, str) else k for k in ([on] if isinstance(on, str) else on)]
    cond = [left[a] == right[b] for a, b in pairs]
    cond.append(right[right_time] >= left[left_time] + F.expr(f"INTERVAL {lower}"))
    cond.append(right[right_time] <= left[left_time] + F.expr(f"INTERVAL {upper}"))
    c = cond[0]
    for x in cond[1:]:
        c = c & x
    return left.join(right, c, how)
