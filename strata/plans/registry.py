"""Registry of the checked queries: one per inventory row, each with its SQL oracle.

A query takes ``(spark, sf_dir)`` and returns a DataFrame over the given tables
(or over tables Spark derives from them). Streaming queries run to completion into
a fresh workspace under the shared checkpoint folder and return a batch read of
the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import (q_cdc, q_dq, q_eventlog, q_gen, q_layout, q_relational,  # noqa: F401
                   q_sources, q_streaming)
