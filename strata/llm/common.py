"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fs import delete
from ..session import new_scratch

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


_OF_THREAD = threading.local()  # scopes: lists of paths, the innermost last


def _scopes() -> list[list[str]]:
    return _OF_THREAD.__dict__.setdefault("scopes", [])


@contextmanager
def kept_in(paths: list[str]) -> Iterator[None]:
    """Adds to ``paths`` the tables that ``keep`` writes inside; their deletion is left to
    the caller."""
    scopes = _scopes()
    scopes.append(paths)
    try:
        yield
    finally:
        scopes.pop()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``keep`` writes inside are deleted at the end. What comes out must have
    been written elsewhere (or kept outside) by then."""
    paths: list[str] = []
    try:
        with kept_in(paths):
            yield
    finally:
        for path in paths:
            delete(spark, path)


def new_path(spark: SparkSession, tag: str) -> str:
    """A new path in the session's shared folder, deleted when this thread's enclosing
    ``scratch`` ends."""
    path = new_scratch(spark, f"llm-{tag}")
    if scopes := _scopes():
        scopes[-1].append(path)
    return path


def keep(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the session's shared folder and read it back.

    Cuts the lineage: a lost executor costs at most the tasks that read the table, never
    the work that made it, and what was drawn once (row numbers, samples) stays fixed.
    The table stays there until the enclosing ``scratch`` ends; without one, until the
    caller clears the folder (results that are still lazy read it).
    """
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def words(text: Column) -> Column:
    """The words of a text: maximal runs of anything but ASCII white space."""
    return F.filter(F.split(text, SPACE, -1), lambda w: w != F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it
    (also inside lambdas, where the optimizer would paste the whole expression)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    have = {c.lower() for c in df.columns}
    while stem.lower() in have:
        stem += "_"
    return stem
