"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures
from ..session import load_tables, prepare
from ..sources.files import read_files_stream
from .finance import LINE_SCHEMA, enrich_lines, write_arrivals
from .workspace import Workspace

# Arrival split of the order lines: two runs' worth of files.
def halves(key: str = "l_orderkey"):
    return [F.col(key) % 2 == 0, F.col(key) % 2 == 1]


def setup(spark: SparkSession, sf_dir: str, params: dict | None = None):
    prepare(spark)
    return load_tables(spark, sf_dir), Workspace(spark, params=params)


def view(spark: SparkSession, t, name: str) -> DataFrame:
    return fixtures.view(spark, name, t)


def line_files(ws: Workspace, t, parts=None, name: str = "lineitem") -> str:
    """Order lines written as CSV files under the workspace, in arrival order."""
    path = f"{ws.root}/files/{name}"
    write_arrivals(t.lineitem.select(*LINE_SCHEMA.fieldNames()), path, parts or halves(), header=True)
    return path


def ingest_lines(ws: Workspace, path: str, table: str = "b_orders", **opts):
    """``b_orders``: streaming table over the CSV files (only new files each run)."""
    src = read_files_stream(ws.spark, path, LINE_SCHEMA, format="csv", header=True, mode="PERMISSIVE", **opts)
    return ws.streaming_table_as(table, src, comment="Raw order lines from csv files; processed incrementally")


def build_s_orders(ws: Workspace, t, source: str = "b_orders", table: str = "s_orders"):
    """``s_orders``: stream of new lines joined to the static orders, customers and items;
    lines left out by the inner join are counted in the run log."""
    s = enrich_lines(ws.read_stream(source), t.orders, t.customer, t.part, observe=f"lookup_{table}")
    return ws.streaming_table_as(table, s, comment="Sales order lines with customer and item information")


def s_orders_pipeline(spark: SparkSession, sf_dir: str, params: dict | None = None):
    """Files → b_orders → s_orders, in one triggered update. Returns (tables, workspace)."""
    t, ws = setup(spark, sf_dir, params)
    path = line_files(ws, t)
    with ws.update():
        ingest_lines(ws, path)
        build_s_orders(ws, t)
    return t, ws
