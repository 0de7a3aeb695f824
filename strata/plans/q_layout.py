"""Table layout: clustering, re-clustering, partitioning, Z-order, statistics columns,
compaction (M1-M6). Layout never changes the rows; the skipping it buys is tested
on file footers in ``tests/``."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import ingest_lines, line_files, setup
from .finance import enrich_lines
from .q_streaming import S_ORDERS_ORACLE
from .registry import query

CLUSTER_KEYS = ("order_date", "customer_id", "item_id")


def _sales_stream(ws, t):
    return enrich_lines(ws.read_stream("b_orders"), t.orders, t.customer, t.part)


@query("layout_clustered", S_ORDERS_ORACLE)
def layout_clustered(spark, sf_dir):
    """M1: ``CLUSTER BY (order_date, customer_id, item_id)``: range-partitioned on the
    keys and sorted in each file."""
    t, ws = setup(spark, sf_dir)
    return ws.materialized_view("c_orders_liquid_clustered", enrich_lines(t.lineitem, t.orders, t.customer, t.part),
                                comment="Sales orders clustered by order_date, customer_id and item_id",
                                cluster_by=CLUSTER_KEYS)


@query("layout_recluster", S_ORDERS_ORACLE)
def layout_recluster(spark, sf_dir):
    """M2: cluster keys changed between updates: new batches use the new keys, nothing
    already written is recomputed."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/lineitem"
    from .finance import LINE_SCHEMA, write_arrivals  # noqa: PLC0415
    lines = t.lineitem.select(*LINE_SCHEMA.fieldNames())
    for k, keys in enumerate([("order_date",), ("customer_id", "item_id")]):
        write_arrivals(lines, path, [F.col("l_orderkey") % 2 == k], header=True)
        with ws.update():
            ingest_lines(ws, path)
            ws.streaming_table("c_orders_clustered", cluster_by=keys)
            ws.append_flow("c_orders_clustered", "c_orders_clustered", _sales_stream(ws, t))
    return ws.read("c_orders_clustered")


@query("layout_incremental", S_ORDERS_ORACLE)
def layout_incremental(spark, sf_dir):
    """M2: after a change of the cluster keys only the files that overlap the most on the new
    ones are rewritten, and after a further batch only what that made overlap."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/lineitem"
    from .finance import LINE_SCHEMA, write_arrivals  # noqa: PLC0415
    lines = t.lineitem.select(*LINE_SCHEMA.fieldNames())
    for k, keys in enumerate([("order_date",), ("customer_id", "item_id"), ("customer_id", "item_id")]):
        write_arrivals(lines, path, [F.col("l_orderkey") % 3 == k], header=True)
        with ws.update():
            ingest_lines(ws, path)
            ws.streaming_table("c_orders_clustered", cluster_by=keys)
            ws.append_flow("c_orders_clustered", "c_orders_clustered", _sales_stream(ws, t))
        if k:
            ws.cluster("c_orders_clustered", depth=1, rows_per_file=100_000)
    return ws.read("c_orders_clustered")


@query("layout_partitioned", S_ORDERS_ORACLE)
def layout_partitioned(spark, sf_dir):
    """M3: ``PARTITIONED BY (customer_id)``."""
    t, ws = setup(spark, sf_dir)
    path = line_files(ws, t)
    with ws.update():
        ingest_lines(ws, path)
        ws.streaming_table("c_orders_partitioned", partition_by=["customer_id"])
        ws.append_flow("c_orders_partitioned", "c_orders_partitioned", _sales_stream(ws, t))
    return ws.read("c_orders_partitioned")


@query("layout_zordered", S_ORDERS_ORACLE)
def layout_zordered(spark, sf_dir):
    """M4: ``PARTITIONED BY (customer_id)`` with ``zOrderCols = "item_id, order_date"``:
    rows of a partition ordered by the Morton code of the two columns' rank buckets."""
    t, ws = setup(spark, sf_dir)
    path = line_files(ws, t)
    with ws.update():
        ingest_lines(ws, path)
        ws.streaming_table("c_orders_partitioned_zordered", partition_by=["customer_id"],
                           properties={"pipelines.autoOptimize.zOrderCols": "item_id, order_date"})
        ws.append_flow("c_orders_partitioned_zordered", "c_orders_partitioned_zordered", _sales_stream(ws, t))
    return ws.read("c_orders_partitioned_zordered")


@query("layout_stats_columns", S_ORDERS_ORACLE)
def layout_stats_columns(spark, sf_dir):
    """M5: ``delta.dataSkippingStatsColumns = "order_date, customer_id"``: footer min/max
    only for those columns."""
    t, ws = setup(spark, sf_dir)
    path = line_files(ws, t)
    with ws.update():
        ingest_lines(ws, path)
        ws.streaming_table("c_orders_fixed_indices",
                           properties={"delta.dataSkippingStatsColumns": "order_date, customer_id"})
        ws.append_flow("c_orders_fixed_indices", "c_orders_fixed_indices", _sales_stream(ws, t))
    return ws.read("c_orders_fixed_indices")


@query("layout_compact", S_ORDERS_ORACLE)
def layout_compact(spark, sf_dir):
    """M6: optimised write / compaction: a table written in many small pieces is
    rewritten into evenly sized, clustered files."""
    t, ws = setup(spark, sf_dir)
    s = enrich_lines(t.lineitem, t.orders, t.customer, t.part).repartition(64)
    ws.materialized_view("c_orders_compacted", s, cluster_by=("customer_id",))
    return ws.compact("c_orders_compacted")
