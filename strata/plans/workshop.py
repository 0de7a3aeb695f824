"""The whole sales workshop as one update: every dataset of the reference's notebooks
1-4, defined with this library over the given tables.

Inputs: order lines (``lineitem``) arrive as CSV files in three flows (main, a new
business unit, a backlog backfill); items and customers are CSV directories (pipe-
delimited customers); supplier changes are the ``cdc_feed`` fixture.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..operators.quality import expect, expect_or_drop, quarantine
from ..sources.files import read_files, read_files_stream, write_files
from ..streaming.event_time import windowed_aggregate
from .finance import LINE_SCHEMA, enrich_lines, finish_day_summary, sales_by_customer, sales_by_day_aggs, \
    write_arrivals
from .workspace import Workspace

START_DATE = "test_pipeline.orders.start_date"
VALID_NAME = "customer_name IS NOT NULL AND customer_name <> ''"


def stage_files(ws: Workspace, t) -> dict:
    """Source files of the workshop, derived from the given tables."""
    spark, root = ws.spark, f"{ws.root}/files"
    items = fixtures.view(spark, "dq_items", t)
    customers = fixtures.view(spark, "dq_customers", t).withColumn(
        "billing_address", F.concat(F.col("payment_terms"), F.lit("\n"), F.col("id").cast("string"), F.lit(" Main St")))
    feed = fixtures.view(spark, "cdc_feed", t)
    write_files(items, f"{root}/items", "csv", header=True)
    write_files(customers, f"{root}/customers", "csv", header=True, sep="|")
    lines = t.lineitem.select(*LINE_SCHEMA.fieldNames())
    for k, name in enumerate(("orders", "orders_new", "orders_backlog")):
        write_arrivals(lines, f"{root}/{name}", [F.col("l_orderkey") % 3 == k], header=True)
    write_arrivals(feed, f"{root}/suppliers_cdc", [F.lit(True)], format="parquet")
    return {"items": f"{root}/items", "items_schema": items.schema,
            "customers": f"{root}/customers", "customers_schema": customers.schema,
            "orders": f"{root}/orders", "orders_new": f"{root}/orders_new",
            "orders_backlog": f"{root}/orders_backlog",
            "suppliers_cdc": f"{root}/suppliers_cdc", "suppliers_cdc_schema": feed.schema}


def run(ws: Workspace, t, files: dict, full_refresh: bool = False) -> None:
    spark = ws.spark
    with ws.update(full_refresh=full_refresh):
        # notebook 1: ingestion
        items = read_files(spark, files["items"], "csv", schema=files["items_schema"], header=True)
        ws.materialized_view("b_items", items, comment="Items as delivered (csv)")
        customers = read_files(spark, files["customers"], "csv", schema=files["customers_schema"], header=True,
                               sep="|", multi_line=True)
        ws.materialized_view("b_customers", customers, comment="Customers as delivered, | between fields")

        def lines(key):
            return read_files_stream(spark, files[key], LINE_SCHEMA, "csv", header=True, mode="PERMISSIVE")
        ws.streaming_table_as("b_orders", lines("orders"), comment="Orders as delivered; only new files are read")
        # notebook 3: more flows into b_orders
        ws.append_flow("b_orders", "b_orders_new_bu", lines("orders_new"))
        ws.append_flow("b_orders", "b_orders_history", lines("orders_backlog"), once=True)

        # notebook 1: join and aggregate
        b_customers, b_items = ws.read("b_customers"), ws.read("b_items")
        cust = b_customers.select(F.col("id").alias("c_custkey"), F.col("customer_name").alias("c_name"))
        part = b_items.select(F.col("id").alias("p_partkey"), F.col("description").alias("p_name"),
                              F.col("unit_price").cast("double").alias("p_retailprice"))
        ws.streaming_table_as("s_orders", enrich_lines(ws.read_stream("b_orders"), t.orders, cust, part,
                                                       observe="lookup_s_orders"),
                              comment="Order lines joined to their customer and item")
        # no watermark: every customer stays in state; update mode writes only the
        # customers a micro-batch changed, upserted into the bucketed summary
        ws.aggregate_table("g_sales_summary_by_customer", sales_by_customer(ws.read_stream("s_orders")), "update",
                           keys=["customer_id", "customer_name"])
        by_day = windowed_aggregate(ws.read_stream("s_orders"), "order_date", "1 day", sales_by_day_aggs(),
                                    delay="1 hour")
        ws.aggregate_table("g_sales_summary_by_day", finish_day_summary(by_day), "append")

        # notebook 2: expectations
        ws.materialized_view("s_items", ws.read("b_items"),
                             expectations=[expect("valid_unit_price", "unit_price IS NOT NULL AND unit_price > 0")])
        ws.materialized_view("validated_customer_names_by_warning", b_customers,
                             expectations=[expect("valid_customer_name", VALID_NAME)])
        ws.materialized_view("validated_customer_names_by_dropping", b_customers,
                             expectations=[expect_or_drop("valid_customer_name", VALID_NAME)])
        ws.materialized_view("quarantined_customer_names",
                             quarantine(b_customers, [expect("valid_customer_name", VALID_NAME)]))
        orders = ws.read("b_orders")
        ws.materialized_view("quarantined_order_pks",
                             orders.groupBy(F.col("l_orderkey").alias("id"), "l_linenumber")
                             .agg(F.count("l_orderkey").alias("num_orders")),
                             expectations=[expect("valid_pk_order_id", "num_orders <> 1")])
        fk = b_items.select(F.col("id").alias("fk_item_id"))
        ws.materialized_view("quarantined_order_fks",
                             orders.join(fk, orders["l_partkey"] == fk["fk_item_id"], "left"),
                             expectations=[expect("valid_fk_item_id", "fk_item_id IS NOT NULL")])

        # notebook 3: change data capture
        cdc_src = read_files_stream(spark, files["suppliers_cdc"], files["suppliers_cdc_schema"], "parquet")
        ws.streaming_table_as("b_suppliers_cdc", cdc_src, comment="Change data for suppliers")
        ws.apply_changes("s_suppliers", ws.read_stream("b_suppliers_cdc"), keys=["id"], sequence_by="update_date",
                         delete_when="update_type = 'DELETE'", tie_break=["event_id"], scd_type=2)
        ws.apply_changes("g_recent_customer_orders", ws.read_stream("s_orders"), keys=["customer_id"],
                         sequence_by="order_date", tie_break=["order_id", "line", "item_id", "qty_ordered"])

        # notebook 4: layout, properties, parameters
        ws.materialized_view("c_orders_liquid_clustered", ws.read("s_orders"),
                             cluster_by=("order_date", "customer_id", "item_id"))
        for name, props, part_by in (
                ("c_orders_fixed_indices", {"delta.dataSkippingStatsColumns": "order_date, customer_id"}, ()),
                ("c_orders_partitioned_zordered", {"pipelines.autoOptimize.zOrderCols": "item_id, order_date"},
                 ("customer_id",)),
                ("c_orders_30s_trigger", {"pipelines.trigger.interval": "30 seconds"}, ())):
            ws.streaming_table(name, properties=props, partition_by=part_by)
            ws.append_flow(name, name, ws.read_stream("s_orders"))
        start = ws.params.timestamp(START_DATE)
        ws.streaming_table_as("c_orders_parameterized",
                              ws.read_stream("s_orders").where(F.col("order_date") > start))

