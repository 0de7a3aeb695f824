"""Streaming tables, stream joins, streaming aggregates and event time (B, D1, D4, E7, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import cte
from ..operators.joins import interval_join
from ..operators.partials import Measure, finish, merge, partial
from ..sources.files import read_files_stream
from ..streaming.event_time import deduplicated, to_event_time, watermarked, windowed_aggregate
from .common import build_s_orders, ingest_lines, s_orders_pipeline, setup, view
from .finance import write_arrivals
from .finance import LINE_SCHEMA, finish_day_summary, sales_by_customer, sales_by_day_aggs
from .registry import query

S_ORDERS_ORACLE = cte("s_orders") + "SELECT * FROM s_orders"

BY_CUSTOMER_ORACLE = cte("s_orders") + """
SELECT customer_id, customer_name, count(order_id) AS total_orders,
  CAST(sum(total_price) AS DECIMAL(38,2)) AS total_sales,
  CAST(sum(total_price) AS DOUBLE) / count(total_price) AS avg_sales,
  min(total_price) AS min_order_amount, max(total_price) AS max_order_amount
FROM s_orders GROUP BY customer_id, customer_name"""


@query("join_stream_static", S_ORDERS_ORACLE)
def join_stream_static(spark, sf_dir):
    """Files → b_orders (stream) → s_orders, joined to static orders, customers, items."""
    _, ws = s_orders_pipeline(spark, sf_dir)
    return ws.read("s_orders")


@query("agg_stream_complete", BY_CUSTOMER_ORACLE)
def agg_stream_complete(spark, sf_dir):
    """Sales by customer as a streaming aggregate with no watermark (complete mode)."""
    _, ws = s_orders_pipeline(spark, sf_dir)
    with ws.update():
        ws.aggregate_table("g_sales_summary_by_customer", sales_by_customer(ws.read_stream("s_orders")),
                           "complete")
    return ws.read("g_sales_summary_by_customer")


RENAMED = """CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 2 = 0 THEN customer_name
  ELSE customer_name || ' (old name)' END"""


@query("agg_stream_update", BY_CUSTOMER_ORACLE.replace(
    "SELECT customer_id, customer_name, count", f"SELECT customer_id, {RENAMED.replace('l_orderkey', 'order_id')} AS customer_name, count").replace(
    "GROUP BY customer_id, customer_name", "GROUP BY 1, 2"))
def agg_stream_update(spark, sf_dir):
    """E7 in update mode, upserted by both group columns: customers that changed their name
    and names that are NULL keep a row of their own. Two runs, so groups are replaced."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/lineitem"
    for k in range(2):
        write_arrivals(t.lineitem.select(*LINE_SCHEMA.fieldNames()), path, [F.col("l_linenumber") % 2 == k], header=True)
        with ws.update():
            ingest_lines(ws, path)
            build_s_orders(ws, t)
            named = ws.read_stream("s_orders").withColumn("customer_name", F.expr(RENAMED.replace("l_orderkey", "order_id")))
            ws.aggregate_table("g_sales_summary_by_customer", sales_by_customer(named), "update",
                               keys=["customer_id", "customer_name"])
    return ws.read("g_sales_summary_by_customer")


# -- J: event time -----------------------------------------------------------------------
DAY_APPEND_ORACLE = cte("s_orders") + """
SELECT * FROM (
  SELECT date_trunc('day', order_date) AS window_start, date_trunc('day', order_date) + INTERVAL 1 DAY AS window_end,
    count(order_id) AS total_orders, CAST(sum(total_price) AS DECIMAL(38,2)) AS total_sales,
    CAST(sum(total_price) AS DOUBLE) / count(total_price) AS avg_sales,
    min(total_price) AS min_order_amount, max(total_price) AS max_order_amount
  FROM s_orders GROUP BY 1, 2)
WHERE window_end <= (SELECT max(order_date) - INTERVAL 1 HOUR FROM s_orders)"""


@query("stream_window_append", DAY_APPEND_ORACLE)
def stream_window_append(spark, sf_dir):
    """``g_sales_summary_by_day``: one-day windows of the order time, which may come an
    hour late; append mode: only windows the watermark has closed are written."""
    _, ws = s_orders_pipeline(spark, sf_dir)
    with ws.update():
        agg = windowed_aggregate(ws.read_stream("s_orders"), "order_date", "1 day", sales_by_day_aggs(),
                                 delay="1 hour")
        ws.aggregate_table("g_sales_summary_by_day", finish_day_summary(agg), "append")
    return ws.read("g_sales_summary_by_day")


EVENTS_BY_DAY = """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
  count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events {where} GROUP BY 1, 2"""

def _events_by_day(df):
    aggs = {"events": F.count(F.lit(1)), "__total": F.sum(F.col("value").cast("decimal(18,2)"))}
    return windowed_aggregate(df, "ts", "1 day", aggs, delay="1 hour") \
        .withColumn("total_value", F.col("__total").cast("double")).drop("__total")


def _event_files(ws, t, parts):
    path = f"{ws.root}/files/events"
    write_arrivals(t.events, path, parts, format="parquet")
    return path


@query("stream_window_update", EVENTS_BY_DAY.format(where=""))
def stream_window_update(spark, sf_dir):
    """The always-current variant: update mode, each micro-batch's changed windows
    upserted by window start (three batches in time order)."""
    t, ws = setup(spark, sf_dir)
    cuts = ["2024-01-11", "2024-01-21"]
    ts = F.col("ts")
    path = _event_files(ws, t, [ts < F.lit(cuts[0]), (ts >= F.lit(cuts[0])) & (ts < F.lit(cuts[1])),
                                ts >= F.lit(cuts[1])])
    src = read_files_stream(spark, path, t.events.schema, "parquet", max_files_per_trigger=1)
    with ws.update():
        ws.aggregate_table("g_events_by_day", _events_by_day(src), "update", keys=["window_start"])
    return ws.read("g_events_by_day")


LATE_ORACLE = f"""
SELECT * FROM ({EVENTS_BY_DAY.format(where="WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")})
WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""


@query("stream_late_data", LATE_ORACLE)
def stream_late_data(spark, sf_dir):
    """Rows older than the watermark are dropped (and counted in the run log): the
    first run brings the second half of the month, the next run the first half."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/events"
    for cond in (F.col("ts") >= F.lit("2024-01-15"), F.col("ts") < F.lit("2024-01-15")):
        write_arrivals(t.events, path, [cond], format="parquet")
        with ws.update():
            src = read_files_stream(spark, path, t.events.schema, "parquet")
            ws.aggregate_table("g_events_by_day", _events_by_day(src), "append")
    return ws.read("g_events_by_day")


@query("stream_dedup", "SELECT * FROM events")
def stream_dedup(spark, sf_dir):
    """L6 on a stream: events sent again, in the same run and in the next one, are dropped by state
    that lasts for the delay (not by a merge with the table)."""
    t, ws = setup(spark, sf_dir)
    path, first = f"{ws.root}/files/events", F.col("ts") < F.lit("2024-01-16")
    again = F.col("event_id") % 5 == 0
    for cond, repeats in ((first, first & again), (~first, again)):
        write_arrivals(t.events, path, [cond, repeats], format="parquet")
        with ws.update():
            src = read_files_stream(spark, path, t.events.schema, "parquet")
            ws.streaming_table_as("b_events", deduplicated(src, "event_id", "ts", "2 days"))
    return ws.read("b_events")


EVENT_MEASURES = [Measure("events", "count"), Measure("total_value", "total", "CAST(value AS DECIMAL(18,2))")]


def _half_month_runs(spark, sf_dir):
    """The second half of the month first, the first half in the next run: late for windows
    that are closed by then."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/events"
    for cond in (F.col("ts") >= F.lit("2024-01-15"), F.col("ts") < F.lit("2024-01-15")):
        write_arrivals(t.events, path, [cond], format="parquet")
        with ws.update():
            src = read_files_stream(spark, path, t.events.schema, "parquet")
            ws.window_table("g_events_by_day", src, "ts", "1 day", "1 HOUR", EVENT_MEASURES)
    return ws


@query("stream_late_rows", "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'")
def stream_late_rows(spark, sf_dir):
    """Rows that come after their window was closed are kept in a side table."""
    return _half_month_runs(spark, sf_dir).read_late("g_events_by_day")


@query("stream_late_repaired", f"""
SELECT * FROM ({EVENTS_BY_DAY.format(where="")}) WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_late_repaired(spark, sf_dir):
    """The windows of the late rows are reopened from the side table: the table then
    equals the aggregate over all rows. A second repair changes nothing."""
    ws = _half_month_runs(spark, sf_dir)
    ws.repair("g_events_by_day")
    ws.repair("g_events_by_day")
    return ws.read("g_events_by_day").withColumn("total_value", F.col("total_value").cast("double"))


@query("agg_day_from_hours", cte("s_orders") + """
SELECT date_trunc('day', order_date) AS window_start, count(order_id) AS total_orders,
  CAST(sum(total_price) AS DECIMAL(38,2)) AS total_sales, CAST(sum(total_price) AS DOUBLE) / count(total_price) AS avg_sales,
  min(total_price) AS min_order_amount, max(total_price) AS max_order_amount
FROM s_orders GROUP BY 1""")
def agg_day_from_hours(spark, sf_dir):
    """The day's summary put together from stored partials of its hours; the order lines
    are read once, for the hours."""
    t, ws = setup(spark, sf_dir)
    price = "total_price"
    measures = [Measure("total_orders", "count", "order_id"), Measure("total_sales", "total", price), Measure("avg_sales", "mean", price),
                Measure("min_order_amount", "least", price), Measure("max_order_amount", "most", price)]
    hours = partial(view(spark, t, "s_orders"), [F.date_trunc("hour", "order_date").alias("hour")], measures)
    ws.materialized_view("g_sales_by_hour", hours)
    day = F.date_trunc("day", "hour").cast("timestamp_ntz").alias("window_start")
    out = finish(merge(ws.read("g_sales_by_hour"), [day], measures), ["window_start"], measures)
    return out.withColumn("total_sales", F.col("total_sales").cast("decimal(38,2)"))


@query("stream_filter", S_ORDERS_ORACLE.replace("SELECT * FROM s_orders",
                                                "SELECT * FROM s_orders WHERE order_date > TIMESTAMP '1997-06-30 00:00:00'"))
def stream_filter(spark, sf_dir):
    """``c_orders_parameterized``: a stateless streaming filter with a pipeline
    parameter."""
    _, ws = s_orders_pipeline(spark, sf_dir, params={"test_pipeline.orders.start_date": "1997-06-30"})
    with ws.update():
        s = ws.read_stream("s_orders")
        start = ws.params.timestamp("test_pipeline.orders.start_date")
        ws.streaming_table_as("c_orders_parameterized", s.where(F.col("order_date") > start))
    return ws.read("c_orders_parameterized")


@query("join_stream_stream_interval", """
SELECT o_orderkey, l_linenumber, o_orderdate, l_shipdate FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 90 DAY""")
def join_stream_stream_interval(spark, sf_dir):
    """Two streams joined on key and a time range, both watermarked so join state is
    bounded."""
    t, ws = setup(spark, sf_dir)
    op, lp = f"{ws.root}/files/orders", f"{ws.root}/files/lines"
    write_arrivals(t.orders, op, [F.lit(True)], format="parquet")
    write_arrivals(t.lineitem, lp, [F.lit(True)], format="parquet")
    o = watermarked(read_files_stream(spark, op, t.orders.schema, "parquet")
                    .select("o_orderkey", "o_orderdate"), "o_orderdate", "1 day")
    li = watermarked(read_files_stream(spark, lp, t.lineitem.schema, "parquet")
                     .select("l_orderkey", "l_linenumber", "l_shipdate"), "l_shipdate", "1 day")
    j = interval_join(o, li, [("o_orderkey", "l_orderkey")], "o_orderdate", "l_shipdate", "0 days", "90 days")
    out = j.select("o_orderkey", "l_linenumber", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
                   F.col("l_shipdate").cast("timestamp_ntz").alias("l_shipdate"))
    with ws.update():
        ws.streaming_table_as("s_order_shipments", out)
    return ws.read("s_order_shipments")
