"""Run-log queries (W1-W5) and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import cte
from ..operators.quality import expect, expect_or_drop, expect_or_fail
from ..plans import eventlog as L
from .common import ingest_lines, line_files, setup, view
from .finance import enrich_lines, sales_by_customer
from .q_dq import INVALID_NAME, VALID_NAME, VALID_PRICE
from .registry import query
from .validate import Definition, rule_counts


def _logged(spark, sf_dir):
    """A small pipeline with two updates, the second failing on a FAIL rule."""
    t, ws = setup(spark, sf_dir)
    path = line_files(ws, t)
    with ws.update():
        ingest_lines(ws, path)
        ws.streaming_table_as("s_orders", enrich_lines(ws.read_stream("b_orders"), t.orders, t.customer, t.part,
                                                       observe="lookup_s_orders"))
        ws.materialized_view("s_items", view(spark, t, "dq_items"),
                             expectations=[expect("valid_unit_price", VALID_PRICE)])
        ws.materialized_view("g_sales_summary_by_customer", sales_by_customer(ws.read("s_orders")))
    try:
        with ws.update():
            ws.materialized_view("validate_customer_names_by_failing", view(spark, t, "dq_customers"),
                                 expectations=[expect_or_fail("valid_customer_name", VALID_NAME)])
    except Exception:  # noqa: BLE001 - the failed update is part of the log
        pass
    return t, ws


# The event queries of the log, over the given ``events`` as a log: the type as recorded,
# level ERROR for errors, and the value in a JSON details column.
AS_LOG = """SELECT event_id, ts AS timestamp, event_type, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  user_id, value FROM events"""


def _given_log(t):
    details = F.to_json(F.struct(F.struct(F.col("event_type").alias("action"), F.col("user_id").cast("string").alias("user_name"))
                                 .alias("user_action")))
    return t.events.select("event_id", F.col("ts").alias("timestamp"), "event_type", details.alias("details"),
                           F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"))


@query("eventlog_user_actions", f"""
SELECT timestamp, event_type AS action, CAST(user_id AS VARCHAR) AS user_name FROM ({AS_LOG})
WHERE event_type IN ('signup', 'purchase')""")
def eventlog_user_actions(spark, sf_dir):
    """Events of chosen types, with JSON path extraction from their details
    (``details:user_action:action``, ``details:user_action:user_name``)."""
    t, _ = setup(spark, sf_dir)
    log = _given_log(t).where(F.col("event_type").isin("signup", "purchase"))
    return log.select("timestamp", L.detail("user_action:action").alias("action"), L.detail("user_action:user_name").alias("user_name"))


@query("eventlog_table_metrics", cte("s_orders") + """
SELECT 'b_orders' AS table_name, CAST(count(*) AS BIGINT) AS num_output_rows, CAST(1 AS BIGINT) AS flow_runs
FROM lineitem
UNION ALL SELECT 's_orders', CAST(count(*) AS BIGINT), CAST(1 AS BIGINT) FROM s_orders
UNION ALL SELECT 's_items', CAST(count(*) AS BIGINT), CAST(1 AS BIGINT) FROM part
UNION ALL SELECT 'g_sales_summary_by_customer', CAST(count(DISTINCT customer_id) AS BIGINT), CAST(1 AS BIGINT)
FROM s_orders""")
def eventlog_table_metrics(spark, sf_dir):
    """Rows written and completed flow runs per table, from the log."""
    _, ws = _logged(spark, sf_dir)
    return L.table_metrics(ws.log.read()).select("table_name", "num_output_rows", "flow_runs")


MOST_ERRORS = 0.2


@query("eventlog_breaches", f"""
SELECT date_trunc('day', timestamp) AS day, count(*) AS events, count(*) FILTER (level = 'ERROR') AS errors
FROM ({AS_LOG}) GROUP BY 1 HAVING count(*) FILTER (level = 'ERROR') > {MOST_ERRORS} * count(*)""")
def eventlog_breaches(spark, sf_dir):
    """What an alert fires on: days whose share of error events is over a limit."""
    t, _ = setup(spark, sf_dir)
    errors = F.count_if(F.col("level") == "ERROR")
    return (_given_log(t).groupBy(F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("day"))
            .agg(F.count(F.lit(1)).alias("events"), errors.alias("errors"))
            .where(F.col("errors") > F.lit(MOST_ERRORS) * F.col("events")))


def _rule(dataset: str, name: str, condition: str, source: str) -> str:
    return (f"SELECT '{dataset}' AS dataset, '{name}' AS expectation, count(*) FILTER (WHERE coalesce({condition}, FALSE)) AS passed, "
            f"count(*) FILTER (WHERE NOT coalesce({condition}, FALSE)) AS failed FROM {source}")


VALIDATE_ORACLE = cte("dq_items", "dq_customers") + "\nUNION ALL ".join([
    _rule("s_items", "valid_unit_price", VALID_PRICE, "dq_items"),
    _rule("validated_customer_names_by_dropping", "valid_customer_name", VALID_NAME, "dq_customers"),
    _rule("quarantined_customer_names", "invalid_customer_name", INVALID_NAME, "dq_customers"),
    _rule("quarantined_order_fks", "known_item", "i.id IS NOT NULL", "lineitem l LEFT JOIN dq_items i ON l.l_partkey = i.id"),
    _rule("quarantined_order_fks", "positive_quantity", "l_quantity > 1", "lineitem l LEFT JOIN dq_items i ON l.l_partkey = i.id"),
])


def contracts(spark, sf_dir):
    """The workshop's definitions over fixture views, two of them faulty: a rule on a column
    the input lacks, and a read of a dataset that is not defined."""
    t, _ = setup(spark, sf_dir)
    sources = {"items": view(spark, t, "dq_items"), "customers": view(spark, t, "dq_customers"),
               "lines": t.lineitem, "orders": t.orders, "customer": t.customer, "part": t.part}
    defs = [
        Definition("b_items", lambda r: r.read("items")),
        Definition("b_customers", lambda r: r.read("customers")),
        Definition("b_orders", lambda r: r.read("lines")),
        Definition("s_orders", lambda r: enrich_lines(r.read("b_orders"), r.read("orders"), r.read("customer"),
                                                      r.read("part"))),
        Definition("g_sales_summary_by_customer", lambda r: sales_by_customer(r.read("s_orders"))),
        Definition("s_items", lambda r: r.read("b_items"), [expect("valid_unit_price", VALID_PRICE)]),
        Definition("validated_customer_names_by_dropping", lambda r: r.read("b_customers"),
                   [expect_or_drop("valid_customer_name", VALID_NAME)]),
        Definition("quarantined_customer_names", lambda r: r.read("b_customers"),
                   [expect_or_drop("invalid_customer_name", INVALID_NAME)]),
        Definition("validate_customer_names_by_failing", lambda r: r.read("b_customers"),
                   [expect_or_fail("valid_customer_id", "customer_id IS NOT NULL")]),
        Definition("quarantined_order_fks",
                   lambda r: r.read("b_orders").join(r.read("b_items").select(F.col("id").alias("fk_item_id")),
                                                     F.col("l_partkey") == F.col("fk_item_id"), "left"),
                   [expect("known_item", "fk_item_id IS NOT NULL"), expect("positive_quantity", "l_quantity > 1")]),
        Definition("g_recent_customer_orders", lambda r: r.read("s_orders_latest")),
    ]
    return defs, sources


@query("validate_contracts", VALIDATE_ORACLE)
def validate_contracts(spark, sf_dir):
    """Every rule of the definitions that resolve, held against all rows: how many pass and
    fail, one aggregate a dataset. (What does not resolve, ``validate`` reports without a job.)"""
    return rule_counts(*contracts(spark, sf_dir))
