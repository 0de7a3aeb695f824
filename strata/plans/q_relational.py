"""Projections, filters, joins, aggregates, top-1 per key, set operations and scalar
functions (C, D2-D5, E1-E10, F, I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import cte
from ..functions import text
from ..operators.joins import lookup, orphans
from ..operators.sequence import latest_per_key
from ..streaming.event_time import windowed_aggregate
from .common import setup, view
from .finance import enrich_lines, finish_day_summary, sales_by_customer, sales_by_day_aggs
from .q_streaming import BY_CUSTOMER_ORACLE, S_ORDERS_ORACLE
from .registry import query


# -- C: projections and filters ------------------------------------------------------------
@query("project_rename", """
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS item_id, l_suppkey AS supplier_id,
  CAST(l_quantity AS INTEGER) AS qty_ordered, l_extendedprice AS extended_price, l_shipdate AS ship_date
FROM lineitem""")
def project_rename(spark, sf_dir):
    """Projection with renames."""
    t, _ = setup(spark, sf_dir)
    return t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
                             F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("supplier_id"),
                             F.col("l_quantity").cast("int").alias("qty_ordered"),
                             F.col("l_extendedprice").alias("extended_price"),
                             F.col("l_shipdate").alias("ship_date"))


@query("project_arith", """
SELECT p_partkey AS id, CAST(CAST(p_size AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(21,2))
  AS total_price FROM part""")
def project_arith(spark, sf_dir):
    """C4: integer times decimal(10,2) (exact, decimal(21,2))."""
    t, _ = setup(spark, sf_dir)
    return t.part.select(F.col("p_partkey").alias("id"),
                         (F.col("p_size").cast("int") * F.col("p_retailprice").cast("decimal(10,2)"))
                         .cast("decimal(21,2)").alias("total_price"))


@query("filter_not_null_positive", cte("dq_items")
       + "SELECT * FROM dq_items WHERE unit_price IS NOT NULL AND unit_price > 0")
def filter_not_null_positive(spark, sf_dir):
    """``x IS NOT NULL AND x > 0``."""
    t, _ = setup(spark, sf_dir)
    d = view(spark, t, "dq_items")
    return d.where(F.col("unit_price").isNotNull() & (F.col("unit_price") > 0))


@query("filter_nonempty", cte("dq_customers")
       + "SELECT * FROM dq_customers WHERE customer_name IS NOT NULL AND customer_name <> ''")
def filter_nonempty(spark, sf_dir):
    """``s IS NOT NULL AND s <> ''``."""
    t, _ = setup(spark, sf_dir)
    return view(spark, t, "dq_customers").where("customer_name IS NOT NULL AND customer_name <> ''")


@query("filter_null_or_empty", cte("dq_customers")
       + "SELECT * FROM dq_customers WHERE customer_name IS NULL OR customer_name = ''")
def filter_null_or_empty(spark, sf_dir):
    """``s IS NULL OR s = ''``."""
    t, _ = setup(spark, sf_dir)
    return view(spark, t, "dq_customers").where("customer_name IS NULL OR customer_name = ''")


@query("filter_literal_eq", cte("cdc_feed") + "SELECT * FROM cdc_feed WHERE update_type = 'DELETE'")
def filter_literal_eq(spark, sf_dir):
    """Equality with a double-quoted string literal (a string, not an identifier)."""
    t, _ = setup(spark, sf_dir)
    return spark.sql('SELECT * FROM {feed} WHERE update_type = "DELETE"', feed=view(spark, t, "cdc_feed"))


@query("having_ne", cte("dq_orders")
       + "SELECT id, count(id) AS num_orders FROM dq_orders GROUP BY id HAVING count(id) <> 1")
def having_ne(spark, sf_dir):
    """Inequality on an aggregate (HAVING)."""
    t, _ = setup(spark, sf_dir)
    return (view(spark, t, "dq_orders").groupBy("id").agg(F.count("id").alias("num_orders"))
            .where(F.col("num_orders") != 1))


@query("filter_date_gt", "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'")
def filter_date_gt(spark, sf_dir):
    """Timestamp against a string literal (implicit cast; pushed to the scan)."""
    t, _ = setup(spark, sf_dir)
    return t.orders.where(F.col("o_orderdate") > F.lit("1998-01-01"))


START_DATE = "test_pipeline.orders.start_date"


@query("filter_parameterized", "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-30 00:00:00'")
def filter_parameterized(spark, sf_dir):
    """C11: orders after a date given as a pipeline parameter, bound as a typed value (unset
    names raise by name)."""
    t, ws = setup(spark, sf_dir, params={START_DATE: "1997-06-30"})
    return ws.params.sql(spark, "SELECT * FROM {orders} WHERE o_orderdate > ${" + START_DATE + "}", orders=t.orders)


# -- D: joins ---------------------------------------------------------------------------
@query("join_left_outer", cte("dq_orders") + """
SELECT o.*, c.c_custkey AS fk_customer_id FROM dq_orders o LEFT JOIN customer c ON c.c_custkey = o.customer_id""")
def join_left_outer(spark, sf_dir):
    """``ord.* , itm.id AS fk`` with a LEFT JOIN (the literal foreign-key table)."""
    t, _ = setup(spark, sf_dir)
    o = view(spark, t, "dq_orders")
    c = t.customer.select(F.col("c_custkey").alias("fk_customer_id"))
    return lookup(o, c, o["customer_id"] == c["fk_customer_id"], "left")


@query("join_static_static", S_ORDERS_ORACLE)
def join_static_static(spark, sf_dir):
    """D3: the same enrichment as s_orders between static tables."""
    t, _ = setup(spark, sf_dir)
    return enrich_lines(t.lineitem, t.orders, t.customer, t.part)


@query("join_anti_fk", cte("dq_orders") + """
SELECT o.* FROM dq_orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.customer_id)""")
def join_anti_fk(spark, sf_dir):
    """Rows without a parent (anti join)."""
    t, _ = setup(spark, sf_dir)
    return orphans(view(spark, t, "dq_orders"), t.customer, "customer_id", "c_custkey")


# -- E: aggregates ------------------------------------------------------------------------
@query("agg_by_customer", BY_CUSTOMER_ORACLE)
def agg_by_customer(spark, sf_dir):
    """Group by two keys with count, sum, avg, min, max."""
    t, _ = setup(spark, sf_dir)
    return sales_by_customer(enrich_lines(t.lineitem, t.orders, t.customer, t.part))


DAY_ORACLE = cte("s_orders") + """
SELECT date_trunc('day', order_date) AS window_start, date_trunc('day', order_date) + INTERVAL 1 DAY AS window_end,
  count(order_id) AS total_orders, CAST(sum(total_price) AS DECIMAL(38,2)) AS total_sales,
  CAST(sum(total_price) AS DOUBLE) / count(total_price) AS avg_sales,
  min(total_price) AS min_order_amount, max(total_price) AS max_order_amount
FROM s_orders GROUP BY 1, 2"""


@query("agg_window_day_batch", DAY_ORACLE)
def agg_window_day_batch(spark, sf_dir):
    """Tumbling one-day windows (batch), window flattened to start/end."""
    t, _ = setup(spark, sf_dir)
    s = enrich_lines(t.lineitem, t.orders, t.customer, t.part)
    return finish_day_summary(windowed_aggregate(s, "order_date", "1 day", sales_by_day_aggs()))


@query("agg_window_hour_batch", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
  count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2, 3""")
def agg_window_hour_batch(spark, sf_dir):
    """Hourly roll-up per event type."""
    t, _ = setup(spark, sf_dir)
    aggs = {"events": F.count(F.lit(1)),
            "total_value": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")}
    return windowed_aggregate(t.events, "ts", "1 hour", aggs, keys=["event_type"])


@query("agg_pk_counts", cte("dq_orders") + "SELECT id, count(id) AS num_orders FROM dq_orders GROUP BY id")
def agg_pk_counts(spark, sf_dir):
    """Occurrences per key (the literal primary-key table, every key)."""
    t, _ = setup(spark, sf_dir)
    return view(spark, t, "dq_orders").groupBy("id").agg(F.count("id").alias("num_orders"))


# -- F: top-1 per key, clustering, union ------------------------------------------------------
@query("topk_latest_per_key", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
WHERE r = 1""")
def topk_latest_per_key(spark, sf_dir):
    """the most recent order of each customer (``max_by`` aggregate, skew-safe)."""
    t, _ = setup(spark, sf_dir)
    return latest_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("cluster_by_query", "SELECT * FROM orders")
def cluster_by_query(spark, sf_dir):
    """query-level ``CLUSTER BY``: distribute by the keys and sort within partitions."""
    t, _ = setup(spark, sf_dir)
    return spark.sql("SELECT * FROM {o} CLUSTER BY o_custkey, o_orderdate", o=t.orders)


@query("union_by_name", "SELECT * FROM orders")
def union_by_name(spark, sf_dir):
    """union of sources by column name."""
    t, _ = setup(spark, sf_dir)
    a = t.orders.where(F.col("o_orderkey") % 3 == 0)
    b = t.orders.where(F.col("o_orderkey") % 3 == 1)
    b = b.select(*reversed(b.columns))
    c = t.orders.where(F.col("o_orderkey") % 3 == 2)
    c = c.select(*c.columns[3:], *c.columns[:3])
    return a.unionByName(b).unionByName(c)


# -- I: scalar functions ----------------------------------------------------------------------
EMAIL_ORACLE = cte("dq_customers") + """
SELECT id, customer_name,
  array_to_string(list_transform(string_split(regexp_replace(customer_name, '[^0-9A-Za-z]', ' ', 'g'), ' '),
    lambda x: upper(x[1:1]) || lower(x[2:])), '') || '@example.com' AS email
FROM dq_customers"""


@query("fn_email_from_name", EMAIL_ORACLE)
def fn_email_from_name(spark, sf_dir):
    """An e-mail address derived from the customer's name."""
    t, _ = setup(spark, sf_dir)
    d = view(spark, t, "dq_customers")
    return d.select("id", "customer_name", text.email_from_name("customer_name").alias("email"))


@query("fn_json_path", """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int
FROM events""")
def fn_json_path(spark, sf_dir):
    """Semi-structured path ``props:k`` on a JSON string (as text, and typed via variant)."""
    t, _ = setup(spark, sf_dir)
    return t.events.select("event_id", text.json_path("props", "k").alias("k"),
                           text.json_path_typed("props", "k", "int").alias("k_int"))


@query("fn_typed_casts", """
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
  TRY_CAST(o_orderstatus AS INTEGER) AS status_as_int, CAST(o_totalprice AS DECIMAL(12,2)) AS total,
  CAST(CAST(year(o_orderdate) AS VARCHAR) || '-06-30 12:00:00' AS TIMESTAMP) AS mid_year
FROM orders""")
def fn_typed_casts(spark, sf_dir):
    """I8: declared casts (decimal, integer, timestamp); dirty text casts to NULL."""
    t, _ = setup(spark, sf_dir)
    o = t.orders
    return o.select("o_orderkey",
                    F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
                    F.col("o_orderstatus").try_cast("int").alias("status_as_int"),
                    F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
                    F.concat(F.year("o_orderdate").cast("string"), F.lit("-06-30 12:00:00"))
                    .cast("timestamp_ntz").alias("mid_year"))
