"""Fixture views over the given tables, shared by the Spark side and the SQL oracles.

Each template names its inputs as ``{table}`` slots. In Spark the slots are filled
with DataFrames (``spark.sql(text, table=df)``); for the oracle they are filled with
view names and the template becomes a CTE. The views inject the faults the test
data lacks (null and negative prices, empty names, orphan keys, repeated ids) by
a rule over the key, over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# name -> (template, inputs it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "dq_items": ("""
SELECT p_partkey AS id, p_name AS description,
  CAST(CASE WHEN p_partkey % 101 = 0 THEN NULL WHEN p_partkey % 103 = 0 THEN -p_retailprice
       ELSE p_retailprice END AS DECIMAL(10,2)) AS unit_price
FROM {part}""", ("part",)),
    "dq_customers": ("""
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN '' ELSE c_name END AS customer_name,
  c_mktsegment AS payment_terms
FROM {customer}""", ("customer",)),
    "dq_orders": ("""
SELECT o_orderkey AS id, o_orderdate AS order_date,
  CASE WHEN o_orderkey % 53 = 0 THEN -1 ELSE o_custkey END AS customer_id
FROM {orders}
UNION ALL
SELECT o_orderkey, o_orderdate, o_custkey FROM {orders} WHERE o_orderkey % 211 = 0""", ("orders",)),
    "s_orders": ("""
SELECT l_orderkey AS order_id, l_linenumber AS line, o_orderdate AS order_date, c_custkey AS customer_id,
  c_name AS customer_name, p_partkey AS item_id, p_name AS item_description,
  CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, CAST(l_quantity AS INT) AS qty_ordered,
  CAST(CAST(l_quantity AS INT) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(21,2)) AS total_price
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
JOIN {customer} ON c_custkey = o_custkey JOIN {part} ON p_partkey = l_partkey""",
                 ("lineitem", "orders", "customer", "part")),
    "cdc_feed": ("""
SELECT user_id AS id, ts AS update_date, event_id, value,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS update_type
FROM {events}""", ("events",)),
}


def view(spark: SparkSession, name: str, tables) -> DataFrame:
    """The fixture view ``name`` as a Spark DataFrame over ``tables`` (a namespace of frames)."""
    text, inputs = VIEWS[name]
    return spark.sql(text, **{t: getattr(tables, t) for t in inputs})


def cte(*names: str) -> str:
    """``WITH`` clause defining the named fixture views for the DuckDB oracle."""
    parts = []
    for n in names:
        text, inputs = VIEWS[n]
        parts.append(f"{n} AS ({text.format(**{t: t for t in inputs})}\n)")
    return "WITH " + ",\n".join(parts) + "\n"
