"""Test-data generators as Spark jobs keyed on the given tables (Q1-Q8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import generators as G
from ..functions.text import email_from_name
from ..sources.files import read_files, write_files
from .common import setup
from .registry import query

TERMS = ["DUE_ON_RECEIPT", "NET_30", "NET_60", "NET_90", "NET_120"]


def _list(values) -> str:
    return "list_value(" + ", ".join(f"'{v}'" for v in values) + ")"


def _epoch_sql(salt: int, lo: str, hi: str, id_col: str) -> str:
    a, b = G._epoch(lo), G._epoch(hi)
    return f"make_timestamp(CAST({a} + ({G.mix_sql(salt, id_col)}) % {b - a + 1} AS BIGINT) * 1000000)"


@query("gen_ids", "SELECT c_custkey AS id FROM customer")
def gen_ids(spark, sf_dir):
    """Q1: ``DataGenerator(rows=n).withIdOutput()``: one row per id of a given table."""
    t, _ = setup(spark, sf_dir)
    return G.DataGenerator(t.customer, "c_custkey").build()


@query("gen_choice", f"SELECT c_custkey AS id, {_list(TERMS)}[1 + ({G.mix_sql(1, 'c_custkey')}) % 5] AS payment_terms "
       "FROM customer")
def gen_choice(spark, sf_dir):
    """Q2: a value picked from a list per row."""
    t, _ = setup(spark, sf_dir)
    return G.DataGenerator(t.customer, "c_custkey").with_column("payment_terms", G.choice(TERMS, 1)).build()


@query("gen_numeric", f"""
SELECT p_partkey AS id, CAST(1 + (({G.mix_sql(2, 'p_partkey')}) % 49901) * 0.01 AS DECIMAL(10,2)) AS unit_price,
  CAST(1 + ({G.mix_sql(3, 'p_partkey')}) % 100 AS INTEGER) AS qty_ordered FROM part""")
def gen_numeric(spark, sf_dir):
    """Q3: numeric ranges with a step (decimal) and integer ranges."""
    t, _ = setup(spark, sf_dir)
    return (G.DataGenerator(t.part, "p_partkey")
            .with_column("unit_price", G.numeric_range(1, 500, 0.01, 2))
            .with_column("qty_ordered", G.integer_range(1, 100, 3)).build())


@query("gen_timestamp", f"""
SELECT o_orderkey AS id, {_epoch_sql(4, '2020-01-01 00:00:00', '2024-01-01 00:00:00', 'o_orderkey')} AS order_date
FROM orders""")
def gen_timestamp(spark, sf_dir):
    """Q4: a timestamp in a range."""
    t, _ = setup(spark, sf_dir)
    return (G.DataGenerator(t.orders, "o_orderkey")
            .with_column("order_date", G.timestamp_range("2020-01-01 00:00:00", "2024-01-01 00:00:00", 4)).build())


@query("gen_nulls", f"""
SELECT c_custkey AS id, CASE WHEN ({G.mix_sql(21, 'c_custkey')}) % 10000 < 100 THEN NULL
  ELSE {G.company_name_sql('c_custkey')} END AS customer_name FROM customer""")
def gen_nulls(spark, sf_dir):
    """Q5: ``percentNulls=0.01``."""
    t, _ = setup(spark, sf_dir)
    return (G.DataGenerator(t.customer, "c_custkey")
            .with_column("customer_name", G.with_nulls(G.company_name(), 0.01, 21)).build())


@query("udf_iterator_text", f"SELECT c_custkey AS id, {G.company_name_sql('c_custkey')} AS customer_name FROM customer")
def udf_iterator_text(spark, sf_dir):
    """Q7: a Python text function with one set-up per task, fed Arrow batches
    (``pandas_udf`` over an iterator of Series)."""
    t, _ = setup(spark, sf_dir)
    return G.DataGenerator(t.customer, "c_custkey").with_column("customer_name", G.company_name_udf()).build()


def _orders_generator(base, id_col):
    return (G.DataGenerator(base, id_col)
            .with_column("order_date", G.timestamp_range("2020-01-01 00:00:00", "2024-01-01 00:00:00", 4))
            .with_column("customer_id", G.integer_range(1, 100, 5))
            .with_column("item_id", G.integer_range(1, 1000, 6))
            .with_column("qty_ordered", G.integer_range(1, 100, 7))
            .with_column("business_unit", G.choice(["retail", "wholesale"], 8)))


BACKLOG_ID = "l_orderkey * 10 + l_linenumber"


@query("gen_backlog", f"""
SELECT {BACKLOG_ID} AS id, {_epoch_sql(9, '2000-01-01 00:00:00', '2020-01-01 00:00:00', f'({BACKLOG_ID})')} AS order_date,
  CAST(1 + ({G.mix_sql(5, f'({BACKLOG_ID})')}) % 100 AS INTEGER) AS customer_id,
  CAST(1 + ({G.mix_sql(6, f'({BACKLOG_ID})')}) % 1000 AS INTEGER) AS item_id,
  CAST(1 + ({G.mix_sql(7, f'({BACKLOG_ID})')}) % 100 AS INTEGER) AS qty_ordered,
  list_value('retail', 'wholesale')[1 + ({G.mix_sql(8, f'({BACKLOG_ID})')}) % 2] AS business_unit
FROM lineitem""")
def gen_backlog(spark, sf_dir):
    """Q8: a generator derived from another (other rows, one column replaced); the
    original is left as it was."""
    t, _ = setup(spark, sf_dir)
    orders = _orders_generator(t.orders, "o_orderkey")
    lines = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"))
    backlog = (orders.with_rows(lines, "line_id")
               .with_column("order_date", G.timestamp_range("2000-01-01 00:00:00", "2020-01-01 00:00:00", 9)))
    if orders.columns[0][1] is backlog.columns[0][1]:
        raise AssertionError("deriving the backlog changed the orders generator")
    return backlog.build()


CUSTOMERS = f"""
WITH g AS (SELECT c_custkey AS id, CASE WHEN ({G.mix_sql(21, 'c_custkey')}) % 10000 < 100 THEN NULL
    ELSE {G.company_name_sql('c_custkey')} END AS customer_name FROM customer)
SELECT id, customer_name, {G.address_sql(30)} AS billing_address, {G.address_sql(40)} AS mailing_address,
  {G.phone_sql(50)} AS phone_number,
  CASE WHEN ({G.mix_sql(22, 'id')}) % 10000 < 1000 THEN NULL ELSE
    array_to_string(list_transform(string_split(regexp_replace(customer_name, '[^0-9A-Za-z]', ' ', 'g'), ' '),
      lambda x: upper(x[1:1]) || lower(x[2:])), '') || '@example.com' END AS email,
  {_list(TERMS)}[1 + ({G.mix_sql(1, 'id')}) % 5] AS payment_terms,
  CASE WHEN ({G.mix_sql(23, 'id')}) % 10000 < 100 THEN NULL
    ELSE CAST(1000 + ({G.mix_sql(24, 'id')}) % 99001 AS DECIMAL(10,2)) END AS balance_limit
FROM g"""


@query("gen_customers", CUSTOMERS)
def gen_customers(spark, sf_dir):
    """Q1-Q7 together: the customers generator (name, email from the name, addresses, phone, terms, limit)."""
    t, _ = setup(spark, sf_dir)
    return _customers(t)


def _customers(t):
    return (G.DataGenerator(t.customer, "c_custkey")
            .with_column("customer_name", G.with_nulls(G.company_name(), 0.01, 21))
            .with_column("email", G.with_nulls(email_from_name("customer_name"), 0.1, 22))
            .with_column("billing_address", G.address(30))
            .with_column("mailing_address", G.address(40))
            .with_column("phone_number", G.phone(50))
            .with_column("payment_terms", G.choice(TERMS, 1))
            .with_column("balance_limit", G.with_nulls(G.numeric_range(1000, 100000, 1, 24), 0.01, 23))
            .build())


@query("s_orders_wide", f"""
WITH b_customers AS ({CUSTOMERS})
SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_custkey AS customer_id, customer_name, billing_address,
  mailing_address, phone_number, email, payment_terms, o_orderpriority AS description, p_partkey AS item_id,
  p_name AS item_description, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, CAST(l_quantity AS INTEGER) AS qty_ordered,
  CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(21,2)) AS total_price
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN b_customers c ON c.id = o_custkey JOIN part ON p_partkey = l_partkey""")
def s_orders_wide(spark, sf_dir):
    """C2/D3 with every column of the joined sales table: generated customers written as
    ``|`` delimited CSV (their addresses hold line breaks), read back, and joined."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/customers"
    made = _customers(t)
    write_files(made, path, "csv", header=True, sep="|")
    c = read_files(spark, path, "csv", schema=made.schema, header=True, sep="|", multi_line=True)
    unit, qty = F.col("p_retailprice").cast("decimal(10,2)"), F.col("l_quantity").cast("int")
    j = (t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(c, F.col("id") == F.col("o_custkey"))
         .join(t.part, F.col("p_partkey") == F.col("l_partkey")))
    return j.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"), F.col("o_custkey").alias("customer_id"),
        "customer_name", "billing_address", "mailing_address", "phone_number", "email", "payment_terms",
        F.col("o_orderpriority").alias("description"), F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_description"),
        unit.alias("unit_price"), qty.alias("qty_ordered"), (qty * unit).cast("decimal(21,2)").alias("total_price"))
