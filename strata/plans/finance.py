"""The sales pipeline of the reference, re-expressed on the given tables.

Inputs map as: order lines = ``lineitem`` (streamed as CSV files), orders header =
``orders``, customers = ``customer``, items = ``part``. Each step is a plain function
returning a DataFrame plan, so batch and streaming forms share the same code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import lookup
from ..sources.files import write_files

LINE_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


def write_arrivals(df: DataFrame, path: str, parts: list, format: str = "csv", **options) -> None:
    """Write ``df`` as files that arrive one part after another (one write per part,
    appended in order, so a file source sees them in this order)."""
    for cond in parts:
        write_files(df.where(cond), path, format=format, mode="append", **options)


def enrich_lines(lines: DataFrame, orders: DataFrame, customers: DataFrame, items: DataFrame,
                 observe: str | None = None) -> DataFrame:
    """``s_orders``: order lines with their order date, customer and item (stream-static
    or static-static).

    Inner-join semantics. With ``observe`` the lines that find no order, customer or item
    are counted under that name (``unmatched_*``) before they are left out, so the run
    log shows what the inner join lost."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = customers.select("c_custkey", "c_name")
    p = items.select("p_partkey", "p_name", "p_retailprice")
    how = "left" if observe else "inner"
    if observe:
        o, c, p = (d.withColumn(m, F.lit(True)) for d, m in ((o, "__m_o"), (c, "__m_c"), (p, "__m_p")))
    j = lookup(lines, o, lines["l_orderkey"] == o["o_orderkey"], how)
    j = lookup(j, c, j["o_custkey"] == c["c_custkey"], how)
    j = lookup(j, p, j["l_partkey"] == p["p_partkey"], how)
    if observe:
        j = j.observe(observe, F.count_if(F.col("__m_o").isNull()).alias("unmatched_orders"),
                      # a line without order has no customer to miss
                      F.count_if(F.col("__m_o") & F.col("__m_c").isNull()).alias("unmatched_customers"),
                      F.count_if(F.col("__m_p").isNull()).alias("unmatched_items"))
        j = j.where(F.col("__m_o") & F.col("__m_c") & F.col("__m_p"))
    unit = F.col("p_retailprice").cast("decimal(10,2)")
    qty = F.col("l_quantity").cast("int")
    return j.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("o_orderdate").alias("order_date"), F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"), F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("item_description"), unit.alias("unit_price"),
        qty.alias("qty_ordered"), (qty * unit).cast("decimal(21,2)").alias("total_price"))


def sales_by_customer(s_orders: DataFrame) -> DataFrame:
    """``g_sales_summary_by_customer``. Sums are exact decimals; the average is their
    quotient by the count, as a double."""
    total = F.sum("total_price")
    return (s_orders.groupBy("customer_id", "customer_name")
            .agg(F.count("order_id").alias("total_orders"), total.alias("__sum"),
                 F.count("total_price").alias("__n"),
                 F.min("total_price").alias("min_order_amount"),
                 F.max("total_price").alias("max_order_amount"))
            .select("customer_id", "customer_name", "total_orders",
                    F.col("__sum").cast("decimal(38,2)").alias("total_sales"),
                    (F.col("__sum").cast("double") / F.col("__n")).alias("avg_sales"),
                    "min_order_amount", "max_order_amount"))


def sales_by_day_aggs() -> dict:
    return {"total_orders": F.count("order_id"), "__sum": F.sum("total_price"),
            "__n": F.count("total_price"), "min_order_amount": F.min("total_price"),
            "max_order_amount": F.max("total_price")}


def finish_day_summary(df: DataFrame) -> DataFrame:
    return df.select("window_start", "window_end", "total_orders",
                     F.col("__sum").cast("decimal(38,2)").alias("total_sales"),
                     (F.col("__sum").cast("double") / F.col("__n")).alias("avg_sales"),
                     "min_order_amount", "max_order_amount")
