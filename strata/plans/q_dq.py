"""Expectations: warn, drop, fail, quarantine, metrics, key checks (K1-K8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import cte
from ..operators.joins import lookup
from ..operators.quality import (expect, expect_or_drop, expect_or_fail, duplicate_keys, quarantine)
from ..plans.eventlog import expectation_metrics
from ..sources.files import read_files_stream
from .common import setup, view
from .finance import write_arrivals
from .registry import query

VALID_PRICE = "unit_price IS NOT NULL AND unit_price > 0"
VALID_NAME = "customer_name IS NOT NULL AND customer_name <> ''"
INVALID_NAME = "customer_name IS NULL OR customer_name = ''"


@query("dq_warn", cte("dq_items") + "SELECT * FROM dq_items")
def dq_warn(spark, sf_dir):
    """K1: ``CONSTRAINT valid_unit_price EXPECT (...)``: all rows kept, violations counted."""
    t, ws = setup(spark, sf_dir)
    return ws.materialized_view("s_items", view(spark, t, "dq_items"),
                                comment="Inventory items checked by business rules",
                                expectations=[expect("valid_unit_price", VALID_PRICE)])


@query("dq_drop", cte("dq_customers") + f"SELECT * FROM dq_customers WHERE coalesce({VALID_NAME}, false)")
def dq_drop(spark, sf_dir):
    """K2: ``ON VIOLATION DROP ROW``."""
    t, ws = setup(spark, sf_dir)
    return ws.materialized_view("validated_customer_names_by_dropping", view(spark, t, "dq_customers"),
                                expectations=[expect_or_drop("valid_customer_name", VALID_NAME)])


@query("dq_quarantine", cte("dq_customers")
       + f"SELECT * FROM dq_customers WHERE NOT coalesce({VALID_NAME}, false)")
def dq_quarantine(spark, sf_dir):
    """K4: the quarantine table: the same input, rows failing the rule (a NULL verdict
    fails), so drop and quarantine partition the input."""
    t, ws = setup(spark, sf_dir)
    customers = view(spark, t, "dq_customers")
    return ws.materialized_view("quarantined_customer_names",
                                quarantine(customers, [expect("valid_customer_name", VALID_NAME)]),
                                comment="Customers which failed business rules")


@query("dq_fail", cte("dq_customers") + "SELECT * FROM dq_customers")
def dq_fail(spark, sf_dir):
    """K3 (passing case): ``ON VIOLATION FAIL UPDATE`` on a rule the data meets; the
    failing case is a test (the update stops, the old version stays)."""
    t, ws = setup(spark, sf_dir)
    return ws.materialized_view("validate_customer_ids_by_failing", view(spark, t, "dq_customers"),
                                expectations=[expect_or_fail("valid_customer_id", "id IS NOT NULL")])


METRICS_ORACLE = cte("dq_items", "dq_customers") + f"""
SELECT 's_items' AS dataset, 'valid_unit_price' AS expectation,
  CAST(count_if(coalesce({VALID_PRICE}, false)) AS BIGINT) AS passed_records,
  CAST(count_if(NOT coalesce({VALID_PRICE}, false)) AS BIGINT) AS failed_records FROM dq_items
UNION ALL
SELECT 'validated_customer_names_by_dropping', 'valid_customer_name',
  CAST(count_if(coalesce({VALID_NAME}, false)) AS BIGINT),
  CAST(count_if(NOT coalesce({VALID_NAME}, false)) AS BIGINT) FROM dq_customers"""


@query("dq_metrics", METRICS_ORACLE)
def dq_metrics(spark, sf_dir):
    """K5: passed / failed rows per dataset and expectation, read back from the run log."""
    t, ws = setup(spark, sf_dir)
    with ws.update():
        ws.materialized_view("s_items", view(spark, t, "dq_items"),
                             expectations=[expect("valid_unit_price", VALID_PRICE)])
        ws.materialized_view("validated_customer_names_by_dropping", view(spark, t, "dq_customers"),
                             expectations=[expect_or_drop("valid_customer_name", VALID_NAME)])
    return expectation_metrics(ws.log.read())


@query("dq_multi", cte("dq_items") + """
SELECT * FROM dq_items WHERE coalesce(unit_price > 0, false) AND coalesce(id > 0, false)""")
def dq_multi(spark, sf_dir):
    """K6: several constraints on one dataset, counted in one pass, drops combined."""
    t, ws = setup(spark, sf_dir)
    rules = [expect("valid_unit_price", VALID_PRICE),
             expect_or_drop("positive_price", "unit_price > 0"),
             expect_or_drop("valid_id", "id > 0")]
    return ws.materialized_view("s_items_checked", view(spark, t, "dq_items"), expectations=rules)


@query("dq_pk_duplicates", cte("dq_orders")
       + "SELECT id, count(id) AS num_orders FROM dq_orders GROUP BY id HAVING count(id) <> 1")
def dq_pk_duplicates(spark, sf_dir):
    """K7: primary-key check, keys that occur more than once (or are NULL)."""
    t, ws = setup(spark, sf_dir)
    return ws.materialized_view("quarantined_order_pks",
                                duplicate_keys(view(spark, t, "dq_orders"), "id", "num_orders"),
                                comment="Quarantined primary keys for orders")


@query("dq_pk_incremental", cte("dq_orders")
       + "SELECT id, count(id) AS num_orders FROM dq_orders GROUP BY id HAVING count(id) <> 1")
def dq_pk_incremental(spark, sf_dir):
    """K7 as orders arrive: three runs, each reads its own rows and the registry of keys. Repeats
    come within a run and runs apart."""
    t, ws = setup(spark, sf_dir)
    path, orders = f"{ws.root}/files/orders", view(spark, t, "dq_orders")
    part = F.pmod(F.xxhash64("id", "customer_id"), F.lit(3))
    for k in range(3):
        write_arrivals(orders, path, [part == k], format="parquet")
        with ws.update():
            ws.key_check("quarantined_order_pks", read_files_stream(spark, path, orders.schema, "parquet"), "id", "num_orders")
    return ws.read("quarantined_order_pks")


@query("dq_fk_orphans", cte("dq_orders") + """
SELECT o.*, c.c_custkey AS fk_customer_id FROM dq_orders o LEFT JOIN customer c ON c.c_custkey = o.customer_id
WHERE c.c_custkey IS NULL""")
def dq_fk_orphans(spark, sf_dir):
    """K8: foreign-key check by left join plus a rule; the quarantine keeps the orphans."""
    t, ws = setup(spark, sf_dir)
    o = view(spark, t, "dq_orders")
    c = t.customer.select(F.col("c_custkey").alias("fk_customer_id"))
    joined = lookup(o, c, o["customer_id"] == c["fk_customer_id"], "left")
    return ws.materialized_view("quarantined_order_fks",
                                quarantine(joined, [expect("valid_fk_customer_id", "fk_customer_id IS NOT NULL")]))
