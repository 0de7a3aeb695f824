"""The whole workshop in one update, then a second update: every dataset is filled,
flows and backfill behave, summaries agree with the joined rows."""

from pyspark.sql import functions as F

from strata.plans import workshop
from strata.plans.common import setup


def test_workshop_end_to_end(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL, params={workshop.START_DATE: "1997-06-30"})
    files = workshop.stage_files(ws, t)
    workshop.run(ws, t, files)
    n_lines = t.lineitem.count()
    assert ws.read("b_orders").count() == n_lines
    s = ws.read("s_orders")
    assert s.count() == n_lines
    g = ws.read("g_sales_summary_by_customer")
    assert g.agg(F.sum("total_orders")).first()[0] == n_lines
    assert ws.read("g_recent_customer_orders").count() == g.count()
    assert ws.read("quarantined_customer_names").count() + ws.read("validated_customer_names_by_dropping").count() \
        == ws.read("b_customers").count()
    assert ws.read("c_orders_parameterized").count() == s.where("order_date > TIMESTAMP'1997-06-30'").count()
    for name in ("c_orders_liquid_clustered", "c_orders_fixed_indices", "c_orders_partitioned_zordered",
                 "c_orders_30s_trigger"):
        assert ws.read(name).count() == n_lines
    assert ws.read("s_suppliers").count() > 0
    # a second update takes nothing new and does not rerun the backfill
    workshop.run(ws, t, files)
    assert ws.read("b_orders").count() == n_lines
    assert ws.read("g_sales_summary_by_customer").agg(F.sum("total_orders")).first()[0] == n_lines


def test_inner_join_losses_are_logged(spark):
    from conftest import SMALL
    from strata.plans import eventlog as L
    from strata.plans.common import ingest_lines, line_files
    from strata.plans.finance import enrich_lines
    t, ws = setup(spark, SMALL)
    path = line_files(ws, t)
    few_items = t.part.where("p_partkey % 2 = 0")  # half the items are missing
    with ws.update():
        ingest_lines(ws, path)
        ws.streaming_table_as("s_orders", enrich_lines(ws.read_stream("b_orders"), t.orders, t.customer,
                                                       few_items, observe="lookup_s_orders"))
    m = L.flow_progress(ws.log.read()).where("table_name = 's_orders'")
    lost = ws.log.read().where("event_type = 'flow_progress' AND table_name = 's_orders'") \
        .select(L.detail("flow_progress:metrics:unmatched_items").cast("long").alias("n")).first()["n"]
    assert lost == t.lineitem.where("l_partkey % 2 = 1").count()
    assert m.first()["num_output_rows"] == t.lineitem.count() - lost
