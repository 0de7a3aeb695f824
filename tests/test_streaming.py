"""Streaming tables and flows: late rows are dropped and logged, a replayed batch is not
written twice, full refresh vs reset.allowed=false, parameters fail by name."""

import pytest
from pyspark.sql import functions as F

from strata.functions.params import MissingParameter, Params
from strata.plans import eventlog as L
from strata.plans.common import ingest_lines, line_files, setup
from strata.plans.finance import LINE_SCHEMA, write_arrivals
from strata.sources.files import read_files_stream
from strata.streaming.event_time import windowed_aggregate


def test_missing_parameter_raises_by_name():
    p = Params({"a": "1"})
    assert p.substitute("x > ${a}") == "x > 1"
    with pytest.raises(MissingParameter, match="test_pipeline.orders.start_date"):
        p.substitute("order_date > '${test_pipeline.orders.start_date}'")


def test_late_rows_are_dropped_and_logged(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    path = f"{ws.root}/files/events"
    dropped = []
    for cond in (F.col("ts") >= F.lit("2024-01-15"), F.col("ts") < F.lit("2024-01-15")):
        write_arrivals(t.events, path, [cond], format="parquet")
        with ws.update():
            src = read_files_stream(spark, path, t.events.schema, "parquet")
            agg = windowed_aggregate(src, "ts", "1 day", {"n": F.count(F.lit(1))}, delay="1 hour")
            res = ws.aggregate_table("by_day", agg, "append")
            dropped.append(res.dropped_by_watermark)
    assert dropped[1] > 0
    starts = [r[0] for r in ws.read("by_day").select("window_start").collect()]
    assert all(s.day >= 15 for s in starts)
    m = L.flow_progress(ws.log.read()).where("table_name = 'by_day'").count()
    assert m == 2


def test_replayed_batch_is_skipped(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    path = line_files(ws, t)
    with ws.update():
        ingest_lines(ws, path)
    i = ws.catalog["b_orders"]
    writer = ws._flow_writer(i, "b_orders", [], {})
    before = ws.read("b_orders").count()
    batch0 = spark.read.schema(LINE_SCHEMA).option("header", True).csv(path)
    writer(batch0, 0)  # the committed batch 0 again: skipped
    assert ws.read("b_orders").count() == before


def test_full_refresh_resets_but_no_reset_table_keeps_rows(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    lines = t.lineitem.select(*LINE_SCHEMA.fieldNames())
    path = f"{ws.root}/files/lines"
    write_arrivals(lines, path, [F.col("l_orderkey") % 2 == 0], header=True)
    for full in (False, True):
        with ws.update(full_refresh=full):
            for name, props in (("keep", {"pipelines.reset.allowed": "false"}), ("reset", {})):
                ws.streaming_table(name, properties=props)
                ws.append_flow(name, name, read_files_stream(spark, path, LINE_SCHEMA, "csv", header=True))
    n = lines.where(F.col("l_orderkey") % 2 == 0).count()
    assert ws.read("keep").count() == n
    assert ws.read("reset").count() == n
    assert ws.catalog["keep"].generation == 0 and ws.catalog["reset"].generation == 1


def test_validate_reports_missing_column_without_jobs(spark):
    import __spark_entry__ as E
    from conftest import SMALL
    from strata.plans.q_eventlog import contracts
    from strata.plans.validate import validate
    E.queries()
    rows = {(r.dataset, r.check): r.status for r in validate(spark, *contracts(spark, SMALL)).collect()}
    assert rows[("validate_customer_names_by_failing", "expectation:valid_customer_id")] == "FAILED"
    assert rows[("s_orders", "definition")] == "OK"


def test_bus_source_without_connector_fails_clearly(spark):
    from strata.sources.files import read_bus_stream
    with pytest.raises(Exception, match="(?i)kafka"):
        read_bus_stream(spark, "localhost:9092", ["orders_emea", "orders_apac"])


def test_schema_is_inferred_over_all_files_and_widened(spark):
    from conftest import SMALL
    from strata.sources.files import SchemaStore, write_files
    t, ws = setup(spark, SMALL)
    path = f"{ws.root}/files/customers"
    write_files(t.customer, path, "json")
    store = SchemaStore(spark, f"{ws.root}/schemas/c")
    first = store.resolve(path, "json")
    assert set(first.fieldNames()) == set(t.customer.columns)
    later = t.customer.limit(1).withColumn("extra", F.lit(1)).withColumn("c_custkey", F.lit("x1"))
    write_files(later, path, "json", mode="append")
    assert store.resolve(path, "json") == first  # kept, no new scan
    grown = store.resolve(path, "json", allow_new_columns=True)
    assert set(grown.fieldNames()) == set(t.customer.columns) | {"extra"}
    assert grown["c_custkey"].dataType.simpleString() == "string"
    assert SchemaStore(spark, f"{ws.root}/schemas/d").resolve(path, "json")["c_custkey"].dataType.simpleString() == "string"


def test_every_batch_is_logged_and_counted_once(spark):
    """More batches than a query object keeps reports of, and layouts that read rows twice."""
    from conftest import SMALL
    from strata.operators.quality import expect
    t, ws = setup(spark, SMALL)
    lines = t.lineitem.select(*LINE_SCHEMA.fieldNames())
    path = f"{ws.root}/files/lines"
    write_arrivals(lines, path, [F.col("l_orderkey") % 5 == k for k in range(5)], header=True)
    n, bad = lines.count(), lines.where("l_quantity >= 30").count()
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with ws.update():
            for name, props, keys in (("plain", {}, ()), ("clustered", {}, ("l_partkey", "l_shipdate")),
                                      ("zordered", {"pipelines.autoOptimize.zOrderCols": "l_partkey, l_suppkey"}, ())):
                ws.streaming_table(name, properties=props, cluster_by=keys)
                src = read_files_stream(spark, path, LINE_SCHEMA, "csv", header=True, max_files_per_trigger=1)
                res = ws.append_flow(name, name, src, expectations=[expect("small", "l_quantity < 30")])
                assert res.batches >= 5 and res.input_rows == n
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    logged = {r.table_name: r.num_output_rows for r in L.table_metrics(ws.log.read()).collect()}
    assert logged == {k: n for k in ("plain", "clustered", "zordered")}
    rules = {r.dataset: r.failed_records for r in L.expectation_metrics(ws.log.read()).collect()}
    assert rules == {k: bad for k in ("plain", "clustered", "zordered")}


def test_failed_full_refresh_keeps_the_old_rows(spark):
    from conftest import SMALL
    from strata.operators.quality import expect_or_fail
    t, ws = setup(spark, SMALL)
    path = line_files(ws, t)
    with ws.update():
        ws.materialized_view("items", t.part)
        ingest_lines(ws, path)
    n, m = ws.read("items").count(), ws.read("b_orders").count()
    src = read_files_stream(spark, path, LINE_SCHEMA, "csv", header=True)
    for name in ("items", "b_orders"):
        with pytest.raises(Exception):
            with ws.update(full_refresh=True):
                if name == "items":
                    ws.materialized_view("items", t.part, expectations=[expect_or_fail("no", "p_size < 0")])
                else:
                    ws.streaming_table("b_orders")
                    ws.append_flow("b_orders", "b_orders", src, expectations=[expect_or_fail("no", "l_quantity < 0")])
        assert (ws.read("items").count(), ws.read("b_orders").count()) == (n, m)


def test_compacted_stream_is_not_read_again(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    path = f"{ws.root}/files/lines"
    lines = t.lineitem.select(*LINE_SCHEMA.fieldNames())
    for k in range(3):
        write_arrivals(lines, path, [F.col("l_orderkey") % 3 == k], header=True)
        with ws.update():
            ingest_lines(ws, path)
            res = ws.streaming_table_as("copy", ws.read_stream("b_orders"))
        if k == 1:
            assert ws.compact("b_orders").count() == lines.where("l_orderkey % 3 < 2").count()
    assert res.input_rows == lines.where("l_orderkey % 3 = 2").count()
    for name in ("b_orders", "copy"):
        assert ws.read(name).exceptAll(lines).count() == 0 and ws.read(name).count() == lines.count()
    again = ws.__class__(spark, root=ws.root)
    assert again.read("b_orders").count() == lines.count()


def test_flows_of_a_continuous_update_run_together(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    path = line_files(ws, t)
    with ws.update(continuous=True):
        ws.streaming_table_as("a", read_files_stream(spark, path, LINE_SCHEMA, "csv", header=True))
        ws.streaming_table_as("b", ws.read_stream("a").where("l_quantity > 10"))
        assert len([q for q in spark.streams.active if q.name.startswith(("a.", "b."))]) == 2
    assert not [q for q in spark.streams.active if q.name.startswith(("a.", "b."))]
    assert ws.read("a").count() == t.lineitem.count()
    assert ws.read("b").count() == t.lineitem.where("l_quantity > 10").count()
    assert L.flow_progress(ws.log.read()).count() == 2


def test_equal_rows_are_not_taken_for_replays(spark):
    """A table that keeps its rows gets every row of later generations that it lacks, by number,
    also rows the source had before the table read it."""
    from strata.plans.workspace import Workspace
    ws = Workspace(spark)
    path, schema = f"{ws.root}/files/in", "k int, v string"
    put = lambda *rows: spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)

    def run(full, read=True):
        with ws.update(full_refresh=full):
            ws.streaming_table_as("b", read_files_stream(spark, path, schema, "parquet"))
            if read:
                ws.streaming_table("c", properties={"pipelines.reset.allowed": "false"})
                ws.append_flow("c", "c", ws.read_stream("b", into="c"))
        return sorted(map(str, ws.read("c").collect())) if read else None

    have = [(1, "a"), (1, "a"), (2, None), (None, None)]
    key = lambda rows: sorted(map(str, spark.createDataFrame(rows, schema).collect()))
    put(*have)
    assert run(False) == key(have)
    put((1, "a"), (3, "c"))
    run(False, read=False)  # the table does not see these yet
    put((1, "a"), (None, None))
    have += [(1, "a"), (3, "c"), (1, "a"), (None, None)]
    assert run(True) == key(have)
    put((3, "c"), (2, None))
    have += [(3, "c"), (2, None)]
    assert run(False) == key(have)
    assert run(True) == key(have)
    put((2, None))
    assert run(False) == key([*have, (2, None)])


def test_relay_replays_as_a_multiset_and_copies_no_rows_beside_it(spark):
    """Equal rows in several files, read a file a batch in the second generation: each passes
    as often as it is new. The replays to come are those of the relay; they are not written
    beside it before a batch has taken some."""
    from strata.fs import children
    _, ws = setup(spark, "/unused")
    path, schema = f"{ws.root}/files/r", "a long, b string"
    rows = [[(1, "x"), (1, "x"), (2, None), (None, None)], [(1, "x"), (3, "y"), (None, None)], [(2, None), (1, "x")]]
    for full, parts in ((False, rows[:1]), (True, rows[1:])):
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        with ws.update(full_refresh=full):
            src = read_files_stream(spark, path, spark.createDataFrame([], schema).schema, "parquet", max_files_per_trigger=1)
            ws.streaming_table_as("b", src)
            ws.streaming_table("keep", properties={"pipelines.reset.allowed": "false"})
            ws.append_flow("keep", "keep", ws.read_stream("b", into="keep", maxFilesPerTrigger=1))
    assert sorted(map(str, ws.read("keep").collect())) == sorted(map(str, spark.createDataFrame(sum(rows, []), schema).collect()))
    due = [n for g in children(spark, f"{ws.root}/relays/keep/_b-due") for n in children(spark, f"{ws.root}/relays/keep/_b-due/{g}")]
    assert "before=1" in due and "before=0" not in due


def test_an_aggregate_with_state_writes_few_files_a_bucket(spark):
    """Micro-batches with state run without AQE: the first upsert must not write a file of every
    bucket from every task."""
    from strata.plans.workspace import Workspace
    ws = Workspace(spark, buckets=8)
    rows = spark.range(4000).select((F.col("id") % 1000).alias("k"), "id")
    path = f"{ws.root}/files/in"
    for part in range(2):
        rows.where(F.col("id") % 2 == part).write.mode("append").parquet(path)
        with ws.update():
            sums = spark.readStream.schema(rows.schema).parquet(path).groupBy("k").agg(F.sum("id").alias("s"))
            ws.aggregate_table("sums", sums, "update", keys=["k"])
        files = spark.read.parquet(f"{ws.data_path('sums')}/data").inputFiles()
        assert len(files) <= 2 * 8
    assert ws.read("sums").exceptAll(rows.groupBy("k").agg(F.sum("id"))).count() == 0
    assert ws.read("sums").count() == 1000
