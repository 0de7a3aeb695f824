"""File sources and sinks, materialized views, streaming tables and flows (A, B)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixtures import cte
from ..operators.quality import expect, expect_or_fail
from ..sources.files import (CORRUPT_COLUMN, SchemaStore, read_files, read_files_stream, with_corrupt_column,
                             write_files)
from .common import ingest_lines, line_files, setup
from .finance import LINE_SCHEMA, write_arrivals
from .registry import query

LINES_ORACLE = "SELECT " + ", ".join(LINE_SCHEMA.fieldNames()) + " FROM lineitem"
ORDERS_ORACLE = "SELECT * FROM orders"
def thirds():
    return [F.col("o_orderkey") % 3 == k for k in range(3)]


# -- A: sources --------------------------------------------------------------------------
@query("scan_csv_batch", ORDERS_ORACLE)
def scan_csv_batch(spark, sf_dir):
    """A1: ``read_files(path, format => 'csv', header => true)`` with the declared schema."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/orders"
    write_files(t.orders, path, "csv", header=True)
    return read_files(spark, path, "csv", schema=t.orders.schema, header=True)


@query("scan_csv_pipe", "SELECT * FROM customer")
def scan_csv_pipe(spark, sf_dir):
    """A2: ``sep => '|'``."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/customers"
    write_files(t.customer, path, "csv", header=True, sep="|")
    return read_files(spark, path, "csv", schema=t.customer.schema, header=True, sep="|")


@query("scan_json", LINES_ORACLE)
def scan_json(spark, sf_dir):
    """A3: the same reader on JSON lines."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/lines_json"
    write_files(t.lineitem.select(*LINE_SCHEMA.fieldNames()), path, "json")
    return read_files(spark, path, "json", schema=LINE_SCHEMA)


@query("scan_parquet", "SELECT * FROM events")
def scan_parquet(spark, sf_dir):
    """A3: the same reader on Parquet."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/events_parquet"
    write_files(t.events, path, "parquet")
    return read_files(spark, path, "parquet")


@query("scan_orc", "SELECT * FROM part")
def scan_orc(spark, sf_dir):
    """A3: the same reader on ORC."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/part_orc"
    write_files(t.part, path, "orc")
    return read_files(spark, path, "orc")


@query("scan_csv_stream", ORDERS_ORACLE)
def scan_csv_stream(spark, sf_dir):
    """A4: ``STREAM read_files(...)`` into a streaming table; files arrive in three parts."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/orders"
    write_arrivals(t.orders, path, thirds(), header=True)
    src = read_files_stream(spark, path, t.orders.schema, "csv", header=True, mode="PERMISSIVE")
    ws.streaming_table_as("b_orders", src)
    return ws.read("b_orders")


PERMISSIVE_ORACLE = """
SELECT p_partkey AS id, p_name AS description,
  CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS unit_price,
  CASE WHEN p_partkey % 101 = 0 THEN CAST(p_partkey AS VARCHAR) || ',' || p_name || ',n/a' END AS _corrupt_record
FROM part"""


@query("scan_csv_permissive", PERMISSIVE_ORACLE)
def scan_csv_permissive(spark, sf_dir):
    """A5: ``mode => 'PERMISSIVE'``: a malformed field becomes NULL, the row stays and
    its raw line is kept in ``_corrupt_record``."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/items"
    raw = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("description"),
                        F.when(F.col("p_partkey") % 101 == 0, F.lit("n/a"))
                        .otherwise(F.col("p_retailprice").cast("string")).alias("unit_price"))
    write_files(raw, path, "csv", header=True)
    schema = with_corrupt_column(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("description", T.StringType()),
        T.StructField("unit_price", T.DecimalType(10, 2))]))
    src = read_files_stream(spark, path, schema, "csv", header=True, mode="PERMISSIVE",
                            corrupt_column=CORRUPT_COLUMN)
    ws.streaming_table_as("b_items", src)
    return ws.read("b_items")


RESCUED_ORACLE = """
SELECT p_partkey AS id, CASE WHEN p_partkey % 3 <> 2 THEN p_name END AS description,
  CASE WHEN p_partkey % 3 <> 2 OR p_partkey % 2 = 1 THEN CAST(p_retailprice AS DECIMAL(10,2)) END AS unit_price,
  CASE WHEN p_partkey % 3 = 1 THEN '{"size":"' || p_size || '"}'
       WHEN p_partkey % 3 = 2 AND p_partkey % 2 = 0 THEN '{"unit_price":"n/a"}' END AS _rescued_data
FROM part"""


@query("scan_rescued", RESCUED_ORACLE)
def scan_rescued(spark, sf_dir):
    """Files that differ: as declared; with their columns in another order and one
    more; with one less and prices that are none. Each is bound by its own header, and what
    the schema has no place for is kept. The last comes in a later run."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/items"
    item = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("description"),
                         F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"), F.col("p_size").alias("size"))
    price = F.when(F.col("id") % 2 == 1, F.col("unit_price").cast("string")).otherwise(F.lit("n/a"))
    kinds = [item.drop("size"), item.select("size", "unit_price", "description", "id"), item.select(price.alias("unit_price"), "id")]
    schema = item.drop("size").schema
    for run in ((0, 1), (2,)):
        for k in run:
            write_files(kinds[k].where(F.col("id") % 3 == k), path, "csv", mode="append")
        with ws.update():
            ws.ingest_files("b_items", path, schema)
    return ws.read("b_items")


INFER_ORACLE = """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
  c_acctbal, c_mktsegment FROM customer"""


@query("scan_infer_schema", INFER_ORACLE)
def scan_infer_schema(spark, sf_dir):
    """No declared columns: infer once from the files present, keep the schema beside
    the table, stream with it."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/customers"
    write_files(t.customer, path, "csv", header=True)
    schema = SchemaStore(spark, f"{ws.root}/schemas/b_customers").resolve(path, "csv", header=True)
    src = read_files_stream(spark, path, schema, "csv", header=True)
    ws.streaming_table_as("b_customers", src)
    return ws.read("b_customers")


@query("stream_from_table", LINES_ORACLE)
def stream_from_table(spark, sf_dir):
    """``STREAM(LIVE.t)``: a stream over a table two flows write to."""
    t, ws = setup(spark, sf_dir)
    a = line_files(ws, t, [F.col("l_orderkey") % 2 == 0], "lines_a")
    b = line_files(ws, t, [F.col("l_orderkey") % 2 == 1], "lines_b")
    with ws.update():
        ingest_lines(ws, a)
        ws.append_flow("b_orders", "b_orders_second",
                       read_files_stream(spark, b, LINE_SCHEMA, "csv", header=True))
        ws.streaming_table_as("c_orders_copy", ws.read_stream("b_orders"))
    return ws.read("c_orders_copy")


@query("stream_rate_limited", LINES_ORACLE)
def stream_rate_limited(spark, sf_dir):
    """Bounded micro-batches (one file per trigger) over a large input."""
    t, ws = setup(spark, sf_dir)
    path = line_files(ws, t, [F.col("l_orderkey") % 4 == k for k in range(4)])
    with ws.update():
        res = ingest_lines(ws, path, max_files_per_trigger=1)
    if res.batches < 2:
        raise AssertionError(f"rate limit not applied: {res.batches} batch(es)")
    return ws.read("b_orders")


MULTILINE_ORACLE = """
SELECT c_custkey AS id, c_name AS customer_name,
  c_name || chr(10) || c_mktsegment || ' Street ' || CAST(c_nationkey AS VARCHAR) AS billing_address,
  c_mktsegment AS payment_terms FROM customer"""


@query("scan_csv_multiline", MULTILINE_ORACLE)
def scan_csv_multiline(spark, sf_dir):
    """Quoted fields holding line breaks, read whole with ``multiLine``."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/customers"
    df = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("customer_name"),
                           F.concat(F.col("c_name"), F.lit("\n"), F.col("c_mktsegment"), F.lit(" Street "),
                                    F.col("c_nationkey").cast("string")).alias("billing_address"),
                           F.col("c_mktsegment").alias("payment_terms"))
    write_files(df, path, "csv", header=True, sep="|")
    return read_files(spark, path, "csv", schema=df.schema, header=True, sep="|", multi_line=True)


# -- B: sinks, refresh kinds, flows -------------------------------------------------------
ITEMS_ORACLE = """
SELECT p_partkey AS id, p_name AS description, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price FROM part"""


def _items(t):
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("description"),
                         F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"))


@query("sink_csv_roundtrip", "SELECT * FROM part")
def sink_csv_roundtrip(spark, sf_dir):
    """CSV directory write with header and delimiter, overwrite, read back."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/part_csv"
    write_files(t.part.where(F.col("p_size") < 10), path, "csv", header=True, sep=",")
    write_files(t.part, path, "csv", header=True, sep=",", mode="overwrite")
    return read_files(spark, path, "csv", schema=t.part.schema, header=True)


@query("mv_full_recompute", ITEMS_ORACLE)
def mv_full_recompute(spark, sf_dir):
    """B1: a materialized view is recomputed in full from all files at each refresh."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/items"
    items = _items(t)
    write_files(items.where(F.col("id") % 2 == 0), path, "csv", header=True, mode="append")
    schema = items.schema
    ws.materialized_view("b_items", read_files(spark, path, "csv", schema=schema, header=True),
                         comment="Raw inventory items; fully recomputed at each update")
    write_files(items.where(F.col("id") % 2 == 1), path, "csv", header=True, mode="append")
    return ws.materialized_view("b_items", read_files(spark, path, "csv", schema=schema, header=True))


@query("st_incremental_append", LINES_ORACLE)
def st_incremental_append(spark, sf_dir):
    """B2: a streaming table appends only what is new at each update."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/lines"
    parts = [F.col("l_orderkey") % 3 == k for k in range(3)]
    for p in parts:
        write_arrivals(t.lineitem.select(*LINE_SCHEMA.fieldNames()), path, [p], header=True)
        with ws.update():
            ingest_lines(ws, path)
    return ws.read("b_orders")


def _orders_flows(spark, t, ws, permute: bool = True, drop: str | None = None):
    """Three order sources: main, a new business unit (columns reordered, maybe one
    missing), and a history backfill."""
    paths = []
    for k, cond in enumerate(thirds()):
        df = t.orders.where(cond)
        if k == 1 and permute:
            df = df.select(*reversed(df.columns))
        if k == 1 and drop:
            df = df.drop(drop)
        p = f"{ws.root}/files/orders_{k}"
        write_files(df, p, "csv", header=True)
        paths.append((p, df.schema))
    src = [read_files_stream(spark, p, s, "csv", header=True, mode="PERMISSIVE") for p, s in paths]
    ws.streaming_table_as("b_orders", src[0], comment="Raw orders")
    ws.append_flow("b_orders", "b_orders_new_bu", src[1], comment="Orders of a new business unit")
    ws.append_flow("b_orders", "b_orders_history", src[2], once=True, comment="Historical orders")


@query("append_flow_by_name", ORDERS_ORACLE)
def append_flow_by_name(spark, sf_dir):
    """A second source appended into an existing streaming table, matched by name."""
    t, ws = setup(spark, sf_dir)
    with ws.update():
        _orders_flows(spark, t, ws)
    return ws.read("b_orders")


@query("append_flow_backfill", ORDERS_ORACLE)
def append_flow_backfill(spark, sf_dir):
    """A one-time backfill flow: a second update neither reruns nor doubles it."""
    t, ws = setup(spark, sf_dir)
    with ws.update():
        _orders_flows(spark, t, ws)
    with ws.update():
        _rerun_orders_flows(spark, t, ws)
    return ws.read("b_orders")


def _rerun_orders_flows(spark, t, ws):
    paths = [(f"{ws.root}/files/orders_{k}", None) for k in range(3)]
    schemas = [t.orders.schema, T.StructType(list(reversed(t.orders.schema.fields))), t.orders.schema]
    src = [read_files_stream(spark, p, s, "csv", header=True, mode="PERMISSIVE")
           for (p, _), s in zip(paths, schemas)]
    ws.streaming_table_as("b_orders", src[0])
    ws.append_flow("b_orders", "b_orders_new_bu", src[1])
    r = ws.append_flow("b_orders", "b_orders_history", src[2], once=True)
    if r is not None:
        raise AssertionError("backfill ran twice")


INSERT_BY_NAME_ORACLE = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders"""


@query("insert_by_name", INSERT_BY_NAME_ORACLE)
def insert_by_name(spark, sf_dir):
    """``INSERT INTO t BY NAME``: columns by name, a missing one is NULL."""
    t, ws = setup(spark, sf_dir)
    with ws.update():
        _orders_flows(spark, t, ws, drop="o_orderpriority")
    return ws.read("b_orders")


@query("st_triggered_two_runs", LINES_ORACLE)
def st_triggered_two_runs(spark, sf_dir):
    """A triggered update takes what is there at its start; files written later are
    taken by the next update, each row once."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/lines"
    lines = t.lineitem.select(*LINE_SCHEMA.fieldNames())
    write_arrivals(lines, path, [F.col("l_orderkey") % 2 == 0], header=True)
    with ws.update():
        ingest_lines(ws, path)
    first = ws.read("b_orders").count()
    write_arrivals(lines, path, [F.col("l_orderkey") % 2 == 1], header=True)
    with ws.update():
        ingest_lines(ws, path)
    if first == 0:
        raise AssertionError("first run took nothing")
    return ws.read("b_orders")


@query("st_trigger_interval", LINES_ORACLE)
def st_trigger_interval(spark, sf_dir):
    """Continuous update with ``pipelines.trigger.interval = '30 seconds'``,
    bounded here by stopping once all input is processed."""
    t, ws = setup(spark, sf_dir)
    path = line_files(ws, t)
    src = read_files_stream(spark, path, LINE_SCHEMA, "csv", header=True)
    with ws.update(continuous=True):
        ws.streaming_table("c_orders_30s_trigger", properties={"pipelines.trigger.interval": "30 seconds"})
        ws.append_flow("c_orders_30s_trigger", "c_orders_30s_trigger", src)
    return ws.read("c_orders_30s_trigger")


@query("st_full_refresh", LINES_ORACLE)
def st_full_refresh(spark, sf_dir):
    """Full refresh recomputes a streaming table from all input (no doubles)."""
    t, ws = setup(spark, sf_dir)
    path = line_files(ws, t)
    with ws.update():
        ingest_lines(ws, path)
    with ws.update(full_refresh=True):
        ingest_lines(ws, path)
    return ws.read("b_orders")


@query("st_no_reset", LINES_ORACLE + " UNION ALL " + LINES_ORACLE + " WHERE l_orderkey % 6 = 1")
def st_no_reset(spark, sf_dir):
    """``pipelines.reset.allowed = false`` on a table that reads a streaming table: a full
    refresh recomputes the source and adds only what is new to this one. Among the new rows
    are some that equal earlier ones in every column, and each other."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/lines"
    lines = t.lineitem.select(*LINE_SCHEMA.fieldNames())
    parts = [[F.col("l_orderkey") % 6 < 2], [F.col("l_orderkey") % 6 == 1, F.col("l_orderkey") % 6 >= 2], []]
    for arrivals, full in zip(parts, (False, True, True)):
        write_arrivals(lines, path, arrivals, header=True, compression="gzip")
        with ws.update(full_refresh=full):
            ingest_lines(ws, path)
            ws.streaming_table("c_orders_no_reset", properties={"pipelines.reset.allowed": "false"})
            ws.append_flow("c_orders_no_reset", "c_orders_no_reset", ws.read_stream("b_orders", into="c_orders_no_reset"))
    return ws.read("c_orders_no_reset")


@query("st_partitioned_retry", LINES_ORACLE)
def st_partitioned_retry(spark, sf_dir):
    """B13 on a partitioned table: a batch that a crash left half written (its staging folder
    holds some partitions) is written whole by the retry, and a committed one is not
    written again."""
    from pyspark.sql.types import IntegerType, StructField, StructType  # noqa: PLC0415
    t, ws = setup(spark, sf_dir)
    path = line_files(ws, t)
    src = read_files_stream(spark, path, LINE_SCHEMA, "csv", header=True)
    with ws.update():
        i = ws.streaming_table("b_orders", LINE_SCHEMA, partition_by=["l_linenumber"])
        half = StructType([StructField("l_linenumber", IntegerType()), StructField("l_orderkey", IntegerType())])
        (spark.createDataFrame([(1, -1)], half).write.partitionBy("l_linenumber")
         .parquet(f"{ws.root}/staging/b_orders/g{i.generation}/b_orders-0"))
        ws.append_flow("b_orders", "b_orders", src)
        write = ws._flow_writer(i, "b_orders", [], {})
        write(t.lineitem.select(*LINE_SCHEMA.fieldNames()), 0)  # the same batch once more
    return ws.read("b_orders")


@query("st_idempotent_retry", LINES_ORACLE)
def st_idempotent_retry(spark, sf_dir):
    """An update fails inside a micro-batch (a FAIL rule), the next update retries
    the same batch from the checkpoint: every row lands once."""
    t, ws = setup(spark, sf_dir)
    path = line_files(ws, t)
    src = read_files_stream(spark, path, LINE_SCHEMA, "csv", header=True)
    failed = False
    try:
        with ws.update():
            ws.streaming_table("b_orders")
            ws.append_flow("b_orders", "b_orders", src,
                           expectations=[expect_or_fail("small_quantity", "l_quantity < 50")])
    except Exception:  # noqa: BLE001 - the failure is the point
        failed = True
    if not failed:
        raise AssertionError("the FAIL rule did not stop the update")
    with ws.update():
        ws.append_flow("b_orders", "b_orders", src, expectations=[expect("small_quantity", "l_quantity < 50")])
    return ws.read("b_orders")


CATALOG_ORACLE = cte("s_orders") + """
SELECT 'b_orders' AS table_name, 'st' AS kind, 'Raw order lines from csv files; processed incrementally' AS comment,
  '{}' AS properties, (SELECT count(*) FROM lineitem) AS num_rows
UNION ALL
SELECT 's_orders', 'st', 'Sales order lines with customer and item information', '{}', (SELECT count(*) FROM s_orders)
UNION ALL
SELECT 'c_orders_fixed_indices', 'st', 'Sales orders; statistics only for order_date and customer_id',
  '{"delta.dataSkippingStatsColumns": "order_date, customer_id"}', (SELECT count(*) FROM s_orders)"""


@query("table_catalog", CATALOG_ORACLE)
def table_catalog(spark, sf_dir):
    """Table comments and properties, with row counts."""
    from .common import build_s_orders  # noqa: PLC0415
    t, ws = setup(spark, sf_dir)
    path = line_files(ws, t)
    with ws.update():
        ingest_lines(ws, path)
        build_s_orders(ws, t)
        ws.streaming_table("c_orders_fixed_indices",
                           comment="Sales orders; statistics only for order_date and customer_id",
                           properties={"delta.dataSkippingStatsColumns": "order_date, customer_id"})
        ws.append_flow("c_orders_fixed_indices", "c_orders_fixed_indices", ws.read_stream("s_orders"))
    cat = ws.tables()
    counts = None
    for name in ("b_orders", "s_orders", "c_orders_fixed_indices"):
        c = ws.read(name).agg(F.count(F.lit(1)).alias("num_rows")).withColumn("table_name", F.lit(name))
        counts = c if counts is None else counts.unionByName(c)
    return cat.join(counts, "table_name").select("table_name", "kind", "comment", "properties", "num_rows")
