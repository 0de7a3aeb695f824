"""Change data capture: type 1 and type 2 targets, deletes, truncates, order, dedup,
composite keys, change counts and the insert-only stream (L1-L8, B17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import cte
from ..operators.partials import Measure
from ..sources.files import read_files_stream
from .common import setup, view
from .finance import write_arrivals
from .registry import query

DELETE_WHEN = "update_type = 'DELETE'"
TRUNCATE_WHEN = "value >= 450"
RECENT_TIES = ["order_id", "line", "item_id", "qty_ordered"]
MID = "2024-01-15"

SCD1_ORACLE = cte("cdc_feed") + """
SELECT id, update_date, event_id, value, update_type FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY update_date DESC, event_id DESC) AS r FROM cdc_feed)
WHERE r = 1 AND update_type <> 'DELETE'"""


def _feed_files(spark, t, ws, parts, name="suppliers_cdc", extra=None):
    feed = view(spark, t, "cdc_feed")
    if extra is not None:
        feed = extra(feed)
    path = f"{ws.root}/files/{name}"
    write_arrivals(feed, path, parts, format="parquet")
    return path, feed.schema


def _run_by_part(spark, t, ws, parts, name="suppliers_cdc", **kw):
    """The parts of the feed arrive one after another; each is applied in an update, and so in
    a micro-batch, of its own, however many files it comes in."""
    feed = view(spark, t, "cdc_feed")
    path = f"{ws.root}/files/{name}"
    for cond in parts:
        write_arrivals(feed, path, [cond], format="parquet")
        with ws.update():
            _apply(ws, path, feed.schema, **kw)


def _apply(ws, path, schema, scd_type=1, keys=("id",), target="s_suppliers", **kw):
    """``b_suppliers_cdc`` (stream of the change files) → ``APPLY CHANGES INTO target``."""
    src = read_files_stream(ws.spark, path, schema, "parquet")
    kw.setdefault("delete_when", DELETE_WHEN)
    kw.setdefault("tie_break", ["event_id"])
    return ws.apply_changes(target, src, keys=list(keys), sequence_by="update_date", scd_type=scd_type, **kw)


@query("cdc_scd1", SCD1_ORACLE)
def cdc_scd1(spark, sf_dir):
    """L1: ``APPLY CHANGES ... KEYS (id) SEQUENCE BY update_date`` (type 1), fed in three
    micro-batches of interleaved times."""
    t, ws = setup(spark, sf_dir)
    _run_by_part(spark, t, ws, [F.col("event_id") % 3 == k for k in range(3)])
    return ws.read("s_suppliers")


@query("cdc_scd2", cte("cdc_feed") + """
SELECT id, update_date, event_id, value, update_type, valid_from, valid_to FROM (
  SELECT *, update_date AS valid_from,
    lead(update_date) OVER (PARTITION BY id ORDER BY update_date, event_id) AS valid_to FROM cdc_feed)
WHERE update_type <> 'DELETE'""")
def cdc_scd2(spark, sf_dir):
    """L2/F2: ``STORED AS SCD TYPE 2``: one version per change, closed by the next change
    of the key; deletes close a version and open none. Three runs of interleaved times."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/suppliers_cdc"
    feed = view(spark, t, "cdc_feed")
    for k in range(3):
        write_arrivals(feed, path, [F.col("event_id") % 3 == k], format="parquet")
        with ws.update():
            _apply(ws, path, feed.schema, scd_type=2)
    return ws.read("s_suppliers")


HISTORY = cte("cdc_feed") + """
, h AS (SELECT *, update_date AS valid_from,
    lead(update_date) OVER (PARTITION BY id ORDER BY update_date, event_id) AS valid_to FROM cdc_feed)
SELECT id, update_date, event_id, value, update_type, valid_from, valid_to FROM h WHERE update_type <> 'DELETE'"""


@query("cdc_scd2_current", HISTORY + " AND valid_to IS NULL")
def cdc_scd2_current(spark, sf_dir):
    """L2: the open versions of a history table, read without its history."""
    t, ws = setup(spark, sf_dir)
    _run_by_part(spark, t, ws, [F.col("event_id") % 2 == k for k in range(2)], scd_type=2)
    return ws.read_current("s_suppliers")


@query("cdc_scd2_late", HISTORY)
def cdc_scd2_late(spark, sf_dir):
    """The newer part of the feed comes first, then the older one, then changes that
    fall between both: each splits the version it falls into. At the end the runs are merged."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/suppliers_cdc"
    feed = view(spark, t, "cdc_feed")
    between = F.col("event_id") % 10 == 0
    newer = F.col("update_date") >= F.lit(MID)
    for cond in (newer & ~between, ~newer & ~between, between):
        write_arrivals(feed, path, [cond], format="parquet")
        with ws.update():
            _apply(ws, path, feed.schema, scd_type=2)
    return ws.compact("s_suppliers")


@query("cdc_delete", SCD1_ORACLE)
def cdc_delete(spark, sf_dir):
    """L3: ``APPLY AS DELETE WHEN update_type = "DELETE"``: the deletes arrive in a later
    run than the rows they remove (and than later upserts of the same keys)."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/suppliers_cdc"
    feed = view(spark, t, "cdc_feed")
    is_delete = F.col("update_type") == "DELETE"
    for cond in (~is_delete, is_delete):
        write_arrivals(feed, path, [cond], format="parquet")
        with ws.update():
            _apply(ws, path, feed.schema)
    return ws.read("s_suppliers")


@query("cdc_truncate", cte("cdc_feed") + f"""
, point AS (SELECT arg_max(update_date, (update_date, event_id)) AS tu, arg_max(event_id, (update_date, event_id)) AS te
  FROM cdc_feed WHERE {TRUNCATE_WHEN})
, kept AS (SELECT f.* FROM cdc_feed f, point p WHERE NOT ({TRUNCATE_WHEN})
  AND (p.tu IS NULL OR f.update_date > p.tu OR (f.update_date = p.tu AND f.event_id > p.te)))
SELECT id, update_date, event_id, value, update_type FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY update_date DESC, event_id DESC) AS r FROM kept)
WHERE r = 1 AND update_type <> 'DELETE'""")
def cdc_truncate(spark, sf_dir):
    """L4: ``APPLY AS TRUNCATE WHEN``: a truncate event empties the target as of its
    sequence; older events arriving later stay out."""
    t, ws = setup(spark, sf_dir)
    _run_by_part(spark, t, ws, [F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1], truncate_when=TRUNCATE_WHEN)
    return ws.read("s_suppliers")


@query("cdc_out_of_order", SCD1_ORACLE)
def cdc_out_of_order(spark, sf_dir):
    """The newer half of the feed arrives first; the sequence column decides."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/suppliers_cdc"
    feed = view(spark, t, "cdc_feed")
    for cond in (F.col("update_date") >= F.lit(MID), F.col("update_date") < F.lit(MID)):
        write_arrivals(feed, path, [cond], format="parquet")
        with ws.update():
            _apply(ws, path, feed.schema)
    return ws.read("s_suppliers")


@query("cdc_dedup", SCD1_ORACLE)
def cdc_dedup(spark, sf_dir):
    """Exact duplicate change rows (within and across batches) collapse."""
    t, ws = setup(spark, sf_dir)
    dup = F.col("event_id") % 5 == 0
    path, schema = _feed_files(spark, t, ws, [F.lit(True), dup], extra=lambda f: f.unionByName(f.where(dup)))
    _apply(ws, path, schema)
    return ws.read("s_suppliers")


@query("cdc_composite_key", cte("cdc_feed") + """
SELECT id, update_date, event_id, value, update_type FROM (
  SELECT *, row_number() OVER (PARTITION BY id, update_type ORDER BY update_date DESC, event_id DESC) AS r
  FROM cdc_feed) WHERE r = 1""")
def cdc_composite_key(spark, sf_dir):
    """``KEYS (id, update_type)``: latest change per user and kind (no delete rule)."""
    t, ws = setup(spark, sf_dir)
    path, schema = _feed_files(spark, t, ws, [F.lit(True)])
    _apply(ws, path, schema, keys=("id", "update_type"), delete_when=None)
    return ws.read("s_suppliers")


TWO_RUNS = cte("cdc_feed") + f"""
, r1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY update_date DESC, event_id DESC) AS r
    FROM cdc_feed WHERE update_date < TIMESTAMP '{MID} 00:00:00') WHERE r = 1 AND update_type <> 'DELETE')
, r2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY update_date DESC, event_id DESC) AS r
    FROM cdc_feed) WHERE r = 1 AND update_type <> 'DELETE')
, k2 AS (SELECT DISTINCT id FROM cdc_feed WHERE update_date >= TIMESTAMP '{MID} 00:00:00')
"""


def _two_runs(spark, sf_dir):
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/suppliers_cdc"
    feed = view(spark, t, "cdc_feed")
    for cond in (F.col("update_date") < F.lit(MID), F.col("update_date") >= F.lit(MID)):
        write_arrivals(feed, path, [cond], format="parquet")
        with ws.update():
            _apply(ws, path, feed.schema)
    return ws


@query("cdc_op_counts", TWO_RUNS + """
SELECT 'insert' AS op, CAST((SELECT count(*) FROM r1) + (SELECT count(*) FROM r2 WHERE id NOT IN (SELECT id FROM r1))
  AS BIGINT) AS num_rows
UNION ALL SELECT 'update', CAST(count(*) AS BIGINT) FROM r1 WHERE id IN (SELECT id FROM r2) AND id IN (SELECT id FROM k2)
UNION ALL SELECT 'delete', CAST(count(*) AS BIGINT) FROM r1 WHERE id NOT IN (SELECT id FROM r2)""")
def cdc_op_counts(spark, sf_dir):
    """Inserts, updates and deletes the two runs made, from the change log."""
    ws = _two_runs(spark, sf_dir)
    return ws.read_changes("s_suppliers").groupBy(F.col("_op").alias("op")).agg(F.count(F.lit(1)).alias("num_rows"))


@query("stream_skip_changes", TWO_RUNS + """
SELECT id, update_date, event_id, value, update_type FROM r1
UNION ALL SELECT id, update_date, event_id, value, update_type FROM r2 WHERE id NOT IN (SELECT id FROM r1)""")
def stream_skip_changes(spark, sf_dir):
    """A stream from a table that gets updates and deletes, taking only appended
    rows (first appearance of a key), as ``skipChangeCommits`` does."""
    ws = _two_runs(spark, sf_dir)
    inserts = ws.read_changes("s_suppliers", stream=True).where(F.col("_op") == "insert").drop("_op", "_batch")
    with ws.update():
        ws.streaming_table_as("new_suppliers", inserts)
    return ws.read("new_suppliers")


@query("agg_retractions", TWO_RUNS + """
SELECT update_type, count(*) AS suppliers, sum(CAST(value AS DECIMAL(18,2))) AS total_value,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS avg_value FROM r2 GROUP BY 1""")
def agg_retractions(spark, sf_dir):
    """A summary over a change target that follows its updates and deletes: each change
    takes the row it replaces back from its group."""
    t, ws = setup(spark, sf_dir)
    path = f"{ws.root}/files/suppliers_cdc"
    feed, value = view(spark, t, "cdc_feed"), "CAST(value AS DECIMAL(18,2))"
    measures = [Measure("suppliers", "count"), Measure("total_value", "total", value), Measure("avg_value", "mean", value)]
    for cond in (F.col("update_date") < F.lit(MID), F.col("update_date") >= F.lit(MID)):
        write_arrivals(feed, path, [cond], format="parquet")
        with ws.update():
            _apply(ws, path, feed.schema)
            ws.signed_aggregate("g_suppliers_by_type", "s_suppliers", ["update_type"], measures)
    return ws.read("g_suppliers_by_type").withColumn("total_value", F.col("total_value").cast("decimal(38,2)"))


@query("cdc_recent_customer_orders", cte("s_orders") + """
SELECT order_id, line, order_date, customer_id, customer_name, item_id, item_description, unit_price,
  qty_ordered, total_price FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id
    ORDER BY order_date DESC, order_id DESC, line DESC, item_id DESC, qty_ordered DESC) AS r
  FROM s_orders) WHERE r = 1""")
def cdc_recent_customer_orders(spark, sf_dir):
    """L1 on the sales stream: ``g_recent_customer_orders``, ``APPLY CHANGES ... FROM
    STREAM(s_orders) KEYS (customer_id) SEQUENCE BY order_date`` (order lines repeat
    ``(order_id, line)``, so the item and quantity break the remaining ties)."""
    from .common import s_orders_pipeline  # noqa: PLC0415
    _, ws = s_orders_pipeline(spark, sf_dir)
    with ws.update():
        ws.apply_changes("g_recent_customer_orders", ws.read_stream("s_orders"), keys=["customer_id"],
                         sequence_by="order_date", tie_break=RECENT_TIES)
    return ws.read("g_recent_customer_orders")


@query("cdc_op_counts_scd2", cte("cdc_feed") + """
, e AS (SELECT update_type = 'DELETE' AS d, lag(update_type = 'DELETE') OVER (PARTITION BY id ORDER BY update_date, event_id) AS b
  FROM cdc_feed)
SELECT CASE WHEN d THEN 'delete' WHEN NOT coalesce(b, TRUE) THEN 'update' ELSE 'insert' END AS op, count(*) AS num_rows
FROM e WHERE NOT (d AND coalesce(b, TRUE)) GROUP BY 1""")
def cdc_op_counts_scd2(spark, sf_dir):
    """L8 on the history table: versions opened, replaced and closed, from its change log."""
    t, ws = setup(spark, sf_dir)
    _run_by_part(spark, t, ws, [F.col("event_id") % 2 == k for k in range(2)], scd_type=2)
    return ws.read_changes("s_suppliers").groupBy(F.col("_op").alias("op")).agg(F.count(F.lit(1)).alias("num_rows"))


NO_KEY = "event_id % 7 = 0"


@query("cdc_quarantine", cte("cdc_feed") + f"""
SELECT CAST(NULL AS BIGINT) AS id, update_date, event_id, value, update_type FROM cdc_feed WHERE {NO_KEY}""")
def cdc_quarantine(spark, sf_dir):
    """Change rows without a key cannot be applied: they are kept as they came."""
    t, ws = setup(spark, sf_dir)
    path, schema = _feed_files(spark, t, ws, [F.lit(True)], extra=lambda f: f.withColumn(
        "id", F.when(~F.expr(NO_KEY), F.col("id"))))
    _apply(ws, path, schema, scd_type=2)
    return ws.read_quarantine("s_suppliers")


@query("cdc_log_after_retry", TWO_RUNS + """
SELECT 'insert' AS op, CAST((SELECT count(*) FROM r1) + (SELECT count(*) FROM r2 WHERE id NOT IN (SELECT id FROM r1))
  AS BIGINT) AS num_rows
UNION ALL SELECT 'update', CAST(count(*) AS BIGINT) FROM r1 WHERE id IN (SELECT id FROM r2) AND id IN (SELECT id FROM k2)
UNION ALL SELECT 'delete', CAST(count(*) AS BIGINT) FROM r1 WHERE id NOT IN (SELECT id FROM r2)""")
def cdc_log_after_retry(spark, sf_dir):
    """L8 after a crash: a batch is applied, then applied again to a target that already
    holds it (as when the run stops between the merge and its commit)."""
    from ..operators.cdc import ChangeApplier, ChangeSpec  # noqa: PLC0415
    t, ws = setup(spark, sf_dir)
    feed = view(spark, t, "cdc_feed")
    spec = ChangeSpec(["id"], "update_date", DELETE_WHEN, tie_break=["event_id"])
    apply = ChangeApplier(spark, f"{ws.root}/retry", spec, 1, ws.buckets)
    first, second = feed.where(F.col("update_date") < F.lit(MID)), feed.where(F.col("update_date") >= F.lit(MID))
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        apply(batch, number)
    return apply.read_changes().groupBy(F.col("_op").alias("op")).agg(F.count(F.lit(1)).alias("num_rows"))
