"""Change capture: results do not depend on how the feed is cut into batches or in
which order batches arrive; the skew-safe lead equals the window lead."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.cdc import ChangeSpec, scd1, scd2
from strata.operators.sequence import next_in_order
from strata.plans.common import setup, view
from strata.plans.finance import write_arrivals
from strata.sources.files import read_files_stream

SPEC = dict(keys=["id"], sequence_by="update_date", delete_when="update_type = 'DELETE'", tie_break=["event_id"])


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_next_in_order_equals_window_lead(spark):
    from conftest import MEDIUM
    t, _ = setup(spark, MEDIUM)
    # one hot key holds a third of the rows
    ev = t.events.withColumn("k", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    got = next_in_order(ev, ["k"], ["ts", "event_id"], "ts", "nxt")
    want = ev.withColumn("nxt", F.lead("ts").over(Window.partitionBy("k").orderBy("ts", "event_id")))
    cols = ["event_id", "k", "nxt"]
    assert _rows(got, cols) == _rows(want, cols)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(cuts=st.lists(st.integers(min_value=0, max_value=9), min_size=1, max_size=3, unique=True),
       reverse=st.booleans())
def test_stream_merge_independent_of_batches(spark, cuts, reverse):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    feed = view(spark, t, "cdc_feed")
    bounds = sorted(cuts)
    parts = []
    lo = None
    for b in bounds + [None]:
        c = F.lit(True)
        if lo is not None:
            c = c & (F.col("event_id") % 10 >= lo)
        if b is not None:
            c = c & (F.col("event_id") % 10 < b)
        parts.append(c)
        lo = b
    if reverse:
        parts = parts[::-1]
    path = f"{ws.root}/files/feed"
    write_arrivals(feed, path, parts, format="parquet")
    for scd in (1, 2):
        src = read_files_stream(spark, path, feed.schema, "parquet", max_files_per_trigger=1)
        ws.apply_changes(f"t{scd}", src, scd_type=scd, **SPEC)
    spec = ChangeSpec(SPEC["keys"], SPEC["sequence_by"], SPEC["delete_when"], tie_break=SPEC["tie_break"])
    cols1 = ["id", "update_date", "event_id", "value", "update_type"]
    assert _rows(ws.read("t1"), cols1) == _rows(scd1(feed, spec), cols1)
    cols2 = cols1 + ["valid_from", "valid_to"]
    assert _rows(ws.read("t2"), cols2) == _rows(scd2(feed, spec), cols2)


def test_hot_key_history_and_latest_match_brute_force(spark):
    """One key holds a third of the change rows: type 1 and type 2 still equal the
    plain window computation."""
    from conftest import MEDIUM
    t, _ = setup(spark, MEDIUM)
    feed = view(spark, t, "cdc_feed").withColumn(
        "id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")))
    spec = ChangeSpec(SPEC["keys"], SPEC["sequence_by"], SPEC["delete_when"], tie_break=SPEC["tie_break"])
    w = Window.partitionBy("id").orderBy("update_date", "event_id")
    want2 = (feed.withColumn("valid_from", F.col("update_date"))
             .withColumn("valid_to", F.lead("update_date").over(w)).where("update_type <> 'DELETE'"))
    cols2 = ["id", "update_date", "event_id", "value", "update_type", "valid_from", "valid_to"]
    assert _rows(scd2(feed, spec), cols2) == _rows(want2, cols2)
    last = feed.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(
        F.col("update_date").desc(), F.col("event_id").desc())))
    want1 = last.where("r = 1 AND update_type <> 'DELETE'")
    cols1 = cols2[:5]
    assert _rows(scd1(feed, spec), cols1) == _rows(want1, cols1)


def test_rows_without_key_are_counted_not_applied(spark):
    from conftest import SMALL
    from strata.plans import eventlog as L
    t, ws = setup(spark, SMALL)
    feed = view(spark, t, "cdc_feed").withColumn(
        "id", F.when(F.col("event_id") % 10 == 0, F.lit(None)).otherwise(F.col("id")))
    path = f"{ws.root}/files/feed"
    write_arrivals(feed, path, [F.lit(True)], format="parquet")
    ws.apply_changes("t", read_files_stream(spark, path, feed.schema, "parquet"), **SPEC)
    spec = ChangeSpec(SPEC["keys"], SPEC["sequence_by"], SPEC["delete_when"], tie_break=SPEC["tie_break"])
    cols = ["id", "update_date", "event_id", "value", "update_type"]
    assert _rows(ws.read("t"), cols) == _rows(scd1(feed, spec), cols)
    n = ws.log.read().where("event_type = 'flow_progress' AND table_name = 't'") \
        .select(L.detail("flow_progress:metrics:null_key_or_sequence").cast("long")).first()[0]
    assert n == feed.where("id IS NULL").count() > 0


def test_history_of_any_sequence_type_without_tie_break(spark):
    """TIMESTAMP, TIMESTAMP_NTZ, date, number and text sequences; the whole row is the tie."""
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    feed = view(spark, t, "cdc_feed").dropDuplicates(["id", "update_date"])
    for k, type_ in enumerate(("timestamp", "timestamp_ntz", "string")):
        typed = feed.withColumn("update_date", F.col("update_date").cast(type_))
        path = f"{ws.root}/files/feed{k}"
        write_arrivals(typed, path, [F.col("event_id") % 2 == i for i in (1, 0)], format="parquet")
        src = read_files_stream(spark, path, typed.schema, "parquet", max_files_per_trigger=1)
        ws.apply_changes(f"h{k}", src, keys=["id"], sequence_by="update_date", delete_when="update_type = 'DELETE'", scd_type=2)
        w = Window.partitionBy("id").orderBy("update_date")
        want = typed.withColumn("valid_to", F.lead("update_date").over(w)).where("update_type <> 'DELETE'")
        cols = ["event_id", "update_date", "valid_to"]
        key = lambda rows: sorted(map(str, rows))
        assert key(tuple(r) for r in ws.read(f"h{k}").select(*cols).collect()) == key(tuple(r) for r in want.select(*cols).collect())


def test_neighbours_by_number_and_backwards(spark):
    d = spark.range(3000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 3000 * 1500).alias("x"), "id")
    for back, near in ((False, F.lead), (True, F.lag)):
        got = next_in_order(d, ["k"], ["x", "id"], "id", "n", back=back)
        want = d.withColumn("n", near("id").over(Window.partitionBy("k").orderBy("x", "id")))
        assert _rows(got.fillna(-1), ["k", "x", "n"]) == _rows(want.fillna(-1), ["k", "x", "n"])


def test_small_batch_leaves_closed_versions_alone(spark):
    import glob
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    feed = view(spark, t, "cdc_feed")
    path = f"{ws.root}/files/feed"
    seen = {}
    for cond in (F.col("event_id") % 50 != 0, F.col("event_id") % 50 == 0):
        write_arrivals(feed, path, [cond], format="parquet")
        ws.apply_changes("h", read_files_stream(spark, path, feed.schema, "parquet"), scd_type=2, **SPEC)
        files = set(glob.glob(ws.data_path("h").removeprefix("file:") + "/data/**/*.parquet", recursive=True))
        assert set(seen) <= files
        seen = dict.fromkeys(files)


@pytest.mark.parametrize("key,batches", [("cdc_scd1", 3), ("cdc_scd2_current", 2), ("cdc_op_counts_scd2", 2), ("cdc_truncate", 2)])
def test_the_number_of_batches_does_not_follow_the_number_of_files(spark, tmp_path, monkeypatch, key, batches):
    import __spark_entry__ as E
    from conftest import SMALL
    from strata.operators.cdc import ChangeApplier
    spark.read.parquet(f"{SMALL}/events.parquet").repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    calls, real = [], ChangeApplier.__call__
    monkeypatch.setattr(ChangeApplier, "__call__", lambda self, batch, n: calls.append(n) or real(self, batch, n))
    got, want = E.queries()[key](spark, str(tmp_path)), E.queries()[key](spark, SMALL)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert len(calls) == 2 * batches
