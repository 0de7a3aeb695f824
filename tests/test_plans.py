"""Plan shapes: filters and projections reach the Parquet scan, building a join runs no
job and leaves the strategy to Spark, and no window is keyed by the change key alone."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from strata.operators import joins
from strata.operators.sequence import block_of, next_in_order
from strata.plans.common import setup


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_and_projection_pushed_to_scan(spark):
    import __spark_entry__ as E
    from conftest import SMALL
    p = _plan(E.queries()["filter_parameterized"](spark, SMALL))
    assert "GreaterThan(o_orderdate" in p
    t, _ = setup(spark, SMALL)
    p2 = _plan(t.lineitem.select("l_orderkey", "l_quantity").where(F.col("l_quantity") > 10))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p2


def test_join_strategy_is_left_to_the_optimizer(spark):
    from conftest import SMALL
    t, _ = setup(spark, SMALL)
    join = lambda: joins.lookup(t.lineitem, t.part, t.lineitem["l_partkey"] == t.part["p_partkey"])
    assert "BroadcastHashJoin" in _plan(join())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(join())
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_building_joins_runs_no_job(spark):
    """Only the schema of a Parquet file may be read (one task each) before an action."""
    import __spark_entry__ as E
    from conftest import SMALL
    status = spark.sparkContext.statusTracker()
    for key in ("join_static_static", "join_anti_fk", "validate_contracts"):
        spark.sparkContext.setJobGroup(f"build-{key}", key)
        E.queries()[key](spark, SMALL)
        jobs = status.getJobIdsForGroup(f"build-{key}")
        stages = [s for j in jobs for s in status.getJobInfo(j).stageIds]
        assert all(status.getStageInfo(s).numTasks == 1 and status.getStageInfo(s).name.startswith("parquet") for s in stages)
    spark.sparkContext.setJobGroup("rest", "rest")


def test_history_window_is_not_keyed_by_the_change_key_alone(spark):
    from conftest import SMALL
    t, _ = setup(spark, SMALL)
    blocks = block_of(t.events, "ts", rows=100)  # as for a table of more rows than one block holds
    p = _plan(next_in_order(t.events, ["user_id"], ["ts", "event_id"], "ts", "nxt", block=blocks))
    # the raw rows are windowed per (key, block); only the per-block firsts per key
    assert "hashpartitioning(user_id#" in p and "__strata_block" in p
