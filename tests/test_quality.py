"""Expectations: FAIL keeps the old version, drop and quarantine split the input,
NULL verdicts are violations, metrics are counted once per rule."""

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import expect, expect_or_drop, expect_or_fail, quarantine, rule_counts
from strata.plans.common import setup, view


def test_fail_rule_stops_update_and_keeps_old_version(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    customers = view(spark, t, "dq_customers")
    ws.materialized_view("c", customers, expectations=[expect_or_fail("has_id", "id IS NOT NULL")])
    before = ws.read("c").count()
    with pytest.raises(Exception):
        ws.materialized_view("c", customers.where("id > 10"),
                             expectations=[expect_or_fail("valid_name", "customer_name IS NOT NULL AND customer_name <> ''")])
    assert ws.read("c").count() == before
    failed = ws.log.read().where("event_type = 'update_progress' AND level = 'ERROR'").count()
    assert failed == 1


def test_drop_and_quarantine_partition_the_input(spark):
    from conftest import SMALL
    t, _ = setup(spark, SMALL)
    d = view(spark, t, "dq_customers")
    rule = expect_or_drop("valid_name", "customer_name IS NOT NULL AND customer_name <> ''")
    from strata.operators.quality import enforce
    kept = enforce(d, [rule], "d").count()
    bad = quarantine(d, [rule]).count()
    assert kept + bad == d.count()
    assert bad > 0


def test_null_verdict_is_a_violation(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    r = rule_counts(df, [expect("pos", "x > 0")]).collect()[0]
    assert (r.passed_records, r.failed_records) == (1, 2)


def test_fail_rule_in_a_stream_commits_nothing(spark):
    from conftest import SMALL
    from strata.plans.common import ingest_lines, line_files
    from strata.plans.finance import LINE_SCHEMA
    from strata.sources.files import read_files_stream
    t, ws = setup(spark, SMALL)
    path = line_files(ws, t)
    src = read_files_stream(spark, path, LINE_SCHEMA, "csv", header=True)
    with pytest.raises(Exception):
        with ws.update():
            ws.streaming_table("b")
            ws.append_flow("b", "b", src, expectations=[expect_or_fail("q", "l_quantity < 50")])
    assert ws.read("b").count() == 0
