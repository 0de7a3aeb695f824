"""Mergeable partials: of batches, of hours, signed; late rows; folding."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.partials import Measure, PartialStore, finish, merge, partial
from strata.plans.workspace import Workspace
from strata.session import new_scratch
from strata.sources.files import read_files_stream

ALL = [Measure("rows", "count"), Measure("n", "count", "v"), Measure("s", "total", "CAST(v AS DECIMAL(18,2))"), Measure("m", "mean", "v"),
       Measure("lo", "least", "v"), Measure("hi", "most", "v"), Measure("d", "distinct", "v"), Measure("q", "quantile", "v", 0.5)]


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_partials_of_parts_are_those_of_the_whole(spark):
    d = spark.range(5000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 11 != 0, (F.col("id") * 7919 % 1000) / 4).alias("v"), (F.col("id") % 5).alias("part"))
    d = d.unionByName(spark.createDataFrame([(None, None, 1), (9, None, 2)], "k long, v double, part long"))
    store = PartialStore(spark, new_scratch(spark, "partials"), ["k"], ALL)
    for n in range(5):
        store.add(d.where(F.col("part") == n), n)
        store.add(d.where(F.col("part") == n), n)  # a batch that comes again
    want = {r.k: r for r in d.groupBy("k").agg(F.count("*").alias("rows"), F.count("v").alias("n"), F.sum(F.expr("CAST(v AS DECIMAL(18,2))")).alias("s"), F.avg("v").alias("m"),
                                              F.min("v").alias("lo"), F.max("v").alias("hi"), F.countDistinct("v").alias("d"), F.median("v").alias("q")).collect()}

    def check():
        got = {r.k: r for r in store.read().collect()}
        assert got.keys() == want.keys()
        for k, w in want.items():
            g = got[k]
            assert (g.rows, g.n, g.s, g.lo, g.hi) == (w.rows, w.n, w.s, w.lo, w.hi)
            assert (g.m is None and w.m is None) or abs(g.m - w.m) < 1e-9
            if w.n:
                assert abs(g.d - w.d) <= 0.1 * w.d + 1 and abs(g.q - w.q) <= 20
    check()
    assert store.fold(most=2) and len(store.parts()) == 1 and not store.fold(most=2)
    check()
    store.add(d.where("false"), 5)
    store.add(d.where("part = 9"), 6)
    assert store.fold(most=1)
    store.clear()
    check()


def test_days_from_hours_read_the_hours_alone(spark):
    ws = Workspace(spark)
    d = spark.range(2000).select(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * 7 as int))").alias("t"), (F.col("id") % 50).cast("double").alias("v"))
    d.write.parquet(f"{ws.root}/files/rows")
    rows = spark.read.parquet(f"{ws.root}/files/rows")
    ws.materialized_view("hours", partial(rows, [F.date_trunc("hour", "t").alias("hour")], ALL))
    out = finish(merge(ws.read("hours"), [F.date_trunc("day", "hour").alias("day")], ALL), ["day"], ALL)
    assert all("/tables/hours/" in f for f in out.inputFiles())
    want = rows.groupBy(F.date_trunc("day", "t").alias("day")).agg(F.count("*").alias("rows"), F.sum("v").alias("s"), F.min("v").alias("lo"))
    assert rows_of(out.select("day", "rows", F.col("s").cast("double").alias("s"), "lo")) == rows_of(want)


def test_measures_that_cannot_be_taken_back_say_so(spark):
    for kind in ("least", "most", "distinct", "quantile"):
        with pytest.raises(ValueError, match="taken back"):
            Measure("x", kind, "v", 0.5).parts(F.lit(1))


def test_a_summary_follows_updates_deletes_and_truncates(spark):
    rnd, ws = random.Random(4), Workspace(spark, buckets=4)
    schema, path = "id int, seq int, kind string, v double, gone boolean", f"{ws.root}/files/in"
    measures = [Measure("n", "count"), Measure("nv", "count", "v"), Measure("s", "total", "CAST(v AS DECIMAL(18,2))"), Measure("m", "mean", "CAST(v AS DECIMAL(18,2))")]
    seq = 0
    for run in range(4):
        rows = []
        for _ in range(40):
            seq += 1
            late = seq - rnd.choice([0, 0, 0, 30])
            rows.append((rnd.randrange(12), late, rnd.choice(["a", "b", None]), rnd.choice([None, 1.25, 2.5]), rnd.random() < 0.3))
        if run == 2:
            rows.append((0, seq - 20, "cut", None, False))
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        with ws.update():
            ws.apply_changes("t", read_files_stream(spark, path, schema, "parquet"), keys=["id"], sequence_by="seq", delete_when="gone", truncate_when="kind = 'cut'")
            ws.signed_aggregate("g", "t", ["kind"], measures)
        want = ws.read("t").groupBy("kind").agg(F.count("*").alias("n"), F.count("v").alias("nv"), F.sum(F.expr("CAST(v AS DECIMAL(18,2))")).alias("s"))
        got = ws.read("g")
        assert rows_of(got.select("kind", "n", "nv", F.col("s").cast("decimal(28,2)").alias("s"))) == rows_of(want)
        assert got.where("nv > 0 AND abs(m - CAST(s AS DOUBLE) / nv) > 1e-9 OR nv = 0 AND m IS NOT NULL").count() == 0
    assert rows_of(Workspace(spark, root=ws.root).read("g")) == rows_of(ws.read("g"))


def test_late_rows_are_kept_and_repaired_in(spark):
    ws = Workspace(spark)
    path, schema = f"{ws.root}/files/in", "k string, t timestamp_ntz, v double"
    at = lambda h: f"2024-01-01 {h:02d}:30:00"
    measures = [Measure("n", "count"), Measure("s", "total", "v"), Measure("lo", "least", "v")]

    def run(*rows):
        df = spark.createDataFrame(list(rows), "k string, t string, v double").withColumn("t", F.expr("CAST(t AS timestamp_ntz)"))
        df.coalesce(1).write.mode("append").parquet(path)
        with ws.update():
            ws.window_table("w", read_files_stream(spark, path, schema, "parquet"), "t", "1 hour", "1 HOUR", measures, keys=["k"])
        return sorted((r.window_start.hour, r.k, r.n, r.s) for r in ws.read("w").collect())

    assert run(("a", at(3), 1.0), ("a", at(5), 2.0), ("b", at(3), 4.0)) == [(3, "a", 1, 1.0), (3, "b", 1, 4.0)]
    assert run(("a", at(3), 8.0), ("a", at(4), 16.0), ("a", None, 1.0)) == [(3, "a", 1, 1.0), (3, "b", 1, 4.0)]  # 3: late; 4: in time, not closed
    assert [r.v for r in ws.read_late("w").collect()] == [8.0]
    assert run(("a", at(9), 0.0)) == [(3, "a", 1, 1.0), (3, "b", 1, 4.0), (4, "a", 1, 16.0), (5, "a", 1, 2.0)]
    assert run(("c", at(2), 5.0)) == [(3, "a", 1, 1.0), (3, "b", 1, 4.0), (4, "a", 1, 16.0), (5, "a", 1, 2.0)]
    assert ws.repair("w") == 4 and ws.repair("w") == 0
    got = sorted((r.window_start.hour, r.k, r.n, r.s) for r in ws.read("w").collect())
    assert got == [(2, "c", 1, 5.0), (3, "a", 2, 9.0), (3, "b", 1, 4.0), (4, "a", 1, 16.0), (5, "a", 1, 2.0)]
    assert ws.read_late("w").count() == 2
