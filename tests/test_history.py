"""The history store: equal to the batch form whatever the batches, and touching no more
than the runs a change falls into."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.cdc import ChangeApplier, ChangeSpec, scd2, versions  # noqa: F401
from strata.operators.sequence import block_of, next_in_order
from strata.session import new_scratch

SCHEMA = "k1 int, k2 string, seq timestamp, tie int, v string, gone boolean"
COLS = ["k1", "k2", "seq", "tie", "v", "gone", "valid_from", "valid_to"]


def rows_of(df):
    return sorted(map(str, df.select(*COLS).collect()))


def spec():
    return ChangeSpec(["k1", "k2"], "seq", "gone", tie_break=["tie"])


def changes(spark, rnd, n, lo, hi, keys=6):
    """Random changes at seconds [lo, hi): ties of sequence, deletes, repeats."""
    import datetime as dt
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(lo, hi))
    rows = [(rnd.randrange(keys), rnd.choice("ab"), at(), rnd.randrange(3), None, rnd.random() < 0.2) for _ in range(n)]
    rows = [(*r[:4], f"v{hash(r[:4]) % 97}", hash(r[:4]) % 5 == 0) for r in rows]  # equal keys and order: equal rows
    return spark.createDataFrame(rows + rows[: n // 5], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_in_any_order_make_the_batch_form(spark, seed):
    rnd = random.Random(seed)
    store = ChangeApplier(spark, new_scratch(spark, "history"), spec(), 2, 4)
    spans = [(50, 100), (0, 100), (90, 130), (0, 10), (0, 200)]  # later, late and overlapping
    all_rows = None
    for n, (lo, hi) in enumerate(spans):
        b = changes(spark, rnd, rnd.choice([1, 5, 30]), lo, hi).cache()
        store(b, n)
        if n == 2:
            store(b, n)  # a batch that comes again
        all_rows = b if all_rows is None else all_rows.unionByName(b)
        want = scd2(all_rows, spec())
        assert rows_of(store.read()) == rows_of(want)
        assert rows_of(store.read_current()) == rows_of(want.where("valid_to IS NULL"))
        assert store.history().size() == want.count()
    before = rows_of(store.read())
    log = sorted(map(str, store.read_changes().collect()))
    store.compact()
    folders = store.history().folders()
    assert rows_of(store.read()) == before and len({f[1:] for f in folders}) == len(folders)
    assert store.history().vacuum() > 0
    assert rows_of(store.read()) == before and sorted(map(str, store.read_changes().collect())) == log
    b = changes(spark, rnd, 20, 0, 250).cache()
    store(b, 9)
    assert rows_of(store.read()) == rows_of(scd2(all_rows.unionByName(b), spec()))


def row(k, second, tie=0, gone=False):
    import datetime as dt
    return (k, "a", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second), tie, f"{k}-{second}", gone)


def test_a_change_touches_only_the_runs_it_falls_into(spark):
    store = ChangeApplier(spark, new_scratch(spark, "history"), spec(), 2, 8)
    make = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    store(make(*[row(k, s) for k in range(40) for s in (10, 20, 30)]), 0)
    first = set(store.history().folders())
    store(make(row(3, 40)), 1)  # newer: one bucket's open rows
    second = set(store.history().folders())
    assert len(first - second) == 1 and {f[1] for f in first - second} == {"open"}
    store(make(row(3, 50)), 2)
    third = set(store.history().folders())
    store(make(row(3, 45)), 3)  # late: splits [40, 50), kept in the run of batch 2
    fourth = set(store.history().folders())
    gone = third - fourth
    assert {f[1] for f in gone} == {"open", "closed"} and len(gone) == 2
    assert [f[0] for f in gone if f[1] == "closed"] == [2]
    store(make(row(3, 5)), 4)  # before the first change: the births of one bucket
    gone = fourth - set(store.history().folders())
    assert {f[1] for f in gone} == {"open", "birth"} and len(gone) == 2
    got = [(r.valid_from.second, r.valid_to and r.valid_to.second) for r in store.read().where("k1 = 3").orderBy("valid_from").collect()]
    assert got == [(5, 10), (10, 20), (20, 30), (30, 40), (40, 45), (45, 50), (50, None)]


def test_current_rows_need_no_window_and_no_history(spark):
    store = ChangeApplier(spark, new_scratch(spark, "history"), spec(), 2, 4)
    store(changes(spark, random.Random(5), 50, 0, 100), 0)
    store(changes(spark, random.Random(6), 50, 50, 150), 1)
    for df in (store.read_current(), store.read()):
        plan = df._jdf.queryExecution().toString()
        assert "Window" not in plan and "Exchange" not in plan and "Aggregate" not in plan
    files = store.read_current().inputFiles()
    assert files and all("_kind=open" in f for f in files)


def test_an_interrupted_batch_is_done_again(spark):
    from strata.fs import children, move
    path = new_scratch(spark, "history")
    store = ChangeApplier(spark, path, spec(), 2, 4)
    a, b = changes(spark, random.Random(7), 40, 0, 100).cache(), changes(spark, random.Random(8), 40, 50, 150).cache()
    store(a, 0)
    store(b, 1)
    newest = children(spark, f"{path}/manifest")[-1]
    move(spark, f"{path}/manifest/{newest}", f"{path}/lost/{newest}")  # a crash between the run and its manifest
    assert rows_of(store.read()) == rows_of(scd2(a, spec()))
    store(b, 1)
    assert rows_of(store.read()) == rows_of(scd2(a.unionByName(b), spec()))


def test_empty_batches_and_no_batch(spark):
    store = ChangeApplier(spark, new_scratch(spark, "history"), spec(), 2, 4)
    assert store.read() is None and store.read_current() is None and store.read_changes() is None
    none = spark.createDataFrame([], SCHEMA)
    store(none, 0)
    store(spark.createDataFrame([(None, "a", None, 1, "x", False)], SCHEMA), 1)
    assert store.read_quarantine().count() == 1
    b = changes(spark, random.Random(9), 30, 0, 50).cache()
    store(b, 2)
    store(none, 3)
    assert rows_of(store.read()) == rows_of(scd2(b, spec()))


@pytest.mark.parametrize("column", ["x", "d", "t", "n", "s", "b"])
def test_hot_keys_are_cut_whatever_their_order_column(spark, column):
    d = spark.range(4000).select(
        F.lit(1).alias("k"), "id", (F.col("id") % 900000).alias("x"), (F.col("id") / 4000).cast("decimal(18,9)").alias("d"),
        F.expr("timestamp_micros(1700000000000000 + id * 1000)").alias("t"), F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0,0,0, id * id / 1000)").alias("n"),
        F.format_string("2024-01-05T10:%02d:%02d", (F.col("id") / 60 % 60).cast("int"), F.col("id") % 60).alias("s"), (F.col("id") % 2 == 0).alias("b"))
    d = d.withColumn(column, F.when(F.col("id") % 97 != 0, F.col(column)))
    block = block_of(d, column, rows=100)
    sizes = [r["count"] for r in d.groupBy(block.alias("b")).count().collect()]
    assert (max(sizes) <= 700 and len(sizes) > 8) or column == "b"
    got = next_in_order(d, ["k"], [column, "id"], "id", "nxt", block=block)
    want = d.withColumn("nxt", F.lead("id").over(Window.partitionBy("k").orderBy(column, "id")))
    assert sorted(map(str, got.select("id", "nxt").collect())) == sorted(map(str, want.select("id", "nxt").collect()))


def test_a_truncate_point_outlives_a_crash_before_the_rows_change(spark):
    tr = ChangeSpec("k1", "seq", "gone", truncate_when="v = 'cut'", tie_break=["tie"])
    store = ChangeApplier(spark, new_scratch(spark, "cut"), tr, 1, 4)
    cut = (9, "a", row(9, 50)[2], 0, "cut", False)
    store(spark.createDataFrame([row(1, 10), row(2, 60)], SCHEMA), 0)
    real, store._overwrite = store._overwrite, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        store(spark.createDataFrame([cut], SCHEMA), 1)
    store._overwrite = real
    store(spark.createDataFrame([cut], SCHEMA), 1)
    store(spark.createDataFrame([row(3, 40), row(4, 70)], SCHEMA), 2)
    store(spark.createDataFrame([(9, "a", row(9, 20)[2], 0, "cut", False)], SCHEMA), 3)  # an earlier point, late
    store(spark.createDataFrame([row(5, 45)], SCHEMA), 4)
    assert sorted(r.k1 for r in store.read().collect()) == [2, 4]


def test_hot_keys_are_cut_in_the_store_and_the_others_are_not(spark, monkeypatch):
    """A batch whose keys are small is merged without blocks; hot keys, beside others, by them."""
    from strata.operators import history
    cut = []
    real = history.HistoryStore._merged_cut
    monkeypatch.setattr(history.HistoryStore, "_merged_cut", lambda self, rows: cut.append(1) or real(self, rows))
    monkeypatch.setattr(history, "ROWS", 8)
    rnd = random.Random(11)
    store = ChangeApplier(spark, new_scratch(spark, "history"), spec(), 2, 4)
    small = spark.createDataFrame([row(k, s) for k in range(30) for s in (10, 20)], SCHEMA).cache()
    store(small, 0)
    assert not cut
    hot = spark.createDataFrame([row(50, s, s % 2, s % 7 == 0) for s in rnd.sample(range(300), 60)] + [row(3, 15)], SCHEMA).cache()
    late = spark.createDataFrame([row(50, s, 2) for s in rnd.sample(range(300), 40)] + [row(4, 12), row(70, 1)], SCHEMA).cache()
    store(hot, 1)
    store(late, 2)
    assert len(cut) == 2
    want = scd2(small.unionByName(hot).unionByName(late), spec())
    assert rows_of(store.read()) == rows_of(want)
    assert rows_of(store.read_current()) == rows_of(want.where("valid_to IS NULL"))


def test_keys_that_fit_a_task_need_one_window_and_no_join(spark):
    d = spark.range(3000).select((F.col("id") % 700).alias("k"), (F.col("id") * 7919 % 3000).alias("x"), "id")
    plan = next_in_order(d, ["k"], ["x", "id"], "id", "n")._jdf.queryExecution().toString()
    assert "Join" not in plan and "__strata_block" not in plan
    hot = d.withColumn("k", F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 31 != 0, F.col("k")))  # and keys that are null
    got = next_in_order(hot, ["k"], ["x", "id"], "id", "n", rows=100)
    assert "__strata_block" in got._jdf.queryExecution().toString()
    want = hot.withColumn("n", F.lead("id").over(Window.partitionBy("k").orderBy("x", "id")))
    assert sorted(map(str, got.select("id", "n").collect())) == sorted(map(str, want.select("id", "n").collect()))
