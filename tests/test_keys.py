"""The incremental key check equals the batch check and reads only what it must; repeats of a
stream are dropped by state that does not grow."""

import random

from pyspark.sql import functions as F

from strata.operators.keyregistry import KeyRegistry
from strata.plans.workspace import Workspace
from strata.session import new_scratch
from strata.sources.files import read_files_stream
from strata.streaming.event_time import deduplicated


def test_any_batches_give_the_batch_check(spark):
    rnd, schema = random.Random(2), "a int, b string, v int"
    reg, seen = None, []
    for n in range(5):
        rows = [(rnd.choice([None, *range(30)]), rnd.choice([None, "x", "y"]), rnd.randrange(9)) for _ in range(rnd.choice([0, 1, 25]) if n else 25)]
        df = spark.createDataFrame(rows, schema)
        reg = reg or KeyRegistry(spark, new_scratch(spark, "keys"), ["a", "b"], df.schema, 4)
        reg(df, n)
        reg(df, n)  # a batch that comes again
        seen += rows
        count = lambda r: 0 if r.a is None or r.b is None else r.c
        want = spark.createDataFrame(seen, schema).groupBy("a", "b").agg(F.count("*").alias("c")).collect()
        got = sorted(map(str, reg.duplicates("c").collect()))
        assert got == sorted(f"Row(a={r.a!r}, b={r.b!r}, c={count(r)})" for r in want if count(r) != 1)


def test_a_batch_reads_the_registry_by_bucket_and_range(spark):
    reg = KeyRegistry(spark, new_scratch(spark, "keys"), ["id"], spark.range(1).schema, 8)
    for n in range(3):
        reg(spark.range(n * 1000, n * 1000 + 1000), n)
    own = spark.range(2990, 2991).withColumn("_bucket", F.pmod(F.xxhash64("id"), F.lit(8)).cast("int"))
    earlier = reg.earlier(own, 3)
    plan = earlier._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(id,2990)" in plan and [r.id for r in earlier.collect()] == [2990]
    assert reg.duplicates("n").count() == 0


def test_state_of_the_deduplication_stays_bounded(spark):
    ws = Workspace(spark)
    path, schema, states = f"{ws.root}/files/in", "id long, t timestamp_ntz", []
    for day in range(1, 7):
        rows = spark.range(day * 100, day * 100 + 100).select("id", F.expr(f"timestamp_ntz'2024-01-0{day} 12:00:00'").alias("t"))
        rows.unionByName(rows.where("id % 3 = 0")).coalesce(1).write.mode("append").parquet(path)
        q = (deduplicated(read_files_stream(spark, path, schema, "parquet"), "id", "t", "1 day").writeStream.format("parquet")
             .option("path", f"{ws.root}/out").option("checkpointLocation", f"{ws.root}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        states.append(q.lastProgress.stateOperators[0].numRowsTotal)
    out = spark.read.parquet(f"{ws.root}/out")
    assert out.count() == out.select("id").distinct().count() == 600 and max(states) <= 300
