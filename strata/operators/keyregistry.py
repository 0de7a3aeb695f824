"""Primary-key check that reads what is new and the registry of keys, never the table.

The registry holds a row for each key of a batch and how often it came, by key bucket, sorted
by key. A batch reads the registry rows of its own buckets between its smallest and its
greatest key (the files' statistics skip the rest, nearly all where keys grow), and records
every key of its own that has now come other than once. Folders appear by one rename; a
replayed batch finds its own and leaves it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fs import children, exists, move

BUCKET, BATCH, N = "_bucket", "_batch", "_n"


class KeyRegistry:
    """``foreachBatch`` function over rows with ``keys``, and its findings."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType, buckets: int):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.row = T.StructType([*[T.StructField(k, schema[k].dataType) for k in keys], T.StructField(N, T.LongType())])

    def _publish(self, df: DataFrame, name: str, batch_id: int, by_bucket: bool) -> None:
        target, stage = f"{self.path}/{name}/{BATCH}={batch_id}", f"{self.path}/_staging/{name}-{batch_id}"
        if exists(self.spark, target):
            return
        w = df.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.keys).write if by_bucket else df.write
        (w.partitionBy(BUCKET) if by_bucket else w).mode("overwrite").parquet(stage)
        move(self.spark, stage, target)

    def _registered(self, before: int) -> DataFrame:
        schema = T.StructType([*self.row.fields, T.StructField(BATCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
        if not children(self.spark, f"{self.path}/keys"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/keys").where(F.col(BATCH) < before)

    def earlier(self, own: DataFrame, batch_id: int) -> DataFrame:
        """Registry rows that keys of ``own`` (with ``_bucket``) may be among."""
        first = self.keys[0]
        touched = [r[0] for r in own.select(BUCKET).distinct().collect()]  # at most ``buckets``
        lo, hi = own.agg(F.min(first), F.max(first)).first()
        rows = self._registered(batch_id).where(F.col(BUCKET).isin(touched))
        between = F.col(first).isNull() if lo is None else F.col(first).between(F.lit(lo), F.lit(hi)) | F.col(first).isNull()
        return rows.where(between)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        own = (batch.groupBy(*self.keys).agg(F.count(F.lit(1)).alias(N))
               .withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")).persist())
        try:
            if not own.isEmpty():
                old = self.earlier(own, batch_id).groupBy(*self.keys).agg(F.sum(N).alias("_old"))
                old = old.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], "_old")
                same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)])
                total = own.join(old, same, "left").select(*self.keys, (F.col(N) + F.coalesce("_old", F.lit(0))).alias(N))
                null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
                self._publish(total.where((F.col(N) > 1) | null), "found", batch_id, False)
                self._publish(own, "keys", batch_id, True)
        finally:
            own.unpersist()

    def duplicates(self, count_name: str) -> DataFrame:
        """Keys that have come other than once, and how often (a key with a NULL: 0 times, as
        ``count(key)`` has it)."""
        base = f"{self.path}/found"
        if not children(self.spark, base):
            return self.spark.createDataFrame([], self.row).withColumnRenamed(N, count_name)
        null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        found = self.spark.read.schema(self.row).parquet(base).groupBy(*self.keys).agg(F.max(N).alias(N))
        return found.select(*self.keys, F.when(null, F.lit(0)).otherwise(F.col(N)).cast("long").alias(count_name))
