"""Change data capture: latest row per key (type 1) and full history (type 2).

The batch forms (``scd1``, ``scd2``) are plain DataFrame plans; ``ChangeApplier`` runs
them inside ``foreachBatch`` against a stored target.

Type 1 is partitioned by ``_bucket = pmod(xxhash64(keys), buckets)``: a micro-batch reads
only the buckets its keys fall in and overwrites just those. The merge is associative and
idempotent, so replays and arrival order do not change the result. Deleted keys stay as
tombstones (``_deleted``), so a late, older event cannot bring a deleted key back.

Type 2 is kept by ``operators.history``: versions with their ends, in runs by key bucket. A
batch touches the open versions of its buckets, a late change besides the one run that holds
the version it splits; a delete closes the open version and opens none.

Folders of a batch (change log, quarantined rows) appear by one rename after they are
complete; a replayed batch that finds its folder leaves it as it is.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fs import delete, exists, move
from .history import HistoryStore
from .sequence import latest_per_key, next_in_order

DELETED, TRUNCATE, BUCKET, SRC, OP, BATCH = "_deleted", "_truncate", "_bucket", "_src", "_op", "_batch"
VALID_FROM, VALID_TO = "valid_from", "valid_to"
WAS = "_was_deleted"
OLD, SIGN = "_old", "_sign"  # of a change log: the row before the change; +1 a row that came, -1 one that went
INTERNAL = (DELETED, TRUNCATE, BUCKET, SRC)


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _flag(cond: str | None) -> Column:
    return F.coalesce(F.expr(cond), F.lit(False)) if cond else F.lit(False)


class ChangeSpec:
    """Keys, ordering and the delete / truncate rules of one change feed."""

    def __init__(self, keys, sequence_by, delete_when: str | None = None, truncate_when: str | None = None,
                 tie_break=None, except_columns=(), null_keys: bool = False):
        self.null_keys = null_keys  # keys of an aggregate: NULL is a group of its own
        self.keys = _as_list(keys)
        self.sequence = _as_list(sequence_by)
        self.delete_when = delete_when
        self.truncate_when = truncate_when
        self.tie = None if tie_break is None else _as_list(tie_break)
        self.except_columns = list(except_columns)

    def order(self, df: DataFrame) -> list[str]:
        tie = self.tie if self.tie is not None else [
            c for c in df.columns if c not in self.keys + self.sequence and c not in INTERNAL]
        return self.sequence + tie  # D-7: without a tie-break, the whole row decides

    def usable(self) -> Column:
        """Change rows that can be applied: key and sequence are not NULL."""
        ok = F.lit(True)
        for c in [*([] if self.null_keys else self.keys), *self.sequence]:
            ok = ok & F.col(c).isNotNull()
        return ok

    def flags(self, df: DataFrame) -> DataFrame:
        """The usable rows with ``_deleted`` and ``_truncate``."""
        df = df.where(self.usable())
        return df.withColumn(DELETED, _flag(self.delete_when)).withColumn(TRUNCATE, _flag(self.truncate_when))

    def user_columns(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in INTERNAL and c not in self.except_columns]


def _truncate_point(ev: DataFrame, order: list[str]):
    """Highest ordering value among truncate events (one row), or None."""
    row = ev.where(F.col(TRUNCATE)).agg(F.max(F.struct(*order)).alias("t")).first()
    return None if row is None or row["t"] is None else tuple(row["t"])


def _after(order: list[str], point) -> Column:
    """``(order...) > point`` lexicographically; NULL-safe on the tie columns."""
    cond = None
    for i in reversed(range(len(order))):
        c, v = F.col(order[i]), F.lit(point[i])
        gt = c > v if point[i] is not None else c.isNotNull()
        cond = gt if cond is None else gt | (c.eqNullSafe(v) & cond)
    return cond


def scd1(df: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Latest row per key; keys whose latest event is a delete are absent; rows at or
    before the latest truncate are gone."""
    ev = spec.flags(df)
    order = spec.order(df)
    point = _truncate_point(ev, order) if spec.truncate_when else None
    ev = ev.where(~F.col(TRUNCATE))
    if point is not None:
        ev = ev.where(_after(order, point))
    cols = spec.user_columns(df)
    return latest_per_key(ev, spec.keys, order).where(~F.col(DELETED)).select(*cols)


def scd2(df: DataFrame, spec: ChangeSpec) -> DataFrame:
    """One version per non-delete event: ``valid_from`` its sequence value, ``valid_to``
    the next event's (NULL for the current version)."""
    if spec.truncate_when:
        raise ValueError("truncate is defined for type 1 only")
    return versions(spec.flags(df).drop(TRUNCATE), spec, spec.user_columns(df))


def versions(ev: DataFrame, spec: ChangeSpec, cols: list[str]) -> DataFrame:
    """Type 2 versions of the change rows ``ev`` (with ``_deleted``); equal rows are one."""
    order = spec.order(ev.select(*cols))
    seq = spec.sequence[0]
    v = next_in_order(ev.select(*cols, DELETED).dropDuplicates(spec.keys + order), spec.keys, order, value=seq, out=VALID_TO)
    return v.where(~F.col(DELETED)).withColumn(VALID_FROM, F.col(seq)).select(*cols, VALID_FROM, VALID_TO)


def version_changes(ev: DataFrame, spec: ChangeSpec, cols: list[str], once: bool = False) -> DataFrame:
    """What each change row did to the versions of its key: ``insert`` opened the first
    version (or one after a delete), ``update`` closed one and opened the next, ``delete``
    closed one. A delete without an open version did nothing and is left out. ``once``: no
    change row is there twice."""
    order = spec.order(ev.select(*cols))
    one = ev.select(*cols, DELETED, BATCH) if once else ev.groupBy(*spec.keys, *[c for c in order if c not in spec.keys]).agg(
        *[F.first(c).alias(c) for c in [*cols, DELETED] if c not in spec.keys and c not in order], F.min(BATCH).alias(BATCH))
    e = next_in_order(one, spec.keys, order, value=DELETED, out="__before", back=True)
    live = F.coalesce(~F.col("__before"), F.lit(False))
    op = (F.when(F.col(DELETED) & live, "delete").when(~F.col(DELETED) & live, "update").when(~F.col(DELETED), "insert"))
    return e.withColumn(OP, op).where(F.col(OP).isNotNull()).select(*cols, OP, BATCH)


def signed(changes: DataFrame, cols: list[str]) -> DataFrame:
    """A change log with the rows before (``_old``) as signed rows: an update takes one back
    and brings one."""
    image = lambda sign, of: F.struct(F.lit(sign).alias(SIGN), *[of(c).alias(c) for c in cols])
    both = F.array(F.when(F.col(OP) != "insert", image(-1, lambda c: F.col(OLD)[c])), F.when(F.col(OP) != "delete", image(1, F.col)))
    return changes.select(F.explode(F.filter(both, lambda r: r.isNotNull())).alias("_r")).select("_r.*")


class ChangeApplier:
    """``foreachBatch`` function applying a change feed to a bucketed Parquet target."""

    def __init__(self, spark: SparkSession, path: str, spec: ChangeSpec, scd_type: int = 1, buckets: int = 64):
        if scd_type not in (1, 2):
            raise ValueError("scd_type must be 1 or 2")
        if scd_type == 2 and spec.truncate_when:
            raise ValueError("truncate is defined for type 1 only")
        self.spark = spark
        self.spec = spec
        self.scd_type = scd_type
        self.buckets = buckets
        self.data = f"{path}/data"
        self.changes = f"{path}/changes"
        self.truncates = f"{path}/truncate"
        self.quarantined = f"{path}/quarantine"
        self.staging = f"{path}/_staging"
        self.path = path
        self.applied = 0  # changes that batches of this applier brought about

    # -- storage ----------------------------------------------------------------
    def _read(self, path: str, schema=None) -> DataFrame | None:
        if not exists(self.spark, path):
            return None
        r = self.spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.spec.keys]), F.lit(self.buckets)).cast("int")

    @staticmethod
    def _overwrite(df: DataFrame, path: str, partition: str) -> None:
        # rebalance on the partition column: few files per bucket, and AQE splits a
        # bucket that a hot key made large. Micro-batches of a query with state run without
        # AQE, which drops that hint: each task would write a file of its own per bucket.
        adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        by_bucket = df.hint("rebalance", partition) if adaptive else df.repartition(partition)
        (by_bucket.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition).parquet(path))

    def _once(self, df: DataFrame, path: str, batch_id: int) -> None:
        """Write ``df`` as the folder of ``batch_id``, unless an earlier attempt has."""
        target, stage = f"{path}/{BATCH}={batch_id}", f"{self.staging}/{path.rsplit('/', 1)[1]}-{batch_id}"
        if exists(self.spark, target):
            return
        df.hint("rebalance").write.mode("overwrite").parquet(stage)
        move(self.spark, stage, target)

    def history(self, columns: T.StructType | None = None) -> HistoryStore | None:
        """The store of a type 2 target; its columns are kept beside it by the first batch."""
        kept = f"{self.path}/columns"
        if columns is None:
            if not exists(self.spark, kept):
                return None
            columns = T.StructType.fromJson(json.loads(self.spark.read.text(kept).first()[0]))
        elif not exists(self.spark, kept):
            stage = f"{self.staging}/columns"
            self.spark.createDataFrame([(columns.json(),)], "v string").coalesce(1).write.mode("overwrite").text(stage)
            move(self.spark, stage, kept)
        order = self.spec.sequence + (self.spec.tie if self.spec.tie is not None else [
            c for c in columns.fieldNames() if c not in self.spec.keys + self.spec.sequence])
        return HistoryStore(self.spark, self.path, self.spec.keys, order, columns, self.buckets)

    def read(self) -> DataFrame | None:
        """Current target: live rows (type 1) or versions (type 2), internal columns dropped."""
        if self.scd_type == 2:
            store = self.history()
            return store and store.versions(VALID_FROM, VALID_TO)
        df = self._read(self.data)
        return df if df is None else df.where(~F.col(DELETED)).drop(DELETED, BUCKET)

    def read_current(self) -> DataFrame | None:
        """Live rows: those of a type 1 target, the open versions of a type 2 target."""
        if self.scd_type == 1:
            return self.read()
        store = self.history()
        return store and store.current(VALID_FROM, VALID_TO)

    def read_changes(self) -> DataFrame | None:
        """The change log: stored for type 1, derived from the change rows for type 2."""
        if self.scd_type == 1:
            return self._read(self.changes)
        store = self.history()
        return store and version_changes(store.events(), self.spec, store.columns.fieldNames(), once=True)

    def read_quarantine(self) -> DataFrame | None:
        """Change rows without a key or sequence value."""
        return self._read(self.quarantined)

    def compact(self) -> None:
        """Rewrite the buckets of a type 1 target into few files, merge the runs of a type 2
        target. Streams read the change log, which stays as it is."""
        if self.scd_type == 2:
            if store := self.history():
                store.compact()
        elif (df := self._read(self.data)) is not None:
            stage = f"{self.staging}/data"
            self._overwrite(df, stage, BUCKET)
            self._overwrite(self._read(stage), self.data, BUCKET)
            delete(self.spark, stage)

    # -- merge -------------------------------------------------------------------
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            lost = batch.where(~self.spec.usable())
            if not lost.isEmpty():
                self._once(lost, self.quarantined, batch_id)
            ev = self.spec.flags(batch)
            if ev.isEmpty():
                return
            if self.scd_type == 1:
                self._merge_scd1(ev, batch_id)
            else:
                cols = self.spec.user_columns(ev)
                store = self.history(T.StructType([ev.schema[c] for c in cols]))
                self.applied += store.apply(ev.select(*cols, DELETED), batch_id)
        finally:
            batch.unpersist()

    def _touched(self, df: DataFrame) -> list[int]:
        # at most ``buckets`` values
        return [r[0] for r in df.select(BUCKET).distinct().collect()]

    def _merge_scd1(self, ev: DataFrame, batch_id: int) -> None:
        spec = self.spec
        cols = spec.user_columns(ev)
        order = spec.order(ev.select(*cols))
        stored_point = None
        if spec.truncate_when:
            t = self._read(self.truncates)
            top = None if t is None else t.agg(F.max(F.struct(*order)).alias("t")).first()["t"]
            stored_point = None if top is None else tuple(top)
            batch_point = _truncate_point(ev, order)
            points = [p for p in (stored_point, batch_point) if p is not None]
            point = max(points, key=lambda p: [(v is not None, v) for v in p]) if points else None  # NULL comes first
        else:
            point = batch_point = None
        if batch_point is not None:
            # kept before the rows change, one folder a batch: a crash leaves no time without it
            self._once(self.spark.createDataFrame([batch_point], ev.select(*order).schema), self.truncates, batch_id)
        ups = ev.where(~F.col(TRUNCATE)).select(*cols, DELETED)
        if point is not None:
            ups = ups.where(_after(order, point))
        red = latest_per_key(ups, spec.keys, order).withColumn(BUCKET, self._bucket())
        cur = self._read(self.data)
        if cur is not None:
            if batch_point is None:
                touched = self._touched(red)
                cur = cur.where(F.col(BUCKET).isin(touched)) if touched else None
            if cur is not None and point is not None:
                # rows at or before the truncate become tombstones (and are logged as deleted)
                cur = cur.withColumn(WAS, F.col(DELETED)).withColumn(DELETED, F.col(DELETED) | ~_after(order, point))
        if cur is None:
            u = red.withColumn(WAS, F.col(DELETED)).withColumn(SRC, F.lit(1))
        else:
            was = cur if WAS in cur.columns else cur.withColumn(WAS, F.col(DELETED))
            u = was.select(*cols, DELETED, BUCKET, WAS).withColumn(SRC, F.lit(0)) \
                .unionByName(red.withColumn(WAS, F.col(DELETED)).withColumn(SRC, F.lit(1)))
        state = [*cols, DELETED, BUCKET]
        g = (u.groupBy(*spec.keys)
             .agg(F.max_by(F.struct(*state), F.struct(*order, SRC)).alias("new"),
                  F.max(F.when(F.col(SRC) == 0, F.struct(F.col(WAS).alias("d"),
                                                         F.struct(*order).alias("o"), F.struct(*cols).alias("r")))).alias("old"))
             .persist())
        try:
            before = F.col("old").isNotNull() & ~F.col("old.d")
            after = ~F.col("new")[DELETED]
            op = (F.when(~before & after, F.lit("insert"))
                  .when(before & after & (F.col("old.o") != F.struct(*[F.col("new")[c] for c in order])),
                        F.lit("update"))
                  .when(before & ~after, F.lit("delete")))
            changes = (g.select(*[F.col("new")[c].alias(c) for c in cols], op.alias(OP), F.when(before, F.col("old.r")).alias(OLD))
                       .where(F.col(OP).isNotNull()))
            # the log comes first, whole and once: a replay finds the data half merged
            self._once(changes.drop(BATCH), self.changes, batch_id)
            self.applied += self.spark.read.parquet(f"{self.changes}/{BATCH}={batch_id}").count()  # from the files' footers
            self._overwrite(g.select("new.*"), self.data, BUCKET)
        finally:
            g.unpersist()
