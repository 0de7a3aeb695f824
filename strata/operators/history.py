"""History store: the versions of every key, kept so that neither a read nor a change needs
the whole history of a key.

A row is one change with the order of the next change of its key beside it (``_next``), so a
version knows its own end. The rows of a key tile time without a gap: a *birth* row stands
for the time before the first change, deletes are rows too, and the row without a next one
is *open*. Every change therefore falls into exactly one row, and splits it.

Layout: a batch writes one run, ``rows/_run=<n>/_kind=<open|closed|birth>/_bucket=<b>``, rows
sorted by key and order. The manifest of a run lists the live (run, kind, bucket) folders
with the span of order values in each; a table is what its newest manifest names. A run and
then its manifest appear by one rename each, so a reader sees a batch whole or not at all,
and a batch that was interrupted is simply done again.

* A change newer than its key's open row touches the open rows of the key's bucket only:
  the old row is closed into the new run, older runs are neither read nor written.
* A late change reads the runs of its bucket whose span covers it, splits the row it falls
  into, and moves the one run that held that row into the new one.
* A batch is merged by one shuffle by bucket, in which its rows are also written; only keys
  of very many rows are cut over several tasks (``sequence``).
* Current rows are the open runs, the history all runs: no window, no merge by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fs import children, delete, exists, move
from .sequence import ROWS, block_of, hot_keys, next_in_order, split_hot

NEXT, BATCH, DELETED = "_next", "_batch", "_deleted"
RUN, KIND, BUCKET = "_run", "_kind", "_bucket"
OPEN, CLOSED, BIRTH = "open", "closed", "birth"
_STORED, _WAS, _RANK = "_stored", "_was", "_rank"  # while a batch is merged


class HistoryStore:
    """Versions under ``path``; ``order`` is a total order of a key's changes whose leading
    column is never null, ``columns`` the columns of a change."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], columns: T.StructType, buckets: int):
        self.spark, self.keys, self.order, self.buckets = spark, keys, order, buckets
        self.rows, self.manifests, self.staging = f"{path}/rows", f"{path}/manifest", f"{path}/_staging"
        self.columns = columns
        nested = T.StructType([T.StructField(c, columns[c].dataType) for c in order])
        self.schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in columns.fields], T.StructField(DELETED, T.BooleanType()),
                                    T.StructField(BATCH, T.LongType()), T.StructField(NEXT, nested)])
        self.parts = [T.StructField(RUN, T.LongType()), T.StructField(KIND, T.StringType()), T.StructField(BUCKET, T.IntegerType())]

    # -- manifests -----------------------------------------------------------------------
    def _version(self) -> int | None:
        names = [int(n.split("=")[1]) for n in children(self.spark, self.manifests)]
        return max(names, default=None)

    def _live(self) -> tuple[int, list]:
        """Number of the newest run (-1: none) and its manifest: one row a live folder."""
        n = self._version()
        return (-1, []) if n is None else (n, self.spark.read.parquet(f"{self.manifests}/n={n}").collect())

    def applied(self) -> int:
        """The last batch that is in the store, -1 for none."""
        _, live = self._live()
        return max((r["batch"] for r in live), default=-1)

    def folders(self) -> list[tuple[int, str, int]]:
        """Live ``(run, kind, bucket)`` folders."""
        return sorted((r[RUN], r[KIND], r[BUCKET]) for r in self._live()[1])

    def size(self) -> int:
        """Number of versions, from the manifest."""
        return sum(r["versions"] for r in self._live()[1])

    def _read(self, folders: list) -> DataFrame:
        """Rows of these folders with their ``_run``, ``_kind`` and ``_bucket``. A kind that is
        live in all buckets of a run is read by one path."""
        schema = T.StructType([*self.schema.fields, *self.parts])
        if not folders:
            return self.spark.createDataFrame([], schema)
        by: dict[tuple, list] = {}
        for r in folders:
            by.setdefault((r[RUN], r[KIND], r["buckets"]), []).append(r[BUCKET])
        paths = []
        for (run, kind, n), own in by.items():
            path = f"{self.rows}/{RUN}={run}/{KIND}={kind}"
            paths += [path] if len(own) == n else [f"{path}/{BUCKET}={b}" for b in own]
        return self.spark.read.schema(schema).option("basePath", self.rows).parquet(*paths)

    # -- reads -----------------------------------------------------------------------------
    def _versions(self, df: DataFrame, valid_from: str, valid_to: str) -> DataFrame:
        names, seq = self.columns.fieldNames(), self.order[0]
        return df.where(~F.col(DELETED)).select(*names, F.col(seq).alias(valid_from), F.col(NEXT)[seq].alias(valid_to))

    def versions(self, valid_from: str, valid_to: str) -> DataFrame:
        """The whole history: one row a version, ``valid_to`` null for the open ones."""
        return self._versions(self._read([r for r in self._live()[1] if r[KIND] != BIRTH]), valid_from, valid_to)

    def current(self, valid_from: str, valid_to: str) -> DataFrame:
        """The open version of every key that has one."""
        return self._versions(self._read([r for r in self._live()[1] if r[KIND] == OPEN]), valid_from, valid_to)

    def events(self) -> DataFrame:
        """Every change once, with the batch that brought it."""
        return self._read([r for r in self._live()[1] if r[KIND] != BIRTH]).select(*self.columns.fieldNames(), DELETED, BATCH)

    # -- writes ------------------------------------------------------------------------------
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _at(self) -> Column:
        return F.struct(*self.order)

    def apply(self, changes: DataFrame, batch_id: int) -> int:
        """Take ``changes`` (the store's columns and ``_deleted``) in as batch ``batch_id``.
        Changes that the store has already are left out; a batch it has taken is skipped.
        ``changes`` are read several times. Returns by how many versions the table grew."""
        newest, live = self._live()
        if batch_id <= max((r["batch"] for r in live), default=-1):
            return 0
        seq = F.col(self.order[0])
        ev = changes.select(*self.columns.fieldNames(), DELETED).withColumn(BATCH, F.lit(batch_id).cast("long")).withColumn(BUCKET, self._bucket())
        per = ev.groupBy(*self.keys, BUCKET).agg(F.min(seq).alias("_lo"), F.max(seq).alias("_hi"), F.count(F.lit(1)).alias("_n")).persist()
        try:
            most = {r[BUCKET]: r["n"] for r in per.groupBy(BUCKET).agg(F.max("_n").alias("n")).collect()}  # at most ``buckets``
            if not most:
                return 0
            opened = [r for r in live if r[KIND] == OPEN and r[BUCKET] in most]
            hot = hot_keys(ev, self.keys, ROWS) if max(most.values()) > ROWS else None
            if not live:
                return self._commit(self._merged(ev, per, None, hot), newest + 1, batch_id, live, set(), hot is not None)
            return self._take(ev, per, hot, batch_id, newest, live, opened)
        finally:
            per.unpersist()

    def _merged(self, ev: DataFrame, new: DataFrame, stored: DataFrame | None, hot: DataFrame | None) -> DataFrame:
        """Changes, the births of the ``new`` keys and the stored rows, each with its next one:
        the row that follows it here, but not one behind the end of the stored row it lies in
        (what follows there may not have been read). The rows of a bucket come in one
        partition, those of ``hot`` keys in many."""
        names = self.columns.fieldNames()
        nothing = F.lit(None).cast(self.schema[NEXT].dataType)
        plain = lambda df, was, run, rank: df.select(
            *names, DELETED, BATCH, BUCKET, was.alias(_WAS), run.alias(_STORED), F.lit(rank).alias(_RANK))
        place = F.lit(None).cast("struct<_run:bigint,_kind:string>")
        births = new.select(*[F.col(c) if c in self.keys else F.lit(None).cast(self.columns[c].dataType).alias(c) for c in names],
                            F.lit(True).alias(DELETED), F.lit(None).cast("long").alias(BATCH), BUCKET, nothing.alias(_WAS),
                            place.alias(_STORED), F.lit(1).alias(_RANK))
        rows = plain(ev, nothing, place, 1).unionByName(births)
        if stored is not None:
            rows = rows.unionByName(plain(stored, F.col(NEXT), F.struct(RUN, KIND), 2))
        if hot is None:
            return self._merged_whole(rows)
        large, rest = split_hot(rows, self.keys, hot)
        return self._merged_whole(rest).unionByName(self._merged_cut(large))

    def _merged_whole(self, rows: DataFrame) -> DataFrame:
        """``_merged`` of keys whose rows fit a task: one shuffle by bucket and one order."""
        line = Window.partitionBy(BUCKET, *self.keys).orderBy(*self.order, F.col(_RANK).desc())
        rows = rows.repartition(F.col(BUCKET)).withColumn("_at", self._at())
        # a change that is stored already, or comes twice, gives way
        rows = rows.withColumn("_again", F.lag("_at").over(line).eqNullSafe(F.col("_at"))).where(~F.col("_again"))
        within = F.last(F.when(F.col(_STORED).isNotNull(), F.struct(F.col(_WAS).alias("end"))), ignorenulls=True).over(
            line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return rows.withColumn(NEXT, F.least(F.lead("_at").over(line), within["end"])).drop("_at", "_again")

    def _merged_cut(self, rows: DataFrame) -> DataFrame:
        """``_merged`` of keys with more rows than a task should hold, cut into blocks. A stored
        row's end stays in line as a mark; marks are dropped afterwards."""
        names, ids = self.columns.fieldNames(), [*self.keys, *(c for c in self.order if c not in self.keys)]
        marks = rows.where(F.col(_WAS).isNotNull()).select(
            *[F.col(c) if c in self.keys else F.col(_WAS)[c].alias(c) if c in self.order else F.lit(None).cast(self.columns[c].dataType).alias(c) for c in names],
            F.lit(None).cast("boolean").alias(DELETED), F.lit(None).cast("long").alias(BATCH), BUCKET,
            F.lit(None).cast(self.schema[NEXT].dataType).alias(_WAS), F.lit(None).cast("struct<_run:bigint,_kind:string>").alias(_STORED), F.lit(0).alias(_RANK))
        block = block_of(rows, self.order[0], ROWS)
        rows = rows.unionByName(marks)
        # a change that is stored already, and a mark where a row stands, give way
        kept = [c for c in rows.columns if c not in ids]
        rows = rows.groupBy(*ids).agg(F.max_by(F.struct(*kept), _RANK).alias("_r")).select(*ids, "_r.*").withColumn("_at", self._at())
        return next_in_order(rows, self.keys, self.order, "_at", NEXT, block=block).where(F.col(_RANK) > 0).drop("_at")

    def _take(self, ev: DataFrame, per: DataFrame, hot: DataFrame | None, batch_id: int, newest: int, live: list, opened: list) -> int:
        names, keys, seq = self.columns.fieldNames(), self.keys, self.order[0]
        open_rows = self._read(opened)
        known = per.join(open_rows.select(*keys, F.col(seq).alias("_head")), keys, "left").persist()
        try:
            # late changes, and the runs of their buckets that may hold the rows they fall into
            span = {r[BUCKET]: (r["lo"], r["hi"]) for r in known.where(F.col("_lo") <= F.col("_head")).groupBy(BUCKET).agg(
                F.min("_lo").alias("lo"), F.max(F.least("_hi", "_head")).alias("hi")).collect()}  # at most ``buckets``
            older = [r for r in live if r[KIND] != OPEN and r[BUCKET] in span and (r["lo"] is None or r["lo"] <= span[r[BUCKET]][1])
                     and r["hi"] >= span[r[BUCKET]][0]]
            stored = open_rows
            if older:
                earlier = self._read(older)
                stored = open_rows.unionByName(earlier)
                hot = hot_keys(ev.select(*keys).unionByName(earlier.select(*keys)), keys, ROWS)
            merged = self._merged(ev, known.where(F.col("_head").isNull()), stored, hot)
            if not older:
                return self._commit(merged, newest + 1, batch_id, live, {(r[RUN], r[KIND], r[BUCKET]) for r in opened}, hot is not None)
            merged = merged.persist()
            try:
                held, kind = F.col(_STORED).isNotNull(), F.col(f"{_STORED}.{KIND}")
                split = merged.where(held & (kind != OPEN) & ~F.col(NEXT).eqNullSafe(F.col(_WAS)))
                # the runs whose rows were split: all their rows go into the new one
                moved = {(r[RUN], r[KIND], r[BUCKET]) for r in split.select(f"{_STORED}.*", BUCKET).distinct().collect()}
                at = F.concat_ws("/", F.col(f"{_STORED}.{RUN}"), kind, BUCKET)
                out = merged.where(~held | (kind == OPEN) | at.isin(["/".join(map(str, m)) for m in moved]))
                gone = moved | {(r[RUN], r[KIND], r[BUCKET]) for r in opened}
                return self._commit(out, newest + 1, batch_id, live, gone, hot is not None)
            finally:
                merged.unpersist()
        finally:
            known.unpersist()

    def _commit(self, rows: DataFrame, run: int, batch_id: int, live: list, gone: set, deal: bool = True) -> int:
        """Write a run and the manifest that names it in place of the folders that are gone.
        ``deal``: the rows of a bucket are not together yet. Returns by how many versions the
        table grew."""
        entries = [r.asDict() | {"batch": max(r["batch"], batch_id)} for r in live if (r[RUN], r[KIND], r[BUCKET]) not in gone]
        target, stage = f"{self.rows}/{RUN}={run}", f"{self.staging}/run-{run}"
        if exists(self.spark, target):  # of an attempt that did not reach its manifest
            delete(self.spark, target)
        kind = F.when(F.col(NEXT).isNull(), OPEN).when(F.col(self.order[0]).isNull(), BIRTH).otherwise(CLOSED)
        rows = rows.select(*self.schema.fieldNames(), kind.alias(KIND), BUCKET)
        ((rows.hint("rebalance", KIND, BUCKET) if deal else rows).sortWithinPartitions(KIND, BUCKET, *self.keys, *[c for c in self.order if c not in self.keys])
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(KIND, BUCKET).parquet(stage))
        move(self.spark, stage, target)
        new = self.spark.read.schema(T.StructType([*self.schema.fields, *self.parts[1:]])).parquet(target)
        # the end of a row is its next one's order: a change up to there may fall into it
        stats = new.groupBy(KIND, BUCKET).agg(F.min(self.order[0]).alias("lo"), F.max(F.col(NEXT)[self.order[0]]).alias("hi"),
                                              F.count_if(~F.col(DELETED)).alias("versions")).collect()  # a row a folder
        per = {k: sum(s[KIND] == k for s in stats) for k in (OPEN, CLOSED, BIRTH)}
        entries += [s.asDict() | {"lo": None if s[KIND] == BIRTH else s["lo"], RUN: run, "buckets": per[s[KIND]], "batch": batch_id} for s in stats]
        seq = self.columns[self.order[0]].dataType
        schema = T.StructType([*self.parts, T.StructField("lo", seq), T.StructField("hi", seq), T.StructField("versions", T.LongType()),
                               T.StructField("buckets", T.IntegerType()), T.StructField("batch", T.LongType())])
        stage = f"{self.staging}/manifest-{run}"
        data = [tuple(e[f] for f in schema.fieldNames()) for e in entries]
        self.spark.createDataFrame(data, schema).coalesce(1).write.mode("overwrite").parquet(stage)
        move(self.spark, stage, f"{self.manifests}/n={run}")
        return sum(e["versions"] for e in entries) - sum(r["versions"] for r in live)

    # -- upkeep ------------------------------------------------------------------------------
    def compact(self, runs: int = 1) -> None:
        """Merge the runs of every bucket and kind that has more than ``runs`` of them."""
        newest, live = self._live()
        count: dict[tuple, int] = {}
        for r in live:
            count[r[KIND], r[BUCKET]] = count.get((r[KIND], r[BUCKET]), 0) + 1
        many = [r for r in live if count[r[KIND], r[BUCKET]] > runs]
        if many:
            self._commit(self._read(many).select(*self.schema.fieldNames(), BUCKET), newest + 1, max(r["batch"] for r in live), live,
                         {(r[RUN], r[KIND], r[BUCKET]) for r in many})

    def vacuum(self) -> int:
        """Delete folders that the newest manifest does not name, and older manifests. For
        times when nobody reads an older state. Returns the number of folders."""
        newest, live = self._live()
        named, gone = {(r[RUN], r[KIND], r[BUCKET]) for r in live}, 0
        for run in children(self.spark, self.rows):
            for kind in children(self.spark, f"{self.rows}/{run}"):
                own = [b for b in children(self.spark, f"{self.rows}/{run}/{kind}") if "=" in b]
                dead = [b for b in own if (int(run.split("=")[1]), kind.split("=")[1], int(b.split("=")[1])) not in named]
                for path in [f"{self.rows}/{run}/{kind}/{b}" for b in dead]:
                    gone += delete(self.spark, path)
        for m in children(self.spark, self.manifests):
            if int(m.split("=")[1]) < newest:
                delete(self.spark, f"{self.manifests}/{m}")
        return gone
