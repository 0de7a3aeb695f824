"""Workspace: the tables of one pipeline, their refresh kinds, flows and run log.

* Materialized view: recomputed in full at each refresh, written to a new version
  directory; the catalog points at it only after the write succeeds, so a failed
  refresh (e.g. a FAIL expectation) leaves the old version readable.
* Streaming table: appended by one or more flows. Each flow is a streaming query
  with its own checkpoint whose ``foreachBatch`` writes one folder
  ``flow=<f>/batch=<id>``, renamed into place when complete. A replayed batch whose
  folder exists is skipped, so retries neither lose nor double rows nor make new files
  for downstream streams.
* Change target: ``apply_changes`` (type 1 / type 2), see ``operators.cdc``.

All paths are under one root in the shared checkpoint folder. Full refresh starts a
new generation (new data directory and new checkpoints) unless the table sets
``pipelines.reset.allowed = false``.
"""

from __future__ import annotations

import dataclasses
import json
import threading
import time
import uuid
from contextlib import contextmanager
from copy import deepcopy
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fs import children, delete, exists, mkdirs, move
from ..functions.params import Params
from ..operators import cdc as cdc_ops
from ..operators.keyregistry import KeyRegistry
from ..operators.layout import Layout, deepest, quantile_cuts, zorder_code
from ..operators.partials import Measure, PartialStore, finish, partial
from ..operators.quality import DROP, enforce, expectation_report, metric_columns
from ..session import new_scratch, prepare
from ..sources.files import RESCUE_COLUMN, file_stream, read_files_rescued
from ..streaming.runner import RunResult, await_run, start
from .eventlog import EventLog

FLOW, BATCH = "flow", "batch"
RESET_ALLOWED = "pipelines.reset.allowed"
TRIGGER_INTERVAL = "pipelines.trigger.interval"
TABLE_STATE = "table_state"


@dataclass
class TableInfo:
    name: str
    kind: str  # mv | st | cdc | agg
    generation: int = 0
    version: int = 0
    comment: str | None = None
    properties: dict = field(default_factory=dict)
    schema: str | None = None  # JSON of the user columns
    partition_by: list = field(default_factory=list)
    cluster_by: list = field(default_factory=list)
    flows: list = field(default_factory=list)
    once_done: list = field(default_factory=list)
    cdc: dict = field(default_factory=dict)
    compacted: dict = field(default_factory=dict)  # streaming table: {"path", "upto": {flow: batch}}
    partials: dict = field(default_factory=dict)  # kind agg: {"keys", "measures", "window"}
    clustered: dict = field(default_factory=dict)  # {"manifest", "keys", "cuts", "upto": {flow: batch}}

    @property
    def reset_allowed(self) -> bool:
        return str(self.properties.get(RESET_ALLOWED, "true")).lower() != "false"

    def layout(self) -> Layout:
        return Layout.from_properties(self.properties, self.cluster_by, self.partition_by)

    def struct(self) -> T.StructType | None:
        return T.StructType.fromJson(json.loads(self.schema)) if self.schema else None


class Workspace:
    def __init__(self, spark: SparkSession, root: str | None = None, pipeline_id: str | None = None,
                 params: dict | None = None, buckets: int | None = None):
        prepare(spark)
        self.spark = spark
        self.root = (root or new_scratch(spark, "pipeline")).rstrip("/")
        self.pipeline_id = pipeline_id or str(uuid.uuid4())
        self.params = Params(params or {})
        # change targets: one bucket per shuffle partition by default, so bucket size
        # follows the cluster's sizing of partitions
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.log = EventLog(spark, f"{self.root}/_event_log", self.pipeline_id)
        self.catalog: dict[str, TableInfo] = {}
        if root is not None:  # an existing workspace: its tables and versions
            self._load_catalog()
        self.update_id: str | None = None
        self._full_refresh = False
        self._continuous = False
        self._touched: set[str] = set()
        self._before: dict[str, TableInfo] = {}  # reset in this update and not refilled yet
        self._running: list[tuple] = []  # flows of a continuous update
        self._deciding = threading.Lock()

    # -- paths and catalog ---------------------------------------------------------
    def data_path(self, name: str) -> str:
        i = self.catalog[name]
        return f"{self.root}/tables/{name}/g{i.generation}v{i.version}"

    def checkpoint_path(self, name: str, flow: str) -> str:
        return f"{self.root}/checkpoints/{name}/g{self.catalog[name].generation}/{flow}"

    def _load_catalog(self) -> None:
        """The latest ``table_state`` event of each table in the run log."""
        if not exists(self.spark, self.log.path):
            return
        states = (self.log.read().where(F.col("event_type") == TABLE_STATE)
                  .groupBy("table_name")
                  .agg(F.max_by("details", F.struct("timestamp", "sequence")).alias("d")))
        for r in states.collect():  # one row per table
            self.catalog[r["table_name"]] = TableInfo(**json.loads(r["d"]))

    def _save_catalog(self) -> None:
        """Table states go to the run log with the update's other events (one write)."""
        for i in self.catalog.values():
            self.log.emit(TABLE_STATE, asdict(i), self.update_id, table=i.name)

    def _declare(self, name: str, kind: str, comment=None, properties=None, schema=None,
                 partition_by=(), cluster_by=()) -> TableInfo:
        i = self.catalog.get(name)
        if i is None:
            i = TableInfo(name=name, kind=kind)
            self.catalog[name] = i
            self.log.emit("dataset_definition", {"dataset_definition": {"dataset_type": kind}},
                          self.update_id, table=name)
        elif i.kind != kind:
            raise ValueError(f"{name} is a {i.kind}, not a {kind}")
        i.comment = comment if comment is not None else i.comment
        i.properties = {**i.properties, **(properties or {})}
        i.partition_by = list(partition_by) or i.partition_by
        i.cluster_by = list(cluster_by) or i.cluster_by  # new keys apply to new writes
        if schema is not None and i.schema is None:
            i.schema = schema.json()
        self._touch(i)
        return i

    def _touch(self, i: TableInfo) -> None:
        """First use of a table in a full-refresh update: start a new generation."""
        if not self._full_refresh or i.name in self._touched:
            return
        self._touched.add(i.name)
        if i.kind == "mv":
            return  # every refresh is a new version; the catalog moves after the write
        if not i.reset_allowed:
            self.log.emit("flow_progress", {"flow_progress": {"status": "RESET_SKIPPED"}},
                          self.update_id, table=i.name)
            return
        self._before[i.name] = deepcopy(i)
        i.generation += 1
        i.version = 0
        i.flows, i.once_done, i.compacted, i.clustered = [], [], {}, {}

    # -- updates -------------------------------------------------------------------
    @contextmanager
    def update(self, full_refresh: bool = False, continuous: bool = False, user: str | None = None):
        """One pipeline update: every definition run inside it shares the update id."""
        self.update_id = str(uuid.uuid4())
        self._full_refresh, self._continuous, self._touched, self._before = full_refresh, continuous, set(), {}
        user = user or self.spark.sparkContext.sparkUser()
        self.log.emit("user_action", {"user_action": {"action": "START", "user_name": user}}, self.update_id)
        self.log.emit("create_update", {"create_update": {"full_refresh": full_refresh,
                                                          "cause": "USER_ACTION",
                                                          "mode": "CONTINUOUS" if continuous else "TRIGGERED"}},
                      self.update_id)
        self.log.emit("update_progress", {"update_progress": {"state": "RUNNING"}}, self.update_id)
        try:
            yield self
            for run in self._running:  # in order, so a flow waits for those it reads from
                self._finish(*run)
        except Exception as e:  # noqa: BLE001 - logged, then raised
            self.catalog.update(self._before)  # reset tables without a finished flow keep their old content
            self.log.emit("update_progress", {"update_progress": {"state": "FAILED"}}, self.update_id,
                          level="ERROR", message=str(e))
            raise
        else:
            self.log.emit("update_progress", {"update_progress": {"state": "COMPLETED"}}, self.update_id)
        finally:
            for _, _, q, _ in self._running:
                if q.isActive:
                    q.stop()
            self._running = []
            self._save_catalog()
            self.log.flush()
            self.update_id = None
            self._full_refresh = False

    @contextmanager
    def _implicit_update(self):
        if self.update_id is not None:
            yield
        else:
            with self.update():
                yield

    def _drive(self, table: str, flow: str, q, record) -> RunResult | None:
        """Run a started flow to its end and record it. In a continuous update it goes on
        beside the others; they are bounded and recorded together when the update ends."""
        if self._continuous:
            self._running.append((table, flow, q, record))
            return None
        return self._finish(table, flow, q, record)

    def _finish(self, table: str, flow: str, q, record) -> RunResult:
        try:
            res = await_run(self.spark, q, self._continuous)
        except Exception as e:
            self._flow_event(table, flow, "FAILED", {}, [], level="ERROR", message=str(e))
            raise
        record(res)
        return res

    def _flow_event(self, table: str, flow: str, status: str, metrics: dict, expectations: list,
                    level: str = "INFO", message: str = "") -> None:
        d = {"flow_progress": {"status": status, "metrics": metrics}}
        if expectations:
            d["flow_progress"]["data_quality"] = {"dropped_records": metrics.get("dropped_records", 0),
                                                  "expectations": expectations}
        self.log.emit("flow_progress", d, self.update_id, table=table, flow=flow, level=level, message=message)

    # -- reads -----------------------------------------------------------------------
    def read(self, name: str) -> DataFrame:
        """Whole current content (``LIVE.t``)."""
        i = self.catalog[name]
        path = self.data_path(name)
        if i.kind == "cdc":
            applier = self._applier(i)
            df = applier.read()
            if df is None:
                return self.spark.createDataFrame([], i.struct())
            return df.select(*i.struct().fieldNames())
        if i.kind == "keys":
            return self._registry(i).duplicates(i.partials["count"])
        if i.kind == "agg":
            df = self._closed(i)
            return self.spark.createDataFrame([], i.struct()) if df is None else df.select(*i.struct().fieldNames())
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], i.struct())
        if i.clustered:
            live = [r["file"] for r in self.spark.read.parquet(i.clustered["manifest"]).select("file").collect()]  # as any scan lists its files
            df = self.spark.read.schema(i.struct()).parquet(*live)
            return df if i.kind == "mv" else df.unionByName(self._batches(i, i.clustered["upto"]).select(*i.struct().fieldNames()))
        if i.kind == "st":
            df = self._batches(i, i.compacted.get("upto", {}))
            if i.compacted:
                done = self.spark.read.schema(i.struct()).parquet(i.compacted["path"])
                return done.unionByName(df.select(*i.struct().fieldNames()))
        else:
            df = self.spark.read.parquet(path)
        return df.select(*i.struct().fieldNames())

    def _batches(self, i: TableInfo, upto: dict) -> DataFrame:
        """Rows of a streaming table's batches after those of ``upto`` (flow -> batch)."""
        late = F.lit(True)
        for flow, batch in upto.items():
            late = late & ((F.col(FLOW) != flow) | (F.col(BATCH) > batch))
        return self.spark.read.schema(self._stored_schema(i)).parquet(self.data_path(i.name)).where(late)

    def read_current(self, name: str) -> DataFrame:
        """Live rows of a change target: of a type 2 target the open versions only, read
        without its history."""
        i = self.catalog[name]
        if i.kind != "cdc":
            return self.read(name)
        df = self._applier(i).read_current()
        return self.spark.createDataFrame([], i.struct()) if df is None else df.select(*i.struct().fieldNames())

    def read_stream(self, name: str, into: str | None = None, **options) -> DataFrame:
        """New rows since the reading query's last commit (``STREAM(LIVE.t)``).

        ``into``: the reading table, if it keeps its rows in a full refresh
        (``pipelines.reset.allowed = false``). It then reads by way of a relay: a copy of what
        it was handed, to which each generation of the source adds only the rows it has more
        often than the relay (equal rows are told apart by their number)."""
        i = self.catalog[name]
        if i.kind != "st":
            raise ValueError(f"{name} is a {i.kind}; only streaming tables are append-only sources")
        path = self.data_path(name)
        reader = self.catalog.get(into) if into else None
        if reader is not None and not reader.reset_allowed:
            path = self._relay(i, into, options)
        cols = i.struct().fieldNames()
        return self.spark.readStream.schema(self._stored_schema(i)).options(**options).parquet(path).select(*cols)

    def _relay(self, i: TableInfo, into: str, options: dict) -> str:
        """Bring the relay from streaming table ``i`` to ``into`` up to date (in a continuous
        update: start doing so) and return its folder.

        A generation after the first begins with the rows of the relay, those of earlier
        generations, as a multiset of replays to come. Each micro-batch takes its rows off that
        multiset and passes on what is left of them; what is left of the multiset is written
        beside it, by batch, so a retried batch finds the one it began with."""
        relay, own = f"{self.root}/relays/{into}/{i.name}", f"g{i.generation}"
        due = f"{self.root}/relays/{into}/_{i.name}-due/{own}"  # before=<batch>: replays still to come
        cols, schema = i.struct().fieldNames(), self._stored_schema(i)
        mkdirs(self.spark, relay)
        row, number = F.struct(*cols).alias("_row"), lambda n: F.lit(n).cast("long").alias("_n")  # equal rows, nulls included, are one group

        def pass_on(batch: DataFrame, batch_id: int) -> None:
            target, stage = f"{relay}/{FLOW}={own}/{BATCH}={batch_id}", f"{self.root}/staging/relay-{into}-{i.name}/{own}-{batch_id}"
            before, after = f"{due}/before={batch_id}", f"{due}/before={batch_id + 1}"
            if batch_id or exists(self.spark, before):
                rest = self.spark.read.parquet(before).select("_row", (-F.col("_n")).alias("_n"))
            else:  # the first batch: the relay as earlier generations left it
                rest = self.spark.read.schema(schema).parquet(relay).where(F.col(FLOW) != own).select(row, number(-1))
            if rest.isEmpty():  # nothing to replay: all rows are new
                self._publish(rest, f"{stage}-due", after)
                self._publish(batch.select(*cols), stage, target)
                return
            # one shuffle for both: the surplus of a row is its number here less the replays to come
            both = batch.select(row, number(1)).unionByName(rest)
            more = both.groupBy("_row").agg(F.sum("_n").alias("_n")).where("_n <> 0").persist()
            try:
                self._publish(more.where("_n < 0").select("_row", (-F.col("_n")).alias("_n")), f"{stage}-due", after)
                new = more.where("_n > 0")
                self._publish(new.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_k")).select("_row.*"), stage, target)
            finally:
                more.unpersist()

        w = (self.spark.readStream.schema(schema).options(**options).parquet(self.data_path(i.name)).select(*cols)
             .writeStream.foreachBatch(pass_on).option("checkpointLocation", f"{self.root}/checkpoints/{into}/relay-{i.name}/{own}")
             .queryName(f"{into}.relay.{i.name}.{uuid.uuid4().hex[:6]}"))
        q = start(self.spark, w, self._continuous, None)
        self._drive(into, f"relay-{i.name}", q, lambda res: None)
        return relay

    def _publish(self, df: DataFrame, stage: str, target: str) -> None:
        """Write ``df`` as the folder ``target``, by one rename, unless it is there."""
        if not exists(self.spark, target):
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(stage)
            move(self.spark, stage, target)

    def read_changes(self, name: str, stream: bool = False) -> DataFrame:
        """Change log of a change target (op, values, batch): inserts, updates, deletes."""
        i = self.catalog[name]
        path = f"{self.data_path(name)}/changes"
        plain = [f for f in i.struct().fields if i.cdc["scd_type"] == 1 or f.name not in (cdc_ops.VALID_FROM, cdc_ops.VALID_TO)]
        schema = T.StructType(plain + [T.StructField(cdc_ops.OP, T.StringType()), T.StructField(cdc_ops.BATCH, T.LongType())])
        if stream:
            if i.cdc["scd_type"] == 2:
                raise ValueError("a type 2 change log is derived from all changes of a key; read it as a table")
            return self.spark.readStream.schema(schema).parquet(path)
        if i.cdc["scd_type"] == 2:
            df = self._applier(i).read_changes()
            return self.spark.createDataFrame([], schema) if df is None else df.select(*schema.fieldNames())
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def read_signed(self, name: str) -> DataFrame:
        """Stream of a type 1 target's changes as signed rows (``_sign``): +1 a row that came,
        -1 one that an update or delete took back."""
        i = self.catalog[name]
        if i.kind != "cdc" or i.cdc["scd_type"] != 1:
            raise ValueError(f"{name} is no type 1 change target")
        path, row = f"{self.data_path(name)}/changes", i.struct()
        mkdirs(self.spark, path)
        schema = T.StructType([*row.fields, T.StructField(cdc_ops.OP, T.StringType()), T.StructField(cdc_ops.OLD, row), T.StructField(cdc_ops.BATCH, T.LongType())])
        return cdc_ops.signed(self.spark.readStream.schema(schema).parquet(path), row.fieldNames())

    def read_quarantine(self, name: str) -> DataFrame:
        """Change rows without a key or sequence value, kept as they came."""
        i = self.catalog[name]
        df = self._applier(i).read_quarantine()
        cols = [f for f in i.struct().fields if f.name not in (cdc_ops.VALID_FROM, cdc_ops.VALID_TO)]
        return self.spark.createDataFrame([], T.StructType(cols)) if df is None else df.select(*[f.name for f in cols])

    def _stored_schema(self, i: TableInfo) -> T.StructType:
        s = i.struct()
        return T.StructType(s.fields + [T.StructField(FLOW, T.StringType()), T.StructField(BATCH, T.LongType())])

    # -- materialized views ------------------------------------------------------------
    def materialized_view(self, name: str, df: DataFrame, comment: str | None = None, expectations=(),
                          properties: dict | None = None, partition_by=(), cluster_by=()) -> DataFrame:
        """``CREATE OR REFRESH MATERIALIZED VIEW``: full recompute into a new version."""
        with self._implicit_update():
            i = self._declare(name, "mv", comment, properties, None, partition_by, cluster_by)
            rules = list(expectations)
            obs = Observation(f"dq_{name}") if rules else None
            out = enforce(df, rules, name, obs)
            out_obs = Observation(f"out_{name}")
            out = out.observe(out_obs, F.count(F.lit(1)).alias("rows"))
            layout = i.layout()
            t0 = time.time()
            prev_version = i.version
            i.version = prev_version + 1
            path = self.data_path(name)
            clustered, i.clustered = i.clustered, {}
            try:
                if layout.reads_twice or layout.partition_by:
                    out = out.persist()  # counted once, whatever the layout samples
                layout.write(out, path, layout.by_folder(out))
            except Exception as e:
                i.version, i.clustered = prev_version, clustered  # the old version stays current
                self._flow_event(name, name, "FAILED", {}, [], level="ERROR", message=str(e))
                raise
            finally:
                out.unpersist()
            i.schema = df.schema.json()
            metrics = {"num_output_rows": int(out_obs.get.get("rows", 0)),
                       "duration_ms": int((time.time() - t0) * 1000)}
            report = []
            if obs is not None:
                m = obs.get
                report = expectation_report(m, rules, name)
                metrics["num_input_rows"] = int(m.get("rows", 0))
                metrics["dropped_records"] = metrics["num_input_rows"] - metrics["num_output_rows"]
            self._flow_event(name, name, "COMPLETED", metrics, report)
        return self.read(name)

    # -- streaming tables and flows ------------------------------------------------------
    def streaming_table(self, name: str, schema: T.StructType | None = None, comment: str | None = None,
                        properties: dict | None = None, partition_by=(), cluster_by=()) -> TableInfo:
        """Declare a streaming table (possibly empty, filled later by flows)."""
        i = self._declare(name, "st", comment, properties, schema, partition_by, cluster_by)
        if schema is not None:
            self._create_empty(i)
        return i

    def _create_empty(self, i: TableInfo) -> None:
        # makes the directory exist so streams can start on it before any flow ran
        mkdirs(self.spark, self.data_path(i.name))

    def _flow_writer(self, i: TableInfo, flow: str, rules: list, counts: dict):
        """The ``foreachBatch`` function of a flow. It applies the rules and adds up what it
        wrote in ``counts``; the micro-batch's plan runs once, whatever the layout reads."""
        layout = i.layout()
        path = self.data_path(i.name)
        kept = F.lit(True)
        for r in rules:
            kept = kept & r.holds() if r.action == DROP else kept

        def write(df: DataFrame, batch_id: int) -> None:
            target = f"{path}/{FLOW}={flow}/{BATCH}={batch_id}"
            stage = f"{self.root}/staging/{i.name}/g{i.generation}/{flow}-{batch_id}"
            seen = [*metric_columns(rules), F.count_if(kept).alias("out")]
            done = exists(self.spark, target)  # committed by an earlier attempt
            if done or layout.reads_twice or layout.partition_by:
                df = df.persist()
                try:
                    m = df.agg(*seen).first().asDict()
                    out = enforce(df, rules, i.name)
                    if not done:
                        layout.write(out, stage, self._by_folder(i, out))
                finally:
                    df.unpersist()
            else:  # counted by the write itself
                obs = Observation(f"flow_{uuid.uuid4().hex}")
                layout.write(enforce(df.observe(obs, *seen), rules, i.name), stage, True)
                m = obs.get
            if not done:
                move(self.spark, stage, target)
            for k, v in m.items():
                counts[k] = counts.get(k, 0) + (v or 0)
        return write

    def _by_folder(self, i: TableInfo, df: DataFrame) -> bool:
        """``Layout.by_folder`` of a streaming table: decided by its first batch that has rows and
        kept beside the batches, as all of them are read as one table. Flows of an update may
        write side by side, so one at a time decides."""
        if not i.partition_by:
            return False
        mark = f"{self.data_path(i.name)}/_partitions"
        with self._deciding:
            if not children(self.spark, mark):
                data = self.data_path(i.name)
                batches = [f"{data}/{f}/{b}" for f in children(self.spark, data) if f.startswith(f"{FLOW}=") for b in children(self.spark, f"{data}/{f}")]
                if any("=" in n for b in batches for n in children(self.spark, b)):  # written before there was a mark
                    return True
                if df.isEmpty():
                    return True
                mkdirs(self.spark, f"{mark}/{'folders' if i.layout().by_folder(df) else 'ranges'}")
            return children(self.spark, mark) == ["folders"]

    def append_flow(self, target: str, flow: str, df: DataFrame, once: bool = False, expectations=(),
                    comment: str | None = None, allow_new_columns: bool = False) -> RunResult | None:
        """``CREATE FLOW f AS INSERT INTO target BY NAME SELECT ...`` on a stream.

        Columns are matched by name; target columns the flow lacks are NULL. With
        ``once=True`` (backfill) the flow runs in one update only."""
        with self._implicit_update():
            i = self.catalog[target]
            self._touch(i)
            if once and flow in i.once_done:
                self._flow_event(target, flow, "SKIPPED", {}, [])
                return None
            if i.schema is None:
                i.schema = df.schema.json()
                self._create_empty(i)
            df = self._by_name(df, i, allow_new_columns)
            rules, counts = list(expectations), {}
            interval = i.properties.get(TRIGGER_INTERVAL)
            w = (df.writeStream.foreachBatch(self._flow_writer(i, flow, rules, counts))
                 .option("checkpointLocation", self.checkpoint_path(target, flow))
                 .queryName(f"{target}.{flow}.{uuid.uuid4().hex[:6]}"))
            q = start(self.spark, w, self._continuous, interval)
            return self._drive(target, flow, q, lambda res: self._record_flow(i, flow, once, res, rules, counts))

    def _record_flow(self, i: TableInfo, flow: str, once: bool, res: RunResult, rules=(), counts: dict | None = None):
        self._before.pop(i.name, None)  # the new generation has content: it stays
        counts = counts or {}
        metrics = {"num_output_rows": int(counts.get("out", 0)), "num_input_rows": res.input_rows,
                   "batches": res.batches, "duration_ms": res.duration_ms,
                   "num_rows_dropped_by_watermark": res.dropped_by_watermark}
        report = []
        if rules:
            report = expectation_report(counts, rules, i.name)
            metrics["dropped_records"] = int(counts.get("rows", 0)) - metrics["num_output_rows"]
        for vals in res.observed.values():  # named counts of the flow's plan
            metrics.update({k: int(v) for k, v in vals.items()})
        if flow not in i.flows:
            i.flows.append(flow)
        if once and flow not in i.once_done:
            i.once_done.append(flow)
        self._flow_event(i.name, flow, "COMPLETED", metrics, report)

    @staticmethod
    def _by_name(df: DataFrame, i: TableInfo, allow_new_columns: bool) -> DataFrame:
        target = i.struct()
        extra = [c for c in df.columns if c not in target.fieldNames()]
        if extra and not allow_new_columns:
            raise ValueError(f"flow into {i.name} has columns the table lacks: {extra}")
        if extra:
            target = T.StructType(target.fields + [df.schema[c] for c in extra])
            i.schema = target.json()
        have = set(df.columns)
        return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in target.fields])

    def streaming_table_as(self, name: str, df: DataFrame, comment: str | None = None, expectations=(),
                           properties: dict | None = None, partition_by=(), cluster_by=()) -> RunResult | None:
        """``CREATE OR REFRESH STREAMING TABLE t AS SELECT ... FROM STREAM ...``."""
        with self._implicit_update():
            self.streaming_table(name, None, comment, properties, partition_by, cluster_by)
            return self.append_flow(name, name, df, expectations=expectations)

    def ingest_files(self, name: str, path: str, schema: T.StructType, format: str = "csv", sep: str = ",", multi_line: bool = False,
                     max_files_per_trigger: int | None = None, rescue_column: str = RESCUE_COLUMN, expectations=(),
                     comment: str | None = None, properties: dict | None = None, partition_by=(), cluster_by=(), **options) -> RunResult | None:
        """Streaming table over CSV or JSON files that binds each file by its own names and
        keeps in ``rescue_column`` what ``schema`` has no place for. The stream is of files;
        a micro-batch reads the files that are new to it (``read_files_rescued``)."""
        with self._implicit_update():
            full = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField(rescue_column, T.StringType())])
            i = self.streaming_table(name, full, comment, properties, partition_by, cluster_by)
            rules, counts = list(expectations), {}
            write = self._flow_writer(i, name, rules, counts)

            def read_new(files: DataFrame, batch_id: int) -> None:
                paths = [r["path"] for r in files.select("path").collect()]  # a row a new file
                if paths:
                    write(read_files_rescued(self.spark, paths, schema, format, sep, multi_line, rescue_column, **options), batch_id)

            w = (file_stream(self.spark, path, max_files_per_trigger).writeStream.foreachBatch(read_new)
                 .option("checkpointLocation", self.checkpoint_path(name, name)).queryName(f"{name}.{uuid.uuid4().hex[:6]}"))
            q = start(self.spark, w, self._continuous, i.properties.get(TRIGGER_INTERVAL))
            return self._drive(name, name, q, lambda res: self._record_flow(i, name, False, res, rules, counts))

    # -- change targets ------------------------------------------------------------------
    def _applier(self, i: TableInfo) -> cdc_ops.ChangeApplier:
        c = i.cdc
        spec = cdc_ops.ChangeSpec(c["keys"], c["sequence_by"], c.get("delete_when"), c.get("truncate_when"),
                                  c.get("tie_break"), c.get("except_columns", ()), c.get("null_keys", False))
        return cdc_ops.ChangeApplier(self.spark, self.data_path(i.name), spec, c["scd_type"], c["buckets"])

    def apply_changes(self, target: str, df: DataFrame, keys, sequence_by, delete_when: str | None = None,
                      truncate_when: str | None = None, scd_type: int = 1, tie_break=None,
                      except_columns=(), comment: str | None = None, buckets: int | None = None) -> RunResult:
        """``APPLY CHANGES INTO target FROM STREAM(src) KEYS (...) SEQUENCE BY ...``."""
        with self._implicit_update():
            i = self._declare(target, "cdc", comment)
            cols = [c for c in df.columns if c not in except_columns]
            schema = T.StructType([df.schema[c] for c in cols])
            if scd_type == 2:
                seq_type = df.schema[sequence_by if isinstance(sequence_by, str) else sequence_by[0]].dataType
                schema = T.StructType(schema.fields + [T.StructField(cdc_ops.VALID_FROM, seq_type),
                                                       T.StructField(cdc_ops.VALID_TO, seq_type)])
            i.schema = i.schema or schema.json()
            i.cdc = i.cdc or {"keys": keys, "sequence_by": sequence_by, "delete_when": delete_when,
                              "truncate_when": truncate_when, "scd_type": scd_type, "tie_break": tie_break,
                              "except_columns": list(except_columns), "buckets": buckets or self.buckets}
            applier = self._applier(i)
            # change rows without a key or sequence value are quarantined and counted
            w = (df.observe(f"cdc_{target}", F.count_if(~applier.spec.usable()).alias("null_key_or_sequence"))
                 .writeStream.foreachBatch(applier)
                 .option("checkpointLocation", self.checkpoint_path(target, "apply_changes"))
                 .queryName(f"{target}.apply_changes.{uuid.uuid4().hex[:6]}"))
            q = start(self.spark, w, self._continuous, i.properties.get(TRIGGER_INTERVAL))
            # what the run changed in the target, counted batch by batch
            return self._drive(target, "apply_changes", q, lambda res: self._record_flow(
                i, "apply_changes", False, res, (), {"out": applier.applied}))

    # -- streaming aggregates ------------------------------------------------------------
    def aggregate_table(self, name: str, df: DataFrame, output_mode: str, keys=(), comment: str | None = None,
                        properties: dict | None = None) -> RunResult:
        """Streaming aggregate into a table.

        * ``append``: finalised groups only (needs a watermark), appended;
        * ``complete``: the whole result, overwritten each micro-batch;
        * ``update``: changed groups, upserted by ``keys`` (all group columns, NULL is a
          key like any other; latest batch wins)."""
        with self._implicit_update():
            if output_mode == "append":
                self.streaming_table(name, None, comment, properties)
                return self.append_flow(name, name, df)
            if output_mode == "update":
                keyed = df
                i = self._declare(name, "cdc", comment, properties)
                i.schema = i.schema or df.schema.json()
                i.cdc = i.cdc or {"keys": list(keys), "sequence_by": cdc_ops.BATCH, "tie_break": [],
                                  "scd_type": 1, "buckets": self.buckets, "null_keys": True}
                applier = self._applier(i)

                def upsert(batch: DataFrame, batch_id: int) -> None:
                    applier(batch.withColumn(cdc_ops.BATCH, F.lit(batch_id).cast("long")), batch_id)
                fn, ckpt_flow, written = upsert, "update", lambda: applier.applied
            elif output_mode == "complete":
                keyed = df
                i = self._declare(name, "mv", comment, properties)
                i.schema = i.schema or df.schema.json()

                def overwrite(batch: DataFrame, batch_id: int) -> None:
                    # a new version each time: the last whole result stays until this one is
                    path = f"{self.root}/tables/{name}/g{i.generation}v{i.version + 1}"
                    batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
                    i.version += 1
                    counts["out"] = self.spark.read.parquet(path).count()  # from the files' footers
                counts: dict = {}
                fn, ckpt_flow, written = overwrite, "complete", lambda: counts.get("out", 0)
            else:
                raise ValueError(f"unknown output mode {output_mode}")
            w = (keyed.writeStream.outputMode(output_mode).foreachBatch(fn)
                 .option("checkpointLocation", self.checkpoint_path(name, ckpt_flow))
                 .queryName(f"{name}.{ckpt_flow}.{uuid.uuid4().hex[:6]}"))
            q = start(self.spark, w, self._continuous, i.properties.get(TRIGGER_INTERVAL))
            return self._drive(name, name, q, lambda res: self._record_flow(i, name, False, res, (), {"out": written()}))

    # -- aggregates kept as partials -------------------------------------------------------
    def _store(self, i: TableInfo) -> PartialStore:
        return PartialStore(self.spark, self.data_path(i.name), i.partials["keys"], [Measure(*m) for m in i.partials["measures"]])

    def _partial_table(self, name: str, keys: list[str], measures: list[Measure], window: dict | None, sample: DataFrame,
                       comment: str | None, properties: dict | None) -> TableInfo:
        i = self._declare(name, "agg", comment, properties)
        i.partials = i.partials or {"keys": list(keys), "measures": [list(m) for m in measures], "window": window}
        if i.schema is None:  # the types of the result, from its plan
            none = self.spark.createDataFrame([], sample.schema)
            i.schema = finish(partial(none, keys, measures), list(keys), measures).schema.json()
        return i

    def _run_partials(self, i: TableInfo, df: DataFrame, take) -> RunResult | None:
        w = (df.writeStream.foreachBatch(take).option("checkpointLocation", self.checkpoint_path(i.name, "partials"))
             .queryName(f"{i.name}.partials.{uuid.uuid4().hex[:6]}"))
        q = start(self.spark, w, self._continuous, i.properties.get(TRIGGER_INTERVAL))

        def record(res: RunResult) -> None:
            if i.kind == "agg":
                self._store(i).fold()
            self._record_flow(i, i.name, False, res)
        return self._drive(i.name, i.name, q, record)

    def signed_aggregate(self, name: str, source: str, keys, measures: list[Measure], comment: str | None = None,
                         properties: dict | None = None) -> RunResult | None:
        """Aggregate by ``keys`` over a type 1 change target that follows its updates and
        deletes: each batch adds the partials of its signed rows, so a group's values and the
        groups there are stay those of the target as it is. Counts, totals and means."""
        with self._implicit_update():
            keys = list(keys)
            for m in measures:
                m.parts(F.lit(1))  # can it be taken back?
            df = self.read_signed(source)
            i = self._partial_table(name, keys, measures, None, self.spark.createDataFrame([], self.catalog[source].struct()), comment, properties)
            store = self._store(i)
            return self._run_partials(i, df, lambda batch, n: store.add(batch, n, sign=cdc_ops.SIGN))

    def _registry(self, i: TableInfo) -> KeyRegistry:
        return KeyRegistry(self.spark, self.data_path(i.name), i.partials["keys"], i.struct(), i.partials["buckets"])

    def key_check(self, name: str, df: DataFrame, keys, count_name: str = "num_rows", comment: str | None = None,
                  properties: dict | None = None) -> RunResult | None:
        """Keys of a stream that have come other than once so far, kept up to date by what each
        run brings (``operators.keyregistry``): the table itself is not read again."""
        with self._implicit_update():
            keys = [keys] if isinstance(keys, str) else list(keys)
            i = self._declare(name, "keys", comment, properties)
            i.partials = i.partials or {"keys": keys, "count": count_name, "buckets": self.buckets}
            i.schema = i.schema or T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys] + [T.StructField(count_name, T.LongType())]).json()
            return self._run_partials(i, df.select(*keys), self._registry(i))

    def window_table(self, name: str, df: DataFrame, time: str, size: str, delay: str, measures: list[Measure], keys=(),
                     comment: str | None = None, properties: dict | None = None) -> RunResult | None:
        """Tumbling windows of ``size`` over ``time`` that are read once they are closed, i.e.
        end at or before the greatest time of earlier batches less ``delay``. Rows that come
        for a closed window are kept (``read_late``), not dropped; ``repair`` takes them in.

        Windows are kept as partials by batch; the watermark is a row a batch beside them, so
        a retried batch finds the one it began with."""
        with self._implicit_update():
            keys = ["window_start", "window_end", *keys]

            def windowed(rows: DataFrame) -> DataFrame:
                w = F.window(F.col(time).cast("timestamp"), size)
                return rows.withColumn("window_start", w["start"].cast("timestamp_ntz")).withColumn("window_end", w["end"].cast("timestamp_ntz"))

            sample = windowed(self.spark.createDataFrame([], df.schema))
            i = self._partial_table(name, keys, measures, {"delay": delay, "schema": df.schema.json()}, sample, comment, properties)
            store = self._store(i)

            def take(batch: DataFrame, n: int) -> None:
                rows = windowed(batch).persist()
                try:
                    mark = self._mark(i, n)
                    closed = F.lit(False) if mark is None else F.col("window_end") <= mark - F.expr(f"INTERVAL {delay}")
                    known = F.col("window_start").isNotNull()  # a row without a time is in no window
                    store.publish(rows.where(closed & known), f"late/batch-{n}")
                    store.add(rows.where(~closed & known), n)
                    seen = rows.agg(F.max(F.col(time).cast("timestamp_ntz")).alias("mark"))
                    if mark is not None:
                        seen = seen.select(F.greatest("mark", mark).alias("mark"))
                    store.publish(seen.coalesce(1), f"marks/before-{n + 1}")
                finally:
                    rows.unpersist()
            return self._run_partials(i, df, take)

    def _mark(self, i: TableInfo, before: int | None = None):
        """The greatest event time of the batches before one (of all without one)."""
        numbers = sorted(int(n.split("-")[1]) for n in children(self.spark, f"{self.data_path(i.name)}/marks"))
        numbers = [n for n in numbers if before is None or n <= before]
        if not numbers:
            return None
        mark = self.spark.read.parquet(f"{self.data_path(i.name)}/marks/before-{numbers[-1]}").first()["mark"]
        return None if mark is None else F.lit(str(mark)).cast("timestamp_ntz")  # a text: no time zone comes in between

    def _closed(self, i: TableInfo) -> DataFrame | None:
        df = self._store(i).read()
        if df is None or not i.partials["window"]:
            return df
        mark = self._mark(i)
        delay = F.expr(f"INTERVAL {i.partials['window']['delay']}")
        return df.where(F.lit(False) if mark is None else F.col("window_end") <= mark - delay)

    def read_late(self, name: str) -> DataFrame:
        """Rows that came for a window after it was closed, as they came."""
        i = self.catalog[name]
        schema = T.StructType.fromJson(json.loads(i.partials["window"]["schema"]))
        base = f"{self.data_path(name)}/late"
        paths = [f"{base}/{n}" for n in children(self.spark, base)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def repair(self, name: str) -> int:
        """Reopen the windows that late rows belong to: their partials are added to those of
        the table. Returns the number of late batches taken in; each is so once."""
        i, done = self.catalog[name], 0
        store, base = self._store(i), f"{self.data_path(name)}/late"
        last = max((int(n.rsplit("-", 1)[1]) for n in children(self.spark, f"{store.path}/parts") if n.startswith("late-")), default=-1)
        _, upto = store._folded()
        for n in sorted(int(x.split("-")[1]) for x in children(self.spark, base)):
            if n > max(last, upto.get("late", -1)):
                store.add(self.spark.read.parquet(f"{base}/batch-{n}"), n, "late")
                done += 1
        return done

    # -- maintenance ---------------------------------------------------------------------
    def _arranged(self, i: TableInfo, df: DataFrame, path: str) -> None:
        layout = i.layout()
        if not (layout.cluster_by or layout.zorder_by or layout.partition_by):
            layout = dataclasses.replace(layout, optimize_write=True)
        layout.write(df, path, layout.by_folder(df))

    def compact(self, name: str) -> DataFrame:
        """Rewrite a table with its layout into few, clustered files. Readers move to them
        with the catalog. A materialized view gets a new version; a streaming table a
        compacted copy of its batches so far, beside them (streams go on reading the
        batches, so nothing is read again); a type 1 change target its buckets anew."""
        i = self.catalog[name]
        if i.kind == "cdc":
            self._applier(i).compact()
            return self.read(name)
        df = self.read(name)
        if i.kind == "st":
            path, upto = f"{self.root}/compacted/{name}/{uuid.uuid4().hex[:12]}", self._upto(i)
            self._arranged(i, df, path)
            i.compacted = {"path": path, "upto": upto}
        else:
            self._arranged(i, df, f"{self.root}/tables/{name}/g{i.generation}v{i.version + 1}")
            i.version += 1
        i.clustered = {}
        self._save_catalog()
        self.log.flush()
        return self.read(name)

    def _upto(self, i: TableInfo) -> dict:
        """The last batch of each flow of a streaming table."""
        rows = self._batches(i, {}).groupBy(FLOW).agg(F.max(BATCH).alias("upto")).collect()  # one row a flow
        return {r[FLOW]: r["upto"] for r in rows}

    def cluster(self, name: str, depth: int = 2, rows_per_file: int = 1_000_000) -> dict:
        """Improve the clustering of a table on its present cluster keys by rewriting only the
        files that overlap the most, until no key value lies in more than ``depth`` of the
        others (``operators.layout.deepest``). Each file's span of the keys is measured once
        and kept; after a change of keys all spans are measured anew (a scan of the keys).
        Readers move with the catalog; streams go on reading the batches. Returns the
        numbers of ``files`` before and of those ``rewritten`` and ``written``."""
        i = self.catalog[name]
        keys = i.layout().zorder_by or i.cluster_by
        if i.kind not in ("st", "mv") or not keys:
            raise ValueError(f"{name} is no table with cluster keys")
        if i.partition_by:
            raise ValueError(f"{name} is partitioned: its files are clustered inside their partitions when they are written")
        columns, upto, known = i.struct().fieldNames(), self._upto(i) if i.kind == "st" else {}, i.clustered
        same = bool(known) and known["keys"] == list(keys)
        cuts = known["cuts"] if same else quantile_cuts(self.read(name), keys)

        def spans(df: DataFrame) -> DataFrame:
            code = zorder_code(df, keys, cuts=cuts)
            return (df.select(F.col("_metadata.file_path").alias("file"), code.alias("code")).groupBy("file")
                    .agg(F.min("code").alias("lo"), F.max("code").alias("hi"), F.count(F.lit(1)).alias("n")))

        if known:
            before = self.spark.read.parquet(known["manifest"])
            if not same:
                before = spans(self.spark.read.schema(i.struct()).parquet(*[r["file"] for r in before.select("file").collect()]))
            if i.kind == "st":
                before = before.unionByName(spans(self._batches(i, known["upto"])))
        elif i.kind == "st":
            before = spans(self._batches(i, i.compacted.get("upto", {})))
            if i.compacted:
                before = before.unionByName(spans(self.spark.read.schema(i.struct()).parquet(i.compacted["path"])))
        else:
            before = spans(self.spark.read.schema(i.struct()).parquet(self.data_path(name)))
        files = before.collect()  # a row a file
        chosen = {files[k]["file"] for k in deepest([(r["lo"], r["hi"]) for r in files], depth)}
        new = []
        folder = f"{self.root}/clustered/{name}/{uuid.uuid4().hex[:12]}"
        if chosen:
            df = self.spark.read.schema(i.struct()).parquet(*sorted(chosen))
            ranges = max(1, -(-sum(r["n"] for r in files if r["file"] in chosen) // rows_per_file))
            code = "__code"
            while code in columns:
                code += "_"
            spread = F.xxhash64(*[F.col(c) for c in columns])  # a hot value may fill several files
            (df.withColumn(code, zorder_code(df, keys, cuts=cuts)).repartitionByRange(ranges, code, spread).sortWithinPartitions(code).drop(code)
             .write.options(**i.layout().writer_options(columns)).parquet(f"{folder}/rows"))
            new = spans(self.spark.read.schema(i.struct()).parquet(f"{folder}/rows")).collect()
        live = [tuple(r) for r in files if r["file"] not in chosen] + [tuple(r) for r in new]
        self.spark.createDataFrame(live, before.schema).coalesce(1).write.parquet(f"{folder}/manifest")
        i.clustered = {"manifest": f"{folder}/manifest", "keys": list(keys), "cuts": cuts, "upto": upto}
        self._save_catalog()
        self.log.flush()
        return {"files": len(files), "rewritten": len(chosen), "written": len(new)}

    def vacuum(self, name: str, keep: int = 1) -> list[str]:
        """Remove old versions of a materialized view, keeping the ``keep`` newest
        (the current one always stays). Returns the removed directories."""
        i = self.catalog[name]
        if i.kind != "mv":
            raise ValueError("only materialized views keep older versions")
        gone = []
        for v in range(0, max(0, i.version - max(1, keep) + 1)):
            path = f"{self.root}/tables/{name}/g{i.generation}v{v}"
            if exists(self.spark, path) and delete(self.spark, path):
                gone.append(path)
        return gone

    def tables(self) -> DataFrame:
        """Catalog of the workspace: name, kind, comment, properties, version."""
        rows = [(i.name, i.kind, i.comment, json.dumps(i.properties, sort_keys=True), i.generation, i.version,
                 ",".join(i.flows)) for i in self.catalog.values()]
        return self.spark.createDataFrame(
            rows, "table_name string, kind string, comment string, properties string, generation int, "
                  "version int, flows string")
